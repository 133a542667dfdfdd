"""Phrase collocations, spelling variants and decontamination against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from seriesmill.llm import collocations, decontamination, queries, variants
from tests.oracle import rows_of

SMALL = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = rows_of(queries.QUERIES[name](spark, SMALL).toPandas())
    assert got and got == rows_of(con.execute(queries.ORACLE_SQL[name]).df())


# ---- collocations


def brute_collocations(rows, top, longest, least):
    f, n, texts = defaultdict(Counter), Counter(), defaultdict(list)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        some = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in some.items():
            if any(len(h) > len(g) and 100 * b >= 50 * a and any(h[i : i + len(g)] == g for i in range(len(h))) for h, b in some.items()):
                continue
            score, k = min((10**6 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (score, a, g, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, g.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def collocated(df, **how):
    found = collocations.collocations(df, **how)
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("block, broadcast, longest", [(1 << 13, 1 << 25, 3), (4, 1 << 25, 4), (5, 0, 3), (3, 0, 2)])
def test_collocations_in_blocks_of_any_size(spark, monkeypatch, block, broadcast, longest):
    monkeypatch.setattr(collocations, "BROADCAST_BYTES", broadcast)
    rng = random.Random(block)
    ends = [" ", " ", "  ", "\t", ". ", ",", "\n", " ;x\r", "\x0b", " \x0c "]
    words = ["a", "B", "c", "é", "É", "d\x1ce", "日本", "\x00", "the", "The"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(60)))) for _ in range(60)]
    rows += rows[:5] + [(None, None), ("en", ""), ("en", " . , "), ("fr", "only once here"), ("es", "x y " * 3000)]
    df = spark.createDataFrame([(*r, i, "z", 1) for i, r in enumerate(rows)], "lang string, text string, g1 long, word string, block int").repartition(3)
    want = brute_collocations(rows, 25, longest, 4)
    assert len(want) > 40
    assert collocated(df, top=25, longest=longest, min_count=4, block=block) == want


def test_collocations_leave_no_table_and_no_setting(spark, docs):
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition"), len(spark.catalog.listTables())
    collocations.collocations(docs).count()
    assert before == (spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition"), len(spark.catalog.listTables()))


def test_a_small_bitmap_keeps_results(spark, docs, monkeypatch):
    want = collocated(docs, min_count=5)
    monkeypatch.setattr(collocations, "MAP_BITS", 10)
    assert collocated(docs, min_count=5) == want


def test_collocations_of_edge_and_empty_tables(spark, edge, edge_rows, empty):
    assert collocated(edge, min_count=2, top=50) == brute_collocations([("en", t) for _, t in edge_rows], 50, 3, 2)
    assert collocated(empty) == []


# ---- spelling variants


def brute_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def varied(words):
    return sorted(tuple(r) for r in variants.spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_variants_of_documents(spark, docs):
    words = brute_words([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(tuple(r) for r in variants.count_words(docs).select("word", "n").collect()) == sorted(words.items())


def test_variants_of_similar_words(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("aé") for _ in range(rng.randrange(7, 10))) for _ in range(200)}
    words |= {"a" * n for n in range(7, 40)} | {"ab" * n for n in range(4, 12)}
    counts = {w: 11 ** rng.randrange(7) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = brute_variants(counts)
    assert sum(w[1] is not None and w[2] != w[1] for w in want) > 20
    assert varied(df) == want


@pytest.mark.parametrize("size", [7, 8, 9, 12, 25])
def test_one_edit_shares_a_signature(size):
    rng = random.Random(size)
    for _ in range(300):
        a = "".join(rng.choice("aabcdeéz") for _ in range(size))
        i, c = rng.randrange(size), rng.choice("aqé")
        for b in (a[:i] + c + a[i + 1 :], a[:i] + c + a[i:], a[:i] + a[i + 1 :]):
            if a != b:
                ours, theirs = set(variants.signatures(a)), set(variants.signatures(b))
                allowed = {(0, 0)} if len(a) == len(b) else {(1, 2)} if len(a) < len(b) else {(2, 1)}
                assert any(k == k2 and (r, r2) in allowed for k, r in ours for k2, r2 in theirs)


def test_variants_of_edge_and_empty_tables(spark, edge, edge_rows, empty):
    rows = edge_rows + [(7, "Überraschung überraschung ÜBERRASCHUNG abcdefg×h")] * 3 + [(70 + k, "spelling " * 30 + "speling spelliing") for k in range(9)]
    df = spark.createDataFrame([(d, t, "w", 1, "f") for d, t in rows], "doc_id long, text string, word string, n int, form string")
    counts = brute_words(rows)
    assert varied(variants.count_words(df)) == brute_variants(counts)
    assert varied(variants.count_words(empty)) == []


# ---- decontamination


def words_in(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute_leaks(docs, items, window):
    windows = set()
    for item, text in items:
        w = words_in(text)
        windows |= {(tuple(w[i : i + window]), item) for i in range(max(1, len(w) - window + 1)) if w}
    out = []
    for doc, text in docs:
        w, hit, found = words_in(text), set(), set()
        for run, item in windows:
            for i in range(len(w) - len(run) + 1):
                if tuple(w[i : i + len(run)]) == run:
                    hit |= set(range(i, i + len(run)))
                    found.add(item)
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def leaks(df, items, **how):
    found = decontamination.find_leaks(df, items, **how)
    sha = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    rows = found.select("doc_id", "n_words", decontamination.hit_words(), F.size("items"), sha).collect()
    return sorted((tuple(r) for r in rows), key=str)


def cases(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "b", "é", "9", "zz", "w" * 70])
    text = lambda n: "".join(word() + rng.choice([" ", ", ", "\n", "_"]) for _ in range(n))
    items = [(k, text(rng.randrange(12))) for k in range(20)] + [(3, "a b"), (None, "b b zz"), (99, None), (98, " ,."), (97, "A b"), (97, "a b"), (5, text(40))]
    docs = [(k, text(rng.randrange(80))) for k in range(40)] + [(7, None), (None, "a b"), (8, ""), (9, "a b" * 400)]
    return docs, items


@pytest.mark.parametrize("block_words", [100_000, 30])
def test_leaks_equal_brute_force(spark, block_words):
    docs, items = cases(block_words)
    df = spark.createDataFrame([(*r, "s", 1) for r in docs], "doc_id long, text string, items string, uid int").repartition(3)
    table = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, block int")
    want = brute_leaks(docs, items, 4)
    assert leaks(df, table, window=4, block_words=block_words) == want
    assert sum(w[2] > 0 for w in want) > 20


def test_pieces_of_any_size_give_the_same_hits():
    docs, items = cases(5)
    automaton = decontamination.Automaton([(str(i), decontamination.words_of((t or "").encode())) for i, t in items], 4)
    for _, text in docs:
        text = (text or "").encode()
        n, whole = decontamination.scan(automaton, text)
        for piece in (1, 2, 7, 50):
            m, hits = decontamination.scan(automaton, text, piece)
            assert (m, hits.spans, hits.states) == (n, whole.spans, whole.states)


def test_decontaminated_texts(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, f"A clean beginning of more than twelve words, as long as the item is at least. {item.upper()}! and an end"),
        (2, item), (3, "nothing here"), (4, None), (5, ""), (6, "one two three four five six seven eight nine"),
    ]
    df = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: (r.text, r.spans) for r in decontamination.decontaminate(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    want = {d: (t, "k") for d, t in rows if d != 2}
    want[1] = ("A clean beginning of more than twelve words, as long as the item is at least. ! and an end", "k")
    assert got == want


def test_leaks_of_edge_and_empty_tables(spark, edge, edge_rows, empty):
    items = [(1, "the same text stands here"), (2, "word"), (3, "TWO words"), (4, "the of word5 the of word6 the of word7 the of")]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert leaks(edge, table) == brute_leaks(edge_rows, items, 10)
    none = table.where("false")
    assert leaks(edge, none) == brute_leaks(edge_rows, [], 10)
    assert leaks(empty, table) == [] and leaks(empty, none) == []
    assert decontamination.decontaminate(edge, none).count() == edge.count()
