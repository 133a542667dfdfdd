"""Operators 2, 3, 4, 7, 9 and 10 against brute force, and the pipeline."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from seriesmill.llm import ann, components, language, licenses, quality, repeats, simhash

LETTERS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# -- 2


def base_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    found = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
    places = [k for k, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


@pytest.mark.parametrize("piece_bytes", [7, 1 << 20])
def test_license_scan(docs, edge_rows, piece_bytes):
    scanner = licenses._scanner(tuple(licenses.TEMPLATES.items()), tuple(licenses.PHRASES.items()), 3, 0.6)
    for text in [r.text for r in docs.collect()] + [t for _, t in edge_rows]:
        n, phrases, _ = scanner.scan((text or "").encode(), piece_bytes)
        places = [k for k, _ in phrases]
        got = n, len(phrases), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in phrases}))
        assert got == base_licenses(text)


def test_license_query(spark):
    for r in licenses.op2(spark, "/root/testdata/sf0.001").collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_license_spans():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES, 3, 0.6)
    text = "foo bar " + licenses.TEMPLATES["mit"].replace("free of charge", "for free") + " and " + licenses.TEMPLATES["bsd"]
    spans = scanner.scan(text.encode())[2]
    assert [s[0] for s in spans] == ["mit", "bsd"] and spans[0][1] == 2 and spans[1][3] == 1.0
    assert scanner.scan(b"permission is hereby granted to walk")[2] == []


def test_matching_statistics():
    """The automaton's longest run at every word, against all runs of all templates."""
    draw = random.Random(4)
    templates = [[draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randrange(1, 14))] for _ in range(4)]
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    held = licenses.Automaton(templates)
    text = [draw.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)]
    state = length = 0
    for k, word in enumerate(text):
        state, length = held.step(state, length, word)
        assert length == max((n for n in range(1, k + 2) if tuple(text[k + 1 - n : k + 1]) in runs), default=0)
        for t, places in held.ends[state].items():
            assert all(templates[t][p + 1 - length : p + 1] == text[k + 1 - length : k + 1] for p in places)


def test_license_inside_a_longer_run():
    """Templates that stand whole at the start, in the middle and at the end of another one."""
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES, 3, 0.6)
    text = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    assert scanner.scan(text.encode())[2] == [("apache-2.0-short", 0, 8, 1.0)]
    text = "it under the terms of the GNU General Public License as published by the Free Software Foundation"
    assert scanner.scan(text.encode())[2] == [("gpl-short", 1, 10, 1.0)]
    templates = {"whole": "a b c d e f g h i j k l", "first": "a b c d", "middle": "e f g h", "last": "i j k l"}
    scanner = licenses.Scanner(templates, {"a b": "x"}, 3, 0.6)
    want = [("first", 2, 6, 1.0), ("last", 10, 14, 1.0), ("middle", 6, 10, 1.0), ("whole", 2, 14, 1.0)]
    assert sorted(scanner.scan(f"o o {templates['whole']} o".encode())[2]) == want
    assert sorted(scanner.scan(f"o o {templates['whole']}".encode())[2]) == want


def test_license_runs_per_template():
    """Runs that cannot be extended, against all runs of each template."""
    draw = random.Random(5)
    for _ in range(60):
        templates = [[draw.choice("abc") for _ in range(draw.randrange(1, 14))] for _ in range(4)]
        templates += [templates[0][2:8] or ["a"], templates[1][:5], templates[2][-5:]]
        scanner = licenses.Scanner({str(t): " ".join(x) for t, x in enumerate(templates)}, {}, 2, 0.6)
        text = [draw.choice("abcd") for _ in range(30)] + templates[0] + templates[1]
        got = {}
        for t in range(len(templates)):
            got[t] = []
        scanner._matches([w.encode() for w in text], 7, got)
        for t, words in enumerate(templates):

            def longest(k):
                """Of the runs that end before word k."""
                sizes = [n for n in range(1, k + 1) if any(words[p : p + n] == text[k - n : k] for p in range(len(words) - n + 1))]
                return max(sizes, default=0) if k <= len(text) else 0

            want = []
            for k in range(1, len(text) + 1):
                n = longest(k)
                if n >= 2 and longest(k + 1) <= n:
                    want += [(7 + k - n, p, n) for p in range(len(words) - n + 1) if words[p : p + n] == text[k - n : k]]
            assert sorted(got[t]) == sorted(want)


# -- 3


def fingerprint(text):
    words = LETTERS.findall(lower(text))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(values, linked):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("frame", ["docs", "edge"])
def test_simhash(request, frame):
    df = request.getfixturevalue(frame)
    rows = [(r.doc_id, fingerprint(r.text)) for r in df.collect()]
    group = groups_of([f for _, f in rows], lambda a, b: (a ^ b).bit_count() <= 2)
    least = {g: min((d for (d, _), x in zip(rows, group) if x == g and d is not None), default=None) for g in group}
    want = sorted(repr((d, f"{f:016x}", least[g])) for (d, f), g in zip(rows, group))
    assert sorted(repr(tuple(r)) for r in simhash.near_duplicates(df).collect()) == want


def test_fingerprint_of_pieces():
    text = " ".join(f"w{k % 13}" for k in range(200)).encode()
    assert simhash.fingerprint(text, 3, 5) == simhash.fingerprint(text) == fingerprint(text.decode())


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4])
@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_links_keep_components(spark, max_bits, hot):
    draw = random.Random(max_bits)
    values = []
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(12):
            base ^= sum(1 << draw.randrange(64) for _ in range(draw.randrange(4)))
            base &= (1 << 64) - 1
            values.append(base)
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), max_bits, hot)
    got = {r.node: r.component for r in components.components(found).collect()} if max_bits else {}
    group = groups_of(values, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= max_bits)
    assert {v: got.get(v, v) for v in values} == {v: values[g] for v, g in zip(values, group)}


def test_segment_tables_miss_no_pair(spark):
    """Every distance a pair can have within the limit, split over the two segments in every way."""
    base = 0x0123456789ABCDEF
    values = {base}
    for low in range(5):
        for high in range(5 - low):
            values.add(base ^ (((1 << low) - 1) << 7) ^ (((1 << high) - 1) << 40))
    nodes = spark.createDataFrame([(v,) for v in sorted(values)], "fp long")
    for max_bits in range(5):
        got = {(r.u, r.v) for r in simhash.links(nodes, max_bits).collect()}
        assert got == {(u, v) for u in values for v in values if u != v and (u ^ v).bit_count() <= max_bits}


def test_components_of_a_chain(spark):
    links = spark.range(1, 400).selectExpr("id AS u", "id - 1 AS v").unionByName(spark.range(1000, 1010).selectExpr("id AS u", "1000L AS v"))
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {k: 0 for k in range(400)} | {k: 1000 for k in range(1000, 1010)}


# -- 4


def test_language_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = language.op4(spark, "/root/testdata/sf0.01").join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_edges(spark, docs, edge, empty):
    model = language.fit(language.training_rows(docs, F.lit(True)))
    got = {(r.doc_id, r.lang_pred) for r in language.identify(edge, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (11, "und")} <= got and len(got) >= 14
    assert language.fit(language.training_rows(empty, F.lit(True))) is None
    assert {r.lang_pred for r in language.identify(edge, None).collect()} == {"und"}
    one = language.fit(language.training_rows(edge.where("doc_id = 8"), F.lit(True)))
    assert {r.lang_pred for r in language.identify(edge, one).collect()} == {"und", "en"}


@pytest.mark.parametrize("n", [2, 3, 7, 8, 20])
def test_codewords_are_apart(n):
    code = language.codewords(n)
    apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
    assert apart >= (2 ** (n - 2) if n <= 7 else 15)


def test_language_of_pieces(monkeypatch):
    """A long text in pieces has the n-grams of the whole."""
    text = ("straße und Häuser, 12 " * 40).encode()
    whole = Counter(np.concatenate(list(language.ngram_pieces(text))).tolist())
    monkeypatch.setattr(language, "PIECE_BYTES", 17)
    assert Counter(np.concatenate(list(language.ngram_pieces(text))).tolist()) == whole


@pytest.mark.parametrize("size", [0, 1, 2, 3, *range(2 * 17 - 5, 2 * 17 + 6), *range(3 * 17 - 5, 3 * 17 + 6)])
def test_language_of_pieces_of_any_length(monkeypatch, size):
    """Texts that end at, just before or just after the end of a piece."""
    text = ("straße und Häuser, 12 " * 4).encode()[:size]
    whole = [Counter(x.tolist()) for x in language.ngram_pieces(text)]
    monkeypatch.setattr(language, "PIECE_BYTES", 17)
    assert sum((Counter(x.tolist()) for x in language.ngram_pieces(text)), Counter()) == sum(whole, Counter())


# -- 7


def without_repeats(rows, length=50):
    first = {}
    for d, t in rows:
        for k in range(len(t) - length + 1) if d is not None else ():
            s = t[k : k + length]
            first[s] = min(d, first.get(s, d))
    out = []
    for d, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1) if d is not None else ():
            if first[t[k : k + length]] < d:
                gone[k : k + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append(repr((d, len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest())))
    return sorted(out)


def repeat_rows():
    draw = random.Random(3)
    passage = "".join(draw.choices("abcdefghij ", k=400))
    rows = []
    for d in range(90):
        text = "".join(draw.choices("abcdefghij ", k=draw.randrange(300)))
        for _ in range(draw.randrange(3)):
            k = draw.randrange(330)
            text += passage[k : k + draw.randrange(40, 70)] + "".join(draw.choices("abcdefghij ", k=draw.randrange(60)))
        rows.append((d, text))
    return rows + [
        (200, "a" * 500), (201, "a" * 300), (202, "ab" * 100), (203, "ba" * 60), (204, passage), (205, passage), (205, passage + "x"),
        (None, passage), (206, None), (207, ""), (208, "ü" * 80), (209, "xü" + "ü" * 60), (-5, passage),
    ]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 3000, "bucket_bytes": 2000}, {"shard_bytes": 2000, "bucket_bytes": 9000, "hot": 4}, {"length": 64}])
def test_repeats(spark, options, monkeypatch):
    monkeypatch.setattr(repeats, "EARLIER_RECORDS", 500)
    rows = repeat_rows()
    found = repeats.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **options)
    got = []
    for r in found.collect():
        removed = sum(s["after"] - s["first"] for s in r.spans)
        got.append(repr((r.doc_id, r.n_bytes, removed, len(r.spans), hashlib.sha256(r.kept).hexdigest())))
    assert sorted(got) == without_repeats([(d, (t or "").encode()) for d, t in rows], options.get("length", 50))


def test_strings_that_share_a_name():
    """The way without names gives what the way with names gives."""
    draw = np.random.default_rng(6)
    rows = np.zeros((300, 78), np.uint8)
    rows[:, :76] = np.tile(draw.integers(0, 2, (20, 76)), (15, 1))
    rows[:, 30] = draw.integers(0, 3, 300)
    rows[:, 76:] = draw.integers(0, 27, (300, 2))
    docs = draw.integers(0, 50, 300)
    assert (repeats._earlier(rows, docs, 50) == repeats._earlier_by_bytes(rows, docs, 50)).all()


def test_repeats_query(spark, docs):
    rows = [(r.doc_id, r.text.encode()) for r in docs.collect()]
    got = repeats.op7(spark, "/root/testdata/sf0.001").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(repr(tuple(r)) for r in got) == without_repeats(rows)


# -- 9


def chained(x, *more):
    h = xxhash.xxh64_intdigest(x, 42)
    for y in more:
        h = xxhash.xxh64_intdigest(struct.pack("<Q", y), h)
    return h


def pair(a, b, *rest):
    return chained(struct.pack("<Q", a), b, *rest)


def quality_by_hand(rows, trusted, threshold=quality.THRESHOLD):
    buckets = quality.BUCKETS
    signed = lambda h: (h - (1 << 64) if h >> 63 else h) % buckets
    grams = {}
    for k, (d, t) in enumerate(rows):
        h = [chained(w.encode()) for w in LETTERS.findall(t or "")]
        grams[k] = [signed(x) for x in h] + [signed(pair(a, b)) for a, b in zip(h, h[1:])]
    raw, good = Counter(), Counter()
    for k, (d, _) in enumerate(rows):
        raw.update(grams[k])
        if d in trusted:
            good.update(grams[k])
    scale = sum(raw.values()) / sum(good.values()) if good else None
    weight = {b: round(math.log((good[b] * scale + quality.PRIOR) / (n + quality.PRIOR)) * 1e6) if scale else 0 for b, n in raw.items()}
    out = []
    for k, (d, t) in enumerate(rows):
        text = t or ""
        words = LETTERS.findall(text)
        lines = [x for x in text.split("\n") if LETTERS.search(x)]
        windows = list(zip(words, words[1:], words[2:]))
        seen = Counter(windows)
        covered = {i + j for i, g in enumerate(windows) if seen[g] > 1 for j in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        score = sum(weight[b] for b in grams[k]) / len(grams[k]) / 1e6 if grams[k] else 0.0
        numbers = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
        out.append((repr(d), *numbers, failed, not failed and score >= threshold, round(score, 5)))
    return sorted(out)


@pytest.mark.parametrize("frame", ["docs", "edge"])
def test_quality(request, labels, frame):
    df = request.getfixturevalue(frame)
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0}
    got = [(repr(r.doc_id), *list(r)[1:8], round(r.score, 5)) for r in quality.quality_rules(df, labels).collect()]
    assert sorted(got) == quality_by_hand([(r.doc_id, r.text) for r in df.collect()], trusted)


def test_quality_without_labels(docs, labels, empty):
    rows = quality.quality_rules(docs, labels.where("false")).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in rows)
    assert quality.quality_rules(empty, labels).count() == 0


def test_quality_runs_no_python(docs, labels, capsys):
    quality.quality_rules(docs, labels).explain("formatted")
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_bounded_weights(spark, docs, labels, edge):
    """Against counts of different texts by hand; no weight below the bound."""
    frame = docs.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    trusted = labels.where("quality = 1 AND toxic = 0").select("doc_id").distinct()
    got = quality.weights(quality.ngram_counts(frame, trusted, once=True), prior=30, smoothing=0.1).first()[0]
    good = {r.doc_id for r in trusted.collect()}
    texts = {}
    for r in frame.collect():
        texts[r.text or ""] = texts.get(r.text or "", False) or r.doc_id in good
    raw, of_good = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for text, is_good in texts.items():
        h = [chained(w.encode()) for w in LETTERS.findall(text)]
        for x in h + [pair(a, b) for a, b in zip(h, h[1:])]:
            raw[x % quality.BUCKETS] += 1  # the number of buckets divides 2^64
            of_good[x % quality.BUCKETS] += is_good
    both = 30 + raw.sum() / quality.BUCKETS
    want = np.log((of_good * (raw.sum() / of_good.sum()) + 0.1 * raw + both) / (1.1 * raw + both))
    assert np.abs(np.array(got) - want * 1e6).max() <= 1
    assert min(got) >= math.log(0.1 / 1.1) * 1e6


def test_copies_change_no_verdict(spark, docs, labels):
    """Neither 1000 times one clean document without a label, also one of words that no other has, nor 1000 times all."""
    sf_dir = "/root/testdata/sf0.001"

    def kept(df):
        return {r.doc_id for r in corpus_pipeline.check_quality(spark, df, sf_dir).select("doc_id").collect()}

    new = [(9_000, " ".join(f"new{k}" for k in range(200)))]
    few = docs.select("doc_id", "text").unionByName(spark.createDataFrame(new, "doc_id long, text string"))
    copy_ids = "CASE WHEN k = 0 THEN doc_id ELSE doc_id + 10000 * k END AS doc_id"
    before = kept(few)
    assert 9_000 in before
    assert 0 < few.join(labels.where("quality = 0"), "doc_id", "left_semi").where(~F.col("doc_id").isin(*before)).count()
    unlabelled = few.join(labels, "doc_id", "left_anti").where(F.col("doc_id").isin(*before) & (F.length("text") < 2000))
    for doc in [9_000, *[r.doc_id for r in unlabelled.orderBy("doc_id").limit(2).collect()]]:
        many = few.crossJoin(spark.range(1000).withColumnRenamed("id", "k")).where((F.col("k") == 0) | (F.col("doc_id") == doc))
        got = kept(many.selectExpr(copy_ids, "text"))
        assert {d for d in got if d < 10_000} == before and {d % 10_000 for d in got} == before and len(got) == len(before) + 999
    short = few.where(F.length("text") < 1200)
    before = kept(short)
    got = kept(short.crossJoin(spark.range(1000).withColumnRenamed("id", "k")).selectExpr(copy_ids, "text"))
    assert len(got) == 1000 * len(before) and {d % 10_000 for d in got} == before


# -- 10


def test_neighbours(spark):
    draw = np.random.default_rng(8)
    vectors = draw.normal(size=(2500, 16)).astype(np.float32)
    vectors[100:130] = vectors[100]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    odd = [(3001, None), (3002, [0.0] * 16), (3003, [None] + [1.0] * 15), (3004, [math.inf] + [1.0] * 15), (3005, [math.nan] * 16), (3006, [1.0, 2.0]), (None, [1.0] * 16), (5, rows[5][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    asked = df.where("vec_id % 50 = 0 OR vec_id BETWEEN 100 AND 105").selectExpr("vec_id AS query_id", "cast(embedding AS array<double>) AS vector")
    got = ann.search(ann.build_index(df, shard_rows=900), asked).toPandas()
    right = total = 0
    exact = vectors.astype(np.float64)
    for query, found in got.sort_values("rank").groupby("query_id"):
        away = np.sqrt(((exact - exact[query]) ** 2).sum(axis=1))
        away[query] = np.inf
        want = np.lexsort((np.arange(len(away)), away))[:10]
        assert found["rank"].tolist() == list(range(1, 11))
        assert np.allclose(found["score"], away[found["vec_id"]], rtol=1e-12)
        assert found["score"].is_monotonic_increasing
        right += len(set(want) & set(found["vec_id"]))
        total += 10
    assert total == 10 * asked.count() and right >= 0.95 * total
    assert got[got["query_id"] == 103].sort_values("rank")["vec_id"].tolist() == [100, 101, 102, 104, 105, 106, 107, 108, 109, 110]


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [3.0, 4.0])], "vec_id long, embedding array<float>")
    asked = df.selectExpr("vec_id AS query_id", "cast(embedding AS array<double>) AS vector").where("query_id = 0")
    assert [(r.rank, r.vec_id) for r in ann.search(ann.build_index(df), asked).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.search(ann.build_index(df.where("false")), asked.where("false")).count() == 0


# -- pipeline


def test_pipeline(spark, docs):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    ids = {r.doc_id for r in out}
    assert 0 < len(ids) < docs.count()


def test_stages_on_edges(spark, edge, docs, empty, labels):
    """Stages keep the columns, take every edge case, and do what their operators say."""
    sf_dir = "/root/testdata/sf0.001"
    for df in (edge, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, sf_dir)
            assert out.columns == df.columns and out.schema.simpleString() == df.schema.simpleString()
            assert out.count() <= df.count()
    near = corpus_pipeline.drop_near_duplicates(spark, edge, sf_dir)
    want = simhash.near_duplicates(edge).select("component_id").distinct().count()
    assert near.count() >= want - 1 and near.where("doc_id = 4").count() <= 1
    cut = corpus_pipeline.cut_repeats(spark, edge, sf_dir)
    assert {r.doc_id: r.text for r in cut.collect()}[-3].startswith("The same text")
    assert cut.where("doc_id IN (4, 5)").count() == 0
    twice = docs.unionByName(docs)
    assert corpus_pipeline.drop_near_duplicates(spark, twice, sf_dir).count() == corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).count()


def test_near_duplicates_keep_one_row_of_each_group(spark, edge):
    kept = simhash.one_of_each_group(edge)
    assert kept.columns == edge.columns
    found = simhash.near_duplicates(edge).groupBy("component_id").count().count()
    assert kept.count() == found


def test_pipeline_stages_on_edge_and_empty_tables(spark, tmp_path, edge_rows):
    rows = [(d, t, "en" if (d or 0) % 2 else None, "s", 1, "x") for d, t in edge_rows + [(20 + k, "the words of this text are clear and many " * 9) for k in range(5)]]
    fields = "doc_id long, text string, lang string, source string, n_chars long, row_ string"
    for name, part in (("edge", rows), ("empty", [])):
        spark.createDataFrame(part, fields).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(21, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, f"{tmp_path}/{name}")
            assert out.columns == docs.columns
            assert out.count() <= len(part)
        packed = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r.doc_id for r in packed} <= {r[0] for r in part}
