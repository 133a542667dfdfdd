"""Operators 1, 5, 6 and 8: token ids, counts, pieces, packing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seriesmill.llm import packing, pfor, sentencepieces, token_counts, token_output
from seriesmill.llm.wordids import word_ids

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def ids_of(library, text, end):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")


HARD = [
    "Hello, WORLD! it's <|endoftext|>x <|STARTOFTEXT|> don't I'LL", "İstanbul ΣΑΣ ς ŉ H̱ K Å ① x²  y z w \x00\x1c\x1d a\x85b",
    "日本語 テキスト ١٢٣ ½ naïve café Café é ́x", "a😀b ---!!! 3.14 100,000", "ÀÉÎõü ß ẞ ǅ ǆ ɐ ¡, ×. ñ, é.", "'S 'T o'RE ''s a's'",
    "ª º ¹ ÷ ­soft­hyphen x​z", "tail., .,a a,. a.b,",
]


def test_word_ids(library, docs):
    words = word_ids(WORDS)
    for text in HARD + [r.text for r in docs.limit(60).collect()]:
        assert np.frombuffer(b"".join(words.stream(text.encode())), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 5000])
@pytest.mark.parametrize("top", [1, 2, 1 << 9, 1 << 16, 1 << 32])
def test_packed_blocks(n, top):
    draw = np.random.default_rng(n + top)
    ids = draw.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    ids[draw.random(n) < 0.02] = top - 1
    file = pfor.Reader(pfor.encode([1, None, -5], [n, 0, 0], ids))
    assert (file.ids() == ids).all() and file.doc_ids == [1, None, -5]
    for a, b in ((0, 1), (n // 3, n // 2), (n - 1, n + 9)):
        assert (file.ids(max(a, 0), b) == ids[max(a, 0) : b]).all()


def test_packing_is_smaller():
    ids = np.random.default_rng(1).integers(100, 1000, 1 << 16).astype(np.uint32)
    ids[::50] = 49_000
    assert len(pfor.encode([1], [len(ids)], ids)) < 0.45 * ids.nbytes


@pytest.mark.parametrize("frame", ["docs", "edge"])
def test_token_output(request, library, frame):
    df = request.getfixturevalue(frame)
    got = [tuple(r) for r in token_output.token_output(df, WORDS, 1).orderBy("start").collect()]
    rows = sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [g[0] for g in got] == [d for d, _ in rows]
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    want = sorted((repr(d), len(i := ids_of(library, t, 1)), zlib.crc32(i.tobytes())) for d, t in rows)
    assert sorted((repr(g[0]), g[2], g[3]) for g in got) == want


def test_token_files_hold_whole_documents(spark, docs, tmp_path):
    files = token_output.write_ids(docs, f"file://{tmp_path}", WORDS, 1, file_ids=5000)
    assert files.count() > 4
    assert token_output.read_ids(files, f"file://{tmp_path}").count() == docs.count()


def test_first_fit_decreasing():
    draw = random.Random(2)
    for n in (0, 1, 2, 50, 700):
        lengths = [draw.randint(1, 100) for _ in range(n)]
        bins, offsets = packing.first_fit_decreasing(np.array(lengths, np.int64), 100)
        rooms, at = [], {}
        for k in sorted(range(n), key=lambda k: -lengths[k]):
            b = next((b for b, room in enumerate(rooms) if room >= lengths[k]), len(rooms))
            if b == len(rooms):
                rooms.append(100)
            at[k] = (b, 100 - rooms[b])
            rooms[b] -= lengths[k]
        assert [at[k] for k in range(n)] == list(zip(bins.tolist(), offsets.tolist()))


@pytest.mark.parametrize("frame", ["docs", "edge"])
@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(request, library, frame, capacity):
    df = request.getfixturevalue(frame)
    got = packing.pack_documents(df, WORDS, 2, capacity, group_tokens=20_000).toPandas()
    want = sorted(
        (repr(r.doc_id), s, len(part), zlib.crc32(part.tobytes()), len(ids))
        for r in df.collect()
        for ids in [ids_of(library, r.text, 2)]
        for s in range(0, len(ids), capacity)
        for part in [ids[s : s + capacity]]
    )
    ids = [None if x != x else int(x) for x in got["doc_id"].astype(object)]
    assert sorted(zip(map(repr, ids), got["start"], got["length"], got["ids_crc32"], got["doc_tokens"])) == want
    lost = 0
    for _, rows in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert rows["offset"].tolist() == [0, *rows["length"].cumsum().tolist()[:-1]]
        used = int(rows["length"].sum())
        assert used <= capacity
        lost += 0 if used & (used - 1) == 0 else capacity - used
    assert lost <= 0.2 * got["length"].sum() + capacity


def test_empty_tables(empty):
    assert token_output.token_output(empty, WORDS, 1).count() == 0
    assert packing.pack_documents(empty, WORDS, 2).count() == 0
    assert token_counts.count_tokens(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert sentencepieces.round_trip(sentencepieces.encode(empty, PIECES), PIECES).count() == 0


def test_edits_keep_counts():
    encode = token_counts.encoding(RANKS, public_tokenizers.PATTERN).encode_ordinary
    draw = random.Random(3)
    letters = "ab c d'se  \n\tÜé1 2,.!  x"
    for _ in range(400):
        text = "".join(draw.choices(letters, k=draw.randrange(200)))
        tree = token_counts.TokenTree(text, lambda t: len(encode(t)), draw.choice([1, 5, 20]))
        for _ in range(5):
            at, remove, insert = draw.randrange(-3, len(text) + 5), draw.randrange(30), "".join(draw.choices(letters, k=draw.randrange(25)))
            tree.edit(at, remove, insert)
            at = min(max(at, 0), len(text))
            text = text[:at] + insert + text[at + remove :]
            assert tree.text() == text and tree.n_tokens == len(encode(text)) == sum(tree.counts())


def test_count_query(spark, docs):
    """The registered query against encoding every edited text as a whole."""
    encode = token_counts.encoding(RANKS, public_tokenizers.PATTERN).encode_ordinary
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts.op5(spark, "/root/testdata/sf0.001").collect():
        text = texts[r.doc_id]
        size = len(text) + 1
        assert r.n_before == len(encode(text))
        for k, (remove, insert) in enumerate([(0, "new words, here"), (40, ""), (7, "don't  stop\n")], 1):
            at = zlib.crc32(f"{r.doc_id}-{k}".encode()) % size
            text = text[:at] + insert + text[at + remove :]
        assert (r.n_tokens, r.n_chars) == (len(encode(text)), len(text))
        assert r.n_encoded <= 3 * 4 * token_counts.LEAF_CHARS + 2000


def test_counts_from_kept_trees(spark, edge):
    """A tree written before is edited without encoding the rest."""
    trees = token_counts.count_tokens(edge, RANKS, public_tokenizers.PATTERN, leaf_chars=64)
    edits = spark.createDataFrame([(6, 1, 10, 3, "x y"), (6, 2, 500, 0, " new"), (99, 1, 0, 0, "a"), (None, 1, 0, 0, "a"), (2, 1, None, None, "b c")], "doc_id long, seq int, at long, remove long, insert string")
    marked = token_counts.attach_edits(trees, edits)
    got = token_counts.count_tokens(marked, RANKS, public_tokenizers.PATTERN, "edits", leaf_chars=64, tree_cols=("leaves", "counts"))
    encode = token_counts.encoding(RANKS, public_tokenizers.PATTERN).encode_ordinary
    rows = got.collect()
    assert len(rows) == edge.count()
    assert all(r.n_tokens == len(encode(r.text)) for r in rows)
    assert 0 < next(r.n_encoded for r in rows if r.doc_id == 6) < 1500
    assert next(r.text for r in rows if r.doc_id == 2) == "b c"


@pytest.mark.parametrize("chunk_chars", [3, 50, 16384])
def test_sentencepiece(spark, chunk_chars, docs, edge_rows):
    rows = [(k, r.text[:400].replace(" ", "") if k % 3 == 0 else r.text[:400]) for k, r in enumerate(docs.limit(20).collect())]
    rows += [(d, t and t[:300]) for d, t in edge_rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    encoded = sentencepieces.encode(df, PIECES, chunk_chars).persist()
    library = sentencepieces.pieces_of(PIECES).library
    got, texts = {}, {}
    for r in encoded.orderBy("uid", "chunk").collect():
        got.setdefault(r.uid, (r.doc_id, []))[1].extend(r.ids)
    assert sorted(map(repr, got.values())) == sorted(repr((d, library.encode(t or ""))) for d, t in rows)
    for r in sentencepieces.decode(encoded, PIECES).orderBy("uid", "chunk").collect():
        texts[r.uid] = texts.get(r.uid, "") + r.text
    assert sorted(texts.values()) == sorted(t or "" for _, t in rows)
    digests = sentencepieces.round_trip(encoded, PIECES).collect()
    want = sorted((repr(d), len(i := library.encode(t or "")), zlib.crc32(np.array(i, "<u4").tobytes()), True) for d, t in rows)
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32, r.round_trip) for r in digests) == want


def test_matrices_combine():
    """The states at all cuts are those of the one path, however the matrices are grouped."""
    pieces = sentencepieces.pieces_of(PIECES)
    text = "▁" + "thereafterinternationalization▁and▁more" * 3
    whole = pieces.library.encode(text[1:].replace("▁", " "))
    for size in (1, 4, 9, 30):
        cuts = range(0, len(text), size)
        held = [sentencepieces.Chunk(pieces, text, b, min(len(text), b + size)) for b in cuts]
        states = sentencepieces.states_of([c.matrix() for c in held])
        out = []
        for c, (entry, exit) in zip(held, states):
            head, tail = c.ends(entry, exit)
            out += head + c.inner() + tail
        assert out == whole


def test_joined_crc32():
    a, b = b"some bytes", bytes(range(200)) * 3
    assert sentencepieces.joined_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert sentencepieces.joined_crc32(zlib.crc32(a), 0, 0) == zlib.crc32(a)


def test_packing_keeps_large_ids_beside_null(spark):
    ids = [2**53 + 1, None, -(2**62), 2**53 + 3, 7]
    df = spark.createDataFrame([(i, f"text number {k}") for k, i in enumerate(ids)], "doc_id long, text string")
    got = packing.pack_documents(df, WORDS, 2).collect()
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(map(repr, ids))
    assert len({r.sequence_id for r in got}) == 1 and sorted(r.offset for r in got)[0] == 0
