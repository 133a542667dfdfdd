"""Operator 6: SentencePiece ids of whole texts and back, giant documents by a max-plus scan over chunks.

A segmentation is a path through the lattice of pieces. For a merge model a sequence of pieces is the encoding of
its text exactly when every two neighbours encode, joined, to themselves again; so a step between neighbours weighs 0
if they do and minus infinity if not, and the best path is the encoding. A text longer than ``chunk_chars`` is cut
at fixed places, in the middle of words too. The state at a cut is the last piece that begins before it. For each
chunk the transfer matrix says which states at its begin lead to which states at its end; since weights are 0 or
minus infinity a column is a set of bits. The matrices of a document are combined pairwise (an associative product of
max and plus), which gives the state at every cut, and every chunk finds its own pieces between its two states.

Between two places where a word begins, no piece can cross (checked when the model is read), so all paths meet
there: inside of these the library encodes, and the lattice is walked only from a cut to the next such place, or
through the whole chunk where there is none. Texts of one chunk need no matrix.

Chunks are written once; matrices of a document (a cell of Spark holds 2 GB, so at most some ten thousand, of some
hundred bytes each) meet in one group, texts never do.

Defined results: a null or empty text has no ids; U+2581 in a text is read as a space, as the library does;
repeated rows are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import batches, id_and_text

CHUNK_CHARS = 1 << 14
ROWS = 256
SPACE = "▁"
#: a character outside the vocabulary, so that nothing merges with it
GUARD = "\x01"

Token = tuple[int, int]


class Pieces:
    """The library's model, and which pieces may follow each other."""

    def __init__(self, model: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        n = self.library.get_piece_size()
        self.kind = "<u2" if n <= 1 << 16 else "<i4"
        special = [i for i in range(n) if self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)]
        self.vocabulary = {self.library.id_to_piece(i) for i in range(n)} - {self.library.id_to_piece(i) for i in special}
        if any(SPACE in p.lstrip(SPACE) for p in self.vocabulary):
            raise ValueError("a piece of this model reaches over the begin of a word")
        self.longest = max(map(len, self.vocabulary))
        self.guard = self.library.encode(GUARD)
        self.valid = functools.lru_cache(maxsize=200_000)(self._valid)
        self.follows = functools.lru_cache(maxsize=500_000)(self._follows)

    def ids(self, text: str) -> list[int]:
        """Ids of a part of a normalized text (spaces as SPACE), without the space that the library puts first."""
        return self.library.encode(GUARD + text.replace(SPACE, " "))[len(self.guard) :]

    def decode(self, ids: list[int], first: bool) -> str:
        return self.library.decode(ids) if first else self.library.decode([*self.guard, *ids])[1:]

    def _valid(self, text: str) -> bool:
        """Whether a part of a text can be one step: a piece that encodes to itself, or a character that is none."""
        return len(self.ids(text)) == 1 if text in self.vocabulary else len(text) == 1

    def _follows(self, a: str, b: str) -> bool:
        return self.ids(a + b) == self.ids(a) + self.ids(b)

    def from_place(self, text: str, s: int) -> list[Token]:
        return [(s, e) for e in range(s + 1, min(len(text), s + self.longest) + 1) if self.valid(text[s:e])]

    def states(self, text: str, cut: int) -> list[Token]:
        """Pieces that begin before a cut and end at it or after."""
        return [t for s in range(max(0, cut - self.longest), cut) for t in self.from_place(text, s) if t[1] >= cut]

    def reach(self, text: str, begin: dict[Token | None, int], at: int, stop: int) -> dict[Token, int]:
        """For every piece that begins in [at, stop): the bits of ``begin`` that lead to it.

        ``begin``: pieces that end at ``at`` or after, or None for the start of the text at ``at``.
        """
        ending: dict[int, list[tuple[Token | None, int]]] = {}
        for t, bits in begin.items():
            ending.setdefault(at if t is None else t[1], []).append((t, bits))
        found: dict[Token, int] = {}
        for s in range(at, stop):
            before = ending.pop(s, None)
            if before is None:
                continue
            for t in self.from_place(text, s):
                word, bits = text[t[0] : t[1]], 0
                for b, more in before:
                    if more & ~bits and (b is None or self.follows(text[b[0] : b[1]], word)):
                        bits |= more
                if bits:
                    found[t] = bits
                    ending.setdefault(t[1], []).append((t, bits))
        return found

    def path(self, text: str, start: Token | None, at: int, stop: int, last: Token | None) -> list[Token]:
        """The pieces that begin in [at, stop) after ``start``, up to ``last`` or else to a piece that ends at ``stop``."""
        found = self.reach(text, {start: 1}, at, stop)
        begin = at if start is None else start[1]
        if begin >= stop:
            return []
        here = last if last is not None else next(t for t in found if t[1] == stop)
        steps = []
        while here is not None and here != start:
            steps.append(here)
            if here[0] == begin and (start is None or self.follows(text[start[0] : start[1]], text[here[0] : here[1]])):
                break
            here = next(t for t in found if t[1] == here[0] and self.follows(text[t[0] : t[1]], text[here[0] : here[1]]))
        return steps[::-1]


def few(make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]):
    """``batches`` over some rows at a time: a list of ids takes many times the room of its text."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k in range(0, batch.num_rows, ROWS):
            yield from make(batch.slice(k, ROWS))

    return batches(each)


@functools.lru_cache(maxsize=2)
def pieces_of(model: str) -> Pieces:
    return Pieces(model)


def _is_begin(text: str, t: int) -> bool:
    """Whether a word begins at t: no piece crosses this place."""
    return 0 < t < len(text) and text[t] == SPACE and text[t - 1] != SPACE


class Chunk:
    """A part of a normalized text with as much around it as a piece is long."""

    def __init__(self, pieces: Pieces, text: str, begin: int, end: int):
        self.pieces, self.text, self.begin, self.end = pieces, text, begin, end
        self.entries: list[Token | None] = pieces.states(text, begin) if begin else [None]
        self.exits = pieces.states(text, end)
        self.first = 0 if begin == 0 else next((t for t in range(begin, end) if _is_begin(text, t)), -1)
        self.last = next((t for t in range(end - 1, max(self.first, begin) - 1, -1) if _is_begin(text, t) or t == 0), -1)
        self.meets = self.first >= 0 and self.last >= self.first

    def matrix(self) -> list[int]:
        """For every state at the end, the states at the begin that lead to it, as bits."""
        begin = {t: 1 << k for k, t in enumerate(self.entries)}
        if not self.meets:
            found = self.pieces.reach(self.text, begin, self.begin, self.end) | {t: b for t, b in begin.items() if t and t[1] >= self.end}
            return [found.get(t, 0) for t in self.exits]
        into = 0
        if self.begin == 0:
            into = 1
        else:
            head = self.pieces.reach(self.text, begin, self.begin, self.first) | {t: b for t, b in begin.items() if t}
            for t, bits in head.items():
                into |= bits if t[1] == self.first else 0
        tail = self.pieces.reach(self.text, {None: 1}, self.last, self.end)
        return [into if t in tail else 0 for t in self.exits]

    def inner(self) -> list[int]:
        """Ids between the first and the last begin of a word."""
        return self.pieces.ids(self.text[self.first : self.last]) if self.meets and self.last > self.first else []

    def ends(self, entry: int, exit: int) -> tuple[list[int], list[int]]:
        """Ids before and after the inner ones, between two states."""

        def ids(path: list[Token]) -> list[int]:
            return [i for s, e in path for i in self.pieces.ids(self.text[s:e])]

        start, last = self.entries[entry], self.exits[exit]
        if not self.meets:
            return ids([t for t in self.pieces.path(self.text, start, self.begin, self.end, last) if t[0] >= self.begin]), []
        head = [] if self.begin == 0 else self.pieces.path(self.text, start, self.begin, self.first, None)
        return ids(head), ids(self.pieces.path(self.text, None, self.last, self.end, last))


def combine(a: list[int], b: list[int]) -> list[int]:
    """The matrix of two neighbouring chunks: states after b by states before a."""
    out = []
    for column in b:
        bits, k = 0, 0
        while column:
            if column & 1:
                bits |= a[k]
            column >>= 1
            k += 1
        out.append(bits)
    return out


def states_of(matrices: list[list[int]]) -> list[tuple[int, int]]:
    """The states at the begin and end of every chunk of a text, from the tree of combined matrices."""
    levels = [matrices]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([combine(below[k], below[k + 1]) if k + 1 < len(below) else below[k] for k in range(0, len(below), 2)])
    final = next(k for k, bits in enumerate(levels[-1][0]) if bits & 1)
    found = [(0, final)]
    for below in levels[-2::-1]:
        split: list[tuple[int, int]] = []
        for k, (entry, exit) in enumerate(found):
            if 2 * k + 1 == len(below):
                split.append((entry, exit))
                continue
            middle = next(m for m, bits in enumerate(below[2 * k]) if bits >> entry & 1 and below[2 * k + 1][exit] >> m & 1)
            split += [(entry, middle), (middle, exit)]
        found = split
    return found


def _packed(pieces: Pieces, ids: list[int]) -> bytes:
    """Ids as little-endian numbers of as many bits as the vocabulary needs, which is how they are written and shuffled."""
    return np.array(ids, pieces.kind).tobytes()


def _listed(pieces: Pieces, column: pa.Array) -> list[list[int]]:
    """The ids of a column of packed or listed ids."""
    values = column.to_pylist()
    return [np.frombuffer(v, pieces.kind).tolist() for v in values] if pa.types.is_binary(column.type) else values


CHUNKS = (
    "uid long, doc_id long, chunk int, chunks int, text_crc32 long, text_bytes long, "
    "head string, head_begin int, head_end int, tail string, tail_begin int, tail_end int, matrix array<string>, inner binary"
)


def _row(pieces: Pieces, text: str, k: int, chunk_chars: int) -> tuple:
    """What a chunk needs later: the text around its cuts, its matrix and its inner ids."""
    begin, end = k * chunk_chars, min(len(text), (k + 1) * chunk_chars)
    low = max(0, begin - pieces.longest)
    around = text[low : end + pieces.longest]
    held = Chunk(pieces, around, begin - low, end - low)
    matrix = [format(bits, "x") for bits in held.matrix()]
    if not held.meets:
        return around, begin - low, end - low, None, None, None, matrix, b""
    head = around[: held.first + 1] if begin else around[:1]
    return head, begin - low, held.first, around[held.last :], 0, end - low - held.last, matrix, _packed(pieces, held.inner())


def chunks(df: DataFrame, model: str, chunk_chars: int = CHUNK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    names = [c.strip().split(" ")[0] for c in CHUNKS.split(",")]
    text32 = pa.list_(pa.string())
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), text32, pa.binary()]

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        rows: list[tuple] = []
        for uid, doc, text in zip(*(batch.column(c).to_pylist() for c in ("uid", "doc_id", "text"))):
            text = text or ""
            if len(text) <= chunk_chars:
                raw = text.encode()
                rows.append((uid, doc, 0, 1, zlib.crc32(raw), len(raw), None, None, None, None, None, None, [], _packed(pieces, pieces.library.encode(text))))
                continue
            normalized = SPACE + text.replace(" ", SPACE)
            n = -(-len(normalized) // chunk_chars)
            for k in range(n):
                raw = text[max(0, k * chunk_chars - 1) : (k + 1) * chunk_chars - 1].encode()
                rows.append((uid, doc, k, n, zlib.crc32(raw), len(raw), *_row(pieces, normalized, k, chunk_chars)))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    docs = id_and_text(df, id_col, text_col).withColumn("uid", F.monotonically_increasing_id())
    return docs.mapInArrow(few(each), CHUNKS)


def _by_document(rows: DataFrame, *columns: str) -> DataFrame:
    """uid and the chunks of a document in order, as one list."""
    return rows.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("listed"))


def encode(
    df: DataFrame, model: str, chunk_chars: int = CHUNK_CHARS, id_col: str = "doc_id", text_col: str = "text", packed: bool = False,
) -> DataFrame:
    """uid (a document), doc_id, chunk, chunks, ids, text_crc32 and text_bytes (of the chunk's text).

    ``ids`` is a list, or with ``packed`` the bytes of little-endian numbers (``Pieces.kind``).
    """
    found = materialize(chunks(df, model, chunk_chars, id_col, text_col), "chunks")

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for uid, listed in zip(batch.column("uid").to_pylist(), batch.column("listed").to_pylist()):
            states = states_of([[int(x, 16) for x in c["matrix"]] for c in listed])
            rows += [(uid, c["chunk"], entry, exit) for c, (entry, exit) in zip(listed, states)]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["uid", "chunk", "entry", "exit"])

    several = found.where("chunks > 1")
    states = _by_document(several, "chunk", "matrix").mapInArrow(few(scan), "uid long, chunk int, entry int, exit int")

    def finish(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces, ids = pieces_of(model), []
        for r in batch.to_pylist():
            ids.append(_packed(pieces, _ids(pieces, r)))
        kept = ["uid", "doc_id", "chunk", "chunks", "text_crc32", "text_bytes"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(ids, pa.binary())], names=[*kept, "ids"])

    ended = several.join(states, ["uid", "chunk"]).mapInArrow(
        few(finish), "uid long, doc_id long, chunk int, chunks int, text_crc32 long, text_bytes long, ids binary"
    )
    columns = ["uid", "doc_id", "chunk", "chunks", "ids", "text_crc32", "text_bytes"]
    whole = found.where("chunks = 1").withColumn("ids", F.col("inner"))
    every = whole.select(columns).unionByName(ended.select(columns))

    def unpack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        ids = pa.array(_listed(pieces, batch.column("ids")), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([ids if c == "ids" else batch.column(c) for c in columns], names=columns)

    return every if packed else every.mapInArrow(
        few(unpack), "uid long, doc_id long, chunk int, chunks int, ids array<int>, text_crc32 long, text_bytes long"
    )


def _ids(pieces: Pieces, r: dict) -> list[int]:
    """All ids of a chunk, from what was kept of it and its two states."""

    def of(text: str, path: list[Token]) -> list[int]:
        return [i for s, e in path for i in pieces.ids(text[s:e])]

    begin, end = r["head_begin"], r["head_end"]
    start = pieces.states(r["head"], begin)[r["entry"]] if begin else None
    if r["tail"] is None:
        last = pieces.states(r["head"], end)[r["exit"]]
        return of(r["head"], [t for t in pieces.path(r["head"], start, begin, end, last) if t[0] >= begin])
    head = of(r["head"], pieces.path(r["head"], start, begin, end, None)) if begin else []
    last = pieces.states(r["tail"], r["tail_end"])[r["exit"]]
    return head + np.frombuffer(r["inner"], pieces.kind).tolist() + of(r["tail"], pieces.path(r["tail"], None, 0, r["tail_end"], last))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """uid, doc_id, chunk and text of what ``encode`` has returned."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        texts = [pieces.decode(i, k == 0) for i, k in zip(_listed(pieces, batch.column("ids")), batch.column("chunk").to_pylist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("uid", "doc_id", "chunk")), pa.array(texts)], names=["uid", "doc_id", "chunk", "text"])

    return encoded.mapInArrow(few(each), "uid long, doc_id long, chunk int, text string")


def _times(matrix: list[int], vector: int) -> int:
    out, k = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[k]
        vector >>= 1
        k += 1
    return out


@functools.lru_cache(maxsize=64)
def _zero_bytes(k: int) -> list[int]:
    """What 2**k zero bytes do to a checksum, as a matrix over bits."""
    if k:
        half = _zero_bytes(k - 1)
        return [_times(half, row) for row in half]
    step = [0xEDB88320, *(1 << b for b in range(31))]  # one zero bit
    for _ in range(3):
        step = [_times(step, row) for row in step]
    return step


def joined_crc32(a: int, b: int, b_bytes: int) -> int:
    """The checksum of two byte strings, one after the other, from theirs."""
    for k in range(b_bytes.bit_length()):
        if b_bytes >> k & 1:
            a = _times(_zero_bytes(k), a)
    return a ^ b


DIGEST = "uid long, doc_id long, chunk int, n_tokens long, ids_crc32 long, text_crc32 long, text_bytes long, back_crc32 long, back_bytes long"


def round_trip(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian unsigned 32-bit ids) and whether decoding gives the text again."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces, rows = pieces_of(model), []
        for ids, k in zip(_listed(pieces, batch.column("ids")), batch.column("chunk").to_pylist()):
            back = pieces.decode(ids, k == 0).encode()
            rows.append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), zlib.crc32(back), len(back)))
        n, crc, back, size = ([r[k] for r in rows] for k in range(4))
        kept = ["uid", "doc_id", "chunk", "text_crc32", "text_bytes"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), *(pa.array(c, pa.int64()) for c in (n, crc, back, size))],
            names=[*kept, "n_tokens", "ids_crc32", "back_crc32", "back_bytes"],
        ).select(["uid", "doc_id", "chunk", "n_tokens", "ids_crc32", "text_crc32", "text_bytes", "back_crc32", "back_bytes"])

    def join(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for listed in batch.column("listed").to_pylist():
            total, sizes = [0, 0, 0], [0, 0, 0]
            for c in listed:
                parts = (c["ids_crc32"], 4 * c["n_tokens"]), (c["text_crc32"], c["text_bytes"]), (c["back_crc32"], c["back_bytes"])
                for k, (crc, size) in enumerate(parts):
                    total[k], sizes[k] = joined_crc32(total[k], crc, size), sizes[k] + size
            rows.append((listed[0]["doc_id"], sizes[0] // 4, total[0], total[1:2] + sizes[1:2] == total[2:] + sizes[2:]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    # documents of one chunk go the same way: two branches would each run what stands before
    digests = encoded.select("uid", "doc_id", "chunk", "text_crc32", "text_bytes", "ids").mapInArrow(few(each), DIGEST)
    columns = ["chunk", "doc_id", "n_tokens", "ids_crc32", "text_crc32", "text_bytes", "back_crc32", "back_bytes"]
    return _by_document(digests, *columns).mapInArrow(few(join), "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import documents

    model = public_tokenizers.path("piece_bpe_32k.model")
    return round_trip(encode(documents(spark, sf_dir), model, packed=True), model)
