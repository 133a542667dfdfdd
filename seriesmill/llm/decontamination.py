"""Operator 13: benchmark decontamination with a generalised suffix automaton of the test items.

The words of all items (A-Z lower-cased, all other ASCII but digits and letters separating) make one automaton that accepts
every run of words of any item. Documents are streamed through it; after each word it gives the longest run that ends
there and stands in an item. Where that is ``window`` words or more, the last ``window`` words are hit; an item with fewer
words is hit only whole, at the state of its end. States know the items they stand in, so the items of a document
come from the states it passes.

Documents are scanned where they are read, without a shuffle. Words that no item has end a run; runs too short to hold a window
are left out before the automaton sees them. Texts are read a megabyte at a time; what is carried is the automaton's
state and place, so a text of any length needs the memory of a piece and of its spans.

Items are dealt to blocks of at most ``BLOCK_WORDS`` words, each item word held in at most ``WORD_BYTES`` bytes (a longer
one by its SHA-256), so what is sent to the workers is bounded; a longer item is cut into slices that share ``window`` - 1
words. Small blocks are taken together. A benchmark of more than one block is a pass over the documents for each, and the
passes are merged per row.

Defined results: a null or empty text has no words and is clean; a null or empty item has no windows; items with one text are all
found; an item without an id marks words but is not listed; repeated rows are scanned each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import batches, documents, id_and_text, q, restored, schema_of, texts_of

WINDOW = 10
BLOCK_WORDS = 100_000
WORD_BYTES = 64
PIECE_BYTES = 1 << 20
#: A-Z lower-cased, other ASCII but digits and letters turned into spaces
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    words = text.translate(TABLE).split()
    if len(text) > WORD_BYTES and max(map(len, words), default=0) > WORD_BYTES:
        words = [w if len(w) <= WORD_BYTES else hashlib.sha256(w).digest() for w in words]
    return words


class Automaton:
    """Generalised suffix automaton of items, with the items at the states of windows and at the ends of short items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._add(last, word)
        self.least = min((min(window, len(words)) for _, words in items if words), default=window)
        self.items: dict[int, set[str | None]] = {}
        self.whole: dict[int, int] = {}  # state: length of the short item that ends there
        for item, words in items:
            self._mark(item, words)
        self._short: dict[int, int] = {}
        self._window: dict[int, int] = {}

    def _state(self, size: int, link: int, arcs: dict[bytes, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _clone(self, p: int, word: bytes, q: int) -> int:
        """The state of the runs of ``p`` and ``word``: ``q`` itself, or split off from it where it also holds longer ones."""
        if self.size[q] == self.size[p] + 1:
            return q
        clone = self._state(self.size[p] + 1, self.link[q], self.next[q].copy())
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _add(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:  # an earlier item begins alike
            return self._clone(last, word, known)
        new, p = self._state(self.size[last] + 1, 0, {}), last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p != -1:
            self.link[new] = self._clone(p, word, self.next[p][word])
        return new

    def _mark(self, item: str | None, words: list[bytes]) -> None:
        state = 0
        for k, word in enumerate(words):
            state = self.next[state][word]
            if k + 1 >= self.window:
                while self.size[self.link[state]] >= self.window:
                    state = self.link[state]
                self.items.setdefault(state, set()).add(item)
        if 0 < len(words) < self.window:
            self.whole[state] = len(words)
            self.items.setdefault(state, set()).add(item)

    def window_state(self, state: int) -> int:
        """The state that holds the last ``window`` words of a state's runs."""
        found = self._window.get(state)
        if found is None:
            found = state
            while self.size[self.link[found]] >= self.window:
                found = self.link[found]
            self._window[state] = found
        return found

    def short_state(self, state: int) -> int:
        """The nearest state on the way of links, this one included, at which a short item ends; -1 where none is."""
        found = self._short.get(state)
        if found is None:
            found = state
            while found > 0 and found not in self.whole:
                found = self.link[found]
            found = found if found > 0 else -1
            self._short[state] = found
        return found

    def items_at(self, states: set[int]) -> set[str]:
        """The items whose windows end at these states, shorter ones within longer ones included."""
        found: set[str | None] = set()
        for state in states:
            while state > 0:
                if state in self.items and (state in self.whole or self.size[state] >= self.window):
                    found |= self.items[state]
                state = self.short_state(self.link[state])
        return {i for i in found if i is not None}


class Hits:
    """What a text's words have hit so far."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, int]] = []  # first word, word after; apart from each other
        self.states: set[int] = set()

    def add(self, first: int, after: int) -> None:
        while self.spans and self.spans[-1][1] >= first:
            first = min(first, self.spans.pop()[0])
        self.spans.append((first, after))


def _run(automaton: Automaton, words: list[bytes], at: int, state: int, length: int, hits: Hits) -> tuple[int, int]:
    """Stream words that items have, the first at place ``at``, from a state with its matched length."""
    arcs, link, size, window, short = automaton.next, automaton.link, automaton.size, automaton.window, bool(automaton.whole)
    for place, word in enumerate(words, at + 1):
        to = arcs[state].get(word)
        while to is None:
            state = link[state]
            length = size[state]
            to = arcs[state].get(word)
        state, length = to, length + 1
        if length >= window:
            hits.states.add(automaton.window_state(state))
            hits.add(place - window, place)
        elif short:
            end = automaton.short_state(state)
            if end == state and automaton.whole[end] > length:  # only the end of that item has been read
                end = automaton.short_state(link[state])
            if end > 0:
                hits.states.add(end)
                hits.add(place - automaton.whole[end], place)
    return state, length


def scan(automaton: Automaton, text: bytes, piece_bytes: int = PIECE_BYTES) -> tuple[int, Hits]:
    """Number of words, and the hits."""
    hits, known = Hits(), automaton.next[0].__contains__
    n = begin = 0
    state = length = 0
    while begin < len(text):
        end = min(len(text), begin + piece_bytes)
        while end < len(text) and TABLE[text[end]] != 0x20:
            end += 1
        words = words_of(text if end - begin == len(text) else text[begin:end])
        flags = np.zeros(len(words) + 2, np.int8)
        flags[1:-1] = np.fromiter(map(known, words), np.int8, len(words))
        edges = np.flatnonzero(np.diff(flags))
        firsts, afters = edges[::2], edges[1::2]
        # a run at a border of the piece may be part of a longer one
        wanted = (afters - firsts >= automaton.least) | (firsts == 0) | (afters == len(words))
        carried = (0, 0)
        for first, after in zip(firsts[wanted].tolist(), afters[wanted].tolist()):
            state, length = _run(automaton, words[first:after], n + first, *((state, length) if first == 0 else (0, 0)), hits)
            carried = (state, length) if after == len(words) else (0, 0)
        if words:
            state, length = carried
        n += len(words)
        begin = end
    return n, hits


def without_spans(text: bytes, spans: list[tuple[int, int]], least: int) -> bytes:
    """The text without its spans of ``least`` words or more."""
    spans = [s for s in spans if s[1] - s[0] >= least]
    if not spans:
        return text
    kept, at, left = [], 0, iter(spans)
    first, after = next(left)
    for k, word in enumerate(WORD.finditer(text)):
        if k == first:
            kept.append(text[at : word.start()])
        if k == after - 1:
            at = word.end()
            first, after = next(left, (-1, -1))
            if first < 0:
                break
    return b"".join(kept) + text[at:]


_built: dict[str, Automaton] = {}  # of a worker, by block: the last one only


def _automaton(block: str, window: int, held: Broadcast) -> Automaton:
    if block not in _built:
        _built.clear()
        _built[block] = Automaton(held.value, window)
    return _built[block]


def item_blocks(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """block, item, words: slices of items, in blocks of at most ``block_words`` words and a slice."""

    def each(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held = 0
        for batch in stream:
            for item, text in zip(batch.column("item").to_pylist(), texts_of(batch)):
                words = words_of(text)
                for at in range(0, max(1, len(words) - window + 1), block_words):
                    part = words[at : at + block_words + window - 1]
                    if part:
                        if held and held + len(part) > block_words:
                            block, held = block + 1, 0
                        held += len(part)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([block], pa.int64()), pa.array([item], pa.string()), pa.array([part], pa.list_(pa.binary()))],
                            names=["block", "item", "words"],
                        )

    items = items.select(q(id_col).cast("string").alias("item"), q(text_col).cast("string").alias("text"))
    sliced = items.repartition(1 + (items.agg(F.sum(F.length("text"))).first()[0] or 0) // (8 * block_words), F.xxhash64("item", "text"))
    found = sliced.mapInArrow(each, "block long, item string, words array<binary>")
    return found.withColumn("block", F.concat_ws("-", F.spark_partition_id(), "block"))


def _passes(blocks: DataFrame, block_words: int) -> list[list[str]]:
    """Blocks that go through the documents together: as many as hold ``block_words`` words."""
    passes: list[list[str]] = [[]]
    held = 0
    for name, n in blocks.groupBy("block").agg(F.sum(F.size("words"))).orderBy("block").collect():
        if held and held + n > block_words:
            passes.append([])
            held = 0
        passes[-1].append(name)
        held += n
    return passes


FOUND = "uid long, doc_id long, n_words long, spans array<struct<first: long, after: long>>, items array<string>"


def _pass(texts: DataFrame, held: Broadcast, window: int) -> DataFrame:
    span = pa.struct([("first", pa.int64()), ("after", pa.int64())])
    schema = schema_of(FOUND, texts, "text", "row_")
    carried = [f.name for f in schema if f.name in ("text", "row_")]
    name = uuid.uuid4().hex

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, window, held)
        for start in range(0, batch.num_rows, 512):
            rows = batch.slice(start, 512)
            found = [scan(automaton, t) for t in texts_of(rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("uid"),
                    rows.column("doc_id"),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([[dict(first=a, after=b) for a, b in h.spans] for _, h in found], pa.list_(span)),
                    pa.array([sorted(automaton.items_at(h.states)) for _, h in found], pa.list_(pa.string())),
                    *[rows.column(c) for c in carried],
                ],
                names=[f.name for f in schema],
            )

    return texts.mapInArrow(batches(each), schema)


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    hits = Hits()
    for s in sorted(spans, key=lambda s: (s["first"], s["after"])):
        if not hits.spans or hits.spans[-1][1] < s["after"]:
            hits.add(s["first"], s["after"])
    return hits.spans


def find_leaks(
    df: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """doc_id, n_words, spans (first, after), items of every document; with ``carry`` also text and all else as ``row_``."""
    spark = df.sparkSession
    blocks = materialize(item_blocks(items, window, block_words), "items")
    texts = id_and_text(df, id_col, text_col, carry).withColumn("uid", F.monotonically_increasing_id())
    passes = []
    for names in _passes(blocks, block_words):
        own = blocks.where(F.col("block").isin(names))
        held = spark.sparkContext.broadcast([(r.item, [bytes(w) for w in r.words]) for r in own.select("item", "words").collect()])
        passes.append(_pass(texts, held, window))
    if len(passes) == 1:
        return passes[0].drop("uid")
    # the first pass has the rows, the others only what they found
    found = passes[0].withColumn("own_", F.lit(True))
    for other in passes[1:]:
        found = found.unionByName(other.where(F.size("spans") > 0).select("uid", "spans", "items"), allowMissingColumns=True)
    kept = [F.max_by(c, F.coalesce("own_", F.lit(False))).alias(c) for c in found.columns if c not in ("uid", "spans", "items", "own_")]
    merged = F.udf(_merged, "array<struct<first: long, after: long>>", useArrow=True)
    return found.groupBy("uid").agg(*kept, F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).select(
        *[c for c in passes[0].columns if c not in ("uid", "spans", "items")], merged("spans").alias("spans"), "items"
    )


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.after - s.first)


def decontaminate(
    df: DataFrame, items: DataFrame, window: int = WINDOW, least: int = WINDOW, max_coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The documents without spans of ``least`` hit words or more, and without those of which more than ``max_coverage`` is hit."""
    found = find_leaks(df, items, window, id_col=id_col, text_col=text_col, carry=True)
    clean = found.where(hit_words() <= max_coverage * F.col("n_words"))

    @F.arrow_udf("string")
    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        texts = [None if t is None else t.encode() for t in text.to_pylist()]
        return pa.array([t if t is None else without_spans(t, [(s["first"], s["after"]) for s in ss], least).decode() for t, ss in zip(texts, spans.to_pylist())], pa.string())

    return restored(clean.withColumn("text", cut("text", "spans")), df.columns, text_col)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS g
    FROM items WHERE len(w) > 0
), places AS (
    SELECT uid, unnest(range(1, len(w) + 1)) AS i, w FROM docs
), runs AS (
    SELECT uid, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM places, (SELECT DISTINCT k FROM windows) WHERE i + k - 1 <= len(w)
), found AS MATERIALIZED (
    SELECT r.uid, r.i, r.k, x.item_id FROM runs r JOIN windows x USING (k, g)
), hit AS (
    SELECT uid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT uid, unnest(range(i, i + k)) AS p FROM found) GROUP BY uid
), listed AS (
    SELECT uid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT uid, cast(item_id AS VARCHAR) AS item_id FROM found WHERE item_id IS NOT NULL) GROUP BY uid
)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (uid) LEFT JOIN listed USING (uid)
"""
