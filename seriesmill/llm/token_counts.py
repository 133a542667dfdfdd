"""Operator 5: token counts that follow edits, with a tree of pre-token segments for each document.

A text is cut into leaves of about ``leaf_chars`` characters, only where a space follows a character that is no
white space: no pre-token reaches across such a place, and those after it do not depend on what is before. So the
counts of the leaves add up to that of the text. A tree over the leaves holds sums of characters and tokens. An edit goes
down the tree to the leaves it touches, with the leaves of the characters next to it as context, joins their new
text, cuts and counts that alone, and adds the differences to the sums above. The rest of the text is never
encoded again.

Trees are rows of a table beside their texts. Documents are built where they are read, without a shuffle; edits come
as an array in the row, or are joined to the table by doc_id (``attach_edits``). A document's edits are applied in order, in
one task, each at positions of the text as the edits before have left it.

Defined results: a null text is empty and has 0 tokens; places beyond the text are its end, negative ones its start;
null parts of an edit are 0 or empty; edits without a document are dropped, documents without edits stay as they
are; repeated rows are documents of their own and get the same edits; edits with a null doc_id are dropped; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, id_and_text, q

LEAF_CHARS = 1024
#: the longest leaf that is not cut, in leaves
STRETCH = 4
TREE = "leaves array<int>, counts array<int>"
EDITS = "array<struct<at: long, remove: long, insert: string>>"
_CUT = regex.compile(r"(?<=\S) ")


@functools.lru_cache(maxsize=2)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """A byte-level BPE from a file of ranks, without special tokens."""
    with open(ranks, "rb") as lines:
        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=found, special_tokens={})


def cut(text: str, leaf_chars: int = LEAF_CHARS) -> list[str]:
    """Leaves of a text; one empty leaf for an empty text. A text without a place to cut is one leaf."""
    out, begin, size = [], 0, len(text)
    while size - begin > leaf_chars:
        at = _CUT.search(text, begin + leaf_chars)
        if at is None:
            break
        out.append(text[begin : at.start()])
        begin = at.start()
    return [*out, text[begin:]]


class TokenTree:
    """Sums of characters and tokens over the leaves of a text. Node 1 is the root, 2k and 2k + 1 are below k."""

    def __init__(self, text: str, count, leaf_chars: int = LEAF_CHARS, leaves: list[int] | None = None, counts: list[int] | None = None):
        self.count, self.leaf_chars, self.encoded = count, leaf_chars, 0
        if leaves is None:
            self.texts = cut(text, leaf_chars)
            counts = [self._encode(t) for t in self.texts]
        else:
            ends = list(accumulate(leaves))
            self.texts = [text[e - n : e] for e, n in zip(ends, leaves)]
        self._build(counts)

    def _encode(self, text: str) -> int:
        self.encoded += len(text)
        return self.count(text)

    def _build(self, counts: list[int]) -> None:
        self.base = 1
        while self.base < len(self.texts):
            self.base *= 2
        spare = [0] * (self.base - len(self.texts))
        self.chars = [0] * self.base + [len(t) for t in self.texts] + spare
        self.tokens = [0] * self.base + counts + spare
        for k in range(self.base - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def _leaf(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and its first character."""
        k, start = 1, 0
        while k < self.base:
            k *= 2
            if place - start >= self.chars[k]:
                start += self.chars[k]
                k += 1
        return k - self.base, start

    def _put(self, leaf: int, text: str, tokens: int) -> None:
        k = self.base + leaf
        chars, more = len(text) - self.chars[k], tokens - self.tokens[k]
        self.texts[leaf] = text
        while k:
            self.chars[k] += chars
            self.tokens[k] += more
            k //= 2

    def edit(self, at: int, remove: int, insert: str) -> None:
        size = self.chars[1]
        at = min(max(at, 0), size)
        end = min(at + max(remove, 0), size)
        if at == end and not insert:
            return
        first, start = self._leaf(max(at - 1, 0)) if size else (0, 0)
        last, last_start = self._leaf(min(end, size - 1)) if size else (0, 0)
        old = "".join(self.texts[first : last + 1])
        new = cut(old[: at - start] + insert + old[end - start :], self.leaf_chars)
        room = last - first + 1
        if len(new) <= room:
            for k in range(room):
                text = new[k] if k < len(new) else ""
                self._put(first + k, text, self._encode(text))
        elif sum(map(len, new)) <= STRETCH * self.leaf_chars * room:  # a longer leaf
            new = [*new[: room - 1], "".join(new[room - 1 :])]
            for k, text in enumerate(new):
                self._put(first + k, text, self._encode(text))
        else:  # more leaves: new sums, but nothing else is encoded
            counts = self.counts()
            counts[first : last + 1] = [self._encode(t) for t in new]
            self.texts[first : last + 1] = new
            self._build(counts)

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def counts(self) -> list[int]:
        return self.tokens[self.base : self.base + len(self.texts)]

    def leaves(self) -> list[int]:
        return [len(t) for t in self.texts]

    def text(self) -> str:
        return "".join(self.texts)


COUNTED = f"doc_id long, text string, {TREE}, n_before long, n_tokens long, n_chars long, n_encoded long"


def count_tokens(
    df: DataFrame, ranks: str, pattern: str, edits_col: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    leaf_chars: int = LEAF_CHARS, tree_cols: tuple[str, str] | None = None,
) -> DataFrame:
    """Trees of all texts, after the edits of ``edits_col``.

    doc_id, text, leaves and counts (the tree's lowest row), n_before and n_tokens (before and after the edits),
    n_chars, n_encoded (characters encoded for the edits). ``tree_cols`` names leaves and counts kept from an earlier
    call; then only what the edits touch is encoded at all.
    """
    docs = id_and_text(df, id_col, text_col) if not (edits_col or tree_cols) else df.select(
        q(id_col).cast("long").alias("doc_id"),
        q(text_col).cast("string").alias("text"),
        *([q(edits_col).cast(EDITS).alias("edits")] if edits_col else []),
        *([q(c).cast("array<int>").alias(n) for c, n in zip(tree_cols, ("leaves", "counts"))] if tree_cols else []),
    )

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = encoding(ranks, pattern).encode_ordinary
        rows = []
        for row in batch.to_pylist():
            known = {"leaves": row["leaves"], "counts": row["counts"]} if row.get("leaves") and row.get("counts") else {}
            tree = TokenTree(row["text"] or "", lambda t: len(encode(t)), leaf_chars, **known)
            before, tree.encoded = tree.n_tokens, 0
            for e in row.get("edits") or []:
                if e:
                    tree.edit(e["at"] or 0, e["remove"] or 0, e["insert"] or "")
            rows.append((row["doc_id"], tree.text(), tree.leaves(), tree.counts(), before, tree.n_tokens, tree.chars[1], tree.encoded))
        kinds = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.int64()] * 4)
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "leaves", "counts", "n_before", "n_tokens", "n_chars", "n_encoded"])

    return docs.mapInArrow(batches(each), COUNTED)


def attach_edits(trees: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add a column ``edits`` from a table doc_id, seq, at, remove, insert, in the order of seq."""
    step = F.struct("seq", F.col("at").cast("long").alias("at"), F.col("remove").cast("long").alias("remove"), F.col("insert").cast("string").alias("insert"))
    listed = edits.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("edited_id")).agg(F.array_sort(F.collect_list(step)).alias("steps"))
    joined = trees.join(listed, q(id_col) == F.col("edited_id"), "left")
    parts = F.transform("steps", lambda s: F.struct(s["at"].alias("at"), s["remove"].alias("remove"), s["insert"].alias("insert")))
    return joined.withColumn("edits", parts).drop("steps", "edited_id")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents before and after three edits whose places follow from doc_id and length."""
    import public_tokenizers

    from .common import documents

    docs = documents(spark, sf_dir)
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")

    def place(k: int):
        return F.pmod(F.crc32(F.concat_ws("-", F.col("doc_id").cast("string"), F.lit(str(k))).cast("binary")), size + 1)

    def step(at, remove: int, insert):
        return F.struct(at.alias("at"), F.lit(remove).cast("long").alias("remove"), F.lit(insert).alias("insert"))

    edits = F.array(step(place(1), 0, "new words, here"), step(place(2), 40, ""), step(place(3), 7, "don't  stop\n"))
    counted = count_tokens(docs.withColumn("edits", edits), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, "edits")
    return counted.select("doc_id", "n_before", "n_tokens", "n_chars", F.size("leaves").cast("long").alias("n_leaves"), "n_encoded")
