"""Blocks of unsigned 32-bit ids, packed by patched frame of reference.

A block holds BLOCK ids. Its minimum is subtracted; the differences are packed at the width that most of them
need (a percentile), and the few that need more keep their low bits in the block and their high bits, with
their places, in the block's exception list. A file holds whole documents:

    header    magic, documents, ids, blocks, place of each section (unsigned 64-bit each)
    documents doc_id (signed 64-bit, the smallest value for null) and number of ids (unsigned 64-bit) of each
    blocks    start of each block's payload (unsigned 64-bit, one more than blocks), minimum (32-bit), width (8-bit)
    payload   per block: packed words, number of exceptions, their places (16-bit) and high bits (32-bit)

All numbers are little-endian. A block is read on its own through the index of block starts.
"""

from __future__ import annotations

import numpy as np

MAGIC = 0x31524F46504C4D53
BLOCK = 1024
LANES = 32
PERCENTILE = 90
NULL_ID = np.iinfo(np.int64).min


def widths_of(values: np.ndarray) -> np.ndarray:
    """Bits each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width as rows of BLOCK * width / 32 words."""
    rows = len(values)
    lanes = np.ascontiguousarray(values.reshape(rows * (BLOCK // LANES), LANES).T).astype(np.uint64)
    words = np.zeros((width + 1, lanes.shape[1]), np.uint64)
    for i in range(LANES):
        at, shift = divmod(i * width, 32)
        moved = lanes[i] << np.uint64(shift)
        words[at] |= moved & np.uint64(0xFFFFFFFF)
        words[at + 1] |= moved >> np.uint64(32)
    return np.ascontiguousarray(words[:width].T.astype("<u4")).reshape(rows, -1)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    rows = len(words)
    lanes = np.ascontiguousarray(words.reshape(-1, width).T).astype(np.uint64)
    lanes = np.concatenate([lanes, np.zeros((1, lanes.shape[1]), np.uint64)])
    mask = np.uint64((1 << width) - 1)
    out = np.empty((LANES, lanes.shape[1]), np.uint32)
    for i in range(LANES):
        at, shift = divmod(i * width, 32)
        out[i] = ((lanes[at] | lanes[at + 1] << np.uint64(32)) >> np.uint64(shift)) & mask
    return np.ascontiguousarray(out.T).reshape(rows, BLOCK)


def encode(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """The file of some documents; ``ids`` are those of all of them, one after the other."""
    blocks = -(-len(ids) // BLOCK)
    padded = np.empty(blocks * BLOCK, np.uint32)
    padded[: len(ids)] = ids
    if blocks:
        padded[len(ids) :] = padded[(blocks - 1) * BLOCK]
    values = padded.reshape(blocks, BLOCK)
    least = values.min(axis=1) if blocks else np.zeros(0, np.uint32)
    values = values - least[:, None]
    bits = widths_of(values)
    rank = min(BLOCK - 1, BLOCK * percentile // 100)
    width = np.partition(bits, rank, axis=1)[:, rank] if blocks else np.zeros(0, np.uint8)
    over = bits > width[:, None]
    payload: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        mine = np.flatnonzero(width == w)
        words = pack(values[mine] & np.uint32((1 << w) - 1), w) if w else np.zeros((len(mine), 0), "<u4")
        for k, row in zip(mine.tolist(), words):
            places = np.flatnonzero(over[k])
            high = values[k, places] >> np.uint32(w)
            payload[k] = b"".join(
                (row.tobytes(), len(places).to_bytes(2, "little"), places.astype("<u2").tobytes(), high.astype("<u4").tobytes())
            )
    starts = np.zeros(blocks + 1, "<u8")
    np.cumsum([len(p) for p in payload], out=starts[1:])
    known = np.array([NULL_ID if d is None else d for d in doc_ids], "<i8")
    sections = [known.tobytes(), np.array(counts, "<u8").tobytes(), starts.tobytes(), least.astype("<u4").tobytes(), width.tobytes()]
    header = np.zeros(4 + len(sections) + 1, "<u8")
    header[:4] = MAGIC, len(doc_ids), len(ids), blocks
    header[4:] = header.nbytes + np.cumsum([0, *map(len, sections)])
    return b"".join([header.tobytes(), *sections, *payload])


class Reader:
    """Reads a file image, whole or by range of ids."""

    def __init__(self, image: bytes):
        self.image = image
        head = np.frombuffer(image, "<u8", 10)
        if int(head[0]) != MAGIC:
            raise ValueError("not a file of packed ids")
        docs, self.n_ids, blocks = (int(x) for x in head[1:4])
        at = [int(x) for x in head[4:]]
        self.doc_ids = [None if d == NULL_ID else d for d in np.frombuffer(image, "<i8", docs, at[0]).tolist()]
        self.counts = np.frombuffer(image, "<u8", docs, at[1]).astype(np.int64)
        self.starts = np.frombuffer(image, "<u8", blocks + 1, at[2]).astype(np.int64)
        self.least = np.frombuffer(image, "<u4", blocks, at[3])
        self.width = np.frombuffer(image, np.uint8, blocks, at[4])
        self.payload = at[5]

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks ``first`` to ``last - 1``, as rows."""
        out = np.empty((last - first, BLOCK), np.uint32)
        width = self.width[first:last]
        for w in np.unique(width).tolist():
            mine = np.flatnonzero(width == w)
            size = BLOCK * w // 32
            begins = [self.payload + int(self.starts[first + k]) for k in mine]
            if w:
                words = np.empty((len(mine), size), "<u4")
                for row, at in zip(words, begins):
                    row[:] = np.frombuffer(self.image, "<u4", size, at)
                values = unpack(words, w)
            else:
                values = np.zeros((len(mine), BLOCK), np.uint32)
            for row, at in zip(values, begins):
                at += 4 * size
                n = int.from_bytes(self.image[at : at + 2], "little")
                if n:
                    places = np.frombuffer(self.image, "<u2", n, at + 2)
                    row[places] |= np.frombuffer(self.image, "<u4", n, at + 2 + 2 * n) << np.uint32(w)
            out[mine] = values
        return out + self.least[first:last, None]

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop - 1`` of the file, from the blocks that hold them."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, -(-stop // BLOCK)
        return self.blocks(first, last).reshape(-1)[start - first * BLOCK : stop - first * BLOCK]
