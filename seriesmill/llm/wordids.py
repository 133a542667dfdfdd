"""Token ids of whole texts with a public word-level BPE vocabulary, through the tokenizers library.

White space is dropped by that vocabulary's pre-tokenizer and no rule looks across it, so the ids of a text
are those of its white-space-separated words, one after the other. A worker remembers the ids of the words it
has met; new words of plain Latin letters go to the library's BPE model by pre-token, any other word through
the whole library pipeline.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import regex
from tokenizers import Tokenizer

# The split pattern of the vocabulary file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECE_BYTES = 1 << 20
REMEMBERED = 800_000


def _byte_names() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordIds(dict):
    """Ids (little-endian unsigned 32-bit) by word; unknown words are encoded when they are asked for."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.remembered = remembered
        self.split = regex.compile(PATTERN).findall
        # no control characters, nothing that normalization or lower-casing treats by context
        self.simple = regex.compile("[!-~¡-¬®-įı-ɏ]+").fullmatch
        self.names = _byte_names()
        specials = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, specials)) or rb"(?!)").search
        # where a text has neither marks that combine with a letter nor anything like a special token
        self.delicate = re.compile(rb"[\xc9-\xff]|<\|").search

    def _pre_token(self, token: str) -> bytes:
        names = token if token.isascii() else "".join(map(self.names.__getitem__, token.encode()))
        return array("I", [t.id for t in self.model.tokenize(names)]).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha():
            ids = self._pre_token(word.lower().decode())
        elif word[-1] in b".," and len(word) > 1 and (text := word.decode())[-2].isalpha() and self.simple(text):
            return self[word[:-1]] + self[word[-1:]]  # a mark after a letter is a pre-token of its own
        else:
            text = word.decode()
            if self.simple(text) and not self.special(word):
                lower = text.lower()
                ids = b"".join(map(self._pre_token, [lower] if text.isalpha() else self.split(lower)))
            else:
                ids = array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if len(word) < 64:
            if len(self) >= self.remembered:
                self.clear()
            self[word] = ids
        return ids

    def stream(self, text: bytes) -> Iterator[bytes]:
        """The ids of a text in pieces of about a megabyte of text."""
        begin, size = 0, len(text)
        while begin < size:
            end = min(size, begin + PIECE_BYTES)
            while end < size and text[end] not in b" \t\n\r\x0b\x0c":
                end += 1
            piece = text if end - begin == size else text[begin:end]
            if not self.delicate(piece):
                piece = piece.lower()
            yield b"".join([self[w] for w in piece.split()])
            begin = end


@functools.lru_cache(maxsize=2)
def word_ids(path: str, remembered: int = REMEMBERED) -> WordIds:
    return WordIds(path, remembered)
