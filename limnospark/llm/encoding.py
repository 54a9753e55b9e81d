"""Encoding of texts with a tokenizer file of the `tokenizers` library, inside tasks."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The characters with Unicode's White_Space property.
SPACE = "\t-\r \x85\xa0  -     　"
# A byte-level vocabulary merges inside words only: a word takes one blank before it, and of a longer run of
# white space the last character before a word stands alone.
_PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


# Marks that may follow a word; together they are one piece of the vocabulary's own split.
_MARKS = ".,;:!?*$%&|"


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class Encoder(dict):
    """Ids of whole texts, as the library gives them without adding special tokens.

    Texts are parted at the vocabulary's added tokens, such as "<|endoftext|>", which are ids of their own. Each distinct piece between white space goes to the library once; as a dictionary, the encoder holds the
    ids of pieces met so far: `remember` of them and as many older ones, from which those still met are taken over. A word of letters alone goes straight to the library's
    model, since the vocabulary's own split leaves it whole; every other piece takes the library's full path.
    """

    def __init__(self, path: str, remember: int = 400_000):
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder()
        self._added = {token.content: array("I", [i]).tobytes() for i, token in added.items() if token.content}
        self._marks = re.compile("(" + "|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) + ")")  # the longest counts
        # tokens that take blanks with them, or are words only, are left to the library
        self._plain = not any(token.lstrip or token.rstrip or token.single_word for token in added.values())
        self._split = self._tokenizer.model.tokenize
        self._letters = _byte_letters()
        self._blank = self._letters[32]
        self._remember = remember
        self._older: dict[str, bytes] = {}
        self.size = self._tokenizer.get_vocab_size()

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), np.uint32)

    def encode_bytes(self, text: str) -> bytes:
        """The ids as native unsigned 32-bit integers."""
        if len(self) > self._remember:
            self._older = dict(self)
            self.clear()
        if not self._added or not self._marks.search(text):
            return b"".join(map(self.__getitem__, _PIECES.findall(text)))
        if not self._plain:
            return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        parts = self._marks.split(text)  # every second one is an added token
        return b"".join(self._added[part] if i % 2 else b"".join(map(self.__getitem__, _PIECES.findall(part))) for i, part in enumerate(parts))

    def __missing__(self, piece: str) -> bytes:
        known = self._older.get(piece)
        if known is not None:
            self[piece] = known
            return known
        word = piece.rstrip(_MARKS)
        if not word.lstrip(" ").isalpha():
            ids = self._tokenizer.encode(piece, add_special_tokens=False).ids
        elif len(word) < len(piece):
            found = self[piece] = self[word] + self[piece[len(word):]]
            return found
        elif piece.isascii():
            ids = [token.id for token in self._split(piece.replace(" ", self._blank))]
        else:
            ids = [token.id for token in self._split(piece.encode().decode("latin-1").translate(self._letters))]
        found = self[piece] = array("I", ids).tobytes()
        return found

    def ends_sentence(self) -> np.ndarray:
        """For each id, whether its text holds a full stop, a question or exclamation mark, or a line break."""
        return np.array([bool(re.search("[.!?\n]", self._tokenizer.decode([i]))) for i in range(self.size)])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
