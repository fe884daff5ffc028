"""Byte-level BPE ids by the ``tokenizers`` library, with a bounded memo of pieces.

A byte-level BPE splits a text before every space that follows a non-space, around a lone line break, and
before a lone mark behind a letter, before any merge takes place. Texts are cut there and each distinct piece is encoded once per
worker; texts with runs of white space are encoded whole. Ids are the same either way.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

ID = np.dtype("<u4")
MEMO = 500_000
_RUN = re.compile(r" \s| \Z")
#: Letters that every Unicode version knows, and marks that never begin a contraction.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: A point or comma that doesn't stand alone behind a letter or digit.
_BESIDE = re.compile(f"[.,](?:(?<![{_LETTER}0-9].)|(?=[^\\s{_LETTER}0-9]))")
_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?#*$%&|()\[\]{}<>=+/-]*)")


def _byte_letters() -> dict[int, str]:
    """The characters that a byte-level vocabulary writes bytes with: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()
_SPACE = _LETTERS[32]
_SAFE = bytes(b for b, c in _LETTERS.items() if ord(c) == b)


class _Pieces(dict):
    """Piece -> ids as little-endian bytes: what follows a space, or a zero and what follows no space.

    A word is one pre-token and goes to the vocabulary's merges directly; marks behind it are another.
    """

    def __init__(self, encode, merge) -> None:
        super().__init__()
        self.encode, self.merge = encode, merge
        self.line, self.marks = encode("\n"), {"": b""}

    def word(self, word: str, before: str = "") -> bytes:
        """Ids of one pre-token, given without the space before it."""
        if not word.isascii():
            raw = word.encode()
            word = raw.decode("latin-1")
            if raw.translate(None, _SAFE):
                word = word.translate(_LETTERS)
        return array("I", [t.id for t in self.merge(before + word)]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():
            got = array("I", [t.id for t in self.merge(_SPACE + piece)]).tobytes()
        else:
            got = self.mixed(piece)
        if len(piece) < 64:
            if len(self) >= MEMO:
                self.clear()
                self.marks = {"": b""}
            self[piece] = got
        return got

    def mixed(self, piece: str) -> bytes:
        fresh = piece[:2] == "\0\n"
        if piece[:1] == "\0" and not fresh:
            return self.encode(piece[1:])
        m = _WORD.fullmatch(piece, 2 if fresh else 0)
        if not m:
            return self.encode(piece[1:] if fresh else " " + piece)
        word, marks = m.groups()
        if marks not in self.marks:
            self.marks[marks] = self.encode(marks)
        if fresh:
            return self.line + self.word(word) + self.marks[marks]
        return (self.get(word) or self.word(word, _SPACE)) + self.marks[marks]


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit bytes.

    A vocabulary that isn't byte-level, or rewrites or prefixes texts, is used on whole texts only.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        split = self.tokenizer.pre_tokenizer
        self.cut = type(split) is pre_tokenizers.ByteLevel and not split.add_prefix_space and split.use_regex and self.tokenizer.normalizer is None
        self.pieces = _Pieces(self.plain, self.tokenizer.model.tokenize)

    def plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.cut or "\0" in text or "\n\n" in text or "\n " in text or _RUN.search(text):
            return self.plain(text)
        text = text.replace("\n", " \0\n")
        if not _BESIDE.search(text):
            text = text.replace(",", " \0,").replace(".", " \0.")
        first, *rest = text.split(" ")
        return (self.plain(first) if first else b"") + b"".join(map(self.pieces.__getitem__, rest))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file; only the calling thread works."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
