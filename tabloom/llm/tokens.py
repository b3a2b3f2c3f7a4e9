"""Token ids of texts from a byte-level vocabulary file, for use inside tasks."""

from __future__ import annotations

import re
from operator import itemgetter

import numpy as np
import regex
from tokenizers import Tokenizer

CACHE_PIECES = 600_000
# Fixed value: the pattern by which byte-level vocabularies split text before merging.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Letters and marks whose class is the same in every Unicode version.
_SETTLED = regex.compile(r"[ \n!-~¡-ſ]*")
# White space other than the space and the line feed.
_ODD_SPACE = re.compile(r"[^\S \n]")
_ODD_LATIN = [chr(c) for c in range(256) if _ODD_SPACE.match(chr(c))]


def _byte_letters() -> dict[int, str]:
    """Byte to the letter that stands for it in the vocabulary: visible Latin-1 bytes
    stand for themselves, the others take the letters from 256 on in order."""
    spare = iter(range(256, 512))
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: chr(b if b in visible else next(spare)) for b in range(256)}


_BYTE_LETTERS = _byte_letters()


class _Known(dict):
    """Ids by piece; a piece asked for the first time is worked out and kept."""

    def __init__(self, work_out):
        self.work_out = work_out

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.work_out(piece)
        return ids


class TokenCoder:
    """Ids of texts as little-endian 32-bit integers, equal to encoding each text whole.

    Texts are cut before single spaces between visible characters: no id spans such a
    place. Ids of a piece are looked up; only pieces not seen lately are encoded.
    ``cache`` bounds the pieces that one task's process remembers (twice that many).
    """

    def __init__(self, path: str, cache: int = CACHE_PIECES):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.cache = cache
        self.units = _Known(self._unit)
        self.known = _Known(self._after_space)  # keyed without the space that begins the piece
        self.older: dict[str, bytes] = {}

    def _unit(self, unit: str) -> bytes:
        return self._letters(unit.encode().decode("latin-1").translate(_BYTE_LETTERS))

    def _letters(self, letters: str) -> bytes:
        return b"".join([self.bytes_of[t.id] for t in self.model.tokenize(letters)])

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if _SETTLED.fullmatch(piece):
            return b"".join([self.units[u] for u in _SPLIT.findall(piece)])
        return self._plain(piece)

    def _after_space(self, rest: str) -> bytes:
        ids = self.older.get(rest)
        if ids is not None:
            return ids
        if rest.isascii() and rest.isalpha():  # one unit, whose letters stand for themselves
            return self._letters(_BYTE_LETTERS[32] + rest)
        return self._piece(" " + rest)

    def _trim(self) -> None:
        if len(self.units) > self.cache:
            self.units.clear()
        if len(self.known) > self.cache:
            self.older, self.known = self.known, _Known(self._after_space)

    @staticmethod
    def _odd_space(text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return _ODD_SPACE.search(text) is not None
        return any(c in text for c in _ODD_LATIN)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._plain(text)
        self._trim()
        first, *rest = text.split(" ")
        if len(rest) > 1 and not ("  " in text or "\n " in text or " \n" in text or self._odd_space(text)):
            return self._piece(first) + b"".join(itemgetter(*rest)(self.known))
        out: list[bytes] = []
        held = first
        for part in rest:
            if part and held and not held[-1].isspace() and not part[0].isspace():
                out.append(self._piece(held))
                held = " " + part
            else:
                held += " " + part
        out.append(self._piece(held))
        return b"".join(out)


_coders: dict[str, TokenCoder] = {}


def coder(path: str) -> TokenCoder:
    """One coder for each process: tasks that run in it share what it remembers."""
    if path not in _coders:
        _coders[path] = TokenCoder(path)
    return _coders[path]
