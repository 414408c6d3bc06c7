"""Token ids by a public tokenizer, one white-space word at a time with a bounded cache.

The tokenizer turns runs of white space into breaks between pre-tokens and never looks across one, so
the ids of a text are those of its ASCII-white-space words one after the other. A word of printable
characters below U+0250 is made small and cut into pre-tokens here, and each pre-token's ids come from the
tokenizer's model; any other word goes to the tokenizer whole. Words repeat: a dictionary of words saves
most of the work. Added tokens are matched before letters are made small, so a word that may hold one goes
to the tokenizer as it is. ``tests/llm`` compares with the tokenizer on whole texts.
"""

from __future__ import annotations

import os
import re
from array import array

from riskmart.llm.common import cached

_BY_PATH: dict[str, "WordTokens"] = {}

# Fixed value: the vocabulary's pattern for pre-tokens, for characters of _PLAIN after lower-casing.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºÀ-ÖØ-öø-ɏ]+|[0-9²³¹¼½¾]|[^a-zªµºÀ-ÖØ-öø-ɏ0-9²³¹¼½¾]+")
#: Printable characters below U+0250 without white space: NFC leaves them alone.
_PLAIN = re.compile(r"[!-~\u00a1-ɏ]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokens(dict):
    """word (UTF-8 bytes without ASCII white space) -> ids (little-endian unsigned 32-bit).

    Two generations of at most ``limit`` words: when the younger one is full it becomes the older one,
    whose words move back as they are met again. Frequent words stay, words met once fall out.
    """

    def __init__(self, path: str, limit: int = 220_000):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model_ids = self._tokenizer.model.tokenize
        self._letters = {b: ord(c) for b, c in byte_letters().items()}
        # What every added token begins with; words that hold it (all, if that is nothing) are not cut here.
        self._mark = os.path.commonprefix([t.content for t in self._tokenizer.get_added_tokens_decoder().values()]).lower().encode()
        self._limit = limit
        self._older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        found = self._older.get(word)
        if found is None:
            found = self._ids(word)
        self[word] = found
        return found

    def _ids(self, word: bytes) -> bytes:
        if word.isalpha() and self._mark:  # ASCII letters alone
            lower = word.lower()
            return self._piece(word.decode()) if lower == word else self[lower]
        text = word.decode()
        lower = text.lower()
        if self._mark in lower.encode() or not _PLAIN.fullmatch(lower) or not _PLAIN.fullmatch(text):
            return self._whole(text)
        pieces = _PIECES.findall(lower)
        if len(pieces) > 1:
            return b"".join([self[piece.encode()] for piece in pieces])
        if lower != text:
            return self[lower.encode()]
        return self._piece(text if word.isascii() else word.decode("latin-1").translate(self._letters))

    def _piece(self, letters: str) -> bytes:
        """One pre-token, in the letters of the vocabulary, straight to the model."""
        return array("I", [t.id for t in self._model_ids(letters)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))

    def trim(self) -> None:
        """Called between texts: a full generation becomes the older one, so that the cache stays bounded."""
        if len(self) >= self._limit:
            self._older = dict(self)
            super().clear()

    def clear(self) -> None:
        self._older = {}
        super().clear()


def word_tokens(path: str) -> WordTokens:
    """One cache per worker process and vocabulary, kept from task to task."""
    if path not in _BY_PATH:
        _BY_PATH[path] = cached("packing", WordTokens(path))
    return _BY_PATH[path]
