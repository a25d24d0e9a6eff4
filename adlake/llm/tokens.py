"""Token ids of a word-level BPE vocabulary, kept per pre-token.

The vocabulary's pre-tokens (runs of letters, single digits, runs of other signs) never share a token, so the ids of a
text are those of its pre-tokens in a row, and each distinct pre-token is encoded by the tokenizer once. Lower case,
composition and classes of characters are plain below U+0180; texts with other characters go to the tokenizer whole.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from itertools import islice

from tokenizers import Tokenizer, pre_tokenizers

#: Pre-tokens, and words, kept at a time by one worker.
KEPT = 250_000

_LIMIT = 0x180
_SPACES = {*range(9, 14), 0x20, 0x85, 0xA0}


def _class(wanted) -> str:
    return "".join(re.escape(chr(c)) for c in range(_LIMIT) if wanted(c))


_LETTER = _class(lambda c: unicodedata.category(chr(c))[0] == "L")
_NUMBER = _class(lambda c: unicodedata.category(chr(c))[0] == "N")
_OTHER = _class(lambda c: unicodedata.category(chr(c))[0] not in "LN" and c not in _SPACES)
_SPLIT = re.compile(f"[{_LETTER}]+|[{_NUMBER}]|'(?:s|t|re|ve|m|ll|d)|[{_OTHER}]+").findall
#: The last range is white space to ``str.split`` alone.
_UNUSUAL = re.compile(f"[İ{chr(_LIMIT)}-\U0010ffff\x1c-\x1f]").search


class _Kept(dict):
    """A bounded cache: when full, the later half goes, since frequent keys come early."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        if len(self) >= KEPT:
            for old in list(islice(self, KEPT // 2, None)):
                del self[old]
        value = self[key] = self.make(key)
        return value


class PreTokens:
    """Ids as bytes, little-endian unsigned 32-bit; of pre-tokens, and of words between white space."""

    _loaded: dict[str, PreTokens] = {}

    @classmethod
    def of(cls, path: str) -> PreTokens:
        """One for each process and file."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.as_bytes = dict(zip(_byte_order(), sorted(pre_tokenizers.ByteLevel.alphabet()), strict=True))
        self.parts = _Kept(self._encode_part)
        self.words = _Kept(self._encode_word)

    def _encode_part(self, pre_token: str) -> bytes:
        if not (pre_token.isascii() and pre_token.isalpha()):
            pre_token = pre_token.encode().decode("latin-1").translate(self.as_bytes)
        return _packed([t.id for t in self.model.tokenize(pre_token)])

    def _encode_word(self, word: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, _SPLIT(word)))

    def usual(self, text: str) -> bool:
        """Whether the words of the text can be encoded one by one."""
        return not _UNUSUAL(text)

    def encode(self, text: str) -> bytes:
        if not self.usual(text):
            return _packed(self.whole.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, text.lower().split()))

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 4


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_order() -> list[int]:
    """Bytes in the order of the characters that stand for them: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return plain + [b for b in range(0x100) if b not in plain]
