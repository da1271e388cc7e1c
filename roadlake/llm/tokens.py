"""Byte-level BPE of whole texts, with the ids of repeated words kept in a bounded cache.

The vocabulary and merges are those of the given ``tokenizers`` JSON file; the
path is a parameter.  A text is cut before each space, which is always a piece
boundary of the byte-level pre-tokenizer unless the space stands between other
white space; such texts are encoded whole.  The strings of the file's added tokens
are cut out first and give their own ids, as the library's default call does.
Tests hold the ids against the ``tokenizers`` library.
"""

from __future__ import annotations

import json
import re

#: White space other than space and line feed, and what Unicode versions disagree on.
_ODD = [
    *"\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0",
    *map(chr, [0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]),
]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies, by their public rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, max_words: int = 400_000):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        to_byte = _byte_of()
        ranks = {
            bytes(to_byte[c] for c in word): n for word, n in spec["model"]["vocab"].items() if word not in special
        }
        self._bpe = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._bytes = [n.to_bytes(4, "little") for n in range(max(ranks.values()) + 1)]
        self._special = {word: n.to_bytes(4, "little") for word, n in special.items()}
        longest = sorted(map(re.escape, special), key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(longest) + ")").split if special else None
        self._max = max_words
        self._new: dict[str, bytes] = {}  # words met lately; a full one becomes the old one
        self._old: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return b"".join([self._bytes[n] for n in self._bpe(text)])

    def _word(self, word: str) -> bytes:
        ids = self._new[word] = self._old.get(word) or self._plain(" " + word)
        return ids

    def encode(self, text: str) -> bytes:
        if any(word in text for word in self._special):
            parts = self._cut(text)  # every other one is an added token
            return b"".join(self._special[x] if k % 2 else self._ordinary(x) for k, x in enumerate(parts) if x)
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if "  " in text or " \n" in text or text.endswith("\n ") or any(c in text for c in _ODD):
            return self._plain(text)
        if len(self._new) > self._max:
            self._new, self._old = {}, self._new
        first, *rest = text.split(" ")
        ids = [*map(self._new.get, rest)]
        if None in ids:
            ids = [self._word(word) if n is None else n for n, word in zip(ids, rest, strict=True)]
        return (self._plain(first) if first else b"") + b"".join(ids)


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """One encoder per Python worker and file."""
    path = path or default_path()
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
