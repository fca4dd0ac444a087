"""Texts as arrays of small character codes, for models over character n-grams."""

from __future__ import annotations

import functools

import numpy as np

# Code points from here on have no code of their own.
_TABLE = 0x2000
_POINTS = 0x110000


@functools.cache
def fold_table(letters_only: bool = False) -> np.ndarray:
    """Code of each code point below 0x2000: case folded, blanks 32, digits '0'.

    Code points beyond the table share 64 codes by their low bits. With ``letters_only``
    every other mark is a blank too, and the table covers all code points: letters
    from U+2000 on share the 8192 codes from 0x2000 on by a hash, and neighbours differ.
    """
    out = np.arange(_TABLE, dtype=np.uint32)
    for c in range(_TABLE):
        ch = chr(c)
        low = ch.lower()
        if ch.isalpha():
            out[c] = ord(low[0])
        elif ch.isdigit():
            out[c] = 32 if letters_only else 48
        elif ch.isspace() or c < 32 or letters_only:
            out[c] = 32
    if letters_only:
        own = np.fromiter((ord(ch.lower()[0]) if ch.isalpha() else 32 for ch in map(chr, range(_TABLE, _POINTS))), np.uint32, _POINTS - _TABLE)
        out = np.concatenate([out, own])
        high = out >= _TABLE
        out[high] = _TABLE + ((out[high] * np.uint32(0x9E3779B1)) >> np.uint32(19))
    out.flags.writeable = False
    return out


class CharTexts:
    """Texts one after another, each with one blank before and one after.

    ``codes`` holds folded characters with runs of blanks made one, ``doc`` each
    character's text.
    """

    def __init__(self, texts: list[str | None], table: np.ndarray):
        clean = [t or "" for t in texts]
        joined = " ".join(["", *clean, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter((len(t) + 1 for t in clean), np.int64, len(clean))
        sizes[:1] += 1  # the blank in front of the first text
        doc = np.repeat(np.arange(len(clean), dtype=np.int32), sizes) if clean else np.zeros(len(points), np.int32)
        low = table[np.minimum(points, len(table) - 1)]
        high = points >= len(table)
        if high.any():
            low[high] = _TABLE + (points[high] & 63)
        blank = low == 32
        keep = np.ones(len(low), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        self.codes, self.doc, self.n_docs = low[keep], doc[keep], len(clean)

    def letters(self) -> np.ndarray:
        """Characters other than blanks per text."""
        return np.bincount(self.doc, weights=self.codes != 32, minlength=self.n_docs).astype(np.int64)


def gram_hash(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the n codes that start at each place (the last n - 1 places have none)."""
    out = np.full(max(len(codes) - n + 1, 0), n, np.uint64)
    for k in range(n):
        out = (out * np.uint64(0x100000001B3)) ^ codes[k : k + len(out)].astype(np.uint64)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))
