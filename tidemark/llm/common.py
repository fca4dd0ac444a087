"""Word rules, storage and vectorised word hashing shared by the operators.

A word is a maximal run of characters other than space and U+0009 to U+000D,
everywhere in this package. A null text counts as an empty one.
"""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, work_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def prepared(spark: SparkSession) -> SparkSession:
    """Runtime settings, and this library on the path of Python workers that share its folder.

    A cluster that does not share it gets the package with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, paths) if p)
    return configure(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Words of a non-null text, without materialising more than the split."""
    blank_at = lambda c: c.isin(*BLANKS).cast("int")
    pieces = F.size(F.split(text, SPACE))
    count = pieces - blank_at(F.substring(text, 1, 1)) - blank_at(F.substring(text, -1, 1))
    return F.when(text == "", F.lit(0)).otherwise(count).cast("long")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo; -1 where the id is null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(-1))


_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[32, 9, 10, 11, 12, 13]] = True
_IS_MARK = np.ones(256, bool)
_IS_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def mixed(h: np.ndarray) -> np.ndarray:
    """Final mix of 64-bit hashes (wrap-around arithmetic)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        forward = np.full(size, _P, np.uint64)
        back = np.full(size, _P_INV, np.uint64)
        forward[0] = back[0] = 1
        _POWERS[:] = [np.multiply.accumulate(forward), np.multiply.accumulate(back)]
    return _POWERS[0][:n], _POWERS[1][:n]


class Words:
    """The words of a batch of texts as arrays: no Python object per word.

    ``start`` and ``end`` are byte offsets into ``data``, ``doc`` the index of
    each word's text, ``hash`` 64 bits of the word's bytes. With ``bare`` ASCII
    marks part words as blanks do.
    """

    def __init__(self, texts: list[str | None], lower: bool = False, bare: bool = False):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.n_docs = len(raw)
        sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8) if raw else np.zeros(0, np.uint8)
        if lower:
            data = _LOWER[data]
        self.data = data
        inside = ~(_IS_MARK if bare else _IS_BLANK)[data]
        step = np.diff(inside.astype(np.int8), prepend=0, append=0)
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        self.doc_ends = np.cumsum(sizes)
        self.first = np.concatenate([[0], np.searchsorted(self.start, self.doc_ends)]).astype(np.int64)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(raw)), self.counts)
        forward, back = powers(len(data) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forward[:-1])])
        self.hash = mixed((total[self.end] - total[self.start]) * back[self.start] ^ (self.end - self.start).astype(np.uint64))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text of every run of ``width`` words.

        A text of fewer words has one shingle, all its words; one of none has none.
        """
        n = len(self.hash)
        out = np.zeros(n, np.uint64)
        room = np.repeat(self.first[1:], self.counts) - np.arange(n)
        for k in range(width):
            take = room > k
            nxt = np.zeros(n, np.uint64)
            nxt[: n - k] = self.hash[k:]
            out = np.where(take, out * np.uint64(0xD6E8FEB86659FD93) + nxt, out)
        is_first = np.zeros(n, bool)
        is_first[self.first[:-1][self.counts > 0]] = True
        keep = (room >= width) | is_first
        return mixed(out[keep]), self.doc[keep]
