"""Packing documents into training sequences, shortest pack first.

A document's tokens are cut into pieces of the sequence length and a rest. The
histogram of piece lengths (at most one row per length) is packed on the driver:
lengths go longest first, each into the packs that are shortest so far, and
whole groups of equal packs move at once, so the work depends on the number of
lengths, not of documents. The resulting patterns are joined back by rank: the
r-th piece of a length takes the r-th slot of that length.

Defined cases: a null text is an empty one, which is one piece of its end token;
null and repeated ids keep a piece per row; an empty table gives an empty result;
other columns are ignored.

At scale: texts are read once; everything later moves one small row per piece.
Ranks within a length are counted in hashed cells and shifted by the cells' sums,
so that a length shared by all documents is no hot key.
"""

from __future__ import annotations

import functools
import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, powers, stored, text_of

SEQUENCE = 2048
END_ID = 1
ROWS_PER_CELL = 1 << 17
MIN_CELLS = 64
CHUNK = 1 << 21  # characters handled at once
PARTS_KEPT = 2_000_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

_BLANK, _LETTER, _DIGIT, _MARK, _ODD = range(5)


@functools.cache
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of the code points below 0x250; what the tokenizer may treat in ways of its own is odd."""
    kind, lower = np.full(0x251, _ODD, np.int8), np.arange(0x251, dtype=np.uint32)
    for c in range(0x20, 0x250):
        ch = chr(c)
        if c == 0x20:
            kind[c] = _BLANK
        elif len(ch.lower()) == 1 and not 0x7F <= c <= 0xA0:
            kind[c] = _LETTER if ch.isalpha() else _DIGIT if ch.isnumeric() else _MARK
            lower[c] = ord(ch.lower())
    kind[9:14] = _BLANK
    return kind, lower


class WordTokens:
    """A tokenizer's ids, remembered per part of a word.

    The tokenizer lower-cases and breaks texts into runs of letters, single digits, runs of marks and
    a few endings after an apostrophe; merges stay inside these parts. So a text's ids are its parts' ids, and each different
    part is encoded once. Parts are found, looked up by hash and put together for many texts
    at a time, without an object per word. Texts with other scripts, control characters
    or special tokens are encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        # tokens that end a part, by the suffix the vocabulary gives them
        self.closing = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.closing[i] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.hash = np.zeros(0, np.uint64)  # of the parts known, ascending
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)  # where their ids are
        self.flat = np.zeros(0, self.type)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type)

    def _encoded(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of parts one after another, and how many each has; many parts to a call."""
        for k in range(0, len(parts), 5000):
            some = parts[k : k + 5000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.type)
            stops = np.flatnonzero(self.closing[ids])
            if len(stops) == len(some):
                yield ids, np.diff(stops, prepend=-1)
            else:
                single = [self.whole(p) for p in some]
                yield np.concatenate(single), np.array([len(i) for i in single])

    def _learn(self, hashes: np.ndarray, parts: list[str]) -> None:
        if len(self.hash) + len(parts) > PARTS_KEPT:
            self._forget()
        ids, counts = zip(*self._encoded(parts))
        count = np.concatenate(counts)
        start = len(self.flat) + np.cumsum(count) - count
        at = np.searchsorted(self.hash, hashes)
        self.flat = np.concatenate([self.flat, *ids])
        self.hash, self.start, self.count = (np.insert(a, at, b) for a, b in ((self.hash, hashes), (self.start, start), (self.count, count)))

    def _parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(lower-cased characters, first and end of every part, text of every part) of texts without odd characters."""
        kinds, lowers = _kinds()
        points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind, low = kinds[points], lowers[points]
        new = np.ones(len(kind), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        # an apostrophe alone, with letters after it, takes an ending with it
        alone = np.flatnonzero((points[:-1] == 39) & new[:-1] & (kind[1:] == _LETTER)) if len(kind) > 1 else np.zeros(0, np.int64)
        first, second = low[alone + 1], low[np.minimum(alone + 2, len(low) - 1)]
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = ~one & np.logical_or.reduce([(first == ord(a)) & (second == ord(b)) for a, b in ("re", "ve", "ll")])
        for found, n in ((alone[one], 1), (alone[two], 2)):
            new[found + 1] = False
            after = found + 1 + n
            new[after] |= kind[after] == _LETTER  # what is left of the letters
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(kind))
        real = kind[start] != _BLANK
        start, end = start[real], end[real]
        doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, "right") if texts else start
        return low, start, end, doc

    def _known(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where each part stands among the known ones; unknown ones are learned first."""
        forward, back = powers(len(low) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * forward[:-1])])
        own = mixed((total[end] - total[start]) * back[start] ^ (end - start).astype(np.uint64))
        different, at, back_to = np.unique(own, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hash, different)
        missing = np.ones(len(different), bool)
        inside = place < len(self.hash)
        missing[inside] = self.hash[place[inside]] != different[inside]
        if missing.any():
            text = low.tobytes().decode("utf-32-le", "surrogatepass")
            at = at[missing]
            before = len(self.hash)
            self._learn(different[missing], [text[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())])
            if len(self.hash) < before + missing.sum():  # others were forgotten
                return self._known(low, start, end)
            place = np.searchsorted(self.hash, different)
        return place[back_to]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        low, start, end, doc = self._parts(texts)
        place = self._known(low, start, end)
        count = self.count[place]
        ends = np.cumsum(count)
        ids = self.flat[np.repeat(self.start[place] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        cut = np.searchsorted(doc, np.arange(1, len(texts)))
        return np.split(ids, np.concatenate([[0], ends])[cut])

    def ids(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of every text, in order."""
        kinds, _ = _kinds()
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop] or "") < CHUNK):
                size, stop = size + len(texts[stop] or "") + 1, stop + 1
            some = [t or "" for t in texts[at:stop]]
            points = np.frombuffer("\n".join([*some, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
            odd = np.concatenate([[0], np.cumsum(kinds[np.minimum(points, 0x250)] == _ODD)])
            bounds = np.cumsum([0, *(len(t) + 1 for t in some)])
            is_odd = [n > 0 or "<|" in t for n, t in zip(np.diff(odd[bounds]).tolist(), some)]
            plain = iter(self._plain([t for t, o in zip(some, is_odd) if not o]))
            for t, o in zip(some, is_odd):
                yield self.whole(t) if o else next(plain)
            at = stop


@functools.lru_cache(maxsize=2)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut(path: str, length: int, end_id: int):
    """Arrow batches of (doc_id, text) to batches of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for batch in batches:
            ids_, texts = batch.column(0), batch.column(1)
            for lo in range(0, batch.num_rows, 4096):
                rows, out = ids_.slice(lo, 4096), []
                for k, own in enumerate(tokens.ids(texts.slice(lo, 4096).to_pylist())):
                    all_ids = np.append(own.astype("<u4"), np.uint32(end_id))
                    n = len(all_ids)
                    out += [(k, s, min(length, n - s), zlib.crc32(all_ids[s : s + length]), n)
                            for s in range(0, n, length)]
                cols = np.array(out, np.int64).T
                yield pa.RecordBatch.from_arrays([rows.take(pa.array(cols[0])), *map(pa.array, cols[1:])],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def pack_histogram(counts: dict[int, int], room: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pack, number of such packs), shortest pack first.

    Lengths from the longest down; each goes into the packs with the fewest
    tokens that still have room, a group of equal packs at a time.
    """
    groups: dict[int, list[list]] = defaultdict(list)  # tokens so far -> [lengths, number]
    sizes: list[int] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        fitted: list[tuple[int, list]] = []
        while left and sizes and sizes[0] + length <= room:
            size = sizes[0]
            group = groups[size].pop()
            if not groups[size]:
                heapq.heappop(sizes)
                del groups[size]
            pattern, number = group
            fits = (room - size) // length
            if number >= left:  # one more piece in some of these packs
                fitted.append((size + length, [pattern + (length,), left]))
                if number > left:
                    fitted.append((size, [pattern, number - left]))
                left = 0
            else:
                # All of these packs get one, and stay the shortest until they reach the next size.
                nxt = sizes[0] if sizes else room
                each = max(1, min(fits, left // number, -(-(nxt - size) // length)))
                left -= each * number
                new = size + each * length
                if new not in groups:
                    heapq.heappush(sizes, new)
                groups[new].append([pattern + (length,) * each, number])
        for size, group in fitted:
            if size not in groups:
                heapq.heappush(sizes, size)
            groups[size].append(group)
        if left:
            per = room // length
            full, rest = divmod(left, per)
            # More packs only once no open one has room; new ones open one by one, so each is filled last.
            for number, each in ((full, per), (1 if rest else 0, rest)):
                if number:
                    size = each * length
                    if size not in groups:
                        heapq.heappush(sizes, size)
                    groups[size].append([(length,) * each, number])
    return [(tuple(p), n) for size in sorted(groups) for p, n in groups[size]]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length rows (first rank, pieces of it in a pack, first sequence, first offset)."""
    out: dict[int, list] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    base = 0
    for lengths, number in patterns:
        at, k = 0, 0
        while k < len(lengths):
            length, m = lengths[k], 1
            while k + m < len(lengths) and lengths[k + m] == length:
                m += 1
            out[length].append((used[length], m, base, at))
            used[length] += m * number
            at, k = at + m * length, k + m
        base += number
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def pack(docs: DataFrame, *, id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    pieces = stored(rows.mapInArrow(cut(tokenizer or tokenizer_path(), length, end_id), PIECES), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = slots(pack_histogram(histogram, length))
    cells = max(MIN_CELLS, sum(histogram.values()) // ROWS_PER_CELL)
    placed = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(cells)))
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    shift = placed.groupBy("length", "cell").count().select(
        "length", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    in_cell = Window.partitionBy("length", "cell").orderBy("doc_id", "start", "ids_crc32")
    ranked = placed.withColumn("nth", F.row_number().over(in_cell) - 1).join(shift, ["length", "cell"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 5))
            seq, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for n in np.unique(size):
                at, own = np.flatnonzero(size == n), table[int(n)]
                row = own[np.searchsorted(own[:, 0], rank[at], "right") - 1]
                k = rank[at] - row[:, 0]
                seq[at], off[at] = row[:, 2] + k // row[:, 1], row[:, 3] + k % row[:, 1] * n
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("nth") + F.col("before")).alias("rank")).mapInArrow(
        place, PIECES + ", sequence_id long, offset long")
