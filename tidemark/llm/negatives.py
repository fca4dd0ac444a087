"""Hard negatives for contrastive training, by exact integer scores.

A row's score with an anchor is the inner product of their integer vectors. An
anchor's positives are the best other rows of its label; for each positive, the best rows of
other labels whose scores lie in a window below the positive's are its hard
negatives. Higher scores come first, ties by smaller id.

Scores come from matrix products in a residue number system. Components are reduced
modulo several small primes, each product runs in float32 (sums stay below 2^24 and
are exact), and the signed score is put together by Chinese remaindering in
balanced mixed radix. As many primes are taken as the largest possible score, by the
largest vector length, needs.

Defined cases: rows with a null label or vector, or a null or non-finite component,
take no part. A null id is no anchor and comes last among ties. Repeated rows are rows
each; a row is not its own positive. Vectors of other lengths are filled with zeros. A row without
partners has no output; an empty table gives an empty result. Squared vector lengths from 2^62 on
(scores need not fit 64 bits) are refused with an error. Other columns are ignored.

At scale: anchors are a query set, compared with all rows in cells of at most about
``ANCHORS`` by ``ROWS``; a cell is one group of a cogroup, so no label, however
frequent, and no group of equal vectors is one task. Positives are looked for in cells of one label.
What leaves a cell is the best few of each anchor.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

ANCHORS = 2048
ROWS = 16384
EXACT = 1 << 24  # integers below are exact in float32
CHUNK = 4096  # components per product
CELLS = 1 << 22  # scores held at once
LIMIT = 1 << 62


def primes_for(bound: int, dims: int) -> list[int]:
    """Odd primes, largest first, whose products of ``dims`` components are exact, for scores up to ``bound``."""
    top = 2 * math.isqrt(EXACT // max(min(dims, CHUNK), 1)) + 1
    top = min(top, 4093)
    sieve = np.ones(top + 1, bool)
    sieve[:3] = False
    sieve[4::2] = False
    for k in range(3, math.isqrt(top) + 1, 2):
        if sieve[k]:
            sieve[k * k :: k] = False
    out, reach = [], 1
    for p in np.flatnonzero(sieve)[::-1].tolist():
        out.append(p)
        reach *= p
        if reach > 2 * bound + 1 and len(out) > 1:
            return out
    raise ValueError("scores too large for the primes at hand")


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues in -(p - 1) / 2 .. (p - 1) / 2."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r)


def residues(matrix: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [balanced(matrix, p).astype(np.float32) for p in primes]


def combined(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed integers from their residues: balanced digits in mixed radix, one prime at a time."""
    total = balanced(parts[0], primes[0]).astype(np.int64)
    digits, radix = [total], 1
    for k in range(1, len(primes)):
        p = primes[k]
        rest = parts[k].astype(np.int64)
        for q, digit in zip(primes, digits):
            rest = balanced((rest - digit) * pow(q, -1, p), p)
        digits.append(rest)
        radix *= primes[k - 1]
        with np.errstate(over="ignore"):  # the sum fits, partial ones may wrap
            total = total + rest * np.array(radix % (1 << 64), np.uint64).astype(np.int64)
    return total


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of the rows of two matrices given by residues."""
    parts = []
    for x, y, p in zip(a, b, primes):
        sums = np.zeros((len(x), len(y)), np.int32)
        for lo in range(0, x.shape[1], CHUNK):
            sums += np.mod(x[:, lo : lo + CHUNK] @ y[:, lo : lo + CHUNK].T, np.float32(p)).astype(np.int32)
        parts.append(sums)
    return combined(parts, primes)


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """List column as rows of ``dims`` integers, short ones filled with zeros."""
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(sizes), dims), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def ranked(score: np.ndarray, usable: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the usable scores ascending and where they stand; ties with the first one last.

    Unusable ones come first, with the least integer as score.
    """
    n = score.shape[1]
    bits = max(n - 1, 1).bit_length()
    least = np.iinfo(np.int64).min
    if bound < 1 << (61 - bits):
        key = (score << bits) + np.arange(n - 1, -1, -1)
        key[~usable] = least
        key.sort(axis=1)
        at = n - 1 - (key & ((1 << bits) - 1))
        return np.where(key == least, least, key >> bits), at
    score = np.where(usable, score, least)
    at = n - 1 - np.argsort(score[:, ::-1], axis=1, kind="stable")
    return np.take_along_axis(score, at, 1), at


def _blocks(anchors: pa.Table, rows: pa.Table, dims: int, primes: list[int]):
    """(anchors' slice, scores) of a cell, a few anchors at a time."""
    a, b = matrix(anchors.column("vec"), dims), residues(matrix(rows.column("vec"), dims), primes)
    step = max(CELLS // max(len(b[0]), 1), 1)
    for lo in range(0, len(a), step):
        yield slice(lo, lo + step), scores(residues(a[lo : lo + step], primes), b, primes)


_FOUND = "anchor long, anchor_id long, place int, row long, id long, score long"


def _joined(found: list[list[np.ndarray]], rows: pa.Table, anchors: pa.Table) -> pa.Table:
    """Found pairs (anchor index, place, row index, score) as a table."""
    a, place, b, score = (np.concatenate([f[k] for f in found]).astype(np.int64) if found else np.zeros(0, np.int64) for k in range(4))
    a, b = pa.array(a), pa.array(b)
    return pa.table({
        "anchor": anchors.column("row").take(a), "anchor_id": anchors.column("id").take(a), "place": pa.array(place.astype(np.int32)),
        "row": rows.column("row").take(b), "id": rows.column("id").take(b), "score": pa.array(score)})


def _best(dims: int, primes: list[int], bound: int, wanted: int):
    """The best other rows of every anchor of a cell."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("id", "ascending"), ("row", "ascending")])
        own, other = (t.column("row").to_numpy() for t in (anchors, rows))
        found = []
        for part, score in _blocks(anchors, rows, dims, primes) if rows.num_rows else ():
            usable = own[part, None] != other
            value, at = ranked(score, usable, bound)
            value, at = value[:, -wanted:], at[:, -wanted:]
            keep = np.take_along_axis(usable, at, 1)
            a, k = np.nonzero(keep)
            found.append([a + part.start, np.zeros(len(a), np.int64), at[a, k], value[a, k]])
        return _joined(found, rows, anchors)

    return run


def _window(dims: int, primes: list[int], bound: int, wanted: int):
    """For every positive of every anchor of a cell the best rows of other labels in its window."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("id", "ascending"), ("row", "ascending")])
        own, other = (t.column("label").to_numpy() for t in (anchors, rows))
        lows, highs = (anchors.column(c).to_pylist() for c in ("lows", "highs"))
        found = []
        for part, score in _blocks(anchors, rows, dims, primes) if rows.num_rows else ():
            value, at = ranked(score, own[part, None] != other, bound)
            for k in range(len(value)):
                a = part.start + k
                end = np.searchsorted(value[k], highs[a], "right")
                first = np.maximum(np.searchsorted(value[k], lows[a], "left"), end - wanted)
                for place, (lo, hi) in enumerate(zip(first.tolist(), end.tolist())):
                    if lo < hi:
                        found.append([np.full(hi - lo, a), np.full(hi - lo, place), at[k, lo:hi], value[k, lo:hi]])
        return _joined(found, rows, anchors)

    return run


def _dealt(rows: DataFrame, anchors: DataFrame, sizes: DataFrame | None, n: int, n_anchors: int, key: list[str]):
    """Anchors and rows, each repeated for the blocks of the other, grouped by cell."""

    def dealt(df: DataFrame, own: str, own_blocks: Column, other: str, other_blocks: Column) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("row"), own_blocks)).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), other_blocks - 1)))

    if sizes is None:
        row_blocks, anchor_blocks = (F.lit(max(-(-k // per), 1)).cast("long") for k, per in ((n, ROWS), (n_anchors, ANCHORS)))
    else:
        rows, anchors = rows.join(sizes, "label"), anchors.join(sizes, "label")
        row_blocks, anchor_blocks = F.col("row_blocks"), F.col("anchor_blocks")
    a = dealt(anchors, "anchor_block", anchor_blocks, "row_block", row_blocks).drop("row_blocks", "anchor_blocks")
    b = dealt(rows, "row_block", row_blocks, "anchor_block", anchor_blocks).drop("row_blocks", "anchor_blocks")
    return a.groupBy(*key, "anchor_block", "row_block"), b.groupBy(*key, "anchor_block", "row_block")


def components(vector: str = "embedding", scale: int = 256) -> Column:
    """Integer components of a vector."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))


def mine(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", label: Column | str = "label", anchor: Column | None = None,
         scale: int = 256, positives: int = 5, negatives: int = 3) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` tells anchors by the table's columns. A negative's score is from half to
    19 twentieths of the positive's.
    """
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    lab = F.col(label) if isinstance(label, str) else label
    length = F.aggregate(F.col(vector), F.lit(0.0), lambda t, x: t + F.pow(F.floor(x.cast("double") * scale).cast("double"), F.lit(2)))
    usable = vectors.where(lab.isNotNull() & F.col(vector).isNotNull()).where(finite)
    is_anchor = anchor if anchor is not None else F.col(id) % 50 == 0
    # vectors as long ones first: the bound decides whether they are put to use at all
    all_rows = stored(usable.select(
        F.col(id).cast("long").alias("id"), lab.cast("long").alias("label"), components(vector, scale).alias("vec"), length.alias("length"),
        F.coalesce(is_anchor & F.col(id).isNotNull(), F.lit(False)).alias("is_anchor")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = all_rows.agg(F.max("length").alias("length"), F.max(F.size("vec")).alias("dims"), F.count("*").alias("n"),
                        F.count_if("is_anchor").alias("anchors")).first()
    longest = size["length"] or 0.0
    if longest >= LIMIT:
        raise ValueError("vectors too long: scores need not fit 64 bits")
    # twice the rounding of the double sum is far below one part in a million
    bound, dims = int(longest * 1.000001) + 1, max(size["dims"] or 0, 1)
    primes = primes_for(bound, dims)
    rows = all_rows.select("row", "id", "label", "vec")
    anchors = all_rows.where("is_anchor").select(*(F.col(c).alias(c) for c in ("row", "id", "label", "vec")))  # columns of their own
    per_label = all_rows.groupBy("label").agg(
        F.ceil(F.count("*") / ROWS).cast("long").alias("row_blocks"), F.ceil(F.count_if("is_anchor") / ANCHORS).cast("long").alias("anchor_blocks")
    ).where("anchor_blocks > 0")
    a, b = _dealt(rows, anchors, per_label, size["n"], size["anchors"], ["label"])
    best = a.cogroup(b).applyInArrow(_best(dims, primes, bound, positives), _FOUND)
    first = lambda *by: Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    chosen = stored(best.withColumn("place", F.row_number().over(first("anchor"))).where(F.col("place") <= positives).where("score >= 0").select(
        "anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p")).select(
        F.col("anchor").alias("row"),
        # low = ceil(p / 2), high = floor(19 p / 20), written so that nothing overflows
        F.transform("p", lambda p: p["positive_score"] - F.shiftright(p["positive_score"], 1)).alias("lows"),
        F.transform("p", lambda p: p["positive_score"] - F.ceil(p["positive_score"].cast("decimal(20,0)") / 20).cast("long")).alias("highs"))
    a, b = _dealt(rows, anchors.join(windows, "row"), None, size["n"], size["anchors"], [])
    found = a.cogroup(b).applyInArrow(_window(dims, primes, bound, negatives), _FOUND)
    ranked_rows = found.withColumn("rank", F.row_number().over(first("anchor", "place"))).where(F.col("rank") <= negatives)
    # places count a window's positives from 0
    return ranked_rows.withColumn("place", F.col("place") + 1).join(chosen, ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


SQL = """
WITH kept AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM kept a JOIN kept r ON a.id % 50 = 0 AND a.id <> r.id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 3
"""
