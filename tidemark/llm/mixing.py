"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source is dealt into shards, every shard's documents are laid end to end
in a seeded order and cut into blocks of (nearly) equal numbers of words. Seats,
one per block, go to sources by highest quotients target / (2k + 1), then in each
source to its shards by the same rule; a shard's quota q over its n blocks takes
every block q // n times and q mod n seeded blocks once more. A document takes
the words of its part of each taken block, so no document repeats more than the
most-taken block does.

Whole copies are the same shares rounded along the documents of a source: size
class by size class, in a seeded order, a document gets one copy more than its
whole part where the running sum of the fractions passes the next half. So every
document has the whole number below or above taken / size, a source's copies times
sizes differ from what it takes by about its largest documents, and which documents
are left out or repeated is a seeded choice, at any size of blocks.

Defined cases: a null text has size 0; size 0 takes 0; a null source is a source
of its own, ordered last; a null id is an id like any other; repeated rows are
documents of their own; an empty table gives an empty result. All other columns
are ignored, whatever their names.

At scale: one pass over the texts yields (id, source, size); all that follows
moves those small rows. The driver sees one row per source (a mixture names its
sources) and at most MAX_SHARDS + sources shard sizes; for whole copies one sum for
each shard and size class (four to a doubling). Rows are dealt into shards by id and text, so shards
have similar sizes however hot their source is, also where ids are null or repeat: a window is about total / MAX_SHARDS,
or one row's copies in every column.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of, word_count

WEIGHTS = (5, 2, 1)
MAX_SHARDS = 4096
BLOCKS_PER_SHARD = 1024
FEW_SOURCES = 100_000
BLOCK_WORDS = 16  # words of a block, at any size of the input


@dataclass(frozen=True)
class Mixture:
    """What a mix asks for: cycling weights by source order, size, repeat limit."""

    weights: tuple[float, ...] = WEIGHTS
    share: float = 1.5
    max_repeats: int = 2
    seed: int = 20240229


def source_targets(sizes: Sequence[int], weights: Sequence[float], share: float, repeats: int) -> list[float]:
    """Words each source should give: by weight, none above ``repeats`` times its size."""
    left, targets = share * sum(sizes), [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > repeats * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = unit * weights[i]
            break
        for i in full:
            targets[i] = float(repeats * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def apportion(weights: Sequence[float], seats: int, limits: Sequence[int]) -> np.ndarray:
    """Seats by highest quotients weight / (2k + 1), none above its limit.

    Most seats come from one divisor that cannot give too many; the rest, at most
    one per party, are dealt singly. Ties go to the earlier party.
    """
    w, top = np.asarray(weights, float), np.asarray(limits, np.int64)
    out = np.zeros(len(w), np.int64)
    if not len(w) or w.sum() <= 0:
        return out
    seats = min(int(seats), int(top[w > 0].sum()))
    fixed = np.zeros(len(w), bool)
    while True:
        free = ~fixed & (w > 0)
        room = seats - int(out[fixed].sum())
        n = int(free.sum())
        if not n:
            return out
        divisor = w[free].sum() / max(room - n / 2, 0.5)
        out[free] = np.floor(w[free] / divisor + 0.5).astype(np.int64) if room > n / 2 else 0
        if (over := free & (out > top)).any():
            out[over], fixed = top[over], fixed | over
            continue
        queue = [(-w[i] / (2 * out[i] + 1), i) for i in np.flatnonzero(free) if out[i] < top[i]]
        heapq.heapify(queue)
        for _ in range(room - int(out[free].sum())):
            _, i = heapq.heappop(queue)
            out[i] += 1
            if out[i] < top[i]:
                heapq.heappush(queue, (-w[i] / (2 * out[i] + 1), i))
        return out


def _stride(n: int, seed: int) -> int:
    """A number coprime to n, so that j -> stride * j mod n visits every block once."""
    a = (seed * 2654435761 + n) % n if n > 1 else 1
    a = max(a, 1)
    while math.gcd(a, n) != 1:
        a += 1
    return a


def mix(docs: DataFrame, mixture: Mixture = Mixture(), *, id: str = "doc_id", text: str = "text",
        source: str = "source", carry: bool = False, whole: bool = True, block: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies per document.

    ``copies`` is for users who repeat whole documents: taken / size, rounded down or up
    so that each source's copies meet what it takes. Without ``whole`` it is left out.
    With ``carry`` the whole input row comes along as struct column ``row``.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id).alias("doc_id"), F.col(source).cast("string").alias("src"),
                       word_count(text_of(text)).alias("size"), F.xxhash64(F.col(id), text_of(text)).alias("key"), *([F.struct("*").alias("row")] if carry else []))
    light = stored(base.select("doc_id", "src", "size", "key"), "mix-sizes")
    if not carry:
        base = light
    found = {r["src"]: int(r["n"]) for r in light.groupBy("src").agg(F.sum("size").alias("n")).collect()}
    names = sorted((s for s in found if s is not None)) + ([None] if None in found else [])
    sizes = [found[s] for s in names]
    weights = [mixture.weights[i % len(mixture.weights)] for i in range(len(names))]
    targets = source_targets(sizes, weights, mixture.share, mixture.max_repeats)
    total = sum(sizes)
    per_shard = max(BLOCKS_PER_SHARD * block, -(-total // MAX_SHARDS))
    shards = [max(1, round(s / per_shard)) for s in sizes]
    plan = spark.createDataFrame(
        [(i, n, s, k, t) for i, (n, s, k, t) in enumerate(zip(names, sizes, shards, targets))],
        "src_no int, src_name string, source_size long, n_shards long, target double")

    def dealt(df: DataFrame) -> DataFrame:
        # one row per source on the right, broadcast if they are few; id and text deal the rows, so that one id for
        # many texts is no hot shard
        return df.join(F.broadcast(plan) if len(names) <= FEW_SOURCES else plan, F.col("src").eqNullSafe(F.col("src_name"))).withColumn(
            "shard", F.pmod(F.xxhash64("key", F.lit(mixture.seed)), F.col("n_shards")))

    found_shards = dealt(light).groupBy("src_no", "shard").agg(F.sum("size").alias("n")).collect()
    cells = sorted((r["src_no"], r["shard"], int(r["n"])) for r in found_shards)
    blocks = {(i, k): max(1, round(n / block)) if n else 0 for i, k, n in cells}
    in_source = [0] * len(names)
    for (i, _), v in blocks.items():
        in_source[i] += v
    own = [t * n / s if s else 0.0 for t, n, s in zip(targets, in_source, sizes)]
    seats = apportion(own, round(sum(own)), [mixture.max_repeats * n for n in in_source])
    quotas = []
    bounds = np.searchsorted(np.array([i for i, _, _ in cells], np.int64), np.arange(len(names) + 1)) if cells else np.zeros(len(names) + 1, int)
    for j in range(len(names)):
        mine = cells[bounds[j] : bounds[j + 1]]
        counts = [blocks[j, k] for _, k, _ in mine]
        for (_, k, n), m, q in zip(mine, counts, apportion(counts, int(seats[j]), [mixture.max_repeats * c for c in counts])):
            quotas.append((j, k, n, m, int(q), _stride(m, mixture.seed + j) if m else 1, (mixture.seed * 31 + j * 17 + k) % max(m, 1)))
    quota = spark.createDataFrame(
        quotas, "q_src int, q_shard long, shard_size long, n_blocks long, quota long, stride long, shift long")

    order = Window.partitionBy("src_no", "shard").orderBy(
        F.xxhash64("key", F.lit(mixture.seed + 1)), "key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)

    def taken(df: DataFrame) -> DataFrame:
        placed = dealt(df).withColumn("lo", F.coalesce(F.sum("size").over(order), F.lit(0)))
        # at most MAX_SHARDS + sources rows on the right
        placed = placed.join(F.broadcast(quota), (F.col("src_no") == F.col("q_src")) & (F.col("shard") == F.col("q_shard")))
        return placed.withColumn("taken", F.expr(_TAKEN))

    mixed = taken(base)
    if whole:
        mixed = _with_copies(mixed, taken(light), mixture.seed)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", *(["copies"] if whole else []), *(["row"] if carry else []))


def _with_copies(mixed: DataFrame, light: DataFrame, seed: int) -> DataFrame:
    """Column ``copies``; ``light`` has the same documents without their rows."""
    group = ["src_no", "size_class", "shard"]

    def split(df: DataFrame) -> DataFrame:
        return df.withColumn("size_class", F.expr(_CLASS)).withColumn("part", F.expr(_PART))

    sums = split(light).groupBy(group).agg(F.sum("part").alias("n")).where("n > 0").toArrow()
    keys = [sums.column(c).to_numpy() for c in group]
    by_group = np.lexsort(keys[::-1])
    src, size_class, shard = (k[by_group] for k in keys)
    n = sums.column("n").to_numpy()[by_group]
    before = np.cumsum(n & (_ONE - 1)) - (n & (_ONE - 1))
    first = np.searchsorted(src, src)  # each source starts at a half
    start = (before - before[first] + _ONE // 2) & (_ONE - 1)
    starts = mixed.sparkSession.createDataFrame(
        pa.table({"s_src": src, "s_class": size_class, "s_shard": shard, "start": start}))
    order = Window.partitionBy("src_no", "shard", "size_class").orderBy(
        F.xxhash64("key", F.lit(seed + 2)), "key", "doc_id", "size", "taken").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most one row per shard and size class on the right
    placed = split(mixed).join(F.broadcast(starts), (F.col("src_no") == F.col("s_src")) & (F.col("size_class") == F.col("s_class"))
                               & (F.col("shard") == F.col("s_shard")), "left")
    placed = placed.withColumn("sum_part", F.sum("part").over(order) + F.coalesce("start", F.lit(0)))
    return placed.withColumn("copies", F.expr(_COPIES))


# The fraction of taken / size in units of 1 / _ONE, and the next whole number that the running sum passes.
_ONE = 1 << 32
_CLASS = "CASE WHEN size > 0 THEN CAST(floor(4 * log2(size)) AS INT) ELSE -1 END"
_PART = f"CASE WHEN size > 0 THEN ((taken % size) * {_ONE}L) div size ELSE 0L END"
_COPIES = f"""CAST(CASE WHEN size > 0
  THEN taken div size + sum_part div {_ONE}L - (sum_part - part) div {_ONE}L ELSE 0 END AS INT)"""

# Blocks j of a shard cover [floor(j L / n), floor((j + 1) L / n)); x lies in block floor(((x + 1) n - 1) / L).
_TAKEN = """
CASE WHEN size = 0 THEN 0L ELSE size * (quota div n_blocks) + aggregate(
  sequence(((lo + 1) * n_blocks - 1) div shard_size, ((lo + size) * n_blocks - 1) div shard_size),
  0L,
  (sum, j) -> sum + IF((j * stride + shift) % n_blocks < quota % n_blocks,
    least(lo + size, ((j + 1) * shard_size) div n_blocks) - greatest(lo, (j * shard_size) div n_blocks), 0L))
END"""


def repeated(docs: DataFrame, mixture: Mixture = Mixture(), **columns: str) -> DataFrame:
    """The mixed documents themselves: each as often as the mix takes it, in whole copies."""
    mixed = mix(docs, mixture, carry=True, **columns).where("copies > 0")
    return mixed.select("row", F.explode(F.expr("sequence(1, copies)")).alias("n")).select("row.*")
