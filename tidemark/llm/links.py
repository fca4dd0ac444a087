"""Links between similar sets: exact counting inside candidate clusters, and components.

``components`` labels connected components of an edge list that never meets in
one place. ``linked`` counts, for every set of a candidate cluster, the sets whose
Jaccard similarity reaches a threshold, by comparing blocks with blocks: no pair
of sets leaves a task, only a count and a local component per set. A cluster of m
sets needs m * m / (2 * BLOCK) rows and as many comparisons as it has pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BLOCK = 512
COLUMNS = 4096


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node it is connected to) for all nodes of ``a long, b long``.

    Alternates large and small stars; each round is stored, and the number of
    rounds grows with the logarithm of the longest path.
    """
    now = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = stored(now, "edges"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                              F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        now = stored(small.where("a != b").distinct(), "edges")


def segments(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows with equal keys from a stream sorted by them; several per table."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1 if b.num_rows > 1 else np.zeros(0, int)
        if held:
            last = held[-1]
            if any(last.column(k)[-1].as_py() != b.column(k)[0].as_py() for k in keys):
                yield pa.Table.from_batches(held)
                held = []
        if len(change):
            yield pa.Table.from_batches([*held, b.slice(0, int(change[-1]))])
            held = [b.slice(int(change[-1]))]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    cols = [table.column(k).to_numpy() for k in keys]
    first = np.ones(table.num_rows, bool)
    first[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return np.append(np.flatnonzero(first), table.num_rows)


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at ``left`` with those at ``right``."""
    size = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), size)
    _, column, times = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    row, column = row[shared], column[shared]
    names, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, len(names), COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        x = np.zeros((len(sets), min(COLUMNS, len(names) - lo)), np.float32)
        x[row[a:b], column[a:b] - lo] = 1
        out += x[left] @ x[right].T
    return out


def roots(linked: np.ndarray) -> np.ndarray:
    """Least index each index is connected to."""
    label = np.arange(len(linked))
    near = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(near, label[None, :], len(label)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _cell(ids: np.ndarray, block: np.ndarray, weight: np.ndarray, sets: list[np.ndarray], lo: int, hi: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(s) for s in sets], float)
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    near = np.zeros((len(ids), len(ids)), bool)
    if len(left) and len(right):
        common = overlaps(sets, left, right)
        found = common * (1 + threshold) >= threshold * (size[left][:, None] + size[right][None, :]) - 1e-6
        near[np.ix_(left, right)] |= found
        near[np.ix_(right, left)] |= found.T
    np.fill_diagonal(near, False)
    return near @ weight, ids[roots(near)]


def linked(sets: DataFrame, threshold: float) -> DataFrame:
    """id, links, root from ``id, cluster, weight, items`` (sorted 64-bit items as bytes).

    ``links`` adds up the weights of the other sets of the cluster that reach the
    threshold; ``root`` is the least id connected through such links.
    """
    sizes = sets.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    rows = sets.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "blocks", "id", "weight", "items")
    keys = ["cluster", "lo", "hi"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in segments(batches, keys):
            cut = group_starts(t, keys)
            lo, hi, block, blocks, ids, weight = (t.column(c).to_numpy() for c in ("lo", "hi", "block", "blocks", "id", "weight"))
            items = t.column("items").to_pylist()
            links, root = np.zeros(len(ids), np.int64), ids.copy()
            for a, b in zip(cut[:-1], cut[1:]):
                if b - a > 1:
                    order = np.argsort(ids[a:b])
                    at = a + order
                    n, r = _cell(ids[at], block[at], weight[at], [np.frombuffer(items[k], np.uint64) for k in at], lo[a], hi[a], threshold)
                    links[at], root[at] = n, r
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(root), pa.array(blocks)], ["id", "links", "root", "blocks"])

    found = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "id long, links long, root long, blocks int")
    found = stored(found, "links")
    one = found.where("blocks = 1").select("id", "links", "root")
    many = found.where("blocks > 1")
    joined = components(many.select(F.col("id").alias("a"), F.col("root").alias("b")))
    total = many.groupBy("id").agg(F.sum("links").alias("links"))
    spread = total.join(joined, F.col("id") == F.col("node"), "left").select("id", "links", F.coalesce("root", "id").alias("root"))
    return one.unionByName(spread)
