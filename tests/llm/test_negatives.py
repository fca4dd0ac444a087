"""Hard negatives: products by residues against integers, mining against a plain version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import negatives

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    # names the operator uses itself
    T.StructField("row", T.StringType()), T.StructField("vec", T.StringType()), T.StructField("place", T.StringType()), T.StructField("length", T.StringType())])


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


def plain(rows):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows
            if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (i, v, y) in enumerate(kept):
        if i is None or i % 50:
            continue
        score = [(-sum(a * b for a, b in zip(v, w)), (j is None, j or 0), j, z) for m, (j, w, z) in enumerate(kept) if m != k]
        score.sort(key=lambda s: s[:2])
        positives = [s for s in score if s[3] == y][:5]
        for p in positives:
            low, high = 50 * -p[0], 95 * -p[0]
            hits = [s for s in score if s[3] != y and low <= 100 * -s[0] <= high][:3]
            out += [(i, p[2], r + 1, s[2], -p[0], -s[0]) for r, s in enumerate(hits)]
    return sorted(out, key=str)


def mined(df):
    return sorted((tuple(r) for r in negatives.mine(df).collect()), key=str)


def some(seed, n, dims=8, labels=3, scale=1.0):
    r = random.Random(seed)
    return [(k, [r.gauss(0.2, 1) * scale for _ in range(dims)], r.choice([0] * 4 + list(range(labels)))) for k in range(n)]


@pytest.mark.parametrize("dims,high", [(1, 3), (64, 200), (300, 1 << 15), (5000, 40), (7, 1 << 29)])
def test_products_by_residues_are_exact(dims, high):
    r = np.random.default_rng(dims)
    a, b = r.integers(-high, high, (5, dims)), r.integers(-high, high, (9, dims))
    exact = a.astype(object) @ b.astype(object).T
    bound = int(max((m.astype(object) ** 2).sum(1).max() for m in (a, b)))
    primes = negatives.primes_for(bound, dims)
    assert math.prod(primes) > 2 * bound + 1 and len(primes) > 1
    got = negatives.scores(negatives.residues(a, primes), negatives.residues(b, primes), primes)
    assert (got == exact).all()


def test_every_signed_value_is_restored():
    primes = [7, 5, 11]
    every = np.arange(-192, 193)
    assert (negatives.combined([negatives.balanced(every, p) for p in primes], primes) == every).all()


@pytest.mark.parametrize("bound", [100, 1 << 61])
def test_ranks_ties_by_place(bound):
    score = np.array([[5, 7, 7, -3, 7, 5]])
    value, at = negatives.ranked(score, np.array([[True, True, True, True, True, False]]), bound)
    assert at[0, ::-1][:4].tolist() == [1, 2, 4, 0] and value[0, -5:].tolist() == [-3, 5, 7, 7, 7]


def test_equals_a_plain_version(spark):
    rows = some(1, 400)
    assert len(mined(table(spark, rows))) > 50
    assert mined(table(spark, rows)) == plain(rows)


def test_cells_of_any_size_and_a_hot_label(spark, monkeypatch):
    rows = some(2, 600) + [(k, [0.5] * 8, 0) for k in range(600, 900)]  # a third are one vector
    whole = plain(rows)
    monkeypatch.setattr(negatives, "ROWS", 37)
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    assert mined(table(spark, rows).repartition(5)) == whole


def test_odd_rows(spark, monkeypatch):
    rows = some(3, 200) + [
        (1000, None, 1), (1050, [1.0] * 8, None), (None, [1.0] * 8, 0), (None, [1.0] * 8, 0), (1100, [1.0, None] + [1.0] * 6, 0),
        (1150, [float("nan")] * 8, 0), (1200, [float("inf")] * 8, 0), (1250, [], 0), (1300, [1.0, 2.0], 0), (1350, [0.0] * 8, 1),
        (50, [1.0] * 8, 0), (50, [1.0] * 8, 0), (1400, [100.0] * 8, 7), (1450, [-1.0] * 12, 2)]
    monkeypatch.setattr(negatives, "ROWS", 64)
    assert mined(table(spark, rows)) == plain(rows)


def test_large_components_and_too_large_ones(spark):
    rows = some(4, 150, scale=3e5)
    assert mined(table(spark, rows)) == plain(rows)
    with pytest.raises(ValueError, match="64 bits"):
        negatives.mine(table(spark, [(0, [1e30], 1), (1, [1.0], 1)]))


def test_nothing_to_find(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(0, [1.0], 1), (50, [1.0], 2)])) == []


def test_given_table_and_changed_labels(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in df.collect()]
    assert sorted((tuple(r) for r in negatives.mine(df, label=label).collect()), key=str) == plain(rows)
