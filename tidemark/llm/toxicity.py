"""Toxicity: a linear model over character n-grams, scaled by naive Bayes ratios.

Features are the character n-grams (3 to 6, folded case, blanks included) that a
text holds. Their log-count ratio r between toxic and clean training texts scales
them; a logistic model over the scaled features, started at plain naive Bayes
(all weights one) and held near it, gives the score. N-grams whose ratio is near zero carry
nothing and are left out of the model, so scoring a text costs a table lookup per
character and order, and only the few n-grams left count, each once per text.

Training labels come from at most ``max_rows`` labelled texts (a parameter; chosen
by hash, all of them where there are fewer). Counting runs as Spark tasks; the
driver gets one row per feature kept, whose number the sample bounds, and the sparse
presence rows of the sample.

Defined cases: a null or empty text has no n-grams and gets the score of the bias;
labels that are null, and label rows without a document, are left out; if either class is missing
the score is the training share of toxic texts (0 without any); repeated rows are
scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chars import CharTexts, fold_table, gram_hash
from tidemark.llm.common import id_remainder, stored, text_of

ORDERS = (3, 4, 5, 6)
BITS = 22
MAX_ROWS = 20_000
MIN_TEXTS = 5
MIN_RATIO = 0.5
MIN_Z = 4.0
SMOOTH = 1.0
CHUNK = 1 << 19


@dataclass(frozen=True)
class Model:
    """Weight per feature id, where feature 0 is 'not in the model'."""

    feature: np.ndarray  # hash bucket -> feature id
    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str | None], table: np.ndarray) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for doc, feature in presence(texts, table, self.feature):
            out += np.bincount(doc, weights=self.weight[feature], minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about CHUNK characters."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= CHUNK:
            yield at, texts[at : k + 1]
            at, size = k + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def presence(texts: list[str | None], table: np.ndarray, feature: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) pairs, each once; hash buckets are the features if none are given."""
    mask = np.uint64((1 << BITS) - 1)
    for base, some in _slices(texts):
        chars, found = CharTexts(some, table), []
        for n in ORDERS:
            bucket = (gram_hash(chars.codes, n) & mask).astype(np.int64)
            same = chars.doc[: len(bucket)] == chars.doc[n - 1 : n - 1 + len(bucket)]
            if feature is None:
                at, value = np.flatnonzero(same), bucket
            else:
                value = feature[bucket]
                at = np.flatnonzero((value > 0) & same)
            found.append((chars.doc[at].astype(np.int64) << 32) | value[at].astype(np.int64))
        pairs = np.unique(np.concatenate(found))
        yield base + (pairs >> 32), pairs & 0xFFFFFFFF


def bucket_counts(table: np.ndarray):
    """Arrow batches of (text, label) to rows (bucket, texts, toxic texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for doc, bucket in presence(batch.column(0).to_pylist(), table, None):
                for y in (0, 1):
                    np.add.at(counts[y], bucket[label[doc] == y], 1)
        some = np.flatnonzero(counts.sum(0))
        for k in range(0, len(some), 50_000):
            at = some[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0, at].astype(np.int64)), pa.array(counts[1, at].astype(np.int64))], ["bucket", "clean", "toxic"])

    return run


def _fit(rows: list[np.ndarray], label: np.ndarray, ratio: np.ndarray, rounds: int = 300, held: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic weights over ratio-scaled presence, pulled towards one; Adam on all rows."""
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feat = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
    # the last entry is the bias, whose scale is one
    scale = np.append(ratio, 1.0)
    weight, prior = np.append(np.ones(len(ratio)), 0.0), np.append(np.ones(len(ratio)), 0.0)
    pull = np.append(np.full(len(ratio), held / len(rows)), 0.0)
    first, second = np.zeros(len(weight)), np.zeros(len(weight))
    for t in range(1, rounds + 1):
        w = weight * scale
        score = w[-1] + np.bincount(doc, weights=w[feat], minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - label) / len(rows)
        slope = np.append(np.bincount(feat, weights=error[doc], minlength=len(ratio)), error.sum()) * scale + pull * (weight - prior)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        weight = weight - 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return (weight * scale)[:-1], float(weight[-1])


def fit(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic",
        max_rows: int = MAX_ROWS, seed: int = 3) -> Model:
    """A model from the labelled documents given (held-out ones must be gone already)."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(id).alias("label_id")).agg(F.max(label).cast("int").alias("y"))
    total = known.count()
    if total > max_rows:  # by hash of the id, so reruns agree
        known = known.where(F.pmod(F.xxhash64("label_id", F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * max_rows / total))
    rows = docs.select(F.col(id).cast("long").alias("label_id"), text_of(text).alias("text")).join(known, "label_id").select("text", "y")
    rows = stored(rows, "toxic-sample")
    table = fold_table()
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(n) < 2:
        share = min(max(n.get(1, 0) / max(sum(n.values()), 1), 1e-9), 1 - 1e-9)
        return Model(np.zeros(1 << BITS, np.int32), np.zeros(1), float(np.log(share / (1 - share))))
    counts = rows.mapInArrow(bucket_counts(table), "bucket long, clean long, toxic long").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    p = (F.col("toxic") + SMOOTH) / (n[1] + 2 * SMOOTH)
    q = (F.col("clean") + SMOOTH) / (n[0] + 2 * SMOOTH)
    deviation = F.sqrt(1 / (F.col("clean") + SMOOTH) + 1 / (F.col("toxic") + SMOOTH))
    kept = counts.where(F.col("clean") + F.col("toxic") >= MIN_TEXTS).withColumn("ratio", F.log(p / q)).where(
        (F.abs("ratio") >= MIN_RATIO) & (F.abs("ratio") >= MIN_Z * deviation))
    chosen = kept.select("bucket", "ratio").toArrow().sort_by("bucket")
    feature = np.zeros(1 << BITS, np.int32)
    feature[chosen.column("bucket").to_numpy()] = np.arange(1, len(chosen) + 1)
    ratio = np.append(0.0, chosen.column("ratio").to_numpy())

    def held_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[] for _ in range(batch.num_rows)]
            for doc, feat in presence(batch.column(0).to_pylist(), table, feature):
                cut = np.searchsorted(doc, np.arange(doc[0], doc[-1] + 2)) if len(doc) else []
                for k in range(len(cut) - 1):
                    found[int(doc[0]) + k] = feat[cut[k] : cut[k + 1]].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([np.asarray(f, np.int32).tobytes() for f in found], pa.binary())], ["y", "found"])

    sample = rows.mapInArrow(held_features, "y int, found binary").toArrow()
    found = [np.frombuffer(f.as_buffer(), np.int32) for f in sample.column("found")]
    weight, bias = _fit(found, sample.column("y").to_numpy().astype(float), ratio)
    return Model(feature, weight, bias)


def score(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted for every row."""
    table = fold_table()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = shared.value.scores(batch.column(1).to_pylist(), table)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(value), pa.array((value >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(
        run, "doc_id long, score double, predicted int")


def split_off(docs: DataFrame, id: str = "doc_id", modulus: int = 5, remainder: int = 0) -> DataFrame:
    """The rows that may be learned from."""
    return docs.where(id_remainder(id, modulus) != remainder)
