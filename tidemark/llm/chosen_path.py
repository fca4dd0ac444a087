"""Similarity join on word n-grams by chosen paths.

A text is the set of its five-word shingles. Texts with equal sets form a class
at once. A class is embedded as min-hash tokens, of which two similar sets share
many; in every run a set follows the tokens that the run's hash of the path so far
selects, on average 1 / SHARE children a node. Sets that meet in a node split
further while it is large; small nodes are compared by brute force on the tokens.
Runs repeat until similar sets have met with the target probability. What met and
looks similar forms candidate clusters, and inside these every pair is compared on
the whole shingle sets.

A document's class id is the least id it is connected to by links (similarity of
the threshold or more), and ``n_links`` the number of other documents it links to,
copies included. Classes go by a 64-bit key made of the digests of their sets, never
by id: ids choose the row and the class id that are shown.

Defined cases: a null text is an empty one; texts without words are all copies of
each other; a text of fewer than five words has one shingle, all its words; null
ids count as the least id, and as the last one for the row that stays of a group;
rows with one id and different texts are different documents; repeated rows are
copies; an empty table gives an empty result; other columns are ignored.

At scale: texts are read twice, and moved once, for the sets of candidates only.
Nodes beyond the last level that are still large (more than LEAF sets that share
all tokens of a path) become one candidate cluster as a whole, so nothing is cut
off. Groups of copies cost one row per map task. Counting links needs as many
comparisons as a cluster of different texts has pairs; they are spread over cells
of two blocks.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import links
from tidemark.llm.common import Words, mixed, stored, text_of

WIDTH = 5
THRESHOLD = 0.8
TOKENS = 64
SHARE = 0.75  # each node has 1 / SHARE children on average
DEPTH = 3
LEAF = 64
RECALL = 0.9999
LOOKS_SIMILAR = 0.55  # five deviations of the min-hash estimate below the threshold
CHUNK = 1 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    base = mixed(np.arange(1, 2 * TOKENS + 1, dtype=np.uint64) * _GOLD)
    return base[:TOKENS] | np.uint64(1), base[TOKENS:]


def runs_for(recall: float, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met in some run with this probability."""
    met = 1.0
    for _ in range(depth):
        met = 1 - math.exp(-threshold / SHARE * met)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text."""
    out: list[np.ndarray] = []
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t) + 1
        if size >= CHUNK or k == len(texts) - 1:
            words = Words(texts[at : k + 1])
            h, doc = words.shingles(WIDTH)
            cut = np.searchsorted(doc, np.arange(words.n_docs + 1))
            out += [np.unique(h[a:b]) for a, b in zip(cut[:-1], cut[1:])]
            at, size = k + 1, 0
    return out


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests per set."""
    size = np.array([len(s) for s in sets], np.uint64)
    both = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.array([int(mixed(s ^ np.uint64(salt)).sum(dtype=np.uint64)) if len(s) else 0 for s in sets], np.uint64)
        both.append(mixed(total ^ (size * _GOLD)).view(np.int64))
    return both[0], both[1]


def tokens(sets: list[np.ndarray]) -> np.ndarray:
    """Min-hash tokens, one row per set (zeros for empty sets)."""
    out = np.zeros((len(sets), TOKENS), np.uint32)
    some = [i for i, s in enumerate(sets) if len(s)]
    if some:
        flat = np.concatenate([sets[i] for i in some])
        start = np.cumsum([0, *(len(sets[i]) for i in some)])[:-1]
        for k, (a, b) in enumerate(zip(*_multipliers())):
            out[some, k] = np.minimum.reduceat((flat * a + b) >> np.uint64(32), start).astype(np.uint32)
    return out


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for lo in range(0, len(texts), 512):
            sets = shingle_sets(texts[lo : lo + 512])
            d1, d2 = digests(sets)
            own = tokens(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, 512), batch.column(2).slice(lo, 512), pa.array(d1), pa.array(d2), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([r.tobytes() for r in own], pa.binary())], ["doc_id", "text_hash", "d1", "d2", "n", "tokens"])


def children(node: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) for the tokens that each row's node selects."""
    name = mixed(own.astype(np.uint64) + (np.arange(TOKENS, dtype=np.uint64) << np.uint64(32)) + _GOLD)
    child = mixed(name ^ node[:, None])
    row, k = np.nonzero(child < np.uint64(int((1 << 64) / (SHARE * TOKENS))))
    return row, mixed(child[row, k] ^ _GOLD)


def _descend(runs: int):
    """Arrow batches of (id, tokens[, node]) to rows (node, id), one level further down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = mixed(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                b = batch.slice(lo, 2048)
                ids = b.column(0).to_numpy()
                own = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, TOKENS)
                nodes = [b.column(2).to_numpy().view(np.uint64)] if b.num_columns > 2 else [np.full(len(ids), s) for s in starts]
                for node in nodes:
                    row, child = children(node, own)
                    yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(ids[row])], ["node", "id"])

    return run


def _brute_force(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, id, tokens) sorted by node to edges (a, b) that connect what looks similar."""
    for t in links.segments(batches, ["node"]):
        cut, ids = links.group_starts(t, ["node"]), t.column("id").to_numpy()
        own = np.frombuffer(b"".join(t.column("tokens").to_pylist()), np.uint32).reshape(-1, TOKENS)
        size = np.diff(cut)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        two = cut[:-1][size == 2]  # most nodes: all at once
        near = (own[two] == own[two + 1]).mean(1) >= LOOKS_SIMILAR
        found.append((ids[two[near]], ids[two[near] + 1]))
        for a, b in zip(cut[:-1][size > 2], cut[1:][size > 2]):
            own_, ids_ = own[a:b], ids[a:b]
            root = links.roots((own_[:, None, :] == own_[None, :, :]).mean(2) >= LOOKS_SIMILAR)
            found.append((ids_, ids_[root]))
        a, b = (np.concatenate(x) for x in zip(*found))
        apart = a != b
        yield pa.RecordBatch.from_arrays([pa.array(a[apart]), pa.array(b[apart])], ["a", "b"])


def candidates(reps: DataFrame, recall: float = RECALL) -> DataFrame:
    """id, cluster for the ids of ``id, tokens`` that met something similar."""
    edges = None
    rows = reps.select("id", "tokens").mapInArrow(_descend(runs_for(recall)), "node long, id long")
    for depth in range(1, DEPTH + 1):
        rows = stored(rows, f"paths-{depth}")
        met = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("id").alias("least")).where("size > 1")
        rows = stored(rows.join(met, "node"), f"nodes-{depth}")
        leaf = rows.where(F.col("size") <= LEAF).join(reps, "id").select("node", "id", "tokens").repartition("node").sortWithinPartitions("node")
        found = leaf.mapInArrow(_brute_force, "a long, b long")
        if depth == DEPTH:
            found = found.unionByName(rows.where(F.col("size") > LEAF).select(F.col("id").alias("a"), F.col("least").alias("b")).where("a != b"))
        edges = found if edges is None else edges.unionByName(found)
        large = rows.where(F.col("size") > LEAF)
        if depth == DEPTH or large.isEmpty():
            break
        rows = large.join(reps, "id").select("id", "tokens", "node").mapInArrow(_descend(1), "node long, id long")
    return links.components(edges.distinct()).select(F.col("node").alias("id"), F.col("root").alias("cluster"))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of (id, text, cluster, weight, d1, d2) to their sets, if the text is the one meant."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for lo in range(0, len(texts), 256):
            b = batch.slice(lo, 256)
            sets = shingle_sets(texts[lo : lo + 256])
            d1, d2 = digests(sets)
            meant = (d1 == b.column(4).to_numpy()) & (d2 == b.column(5).to_numpy())
            out = pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             ["id", "cluster", "weight", "items"])
            yield out.filter(pa.array(meant))


def _classes(docs: DataFrame, id: str, text: str, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and the classes of equal sets with links and ``root``, the least key they are connected to.

    Of a class's rows ``least`` is the first by id and ``keep`` the first by id with null ids last,
    both with the hash of their text.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    sketches = stored(rows.mapInArrow(sketch, "doc_id long, text_hash long, d1 long, d2 long, n long, tokens binary"), "sketches")
    classes = stored(sketches.groupBy("d1", "d2").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("least"), F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "text_hash")).alias("keep"),
        F.count("*").alias("copies"), F.max("n").alias("n"), F.first("tokens").alias("tokens")).withColumn("id", F.xxhash64("d1", "d2")), "classes")
    reps = classes.where("n > 0").select("id", "tokens")
    clusters = candidates(reps, recall)
    wanted = classes.where("n > 0").join(clusters, "id").select(
        "id", "cluster", F.col("copies").alias("weight"), "d1", "d2", F.col("least.doc_id").alias("of_id"), F.col("least.text_hash").alias("of_hash"))
    # one text of each class: all rows with its id and text
    meant = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
    sets = rows.join(wanted, meant).select("id", "text", "cluster", "weight", "d1", "d2").mapInArrow(
        _exact, "id long, cluster long, weight long, items binary").dropDuplicates(["id", "items"])
    found = links.linked(sets, threshold)
    return sketches, classes.drop("tokens").join(found, "id", "left").withColumn("root", F.coalesce("root", "id"))


def similar(docs: DataFrame, *, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links for every row."""
    sketches, classes = _classes(docs, id, text, threshold, recall)
    classes = classes.select("d1", "d2", "root", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    shown = classes.groupBy("root").agg(F.min("least").getField("doc_id").alias("class_id"))
    of_class = classes.join(shown, "root").select("d1", "d2", "class_id", "n_links")
    return sketches.select("doc_id", "d1", "d2").join(of_class, ["d1", "d2"]).select("doc_id", "class_id", "n_links")


def distinct(docs: DataFrame, *, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row of each class, unchanged: that of the least id, null ids last, and of rows with equal ids the first by text."""
    _, classes = _classes(docs, id, text, threshold, recall)
    chosen = classes.groupBy("root").agg(F.min("keep").alias("keep")).select(F.col("keep.doc_id").alias("keep_id"), F.col("keep.text_hash").alias("keep_hash"))
    row = docs.select(F.col(id).cast("long").alias("row_id"), F.xxhash64(text_of(text)).alias("row_hash"), F.struct("*").alias("row"))
    kept = row.join(chosen, F.col("row_id").eqNullSafe(F.col("keep_id")) & (F.col("row_hash") == F.col("keep_hash")), "left_semi")
    # rows with one id and one text are copies
    first = Window.partitionBy("row_id", "row_hash").orderBy("row_hash")
    return kept.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
