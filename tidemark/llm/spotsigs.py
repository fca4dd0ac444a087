"""SpotSigs fingerprints: chains of content words that follow common words.

Every anchor (a common word of English, German, French or Spanish) starts a spot:
the anchor and the next two words that are no anchors, in lower case and without
ASCII marks. Where GAP words in a row hold no anchor, each further word starts a spot
until one comes, and so does each word of a text without any spot; other languages
and lists thus have fingerprints too. A text's fingerprint is the set of its spots'
32-bit hashes, sorted and written in base 64. A text without words has the hash of
itself, the empty text the empty fingerprint. Equal texts have equal fingerprints.

Sets are compared by Jaccard similarity, only where their lengths allow the
similarity asked for: length partitions are such that sets further apart than
neighbouring partitions cannot reach it.

Defined cases: a null text is an empty one; two empty sets are alike (1), an empty
and another are not (0); null ids are ordered last, equal ids by text; repeated
rows are rows of their own; the only row's next one is itself; an empty table gives
an empty result; other columns are ignored.

At scale: ``edited`` moves every text once, into ranges of ids that are sorted and
read as a stream, each with the first row of the range after it as its border.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import links
from tidemark.llm.common import Words, mixed, stored, text_of

# Common words that serve as anchors.
ANCHORS = (
    "a an the of and to in is was are be that it for on with as at by from this not but or have has had which his her they you "
    "der die das den dem des ein eine und ist war sind nicht mit von zu auf für im als auch sich es bei oder "
    "le la les un une des du de et est dans que qui pour par sur pas au aux avec ce il elle ou "
    "el los las una y en es por con para del se no su al lo como").split()
CHAIN = 2
GAP = 8
ROWS_PER_RANGE_CHARS = 1 << 24
MAX_RANGES = 1 << 14
NULL_ID = -(1 << 63)
CHUNK = 1 << 20

_ANCHOR_HASHES = np.unique(Words([" ".join(sorted(set(ANCHORS)))], lower=True).hash)


def _sets(texts: list[str]) -> list[np.ndarray]:
    words = Words(texts, lower=True, bare=True)
    n = len(words.hash)
    at = np.minimum(np.searchsorted(_ANCHOR_HASHES, words.hash), len(_ANCHOR_HASHES) - 1)
    anchor = _ANCHOR_HASHES[at] == words.hash
    content = np.flatnonzero(~anchor)
    since = np.arange(n) - np.maximum(np.maximum.accumulate(np.where(anchor, np.arange(n), -1)), np.repeat(words.first[:-1], words.counts) - 1) if n else np.zeros(0, np.int64)
    spot = np.flatnonzero(anchor | (since > GAP))
    place = np.searchsorted(content, spot, "right")  # the next content word

    def chain(start: np.ndarray, place: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, doc, length = words.hash[start].copy(), words.doc[start], np.zeros(len(start), np.int64)
        for k in range(CHAIN):
            p = np.minimum(place + k, max(len(of) - 1, 0))
            nxt = of[p] if len(of) else np.zeros(len(start), np.int64)
            ok = (place + k < len(of)) & (length == k)
            ok[ok] = words.doc[nxt[ok]] == doc[ok]
            h = np.where(ok, h * np.uint64(0x100000001B3) + words.hash[nxt] if len(of) else h, h)
            length += ok
        return mixed(h) >> np.uint64(32), length

    sig, length = chain(spot, place, content)
    keep = length == CHAIN
    doc = words.doc[spot][keep]
    sig = sig[keep]
    bare = np.ones(words.n_docs, bool)
    bare[doc] = False
    rest = np.flatnonzero(bare[words.doc]) if n else np.zeros(0, np.int64)
    if len(rest):  # texts without a spot: chains of neighbouring words
        more, _ = chain(rest, rest + 1, np.arange(n))
        sig, doc = np.concatenate([sig, more]), np.concatenate([doc, words.doc[rest]])
    key = np.unique((doc.astype(np.uint64) << np.uint64(32)) | sig)
    cut = np.searchsorted(key >> np.uint64(32), np.arange(words.n_docs + 1).astype(np.uint64))
    low = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out = [low[a:b] for a, b in zip(cut[:-1], cut[1:])]
    for k in np.flatnonzero((words.counts == 0)):
        if texts[k]:  # no words
            out[k] = np.array([int.from_bytes(hashlib.blake2b(texts[k].encode("utf-8", "surrogatepass"), digest_size=4).digest(), "big")], np.uint32)
    return out


def spot_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct spot hashes per text."""
    out: list[np.ndarray] = []
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t) + 1
        if size >= CHUNK or k == len(texts) - 1:
            out += _sets(texts[at : k + 1])
            at, size = k + 1, 0
    return out


def encoded(spots: np.ndarray) -> str:
    return base64.b64encode(spots.astype(">u4").tobytes()).decode("ascii")


def length_partition(size: np.ndarray, threshold: float) -> np.ndarray:
    """Sets that reach the threshold lie in the same or neighbouring partitions."""
    return np.floor(np.log(np.maximum(size, 1)) / -math.log(threshold)).astype(np.int64)


def likeness(left: list[np.ndarray], right: list[np.ndarray], threshold: float = 0.0) -> np.ndarray:
    """Jaccard similarity of each pair; pairs whose lengths rule the threshold out are 0 unseen."""
    a, b = (np.array([len(s) for s in side], np.int64) for side in (left, right))
    out = np.where((a == 0) & (b == 0), 1.0, 0.0)
    open_ = (a > 0) & (b > 0)
    if threshold > 0:
        open_ &= np.abs(length_partition(a, threshold) - length_partition(b, threshold)) <= 1
        open_ &= np.minimum(a, b) >= threshold * np.maximum(a, b)
    at = np.flatnonzero(open_)
    if len(at):
        both = np.concatenate([*(left[i] for i in at), *(right[i] for i in at)]).astype(np.uint64)
        pair = np.concatenate([np.repeat(np.arange(len(at)), a[at]), np.repeat(np.arange(len(at)), b[at])]).astype(np.uint64)
        key = np.sort((pair << np.uint64(32)) | both)
        common = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(32)).astype(np.int64), minlength=len(at))
        out[at] = common / (a[at] + b[at] - common)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for lo in range(0, len(texts), 512):
            sets = spot_sets(texts[lo : lo + 512])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, 512), pa.array([len(s) for s in sets], pa.int64()), pa.array([encoded(s) for s in sets]),
                pa.array([s.astype(np.uint64).tobytes() for s in sets], pa.binary())], ["doc_id", "n", "fingerprint", "items"])


def fingerprints(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (spots), fingerprint, items (sorted 64-bit spots as bytes) per row."""
    return docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(
        _sketch, "doc_id long, n long, fingerprint string, items binary")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id, n_links: documents connected by fingerprints that reach the threshold.

    Equal fingerprints are one class. A set's prefix (so many spots, in hash order,
    that sets without a common one cannot reach the threshold) meets the others of
    its and the next length partition; what met is one candidate cluster, inside which all are compared.
    """
    rows = stored(fingerprints(docs, id=id, text=text).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID))), "spots")
    classes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"),
                                                     F.first("items").alias("items"), F.first("n").alias("n")), "spot-classes")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                spots = np.frombuffer(raw, np.uint64)
                first = mixed(spots)[np.argsort(mixed(spots))][: len(spots) - math.ceil(threshold * len(spots) - 1e-9) + 1]
                part = int(length_partition(np.array([len(spots)]), threshold)[0])
                names = np.concatenate([mixed(first ^ np.uint64(p)) for p in (part, part + 1)])
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array([i] * len(names), pa.int64())], ["name", "id"])

    met = classes.where("n > 0").select("id", "items").mapInArrow(prefixes, "name long, id long")
    least = met.groupBy("name").agg(F.min("id").alias("b"), F.count("*").alias("size")).where("size > 1")
    clusters = links.components(met.join(least, "name").select(F.col("id").alias("a"), "b"))
    found = links.linked(classes.join(clusters, F.col("id") == F.col("node")).select(
        "id", F.col("root").alias("cluster"), F.col("copies").alias("weight"), "items"), threshold)
    own = classes.join(found, "id", "left").select(
        "fingerprint", F.coalesce("root", "id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.select("doc_id", "fingerprint").join(own, "fingerprint").select("doc_id", "class_id", "n_links")


_EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, border, doc_id, text), sorted, to results; a row's next one is the row after it in its part."""
    held: tuple | None = None  # part, border, doc_id, text, spots of the row before
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "border", "doc_id", "text")]
        for lo in range(0, batch.num_rows, 256):
            part, border, ids, texts = (c[lo : lo + 256] for c in columns)
            rows = list(zip(part, border, ids, texts, spot_sets(texts)))
            if held is not None:
                rows.insert(0, held)
            held = rows[-1]
            pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:]) if not a[1] and a[0] == b[0]]
            if not pairs:
                continue
            edited = [a[3][: len(a[3]) - len(a[3]) // 3] + b[3][: len(a[3]) // 3] for a, b in pairs]
            own, nxt, changed = [a[4] for a, _ in pairs], [b[4] for _, b in pairs], spot_sets(edited)
            yield pa.RecordBatch.from_arrays([
                pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]),
                pa.array([encoded(s) for s in own]), pa.array([encoded(s) for s in changed]),
                pa.array(likeness(own, changed)), pa.array(likeness(own, nxt))], [c.split()[0] for c in _EDITED.split(", ")])


def range_of(splits: np.ndarray, key: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Number of the range of (key, tie), ascending. A key that is a cut point m times is itself cut into
    m - 1 ranges by its ties."""
    low, high = np.searchsorted(splits, key, "left"), np.searchsorted(splits, key, "right")
    times = high - low
    own = np.floor((tie / 2.0**64 + 0.5) * np.maximum(times - 1, 0)).astype(np.int64)
    return np.where(times == 0, low, low + 1 + np.minimum(own, np.maximum(times - 2, 0)))


def edited(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of the text with its last third taken from the next document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text")).withColumn("key", F.coalesce("doc_id", F.lit(NULL_ID)))
    total = rows.agg(F.sum(F.length("text") + 100)).first()[0] or 0
    ranges = int(min(MAX_RANGES, max(1, total // ROWS_PER_RANGE_CHARS)))
    cuts = rows.agg(F.percentile_approx("key", [k / ranges for k in range(1, ranges)], max(10_000, 4 * ranges))).first()[0] if ranges > 1 else []
    splits = np.array(cuts or [], np.int64)  # a key that fills several ranges stands here several times

    @F.pandas_udf("long")
    def part_of(key, tie):
        import pandas as pd

        return pd.Series(len(splits) + 1 - range_of(splits, key.to_numpy(), tie.to_numpy()))

    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("part", part_of("key", "tie"))
    # one row per range, so at most MAX_RANGES: who comes first in it, and which range lies before
    firsts = rows.groupBy("part").agg(F.max(F.struct("key", "tie")).alias("f"))
    order = Window.orderBy("part")
    around = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("part", "f", F.coalesce(F.lag("part").over(order), F.last("part").over(around)).alias("before")).select(
        F.col("part").alias("f_part"), F.col("f.key").alias("f_key"), F.col("f.tie").alias("f_tie"), "before")
    borders = rows.join(F.broadcast(firsts), (F.col("part") == F.col("f_part")) & (F.col("key") == F.col("f_key")) & (F.col("tie") == F.col("f_tie")))
    borders = borders.groupBy(F.col("before").alias("part")).agg(F.min(F.struct("key", "text", "tie", "doc_id")).alias("r")).select(
        "part", F.lit(1).alias("border"), "r.doc_id", "r.text", "r.key", "r.tie")
    rows = rows.select("part", F.lit(0).alias("border"), "doc_id", "text", "key", "tie").unionByName(borders)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartition(max(n, ranges), "part").sortWithinPartitions("part", "border", F.desc("key"), F.desc("tie"))
    return sorted_.select("part", "border", "doc_id", "text").mapInArrow(_compare, _EDITED)
