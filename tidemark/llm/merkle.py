"""Merkle manifest of a dataset, with a witness per row that leads to one root.

Rows are leaves, in order within their group; a tree per group gives a subroot, and
the subroots, in order of their groups, give the root in the same way. Wherever more
than one node remains on a level, every two consecutive ones become their hash, and
a last single one becomes its own.

Trees grow by appending. An ``Appender`` keeps the complete subtrees that are still
open, each with the partial witnesses of the nodes under it. A node appended next to
an open subtree of its height completes a larger one: the nodes on either side get
the other side's root as the next entry of their witness. Leaves are dealt over
blocks of ``2 ** BITS`` aligned places and appended block by block in tasks; the
roots of the blocks are further appends, of the next layer, until a group has
one. Coming down, the witness of a block's root extends those of the nodes in it.

A witness is text: per level ``L`` or ``R`` and the sibling's digest (which side it is
on), or ``-`` where there is none; it leads from the leaf through the subroot to the root.

Defined cases: every row is a leaf, repeated rows too; rows with equal order values
stand in order of their digests; a null group is a group of its own, and comes first; null
order values come first; an empty table gives an empty result; columns not named in
the leaf do not matter.

At scale: texts are hashed where they are read. After that a row is its key and two digests. Places
come from one range partitioning over (group, order, digest, number of the row), which cuts
groups and copies of any size, and from running sums over its partitions. No
task holds more than a block, and layers shrink 4096-fold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BITS = 12
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "grp long, pos long, total long, digest string"


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


class Appender:
    """A tree that grows to the right, and the witnesses of its nodes so far."""

    def __init__(self, size: int, levels: int):
        self.entries = np.zeros((levels, size), "S65")
        self.open: list[tuple[int, int, int, bytes]] = []  # height, first node, end, root
        self.size = 0

    def append(self, root: bytes) -> None:
        self.open.append((0, self.size, self.size + 1, root))
        self.size += 1
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._complete()

    def _complete(self) -> None:
        """Two open subtrees of a height become one; both sides' witnesses are extended."""
        (height, a, b, left), (_, _, c, right) = self.open[-2:]
        self.entries[height, a:b] = b"R" + right
        self.entries[height, b:c] = b"L" + left
        self.open[-2:] = [(height + 1, a, c, digest(left + right))]

    def close(self, height: int | None = None) -> bytes:
        """The root of what was appended; of a tree of this height if it is part of a larger one."""
        while len(self.open) > 1 or (height is not None and self.open[-1][0] < height):
            own, a, b, root = self.open[-1]
            if len(self.open) > 1 and self.open[-2][0] == own:
                self._complete()
            else:
                self.entries[own, a:b] = b"-"
                self.open[-1] = (own + 1, a, b, digest(root))
        return self.open[-1][3]

    def witnesses(self) -> list[bytes]:
        out = np.ascontiguousarray(self.entries[:, : self.size].T)
        return [b"".join(row) for row in out.tolist()]


def fold(node: bytes, witness: bytes) -> bytes:
    """The root a node leads to."""
    at = 0
    while at < len(witness):
        side = witness[at : at + 1]
        if side == b"-":
            node, at = digest(node), at + 1
            continue
        sibling = witness[at + 1 : at + 65]
        node, at = digest(sibling + node if side == b"L" else node + sibling), at + 65
    return node


def proof(witness: bytes) -> bytes:
    """Hash of the siblings of a witness, one after another."""
    return digest(witness.translate(None, b"LR-"))


def leaf(columns: list[Column]) -> Column:
    """Digest of a row: each value as byte count, colon, text; a null as a dash."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def placed(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with (part, row) in their order, stored; and per (part, group) the first row,
    the rows of the group before it and in all."""
    # stored first: the partitioning samples its input, which shall not read texts again
    numbered = stored(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    keys = [group, *order, "tie"]
    at = stored(
        numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()).drop("tie"), "merkle-order")
    counts = at.groupBy("part", group).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy(group)
    runs = counts.select(
        "part", group, "first",
        F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(own).alias("total"))
    return at, stored(runs, "merkle-runs")


def _grow(nodes: pa.Table, bits: int) -> tuple[pa.Table, Appender, bytes]:
    nodes = nodes.sort_by("pos")
    whole = nodes.column("total")[0].as_py() <= 1 << bits
    tree = Appender(nodes.num_rows, bits)
    for root in nodes.column("digest").to_pylist():
        tree.append(root.encode())
    return nodes, tree, tree.close(None if whole else bits)


def _block_root(bits: int):
    def run(nodes: pa.Table) -> pa.Table:
        nodes, _, root = _grow(nodes, bits)
        first = {c: nodes.column(c)[0].as_py() for c in ("grp", "pos", "total")}
        return pa.table({
            "grp": pa.array([first["grp"]], pa.int64()), "pos": pa.array([first["pos"] >> bits], pa.int64()),
            "total": pa.array([-(-first["total"] >> bits)], pa.int64()), "digest": [root.decode()]})

    return run


def climbed(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """Layers of a forest from its nodes (grp, pos, total, digest) up; the last has one node per group."""
    layers = [nodes]
    largest = nodes.agg(F.max("total")).first()[0] or 0
    while largest > 1:
        blocks = layers[-1].select("grp", "pos", "total", "digest").groupBy("grp", F.shiftright("pos", bits).alias("block"))
        layers.append(stored(blocks.applyInArrow(_block_root(bits), _NODE), "merkle-layer"))
        largest = -(-largest >> bits)
    return layers


def _extended(own: list[str], bits: int):
    def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
        if not nodes.num_rows:
            return pa.table({c: pa.array([], t) for c, t in [*((c, nodes.schema.field(c).type) for c in own),
                            ("witness", pa.string()), ("subroot", pa.string()), ("root", pa.string())]})
        nodes, tree, _ = _grow(nodes, bits)
        further = above.column("witness")[0].as_py()
        return pa.table({
            **{c: nodes.column(c) for c in own}, "witness": [w.decode() + further for w in tree.witnesses()],
            **{c: pa.array([above.column(c)[0].as_py()] * nodes.num_rows, pa.string()) for c in ("subroot", "root")}})

    return run


def descended(layers: list[DataFrame], top: DataFrame, own: list[str], bits: int) -> DataFrame:
    """The witness of every node of the lowest layer, with its columns ``own``.

    ``top`` has (grp, pos = 0, witness, subroot, root) per group.
    """
    for k in range(max(len(layers) - 2, 0), -1, -1):
        kept = own if k == 0 else ["grp", "pos"]
        nodes = layers[k].groupBy("grp", F.shiftright("pos", bits).alias("block"))
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layers[k].select(kept).schema)
        above = top.select(F.col("grp").alias("own"), F.col("pos").alias("at"), "witness", "subroot", "root").groupBy("own", "at")
        top = nodes.cogroup(above).applyInArrow(_extended(kept, bits), f"{types}, witness string, subroot string, root string")
        if k:
            top = stored(top, "merkle-witness")
    return top


def manifest(docs: DataFrame, *, columns: tuple[str, ...] = COLUMNS, group: str = "lang", order: str = "doc_id",
             altered: dict[str, Column] | None = None, bits: int = BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, witness of every row; and ``offered``, the leaf of its row
    with columns replaced by ``altered`` (the leaf itself if none are given)."""
    values = {c: F.col(c) for c in columns}
    leaves = docs.select(
        F.col(order).cast("long").alias("doc_id"), F.col(group).cast("string").alias("lang"), leaf(list(values.values())).alias("digest"),
        leaf(list((values | altered).values())).alias("offered") if altered else F.lit(None).cast("string").alias("offered"))
    at, runs = placed(leaves, "lang", ["doc_id", "digest"])
    # groups are numbered in their order by the same means
    groups, group_runs = placed(runs.groupBy("lang").agg(F.max("total").alias("leaves")).withColumn("all", F.lit(0)), "all", ["lang"])
    numbers = groups.join(group_runs, ["part", "all"]).select(
        F.col("lang").alias("own"), (F.col("row") - F.col("first") + F.col("before")).alias("grp"), F.col("total").alias("groups"))
    numbers = stored(numbers, "merkle-groups")
    runs = runs.join(numbers, F.col("lang").eqNullSafe(F.col("own"))).select("part", F.col("lang").alias("own"), "first", "before", "total", "grp")
    nodes = at.join(runs, (at["part"] == runs["part"]) & at["lang"].eqNullSafe(runs["own"])).select(
        "grp", (F.col("row") - F.col("first") + F.col("before")).alias("pos"), "total", "digest", "doc_id", "offered")
    layers = climbed(nodes, bits)
    subroots = layers[-1].select("grp", F.col("digest").alias("subroot"))
    over = layers[-1].join(numbers, "grp").select(
        F.lit(0).cast("long").alias("grp"), F.col("grp").alias("pos"), F.col("groups").alias("total"), "digest")
    upper = climbed(over, bits)
    roots = upper[-1].select("grp", F.lit(0).cast("long").alias("pos"), F.lit("").alias("witness"),
                             F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    above = descended(upper, roots, ["pos"], bits).select(F.col("pos").alias("grp"), "witness", "root")
    tops = stored(above.join(subroots, "grp").select("grp", F.lit(0).cast("long").alias("pos"), "witness", "subroot", "root"), "merkle-tops")
    return descended(layers, tops, ["doc_id", "digest", "offered"], bits).select(
        "doc_id", F.col("digest").alias("leaf"), F.coalesce("offered", "digest").alias("offered"), "witness", "subroot", "root")


def checked(rows: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, the root that the offered leaf folds to, and whether it is the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offered, witness = (b.column(i).to_pylist() for i in (4, 5))
            paths = [w.encode() for w in witness]
            root = pa.array([fold(o.encode(), w).decode() for o, w in zip(offered, paths)], pa.string())
            same = pa.array([r == o for r, o in zip(root.to_pylist(), b.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array([proof(w).decode() for w in paths], pa.string()), root, same],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return rows.select("doc_id", "leaf", "subroot", "root", "offered", "witness").mapInArrow(
        run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def tampered_digests(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """The manifest checked with a changed character count where 7 divides the crc32 of the id."""
    more = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(
        F.col("n_chars").cast("decimal(20,0)"))
    return checked(manifest(docs, altered={"n_chars": more}, bits=bits))


_PART = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "{n}", "text"))

# crc32 is not a function of DuckDB: eight shifts per byte of the decimal id.
SQL = f"""
WITH RECURSIVE bytes AS (
  SELECT doc_id, [ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')] AS own
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), crc(doc_id, own, k, value) AS (
  SELECT doc_id, own, 0, 4294967295::BIGINT FROM bytes
  UNION ALL
  SELECT doc_id, own, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END
  FROM (SELECT *, xor(value, CASE WHEN k % 8 = 0 THEN own[k // 8 + 1] ELSE 0 END) AS v FROM crc WHERE k < 8 * len(own))
), sums AS (
  SELECT doc_id, xor(value, 4294967295) AS crc FROM crc WHERE k = 8 * len(own)
), leaves AS (
  SELECT doc_id, lang, sha256({_LEAF.format(n='n_chars')}) AS leaf,
    CASE WHEN s.crc % 7 = 0 THEN sha256({_LEAF.format(n='(n_chars + 1)')}) ELSE sha256({_LEAF.format(n='n_chars')}) END AS offered
  FROM documents LEFT JOIN sums s USING (doc_id)
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf) AS rid FROM leaves
), nodes(lang, lvl, pos, h, n) AS (
  SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM ordered
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 2, n
), subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1
), upper(lvl, pos, h, n) AS (
  SELECT 0, pos, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM upper WHERE n > 1 GROUP BY lvl, pos // 2, n
), steps AS (
  SELECT o.rid, a.lvl, (o.pos >> a.lvl) % 2 AS side, s.h
  FROM ordered o JOIN (SELECT DISTINCT lang, lvl FROM nodes WHERE n > 1) a ON a.lang IS NOT DISTINCT FROM o.lang
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM o.lang AND s.lvl = a.lvl AND s.pos = xor(o.pos >> a.lvl, 1)
  UNION ALL
  SELECT o.rid, a.lvl + 100, (b.pos >> a.lvl) % 2, s.h
  FROM ordered o JOIN subroots b ON b.lang IS NOT DISTINCT FROM o.lang CROSS JOIN (SELECT DISTINCT lvl FROM upper WHERE n > 1) a
  LEFT JOIN upper s ON s.lvl = a.lvl AND s.pos = xor(b.pos >> a.lvl, 1)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY lvl) AS k FROM steps
), folded(rid, k, h) AS (
  SELECT rid, 0, offered FROM ordered
  UNION ALL
  SELECT f.rid, f.k + 1, sha256(CASE WHEN n.h IS NULL THEN f.h WHEN n.side = 1 THEN n.h || f.h ELSE f.h || n.h END)
  FROM folded f JOIN numbered n ON n.rid = f.rid AND n.k = f.k + 1
), ends AS (
  SELECT rid, max_by(h, k) AS folded_root FROM folded GROUP BY rid
), proofs AS (
  SELECT rid, sha256(coalesce(string_agg(h, '' ORDER BY lvl), '')) AS proof_sha256 FROM steps GROUP BY rid
)
SELECT o.doc_id, o.leaf, b.subroot, r.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root,
  e.folded_root = r.h AS verified
FROM ordered o JOIN subroots b ON b.lang IS NOT DISTINCT FROM o.lang
CROSS JOIN (SELECT h FROM upper WHERE n = 1) r
JOIN ends e USING (rid) LEFT JOIN proofs p USING (rid)
"""
