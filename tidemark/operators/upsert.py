"""Keyed upserts as pure functions from tables to tables.

The writers in ``tidemark.sources.tables`` apply them to stored tables; here
they only describe the result, so they can be checked against plain SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.versions import latest_per


class SchemaChanged(Exception):
    pass


class DuplicateKeys(Exception):
    pass


def assert_same_schema(target: DataFrame, batch: DataFrame) -> None:
    """An incremental target never changes its columns or types on the side."""
    have = [(f.name, f.dataType.simpleString()) for f in target.schema.fields]
    got = [(f.name, f.dataType.simpleString()) for f in batch.schema.fields]
    if sorted(have) != sorted(got):
        raise SchemaChanged(
            f"columns differ: only in target {sorted(set(have) - set(got))}, "
            f"only in batch {sorted(set(got) - set(have))}"
        )


def unique_batch(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch, or an error if a key appears twice: two source rows for one
    target row have no defined outcome."""
    counts = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not counts.isEmpty():
        raise DuplicateKeys(f"batch holds a key more than once: {list(keys)}")
    return batch


def merged(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str] = (),
) -> DataFrame:
    """Target after an upsert: matched rows are replaced, others inserted, none deleted.

    With ``newest`` a match is replaced only by a row that is not older, so the
    order in which batches arrive does not matter.
    """
    assert_same_schema(target, batch)
    if not newest:
        # a batch below the broadcast threshold leaves the target unshuffled
        untouched = target.join(batch.select(*keys), list(keys), "left_anti")
        return untouched.unionByName(batch)
    both = target.withColumn("__arriving", F.lit(0)).unionByName(
        batch.withColumn("__arriving", F.lit(1))
    )
    return latest_per(both, keys, [*newest, "__arriving"]).drop("__arriving")


def insert_missing(target: DataFrame, seed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add seed rows whose key is absent; present rows keep their state."""
    absent = seed.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(absent, allowMissingColumns=True)


def updated(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    changes: dict[str, Column],
    when: Column | None = None,
    insert: bool = True,
) -> DataFrame:
    """Column-wise upsert.

    ``changes`` gives new values for matched rows in terms of ``t.column`` and
    ``b.column``; ``when`` restricts which matches change. Unmatched batch rows
    are inserted unless ``insert`` is off; columns the batch lacks are NULL.
    """
    t, b = target.alias("t"), batch.withColumn("__new", F.lit(True)).alias("b")
    on = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys]
    marked = target.withColumn("__old", F.lit(True)).alias("t")
    both = marked.join(b, on, "full_outer" if insert else "left")
    matched = F.col("t.__old").isNotNull() & F.col("b.__new").isNotNull()
    change = matched if when is None else matched & F.coalesce(when, F.lit(False))
    is_new = F.col("t.__old").isNull()
    out = []
    for field in t.schema.fields:
        name = field.name
        kept = F.col(f"t.{name}")
        value = F.when(change, changes[name]).otherwise(kept) if name in changes else kept
        if insert:
            arriving = F.col(f"b.{name}") if name in batch.columns else F.lit(None)
            value = F.when(is_new, arriving).otherwise(value)
        out.append(value.cast(field.dataType).alias(name))
    return both.select(*out)
