"""Stored tables: full refresh, partition overwrite, upsert, control commits."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import open_end
from tidemark.operators.history import snapshot_merge
from tidemark.operators.upsert import assert_same_schema, merged, unique_batch
from tidemark.session import work_dir


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | str | None = None):
    """A stored table, or None before its first write."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def stored(spark: SparkSession, df: DataFrame, name: str = "stored") -> DataFrame:
    """The same rows as a table in the shared folder: derived once, read often."""
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Replace a table. The new content must not read from the same path."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_partition(df: DataFrame, path: str, *columns: str) -> None:
    """Replace exactly the partitions present in ``df``.

    Rebalancing gathers a partition's rows into few files and splits a
    partition that is too large for one task.
    """
    (
        df.hint("rebalance", *columns).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    )


# ------------------------------------------------------------ commit log

_LOG = "seq bigint, id string, state string, detail string"


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    return read_or_none(spark, path, _LOG)


def last_entry(spark: SparkSession, path: str):
    log = _log(spark, path)
    return None if log is None else log.orderBy(F.desc("seq")).first()


def add_entry(spark: SparkSession, path: str, state: str, detail: str, ident: str | None = None) -> int:
    """Append one row; a single-row file appears whole or not at all."""
    last = last_entry(spark, path)
    seq = 0 if last is None else last.seq + 1
    row = [(seq, ident or uuid.uuid4().hex, state, detail)]
    spark.createDataFrame(row, _LOG).coalesce(1).write.mode("append").parquet(path)
    return seq


# ------------------------------------------------------------ upsert


def day_of(column: str) -> Column:
    """Partition of a log whose key contains the version: a match is on the same day."""
    return F.to_date(column)


def month_of(column: str) -> Column:
    """The same in months, where a day holds little or the first load spans years."""
    return F.to_date(F.trunc(column, "MM"))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Partition of a table whose key carries no time."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


PART = "part_of"


class OtherLayout(ValueError):
    """A table's stored partitioning and the one asked for differ."""


class NoPartition(ValueError):
    """A row without a partition value."""


def _by_part(df: DataFrame, path: str) -> None:
    df.hint("rebalance", PART).write.option("compression", "zstd").partitionBy(PART).parquet(path)


class KeyedTable:
    """A Parquet table that takes upserts by rewriting the partitions they touch.

    The rewritten partitions are first written beside the table and logged.
    Only then are they moved in. If the driver dies in between, the next call
    (or ``recover``) repeats the move, so no partition stays half replaced.

    The partitioning is logged with the table's first batch; a handle with another
    one is refused, since it would not meet the rows stored before. So is a batch
    with a row whose partition is NULL. Both happen before anything is staged.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partition: Column,
                 newest: Sequence[str] = ()):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.partition, self.newest = partition, list(newest)
        self.log = f"{self.path}__log"

    def stored(self) -> DataFrame | None:
        """The table with its partition column."""
        return read_or_none(self.spark, self.path)

    def read(self) -> DataFrame | None:
        stored = self.stored()
        return None if stored is None else stored.drop(PART)

    def recover(self) -> bool:
        """Finish an interrupted upsert."""
        last = last_entry(self.spark, self.log)
        if last is None or last.state != "staged":
            return False
        self._publish(last.detail, last.id)
        return True

    def _same_layout(self) -> None:
        """Log the partitioning of a new table, compare it with that of an old one."""
        layout, log = str(self.partition), _log(self.spark, self.log)
        known = None if log is None else log.filter("state = 'layout'").orderBy("seq").first()
        if known is None:
            add_entry(self.spark, self.log, "layout", layout)
        elif known.detail != layout:
            raise OtherLayout(f"{self.path} is partitioned by {known.detail}, not by {layout}")

    def _publish(self, staged: str, ident: str) -> None:
        (
            self.spark.read.parquet(staged).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path)
        )
        add_entry(self.spark, self.log, "published", staged, ident)

    def upsert(self, batch: DataFrame) -> None:
        self.recover()
        ident = uuid.uuid4().hex
        folder = work_dir(self.spark, "upsert")
        target = self.stored()
        parted = batch.withColumn(PART, self.partition)
        # written once: later steps read it instead of deriving it again. A table's first batch is what will be staged
        # and is laid out for that at once
        if target is None:
            _by_part(parted, f"{folder}/batch")
        else:
            parted.write.option("compression", "zstd").parquet(f"{folder}/batch")
        batch = self.spark.read.schema(parted.schema).parquet(f"{folder}/batch")
        if batch.isEmpty():
            return
        self._same_layout()
        if not batch.filter(F.col(PART).isNull()).isEmpty():
            raise NoPartition(f"rows of the batch for {self.path} have no partition: a key column is NULL")
        unique_batch(batch, self.keys)
        if target is None:
            staged = f"{folder}/batch"
        else:
            assert_same_schema(target, batch)
            # one value per partition of the table: a filter that prunes them
            touched = [r[0] for r in batch.select(PART).distinct().collect()]
            result = merged(target.filter(F.col(PART).isin(touched)), batch, self.keys, self.newest)
            staged = f"{folder}/staged"
            _by_part(result, staged)
        add_entry(self.spark, self.log, "staged", staged, ident)
        self._publish(staged, ident)


# ------------------------------------------------------------ snapshot history


class SnapshotTable:
    """A snapshot history that rewrites its open rows only.

    Each merge writes one step: the rows it closed, and all rows now open. The
    history is the closed rows of every committed step plus the open rows of
    the last one, so closed history is never read or written again.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, updated_at: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.updated_at = key, updated_at
        self.log = f"{self.path}__log"

    def _steps(self) -> list[str]:
        log = _log(self.spark, self.log)
        # one row per merge ever made
        return [] if log is None else [r.detail for r in log.orderBy("seq").collect()]

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame | None:
        steps = self._steps()
        if not steps:
            return None
        closed = ~F.col("is_open") & F.col("step").isin(steps)
        still_open = F.col("is_open") & (F.col("step") == steps[-1])
        return self._stored().filter(closed | still_open).drop("step", "is_open")

    def merge(self, current: DataFrame) -> None:
        steps = self._steps()
        open_rows = None
        if steps:
            last = (F.col("step") == steps[-1]) & F.col("is_open")
            open_rows = self._stored().filter(last).drop("step", "is_open")
        merged_rows = snapshot_merge(open_rows, current, self.key, self.updated_at)
        step = f"s{len(steps):06d}_{uuid.uuid4().hex}"
        (
            merged_rows.withColumn("is_open", F.col("valid_to") >= open_end())
            .write.mode("errorifexists").partitionBy("is_open").parquet(f"{self.path}/step={step}")
        )
        add_entry(self.spark, self.log, "merged", step)


# ------------------------------------------------------------ control tables


class ControlStore:
    """Watermarks and run audit, committed together.

    Both tables go into a new folder; one row in the commit log makes them the
    current state. A crash before that row leaves the previous state in place.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = f"{self.path}/commits"

    def commit(self, tables: dict[str, DataFrame]) -> None:
        version = f"{self.path}/v-{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.coalesce(1).write.mode("errorifexists").parquet(f"{version}/{name}")
        add_entry(self.spark, self.log, "committed", version)

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        last = last_entry(self.spark, self.log)
        if last is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{last.detail}/{name}")
