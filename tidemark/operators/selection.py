"""Change windows, feed pages and incremental selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import is_safe_run_id, safe_run_id
from tidemark.operators.versions import latest_per

LOOKBACK = "INTERVAL 3 HOURS"
BUFFER = "INTERVAL 2 HOURS"
MAX_PAGE = 500


class MissingWatermark(Exception):
    pass


def _ts(value: dt.datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def changes_between(log: DataFrame, cursor: str, since, until) -> DataFrame:
    """Versions changed in (since, until]."""
    return log.filter((F.col(cursor) > _ts(since)) & (F.col(cursor) <= _ts(until)))


def snapshots_to_changes(df: DataFrame, cursor: str, snapshot_date: str) -> DataFrame:
    """Rows of full daily snapshots that changed on the day of their snapshot."""
    return df.filter(F.to_date(cursor) == F.col(snapshot_date))


def as_of(log: DataFrame, key: str, cursor: str, day, ties: Sequence[str] = ()) -> DataFrame:
    """State of every key at the end of ``day``."""
    until = log.filter(F.to_date(cursor) <= F.lit(day).cast("date"))
    return latest_per(until, [key], [cursor, *ties])


def ordered_feed(df: DataFrame, cursor: str, ident: str) -> DataFrame:
    return df.orderBy(cursor, ident)


def feed_page(
    df: DataFrame,
    cursor: str,
    ident: str,
    size: int,
    offset: int = 0,
    after: tuple | None = None,
) -> DataFrame:
    """One page of the ordered feed, and whether more rows follow.

    ``after`` is the (cursor, id) of the last row seen. It turns into a filter
    the scan can use, so page one million costs what page one costs; an offset
    makes Spark order every row before it and suits the first pages only.
    ``has_more`` comes from fetching one row beyond the page, not from a count.
    """
    size = max(1, min(int(size), MAX_PAGE))
    if after is not None:
        last_cursor, last_id = (F.lit(v) for v in after)
        df = df.filter(F.col(cursor) >= last_cursor).filter(
            (F.col(cursor) > last_cursor) | (F.col(ident) > last_id)
        )
    fetched = df.orderBy(cursor, ident).offset(offset).limit(size + 1)
    # at most 501 rows from here on
    rows = F.struct(F.col(cursor).alias("c"), F.col(ident).alias("i"), F.struct("*").alias("r"))
    page = fetched.agg(F.sort_array(F.collect_list(rows)).alias("rows"))
    return (
        page.withColumn("has_more", F.size("rows") > size)
        .select(F.explode(F.slice("rows", 1, size)).alias("row"), "has_more")
        .select("row.r.*", "has_more")
    )


def plan_window(watermarks: DataFrame, until, buffer: str = BUFFER) -> DataFrame:
    """(watermark - buffer, until] per entity; ``is_empty`` where nothing is left to pull."""
    return watermarks.select(
        "source_name",
        "entity",
        "high_watermark",
        (F.col("high_watermark") - F.expr(buffer)).alias("window_start"),
        _ts(until).alias("window_end"),
    ).withColumn("is_empty", F.col("window_start") >= F.col("window_end"))


def missing_keys(required: DataFrame, present: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return required.join(present, on, "left_anti")


def read_watermarks(watermarks: DataFrame, source: str, entities: Sequence[str]) -> DataFrame:
    """One row per entity. An entity without a watermark is an error: falling
    back to "everything" would pull the whole source."""
    mine = watermarks.filter(F.col("source_name") == source).filter(
        F.col("entity").isin(list(entities))
    )
    # a handful of entities, one row each
    found = {row.entity for row in mine.select("entity").distinct().collect()}
    if set(entities) - found:
        raise MissingWatermark(f"no watermark for {sorted(set(entities) - found)} of {source}")
    return mine


def plan_request(runs: DataFrame, run_after: str = "run_after", run_id: str = "run_id") -> DataFrame:
    """Path-safe run id, business date (the day before) and window end of each run."""
    planned = runs.withColumn(run_id, safe_run_id(run_id))
    return planned.select(
        *planned.columns,
        F.date_sub(F.to_date(run_after), 1).alias("business_date"),
        F.date_trunc("second", run_after).cast("timestamp_ntz").alias("window_end"),
        is_safe_run_id(run_id).alias("is_safe"),
    )


def incremental(
    source: DataFrame,
    target: DataFrame | None,
    loaded_at: str = "loaded_at",
    target_loaded_at: str | None = None,
    lookback: str = LOOKBACK,
    load_day: str | None = None,
    target_day: str | None = None,
) -> DataFrame:
    """Source rows loaded after the newest load in the target, minus a lookback.

    No target or an empty one selects everything. The bound is a scalar
    subquery: one pass over the target's load times, then a plain comparison
    that the source scan can use to skip row groups. ``target_day`` names a partition
    column of the target that grows with its load times: then only its newest
    partition is read for the bound.
    """
    if target is None:
        return source
    lowest = F.lit("0001-01-01 00:00:00").cast(source.schema[loaded_at].dataType)
    if target_day:  # the first subquery asks for partition values only
        target = target.filter(F.col(target_day) == target.agg(F.max(target_day).alias("latest")).scalar())
    newest = F.max(target_loaded_at or loaded_at) - F.expr(lookback)
    bound = target.agg(F.coalesce(newest, lowest).alias("bound"))
    recent = source.filter(F.col(loaded_at) > bound.scalar())
    if load_day:  # partition column with the day of the load: skips whole folders
        recent = recent.filter(F.col(load_day) >= F.to_date(bound.scalar()))
    return recent


def changed_keys(
    events: DataFrame,
    target: DataFrame | None,
    key: str,
    loaded_at: str = "loaded_at",
    target_loaded_at: str = "last_loaded_at",
    lookback: str = LOOKBACK,
    target_day: str | None = None,
) -> DataFrame:
    """Keys with events newer than the target."""
    recent = incremental(events, target, loaded_at, target_loaded_at, lookback, target_day=target_day)
    return recent.select(key).distinct()


def events_of(events: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """All events of the given keys, so that early milestones are never lost."""
    return events.join(keys, on, "left_semi")


def pick_business_date(df: DataFrame, column: str = "business_date", day=None) -> DataFrame:
    """Rows of the given date, or of the latest one."""
    if day is not None:
        return df.filter(F.col(column) == F.lit(day).cast("date"))
    latest = df.agg(F.max(column).alias("latest"))
    return df.filter(F.col(column) == latest.scalar())


def rows_of_attempt(df: DataFrame, run_id: str, attempt: str) -> DataFrame:
    return df.filter(
        (F.col("run_id") == run_id) & F.col("source_file").contains(f"/attempt={attempt}/")
    )
