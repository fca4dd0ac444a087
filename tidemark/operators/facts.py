"""Building blocks of dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import date_key


def with_unknown_member(dim: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Append the member facts point to when their key is not loaded.

    Columns missing from ``values`` are NULL. The row is written in the
    dimension's own types, so the union changes none of them.
    """
    columns = [
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields
    ]
    member = dim.sparkSession.range(1).select(*columns)
    return dim.unionByName(member)


def lookup(
    fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Add columns of a dimension that holds each key once."""
    keys = [on] if isinstance(on, str) else list(on)
    return fact.join(dim.select(*keys, *columns), keys, how)


def accumulate(
    events: DataFrame,
    key: str,
    ts: str,
    status: str,
    milestones: Mapping[str, str],
    latest: Mapping[str, str] | Sequence[str] = (),
    loaded_at: str | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """One row per key: first time of each status, latest values, last times.

    ``milestones`` maps output column to status. ``latest`` attributes come
    from the newest event (``ties`` decide between equal timestamps). All of it
    is one aggregation that combines before the shuffle, so a key with many
    events reaches the shuffle as one row per map task.
    """
    latest = dict(latest) if isinstance(latest, Mapping) else {c: c for c in latest}
    order = [ts, *([loaded_at] if loaded_at else []), *ties]
    newest = F.max(
        F.struct(
            *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
            *[F.col(c).alias(f"v_{name}") for name, c in latest.items()],
        )
    )
    aggregates = [newest.alias("__newest")]
    for name, value in milestones.items():
        aggregates.append(F.min(F.when(F.col(status) == value, F.col(ts))).alias(name))
    aggregates.append(F.max(ts).alias("last_updated_at"))
    if loaded_at:
        aggregates.append(F.max(loaded_at).alias("last_loaded_at"))
    tail = ["last_updated_at", *(["last_loaded_at"] if loaded_at else [])]
    return events.groupBy(key).agg(*aggregates).select(
        key,
        *[F.col(f"__newest.v_{name}").alias(name) for name in latest],
        *milestones,
        *tail,
    )


def role_play(fact: DataFrame, dim_date: DataFrame, roles: Mapping[str, str],
              columns: Sequence[str] = ("date_day",)) -> DataFrame:
    """Join one calendar several times, once per role.

    A calendar has a few thousand rows, fixed by its date range.
    """
    out = fact
    for role, key_col in roles.items():
        day = dim_date.select(
            F.col("date_key").alias(f"__{role}_key"),
            *[F.col(c).alias(f"{role}_{c}") for c in columns],
        )
        out = out.join(F.broadcast(day), F.col(key_col) == F.col(f"__{role}_key"), "left").drop(
            f"__{role}_key"
        )
    return out


def date_keys(roles: Mapping[str, str]) -> list:
    return [date_key(column).alias(name) for name, column in roles.items()]


def load_stats(df: DataFrame, by: Sequence[str], file_col: str, cursor: str) -> DataFrame:
    """Rows, files and newest cursor value per group.

    Two steps, so that a group with very many files spreads over tasks.
    """
    per_file = df.groupBy(*by, file_col).agg(
        F.count(F.lit(1)).alias("rows"), F.max(cursor).alias("max_cursor")
    )
    return per_file.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        F.count(file_col).alias("files"),
        F.max("max_cursor").alias("max_cursor"),
    )


def report_delta(removed: DataFrame | None, added: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """What a change of fact rows adds to a grouped report: sums of the new rows less those of the
    rows they replace, and the same for their number (``rows``). Groups that end up unchanged are left out."""
    both = added.select(*keys, *sums, F.lit(1).alias("rows"))
    if removed is not None:
        both = both.unionByName(removed.select(*keys, *[(-F.col(c)).alias(c) for c in sums], F.lit(-1).alias("rows")))
    delta = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], F.sum("rows").alias("rows"))
    changed = F.col("rows") != 0
    for c in sums:
        changed = changed | (F.col(c) != 0)
    return delta.filter(changed)


def apply_delta(report: DataFrame | None, delta: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """A report with a delta merged in; a group without rows is gone. The report holds sums and ``rows``."""
    if report is not None:
        types = {f.name: f.dataType for f in report.schema.fields}
        delta = report.unionByName(delta.select(*keys, *[F.col(c).cast(types[c]).alias(c) for c in (*sums, "rows")]))
        delta = delta.groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in (*sums, "rows")])
    return delta.filter("rows > 0")
