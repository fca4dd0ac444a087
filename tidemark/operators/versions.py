"""Typed projections and one-row-per-key selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def typed(
    df: DataFrame,
    fields: Mapping[str, tuple[str, str]],
    keep: Sequence[str] = (),
    record: str = "record",
) -> DataFrame:
    """Project a semi-structured record onto typed columns.

    ``fields`` maps column name to (field in the record, type). An absent field
    gives NULL, a value that does not fit its type raises. Naive timestamps go
    through text because a variant only holds zoned ones read from JSON strings.
    """
    columns = []
    for name, (path, kind) in fields.items():
        if kind in ("date", "timestamp_ntz", "timestamp"):
            value = F.variant_get(record, f"$.{path}", "string").cast(kind)
        else:
            value = F.variant_get(record, f"$.{path}", kind)
        columns.append(value.alias(name))
    return df.select(*columns, *keep)


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last in ``order``.

    Spark limits every key to one row before the shuffle as well as after it,
    so copies of one key shrink to one row per map task, however many there are.
    """
    last_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__rn", F.row_number().over(last_first)).filter("__rn = 1").drop("__rn")
