"""Column expressions: keys, dates, paths. All stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_KEY = "-1"
OPEN_END = "9999-12-31 00:00:00"
BEGINNING = "1900-01-01 00:00:00"

# Version keys format the version timestamp. Whole seconds reproduce published
# keys; MICROS keeps two versions within one second apart.
SECONDS = "yyyy-MM-dd HH:mm:ss"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as int; NULL stays NULL."""
    day = _col(c).cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def version_key(key: Column | str, version: Column | str, fmt: str = SECONDS) -> Column:
    """md5 of ``key~version``: one surrogate key per version, stable over rebuilds."""
    return F.md5(F.concat(_col(key).cast("string"), F.lit("~"), F.date_format(_col(version), fmt)))


def hash_key(key: Column | str) -> Column:
    return F.md5(_col(key).cast("string"))


# Longer than a packed digest: no other text is taken for one.
_NOT_PACKED = bytes(17)


def packed_key(c: Column | str) -> Column:
    """A key as bytes, to join and shuffle by: an md5 in 16 instead of 32, which shuffles cannot compress.

    Equal for equal keys only: what is not an md5 in lower case is kept whole behind ``_NOT_PACKED``.
    """
    c = _col(c)
    return F.when(c.rlike(r"\A[0-9a-f]{32}\z"), F.unhex(c)).otherwise(F.concat(F.lit(_NOT_PACKED), c.cast("binary")))


def unpacked_key(c: Column | str) -> Column:
    """The text of a ``packed_key``."""
    c = _col(c)
    text = F.substring(c, len(_NOT_PACKED) + 1, (1 << 31) - 1).cast("string")
    return F.when(F.octet_length(c) == 16, F.lower(F.hex(c))).otherwise(text)


def with_packed(df, *columns: str):
    """The table with these keys packed."""
    return df.withColumns({c: packed_key(c) for c in columns})


def or_unknown(c: Column | str, default: str = UNKNOWN_KEY) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def path_part(path: Column | str, name: str) -> Column:
    """Value of the ``name=value`` folder in a path; '' where there is none."""
    return F.split_part(F.split_part(_col(path), F.lit(f"{name}="), F.lit(2)), F.lit("/"), F.lit(1))


def to_naive_utc(c: Column | str) -> Column:
    """ISO text, with or without offset, as naive UTC. The session zone is UTC."""
    return _col(c).cast("timestamp").cast("timestamp_ntz")


def safe_run_id(c: Column | str) -> Column:
    """Replace every character that may not appear in a path segment."""
    return F.regexp_replace(_col(c), "[^A-Za-z0-9_.-]", "_")


def is_safe_run_id(c: Column | str) -> Column:
    return _col(c).rlike("^[A-Za-z0-9_.-]{1,128}$")


def classify(c: Column | str, threshold: float, above: str = "big", below: str = "small") -> Column:
    return F.when(_col(c) > threshold, above).otherwise(below)
