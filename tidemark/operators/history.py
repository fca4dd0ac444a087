"""Slowly changing dimensions and lookups by point in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import SECONDS, open_end, unpacked_key, version_key, with_packed
from tidemark.operators import skew


# So many keys fit a broadcast.
FEW_KEYS = 100_000


def scd2_windows(
    log: DataFrame,
    key: str,
    version: str,
    attributes: Sequence[str] | None = None,
    sk: str = "version_sk",
    sk_format: str = SECONDS,
    pieces: skew.Pieces | str | None = skew.AUTO,
) -> DataFrame:
    """Validity windows [valid_from, valid_to) of a version log.

    The log holds each (key, version) once. Windows chain without gaps, the
    last one is open, and a late version falls into place on the next build.
    ``pieces`` splits keys with very long histories; where the log is not
    a stored table, find them in the table it comes from.
    """
    if attributes is None:
        attributes = [c for c in log.columns if c not in (key, version)]
    if pieces == skew.AUTO:
        pieces = skew.find_pieces(log, key, version)
    led = skew.lead_within(log.select(key, version, *attributes), key, version, "__next", pieces)
    valid_to = F.coalesce("__next", open_end())
    return led.select(
        version_key(key, version, sk_format).alias(sk),
        key,
        *attributes,
        F.col(version).alias("valid_from"),
        valid_to.alias("valid_to"),
        (valid_to == open_end()).alias("is_current"),
    )


def point_in_time(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: Column | str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    dim_key: str | None = None,
    how: str = "left",
    pieces: skew.Pieces | str | None = skew.AUTO,
) -> DataFrame:
    """Add ``columns`` of the dimension version valid at ``ts``.

    An equi join with the window as its condition: Spark broadcasts the
    dimension below its size threshold and otherwise shuffles both sides by
    key, where adaptive execution splits a key that is hot in the fact. Keys
    with a long history in the dimension would make that join quadratic; their
    rows meet the windows in an ordered pass instead, with the same result: one
    row per window that holds the time, also where windows overlap.
    """
    dim_key = dim_key or key
    if pieces == skew.AUTO:
        pieces = skew.find_pieces(dim, dim_key, valid_from)
    ts = F.col(ts) if isinstance(ts, str) else ts
    timed = fact.withColumn("__ts", ts)
    narrow = dim.select(
        F.col(dim_key).alias("__dim_key"),
        F.col(valid_from).alias("__from"),
        F.col(valid_to).alias("__to"),
        *[F.col(c).alias(f"__dim_{c}") for c in columns],
    )
    added = [F.col(f"__dim_{c}").alias(c) for c in columns]
    match = (
        (F.col(key) == F.col("__dim_key"))
        & (F.col("__ts") >= F.col("__from"))
        & (F.col("__ts") < F.col("__to"))
    )
    if pieces is None:
        return timed.join(narrow, match, how).select(*fact.columns, *added)
    plain, long_lived = skew.split_hot(timed, key, pieces)
    few, many = skew.split_hot(narrow, "__dim_key", pieces)
    joined = plain.join(few, match, how).select(*fact.columns, *added)
    many = many.withColumnRenamed("__dim_key", key)
    # each instant once: facts of one key at one time come back by an equi join,
    # whose hot side adaptive execution splits
    instants = long_lived.select(key, "__ts").filter(F.col("__ts").isNotNull()).distinct()
    found = skew.windows_at(instants, many, key, "__ts", "__from", "__to", pieces).select(
        F.col(key).alias("__at_key"), F.col("__ts").alias("__at_ts"), "__window"
    )
    at = (F.col(key) == F.col("__at_key")) & (F.col("__ts") == F.col("__at_ts"))
    matched = long_lived.join(found, at, how)
    return joined.unionByName(
        matched.select(*fact.columns, *[F.col(f"__window.__dim_{c}").alias(c) for c in columns])
    )


def repaired_windows(
    dim: DataFrame,
    batch: DataFrame,
    key: str,
    version: str,
    attributes: Sequence[str] | None = None,
    sk: str = "version_sk",
    sk_format: str = SECONDS,
    pieces: skew.Pieces | str | None = skew.AUTO,
) -> tuple[DataFrame, DataFrame]:
    """What a batch of versions, late ones included, changes in a windowed dimension.

    Returns the windows of the arriving versions, and the windows that now end where
    one of them starts. Both replace rows of the same (key, valid_from); all other rows
    of the dimension stay as they are, so what is written follows the batch, not the table.

    A version ends where the batch's or the dimension's next one starts, whichever comes first: the
    dimension's is the end of the window that holds it, or the key's first start. A version
    the dimension has already replaces its attributes. The batch holds each (key, version) once;
    keys are not NULL. ``pieces`` are the dimension's; hot keys of the batch are found in it.
    """
    if attributes is None:
        attributes = [c for c in batch.columns if c not in (key, version)]
    names = [sk, key, *attributes, "valid_from", "valid_to", "is_current"]
    arriving = skew.lead_within(
        batch.select(key, version, *attributes), key, version, "__next_new", skew.find_pieces(batch, key, version))
    known = dim.join(batch.select(key).distinct(), key, "left_semi").select(
        key, "valid_from", "valid_to", F.struct(*attributes).alias("__before"))
    firsts = known.groupBy(F.col(key).alias("__first_key")).agg(F.min("valid_from").alias("__first"))
    held = point_in_time(arriving, known, key, version, ["valid_from", "valid_to", "__before"], pieces=pieces)
    around = held.join(firsts, F.col(key) == F.col("__first_key"), "left")
    end = F.least(F.coalesce("__next_new", open_end()), F.coalesce("valid_to", "__first", open_end()))
    arrived = around.select(
        version_key(key, version, sk_format).alias(sk), key, *attributes, F.col(version).alias("valid_from"),
        end.alias("valid_to"), (end == open_end()).alias("is_current"))
    shortened = held.filter(F.col("valid_from").isNotNull()).groupBy(key, "valid_from").agg(
        F.min(version).alias("valid_to"), F.any_value("__before").alias("__before")).filter("valid_to > valid_from")
    closed = shortened.select(
        version_key(key, "valid_from", sk_format).alias(sk), key, *[F.col(f"__before.{c}").alias(c) for c in attributes],
        "valid_from", "valid_to", F.lit(False).alias("is_current"))
    return arrived.select(*names), closed.select(*names)


def rekeyed(
    facts: DataFrame,
    owners: DataFrame,
    arrived: DataFrame,
    on: str,
    key: str,
    ts: Column | str,
    sk: str,
    period: str | None = None,
    pieces: skew.Pieces | str | None = None,
    replaced: str | None = None,
    packed: Sequence[str] = (),
) -> DataFrame:
    """The stored facts whose time falls into an arrived window, with that window's key.

    ``owners`` maps a fact's ``on`` to the dimension's ``key``, each once; facts that hold ``key`` already are not joined with it. ``packed``
    names other md5 keys of the facts, which are packed on the way as the dimension's are. Where few keys arrived (a count
    of its own), only their owners meet the facts, which then need not be shuffled; many would shuffle the owners
    once more than the lookup does. ``replaced`` adds a column with the key a fact had before. ``period`` names a partition column of the facts with the first day of the
    month of their time: months outside the arrived windows are not read.
    """
    if period:
        bounds = [arrived.agg(F.trunc(F.min("valid_from"), "MM")).scalar(), arrived.agg(F.max("valid_to").cast("date")).scalar()]
        facts = facts.filter((F.col(period) >= bounds[0]) & (F.col(period) <= bounds[1]))
    before = facts.withColumnRenamed(sk, replaced) if replaced else facts.drop(sk)
    keyed = [*packed, *([replaced] if replaced else [])]
    before = with_packed(before, *keyed)
    if key not in facts.columns:
        keys = arrived.select(key).distinct()
        if keys.limit(FEW_KEYS + 1).count() <= FEW_KEYS:
            owners = owners.join(F.broadcast(keys), key, "left_semi")
        before = before.join(owners.select(on, key), on)
    if pieces == skew.AUTO:  # looked for in the windows as they are stored
        pieces = skew.find_pieces(arrived, key, "valid_from")
    rows = point_in_time(before, with_packed(arrived, sk), key, ts, [sk], how="inner", pieces=pieces)
    rows = rows.withColumns({c: unpacked_key(c) for c in (sk, *keyed)})
    return rows.select(*facts.columns, *([replaced] if replaced else []))


def current_only(dim: DataFrame, is_current: str = "is_current") -> DataFrame:
    return dim.filter(F.col(is_current))


HISTORY_COLUMNS = ("scd_id", "valid_from", "valid_to")


def snapshot_merge(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    updated_at: str,
) -> DataFrame:
    """Record the current state of every key in a snapshot history.

    A newer state closes the open row at its own timestamp and opens a new one,
    a new key opens a row, and an unchanged or older state changes nothing.
    Keys absent from ``current`` stay open.

    Only open rows meet the input, one per key on both sides, so no key is hot.
    Each joined pair turns into one row or two in the same task.
    """
    opened = current.select(
        F.md5(
            F.concat(F.col(key).cast("string"), F.lit("|"),
                     F.date_format(updated_at, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        ).alias("scd_id"),
        *current.columns,
        F.col(updated_at).alias("valid_from"),
        open_end().alias("valid_to"),
    )
    if history is None:
        return opened
    names = opened.columns
    closed = history.filter(F.col("valid_to") < open_end()).select(*names)
    old = history.filter(F.col("valid_to") >= open_end()).select(
        F.col(key).alias("__old_key"), F.struct(*names).alias("__old")
    )
    new = opened.select(F.col(key).alias("__new_key"), F.struct(*names).alias("__new"))
    pairs = old.join(new, F.col("__old_key").eqNullSafe(F.col("__new_key")), "full_outer")
    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    newer = F.col(f"__new.{updated_at}") > F.col(f"__old.{updated_at}")
    rows = (
        F.when(~has_old, F.array("__new"))
        .when(
            has_new & newer,
            F.array(
                F.col("__old").withField("valid_to", F.col(f"__new.{updated_at}")),
                F.col("__new"),
            ),
        )
        .otherwise(F.array("__old"))
    )
    merged = pairs.select(F.explode(rows).alias("r")).select("r.*").select(*names)
    return closed.unionByName(merged)


def snapshot_backfill(
    dumps: DataFrame,
    key: str,
    updated_at: str,
    dump_date: str,
    history: DataFrame | None = None,
) -> DataFrame:
    """The snapshot history after many dumps, as merging them one by one in order of their dates gives it.

    A state counts if it is newer than all states of the key in earlier dumps and than the history's
    open row; it starts at its own timestamp and ends at that of the next one that counts.
    Closed history stays. One pass: copies of a state shrink to the dump it came with first before the
    shuffle, and a key has at most one row per dump.
    """
    names = [c for c in dumps.columns if c != dump_date]
    seen = dumps.groupBy(key, updated_at).agg(
        F.min_by(F.struct(*[c for c in names if c not in (key, updated_at)]), dump_date).alias("__state"), F.min(dump_date).alias("__seen"))
    rows = seen.select(key, updated_at, F.struct(key, updated_at, "__state.*").alias("__row"), "__seen")
    closed = None
    if history is not None:
        closed = history.filter(F.col("valid_to") < open_end())
        opened = history.filter(F.col("valid_to") >= open_end())
        rows = rows.unionByName(opened.select(key, updated_at, F.struct(
            *[F.col(f.name) for f in rows.schema["__row"].dataType.fields]).alias("__row"), F.lit(None).cast(dumps.schema[dump_date].dataType).alias("__seen")))
    before = Window.partitionBy(key).orderBy(F.asc_nulls_first("__seen")).rowsBetween(Window.unboundedPreceding, -1)
    newest = F.max(updated_at).over(before)
    counted = rows.withColumn("__newest", newest).filter(F.col("__newest").isNull() | (F.col(updated_at) > F.col("__newest")))
    following = F.lead(updated_at).over(Window.partitionBy(key).orderBy(updated_at))
    out = counted.withColumn("valid_to", F.coalesce(following, open_end())).select(
        F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), F.date_format(updated_at, "yyyy-MM-dd HH:mm:ss.SSSSSS"))).alias("scd_id"),
        *[F.col(f"__row.{c}").alias(c) for c in names], F.col(updated_at).alias("valid_from"), "valid_to")
    return out if closed is None else closed.select(*out.columns).unionByName(out)


def compare_histories(log_dim: DataFrame, snapshot_dim: DataFrame, key: str) -> DataFrame:
    """Versions both histories know, and those only one of them has."""
    left = log_dim.select(
        key, "valid_from", F.col("valid_to").alias("log_valid_to"), F.lit(True).alias("in_log")
    )
    right = snapshot_dim.select(
        key, "valid_from", F.col("valid_to").alias("snapshot_valid_to"), F.lit(True).alias("in_snap")
    )
    both = left.join(right, [key, "valid_from"], "full_outer")
    return both.select(
        key,
        "valid_from",
        "log_valid_to",
        "snapshot_valid_to",
        F.when(F.col("in_snap").isNull(), "only_log")
        .when(F.col("in_log").isNull(), "only_snapshot")
        .otherwise("matched")
        .alias("status"),
    )
