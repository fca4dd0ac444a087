"""Data tests, gates, freshness, contracts and reconciliation.

A test describes its failing rows; no failing rows means it passed. Tests that
look at one row at a time are predicates, and the gate evaluates all
predicates of a table in one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import skew

ERROR, WARN = "error", "warn"


# ------------------------------------------------------------ failing rows


def unique(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """Combinations that appear more than once. One column alone ignores NULLs."""
    single = isinstance(columns, str)
    keys = [columns] if single else list(columns)
    rows = df.filter(F.col(columns).isNotNull()) if single else df
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def outside(column: str, values: Sequence) -> Column:
    """True where a value is not in the list; NULL passes."""
    return ~F.col(column).isin(list(values))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    failing = df.filter(outside(column, values))
    return failing.groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent; NULL keys are ignored."""
    known = parent.select(F.col(parent_column).alias("__parent"))
    return child.filter(F.col(column).isNotNull()).join(
        known, F.col(column) == F.col("__parent"), "left_anti"
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys without a parent and how many child rows carry them.

    Counting first means the join sees each key once, so a key that fills a
    third of the child costs no more than any other.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column)
    return orphans(keys.agg(F.count(F.lit(1)).alias("occurrences")), column, parent, parent_column)


def rule(df: DataFrame, broken: Column) -> DataFrame:
    """Rows for which ``broken`` is true; NULL counts as fine."""
    return df.filter(broken)


def scd2_contiguous(
    dim: DataFrame, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
    pieces: skew.Pieces | str | None = skew.AUTO,
) -> DataFrame:
    """Windows that hold no time, or do not end where the key's next one begins."""
    own = dim.select(F.col(key).alias("dim_key"), F.col(valid_from).alias("opens_at"), F.col(valid_to).alias("closes_at"))
    if pieces == skew.AUTO:
        pieces = skew.find_pieces(own, "dim_key", "opens_at")
    beside = skew.lead_within(own, "dim_key", "opens_at", "follows_at", pieces)
    holds_time = F.col("opens_at") < F.col("closes_at")
    chains = F.coalesce(F.col("closes_at") == F.col("follows_at"), F.lit(True))
    return beside.filter(~(holds_time & chains))


def scd2_one_current(dim: DataFrame, key: str, is_current: str = "is_current") -> DataFrame:
    """Keys that have not exactly one current version."""
    marked = dim.groupBy(key).agg(F.count_if(F.col(is_current)).alias("current_rows"))
    return marked.filter(F.col("current_rows") != 1)


def reconcile_totals(
    a: DataFrame, b: DataFrame, measures: Mapping[str, Column], names: tuple[str, str] = ("a", "b"),
    null_safe: bool = False,
) -> DataFrame:
    """One row if any total differs between two tables, none otherwise.

    By default a NULL total (an empty table) passes; ``null_safe`` reports it.
    """
    totals = [
        df.agg(*[e.alias(m) for m, e in measures.items()]).withColumn("__side", F.lit(side))
        for df, side in ((a, names[0]), (b, names[1]))
    ]
    sides = totals[0].unionByName(totals[1]).groupBy().agg(
        *[
            F.max(F.when(F.col("__side") == side, F.col(m))).alias(f"{side}_{m}")
            for m in measures
            for side in names
        ]
    )
    pairs = [(F.col(f"{names[0]}_{m}"), F.col(f"{names[1]}_{m}")) for m in measures]
    differs = [~x.eqNullSafe(y) if null_safe else x != y for x, y in pairs]
    return sides.filter(reduce(lambda x, y: x | y, differs))


# ------------------------------------------------------------ gate


@dataclass(frozen=True)
class Check:
    """A named data test over a table: either a row predicate or failing rows."""

    name: str
    severity: str = ERROR
    table: DataFrame | None = None
    predicate: Column | None = None
    failing: DataFrame | None = None


@dataclass(frozen=True)
class Result:
    name: str
    severity: str
    failures: int

    @property
    def status(self) -> str:
        if self.failures == 0:
            return "pass"
        return "fail" if self.severity == ERROR else "warn"


class GateFailed(Exception):
    def __init__(self, results: Sequence[Result]):
        self.results = results
        broken = {r.name: r.failures for r in results if r.status == "fail"}
        super().__init__(f"{len(broken)} checks failed: {broken}")


def failure_counts(checks: Sequence[Check]) -> DataFrame:
    """(name, severity, failures) of every check, as one query."""
    by_table: dict[int, list[Check]] = {}
    parts = []
    for check in checks:
        if check.predicate is not None:
            by_table.setdefault(id(check.table), []).append(check)
        else:
            n = check.failing.agg(F.count(F.lit(1)).alias("failures"))
            parts.append(
                n.select(F.lit(check.name).alias("name"), F.lit(check.severity).alias("severity"),
                         "failures")
            )
    for group in by_table.values():
        counts = F.array(
            *[
                F.struct(F.lit(c.name).alias("name"), F.lit(c.severity).alias("severity"),
                         F.count_if(c.predicate).alias("failures"))
                for c in group
            ]
        )
        one_scan = group[0].table.agg(counts.alias("c"))
        parts.append(one_scan.select(F.explode("c").alias("c")).select("c.*"))
    return reduce(DataFrame.unionByName, parts)


def gate(checks: Sequence[Check]) -> list[Result]:
    """Run the checks. Raises on a failing error check; warnings are returned."""
    if not checks:
        return []
    counted = failure_counts(checks).collect()  # one row per check
    results = [Result(r.name, r.severity, r.failures) for r in counted]
    if any(r.status == "fail" for r in results):
        raise GateFailed(results)
    return results


# ------------------------------------------------------------ contract


class ContractBroken(Exception):
    pass


def enforce_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table in the contract's column order.

    Names and types must be exactly those of the contract. NULLs in a column
    declared not null fail the job that writes the result, without an extra pass.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    problems = [f"missing {n}" for n in want if n not in have]
    problems += [f"unexpected {n}" for n in have if n not in want]
    problems += [
        f"{n} is {have[n].simpleString()}, contract says {t.simpleString()}"
        for n, t in want.items()
        if n in have and have[n] != t
    ]
    if problems:
        raise ContractBroken("; ".join(problems))
    columns = []
    for f in schema.fields:
        c = F.col(f.name)
        if not f.nullable:
            message = f"contract: {f.name} must not be null"
            c = F.when(c.isNull(), F.raise_error(F.lit(message)).cast(f.dataType)).otherwise(c)
        columns.append(c.alias(f.name))
    return df.select(*columns)


# ------------------------------------------------------------ freshness and counts


def freshness(
    df: DataFrame, ts: str, now, warn: str = "INTERVAL 26 HOURS", error: str = "INTERVAL 48 HOURS",
    by: Sequence[str] = (),
) -> DataFrame:
    """Age of the newest timestamp as PASS, WARN or ERROR. An empty source is an error."""
    now = now if isinstance(now, Column) else F.lit(now).cast(df.schema[ts].dataType)
    newest = df.groupBy(*by).agg(F.max(ts).alias("newest"))
    status = (
        F.when(F.col("newest").isNull(), "ERROR")
        .when(F.col("newest") < now - F.expr(error), "ERROR")
        .when(F.col("newest") < now - F.expr(warn), "WARN")
        .otherwise("PASS")
    )
    return newest.withColumn("status", status)


def compare_counts(expected: Column, loaded: Column) -> Column:
    return (
        F.when(loaded > expected, "TOO_MANY").when(loaded < expected, "NOT_YET").otherwise("DONE")
    )


def reconcile(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Rows and files per entity: what the manifest lists against what is loaded.

    ``manifest`` is (entity, key, rows) with one row per file, and one row with
    a NULL key for an entity without files. ``landed`` is (entity, source_file)
    with one row per loaded record of that attempt. An entity that loaded
    nothing still appears.
    """
    expected = manifest.groupBy("entity").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("expected_rows"),
        F.count("key").alias("expected_files"),
    )
    per_file = landed.groupBy("entity", "source_file").agg(F.count(F.lit(1)).alias("rows"))
    loaded = per_file.groupBy("entity").agg(
        F.sum("rows").alias("loaded_rows"), F.count("source_file").alias("loaded_files")
    )
    both = expected.join(loaded, "entity", "left").na.fill(0, ["loaded_rows", "loaded_files"])
    rows = compare_counts(F.col("expected_rows"), F.col("loaded_rows"))
    files = compare_counts(F.col("expected_files"), F.col("loaded_files"))
    return both.select(
        "entity", "expected_rows", "loaded_rows", "expected_files", "loaded_files",
        rows.alias("status"), files.alias("file_status"),
    )


def reconcile_files(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Every file that is listed or loaded: entity, file, rows on both sides, status.

    Equal totals can hide files swapped for others, and totals of listed entities
    never show one the manifest lacks. Both sides are counted before they meet.
    """
    listed = manifest.filter(F.col("key").isNotNull()).groupBy(F.col("entity").alias("e1"), F.col("key").alias("f1")).agg(
        F.sum("rows").alias("expected_rows"))
    loaded = landed.groupBy(F.col("entity").alias("e2"), F.col("source_file").alias("f2")).agg(
        F.count(F.lit(1)).alias("loaded_rows"))
    both = listed.join(loaded, (F.col("e1") == F.col("e2")) & (F.col("f1") == F.col("f2")), "full_outer")
    status = (
        F.when(F.col("f1").isNull(), "NOT_LISTED").when(F.col("f2").isNull(), "NOT_YET")
        .otherwise(compare_counts(F.col("expected_rows"), F.col("loaded_rows")))
    )
    return both.select(F.coalesce("e1", "e2").alias("entity"), F.coalesce("f1", "f2").alias("file"),
                       F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
                       F.coalesce("loaded_rows", F.lit(0)).alias("loaded_rows"), status.alias("status"))


def row_digest(columns: Sequence[str]) -> Column:
    """60 bits of a row's content, as a number; NULL and empty text differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("decimal(20,0)")


def content_sums(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows and the sum of their digests modulo 2^60 per group: the same for any order of the rows.

    Sums combine before the shuffle; repeated rows count as often as they are there.
    """
    total = F.sum(row_digest(columns)) % F.lit(1 << 60)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), total.cast("bigint").alias("content"))


def reconcile_content(announced: DataFrame, loaded: DataFrame, by: Sequence[str]) -> DataFrame:
    """Two ``content_sums`` side by side, every group of either: what counts alone accept may be CHANGED."""
    a = announced.select(*by, F.col("rows").alias("expected_rows"), F.col("content").alias("expected_content"))
    b = loaded.select(*by, F.col("rows").alias("loaded_rows"), F.col("content").alias("loaded_content"))
    both = a.join(b, list(by), "full_outer").na.fill(0, ["expected_rows", "loaded_rows"])
    counts = compare_counts(F.col("expected_rows"), F.col("loaded_rows"))
    same = F.col("expected_content").eqNullSafe(F.col("loaded_content"))
    return both.withColumn("status", F.when((counts == "DONE") & ~same, "CHANGED").otherwise(counts))


def reconcile_min(expected: DataFrame, loaded: DataFrame, by: Sequence[str]) -> DataFrame:
    """Loaded at least what was expected; duplicates pass."""
    counts = loaded.groupBy(*by).agg(F.count(F.lit(1)).alias("loaded_rows"))
    both = expected.join(counts, list(by), "left").na.fill(0, ["loaded_rows"])
    done = F.col("loaded_rows") >= F.col("expected_rows")
    return both.withColumn("status", F.when(done, "DONE").otherwise("NOT_YET"))


def batch_summary(df: DataFrame, measure: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(measure).alias("total"))

