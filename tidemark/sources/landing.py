"""Landing zone: reading and writing the immutable files of a change feed.

Layout:  <lake>/<entity>/dt=<date>/run=<id>/attempt=<ts>/part-*.json.gz
         <lake>/_manifests/dt=<date>/run=<id>/manifest.json
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import path_part
from tidemark.session import work_dir

# A data part, and nothing else: no .tmp, _SUCCESS or manifest. Anchored,
# because rlike looks for the pattern anywhere.
NDJSON_PARTS = r"/part-[0-9]+(-[^/]*)?[.]json([.]gz)?$"
PARQUET_FILES = r"[.]parquet$"
MAX_PART_ROWS = 10_000
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


class ManifestMissing(Exception):
    pass


# ------------------------------------------------------------ reading


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def with_path_columns(df: DataFrame, parts: Mapping[str, tuple[str, str]],
                      path: str = "source_file") -> DataFrame:
    """Columns from ``name=value`` folders: ``{column: (name, type)}``."""
    return df.select(
        "*", *[path_part(path, name).cast(kind).alias(c) for c, (name, kind) in parts.items()]
    )


def numbered_lines(
    spark: SparkSession, path: str | Sequence[str], pattern: str = NDJSON_PARTS,
    parts: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """(value, source_file, file_row) for every non-empty line of the matching files.

    ``parts`` adds columns from their folders, as ``with_path_columns`` does. These and, for files named one by one,
    the pattern are looked at once per block instead of once per line.

    Lines end at a line feed, with or without a carriage return before it, in files
    of any size and however they are split. Within one block of one file ids grow
    by one per line, so a line's number follows from its block's first id and the
    running sum of the blocks before it: one row per block meets the lines. Files named one by
    one are few, so their blocks are broadcast and the lines stay where they are read.
    """
    files = spark.read.format("text").option("recursiveFileLookup", True).option("lineSep", "\n").load(_paths(path))
    if isinstance(path, str):  # files of a folder that do not match are not opened
        files = files.filter(F.col("_metadata.file_path").rlike(pattern))
    lines = files.select("value", F.col("_metadata.file_path").alias("source_file"),
                         F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_id"))
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("source_file", "block").agg(
        F.min("line_id").alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    if not isinstance(path, str):  # asked of counted blocks, which keeps it from being asked of lines
        blocks = blocks.filter(F.when(F.col("n") > 0, F.col("source_file").rlike(pattern)))
    blocks = blocks.select("source_file", "block", "first_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"))
    blocks = with_path_columns(blocks, parts or {})
    if not isinstance(path, str):
        blocks = F.broadcast(blocks)
    value = F.when(F.col("value").endswith("\r"), F.rtrim("value", F.lit("\r"))).otherwise(F.col("value"))
    numbered = lines.join(blocks, ["source_file", "block"]).select(
        value.alias("value"), "source_file",
        (F.col("line_id") - F.col("first_id") + F.col("rows_before") + 1).alias("file_row"), *(parts or {}),
    )
    return numbered.filter(F.col("value") != "")


def read_landing(spark: SparkSession, path: str | Sequence[str], pattern: str = NDJSON_PARTS) -> DataFrame:
    """NDJSON parts as landing rows; every object stays whole in ``record``. A malformed line is an error."""
    return _landing_rows(numbered_lines(spark, path, pattern, _FOLDERS), F.parse_json("value"))


_FOLDERS = {"business_date": ("dt", "date"), "run_id": ("run", "string")}


def _landing_rows(lines: DataFrame, record: Column, *more: str) -> DataFrame:
    return lines.select(
        record.alias("record"),
        "business_date", "run_id", "source_file", "file_row",
        F.current_timestamp().alias("loaded_at"), *more,
    )


def judged_lines(spark: SparkSession, path: str | Sequence[str], pattern: str = NDJSON_PARTS) -> DataFrame:
    """Every line as a landing row, with the line itself in ``value`` and, where it holds no object, why in ``reason``."""
    parsed = F.try_parse_json("value")
    reason = F.when(parsed.isNull(), "not json").when(~F.schema_of_variant(parsed).startswith("OBJECT"), "not an object")
    lines = numbered_lines(spark, path, pattern, _FOLDERS).withColumn("reason", reason)
    return _landing_rows(lines, parsed, "value", "reason")


REJECTED = ("value", "reason", "business_date", "run_id", "source_file", "file_row", "loaded_at")


def read_landing_parquet(spark: SparkSession, path: str | Sequence[str],
                         pattern: str = PARQUET_FILES) -> DataFrame:
    """Parquet files as landing rows; the whole row becomes ``record``."""
    raw = spark.read.option("recursiveFileLookup", True).parquet(*_paths(path))
    rows = raw.select(
        F.to_variant_object(F.struct(*raw.columns)).alias("record"),
        F.col("_metadata.file_path").alias("source_file"),
    ).filter(F.col("_metadata.file_path").rlike(pattern))
    return with_path_columns(rows, {"business_date": ("dt", "date")}).select(
        "record", "business_date", "source_file", F.current_timestamp().alias("loaded_at")
    )


def to_records(df: DataFrame, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """Typed rows as semi-structured records, the way a source sends them: dates
    and timestamps travel as ISO text."""
    kept = set(keep)
    wire = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.translate(c.cast("string"), " ", "T")
        if f.name not in kept:
            wire.append(F.when(F.col(f.name).isNotNull(), c).alias(f.name))
    return df.select(F.to_variant_object(F.struct(*wire)).alias(record), *keep)


LANDING_COLUMNS = ("record", "business_date", "run_id", "source_file", "file_row", "loaded_at")


def bronze(landing: DataFrame) -> DataFrame:
    """Landing as it is: nothing parsed, duplicates kept."""
    return landing.select(*LANDING_COLUMNS)


def file_inventory(spark: SparkSession, path: str, glob: str = "*.parquet",
                   depth_from_end: int | None = None, root: str | None = None) -> DataFrame:
    """Files and bytes per entity, the first folder below ``root`` (default: ``path``).

    Only paths and lengths are read, never contents.
    """
    root = (root or path).rstrip("/").split(":", 1)[-1].lstrip("/")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).load(path).select("path", "length")
    )
    below = F.split_part(F.col("path"), F.lit(root + "/"), F.lit(-1))
    return (
        files.withColumn("entity", F.split_part(below, F.lit("/"), F.lit(1)))
        .groupBy("entity")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


# ------------------------------------------------------------ writing


def attempt_id(now: dt.datetime | None = None) -> str:
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%S%fZ")


def attempt_dir(lake: str, entity: str, business_date: str, run_id: str, attempt: str) -> str:
    return f"{lake.rstrip('/')}/{entity}/dt={business_date}/run={run_id}/attempt={attempt}"


def write_parts(df: DataFrame, path: str, max_rows: int = MAX_PART_ROWS) -> None:
    """Gzip NDJSON parts of at most ``max_rows`` rows, fields in name order, NULLs kept.

    The folder must be new: files are immutable, a retry is a new attempt.
    """
    (
        df.select(*sorted(df.columns)).write.mode("errorifexists")
        .option("maxRecordsPerFile", max_rows).option("compression", "gzip")
        .option("ignoreNullFields", False)
        .option("timestampNTZFormat", ISO_MICROS)
        .json(path)
    )


# Tasks of one write whose rows are told apart while it runs.
MAX_TASKS = 10_000


@dataclass(frozen=True)
class Written:
    """What a write saw go by: rows per task, rows in all, newest cursor value as the files have it."""

    path: str
    max_rows: int
    rows: int
    tasks: dict[int, int]
    max_changed_at: str | None

    @property
    def complete(self) -> bool:
        return sum(self.tasks.values()) == self.rows

    def parts(self, spark: SparkSession) -> DataFrame:
        """(key, rows, max_changed_at) of every part. A task fills its files one after another, so a
        file's rows follow from its task, its number and the task's rows; names are listed, contents not read."""
        names = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.path)
            .select(F.col("path").alias("key")).filter(F.col("key").rlike(NDJSON_PARTS))
        )
        task = F.regexp_extract("key", r"/part-([0-9]+)[^/]*$", 1).cast("int")
        nth = F.regexp_extract("key", r"-c([0-9]+)[.]json", 1).cast("int")
        counts = spark.createDataFrame(list(self.tasks.items()), "task int, task_rows bigint")
        return names.withColumns({"task": task, "nth": nth}).join(counts, "task").select(
            "key", F.least(F.lit(self.max_rows), F.col("task_rows") - F.col("nth") * self.max_rows).cast("bigint").alias("rows"),
            F.lit(self.max_changed_at).alias("max_changed_at")).filter("rows > 0")


def write_counted(df: DataFrame, path: str, cursor: str, max_rows: int = MAX_PART_ROWS) -> Written:
    """``write_parts``, counting while it writes: the landed files need not be read for their manifest."""
    seen = Observation()
    changed = F.col(cursor)
    if isinstance(df.schema[cursor].dataType, T.TimestampNTZType):  # as the writer formats it
        changed = F.concat_ws("T", F.to_date(changed).cast("string"), F.date_format(changed, "HH:mm:ss.SSSSSS"))
    counted = df.withColumn("__task", F.spark_partition_id()).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max(changed.cast("string")).alias("newest"),
        F.expr(f"approx_top_k(__task, {MAX_TASKS}, {2 * MAX_TASKS})").alias("tasks")).drop("__task")
    write_parts(counted, path, max_rows)
    got = seen.get
    tasks = {r["item"]: r["count"] for r in got["tasks"] or []}
    return Written(path, max_rows, got["rows"], tasks, got["newest"])


MANIFEST = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("generated_at", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("watermark", T.TimestampNTZType()),
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("file_count", T.LongType()),
        T.StructField("max_changed_at", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)

# One document with a map of entities, each with an array of files.
NESTED_MANIFEST = (
    "run_id string, business_date date, source_name string, attempt string, "
    "buffer_hours double, generated_at string, entities map<string, struct<"
    "watermark: timestamp_ntz, window_start: timestamp_ntz, window_end: timestamp_ntz, "
    "row_count: bigint, max_changed_at: string, files: array<struct<key: string, rows: bigint>>>>"
)


def manifest_path(lake: str, business_date: str, run_id: str) -> str:
    return f"{lake.rstrip('/')}/_manifests/dt={business_date}/run={run_id}/manifest.json"


def part_stats(spark: SparkSession, path: str, cursor: str) -> DataFrame:
    """(key, rows, max_changed_at) of every part, counted from what was written."""
    lines = (
        spark.read.format("text").option("recursiveFileLookup", True).load(path)
        .filter(F.col("_metadata.file_path").rlike(NDJSON_PARTS))
        .select(F.col("_metadata.file_path").alias("key"),
                F.get_json_object("value", f"$.{cursor}").alias("changed_at"))
    )
    return lines.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.max("changed_at").alias("max_changed_at")
    )


def write_manifest(
    spark: SparkSession, lake: str, plan: DataFrame, attempt: str, cursors: Mapping[str, str],
    written: Mapping[str, Written] | None = None,
) -> str:
    """List the files of an attempt. Written last: its presence says all data is there.

    ``plan`` has one row per entity: run_id, business_date, source_name, entity,
    watermark, window_start, window_end. One line per file, plus one line for an
    entity without files, so no document grows with the number of files. It is
    written as a single file and therefore appears all at once. Entities in
    ``written`` were counted while they were written; the parts of others are read.
    """
    planned = plan.collect()  # one row per entity
    stats = None
    for row in planned:
        folder = attempt_dir(lake, row.entity, str(row.business_date), row.run_id, attempt)
        counted = (written or {}).get(row.entity)
        if counted is not None and counted.complete:
            found = counted.parts(spark)
        else:
            found = part_stats(spark, folder, cursors[row.entity])
        found = found.withColumn("entity", F.lit(row.entity))
        stats = found if stats is None else stats.unionByName(found)
    # the landed files are read once; the counts are then joined with their totals
    counted = f"{work_dir(spark, 'manifest')}/parts"
    stats.write.parquet(counted)
    stats = spark.read.parquet(counted)
    totals = stats.groupBy("entity").agg(
        F.sum("rows").alias("row_count"), F.count("key").alias("file_count"),
        F.max("max_changed_at").alias("entity_max"),
    )
    lines = (
        plan.join(totals, "entity", "left").join(stats.drop("max_changed_at"), "entity", "left")
        .na.fill(0, ["row_count", "file_count", "rows"])
        .withColumn("attempt", F.lit(attempt))
        .withColumn("generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))
        .withColumnRenamed("entity_max", "max_changed_at")
    )
    path = manifest_path(lake, str(planned[0].business_date), planned[0].run_id)
    ordered = lines.select(*[F.col(f.name).cast(f.dataType) for f in MANIFEST.fields])
    # replaced as a whole when a run is tried again: it names one attempt's files
    (
        ordered.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False)
        .option("timestampNTZFormat", ISO_MICROS).json(path)
    )
    return path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per listed file, and one per entity without files.

    An unreadable or empty manifest raises: it must never pass for "nothing expected".
    """
    lines = spark.read.schema(MANIFEST).json(path)
    if lines.isEmpty():
        raise ManifestMissing(path)
    return lines


def read_nested_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Same rows from a manifest that is one nested document."""
    doc = spark.read.schema(NESTED_MANIFEST).option("multiLine", True).json(path)
    if doc.isEmpty():
        raise ManifestMissing(path)
    per_entity = doc.select(
        "run_id", "business_date", "source_name", "attempt", "generated_at",
        F.explode("entities").alias("entity", "info"),
    )
    per_file = per_entity.select("*", F.explode_outer("info.files").alias("file"))
    return per_file.select(
        "run_id", "business_date", "source_name", "attempt", "generated_at", "entity",
        "info.watermark", "info.window_start", "info.window_end", "info.row_count",
        F.coalesce(F.size("info.files"), F.lit(0)).cast("bigint").alias("file_count"),
        "info.max_changed_at",
        F.col("file.key").alias("key"), F.coalesce("file.rows", F.lit(0)).cast("bigint").alias("rows"),
    )
