"""Sources, sinks, upserts and streams: written to the shared folder and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import path_part
from tidemark.operators import calendar, control, quality, selection, upsert
from tidemark.operators.upsert import SchemaChanged
from tidemark.operators.versions import latest_per, typed
from tidemark.plans import models
from tidemark.queries import feeds
from tidemark.queries.registry import Lake, cte, query
from tidemark.queries.selection_queries import watermarks
from tidemark.session import work_dir
from tidemark.sources import landing, tables
from tidemark.sources.tables import ControlStore, KeyedTable
from tidemark.spec import CLAIMS
from tidemark.streaming.ingest import dedup_stream, ingest, ingest_days, read_deduplicated, upsert_stream

_EVENT_FIELDS = {"event_id": ("event_id", "bigint"), "user_id": ("user_id", "bigint"),
                 "event_type": ("event_type", "string"), "value": ("value", "double"),
                 "ts": ("ts", "timestamp_ntz")}
_EVENT = "event_id:l user_id:l event_type:s value:d ts:t"
_LANDED = _EVENT + " business_date:D run_id:s"
_LANDED_SQL = "SELECT *, DATE '2024-01-31' AS business_date, 'run-1' AS run_id FROM events"


def _lake_of_events(t: Lake) -> str:
    """All events as one attempt of one run."""
    root = work_dir(t.spark, "lake")
    landing.write_parts(t.events, landing.attempt_dir(root, "events", "2024-01-31", "run-1", "a1"))
    return root


# ------------------------------------------------------------ sources


@query("src01_ndjson_landing", _LANDED, _LANDED_SQL)
def src01_ndjson_landing(t: Lake):
    """Gzip NDJSON parts, written and read back as records."""
    rows = landing.read_landing(t.spark, _lake_of_events(t) + "/events")
    return typed(rows, _EVENT_FIELDS, ["business_date", "run_id"])


@query("src02_parquet_landing", "c_custkey:l c_name:s c_nationkey:i c_acctbal:d",
       "SELECT * FROM customer")
def src02_parquet_landing(t: Lake):
    rows = landing.read_landing_parquet(t.spark, t.path("customer"))
    return typed(rows.withColumn("business_date", F.lit(None)), {
        "c_custkey": ("c_custkey", "bigint"), "c_name": ("c_name", "string"),
        "c_nationkey": ("c_nationkey", "int"), "c_acctbal": ("c_acctbal", "double")})


@query("src03_file_pattern", "event_type:s row_count:l",
       "SELECT event_type, count(*) AS row_count FROM events GROUP BY 1")
def src03_file_pattern(t: Lake):
    """Copies of the data under names that are no data parts are never rows."""
    root = _lake_of_events(t)
    t.events.write.csv(f"{root}/events/dt=2024-01-31/run=run-1/attempt=a1/csv")
    t.events.write.parquet(f"{root}/events/dt=2024-01-31/run=run-1/attempt=a1/parquet")
    rows = landing.read_landing(t.spark, root + "/events")
    return typed(rows, _EVENT_FIELDS).groupBy("event_type").agg(F.count(F.lit(1)).alias("row_count"))


@query("src04_path_columns", "source_file:s business_date:D run_id:s none:s",
       "SELECT source_file, business_date, run_id, '' AS none FROM holders_d", "holders_d")
def src04_path_columns(t: Lake):
    paths = feeds.holder_rows(t).select("source_file")
    return landing.with_path_columns(paths, {"business_date": ("dt", "date"), "run_id": ("run", "string"),
                                             "none": ("nothing", "string")})


def _lake_by_day(t: Lake) -> str:
    """Events in a folder for each day and run."""
    root = work_dir(t.spark, "lake")
    days = t.events.withColumn("dt", F.to_date("ts")).withColumn("run", F.concat(F.lit("run-"), F.date_format("ts", "yyyyMMdd")))
    days.hint("rebalance", "dt", "run").write.partitionBy("dt", "run").option("compression", "gzip").json(root)
    return root


@query("src05_lineage", "business_date:D run_id:s files_are_parts:b first_event:l row_count:l",
       """SELECT CAST(ts AS DATE) AS business_date, 'run-' || strftime(ts, '%Y%m%d') AS run_id, true AS files_are_parts,
          min(event_id) AS first_event, count(*) AS row_count FROM events GROUP BY 1, 2""")
def src05_lineage(t: Lake):
    """Every row knows the day, run and file it came from."""
    rows = landing.read_landing(t.spark, _lake_by_day(t))
    return rows.groupBy("business_date", "run_id").agg(
        F.bool_and(F.col("source_file").rlike(landing.NDJSON_PARTS)).alias("files_are_parts"),
        F.min(F.variant_get("record", "$.event_id", "bigint")).alias("first_event"), F.count(F.lit(1)).alias("row_count"))


@query("src06_row_in_file", "day:s event_id:l file_row:l",
       """SELECT strftime(ts, '%Y-%m-%d') AS day, event_id,
          row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS file_row FROM events""")
def src06_row_in_file(t: Lake):
    """One file a day, its events in order of their ids: the line each is on."""
    root = work_dir(t.spark, "lake")
    days = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    days.repartition("dt").sortWithinPartitions("dt", "event_id").write.partitionBy("dt").json(root)
    lines = landing.numbered_lines(t.spark, root)
    return lines.select(path_part("source_file", "dt").alias("day"),
                        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "file_row")


@query("src07_load_time", "business_date:D load_times:l row_count:l",
       "SELECT CAST(ts AS DATE) AS business_date, 1 AS load_times, count(*) AS row_count FROM events GROUP BY 1")
def src07_load_time(t: Lake):
    """One load has one time, whatever the day and file of a row."""
    rows = landing.read_landing(t.spark, _lake_by_day(t))
    whole = tables.stored(t.spark, rows)
    newest = whole.agg(F.max("loaded_at").alias("at"))
    return whole.groupBy("business_date").agg(
        F.count_distinct(F.when(F.col("loaded_at") == newest.scalar(), F.col("loaded_at"))).alias("load_times"),
        F.count_if(F.col("loaded_at") == newest.scalar()).alias("row_count"))


@query("src08_inline_values", "o_orderkey:l label:s",
       """SELECT o_orderkey, label FROM orders JOIN (VALUES ('O', 'open'), ('F', 'finished'),
          ('P', 'pending')) v(code, label) ON code = o_orderstatus""")
def src08_inline_values(t: Lake):
    codes = t.spark.sql("SELECT * FROM VALUES ('O', 'open'), ('F', 'finished'), ('P', 'pending') AS v(code, label)")
    return t.orders.join(F.broadcast(codes), F.col("o_orderstatus") == F.col("code"))


@query("src09_date_spine", "date_day:D orders_n:l",
       """SELECT d AS date_day, count(o_orderkey) AS orders_n FROM
          (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS d)
          LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY 1""")
def src09_date_spine(t: Lake):
    """Every day of seven years with its orders, days without any included."""
    spine = calendar.date_spine(t.spark, "1995-01-01", 2557)
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("date_day")).agg(
        F.count(F.lit(1)).alias("orders_n"))
    return spine.join(per_day, "date_day", "left").na.fill(0, ["orders_n"])


def _run_with_manifest(t: Lake, counted: bool = False) -> tuple[str, DataFrame]:
    """One entity per event type, one that has nothing new, and their manifest."""
    written = {}
    root = work_dir(t.spark, "lake")
    marks = watermarks(t)
    kinds = [r.entity for r in marks.select("entity").collect()]  # one row per entity
    for kind in [*kinds, "refund"]:
        folder = landing.attempt_dir(root, kind, "2024-01-31", "run-1", "a1")
        rows = t.events.filter(F.col("event_type") == kind)
        if counted:
            written[kind] = landing.write_counted(rows, folder, "ts", max_rows=1000)
        else:
            landing.write_parts(rows, folder, max_rows=1000)
    nothing = t.spark.range(1).select(F.lit("api").alias("source_name"), F.lit("refund").alias("entity"),
                                      F.lit("2024-01-30").cast("timestamp_ntz").alias("high_watermark"))
    plan = selection.plan_window(marks.unionByName(nothing), "2024-01-31").select(
        F.lit("run-1").alias("run_id"), F.lit("2024-01-31").cast("date").alias("business_date"),
        "source_name", "entity", F.col("high_watermark").alias("watermark"), "window_start", "window_end")
    landing.write_manifest(t.spark, root, plan, "a1", {k: "ts" for k in [*kinds, "refund"]}, written)
    return root, landing.read_manifest(t.spark, landing.manifest_path(root, "2024-01-31", "run-1"))


_MANIFEST_SQL = """SELECT w.entity, count(e.event_id) AS row_count, sum(CASE WHEN e.event_id IS NULL THEN 0 ELSE 1 END) AS listed,
    strftime(max(e.ts), '%Y-%m-%dT%H:%M:%S.%f') AS max_changed_at, any_value(w.high_watermark) - INTERVAL 2 HOUR AS window_start
    FROM (SELECT * FROM watermarks UNION ALL SELECT 'api', 'refund', TIMESTAMP '2024-01-30') w
    LEFT JOIN events e ON e.event_type = w.entity GROUP BY 1"""


@query("src10_manifest", "entity:s row_count:l listed:l max_changed_at:s window_start:t",
       _MANIFEST_SQL, "watermarks")
def src10_manifest(t: Lake):
    """Per entity: rows announced, rows listed per file, newest change. One has no files."""
    _, manifest = _run_with_manifest(t)
    return manifest.groupBy("entity").agg(
        F.max("row_count").alias("row_count"), F.sum("rows").alias("listed"),
        F.max("max_changed_at").alias("max_changed_at"), F.max("window_start").alias("window_start"))


@query("snk03_counted_while_written", "entity:s row_count:l listed:l in_files:l max_changed_at:s window_start:t",
       f"SELECT *, row_count AS in_files FROM ({_MANIFEST_SQL})", "watermarks")
def snk03_counted_while_written(t: Lake):
    """The manifest from counts taken while writing; beside them, the lines of the listed files by reading."""
    root, manifest = _run_with_manifest(t, counted=True)
    lines = landing.numbered_lines(t.spark, root).groupBy("source_file").agg(F.count(F.lit(1)).alias("in_file"))
    # a file whose announced rows are not its lines would not count
    agree = (F.col("key") == F.col("source_file")) & (F.col("rows") == F.col("in_file"))
    return manifest.join(lines, agree, "left").groupBy("entity").agg(
        F.max("row_count").alias("row_count"), F.sum("rows").alias("listed"), F.coalesce(F.sum("in_file"), F.lit(0)).alias("in_files"),
        F.max("max_changed_at").alias("max_changed_at"), F.max("window_start").alias("window_start"))


@query("src01_rejected_lines", "line:s status:s file_row_known:b",
       """SELECT CASE WHEN event_id % 97 = 0 THEN '{"event_id": ' || event_id WHEN event_id % 89 = 0 THEN '[' || event_id || ']'
            WHEN event_id % 83 = 0 THEN event_id::VARCHAR ELSE 'event ' || event_id END AS line,
          CASE WHEN event_id % 97 = 0 THEN 'not json' WHEN event_id % 89 = 0 OR event_id % 83 = 0 THEN 'not an object'
            ELSE 'landed' END AS status, true AS file_row_known FROM events""")
def src01_rejected_lines(t: Lake):
    """Cut off objects, arrays and bare numbers among the lines: kept aside with file, line and reason; the rest lands."""
    number = F.col("event_id").cast("string")
    line = (
        F.when(F.col("event_id") % 97 == 0, F.concat(F.lit('{"event_id": '), number))
        .when(F.col("event_id") % 89 == 0, F.concat(F.lit("["), number, F.lit("]")))
        .when(F.col("event_id") % 83 == 0, number).otherwise(F.to_json(F.struct("event_id", "user_id", "event_type")))
    )
    root = work_dir(t.spark, "lake")
    path = landing.attempt_dir(root, "events", "2024-01-31", "run-1", "a1")
    t.events.select(line.alias("value")).write.option("compression", "gzip").text(path)
    table, aside = work_dir(t.spark, "landing"), work_dir(t.spark, "rejected")
    ingest(t.spark, f"{root}/events", table, work_dir(t.spark, "checkpoint"), quarantine=aside, pattern=r"/part-[0-9]+[^/]*[.]txt[.]gz$")
    known = (F.col("file_row") > 0).alias("file_row_known")
    good = t.spark.read.parquet(table).select(
        F.concat(F.lit("event "), F.variant_get("record", "$.event_id", "string")).alias("line"), F.lit("landed").alias("status"), known)
    return good.unionByName(t.spark.read.parquet(aside).select(F.col("value").alias("line"), F.col("reason").alias("status"), known))


@query("src11_file_inventory", "entity:s files:l has_bytes:b",
       """SELECT 'event_type=' || event_type AS entity, count(DISTINCT CAST(ts AS DATE)) AS files, true AS has_bytes
          FROM events GROUP BY 1""")
def src11_file_inventory(t: Lake):
    """One file for each type and day is written, then counted."""
    path = work_dir(t.spark, "inventory")
    days = t.events.withColumn("day", F.to_date("ts"))
    days.repartition("event_type", "day").write.partitionBy("event_type", "day").parquet(path)
    return landing.file_inventory(t.spark, path).withColumn("has_bytes", F.col("bytes") > 0)


@query("src12_raw_view", "city:s business_date:D run_id:s source_file:s file_row:l loaded_at:t",
       "SELECT * FROM holders_d", "holders_d")
def src12_raw_view(t: Lake):
    view = tables.as_view(landing.bronze(feeds.holders(t)), "tidemark_raw_policyholders")
    return view.withColumn("city", F.variant_get("record", "$.city", "string"))


@query("src13_empty_like", "o_orderkey:l o_totalprice:d",
       "SELECT o_orderkey, o_totalprice FROM orders")
def src13_empty_like(t: Lake):
    """A table without rows has the columns and types of its model."""
    return tables.empty_like(t.orders).unionByName(t.orders)


# ------------------------------------------------------------ sinks


@query("snk01_bounded_parts", "row_count:l none_too_long:b sorted_fields:b nulls_kept:b",
       """SELECT count(*) AS row_count, true AS none_too_long, true AS sorted_fields, true AS nulls_kept
          FROM lineitem""")
def snk01_bounded_parts(t: Lake):
    root = work_dir(t.spark, "lake")
    rows = t.lineitem.withColumn("a_null", F.lit(None).cast("string"))
    landing.write_parts(rows, root, max_rows=10_000)
    lines = landing.numbered_lines(t.spark, root)
    per_file = lines.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("value").startswith('{"a_null":null,"l_discount"')).alias("ok"))
    return per_file.agg(F.sum("n").alias("row_count"), (F.max("n") <= 10_000).alias("none_too_long"),
                        F.bool_and("ok").alias("sorted_fields"), F.bool_and("ok").alias("nulls_kept"))


@query("snk02_attempts_side_by_side", "attempt:s row_count:l",
       """SELECT 'a1' AS attempt, count(*) AS row_count FROM events
          UNION ALL SELECT 'a2', count(*) FROM events""")
def snk02_attempts_side_by_side(t: Lake):
    """A retry adds an attempt; the first one stays as it was."""
    root = _lake_of_events(t)
    landing.write_parts(t.events, landing.attempt_dir(root, "events", "2024-01-31", "run-1", "a2"))
    rows = landing.read_landing(t.spark, root + "/events")
    parts = [selection.rows_of_attempt(rows, "run-1", a).agg(F.count(F.lit(1)).alias("row_count"))
             .withColumn("attempt", F.lit(a)) for a in ("a1", "a2")]
    return reduce(DataFrame.unionByName, parts)


@query("snk04_partition_overwrite", "o_orderkey:l o_totalprice:d y:i",
       """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN 0 ELSE o_totalprice END AS o_totalprice,
          year(o_orderdate) AS y FROM orders""")
def snk04_partition_overwrite(t: Lake):
    """Writing one year again replaces that year and nothing else."""
    path = work_dir(t.spark, "table")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    tables.overwrite_partition(rows, path, "y")
    tables.overwrite_partition(rows.filter("y = 1998").withColumn("o_totalprice", F.lit(0.0)), path, "y")
    return t.spark.read.parquet(path)


@query("snk05_append", "event_id:l copies:l", "SELECT event_id, 2 AS copies FROM events")
def snk05_append(t: Lake):
    path = work_dir(t.spark, "table")
    tables.append(t.events, path)
    tables.append(t.events, path)
    return t.spark.read.parquet(path).groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


@query("snk06_full_refresh", "o_custkey:l n:l", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def snk06_full_refresh(t: Lake):
    path = work_dir(t.spark, "table")
    tables.full_refresh(t.events.groupBy("user_id").count(), path)
    return tables.full_refresh(t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), path)


@query("snk07_view", "o_orderkey:l year:i", "SELECT o_orderkey, year(o_orderdate) AS year FROM orders")
def snk07_view(t: Lake):
    tables.as_view(t.orders, "tidemark_orders")
    return t.spark.sql("SELECT o_orderkey, year(o_orderdate) AS year FROM tidemark_orders")


_VERSION = "claim_id:s claim_status:s claim_amount:d updated_at:t source_file:s loaded_at:t"


@query("snk08_upsert_version_log", _VERSION, "SELECT * FROM slv_claims", "slv_claims")
def snk08_upsert_version_log(t: Lake):
    """A stored log, built day by day of partitions: two loads, the second one twice."""
    bronze = feeds.claims(t)
    table = KeyedTable(t.spark, work_dir(t.spark, "table"), ["claim_id", "updated_at"],
                       tables.day_of("updated_at"))
    early = bronze.filter(F.col("loaded_at") <= F.lit("2024-01-15").cast("timestamp_ntz"))
    table.upsert(models.slv_claim_events(early))
    table.upsert(models.slv_claim_events(bronze, table.read()))
    table.upsert(models.slv_claim_events(bronze, table.read()))
    return table.read()


@query("snk18_schema_change", "o_custkey:l o_orderkey:l o_totalprice:d refused:i",
       """SELECT o_custkey, o_orderkey, o_totalprice, 3 AS refused FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def snk18_schema_change(t: Lake):
    """Batches with a column less, one more and one of another type are refused and leave no row; the right one merges."""
    latest = latest_per(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")
    table = KeyedTable(t.spark, work_dir(t.spark, "table"), ["o_custkey"], tables.bucket_of(["o_custkey"], 8))
    table.upsert(latest.withColumn("o_totalprice", F.lit(0.0)))
    refused = 0
    for batch in (latest.drop("o_totalprice"), latest.withColumn("extra", F.lit(1)),
                  latest.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))):
        try:
            table.upsert(batch)
        except SchemaChanged:
            refused += 1
    table.upsert(latest)
    return table.read().withColumn("refused", F.lit(refused))


@query("snk08_null_version_refused", _VERSION, "SELECT * FROM slv_claims", "slv_claims")
def snk08_null_version_refused(t: Lake):
    """Batches with NULL versions, alone or among others, change nothing and block nothing."""
    claims = tables.stored(t.spark, models.slv_claim_events(feeds.claims(t)))  # four batches come from it
    table = KeyedTable(t.spark, work_dir(t.spark, "table"), ["claim_id", "updated_at"], tables.month_of("updated_at"))
    broken = claims.withColumn("updated_at", F.lit(None).cast("timestamp_ntz")).dropDuplicates(["claim_id"])
    table.upsert(claims.filter(F.col("claim_status") == "OPEN"))
    for batch in (broken, claims.unionByName(broken)):
        try:
            table.upsert(batch)
        except tables.NoPartition:
            continue
        raise AssertionError("a batch with NULL versions was taken")
    table.upsert(claims)
    return table.read()


@query("snk09_upsert_scd1", "o_custkey:l o_orderkey:l o_orderdate:t o_totalprice:d",
       """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def snk09_upsert_scd1(t: Lake):
    """Latest order per customer in hash buckets. The newer half arrives first and still wins."""
    table = KeyedTable(t.spark, work_dir(t.spark, "table"), ["o_custkey"],
                       tables.bucket_of(["o_custkey"], 16), newest=["o_orderdate", "o_orderkey"])
    cut = F.lit("1998-06-30").cast("timestamp_ntz")
    for part in (t.orders.filter(F.col("o_orderdate") > cut), t.orders.filter(F.col("o_orderdate") <= cut)):
        table.upsert(latest_per(part, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    return table.read()


@query("snk10_upsert_unconditional", "o_custkey:l o_orderkey:l",
       """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
            ORDER BY (o_orderdate <= TIMESTAMP '1998-06-30') DESC, o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders) WHERE rn = 1""")
def snk10_upsert_unconditional(t: Lake):
    """Without an order between versions the batch replaces what it meets."""
    cut = F.lit("1998-06-30").cast("timestamp_ntz")
    late, early = (latest_per(t.orders.filter(side), ["o_custkey"], ["o_orderdate", "o_orderkey"])
                   for side in (F.col("o_orderdate") > cut, F.col("o_orderdate") <= cut))
    return upsert.merged(late, early, ["o_custkey"])


@query("snk11_insert_missing", "key:l name:s",
       """SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL
          SELECT DISTINCT user_id, 'seed' FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)
          UNION ALL SELECT DISTINCT l_partkey, 'seed' FROM lineitem
            WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)
            AND l_partkey NOT IN (SELECT user_id FROM events)""")
def snk11_insert_missing(t: Lake):
    live = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    wanted = t.events.select(F.col("user_id").alias("key")).union(t.lineitem.select("l_partkey")).distinct()
    return upsert.insert_missing(live, wanted.withColumn("name", F.lit("seed")), ["key"])


# ------------------------------------------------------------ control


def _old_marks(t: Lake, until="2024-01-20"):
    """Watermarks of an earlier run: the newest event before a day, errors not at all yet."""
    known = t.events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    marks = watermarks(Known(t, known)).withColumn("last_run_id", F.lit("old")).withColumn(
        "updated_at", F.lit("2024-01-20").cast("timestamp"))
    return marks.select([f.name for f in control.WATERMARKS.fields])


class Known(Lake):
    """A lake with some of its events replaced."""

    def __init__(self, lake: Lake, events: DataFrame):
        super().__init__(lake.spark, lake.folder)
        self.events = events


cte("old_marks", """SELECT 'api' AS source_name, event_type AS entity, max(ts) AS high_watermark
                    FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 2""")
# what a run loaded: views up to an earlier day only, clicks nothing at all
cte("loaded", """SELECT entity, max(CASE WHEN entity = 'click' THEN NULL
                   WHEN entity = 'view' AND ts >= TIMESTAMP '2024-01-05' THEN NULL ELSE ts END) AS max_changed_at
                 FROM (SELECT event_type AS entity, ts FROM events) GROUP BY 1""")


def _loaded(t: Lake):
    kind, ts = F.col("event_type"), F.col("ts")
    seen = F.when(kind == "click", F.lit(None)).when(
        (kind == "view") & (ts >= F.lit("2024-01-05").cast("timestamp_ntz")), F.lit(None)).otherwise(ts)
    return t.events.groupBy(kind.alias("entity")).agg(F.max(seen).alias("max_changed_at")).select(
        F.lit("api").alias("source_name"), "entity", "max_changed_at", F.lit("new").alias("run_id"))


_ADVANCED = """SELECT m.source_name, m.entity,
    CASE WHEN l.max_changed_at > m.high_watermark THEN l.max_changed_at ELSE m.high_watermark END AS high_watermark,
    CASE WHEN l.max_changed_at IS NULL THEN 'old' ELSE 'new' END AS last_run_id
    FROM old_marks m LEFT JOIN loaded l ON l.entity = m.entity"""


@query("snk12_advance_watermarks", "source_name:s entity:s high_watermark:t last_run_id:s",
       _ADVANCED, "old_marks loaded")
def snk12_advance_watermarks(t: Lake):
    return control.advance_watermarks(_old_marks(t), _loaded(t))


def _audit(t: Lake):
    """(run, entity) pairs of every day and event type, as a run reports them."""
    return t.events.groupBy(
        F.concat(F.lit("run-"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.lit("api").alias("source_name"), F.col("event_type").alias("entity"),
        F.to_date("ts").alias("business_date"),
    ).agg(F.min("ts").alias("window_start"), F.max("ts").alias("window_end"),
          F.count(F.lit(1)).alias("row_count_manifest"), F.count(F.lit(1)).alias("row_count_loaded"),
          F.max("ts").alias("max_updated_at"))


cte("audit", """SELECT 'run-' || strftime(ts, '%Y%m%d') AS run_id, event_type AS entity,
    CAST(ts AS DATE) AS business_date, min(ts) AS window_start, max(ts) AS window_end, count(*) AS n
    FROM events GROUP BY 1, 2, 3""")
_AUDIT = "run_id:s entity:s business_date:D status:s row_count_loaded:d window_end:t error_message:s"


def _failed_first(t: Lake):
    """Days before the 10th succeeded, days from the 10th to the 20th failed."""
    runs = t.spark.createDataFrame([], control.EXTRACT_RUNS)
    days = _audit(t)
    done = days.filter(F.col("business_date") < F.lit("2024-01-10").cast("date"))
    broken = days.filter((F.col("business_date") >= F.lit("2024-01-10").cast("date"))
                         & (F.col("business_date") < F.lit("2024-01-20").cast("date")))
    runs = control.record_success(runs, done)
    return control.record_failure(runs, broken.select("run_id", "source_name", "entity", "business_date",
                                                      F.repeat(F.lit("x"), 5000).alias("error_message")))


@query("snk13_record_success", _AUDIT,
       """SELECT run_id, entity, business_date, 'SUCCEEDED' AS status, n AS row_count_loaded, window_end,
          NULL AS error_message FROM audit""", "audit")
def snk13_record_success(t: Lake):
    """Every run succeeds in the end: failed ones are corrected, missing ones inserted."""
    return control.record_success(_failed_first(t), _audit(t))


@query("snk14_record_failure", _AUDIT + " message_length:d",
       """SELECT run_id, entity, business_date,
          CASE WHEN business_date < DATE '2024-01-10' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
          CASE WHEN business_date < DATE '2024-01-10' THEN n END AS row_count_loaded,
          CASE WHEN business_date < DATE '2024-01-10' THEN window_end END AS window_end,
          CASE WHEN business_date >= DATE '2024-01-10' THEN repeat('y', 4000) END AS error_message,
          CASE WHEN business_date >= DATE '2024-01-10' THEN 4000 END AS message_length FROM audit""", "audit")
def snk14_record_failure(t: Lake):
    """A failure reported for every run: those that succeeded stay succeeded."""
    failures = _audit(t).select("run_id", "source_name", "entity", "business_date",
                                F.repeat(F.lit("y"), 6000).alias("error_message"))
    return control.record_failure(_failed_first(t), failures).withColumn(
        "message_length", F.length("error_message"))


@query("snk15_commit_control", "source_name:s entity:s high_watermark:t last_run_id:s runs:l",
       f"""SELECT a.*, r.runs FROM ({_ADVANCED}) a
           JOIN (SELECT entity, count(*) AS runs FROM audit GROUP BY 1) r ON r.entity = a.entity""",
       "old_marks loaded audit")
def snk15_commit_control(t: Lake):
    """Watermarks and audit committed together; the latest commit is what is read."""
    store = ControlStore(t.spark, work_dir(t.spark, "control"))
    store.commit({"watermarks": _old_marks(t), "extract_runs": _failed_first(t)})
    store.commit({
        "watermarks": control.advance_watermarks(store.read("watermarks", control.WATERMARKS), _loaded(t)),
        "extract_runs": control.record_success(store.read("extract_runs", control.EXTRACT_RUNS), _audit(t)),
    })
    runs = store.read("extract_runs", control.EXTRACT_RUNS).groupBy("entity").agg(F.count(F.lit(1)).alias("runs"))
    return store.read("watermarks", control.WATERMARKS).join(runs, "entity")


# ------------------------------------------------------------ snapshots


_CUTS = ("1996-07-01", "1998-07-01", "2000-07-01")
_SEEN = " UNION ALL ".join(
    f"""SELECT * EXCLUDE (rn) FROM (SELECT o_custkey, o_orderdate, o_orderpriority, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderdate <= TIMESTAMP '{cut}') WHERE rn = 1""" for cut in _CUTS)
_SEEN_SQL = f"""SELECT o_custkey, o_orderpriority, o_orderdate AS valid_from,
    coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate),
             TIMESTAMP '9999-12-31') AS valid_to FROM (SELECT DISTINCT * FROM ({_SEEN}))"""


def _state(t: Lake, cut: str):
    known = t.orders.filter(F.col("o_orderdate") <= F.lit(cut).cast("timestamp_ntz"))
    return latest_per(known, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderdate", "o_orderpriority")


@query("snk16_snapshot_merge", "o_custkey:l o_orderpriority:s valid_from:t valid_to:t", _SEEN_SQL)
def snk16_snapshot_merge(t: Lake):
    """Three runs, then the last repeated and an older state: both change nothing."""
    from tidemark.operators.history import snapshot_merge

    past = None
    for cut in (*_CUTS, _CUTS[-1], _CUTS[0]):
        past = tables.stored(t.spark, snapshot_merge(past, _state(t, cut), "o_custkey", "o_orderdate"))
    return past


@query("snk17_ordered_backfill", "o_custkey:l o_orderpriority:s valid_from:t valid_to:t", _SEEN_SQL)
def snk17_ordered_backfill(t: Lake):
    """The same history from one table of dumps, backfilled by business date."""
    from tidemark.operators.history import snapshot_merge

    dumps = reduce(DataFrame.unionByName,
                   [_state(t, cut).withColumn("business_date", F.lit(cut).cast("date")) for cut in _CUTS])
    past = None
    for cut in _CUTS:
        day = selection.pick_business_date(dumps, "business_date", cut).drop("business_date")
        past = tables.stored(t.spark, snapshot_merge(past, day, "o_custkey", "o_orderdate"))
    return past


# ------------------------------------------------------------ streams


def _streamed(t: Lake, kind: str, root: str, again: int = 0) -> DataFrame:
    table, checkpoint = work_dir(t.spark, "landing"), work_dir(t.spark, "checkpoint")
    for _ in range(1 + again):
        ingest(t.spark, root, table, checkpoint, kind)
    return t.spark.read.parquet(table)


@query("str01_file_ingest", _LANDED, _LANDED_SQL)
def str01_file_ingest(t: Lake):
    rows = _streamed(t, "ndjson", _lake_of_events(t) + "/events")
    return typed(rows, _EVENT_FIELDS, ["business_date", "run_id"])


@query("str02_parquet_ingest", "o_orderkey:l o_orderstatus:s o_totalprice:d business_date:D",
       "SELECT *, DATE '2001-08-01' AS business_date FROM orders")
def str02_parquet_ingest(t: Lake):
    root = work_dir(t.spark, "lake")
    tables.overwrite_partition(t.orders.withColumn("dt", F.lit("2001-08-01").cast("date")), root, "dt")
    return typed(_streamed(t, "parquet", root), {
        "o_orderkey": ("o_orderkey", "bigint"), "o_orderstatus": ("o_orderstatus", "string"),
        "o_totalprice": ("o_totalprice", "double")}, ["business_date"])


@query("str03_once_per_file", _EVENT, "SELECT * FROM events")
def str03_once_per_file(t: Lake):
    """Ingesting again finds no new file name and adds nothing."""
    return typed(_streamed(t, "ndjson", _lake_of_events(t) + "/events", again=2), _EVENT_FIELDS)


@query("str03_open_days", _EVENT, "SELECT * FROM events")
def str03_open_days(t: Lake):
    """Day folders as streams: all days, then files that come late for the open ones; closed days are not listed again."""
    root, table, checkpoint = work_dir(t.spark, "lake"), work_dir(t.spark, "landing"), work_dir(t.spark, "checkpoint")
    late = (F.to_date("ts") >= F.lit("2024-01-25").cast("date")) & (F.col("event_id") % 2 == 0)
    days = [r.day for r in t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct().orderBy("day").collect()]  # of a month
    for part, opened in ((~late, days), (late, [d for d in days if d >= "2024-01-25"])):
        t.events.filter(part).withColumn("dt", F.to_date("ts")).hint("rebalance", "dt").write.mode("append").partitionBy("dt").option("timestampNTZFormat", landing.ISO_MICROS).json(root)
        ingest_days(t.spark, root, table, checkpoint, opened)
    return typed(t.spark.read.parquet(table), _EVENT_FIELDS)


@query("str04_high_watermark", "entity:s high_watermark:t", "SELECT * FROM watermarks", "watermarks")
def str04_high_watermark(t: Lake):
    """Runs that see more and more of the feed move the watermark to its end."""
    marks = _old_marks(t, "2024-01-05")
    for until in ("2024-01-15", "2024-01-10", "2024-02-01"):
        loaded = _old_marks(t, until).select(
            "source_name", "entity", F.col("high_watermark").alias("max_changed_at"), F.lit(until).alias("run_id"))
        marks = control.advance_watermarks(marks, loaded)
    return marks


@query("str05_source_lookback", _EVENT,
       """SELECT e.* FROM events e JOIN old_marks m ON m.entity = e.event_type
          WHERE e.ts > m.high_watermark - INTERVAL 2 HOUR AND e.ts <= TIMESTAMP '2024-01-25'""", "old_marks")
def str05_source_lookback(t: Lake):
    """What the next run pulls: from two hours before each entity's watermark."""
    windows = selection.plan_window(_old_marks(t), "2024-01-25").filter(~F.col("is_empty"))
    w = F.broadcast(windows.select("entity", "window_start", "window_end"))  # one row per entity
    return t.events.join(w, (F.col("event_type") == F.col("entity")) & (F.col("ts") > F.col("window_start"))
                         & (F.col("ts") <= F.col("window_end"))).select(*t.events.columns)


@query("str06_load_lookback", _VERSION, "SELECT * FROM slv_claims", "slv_claims")
def str06_load_lookback(t: Lake):
    """Three incremental loads that overlap by their lookback give the full build."""
    bronze = feeds.claims(t)
    table = None
    for until in ("2024-01-08", "2024-01-20", "2024-03-01"):
        seen = bronze.filter(F.col("loaded_at") <= F.lit(until).cast("timestamp_ntz"))
        batch = models.slv_claim_events(seen, table)
        table = tables.stored(t.spark, batch if table is None else upsert.merged(table, batch, ["claim_id", "updated_at"]))
    return table


@query("str07_streaming_upsert", _VERSION, "SELECT * FROM slv_claims", "slv_claims")
def str07_streaming_upsert(t: Lake):
    """Landing files streamed into a version log; of all deliveries the last one stays."""
    path = work_dir(t.spark, "landing")
    landing.bronze(feeds.claims(t)).write.parquet(path)
    table = KeyedTable(t.spark, work_dir(t.spark, "table"), ["claim_id", "updated_at"],
                       tables.day_of("updated_at"), newest=["loaded_at", "source_file"])
    upsert_stream(t.spark, path, table, work_dir(t.spark, "checkpoint"),
                  lambda rows: typed(rows, CLAIMS.fields, ["source_file", "loaded_at"]))
    return table.read()


@query("str07_stateful_dedup", _VERSION, "SELECT * FROM slv_claims", "slv_claims")
def str07_stateful_dedup(t: Lake):
    """Deliveries streamed through keyed state, newest files first, with a restart in mid-stream."""
    path, table, checkpoint = (work_dir(t.spark, name) for name in ("landing", "deduplicated", "checkpoint"))
    rows = landing.bronze(feeds.claims(t))
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    keys = ["claim_id", "updated_at"]
    for part in (F.col("loaded_at") > cut, F.col("loaded_at") <= cut):
        rows.filter(part).write.mode("append").parquet(path)
        dedup_stream(t.spark, path, table, checkpoint, lambda r: typed(r, CLAIMS.fields, ["run_id", "source_file", "loaded_at"]), keys,
                     files_per_batch=4)
    return read_deduplicated(t.spark, table, keys)


@query("str08_late_version", "o_custkey:l valid_from:t valid_to:t o_orderpriority:s",
       """SELECT o_custkey, o_orderdate AS valid_from, o_orderpriority,
          coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate), TIMESTAMP '9999-12-31') AS valid_to
          FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
                FROM orders) WHERE rn = 1""")
def str08_late_version(t: Lake):
    """Older versions that arrive last fall into their place on the next build."""
    from tidemark.operators.history import scd2_windows
    from tidemark.operators.skew import find_pieces

    log = latest_per(t.orders, ["o_custkey", "o_orderdate"], ["o_orderkey"])
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    late_last = upsert.merged(log.filter(F.col("o_orderdate") >= cut), log.filter(F.col("o_orderdate") < cut),
                              ["o_custkey", "o_orderdate"])
    pieces = find_pieces(t.orders, "o_custkey", "o_orderdate")
    return scd2_windows(late_last, "o_custkey", "o_orderdate", ["o_orderpriority"], pieces=pieces)


@query("str09_gap_catch_up", "day:D pulled:l",
       """SELECT CAST(ts AS DATE) AS day, count(*) AS pulled FROM events
          WHERE ts > TIMESTAMP '2024-01-09 22:00:00' AND ts <= TIMESTAMP '2024-01-25' GROUP BY 1""")
def str09_gap_catch_up(t: Lake):
    """Two weeks without a run: the window starts at the watermark and covers them all."""
    mark = t.spark.range(1).select(F.lit("api").alias("source_name"), F.lit("events").alias("entity"),
                                   F.lit("2024-01-10").cast("timestamp_ntz").alias("high_watermark"))
    w = selection.plan_window(mark, "2024-01-25").first()
    pulled = selection.changes_between(t.events, "ts", w.window_start, w.window_end)
    return pulled.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("pulled"))


@query("str10_backlog", "run_id:s row_count:l",
       """SELECT 'run-' || strftime(ts, '%Y%m%d') AS run_id, count(*) AS row_count FROM events GROUP BY 1""")
def str10_backlog(t: Lake):
    """Files that landed before the stream existed are loaded by its first start."""
    return _streamed(t, "ndjson", _lake_by_day(t)).groupBy("run_id").agg(F.count(F.lit(1)).alias("row_count"))


@query("dq14_reconcile_manifest", "entity:s expected_rows:l loaded_rows:l status:s files_agree:b",
       """SELECT w.entity, count(e.event_id) AS expected_rows, count(e.event_id) AS loaded_rows, 'DONE' AS status,
          true AS files_agree FROM (SELECT * FROM watermarks UNION ALL SELECT 'api', 'refund', NULL) w
          LEFT JOIN events e ON e.event_type = w.entity GROUP BY 1""", "watermarks")
def dq14_reconcile_manifest(t: Lake):
    """Files written, manifest written, files ingested, counts compared per entity."""
    root, manifest = _run_with_manifest(t)
    loaded = _streamed(t, "ndjson", root).select(
        F.split_part(F.split_part("source_file", F.lit("/dt="), F.lit(1)), F.lit("/"), F.lit(-1)).alias("entity"),
        "source_file")
    report = quality.reconcile(manifest, loaded)
    return report.withColumn("files_agree", F.col("file_status") == "DONE")


_CLAIM_COLUMNS = ["claim_id", "policy_id", "claim_amount", "claim_status", "updated_at"]
_DIGEST_SQL = "('0x' || substr(md5(" + " || '|' || ".join(
    f"coalesce('=' || {c}, '-')" for c in ("claim_id", "policy_id", "CAST({amount} AS DECIMAL(12,2))::VARCHAR", "claim_status", "strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f')")
) + "), 1, 15))::BIGINT::HUGEINT"
_SUM_SQL = "(sum(" + _DIGEST_SQL + ") % 1152921504606846976)::BIGINT"


@query(
    "dq14_content_reconciliation", "business_date:D expected_rows:l loaded_rows:l expected_content:l loaded_content:l status:s",
    f"""WITH swapped AS (
        SELECT *, CASE WHEN day(updated_at) % 5 = 0 THEN coalesce(lead(claim_amount) OVER w, first_value(claim_amount) OVER w) ELSE claim_amount END AS other
        FROM slv_claims WINDOW w AS (PARTITION BY CAST(updated_at AS DATE) ORDER BY claim_id, updated_at ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
      a AS (SELECT CAST(updated_at AS DATE) AS business_date, count(*) AS n, {_SUM_SQL.format(amount='claim_amount')} AS content FROM slv_claims GROUP BY 1),
      b AS (SELECT CAST(updated_at AS DATE) AS business_date, count(*) AS n, {_SUM_SQL.format(amount='other')} AS content FROM swapped
            WHERE NOT (day(updated_at) % 7 = 0 AND claim_status = 'PAID') GROUP BY 1)
      SELECT business_date, a.n AS expected_rows, ifnull(b.n, 0) AS loaded_rows, a.content AS expected_content, b.content AS loaded_content,
        CASE WHEN ifnull(b.n, 0) < a.n THEN 'NOT_YET' WHEN a.content = b.content THEN 'DONE' ELSE 'CHANGED' END AS status
      FROM a LEFT JOIN b USING (business_date)""", "slv_claims")
def dq14_content_reconciliation(t: Lake):
    """Days on which amounts moved to other claims (equal counts and equal sums), days with rows missing, and days as announced."""
    from pyspark.sql import Window

    claims = tables.stored(t.spark, models.slv_claim_events(feeds.claims(t)))
    day = F.to_date("updated_at")
    own = claims.withColumn("business_date", day).withColumn("claim_amount", F.col("claim_amount").cast("decimal(12,2)"))
    in_day = Window.partitionBy("business_date").orderBy("claim_id", "updated_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nth = Window.partitionBy("business_date").orderBy("claim_id", "updated_at")
    moved = F.when(F.dayofmonth("updated_at") % 5 == 0, F.coalesce(F.lead("claim_amount").over(nth), F.first("claim_amount").over(in_day)))
    arrived = own.withColumn("claim_amount", F.coalesce(moved, F.col("claim_amount"))).filter(
        ~((F.dayofmonth("updated_at") % 7 == 0) & (F.col("claim_status") == "PAID")))
    sums = [quality.content_sums(df.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")), ["business_date"], _CLAIM_COLUMNS)
            for df in (own, arrived)]
    return quality.reconcile_content(*sums, ["business_date"])
