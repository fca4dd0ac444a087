"""Change windows, incremental selection, feed pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import selection, skew
from tidemark.operators.facts import accumulate
from tidemark.plans import models
from tidemark.queries import feeds
from tidemark.session import work_dir
from tidemark.queries.registry import Lake, cte, query

_EVENT = "event_id:l user_id:l ts:t event_type:s value:d"


@query("win01_change_window", _EVENT,
       """SELECT * FROM events
          WHERE ts > TIMESTAMP '2024-01-10 06:00:00' AND ts <= TIMESTAMP '2024-01-12 18:30:00'""")
def win01_change_window(t: Lake):
    return selection.changes_between(t.events, "ts", "2024-01-10 06:00:00", "2024-01-12 18:30:00")


def _dumps(t: Lake):
    """Two full dumps hold every order: the one of its own day, and the one a week later."""
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_custkey", "o_orderkey", "o_orderdate",
        F.explode(F.array(day, F.date_add(day, 7))).alias("snapshot_date"),
    )


@query("win02_snapshots_to_changes", "o_custkey:l o_orderkey:l o_orderdate:t snapshot_date:D",
       """SELECT o_custkey, o_orderkey, o_orderdate, snapshot_date FROM (
            SELECT *, CAST(o_orderdate AS DATE) + d.n AS snapshot_date
            FROM orders CROSS JOIN (VALUES (0), (7)) d(n))
          WHERE CAST(o_orderdate AS DATE) = snapshot_date""")
def win02_snapshots_to_changes(t: Lake):
    return selection.snapshots_to_changes(_dumps(t), "o_orderdate", "snapshot_date")


@query("win03_as_of", "o_custkey:l o_orderkey:l o_orderdate:t o_orderpriority:s",
       """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
          WHERE CAST(o_orderdate AS DATE) <= DATE '1998-03-15') WHERE rn = 1""")
def win03_as_of(t: Lake):
    return selection.as_of(t.orders, "o_custkey", "o_orderdate", "1998-03-15", ["o_orderkey"])


@query("win04_ordered_feed", _EVENT, "SELECT * FROM events ORDER BY ts, event_id")
def win04_ordered_feed(t: Lake):
    return selection.ordered_feed(t.events, "ts", "event_id")


@query("win05_feed_page", _EVENT + " has_more:b",
       """SELECT *, (SELECT count(*) FROM events) > 300 AS has_more
          FROM (SELECT * FROM events ORDER BY ts, event_id LIMIT 100 OFFSET 200)""")
def win05_feed_page(t: Lake):
    return selection.feed_page(t.events, "ts", "event_id", size=100, offset=200)


@query("win05_feed_page_after", "o_orderkey:l o_orderdate:t has_more:b",
       """SELECT o_orderkey, o_orderdate,
            (SELECT count(*) FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-05'
               OR (o_orderdate = TIMESTAMP '1998-01-05' AND o_orderkey > 700)) > 500 AS has_more
          FROM (SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-05'
               OR (o_orderdate = TIMESTAMP '1998-01-05' AND o_orderkey > 700)
               ORDER BY o_orderdate, o_orderkey LIMIT 500)""")
def win05_feed_page_after(t: Lake):
    """The page that follows a given row; sizes above 500 are cut to 500."""
    import datetime as dt

    return selection.feed_page(t.orders, "o_orderdate", "o_orderkey", size=9999,
                               after=(dt.datetime(1998, 1, 5), 700))


# ------------------------------------------------------------ watermarks as the plan of a run


def watermarks(t: Lake):
    """One watermark per event type: its newest event."""
    return t.events.groupBy(F.col("event_type").alias("entity")).agg(
        F.max("ts").alias("high_watermark")
    ).select(F.lit("api").alias("source_name"), "entity", "high_watermark")


cte("watermarks", """SELECT 'api' AS source_name, event_type AS entity, max(ts) AS high_watermark
                     FROM events GROUP BY event_type""")

UNTIL = "2024-01-30 22:00:00"
_WINDOW = "entity:s high_watermark:t window_start:t window_end:t is_empty:b"
_WINDOW_SQL = f"""SELECT entity, high_watermark, high_watermark - INTERVAL 2 HOUR AS window_start,
    TIMESTAMP '{UNTIL}' AS window_end,
    high_watermark - INTERVAL 2 HOUR >= TIMESTAMP '{UNTIL}' AS is_empty FROM watermarks"""


@query("win06_window_start", _WINDOW, _WINDOW_SQL, "watermarks")
def win06_window_start(t: Lake):
    return selection.plan_window(watermarks(t), UNTIL)


@query("win07_empty_window", "entity:s pulled:l max_changed_at:t",
       """SELECT w.entity, count(e.event_id) AS pulled, max(e.ts) AS max_changed_at
          FROM watermarks w LEFT JOIN events e ON e.event_type = w.entity
            AND w.high_watermark - INTERVAL 2 HOUR < TIMESTAMP '2024-01-30 21:00:00'
            AND e.ts > w.high_watermark - INTERVAL 2 HOUR AND e.ts <= TIMESTAMP '2024-01-30 21:00:00'
          GROUP BY 1""", "watermarks")
def win07_empty_window(t: Lake):
    """Entities whose watermark lies beyond the window pull no row and have no maximum."""
    windows = selection.plan_window(watermarks(t), "2024-01-30 21:00:00")
    live = windows.filter(~F.col("is_empty")).select("entity", "window_start", "window_end")
    pulled = t.events.join(F.broadcast(live), (F.col("event_type") == F.col("entity"))
                           & (F.col("ts") > F.col("window_start")) & (F.col("ts") <= F.col("window_end")))
    counts = pulled.groupBy("entity").agg(F.count("event_id").alias("pulled"),
                                          F.max("ts").alias("max_changed_at"))
    return windows.select("entity").join(counts, "entity", "left").na.fill(0, ["pulled"])


@query("win08_read_watermarks", "source_name:s entity:s high_watermark:t",
       "SELECT * FROM watermarks WHERE entity IN ('click', 'purchase', 'view')", "watermarks")
def win08_read_watermarks(t: Lake):
    return selection.read_watermarks(watermarks(t), "api", ["click", "purchase", "view"])


@query("win09_plan_request", "run_id:s business_date:D window_end:t is_safe:b",
       r"""SELECT regexp_replace('manual:' || event_id || '+' || event_type || '@'
              || strftime(ts, '%H:%M'), '[^A-Za-z0-9_.-]', '_', 'g') AS run_id,
            CAST(ts AS DATE) - 1 AS business_date, date_trunc('second', ts) AS window_end,
            true AS is_safe FROM events""")
def win09_plan_request(t: Lake):
    runs = t.events.select(
        F.concat(F.lit("manual:"), F.col("event_id").cast("string"), F.lit("+"), "event_type",
                 F.lit("@"), F.date_format("ts", "HH:mm")).alias("run_id"),
        F.col("ts").alias("run_after"),
    )
    return selection.plan_request(runs)


_SPLIT = "2024-01-15"


@query("win10_incremental_read", "claim_id:s source_file:s loaded_at:t",
       f"""SELECT claim_id, source_file, loaded_at FROM claims_d WHERE loaded_at > (
            SELECT max(loaded_at) - INTERVAL 3 HOUR FROM claims_d
            WHERE loaded_at <= TIMESTAMP '{_SPLIT}')""", "claims_d")
def win10_incremental_read(t: Lake):
    rows = feeds.claim_rows(t)
    target = rows.filter(F.col("loaded_at") <= F.lit(_SPLIT).cast("timestamp_ntz"))
    return selection.incremental(rows, target)


def _by_load_day(t: Lake, df, loaded_at: str):
    """A table stored in partitions by the day of its loads."""
    path = work_dir(t.spark, "by-load-day")
    df.withColumn("load_day", F.to_date(loaded_at)).hint("rebalance", "load_day").write.partitionBy("load_day").parquet(path)
    return t.spark.read.parquet(path)


@query("win10_newest_partition", "claim_id:s source_file:s loaded_at:t",
       f"""SELECT claim_id, source_file, loaded_at FROM claims_d WHERE loaded_at > (
            SELECT max(loaded_at) - INTERVAL 3 HOUR FROM claims_d
            WHERE loaded_at <= TIMESTAMP '{_SPLIT}')""", "claims_d")
def win10_newest_partition(t: Lake):
    """The newest load is looked for in the target's newest partition only."""
    rows = feeds.claim_rows(t)
    target = _by_load_day(t, rows.filter(F.col("loaded_at") <= F.lit(_SPLIT).cast("timestamp_ntz")), "loaded_at")
    return selection.incremental(rows, target, target_day="load_day")


@query("win10_incremental_empty_target", "claim_id:s source_file:s loaded_at:t",
       "SELECT claim_id, source_file, loaded_at FROM claims_d", "claims_d")
def win10_incremental_empty_target(t: Lake):
    """A target without rows has no newest load: everything is selected."""
    rows = feeds.claim_rows(t)
    return selection.incremental(rows, rows.filter(F.col("loaded_at") < F.col("updated_at")))


_OLD_FACTS = f"SELECT max(loaded_at) FROM slv_claims WHERE loaded_at <= TIMESTAMP '{_SPLIT}'"
cte("changed_claims", f"""SELECT DISTINCT claim_id FROM slv_claims
    WHERE loaded_at > ({_OLD_FACTS}) - INTERVAL 3 HOUR""", "slv_claims")


def _events_and_facts(t: Lake):
    events = models.slv_claim_events(feeds.claims(t))
    known = events.filter(F.col("loaded_at") <= F.lit(_SPLIT).cast("timestamp_ntz"))
    facts = accumulate(known, "claim_id", "updated_at", "claim_status", {}, loaded_at="loaded_at")
    return events, facts


@query("win11_changed_keys", "claim_id:s", "SELECT claim_id FROM changed_claims", "changed_claims")
def win11_changed_keys(t: Lake):
    events, facts = _events_and_facts(t)
    return selection.changed_keys(events, facts, "claim_id")


@query("win11_newest_partition", "claim_id:s", "SELECT claim_id FROM changed_claims", "changed_claims")
def win11_newest_partition(t: Lake):
    events, facts = _events_and_facts(t)
    return selection.changed_keys(events, _by_load_day(t, facts, "last_loaded_at"), "claim_id", target_day="load_day")


@query("win12_events_of_changed_keys", "claim_id:s claim_status:s updated_at:t",
       "SELECT e.* FROM slv_claims e JOIN changed_claims c ON c.claim_id = e.claim_id",
       "slv_claims changed_claims")
def win12_events_of_changed_keys(t: Lake):
    events, facts = _events_and_facts(t)
    return selection.events_of(events, selection.changed_keys(events, facts, "claim_id"), "claim_id")


@query("win13_latest_business_date", "policyholder_id:l city:s business_date:D",
       """SELECT * FROM holders_d WHERE business_date = (SELECT max(business_date) FROM holders_d)""",
       "holders_d")
def win13_latest_business_date(t: Lake):
    return selection.pick_business_date(feeds.holder_rows(t))


@query("win13_given_business_date", "policyholder_id:l city:s business_date:D",
       "SELECT * FROM holders_d WHERE business_date = DATE '1997-05-05'", "holders_d")
def win13_given_business_date(t: Lake):
    return selection.pick_business_date(feeds.holder_rows(t), day="1997-05-05")


@query("win14_rows_of_attempt", "policyholder_id:l source_file:s",
       """SELECT policyholder_id, source_file FROM holders_d
          WHERE run_id = 'r1' AND source_file LIKE '%/attempt=a/%'""", "holders_d")
def win14_rows_of_attempt(t: Lake):
    return selection.rows_of_attempt(feeds.holder_rows(t), "r1", "a")


# ------------------------------------------------------------ sort, set


@query("srt01_global_order", "source_name:s entity:s high_watermark:t",
       "SELECT * FROM watermarks ORDER BY entity", "watermarks")
def srt01_global_order(t: Lake):
    return watermarks(t).orderBy("entity")


@query("srt02_offset_limit", "o_orderkey:l o_orderdate:t o_totalprice:d",
       """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
          ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 1000""")
def srt02_offset_limit(t: Lake):
    return t.orders.orderBy("o_orderdate", "o_orderkey").offset(1000).limit(50)


@query("set02_required_minus_present", "o_custkey:l",
       "SELECT c_custkey AS o_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def set02_required_minus_present(t: Lake):
    """Customers without an order since 2000."""
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    return selection.missing_keys(
        t.customer.select(F.col("c_custkey").alias("o_custkey")), recent.select("o_custkey"), "o_custkey"
    )


@query("skew_hot_keys", "l_partkey:l",
       "SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_partkey LIMIT 100")
def skew_hot_keys(t: Lake):
    """The 100 keys that own most rows, a report."""
    keys = skew.hot_keys(t.lineitem, "l_partkey", min_rows=1)
    rows = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return keys.join(rows, F.col("__hot_key") == F.col("l_partkey")).orderBy(F.desc("n"), "l_partkey").limit(100).select("l_partkey")
