"""Projections, predicates, functions, joins, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.keys import (
    MICROS, classify, date_key, hash_key, is_safe_run_id, or_unknown, path_part,
    safe_run_id, to_naive_utc, version_key,
)
from tidemark.operators import facts, history, quality, selection, skew
from tidemark.operators.calendar import describe_days, spine_over
from tidemark.operators.versions import latest_per, typed
from tidemark.plans import models
from tidemark.queries import feeds
from tidemark.queries.model_queries import claim_facts, dim_holder, narrow_star, star
from tidemark.queries.registry import Lake, query
from tidemark.sources.landing import to_records
from tidemark.spec import CLAIMS, POLICIES, POLICYHOLDERS

# ------------------------------------------------------------ projections


@query("prj01_typed_claims", "claim_id:s policy_id:s loss_date:D reported_date:D claim_amount:d "
       "claim_status:s updated_at:t", "SELECT * FROM claims_d", "claims_d")
def prj01_typed_claims(t: Lake):
    return typed(feeds.claims(t), CLAIMS.fields)


@query("prj02_typed_policies", "policy_id:s policyholder_id:l product_line:s annual_premium:d "
       "effective_date:D expiration_date:D policy_status:s issued_at:t",
       "SELECT * FROM policies_d", "policies_d")
def prj02_typed_policies(t: Lake):
    return typed(feeds.policies(t), POLICIES.fields)


@query("prj03_typed_policyholders", "policyholder_id:l first_name:s last_name:s date_of_birth:D "
       "city:s state:s risk_tier:s updated_at:t", "SELECT * FROM holders_d", "holders_d")
def prj03_typed_policyholders(t: Lake):
    return typed(feeds.holders(t), POLICYHOLDERS.fields)


@query("prj04_rename", "user_id:l event_status:s k:d",
       "SELECT user_id, event_type AS event_status, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def prj04_rename(t: Lake):
    rows = to_records(t.events.select("user_id", "event_type"), keep=())
    named = typed(rows, {"user_id": ("user_id", "bigint"), "event_status": ("event_type", "string")})
    parsed = typed(t.events.select(F.parse_json("props").alias("record"), "user_id", "event_type"),
                   {"k": ("k", "bigint")}, keep=["user_id", F.col("event_type").alias("event_status")])
    return parsed.select(*named.columns, "k")


@query("prj05_boolean_columns", "o_orderkey:l is_open:b is_weekend:b",
       """SELECT o_orderkey, o_orderstatus = 'O' AS is_open,
          isodow(o_orderdate) IN (6, 7) AS is_weekend FROM orders""")
def prj05_boolean_columns(t: Lake):
    return t.orders.select("o_orderkey", (F.col("o_orderstatus") == "O").alias("is_open"),
                           (F.weekday("o_orderdate") + 1).isin(6, 7).alias("is_weekend"))


@query("prj06_null_to_unknown", "l_orderkey:l l_linenumber:i customer_sk:s",
       """SELECT l_orderkey, l_linenumber, coalesce(md5(CAST(c_custkey AS VARCHAR)), '-1') AS customer_sk
          FROM lineitem LEFT JOIN customer ON c_custkey = l_partkey""")
def prj06_null_to_unknown(t: Lake):
    dim = t.customer.select(F.col("c_custkey").alias("l_partkey"), hash_key("c_custkey").alias("sk"))
    return facts.lookup(t.lineitem, dim, "l_partkey", ["sk"]).select(
        "l_orderkey", "l_linenumber", or_unknown("sk").alias("customer_sk")
    )


@query("prj07_unknown_member", "c_custkey:l c_name:s c_mktsegment:s c_acctbal:d",
       """SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer
          UNION ALL SELECT -1, 'Unknown', 'Unknown', NULL""")
def prj07_unknown_member(t: Lake):
    dim = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return facts.with_unknown_member(
        dim, {"c_custkey": -1, "c_name": "Unknown", "c_mktsegment": "Unknown"}
    )


@query("prj08_predicates", "claim_id:s paid_date_key:d approved_date_key:d",
       """SELECT * FROM fct_claims WHERE (approved_date_key <= paid_date_key AND rejected_date_key IS NULL)
          OR (loss_date_key < reported_date_key AND approved_date_key IS NOT NULL
              AND current_status <> 'OPEN' AND claim_amount >= 20 AND NOT (paid_date_key > 20240115))""",
       "fct_claims")
def prj08_predicates(t: Lake):
    c = F.col
    broken = ((c("approved_date_key") <= c("paid_date_key")) & c("rejected_date_key").isNull()) | (
        (c("loss_date_key") < c("reported_date_key")) & c("approved_date_key").isNotNull()
        & (c("current_status") != "OPEN") & (c("claim_amount") >= 20) & ~(c("paid_date_key") > 20240115)
    )
    return quality.rule(claim_facts(t, narrow_star(t)), broken)


@query("prj09_like", "o_orderkey:l o_orderpriority:s",
       "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '%E%'")
def prj09_like(t: Lake):
    return t.orders.filter(F.col("o_orderpriority").contains("E"))


@query("prj10_key_equality", "policyholder_id:l run_id:s business_date:D",
       "SELECT * FROM holders_d WHERE run_id = 'r0' AND business_date = DATE '1996-07-07'", "holders_d")
def prj10_key_equality(t: Lake):
    rows = feeds.holder_rows(t)
    day = F.lit("1996-07-07").cast("date")
    return rows.filter((F.col("run_id") == "r0") & (F.col("business_date") == day))


@query("prj11_conditional", "event_id:l paid_at:t",
       "SELECT event_id, CASE WHEN event_type = 'purchase' THEN ts END AS paid_at FROM events")
def prj11_conditional(t: Lake):
    return t.events.select(
        "event_id", F.when(F.col("event_type") == "purchase", F.col("ts")).alias("paid_at")
    )


@query("prj12_threshold_class", "o_custkey:l policy_count:l batch:s",
       """SELECT o_custkey, count(*) AS policy_count,
          CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) > 1000000 THEN 'big' ELSE 'small' END AS batch
          FROM orders GROUP BY 1""")
def prj12_threshold_class(t: Lake):
    sums = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("policy_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
    )
    return sums.withColumn("batch", classify("total", 1_000_000))


@query("prj13_naive_utc", "event_id:l with_offset:t without:t",
       """SELECT event_id, ts - INTERVAL 150 MINUTE AS with_offset, ts AS without FROM events""")
def prj13_naive_utc(t: Lake):
    """The same clock time, once at +02:30 and once without an offset."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return t.events.select(
        "event_id", to_naive_utc(F.concat(iso, F.lit("+02:30"))).alias("with_offset"),
        to_naive_utc(iso).alias("without"),
    )


# ------------------------------------------------------------ scalar functions


@query("fn_dates",
       "o_orderkey:l date_key:i y:i q:i m:i d:i month_name:s day_name:s iso_day:i month_start:D "
       "next_week:D in_3_hours:t days_since:d",
       """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
          year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m, day(o_orderdate) AS d,
          strftime(o_orderdate, '%b') AS month_name, strftime(o_orderdate, '%a') AS day_name,
          isodow(o_orderdate) AS iso_day, date_trunc('month', o_orderdate) AS month_start,
          CAST(o_orderdate AS DATE) + 7 AS next_week, o_orderdate + INTERVAL 3 HOUR AS in_3_hours,
          date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS days_since FROM orders""")
def fn_dates(t: Lake):
    """FN-07 to FN-13: date keys, parts, names, truncation and arithmetic."""
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", date_key(d).alias("date_key"), F.year(d).alias("y"), F.quarter(d).alias("q"),
        F.month(d).alias("m"), F.day(d).alias("d"), F.monthname(d).alias("month_name"),
        F.dayname(d).alias("day_name"), (F.weekday(d) + 1).alias("iso_day"),
        F.trunc(d, "MM").alias("month_start"), F.date_add(F.to_date(d), 7).alias("next_week"),
        (d + F.expr("INTERVAL 3 HOURS")).alias("in_3_hours"),
        F.datediff(F.to_date(d), F.lit("1995-01-01").cast("date")).alias("days_since"),
    )


@query("fn_keys_and_text",
       "event_id:l sk:s fine_sk:s hashed:s run:s safe:b part:s missing:s cut:s listed:b",
       r"""SELECT event_id, md5(user_id || '~' || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS sk,
          md5(user_id || '~' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) AS fine_sk,
          md5(event_type) AS hashed,
          regexp_replace(event_type || ' #' || user_id, '[^A-Za-z0-9_.-]', '_', 'g') AS run,
          regexp_full_match(event_type || '/' || user_id, '[A-Za-z0-9_.-]{1,128}') AS safe,
          split_part(split_part('x/run=' || event_type || '/f', 'run=', 2), '/', 1) AS part,
          split_part(split_part('x/run=' || event_type || '/f', 'dt=', 2), '/', 1) AS missing,
          substring(repeat(props, 900), 1, 4000) AS cut, event_type IN ('click', 'view') AS listed
          FROM events""")
def fn_keys_and_text(t: Lake):
    """FN-03 to FN-06, FN-17, FN-18, FN-20."""
    path = F.concat(F.lit("x/run="), "event_type", F.lit("/f"))
    user = F.col("user_id").cast("string")
    return t.events.select(
        "event_id", version_key("user_id", "ts").alias("sk"),
        version_key("user_id", "ts", MICROS).alias("fine_sk"), hash_key("event_type").alias("hashed"),
        safe_run_id(F.concat("event_type", F.lit(" #"), user)).alias("run"),
        is_safe_run_id(F.concat("event_type", F.lit("/"), user)).alias("safe"),
        path_part(path, "run").alias("part"), path_part(path, "dt").alias("missing"),
        F.substring(F.repeat("props", 900), 1, 4000).alias("cut"),
        F.col("event_type").isin("click", "view").alias("listed"),
    )


@query("fn_variant_and_casts",
       "event_id:l k:d absent:d value:d as_date:D as_ts:t newest:t filled:d in_order:b",
       """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, NULL AS absent,
          CAST(value AS DECIMAL(12,2)) AS value, CAST(ts AS DATE) AS as_date, ts AS as_ts,
          greatest(ts, TIMESTAMP '2024-01-15') AS newest,
          coalesce(CASE WHEN event_type = 'view' THEN value END, -1) AS filled, true AS in_order FROM events""")
def fn_variant_and_casts(t: Lake):
    """FN-01, FN-02, FN-14, FN-15, FN-16, FN-19, FN-21."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    record = F.parse_json("props")
    text = F.to_json(F.struct(F.col("event_id").alias("a"), F.col("user_id").alias("b")))
    return t.events.select(
        "event_id", F.variant_get(record, "$.k", "bigint").alias("k"),
        F.variant_get(record, "$.nothing", "bigint").alias("absent"),
        F.col("value").cast("decimal(12,2)").alias("value"),
        iso.cast("date").alias("as_date"), iso.cast("timestamp_ntz").alias("as_ts"),
        F.greatest("ts", F.lit("2024-01-15").cast("timestamp_ntz")).alias("newest"),
        F.coalesce(F.when(F.col("event_type") == "view", F.col("value")), F.lit(-1.0)).alias("filled"),
        (text.startswith('{"a":') & (F.current_timestamp() > F.lit("2024-01-01").cast("timestamp")))
        .alias("in_order"),
    )


# ------------------------------------------------------------ joins


@query("jn01_inner_lookup", "l_orderkey:l l_linenumber:i order_sk:s l_extendedprice:d",
       """SELECT l_orderkey, l_linenumber, md5(CAST(o_orderkey AS VARCHAR)) AS order_sk, l_extendedprice
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def jn01_inner_lookup(t: Lake):
    dim = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), hash_key("o_orderkey").alias("order_sk"))
    return facts.lookup(t.lineitem, dim, "l_orderkey", ["order_sk"], "inner")


@query("jn02_left_lookups", "claim_id:s policyholder_id:d policy_sk:s",
       """SELECT c.claim_id, p.policyholder_id, dp.policy_sk FROM claim_states c
          LEFT JOIN slv_policies p ON p.policy_id = c.policy_id
          LEFT JOIN dim_policy dp ON dp.policy_id = c.policy_id""", "claim_states slv_policies dim_policy")
def jn02_left_lookups(t: Lake):
    s = narrow_star(t)
    claims = models.slv_claim_events(feeds.claims(t)).groupBy("claim_id").agg(
        F.max("policy_id").alias("policy_id"))
    owned = facts.lookup(claims, s["policies"], "policy_id", ["policyholder_id"])
    return facts.lookup(owned, s["dim_policy"], "policy_id", ["policy_sk"])


_PIT = """FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey
    LEFT JOIN dim_holder h ON h.policyholder_id = o.o_custkey"""


def _shipped(t: Lake):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice",
        F.col("o_custkey").alias("policyholder_id"),
    )


@query("jn03_point_in_time", "l_orderkey:l l_linenumber:i l_shipdate:t city:s policyholder_sk:s",
       f"""SELECT l_orderkey, l_linenumber, l_shipdate, h.city, h.policyholder_sk {_PIT}
           AND l_shipdate >= h.valid_from AND l_shipdate < h.valid_to""", "dim_holder")
def jn03_point_in_time(t: Lake):
    return history.point_in_time(_shipped(t), dim_holder(t), "policyholder_id", "l_shipdate",
                                 ["city", "policyholder_sk"], pieces=feeds.holder_pieces(t))


@query("jn03_point_in_time_pieces", "l_orderkey:l l_linenumber:i l_shipdate:t city:s policyholder_sk:s",
       f"""SELECT l_orderkey, l_linenumber, l_shipdate, h.city, h.policyholder_sk {_PIT}
           AND l_shipdate >= h.valid_from AND l_shipdate < h.valid_to""", "dim_holder")
def jn03_point_in_time_pieces(t: Lake):
    """The same lookup with every customer of ten or more orders cut into pieces."""
    changes = t.orders.select(F.col("o_custkey").alias("policyholder_id"),
                              F.col("o_orderdate").alias("updated_at"))
    pieces = skew.find_pieces(changes, "policyholder_id", "updated_at", min_rows=10, pieces=4)
    versions = models.slv_policyholder_versions(feeds.holders(t))
    dim = models.dim_policyholder(versions, pieces=pieces)
    return history.point_in_time(_shipped(t), dim, "policyholder_id", "l_shipdate",
                                 ["city", "policyholder_sk"], pieces=pieces)


@query("jn04_point_in_time_on_date", "claim_id:s loss_date:D city:s",
       """SELECT c.claim_id, c.loss_date, h.city FROM claim_states c
          LEFT JOIN slv_policies p ON p.policy_id = c.policy_id
          LEFT JOIN dim_holder h ON h.policyholder_id = p.policyholder_id
            AND CAST(c.loss_date AS TIMESTAMP) >= h.valid_from AND CAST(c.loss_date AS TIMESTAMP) < h.valid_to""",
       "claim_states slv_policies dim_holder")
def jn04_point_in_time_on_date(t: Lake):
    s = narrow_star(t, more_of_holder=("city",))
    claims = models.slv_claim_events(feeds.claims(t)).groupBy("claim_id").agg(
        F.max("policy_id").alias("policy_id"), F.max("loss_date").alias("loss_date"))
    owned = facts.lookup(claims, s["policies"], "policy_id", ["policyholder_id"])
    return history.point_in_time(owned, s["dim_holder"], "policyholder_id",
                                 F.col("loss_date").cast("timestamp_ntz"), ["city"], pieces=s["pieces"])


@query("jn05_semi_join", "event_id:l user_id:l ts:t",
       """SELECT event_id, user_id, ts FROM events WHERE user_id IN (
          SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2001-01-01')""")
def jn05_semi_join(t: Lake):
    urgent = t.orders.filter((F.col("o_orderpriority") == "1-URGENT")
                             & (F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")))
    return selection.events_of(t.events, urgent.select(F.col("o_custkey").alias("user_id")), "user_id")


@query("jn06_totals_side_by_side", "lines_n:l orders_n:l lines_total:d orders_total:d",
       """SELECT a.n AS lines_n, b.n AS orders_n, a.total AS lines_total, b.total AS orders_total FROM
          (SELECT count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS total FROM lineitem) a
          CROSS JOIN (SELECT count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders) b
          WHERE a.n <> b.n OR a.total <> b.total""")
def jn06_totals_side_by_side(t: Lake):
    a = t.lineitem.select(F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"))
    b = t.orders.select(F.col("o_totalprice").cast("decimal(12,2)").alias("amount"))
    return quality.reconcile_totals(a, b, {"n": F.count(F.lit(1)), "total": F.sum("amount")},
                                    ("lines", "orders"))


@query("jn07_anti_join", "event_id:l user_id:l",
       """SELECT event_id, user_id FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (
          SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def jn07_anti_join(t: Lake):
    parents = t.customer.filter("c_mktsegment = 'BUILDING'")
    return quality.orphans(t.events, "user_id", parents, "c_custkey")


@query("jn08_star_join", "c_mktsegment:s p_brand:s s_nationkey:i revenue:d",
       """SELECT c_mktsegment, p_brand, s_nationkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS revenue
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
          JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3""")
def jn08_star_join(t: Lake):
    c = F.col
    owner = t.orders.join(t.customer, c("c_custkey") == c("o_custkey")).select("o_orderkey", "c_mktsegment")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey",
                              c("l_extendedprice").cast("decimal(12,2)").alias("price"))
    return (
        lines.join(t.part.select("p_partkey", "p_brand"), c("l_partkey") == c("p_partkey"))
        .join(t.supplier.select("s_suppkey", "s_nationkey"), c("l_suppkey") == c("s_suppkey"))
        .join(owner, c("l_orderkey") == c("o_orderkey"))
        .groupBy("c_mktsegment", "p_brand", "s_nationkey").agg(F.sum("price").alias("revenue"))
    )


_ROLES = ("loss", "reported", "approved", "rejected", "paid")


@query("jn09_role_playing_dates", "claim_id:s " + " ".join(f"{r}_date_day:D" for r in _ROLES),
       "SELECT claim_id, " + ", ".join(f"strptime(CAST({r}_date_key AS VARCHAR), '%Y%m%d') AS {r}_date_day"
                                       for r in _ROLES) + " FROM fct_claims", "fct_claims")
def jn09_role_playing_dates(t: Lake):
    fct = claim_facts(t, narrow_star(t))
    span = t.orders.select("o_orderdate").union(t.events.select("ts"))
    calendar = describe_days(spine_over(span, "o_orderdate"))
    return facts.role_play(fct, calendar, {r: f"{r}_date_key" for r in _ROLES})


@query("jn10_current_version", "policy_id:s current_city:s",
       """SELECT p.policy_id, h.city AS current_city FROM slv_policies p
          JOIN dim_holder h ON h.policyholder_id = p.policyholder_id AND h.is_current""",
       "slv_policies dim_holder")
def jn10_current_version(t: Lake):
    from tidemark.plans.reports import current_owner

    s = star(t)
    return current_owner(s["policies"], s["dim_holder"])


# ------------------------------------------------------------ aggregates


@query("agg01_count_of_day", "rows:l",
       "SELECT count(*) AS rows FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-01-10'")
def agg01_count_of_day(t: Lake):
    day = t.orders.filter(F.to_date("o_orderdate") == F.lit("1997-01-10").cast("date"))
    return day.agg(F.count(F.lit(1)).alias("rows"))


@query("agg02_load_stats", "run_id:s business_date:D rows:l files:l max_cursor:t",
       """SELECT run_id, business_date, count(*) AS rows, count(DISTINCT source_file) AS files,
          max(updated_at) AS max_cursor FROM claims_d GROUP BY 1, 2""", "claims_d")
def agg02_load_stats(t: Lake):
    return facts.load_stats(feeds.claim_rows(t), ["run_id", "business_date"], "source_file", "updated_at")


_PIVOT = {"approved_at": "click", "rejected_at": "error", "paid_at": "purchase"}


@query("agg03_grouped_min_max", "user_id:l first_ts:t last_ts:t",
       "SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1")
def agg03_grouped_min_max(t: Lake):
    return t.events.groupBy("user_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("agg04_milestone_pivot", "user_id:l approved_at:t rejected_at:t paid_at:t",
       "SELECT user_id, " + ", ".join(
           f"min(CASE WHEN event_type = '{s}' THEN ts END) AS {m}" for m, s in _PIVOT.items())
       + " FROM events GROUP BY 1")
def agg04_milestone_pivot(t: Lake):
    return facts.accumulate(t.events, "user_id", "ts", "event_type", _PIVOT)


@query("agg05_latest_value", "user_id:l value:d current_status:s last_updated_at:t",
       """SELECT user_id, arg_max_null(value, ts) AS value, arg_max_null(event_type, ts) AS current_status,
          max(ts) AS last_updated_at FROM events GROUP BY 1""")
def agg05_latest_value(t: Lake):
    return facts.accumulate(t.events, "user_id", "ts", "event_type", {},
                            latest={"value": "value", "current_status": "event_type"})


@query("agg06_constant_attribute", "claim_id:s policy_id:s loss_date:D reported_date:D",
       "SELECT * FROM claim_states", "claim_states")
def agg06_constant_attribute(t: Lake):
    events = models.slv_claim_events(feeds.claims(t))
    return facts.accumulate(events, "claim_id", "updated_at", "claim_status", {},
                            latest=["policy_id", "loss_date", "reported_date"])


@query("agg07_count_if", "o_custkey:l urgent:l",
       "SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1")
def agg07_count_if(t: Lake):
    return t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))


@query("agg08_decimal_sum", "l_returnflag:s total:d",
       """SELECT l_returnflag, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS total FROM lineitem GROUP BY 1""")
def agg08_decimal_sum(t: Lake):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("total"))


@query("agg09_having", "o_custkey:l o_orderdate:t occurrences:l",
       """SELECT o_custkey, o_orderdate, count(*) AS occurrences FROM orders
          GROUP BY 1, 2 HAVING count(*) > 1""")
def agg09_having(t: Lake):
    return quality.unique(t.orders, ["o_custkey", "o_orderdate"])


@query("agg10_distinct", "l_partkey:l l_suppkey:l",
       "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def agg10_distinct(t: Lake):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query("agg11_multi_key_sum", "y:i m:i o_orderpriority:s o_orderstatus:s total:d",
       """SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderpriority, o_orderstatus,
          sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders GROUP BY 1, 2, 3, 4""")
def agg11_multi_key_sum(t: Lake):
    return t.orders.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
                            "o_orderpriority", "o_orderstatus").agg(
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total"))


@query("agg12_count_and_average", "l_returnflag:s lines:l avg_days:d",
       """SELECT l_returnflag, count(*) AS lines,
          CAST(sum(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS DOUBLE) / count(*) AS avg_days
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def agg12_count_and_average(t: Lake):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"),
        F.avg(F.datediff("l_shipdate", "o_orderdate")).alias("avg_days"))


@query("agg13_batch_summary", "row_count:l total:d",
       "SELECT count(*) AS row_count, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders")
def agg13_batch_summary(t: Lake):
    return quality.batch_summary(t.orders.select(F.col("o_totalprice").cast("decimal(12,2)").alias("p")), "p")


@query("agg14_scalar_max", "o_orderkey:l o_orderdate:t",
       "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def agg14_scalar_max(t: Lake):
    return selection.pick_business_date(t.orders, "o_orderdate")


@query("agg15_max_cursor", "event_type:s max_changed_at:s",
       "SELECT event_type, max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) AS max_changed_at FROM events GROUP BY 1")
def agg15_max_cursor(t: Lake):
    """ISO text orders like the timestamps it represents."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return t.events.groupBy("event_type").agg(F.max(iso).alias("max_changed_at"))


@query("agg16_rows_per_file", "business_date:D files:l row_count:l",
       """SELECT business_date, count(*) AS files, sum(n) AS row_count FROM (
          SELECT business_date, source_file, count(*) AS n FROM holders_d GROUP BY 1, 2) GROUP BY 1""",
       "holders_d")
def agg16_rows_per_file(t: Lake):
    rows = feeds.holder_rows(t)
    stats = facts.load_stats(rows, ["business_date"], "source_file", "updated_at")
    return stats.withColumnRenamed("rows", "row_count")


# ------------------------------------------------------------ windows


@query("wf01_dedup_version", "claim_id:s updated_at:t source_file:s loaded_at:t",
       "SELECT * FROM slv_claims", "slv_claims")
def wf01_dedup_version(t: Lake):
    rows = typed(feeds.claims(t), CLAIMS.fields, ["source_file", "loaded_at"])
    return latest_per(rows, ["claim_id", "updated_at"], ["loaded_at", "source_file"])


@query("wf02_dedup_key", "o_custkey:l o_orderkey:l o_orderdate:t",
       """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def wf02_dedup_key(t: Lake):
    return latest_per(t.orders, ["o_custkey"], ["o_orderdate", "o_totalprice", "o_orderkey"])


@query("wf03_dedup_latest_load", "l_orderkey:l l_linenumber:i l_partkey:l",
       """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1""")
def wf03_dedup_latest_load(t: Lake):
    return latest_per(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query("wf04_dedup_per_day", "policyholder_id:l business_date:D source_file:s",
       """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY policyholder_id, business_date
          ORDER BY loaded_at DESC, source_file DESC) AS rn FROM holders_d) WHERE rn = 1""", "holders_d")
def wf04_dedup_per_day(t: Lake):
    return latest_per(feeds.holder_rows(t), ["policyholder_id", "business_date"], ["loaded_at", "source_file"])


@query("wf05_dedup_claims", "claim_id:s updated_at:t loaded_at:t", "SELECT * FROM slv_claims", "slv_claims")
def wf05_dedup_claims(t: Lake):
    return models.stg_claims(feeds.claims(t))


@query("wf06_current_row", "user_id:l event_id:l event_type:s",
       """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
          FROM events) WHERE rn = 1""")
def wf06_current_row(t: Lake):
    return latest_per(t.events, ["user_id"], ["ts"])


_LEAD_SQL = """SELECT user_id, ts AS valid_from, event_type,
    coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), TIMESTAMP '9999-12-31') AS valid_to FROM events"""


@query("wf07_validity_windows", "user_id:l valid_from:t valid_to:t event_type:s", _LEAD_SQL)
def wf07_validity_windows(t: Lake):
    return history.scd2_windows(t.events, "user_id", "ts", ["event_type"], sk_format=MICROS)


@query("wf07_validity_windows_pieces", "user_id:l valid_from:t valid_to:t event_type:s", _LEAD_SQL)
def wf07_validity_windows_pieces(t: Lake):
    """The same windows with every user cut into pieces."""
    pieces = skew.find_pieces(t.events, "user_id", "ts", min_rows=1, pieces=8)
    return history.scd2_windows(t.events, "user_id", "ts", ["event_type"], sk_format=MICROS, pieces=pieces)


@query("jn03_overlapping_windows", "fact_id:l event_id:l",
       """SELECT f.event_id AS fact_id, w.event_id FROM events f LEFT JOIN events w ON w.user_id = f.user_id
          AND f.ts >= w.ts AND f.ts < w.ts + INTERVAL 12 HOUR""")
def jn03_overlapping_windows(t: Lake):
    """Windows that overlap, every user cut into pieces: one row per window, as a plain join gives."""
    dim = t.events.select("user_id", "event_id", F.col("ts").alias("valid_from"),
                          (F.col("ts") + F.expr("INTERVAL 12 HOURS")).alias("valid_to"))
    fact = t.events.select("user_id", F.col("event_id").alias("fact_id"), F.col("ts").alias("at"))
    pieces = skew.find_pieces(t.events, "user_id", "ts", min_rows=1, pieces=8)
    return history.point_in_time(fact, dim, "user_id", "at", ["event_id"], pieces=pieces)


@query("wf08_next_start", "policyholder_id:l window_start:t next_start:t",
       """SELECT policyholder_id, valid_from AS window_start,
          lead(valid_from) OVER (PARTITION BY policyholder_id ORDER BY valid_from) AS next_start
          FROM dim_holder""", "dim_holder")
def wf08_next_start(t: Lake):
    windows = dim_holder(t).select("policyholder_id", F.col("valid_from").alias("window_start"))
    return skew.lead_within(windows, "policyholder_id", "window_start", "next_start", feeds.holder_pieces(t))


@query("wf10_window_filter", "o_orderkey:l o_orderpriority:s",
       """SELECT o_orderkey, o_orderpriority FROM orders
          QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE)
            ORDER BY o_totalprice DESC, o_orderkey DESC) = 1""")
def wf10_window_filter(t: Lake):
    rows = t.orders.withColumn("day", F.to_date("o_orderdate"))
    return latest_per(rows, ["day"], ["o_totalprice", "o_orderkey"])


@query("srt03_top_one_per_group", "l_suppkey:l l_orderkey:l l_linenumber:i l_extendedprice:d",
       """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey
          ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC, l_shipdate DESC) AS rn FROM lineitem)
          WHERE rn = 1""")
def srt03_top_one_per_group(t: Lake):
    return latest_per(t.lineitem, ["l_suppkey"],
                      ["l_extendedprice", "l_orderkey", "l_linenumber", "l_shipdate"])


@query("set01_union_unknown_member", "s_suppkey:l s_name:s s_nationkey:d",
       "SELECT s_suppkey, s_name, s_nationkey FROM supplier UNION ALL SELECT -1, 'Unknown', NULL")
def set01_union_unknown_member(t: Lake):
    return facts.with_unknown_member(t.supplier.select("s_suppkey", "s_name", "s_nationkey"),
                                     {"s_suppkey": -1, "s_name": "Unknown"})
