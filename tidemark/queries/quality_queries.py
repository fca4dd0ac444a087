"""Data tests on tables that break them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.operators.versions import typed
from tidemark.plans import checks, models
from tidemark.queries import feeds
from tidemark.queries.model_queries import claim_facts, dim_holder, narrow_star, star, written
from tidemark.queries.registry import Lake, query
from tidemark.spec import POLICIES, contract


@query("dq01_unique", "policy_id:s occurrences:l",
       "SELECT policy_id, count(*) AS occurrences FROM policies_d GROUP BY 1 HAVING count(*) > 1", "policies_d")
def dq01_unique(t: Lake):
    return q.unique(feeds.policy_rows(t), "policy_id")


@query("dq02_not_null", "claim_id:s", "SELECT claim_id FROM fct_claims WHERE paid_date_key IS NULL", "fct_claims")
def dq02_not_null(t: Lake):
    return q.not_null(claim_facts(t, narrow_star(t)), "paid_date_key")


@query("dq03_accepted_values", "o_orderpriority:s occurrences:l",
       """SELECT o_orderpriority, count(*) AS occurrences FROM orders
          WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY 1""")
def dq03_accepted_values(t: Lake):
    return q.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


@query("dq04_relationships", "user_id:l occurrences:l",
       """SELECT user_id, count(*) AS occurrences FROM events WHERE user_id NOT IN (
          SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) GROUP BY 1""")
def dq04_relationships(t: Lake):
    parents = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return q.relationships(t.events, "user_id", parents, "c_custkey")


@query("dq04_date_keys", "paid_date_key:i occurrences:l",
       """SELECT paid_date_key, count(*) AS occurrences FROM fct_claims WHERE paid_date_key IS NOT NULL
          AND paid_date_key NOT IN (SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) FROM events
                                    WHERE event_type = 'signup' AND value > 150) GROUP BY 1""", "fct_claims")
def dq04_date_keys(t: Lake):
    days = t.events.filter("event_type = 'signup' AND value > 150").select(
        F.date_format("ts", "yyyyMMdd").cast("int").alias("date_key"))
    return q.relationships(claim_facts(t, narrow_star(t)), "paid_date_key", days, "date_key")


@query("dq05_unique_combination", "l_orderkey:l l_linenumber:i occurrences:l",
       """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
          GROUP BY 1, 2 HAVING count(*) > 1""")
def dq05_unique_combination(t: Lake):
    return q.unique(t.lineitem, ["l_orderkey", "l_linenumber"])


# every window beside the one that begins next: an ordered list per user, unnested with its successor
_BROKEN = """SELECT user_id AS dim_key, w.f AS opens_at, w.t AS closes_at, n AS follows_at FROM (
    SELECT user_id, unnest(list_zip(ws, list_append(list_transform(ws[2:], lambda x: x.f), NULL))) AS pair,
      pair[1] AS w, pair[2] AS n
    FROM (SELECT user_id, list({'f': ts, 't': CASE event_type WHEN 'error' THEN ts - INTERVAL 1 DAY
              WHEN 'view' THEN ts + INTERVAL 1 HOUR ELSE ifnull(after, TIMESTAMP '9999-12-31') END} ORDER BY ts) AS ws
          FROM (SELECT e.user_id, e.ts, e.event_type, min(l.ts) AS after FROM events e
                LEFT JOIN events l ON l.user_id = e.user_id AND l.ts > e.ts GROUP BY ALL)
          GROUP BY user_id))
    WHERE NOT (w.f < w.t AND ifnull(w.t = n, true))"""


def _broken_windows(t: Lake):
    """Windows of users, reversed at errors and one hour long after views."""
    from tidemark.operators.history import scd2_windows

    dim = scd2_windows(t.events, "user_id", "ts", ["event_type"])
    ts, kind = F.col("valid_from"), F.col("event_type")
    until = F.when(kind == "error", ts - F.expr("INTERVAL 1 DAY")).when(
        kind == "view", ts + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("valid_to"))
    return dim.withColumn("valid_to", until)


@query("dq06_scd2_contiguous", "dim_key:l opens_at:t closes_at:t follows_at:t", _BROKEN)
def dq06_scd2_contiguous(t: Lake):
    from tidemark.operators.skew import find_pieces

    return q.scd2_contiguous(_broken_windows(t), "user_id", pieces=find_pieces(t.events, "user_id", "ts"))


@query("dq06_scd2_contiguous_clean", "dim_key:l opens_at:t closes_at:t follows_at:t",
       """SELECT policyholder_id AS dim_key, valid_from AS opens_at, valid_to AS closes_at,
          valid_to AS follows_at FROM dim_holder WHERE valid_to <= valid_from""", "dim_holder")
def dq06_scd2_contiguous_clean(t: Lake):
    """The shipped dimension passes."""
    return q.scd2_contiguous(dim_holder(t), "policyholder_id", pieces=feeds.holder_pieces(t))


@query("dq07_scd2_one_current", "o_custkey:l current_rows:l",
       """SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS current_rows FROM orders
          GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'O') <> 1""")
def dq07_scd2_one_current(t: Lake):
    marked = t.orders.withColumn("is_current", F.col("o_orderstatus") == "O")
    return q.scd2_one_current(marked, "o_custkey")


_KEYS = "claim_id:s loss_date_key:d reported_date_key:d approved_date_key:d rejected_date_key:d paid_date_key:d"


@query("dq08_milestones_in_order", _KEYS,
       """SELECT * FROM fct_claims
          WHERE least(approved_date_key, rejected_date_key, paid_date_key) < reported_date_key
            OR reported_date_key < loss_date_key OR approved_date_key + rejected_date_key IS NOT NULL""", "fct_claims")
def dq08_milestones_in_order(t: Lake):
    return q.rule(claim_facts(t, narrow_star(t)), checks.milestones_out_of_order())


@query("dq09_paid_without_approval", _KEYS + " current_status:s",
       """SELECT * FROM fct_claims WHERE paid_date_key > 0
          EXCEPT ALL SELECT * FROM fct_claims WHERE approved_date_key > 0 AND rejected_date_key IS NULL""", "fct_claims")
def dq09_paid_without_approval(t: Lake):
    return q.rule(claim_facts(t, narrow_star(t)), checks.paid_without_approval())


_TOTALS = "gold_policies:l silver_policies:l gold_premium:d silver_premium:d"


def _totals(gold, silver):
    return q.reconcile_totals(gold, silver, {"policies": F.count(F.lit(1)), "premium": F.sum("annual_premium")},
                              ("gold", "silver"))


def _totals_sql(gold: str, silver: str) -> str:
    side = lambda table, name: (f"SELECT count(*) AS {name}_policies, sum(annual_premium) AS {name}_premium "  # noqa: E731
                                f"FROM {table}")
    return f"""SELECT * FROM ({side(gold, 'gold')}) POSITIONAL JOIN ({side(silver, 'silver')})
        WHERE (gold_policies, gold_premium) <> (silver_policies, silver_premium)"""


@query("dq10_gold_equals_silver", _TOTALS, _totals_sql("fct_written", "slv_policies"),
       "fct_written slv_policies")
def dq10_gold_equals_silver(t: Lake):
    s = star(t)
    return _totals(written(t, s), s["policies"])


@query("dq10_duplicates_found", _TOTALS, _totals_sql("policies_d", "slv_policies"), "policies_d slv_policies")
def dq10_duplicates_found(t: Lake):
    """Deliveries hold every policy twice: totals differ and the test says by how much."""
    bronze = typed(feeds.policies(t), POLICIES.fields)
    return _totals(bronze, models.slv_policies(feeds.policies(t)))


@query("dq11_gate_counts", "name:s severity:s failures:l",
       """SELECT 'amount' AS name, 'error' AS severity, count(*) FILTER (o_totalprice <= 1000) AS failures FROM orders
          UNION ALL SELECT 'status', 'warn', count(*) FILTER (o_orderstatus = 'P') FROM orders
          UNION ALL SELECT 'customer', 'warn', count(*) FROM (SELECT o_custkey FROM orders
            WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1)""")
def dq11_gate_counts(t: Lake):
    """Failures of several tests as one query; those of one table share a scan."""
    orders = t.orders
    return q.failure_counts([
        q.Check("amount", table=orders, predicate=F.col("o_totalprice") <= 1000),
        q.Check("status", q.WARN, table=orders, predicate=F.col("o_orderstatus") == "P"),
        q.Check("customer", q.WARN, failing=q.relationships(orders, "o_custkey", t.events, "user_id")),
    ])


_FRESH = """SELECT {key}, max({ts}) AS newest, CASE WHEN max({ts}) < TIMESTAMP '{now}' - INTERVAL 48 HOUR THEN 'ERROR'
    WHEN max({ts}) < TIMESTAMP '{now}' - INTERVAL 26 HOUR THEN 'WARN' ELSE 'PASS' END AS status FROM {table} GROUP BY 1"""


@query("dq12_source_freshness", "user_id:l newest:t status:s",
       _FRESH.format(key="user_id", ts="ts", now="2024-02-01 03:00:00", table="events"))
def dq12_source_freshness(t: Lake):
    return q.freshness(t.events, "ts", "2024-02-01 03:00:00", by=["user_id"])


@query("dq13_load_freshness", "run_id:s newest:t status:s",
       _FRESH.format(key="run_id", ts="loaded_at", now="2024-02-02 12:00:00", table="claims_d"), "claims_d")
def dq13_load_freshness(t: Lake):
    return q.freshness(feeds.claim_rows(t), "loaded_at", "2024-02-02 12:00:00", by=["run_id"])


@query("jn12_reconcile_files", "entity:l file:s expected_rows:l loaded_rows:l status:s",
       """SELECT ifnull(m.entity, l.entity) AS entity, ifnull(m.file, l.file) AS file, ifnull(m.n, 0) AS expected_rows,
            ifnull(l.n, 0) AS loaded_rows, CASE WHEN m.n IS NULL THEN 'NOT_LISTED' WHEN l.n IS NULL THEN 'NOT_YET'
            WHEN l.n > m.n THEN 'TOO_MANY' WHEN l.n < m.n THEN 'NOT_YET' ELSE 'DONE' END AS status
          FROM (SELECT o_custkey AS entity, strftime(o_orderdate, '%m') AS file, count(*) AS n FROM orders GROUP BY ALL) m
          FULL JOIN (SELECT user_id AS entity, strftime(ts, '%m') AS file, count(*) AS n FROM events GROUP BY ALL) l
          USING (entity, file)""")
def jn12_reconcile_files(t: Lake):
    """Months as files: customers' orders announced, their events loaded."""
    manifest = t.orders.select(F.col("o_custkey").alias("entity"), F.date_format("o_orderdate", "MM").alias("key"),
                               F.lit(1).cast("bigint").alias("rows"))
    loaded = t.events.select(F.col("user_id").alias("entity"), F.date_format("ts", "MM").alias("source_file"))
    return q.reconcile_files(manifest, loaded)


@query("dq14_reconcile_status", "entity:s expected_rows:l loaded_rows:l expected_files:l loaded_files:l "
       "status:s file_status:s",
       """WITH m AS (SELECT o_custkey AS entity, count(*) AS er, count(*) AS ef FROM orders GROUP BY 1),
          l AS (SELECT user_id AS entity, count(*) AS lr, count(DISTINCT CAST(ts AS DATE)) AS lf FROM events GROUP BY 1)
          SELECT m.entity, er AS expected_rows, coalesce(lr, 0) AS loaded_rows, ef AS expected_files,
            coalesce(lf, 0) AS loaded_files,
            CASE WHEN coalesce(lr, 0) > er THEN 'TOO_MANY' WHEN coalesce(lr, 0) < er THEN 'NOT_YET' ELSE 'DONE' END AS status,
            CASE WHEN coalesce(lf, 0) > ef THEN 'TOO_MANY' WHEN coalesce(lf, 0) < ef THEN 'NOT_YET' ELSE 'DONE' END AS file_status
          FROM m LEFT JOIN l ON l.entity = m.entity""")
def dq14_reconcile_status(t: Lake):
    """All three outcomes: users as entities, their orders announced, their events loaded."""
    manifest = t.orders.select(F.col("o_custkey").alias("entity"),
                               F.col("o_orderkey").cast("string").alias("key"),
                               F.lit(1).cast("bigint").alias("rows"))
    loaded = t.events.select(F.col("user_id").alias("entity"),
                             F.date_format("ts", "yyyy-MM-dd").alias("source_file"))
    return q.reconcile(manifest, loaded)


@query("dq15_reconcile_at_least", "day:D expected_rows:l loaded_rows:l status:s",
       """SELECT e.day, expected_rows, coalesce(n, 0) AS loaded_rows,
          CASE WHEN coalesce(n, 0) >= expected_rows THEN 'DONE' ELSE 'NOT_YET' END AS status FROM
          (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS expected_rows FROM orders GROUP BY 1) e
          LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem
                     WHERE l_returnflag = 'A' AND l_linestatus = 'F' GROUP BY 1) l ON l.day = e.day""")
def dq15_reconcile_at_least(t: Lake):
    expected = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("expected_rows"))
    loaded = t.lineitem.filter("l_returnflag = 'A' AND l_linestatus = 'F'").select(
        F.to_date("l_shipdate").alias("day"))
    return q.reconcile_min(expected, loaded, ["day"])


@query("dq16_last_check", "entity:s rows_announced:l rows_loaded:l may_advance:b",
       """SELECT run_id AS entity, count(*) AS rows_announced, count(DISTINCT claim_id || updated_at) AS rows_loaded,
          count(*) = count(DISTINCT claim_id || updated_at) AS may_advance FROM claims_d GROUP BY 1""", "claims_d")
def dq16_last_check(t: Lake):
    rows = feeds.claim_rows(t)
    announced = rows.groupBy(F.col("run_id").alias("entity")).agg(F.count(F.lit(1)).alias("rows_announced"))
    loaded = rows.select(F.col("run_id").alias("entity"), "claim_id", "updated_at").distinct().groupBy(
        "entity").agg(F.count(F.lit(1)).alias("rows_loaded"))
    status = q.compare_counts(F.col("rows_announced"), F.col("rows_loaded"))
    return announced.join(loaded, "entity").withColumn("may_advance", status == "DONE")


@query("dq17_contract", "c_custkey:l c_name:s c_acctbal:d",
       "SELECT c_custkey, c_name, c_acctbal FROM customer")
def dq17_contract(t: Lake):
    """Columns come out in contract order; a NULL key would fail the job."""
    agreed = contract(c_custkey="bigint!", c_name="string", c_acctbal="double")
    return q.enforce_contract(t.customer.select("c_acctbal", "c_name", "c_custkey"), agreed)


@query("dq18_batch_checks", "o_custkey:l row_count:l total:d not_empty:b positive:b",
       """SELECT o_custkey, count(*) AS row_count, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total,
          count(*) > 0 AS not_empty, sum(CAST(o_totalprice AS DECIMAL(12,2))) > 0 AS positive FROM orders GROUP BY 1""")
def dq18_batch_checks(t: Lake):
    sums = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total"))
    return sums.select("*", (F.col("row_count") > 0).alias("not_empty"), (F.col("total") > 0).alias("positive"))


@query("dq19_unknown_entity", "event_type:s occurrences:l",
       """SELECT event_type, count(*) AS occurrences FROM events
          WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY 1""")
def dq19_unknown_entity(t: Lake):
    return q.accepted_values(t.events, "event_type", ["view", "click", "purchase"])
