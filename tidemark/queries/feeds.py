"""The change feeds of the shipped models, derived from the given tables.

Customers change with their orders, line items are policies, and the events of
a user within a week are a claim. Everything is delivered as records, with
copies as a real feed has them: customer versions arrive twice, a line number
that repeats within an order is a newer version of the policy, and claim events
of the last two hours of a day arrive again with the next day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import skew
from tidemark.operators.versions import latest_per
from tidemark.queries.registry import Lake, cte

from tidemark.sources.landing import to_records

LINEAGE = ("business_date", "run_id", "source_file", "file_row", "loaded_at")

# ------------------------------------------------------------ Spark


def _delivered(df: DataFrame, entity: str, cursor: str, ident) -> DataFrame:
    """Lineage of delivery ``n``: one day after the change, then a day later."""
    day = F.to_date(cursor)
    run = F.concat(F.lit("r"), F.col("n").cast("string"))
    file = F.concat(
        F.lit(f"/lake/{entity}/dt="), day.cast("string"), F.lit("/run="), run,
        F.lit("/attempt=a/part-"), ident, F.lit(".json.gz"),
    )
    loaded = F.date_trunc("day", cursor).cast("timestamp_ntz") + F.make_dt_interval(days=F.col("n") + 1)
    return df.select(
        "*", day.alias("business_date"), run.alias("run_id"), file.alias("source_file"),
        F.lit(1).cast("bigint").alias("file_row"), loaded.alias("loaded_at"),
    ).drop("n")


def _text(*columns) -> F.Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in columns])


def tier() -> F.Column:
    return (
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "HIGH")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "MEDIUM").otherwise("LOW")
    )


def product() -> F.Column:
    return (
        F.when(F.col("l_returnflag") == "A", "AUTO").when(F.col("l_returnflag") == "N", "HOME")
        .otherwise("LIFE")
    )


def holder_rows(t: Lake, dealt: bool = False) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_orderkey")
    rows = (orders.repartition("o_custkey", "o_orderdate") if dealt else orders).select(
        F.col("o_custkey").alias("policyholder_id"),
        F.concat(F.lit("F-"), "o_orderstatus").alias("first_name"),
        F.concat(F.lit("L-"), "o_orderstatus").alias("last_name"),
        F.date_sub(F.to_date("o_orderdate"), 9000).alias("date_of_birth"),
        F.col("o_orderpriority").alias("city"),
        F.col("o_orderstatus").alias("state"),
        tier().alias("risk_tier"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("__id"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("n"),
    )
    return _delivered(rows, "policyholders", "updated_at", _text("__id")).drop("__id")


def policy_rows(t: Lake, dealt: bool = False) -> DataFrame:
    owners = t.orders.select("o_orderkey", "o_custkey")
    # the join deals the lines by order, where it may not broadcast the orders
    lines = t.lineitem.hint("merge") if dealt else t.lineitem
    rows = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("POL-"), _text("l_orderkey", "l_linenumber")).alias("policy_id"),
        F.col("o_custkey").alias("policyholder_id"),
        product().alias("product_line"),
        F.col("l_extendedprice").alias("annual_premium"),
        F.to_date("l_shipdate").alias("effective_date"),
        F.date_add(F.to_date("l_shipdate"), 365).alias("expiration_date"),
        F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").alias("issued_at"),
        _text("l_partkey", "l_suppkey").alias("__id"),
        F.lit(0).alias("n"),
    )
    return _delivered(rows, "policies", "issued_at", F.col("__id")).drop("__id")


def claim_rows(t: Lake, dealt: bool = False) -> DataFrame:
    week = F.to_date(F.date_trunc("week", "ts"))
    claim = F.concat(F.lit("CLM-"), F.col("user_id").cast("string"), F.lit("-"), F.date_format(week, "yyyyMMdd"))
    kind = F.col("event_type")
    status = (
        F.when(kind == "click", "APPROVED").when(kind == "error", "REJECTED")
        .when(kind == "purchase", "PAID").otherwise("OPEN")
    )
    copies = F.when(F.hour("ts") >= 22, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    events = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    rows = (events.repartition(claim, "ts") if dealt else events).select(
        claim.alias("claim_id"),
        F.concat(F.lit("POL-"), F.col("user_id").cast("string"), F.lit("-1")).alias("policy_id"),
        F.date_sub(week, 9131).alias("loss_date"),
        week.alias("reported_date"),
        F.col("value").alias("claim_amount"),
        status.alias("status"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("__id"),
        F.explode(copies).alias("n"),
    )
    return _delivered(rows, "claims", "updated_at", _text("__id")).drop("__id")


# Records. Given tables are dealt by key as they are, before copies, lineage and records are made: that is most
# of the work, and a given table may be a single row group. Nothing wider than a given row is shuffled for it.


def holders(t: Lake) -> DataFrame:
    return to_records(holder_rows(t, dealt=True), keep=LINEAGE)


def policies(t: Lake) -> DataFrame:
    return to_records(policy_rows(t, dealt=True), keep=LINEAGE)


def claims(t: Lake) -> DataFrame:
    return to_records(claim_rows(t, dealt=True), keep=LINEAGE)


def holder_pieces(t: Lake) -> skew.Pieces | None:
    """Cut points of customers with very long histories, from the stored orders."""
    changes = t.orders.select(
        F.col("o_custkey").alias("policyholder_id"), F.col("o_orderdate").alias("updated_at")
    )
    return skew.find_pieces(changes, "policyholder_id", "updated_at")


# ------------------------------------------------------------ a feed for whole runs

# Changes of one month, second by second: every run of the month finds fresh sources.
MONTH = 30 * 24 * 3600


def _at(slot) -> F.Column:
    return F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=slot)


def _twice(df: DataFrame) -> DataFrame:
    return df.withColumn("__n", F.explode(F.array(F.lit(0), F.lit(1)))).drop("__n")


def run_holders(t: Lake) -> DataFrame:
    """Customer versions as ``holder_rows`` has them, changed within one month; each delivered twice."""
    slots = t.orders.withColumn("__slot", F.pmod(F.col("o_orderkey") * 7919, F.lit(MONTH)))
    changes = latest_per(slots, ["o_custkey", "__slot"], ["o_orderkey"]).select(
        F.col("o_custkey").alias("policyholder_id"),
        F.concat(F.lit("F-"), "o_orderstatus").alias("first_name"), F.concat(F.lit("L-"), "o_orderstatus").alias("last_name"),
        F.date_sub(F.to_date("o_orderdate"), 9000).alias("date_of_birth"),
        F.col("o_orderpriority").alias("city"), F.col("o_orderstatus").alias("state"), tier().alias("risk_tier"),
        _at(F.col("__slot")).alias("updated_at"),
    )
    return _twice(changes)


def run_policies(t: Lake) -> DataFrame:
    """One policy per line number of an order."""
    lines = latest_per(t.lineitem, ["l_orderkey", "l_linenumber"],
                       ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus"])
    slot = F.pmod(F.col("l_orderkey") * 4093 + F.col("l_linenumber") * 6007, F.lit(MONTH))
    issued = _at(slot)
    owners = t.orders.select("o_orderkey", "o_custkey")
    return lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("POL-"), _text("l_orderkey", "l_linenumber")).alias("policy_id"),
        F.col("o_custkey").alias("policyholder_id"), product().alias("product_line"),
        F.col("l_extendedprice").alias("annual_premium"),
        F.to_date(issued).alias("effective_date"), F.date_add(F.to_date(issued), 365).alias("expiration_date"),
        F.col("l_linestatus").alias("status"), issued.alias("issued_at"),
    )


def run_claims(t: Lake) -> DataFrame:
    """Claims on policies already issued, with one outcome each; late events of a day are delivered twice."""
    first = t.lineitem.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("line"))
    slot = F.pmod(F.col("l_orderkey") * 4093 + F.col("line") * 6007, F.lit(MONTH))
    insured = first.select(
        F.col("l_orderkey").alias("__user"), F.concat(F.lit("POL-"), _text("l_orderkey", "line")).alias("policy_id"),
        _at(slot).alias("__issued"))
    kind, even = F.col("event_type"), F.col("user_id") % 2 == 0
    status = (
        F.when((kind == "click") & even, "APPROVED").when((kind == "error") & ~even, "REJECTED")
        .when(kind == "purchase", "PAID").otherwise("OPEN")
    )
    events = latest_per(t.events, ["user_id", "ts"], ["event_id"])
    rows = events.join(insured, F.col("user_id") == F.col("__user")).filter("ts >= __issued")
    week = F.to_date(F.date_trunc("week", "ts"))
    copies = F.when(F.hour("ts") >= 22, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.concat(F.lit("CLM-"), F.col("user_id").cast("string"), F.lit("-"), F.date_format(week, "yyyyMMdd")).alias("claim_id"),
        "policy_id", F.date_sub(week, 9131).alias("loss_date"), week.alias("reported_date"),
        F.col("value").alias("claim_amount"), status.alias("status"), F.col("ts").alias("updated_at"),
        F.explode(copies).alias("__n"),
    ).drop("__n")


def run_feeds(t: Lake) -> dict[str, DataFrame]:
    return {"policyholders": run_holders(t), "policies": run_policies(t), "claims": run_claims(t)}


# ------------------------------------------------------------ SQL


def _lineage(entity: str, cursor: str, ident: str) -> str:
    return f"""
    CAST({cursor} AS DATE) AS business_date, 'r' || n AS run_id,
    '/lake/{entity}/dt=' || strftime({cursor}, '%Y-%m-%d') || '/run=r' || n
      || '/attempt=a/part-' || {ident} || '.json.gz' AS source_file,
    1 AS file_row, date_trunc('day', {cursor}) + (n + 1) * INTERVAL 1 DAY AS loaded_at"""


cte("holders_d", f"""
  SELECT o_custkey AS policyholder_id, 'F-' || o_orderstatus AS first_name,
    'L-' || o_orderstatus AS last_name, CAST(o_orderdate AS DATE) - 9000 AS date_of_birth,
    o_orderpriority AS city, o_orderstatus AS state,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
    o_orderdate AS updated_at, {_lineage('policyholders', 'o_orderdate', 'o_orderkey')}
  FROM orders CROSS JOIN (VALUES (0), (1)) AS d(n)""")

cte("policies_d", f"""
  SELECT 'POL-' || l_orderkey || '-' || l_linenumber AS policy_id, o_custkey AS policyholder_id,
    CASE l_returnflag WHEN 'A' THEN 'AUTO' WHEN 'N' THEN 'HOME' ELSE 'LIFE' END AS product_line,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS annual_premium,
    CAST(l_shipdate AS DATE) AS effective_date, CAST(l_shipdate AS DATE) + 365 AS expiration_date,
    l_linestatus AS policy_status, l_shipdate AS issued_at,
    {_lineage('policies', 'l_shipdate', "l_partkey || '-' || l_suppkey")}
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey CROSS JOIN (SELECT 0 AS n)""")

cte("claims_d", f"""
  SELECT 'CLM-' || user_id || '-' || strftime(date_trunc('week', ts), '%Y%m%d') AS claim_id,
    'POL-' || user_id || '-1' AS policy_id,
    CAST(date_trunc('week', ts) AS DATE) - 9131 AS loss_date,
    CAST(date_trunc('week', ts) AS DATE) AS reported_date,
    CAST(value AS DECIMAL(12,2)) AS claim_amount,
    CASE event_type WHEN 'click' THEN 'APPROVED' WHEN 'error' THEN 'REJECTED'
                    WHEN 'purchase' THEN 'PAID' ELSE 'OPEN' END AS claim_status,
    ts AS updated_at, {_lineage('claims', 'ts', 'event_id')}
  FROM events JOIN (VALUES (0), (1)) AS d(n) ON n = 0 OR hour(ts) >= 22""")


def _latest(source: str, keys: str, order: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"""


cte("slv_holder_versions", _latest("holders_d", "policyholder_id, updated_at",
                                   "loaded_at DESC, source_file DESC"), "holders_d")
cte("slv_holders", _latest("slv_holder_versions", "policyholder_id", "updated_at DESC"),
    "slv_holder_versions")
cte("slv_policies", _latest("policies_d", "policy_id",
                            "issued_at DESC, loaded_at DESC, source_file DESC"), "policies_d")
cte("slv_claims", _latest("claims_d", "claim_id, updated_at",
                          "loaded_at DESC, source_file DESC"), "claims_d")

def _version_key(ident: str, at: str) -> str:
    return f"md5({ident} || '~' || strftime({at}, '%Y-%m-%d %H:%M:%S'))"


def _day_key(day: str) -> str:
    return f"year({day}) * 10000 + month({day}) * 100 + day({day})"


# a version ends with the earliest later one of its holder
cte("dim_holder", f"""
  WITH ends AS (
    SELECT v.policyholder_id, v.updated_at, min(later.updated_at) AS until
    FROM slv_holder_versions v LEFT JOIN slv_holder_versions later
      ON later.policyholder_id = v.policyholder_id AND later.updated_at > v.updated_at
    GROUP BY ALL)
  SELECT {_version_key('policyholder_id', 'updated_at')} AS policyholder_sk, policyholder_id, first_name, last_name,
    date_of_birth, city, state, risk_tier, updated_at AS valid_from,
    ifnull(until, TIMESTAMP '9999-12-31') AS valid_to, until IS NULL AS is_current
  FROM slv_holder_versions JOIN ends USING (policyholder_id, updated_at)
  UNION ALL BY NAME
  SELECT '-1' AS policyholder_sk, -1 AS policyholder_id, NULL AS date_of_birth, true AS is_current,
    TIMESTAMP '1900-01-01' AS valid_from, TIMESTAMP '9999-12-31' AS valid_to,
    u AS first_name, u AS last_name, u AS city, u AS state, u AS risk_tier FROM (VALUES ('Unknown')) AS x(u)""",
    "slv_holder_versions")

cte("dim_policy", """
  SELECT md5(policy_id) AS policy_sk, policy_id, product_line, policy_status, effective_date, expiration_date,
    expiration_date - effective_date AS term_days FROM slv_policies
  UNION ALL BY NAME
  SELECT '-1' AS policy_sk, 'UNKNOWN' AS policy_id, u AS product_line, u AS policy_status
  FROM (VALUES ('Unknown')) AS x(u)""", "slv_policies")

# holder versions chain without gaps, so the one in force is the last that began
cte("fct_written", f"""
  SELECT p.policy_id, md5(p.policy_id) AS policy_sk,
    CASE WHEN v.updated_at IS NULL THEN '-1' ELSE {_version_key('v.policyholder_id', 'v.updated_at')} END AS policyholder_sk,
    {_day_key('p.issued_at')} AS issue_date_key, {_day_key('p.effective_date')} AS effective_date_key,
    p.annual_premium, p.issued_at
  FROM slv_policies p ASOF LEFT JOIN slv_holder_versions v
    ON v.policyholder_id = p.policyholder_id AND p.issued_at >= v.updated_at""",
    "slv_policies", "slv_holder_versions")

# policy and dates never change within a claim, so its newest event has them all
cte("claim_states", """
  SELECT *, min(updated_at) FILTER (claim_status = 'APPROVED') OVER whole AS approved_at,
    min(updated_at) FILTER (claim_status = 'REJECTED') OVER whole AS rejected_at,
    min(updated_at) FILTER (claim_status = 'PAID') OVER whole AS paid_at, max(loaded_at) OVER whole AS last_loaded_at
  FROM slv_claims WINDOW whole AS (PARTITION BY claim_id)
  QUALIFY updated_at = max(updated_at) OVER whole""", "slv_claims")

cte("fct_claims", f"""
  WITH owned AS (
    SELECT s.*, p.policy_id IS NOT NULL AS has_policy, p.policyholder_id, CAST(s.loss_date AS TIMESTAMP) AS lost_at
    FROM claim_states s LEFT JOIN slv_policies p USING (policy_id))
  SELECT o.claim_id, if(o.has_policy, md5(o.policy_id), '-1') AS policy_sk,
    CASE WHEN v.updated_at IS NULL THEN '-1' ELSE {_version_key('v.policyholder_id', 'v.updated_at')} END AS policyholder_sk,
    {_day_key('o.loss_date')} AS loss_date_key, {_day_key('o.reported_date')} AS reported_date_key,
    {_day_key('o.approved_at')} AS approved_date_key, {_day_key('o.rejected_at')} AS rejected_date_key,
    {_day_key('o.paid_at')} AS paid_date_key, o.claim_status AS current_status, o.claim_amount,
    CAST(o.paid_at AS DATE) - o.reported_date AS days_to_settle, o.updated_at AS last_updated_at, o.last_loaded_at
  FROM owned o ASOF LEFT JOIN slv_holder_versions v
    ON v.policyholder_id = o.policyholder_id AND o.lost_at >= v.updated_at""",
    "claim_states", "slv_policies", "slv_holder_versions")


# the feed for whole runs: rows as the source has them, copies with n
_PARSED = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {0} ORDER BY {1}) AS rn FROM {2}) WHERE rn = 1"

cte("run_holders", f"""
  SELECT o_custkey AS policyholder_id, 'F-' || o_orderstatus AS first_name, 'L-' || o_orderstatus AS last_name,
    CAST(o_orderdate AS DATE) - 9000 AS date_of_birth, o_orderpriority AS city, o_orderstatus AS state,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
    TIMESTAMP '2024-01-01' + to_seconds(slot) AS updated_at, 2 AS copies
  FROM ({_PARSED.format('o_custkey, slot', 'o_orderkey DESC', f'(SELECT *, (o_orderkey * 7919) % {MONTH} AS slot FROM orders)')})""")

cte("run_policies", f"""
  SELECT 'POL-' || l_orderkey || '-' || l_linenumber AS policy_id, o_custkey AS policyholder_id,
    CASE l_returnflag WHEN 'A' THEN 'AUTO' WHEN 'N' THEN 'HOME' ELSE 'LIFE' END AS product_line,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS annual_premium, CAST(issued_at AS DATE) AS effective_date,
    CAST(issued_at AS DATE) + 365 AS expiration_date, l_linestatus AS policy_status, issued_at, 1 AS copies
  FROM (SELECT *, TIMESTAMP '2024-01-01' + to_seconds((l_orderkey * 4093 + l_linenumber * 6007) % {MONTH}) AS issued_at
    FROM ({_PARSED.format('l_orderkey, l_linenumber', 'l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_shipdate DESC, l_returnflag DESC, l_linestatus DESC', 'lineitem')}))
  JOIN orders ON o_orderkey = l_orderkey""")

cte("run_claims", f"""
  SELECT 'CLM-' || user_id || '-' || strftime(date_trunc('week', ts), '%Y%m%d') AS claim_id, policy_id,
    CAST(date_trunc('week', ts) AS DATE) - 9131 AS loss_date, CAST(date_trunc('week', ts) AS DATE) AS reported_date,
    CAST(value AS DECIMAL(12,2)) AS claim_amount,
    CASE WHEN event_type = 'click' AND user_id % 2 = 0 THEN 'APPROVED' WHEN event_type = 'error' AND user_id % 2 = 1 THEN 'REJECTED'
         WHEN event_type = 'purchase' THEN 'PAID' ELSE 'OPEN' END AS claim_status,
    ts AS updated_at, if(hour(ts) >= 22, 2, 1) AS copies
  FROM ({_PARSED.format('user_id, ts', 'event_id DESC', 'events')})
  JOIN (SELECT l_orderkey, 'POL-' || l_orderkey || '-' || min(l_linenumber) AS policy_id,
      TIMESTAMP '2024-01-01' + to_seconds((l_orderkey * 4093 + min(l_linenumber) * 6007) % {MONTH}) AS issued
    FROM lineitem GROUP BY l_orderkey) ON l_orderkey = user_id AND ts >= issued""")
