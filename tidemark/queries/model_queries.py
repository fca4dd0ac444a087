"""The shipped tables and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.keys import MICROS, or_unknown, with_packed
from tidemark.operators import facts, history, selection, skew
from tidemark.operators.calendar import describe_days, spine_over
from tidemark.operators.upsert import merged
from tidemark.operators.versions import latest_per
from tidemark.plans import models, reports
from tidemark.queries import feeds
from tidemark.queries.registry import Lake, query

from tidemark.session import work_dir
from tidemark.sources.landing import bronze
from tidemark.sources.tables import stored
from tidemark.spec import POLICYHOLDERS

# ------------------------------------------------------------ flagship


@query(
    "revenue_by_tier_at_ship_time",
    "tier:s lines:l revenue:d first_sk:s",
    """
    WITH log AS (
      SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
    dim AS (
      SELECT md5(o_custkey || '~' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')) AS sk, o_custkey,
        o_orderpriority, o_orderdate AS valid_from,
        coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate),
                 TIMESTAMP '9999-12-31') AS valid_to FROM log)
    SELECT coalesce(d.o_orderpriority, 'Unknown') AS tier, count(*) AS lines,
      sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS revenue, min(coalesce(d.sk, '-1')) AS first_sk
    FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey
    LEFT JOIN dim d ON d.o_custkey = o.o_custkey AND l_shipdate >= d.valid_from AND l_shipdate < d.valid_to
    GROUP BY 1
    """,
)
def revenue_by_tier_at_ship_time(t: Lake):
    """Revenue by the priority tier the customer had when the line was shipped."""
    pieces = skew.find_pieces(t.orders, "o_custkey", "o_orderdate")
    log = latest_per(
        t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"),
        ["o_custkey", "o_orderdate"], ["o_orderkey"],
    )
    dim = history.scd2_windows(
        log, "o_custkey", "o_orderdate", ["o_orderpriority"], sk_format=MICROS, pieces=pieces
    )
    lines = t.lineitem.select(
        "l_orderkey", "l_shipdate", F.col("l_extendedprice").cast("decimal(12,2)").alias("price")
    ).join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    placed = history.point_in_time(
        lines, dim, "o_custkey", "l_shipdate", ["version_sk", "o_orderpriority"], pieces=pieces
    )
    return placed.groupBy(or_unknown("o_orderpriority", "Unknown").alias("tier")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("price").alias("revenue"),
        F.min(or_unknown("version_sk")).alias("first_sk"),
    )


# ------------------------------------------------------------ bronze, staging, silver

_HOLDER = ("policyholder_id:l first_name:s last_name:s date_of_birth:D city:s state:s risk_tier:s "
           "updated_at:t")
_POLICY = ("policy_id:s policyholder_id:l product_line:s annual_premium:d effective_date:D "
           "expiration_date:D policy_status:s issued_at:t")
_CLAIM = ("claim_id:s policy_id:s loss_date:D reported_date:D claim_amount:d claim_status:s "
          "updated_at:t")
_LINEAGE = " run_id:s source_file:s loaded_at:t"


@query("md01_bronze_policyholders", "city:s business_date:D run_id:s source_file:s file_row:l loaded_at:t",
       "SELECT * FROM holders_d", "holders_d")
def md01_bronze_policyholders(t: Lake):
    rows = bronze(feeds.holders(t))
    return rows.withColumn("city", F.variant_get("record", "$.city", "string"))


@query("md01_bronze_policies", "premium:d business_date:D run_id:s source_file:s file_row:l loaded_at:t",
       "SELECT *, annual_premium AS premium FROM policies_d", "policies_d")
def md01_bronze_policies(t: Lake):
    rows = bronze(feeds.policies(t))
    return rows.withColumn("premium", F.variant_get("record", "$.annual_premium", "decimal(12,2)"))


@query("md01_bronze_claims", "claim_id:s business_date:D run_id:s source_file:s file_row:l loaded_at:t",
       "SELECT * FROM claims_d", "claims_d")
def md01_bronze_claims(t: Lake):
    rows = bronze(feeds.claims(t))
    return rows.withColumn("claim_id", F.variant_get("record", "$.claim_id", "string"))


@query("md02_stg_policyholders", _HOLDER + " business_date:D source_file:s loaded_at:t",
       """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY policyholder_id, business_date
          ORDER BY loaded_at DESC, source_file DESC) AS rn FROM holders_d) WHERE rn = 1""", "holders_d")
def md02_stg_policyholders(t: Lake):
    return models.stg_policyholders(feeds.holders(t))


@query("md02_stg_policies", _POLICY + " business_date:D source_file:s loaded_at:t",
       """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY policy_id
          ORDER BY loaded_at DESC, source_file DESC) AS rn FROM policies_d) WHERE rn = 1""", "policies_d")
def md02_stg_policies(t: Lake):
    return models.stg_policies(feeds.policies(t))


@query("md02_stg_claims", _CLAIM + " business_date:D source_file:s loaded_at:t",
       "SELECT * FROM slv_claims", "slv_claims")
def md02_stg_claims(t: Lake):
    return models.stg_claims(feeds.claims(t))


@query("md03_policyholder_versions", _HOLDER + _LINEAGE,
       "SELECT * FROM slv_holder_versions", "slv_holder_versions")
def md03_policyholder_versions(t: Lake):
    return models.slv_policyholder_versions(feeds.holders(t))


def _in_two_loads(landing, keys, model, cut: str, newest=()):
    """Build from the loads up to ``cut``, then upsert what the incremental filter picks."""
    first = model(landing.filter(F.col("loaded_at") <= F.lit(cut).cast("timestamp_ntz")))
    return merged(first, model(landing, first), keys, newest)


@query("md03_policyholder_versions_incremental", _HOLDER + _LINEAGE,
       "SELECT * FROM slv_holder_versions", "slv_holder_versions")
def md03_policyholder_versions_incremental(t: Lake):
    """Two loads give what one load of everything gives."""
    return _in_two_loads(feeds.holders(t), ["policyholder_id", "updated_at"],
                         models.slv_policyholder_versions, "1998-06-30")


@query("md04_policyholders_current", _HOLDER, "SELECT * FROM slv_holders", "slv_holders")
def md04_policyholders_current(t: Lake):
    return models.slv_policyholders(models.slv_policyholder_versions(feeds.holders(t)))


@query("md05_policies_scd1", _POLICY + _LINEAGE, "SELECT * FROM slv_policies", "slv_policies")
def md05_policies_scd1(t: Lake):
    return models.slv_policies(feeds.policies(t))


@query("md05_policies_scd1_incremental", _POLICY + _LINEAGE, "SELECT * FROM slv_policies", "slv_policies")
def md05_policies_scd1_incremental(t: Lake):
    return _in_two_loads(feeds.policies(t), ["policy_id"], models.slv_policies, "1998-06-30",
                         newest=["issued_at", "loaded_at", "source_file"])


@query("md06_claim_events", _CLAIM + _LINEAGE, "SELECT * FROM slv_claims", "slv_claims")
def md06_claim_events(t: Lake):
    return models.slv_claim_events(feeds.claims(t))


@query("md06_claim_events_incremental", _CLAIM + _LINEAGE, "SELECT * FROM slv_claims", "slv_claims")
def md06_claim_events_incremental(t: Lake):
    return _in_two_loads(feeds.claims(t), ["claim_id", "updated_at"],
                         models.slv_claim_events, "2024-01-15")


# ------------------------------------------------------------ snapshots

RUN_DAYS = ("1996-01-01", "1997-06-15", "1999-01-01", "2001-12-31")

_STATES = " UNION ALL ".join(
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY policyholder_id
        ORDER BY updated_at DESC) AS rn FROM slv_holder_versions
        WHERE updated_at <= TIMESTAMP '{day}') WHERE rn = 1"""
    for day in RUN_DAYS
)
# What a snapshot has seen is the union of the states of its runs.
_SNAPSHOT = f"""
  SELECT md5(policyholder_id || '|' || strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id, *,
    updated_at AS valid_from,
    coalesce(lead(updated_at) OVER (PARTITION BY policyholder_id ORDER BY updated_at),
             TIMESTAMP '9999-12-31') AS valid_to
  FROM (SELECT DISTINCT policyholder_id, first_name, last_name, date_of_birth, city, state,
          risk_tier, updated_at FROM ({_STATES}))"""


def _snapshot(t: Lake):
    versions = stored(t.spark, models.slv_policyholder_versions(feeds.holders(t)))
    past = None
    for day in RUN_DAYS:
        known = versions.filter(F.col("updated_at") <= F.lit(day).cast("timestamp_ntz"))
        past = stored(t.spark, models.snap_api_policyholders(models.slv_policyholders(known), past))
    return past


@query("md07_snapshot_history", "scd_id:s " + _HOLDER + " valid_from:t valid_to:t",
       _SNAPSHOT, "slv_holder_versions")
def md07_snapshot_history(t: Lake):
    return _snapshot(t)


DUMP_DAYS = ("1996-01-31", "1998-01-31", "2000-01-31")
BACKFILL_DAYS = tuple(f"{year}-{month}" for year in range(1993, 1997)
                      for month in ("01-31", "02-28", "03-31", "04-30", "05-31", "06-30", "07-31", "08-31", "09-30", "10-31", "11-30", "12-31"))


def _dump_sql(day: str) -> str:
    return f"""SELECT policyholder_id, first_name, last_name, date_of_birth, city, state, risk_tier,
        updated_at FROM (SELECT *, row_number() OVER (PARTITION BY policyholder_id
        ORDER BY updated_at DESC) AS rn FROM slv_holder_versions
        WHERE CAST(updated_at AS DATE) <= DATE '{day}') WHERE rn = 1"""


@query(
    "md08_daily_dump_history", "scd_id:s " + _HOLDER + " valid_from:t valid_to:t",
    f"""SELECT md5(policyholder_id || '|' || strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id, *,
      updated_at AS valid_from,
      coalesce(lead(updated_at) OVER (PARTITION BY policyholder_id ORDER BY updated_at),
               TIMESTAMP '9999-12-31') AS valid_to
      FROM (SELECT DISTINCT * FROM ({' UNION ALL '.join(_dump_sql(d) for d in DUMP_DAYS)}))""",
    "slv_holder_versions",
)
def md08_daily_dump_history(t: Lake):
    """Full dumps of three days, backfilled in order."""
    versions = stored(t.spark, models.slv_policyholder_versions(feeds.holders(t)))
    past = None
    for day in DUMP_DAYS:
        dump = selection.as_of(versions, "policyholder_id", "updated_at", day)
        staged = dump.withColumn("business_date", F.lit(day).cast("date"))
        past = stored(t.spark, models.snap_policyholders(staged, past, day))
    return past


@query(
    "snk17_backfill_in_one_pass", "scd_id:s " + _HOLDER + " valid_from:t valid_to:t",
    f"""SELECT md5(policyholder_id || '|' || strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id, *,
      updated_at AS valid_from,
      coalesce(lead(updated_at) OVER (PARTITION BY policyholder_id ORDER BY updated_at),
               TIMESTAMP '9999-12-31') AS valid_to
      FROM (SELECT DISTINCT * FROM ({' UNION ALL '.join(_dump_sql(d) for d in BACKFILL_DAYS)}))""",
    "slv_holder_versions",
)
def snk17_backfill_in_one_pass(t: Lake):
    """Dumps of the last day of 48 months: the first two merged one by one, the others in one pass onto that history."""
    versions = stored(t.spark, models.slv_policyholder_versions(feeds.holders(t)))
    dumps = [selection.as_of(versions, "policyholder_id", "updated_at", day).select(*POLICYHOLDERS.fields) for day in BACKFILL_DAYS[:2]]
    past = models.snap_api_policyholders(dumps[1], models.snap_api_policyholders(dumps[0]))
    days = F.array(*[F.lit(d).cast("date") for d in BACKFILL_DAYS[2:]])
    # a dump holds the newest version of every customer up to its day: the one whose window holds the day's end
    windows = history.scd2_windows(versions, "policyholder_id", "updated_at", [c for c in POLICYHOLDERS.fields if c not in ("policyholder_id", "updated_at")], pieces=None)
    held = F.filter(days, lambda day: (F.to_date("valid_from") <= day) & (F.to_date("valid_to") > day))
    rest = windows.withColumn("day", F.explode(held)).withColumn("updated_at", F.col("valid_from")).select(*POLICYHOLDERS.fields, "day")
    return history.snapshot_backfill(rest, "policyholder_id", "updated_at", "day", stored(t.spark, past))


# ------------------------------------------------------------ dimensions


@query(
    "md09_calendar",
    "date_key:i date_day:D calendar_year:i calendar_quarter:i calendar_month:i month_name:s "
    "day_of_month:i day_of_week:i day_name:s is_weekend:b month_start_date:D",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day, year(d) AS calendar_year,
       quarter(d) AS calendar_quarter, month(d) AS calendar_month, strftime(d, '%b') AS month_name,
       day(d) AS day_of_month, isodow(d) AS day_of_week, strftime(d, '%a') AS day_name,
       isodow(d) IN (6, 7) AS is_weekend, date_trunc('month', d) AS month_start_date
       FROM (SELECT unnest(generate_series(min(l_shipdate)::DATE::TIMESTAMP, max(l_shipdate)::DATE::TIMESTAMP,
             INTERVAL 1 DAY)) AS d FROM lineitem)""",
)
def md09_calendar(t: Lake):
    return describe_days(spine_over(t.lineitem, "l_shipdate"))


_DIM_HOLDER = ("policyholder_sk:s policyholder_id:l first_name:s last_name:s date_of_birth:D city:s "
               "state:s risk_tier:s valid_from:t valid_to:t is_current:b")


def dim_holder(t: Lake):
    versions = models.slv_policyholder_versions(feeds.holders(t))
    return models.dim_policyholder(versions, pieces=feeds.holder_pieces(t))


@query("md10_dim_policyholder", _DIM_HOLDER, "SELECT * FROM dim_holder", "dim_holder")
def md10_dim_policyholder(t: Lake):
    return dim_holder(t)


@query("md11_dim_policyholder_snap", _DIM_HOLDER,
       f"""SELECT scd_id AS policyholder_sk, policyholder_id, first_name, last_name, date_of_birth, city,
          state, risk_tier, valid_from, valid_to, valid_to = TIMESTAMP '9999-12-31' AS is_current
          FROM ({_SNAPSHOT})
          UNION ALL SELECT '-1', -1, 'Unknown', 'Unknown', NULL, 'Unknown', 'Unknown', 'Unknown',
          TIMESTAMP '1900-01-01', TIMESTAMP '9999-12-31', true""", "slv_holder_versions")
def md11_dim_policyholder_snap(t: Lake):
    return models.dim_policyholder_snap(_snapshot(t))


@query("md12_dim_policy",
       "policy_sk:s policy_id:s product_line:s policy_status:s effective_date:D expiration_date:D term_days:d",
       "SELECT * FROM dim_policy", "dim_policy")
def md12_dim_policy(t: Lake):
    return models.dim_policy(models.slv_policies(feeds.policies(t)))


# ------------------------------------------------------------ facts

_WRITTEN = ("policy_id:s policy_sk:s policyholder_sk:s issue_date_key:i effective_date_key:i "
            "annual_premium:d issued_at:t")
_FCT_CLAIMS = ("claim_id:s policy_sk:s policyholder_sk:s loss_date_key:i reported_date_key:i "
               "approved_date_key:d rejected_date_key:d paid_date_key:d current_status:s "
               "claim_amount:d days_to_settle:d last_updated_at:t last_loaded_at:t")


# what facts read of silver policies and of the customer dimension
_OF_WRITTEN = ("policy_id", "policyholder_id", "annual_premium", "effective_date", "issued_at")
_OF_CLAIMS = ("policy_id", "policyholder_id")
_OF_HOLDER = ("policyholder_sk", "policyholder_id", "valid_from", "valid_to")


def _policies(t: Lake, columns=None):
    """Silver policies as a stored table, whole or with some columns; no fact or dimension has their lineage."""
    silver = models.slv_policies(feeds.policies(t)).drop(*models.LINEAGE)
    return stored(t.spark, silver.select(*columns) if columns else silver)


def star(t: Lake) -> dict:
    """Silver policies and the customer dimension as stored tables: several tables build on them."""
    silver = _policies(t)
    holder = stored(t.spark, dim_holder(t))
    return {"policies": silver, "dim_policy": models.dim_policy(silver), "dim_holder": holder,
            "pieces": feeds.holder_pieces(t)}


def narrow_star(t: Lake, policy=_OF_CLAIMS, more_of_holder=(), of_dim_policy=()) -> dict:
    """The star with all its rows and the columns that a query reads: a stored table hides from Spark which these are."""
    silver = _policies(t, policy)
    holder = stored(t.spark, dim_holder(t).select(*_OF_HOLDER, *more_of_holder))
    return {"policies": silver, "dim_policy": models.dim_policy(silver, of_dim_policy), "dim_holder": holder,
            "pieces": feeds.holder_pieces(t)}


def written(t: Lake, s: dict):
    return models.fct_policies_written(s["policies"], s["dim_policy"], s["dim_holder"], pieces=s["pieces"])


def claim_facts(t: Lake, s: dict, events=None, target=None):
    events = models.slv_claim_events(feeds.claims(t)) if events is None else events
    return models.fct_claims(events, s["policies"], s["dim_policy"], s["dim_holder"],
                             target=target, pieces=s["pieces"])


@query("md13_fct_policies_written", _WRITTEN, "SELECT * FROM fct_written", "fct_written")
def md13_fct_policies_written(t: Lake):
    return written(t, narrow_star(t, _OF_WRITTEN))


@query("md14_accumulating_full", _FCT_CLAIMS, "SELECT * FROM fct_claims", "fct_claims")
def md14_accumulating_full(t: Lake):
    return claim_facts(t, narrow_star(t))


@query("md14_accumulating_incremental", _FCT_CLAIMS, "SELECT * FROM fct_claims", "fct_claims")
def md14_accumulating_incremental(t: Lake):
    """The first half of the deliveries, then the claims that changed since: equals the full build."""
    s = narrow_star(t)
    landing = feeds.claims(t)
    events = stored(t.spark, models.slv_claim_events(landing))
    early = landing.filter(F.col("loaded_at") <= F.lit("2024-01-15").cast("timestamp_ntz"))
    target = stored(t.spark, claim_facts(t, s, models.slv_claim_events(early)))
    rebuilt = claim_facts(t, s, events, target)
    return merged(target, rebuilt, ["claim_id"])


# ------------------------------------------------------------ late customer versions


def _late(versions, n: int):
    """One of two batches of versions that arrive after the first build, spread over all histories."""
    return versions.filter(F.pmod(F.xxhash64("policyholder_id", "updated_at"), F.lit(7)) == n)


def _on_time(versions):
    return versions.filter(F.pmod(F.xxhash64("policyholder_id", "updated_at"), F.lit(7)) > 1)


def repaired_dim(t: Lake, **attributes):
    """(dimension before, after) two late batches, and the windows that arrived with them."""
    versions = models.slv_policyholder_versions(feeds.holders(t)).drop(*models.LINEAGE)
    if attributes:  # a stored table hides which columns are read
        versions = versions.select("policyholder_id", "updated_at", *attributes["attributes"])
    versions = stored(t.spark, versions)
    first = dim = stored(t.spark, models.dim_policyholder(_on_time(versions), pieces=None, **attributes))
    all_arrived = []
    for n in (0, 1):
        arrived, closed = (stored(t.spark, part) for part in models.late_policyholders(dim, _late(versions, n), pieces=feeds.holder_pieces(t), **attributes))
        dim = stored(t.spark, merged(dim, arrived.unionByName(closed), ["policyholder_id", "valid_from"]))
        all_arrived.append(arrived)
    return first, dim, all_arrived


@query("md10_late_versions", _DIM_HOLDER, "SELECT * FROM dim_holder", "dim_holder")
def md10_late_versions(t: Lake):
    """Two sevenths of the versions arrive late, in two batches; only their windows and those they shorten are written."""
    return repaired_dim(t)[1]


def _late_star(t: Lake, policy):
    first, dim, arrived = repaired_dim(t)
    policies = _policies(t, policy)
    return {"policies": policies, "dim_policy": models.dim_policy(policies, ()), "dim_holder": first, "pieces": feeds.holder_pieces(t)}, arrived


def _with_late_keys(t: Lake, stored_facts, rekey, arrived, key: str):
    """Stored facts under the keys of all batches. Only their key changes, so each batch is re-keyed from them as
    they were stored; batches replace each other first, and the facts are met by all of them at once."""
    late = None
    for windows in arrived:
        changed = stored(t.spark, rekey(stored_facts, windows))
        late = changed if late is None else stored(t.spark, merged(late, changed, [key]))
    return merged(stored_facts, late, [key])


@query("md13_late_versions", _WRITTEN, "SELECT * FROM fct_written", "fct_written")
def md13_late_versions(t: Lake):
    """Facts stored by month before the versions arrived; only policies issued within their windows are written again."""
    s, arrived = _late_star(t, _OF_WRITTEN)
    path = work_dir(t.spark, "written-by-month")
    by_month = written(t, s).withColumn("month", F.to_date(F.trunc("issued_at", "MM")))
    by_month.write.option("compression", "zstd").partitionBy("month").parquet(path)

    def rekey(facts_, windows):
        return models.rekeyed_policies_written(facts_, s["policies"], windows, period="month", pieces=s["pieces"])

    return _with_late_keys(t, t.spark.read.parquet(path), rekey, arrived, "policy_id")


@query("md14_late_versions", _FCT_CLAIMS, "SELECT * FROM fct_claims", "fct_claims")
def md14_late_versions(t: Lake):
    s, arrived = _late_star(t, _OF_CLAIMS)

    def rekey(facts_, windows):
        return models.rekeyed_claims(facts_, s["policies"], windows, pieces=s["pieces"])

    return _with_late_keys(t, stored(t.spark, claim_facts(t, s)), rekey, arrived, "claim_id")


# ------------------------------------------------------------ reports


@query("md17_premium_by_month_city_product", "calendar_month:i city:s product_line:s premium:d",
       """SELECT month(f.issued_at) AS calendar_month, h.city, p.product_line, sum(f.annual_premium) AS premium
          FROM fct_written f JOIN dim_policy p ON f.policy_sk = p.policy_sk
          JOIN dim_holder h ON f.policyholder_sk = h.policyholder_sk GROUP BY 1, 2, 3""",
       "fct_written dim_policy dim_holder")
def md17_premium_by_month_city_product(t: Lake):
    s = narrow_star(t, (*_OF_WRITTEN, "product_line"), ("city",), ("product_line",))
    calendar = describe_days(spine_over(t.lineitem, "l_shipdate"))
    return reports.premium_by_month_city_product(written(t, s), s["dim_policy"], s["dim_holder"], calendar)


_BY_MONTH = ("calendar_month", "city", "product_line")


@query("md17_premium_by_delta", "calendar_month:i city:s product_line:s premium:d rows:l",
       """SELECT month(f.issued_at) AS calendar_month, h.city, p.product_line, sum(f.annual_premium) AS premium, count(*) AS rows
          FROM fct_written f JOIN dim_policy p ON f.policy_sk = p.policy_sk
          JOIN dim_holder h ON f.policyholder_sk = h.policyholder_sk GROUP BY 1, 2, 3""",
       "fct_written dim_policy dim_holder")
def md17_premium_by_delta(t: Lake):
    """The report kept by three increments: all policies, then twice those that late customer versions re-keyed,
    whose old rows are taken back. The facts are stored once, with their customers; what is re-keyed is kept beside them."""
    first, dim, arrived = repaired_dim(t, attributes=("city",))
    policies = _policies(t, (*_OF_WRITTEN, "product_line"))
    dim_policy_ = models.dim_policy(policies, ("product_line",))
    pieces = feeds.holder_pieces(t)

    def described(rows):
        rows = with_packed(rows, "policy_sk", "policyholder_sk")
        products = with_packed(dim_policy_, "policy_sk").select("policy_sk", "product_line")
        places = with_packed(dim, "policyholder_sk").select("policyholder_sk", "city")
        return rows.join(products, "policy_sk").join(places, "policyholder_sk").select(
            F.month("issued_at").alias("calendar_month"), "city", "product_line", F.col("annual_premium").cast("decimal(12,2)").alias("premium"))

    # both batches ask for the customer
    facts_ = stored(t.spark, models.fct_policies_written(policies, dim_policy_, first, pieces=pieces, keep=["policyholder_id"]))
    report = stored(t.spark, facts.apply_delta(None, facts.report_delta(None, described(facts_), _BY_MONTH, ["premium"]), _BY_MONTH, ["premium"]))
    earlier = None  # facts re-keyed so far; all others are as they were stored
    for windows in arrived:
        found = models.rekeyed_policies_written(facts_, policies, windows, pieces=pieces, replaced="replaced_sk")
        if earlier is not None:  # what a fact was keyed with last
            last = earlier.select("policy_id", F.col("policyholder_sk").alias("last_sk"))
            found = found.join(last, "policy_id", "left").withColumn("replaced_sk", F.coalesce("last_sk", "replaced_sk")).drop("last_sk")
        new = stored(t.spark, found)
        old = new.withColumn("policyholder_sk", F.col("replaced_sk"))
        delta = facts.report_delta(described(old), described(new), _BY_MONTH, ["premium"])
        report = stored(t.spark, facts.apply_delta(report, delta, _BY_MONTH, ["premium"]))
        new = new.drop("replaced_sk")
        earlier = new if earlier is None else merged(earlier, new, ["policy_id"])
    return report


@query("md18_claims_by_status", "current_status:s claims:l avg_days_to_settle:d",
       """SELECT current_status, count(*) AS claims,
          CAST(sum(days_to_settle) AS DOUBLE) / count(days_to_settle) AS avg_days_to_settle
          FROM fct_claims GROUP BY 1""", "fct_claims")
def md18_claims_by_status(t: Lake):
    return reports.claims_by_status(claim_facts(t, narrow_star(t)))


@query("md19_city_then_and_now", "claim_id:s policyholder_sk:s city_then:s city_now:s",
       """SELECT f.claim_id, f.policyholder_sk, a.city AS city_then, b.city AS city_now
          FROM fct_claims f JOIN dim_holder a ON a.policyholder_sk = f.policyholder_sk
          JOIN dim_holder b ON b.policyholder_id = a.policyholder_id AND b.is_current""",
       "fct_claims dim_holder")
def md19_city_then_and_now(t: Lake):
    s = narrow_star(t, more_of_holder=("city", "is_current"))
    return reports.city_then_and_now(claim_facts(t, s), s["dim_holder"])


@query("md20_log_versus_snapshot",
       "policyholder_id:l valid_from:t log_valid_to:t snapshot_valid_to:t status:s",
       f"""SELECT coalesce(l.policyholder_id, s.policyholder_id) AS policyholder_id,
          coalesce(l.valid_from, s.valid_from) AS valid_from, l.valid_to AS log_valid_to,
          s.valid_to AS snapshot_valid_to,
          CASE WHEN s.policyholder_id IS NULL THEN 'only_log'
               WHEN l.policyholder_id IS NULL THEN 'only_snapshot' ELSE 'matched' END AS status
          FROM (SELECT * FROM dim_holder WHERE policyholder_id <> -1) l
          FULL JOIN ({_SNAPSHOT}) s ON s.policyholder_id = l.policyholder_id AND s.valid_from = l.valid_from""",
       "dim_holder slv_holder_versions")
def md20_log_versus_snapshot(t: Lake):
    log = dim_holder(t).filter("policyholder_id <> -1")
    return history.compare_histories(log, _snapshot(t), "policyholder_id")
