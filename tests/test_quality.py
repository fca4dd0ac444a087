"""Every data test finds a planted violation and passes clean data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import date_key, to_naive_utc
from tidemark.operators import facts, quality as q
from tidemark.operators.calendar import dim_date
from tidemark.plans import checks
from tidemark.spec import contract, contracts


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_unique_ignores_nulls_only_for_one_column(spark):
    df = frame(spark, "a int, b int", (1, 1), (1, 2), (None, 3), (None, 3))
    assert rows(q.unique(df, "a")) == [(1, 2)]
    assert rows(q.unique(df, ["a", "b"])) == [(None, 3, 2)]


def test_accepted_values_and_not_null(spark):
    df = frame(spark, "a string", ("x",), ("y",), ("y",), (None,))
    assert rows(q.accepted_values(df, "a", ["x"])) == [("y", 2)]
    assert q.not_null(df, "a").count() == 1


def test_relationships_ignore_null_keys(spark):
    child = frame(spark, "k int", (1,), (2,), (2,), (None,))
    parent = frame(spark, "id int", (1,), (None,))
    assert rows(q.relationships(child, "k", parent, "id")) == [(2, 2)]
    assert rows(q.orphans(child, "k", parent, "id")) == [(2,), (2,)]


def dim(spark, *windows):
    df = frame(spark, "k int, f string, t string, is_current boolean", *windows)
    return df.select("k", F.col("f").cast("timestamp_ntz").alias("valid_from"),
                     F.col("t").cast("timestamp_ntz").alias("valid_to"), "is_current")


def test_window_chain(spark):
    d = dim(spark, (1, "2026-01-01", "2026-01-02", False), (1, "2026-01-02", "9999-12-31", True),
            (2, "2026-01-01", "2026-01-02", False), (2, "2026-01-03", "9999-12-31", True),
            (3, "2026-01-01", "2026-01-05", False), (3, "2026-01-03", "9999-12-31", True),
            (4, "2026-01-02", "2026-01-02", True), (5, "2026-01-01", "2026-01-02", False))
    assert sorted(r.dim_key for r in q.scd2_contiguous(d, "k").collect()) == [2, 3, 4]
    assert rows(q.scd2_one_current(d, "k")) == [(5, 0)]


def test_totals(spark):
    a = frame(spark, "v double", (1.0,), (2.0,))
    b = frame(spark, "v double", (1.0,), (1.0,))
    empty = a.limit(0)
    m = {"n": F.count(F.lit(1)), "v": F.sum("v")}
    assert q.reconcile_totals(a, a, m).isEmpty()
    assert q.reconcile_totals(a, b, m).count() == 1
    only_sum = {"v": F.sum("v")}
    assert q.reconcile_totals(a, empty, only_sum).isEmpty()  # NULL totals pass
    assert q.reconcile_totals(a, empty, only_sum, null_safe=True).count() == 1


def test_gate_blocks_on_errors_and_reports_warnings(spark):
    df = frame(spark, "a int", (1,), (None,))
    warn = q.Check("w", q.WARN, table=df, predicate=F.col("a").isNull())
    fine = q.Check("f", table=df, predicate=F.col("a") > 5)
    error = q.Check("e", failing=q.not_null(df, "a"))
    assert {r.name: r.status for r in q.gate([warn, fine])} == {"w": "warn", "f": "pass"}
    with pytest.raises(q.GateFailed, match="'e': 1") as e:
        q.gate([warn, fine, error])
    assert len(e.value.results) == 3
    assert q.gate([]) == []


@pytest.mark.parametrize("age, status", [(26, "PASS"), (26.01, "WARN"), (48, "WARN"), (48.01, "ERROR")])
def test_freshness_boundaries(spark, age, status):
    now = dt.datetime(2026, 1, 10)
    df = frame(spark, "ts timestamp_ntz", (now - dt.timedelta(hours=age),))
    assert q.freshness(df, "ts", now).first().status == status


def test_empty_source_is_stale(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz")
    assert q.freshness(df, "ts", dt.datetime(2026, 1, 1)).first().status == "ERROR"


class TestContract:
    @pytest.fixture
    def agreed(self, spark):
        return contract(k="bigint!", v="string")

    def test_reorders(self, spark, agreed):
        df = frame(spark, "v string, k bigint", ("a", 1))
        assert q.enforce_contract(df, agreed).columns == ["k", "v"]

    @pytest.mark.parametrize("schema, row", [
        ("k bigint", (1,)), ("k bigint, v string, more int", (1, "a", 1)), ("k int, v string", (1, "a"))])
    def test_refuses_other_columns_and_types(self, spark, agreed, schema, row):
        with pytest.raises(q.ContractBroken):
            q.enforce_contract(frame(spark, schema, row), agreed)

    def test_null_in_a_key_fails_the_job(self, spark, agreed):
        df = frame(spark, "k bigint, v string", (1, "a"), (None, "b"))
        with pytest.raises(Exception, match="k must not be null"):
            q.enforce_contract(df, agreed).collect()


def test_calendar_meets_its_contract(spark):
    days = q.enforce_contract(dim_date(spark), contracts()["dim_date"])
    got = days.orderBy("date_key").collect()
    assert (len(got), got[0].date_key, got[-1].date_key) == (1096, 20260101, 20281231)
    day = next(r for r in got if r.date_key == 20260930)
    assert tuple(day)[2:10] == (2026, 3, 9, "Sep", 30, 3, "Wed", False)
    assert day.month_start_date == dt.date(2026, 9, 1)


def test_milestone_rules(spark):
    schema = ("claim_id string, loss_date_key int, reported_date_key int, approved_date_key int, "
              "rejected_date_key int, paid_date_key int")
    df = frame(spark, schema, ("fine", 1, 2, 3, None, 4), ("loss after report", 3, 2, None, None, None),
               ("both", 1, 2, 3, 3, None), ("early payment", 1, 3, None, None, 2), ("open", 1, 2, None, None, None))
    assert sorted(r.claim_id for r in q.rule(df, checks.milestones_out_of_order()).collect()) == [
        "both", "early payment", "loss after report"]
    assert [r.claim_id for r in q.rule(df, checks.paid_without_approval()).collect()] == ["early payment"]


def test_suite_sizes(spark):
    """41 tests for the feed's tables and 9 for staging."""
    import fixtures

    from tidemark.plans import models

    silver = {
        "slv_policyholder_versions": fixtures.holders(spark), "slv_policyholders": fixtures.holders(spark),
        "slv_policies": fixtures.policies(spark).withColumnRenamed("status", "policy_status"),
        "slv_claim_events": fixtures.claims(spark).withColumnRenamed("status", "claim_status"),
    }
    holder = models.dim_policyholder(silver["slv_policyholder_versions"], pieces=None)
    policy = models.dim_policy(silver["slv_policies"])
    gold = {
        "dim_date": dim_date(spark), "dim_policyholder": holder, "dim_policyholder_snap": holder,
        "dim_policy": policy,
        "fct_policies_written": models.fct_policies_written(silver["slv_policies"], policy, holder, pieces=None),
        "fct_claims": models.fct_claims(
            silver["slv_claim_events"].withColumn("loaded_at", F.current_timestamp()).withColumn("source_file", F.lit("f")),
            silver["slv_policies"], policy, holder, pieces=None),
    }
    assert len(checks.silver_checks(silver)) + len(checks.gold_checks({**silver, **gold})) == 41
    staging = {"stg_policies": silver["slv_policies"], "stg_claims": silver["slv_claim_events"],
               "stg_policyholders": silver["slv_policyholders"]}
    assert len(checks.staging_checks(staging)) == 9


def test_accumulate_takes_values_of_the_newest_event(spark):
    df = frame(spark, "k int, ts int, s string, v int", (1, 1, "OPEN", 5), (1, 3, "PAID", None), (1, 2, "PAID", 7))
    got = facts.accumulate(df, "k", "ts", "s", {"paid": "PAID", "rejected": "REJECTED"}, latest={"v": "v", "now": "s"})
    assert rows(got) == [(1, None, "PAID", 2, None, 3)]


def test_small_expressions(spark):
    row = spark.range(1).select(
        date_key(F.lit(None).cast("date")).alias("none"), date_key(F.lit("2026-09-30 23:59:59").cast("timestamp_ntz")).alias("key"),
        to_naive_utc(F.lit("2026-09-30T01:00:00+02:00")).alias("utc"), to_naive_utc(F.lit("2026-09-30T01:00:00")).alias("same"),
    ).first()
    assert (row.none, row.key) == (None, 20260930)
    assert (row.utc, row.same) == (dt.datetime(2026, 9, 29, 23), dt.datetime(2026, 9, 30, 1))


def test_role_playing_keeps_every_fact(spark):
    fact = frame(spark, "id int, a int, b int", (1, 20260101, None), (2, 20270101, 20260101))
    out = facts.role_play(fact, dim_date(spark), {"first": "a", "second": "b"}, ["calendar_year"])
    assert rows(out.select("id", "first_calendar_year", "second_calendar_year")) == [(1, 2026, None), (2, 2027, 2026)]


def test_content_sums_find_what_counts_accept(spark):
    rows = [("f1", 1, "a"), ("f1", 2, "b"), ("f2", 3, None), ("f2", 3, None), ("f3", 4, ""), ("f5", 6, "x")]
    announced = spark.createDataFrame(rows, "file string, id int, v string")
    swapped = [("f1", 2, "a"), ("f1", 1, "b"), ("f2", 3, None), ("f2", 3, None), ("f3", 4, None), ("f4", 5, "y")]
    loaded = spark.createDataFrame(swapped[::-1], "file string, id int, v string").repartition(3)
    sums = [q.content_sums(df, ["file"], ["id", "v"]) for df in (announced, loaded)]
    got = {r.file: r.status for r in q.reconcile_content(*sums, ["file"]).collect()}
    assert got == {"f1": "CHANGED", "f2": "DONE", "f3": "CHANGED", "f4": "TOO_MANY", "f5": "NOT_YET"}
    again = q.content_sums(announced.repartition(4).orderBy("v"), ["file"], ["id", "v"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, sums[0].collect()))
