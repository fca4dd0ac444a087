"""Whole runs on a small feed: catch-up, idempotence, failures, dumps."""

import datetime as dt

import fixtures
import pytest
from pyspark.sql import functions as F

from tidemark.operators import control
from tidemark.operators.quality import GateFailed
from tidemark.operators.selection import MissingWatermark
from tidemark.plans import models, runs
from tidemark.sources import landing, tables
from tidemark.sources.landing import ManifestMissing


def plan(day, ident):
    return runs.Plan(ident, dt.datetime.fromisoformat(day), source_name="api", buckets=2)


def marks(spark, paths):
    rows = runs.store(spark, paths).read("watermarks", control.WATERMARKS).collect()
    return {r.entity: r.high_watermark.isoformat() for r in rows}


def statuses(spark, paths):
    rows = runs.store(spark, paths).read("extract_runs", control.EXTRACT_RUNS).collect()
    return {(r.run_id, r.entity): r.status for r in rows}


def gold(spark, paths, name):
    df = spark.read.parquet(paths.table(name))
    return df.drop(tables.PART) if tables.PART in df.columns else df


def content(df, *columns):
    return sorted(tuple(str(v) for v in r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """Two daily runs."""
    root = tmp_path_factory.mktemp("runs")
    paths = runs.Paths(str(root / "lake"), str(root / "wh"))
    runs.seed(spark, paths, "api")
    runs.seed(spark, paths, "api")
    feeds = fixtures.feeds(spark)
    first = runs.run_feed(spark, feeds, plan("2026-09-30T00:00:00", "day-1"), paths)
    after_first = marks(spark, paths)
    second = runs.run_feed(spark, feeds, plan("2026-10-01T00:00:00", "day-2"), paths)
    return paths, first, after_first, second


def test_first_run_catches_up_and_moves_the_watermarks(spark, history):
    paths, first, after_first, _ = history
    assert {r.entity: r.loaded_rows for r in first.reconciled} == {
        "policyholders": 5, "policies": 3, "claims": 4}
    assert after_first == {"policyholders": "2026-09-29T09:00:00", "policies": "2026-09-29T10:30:00",
                           "claims": "2026-09-29T15:00:00"}


def test_second_run_pulls_from_the_watermark_minus_buffer(spark, history):
    paths, _, _, second = history
    loaded = {r.entity: r.loaded_rows for r in second.reconciled}
    assert loaded == {"policyholders": 2, "policies": 3, "claims": 3}  # includes repeated rows
    assert marks(spark, paths) == {"policyholders": "2026-09-30T09:00:00",
                                   "policies": "2026-09-30T10:00:00", "claims": "2026-09-30T15:00:00"}
    assert set(statuses(spark, paths).values()) == {"SUCCEEDED"}
    assert len(statuses(spark, paths)) == 6
    log = spark.read.parquet(paths.table("slv_policyholder_versions"))
    assert log.count() == len(fixtures.HOLDERS)


def test_gold_tables(spark, history):
    paths = history[0]
    dim = gold(spark, paths, "dim_policyholder")
    assert content(dim.filter("policyholder_id = 1"), "valid_from", "valid_to", "city") == [
        ("2026-09-01 00:00:00", "2026-09-28 09:00:00", "Pune"),
        ("2026-09-28 09:00:00", "2026-09-30 09:00:00", "Delhi"),
        ("2026-09-30 09:00:00", "9999-12-31 00:00:00", "Mumbai"),
    ]
    snap = gold(spark, paths, "dim_policyholder_snap")
    # the first run saw only the latest of what it caught up with
    assert content(snap.filter("policyholder_id = 1"), "city") == [("Delhi",), ("Mumbai",)]
    written = gold(spark, paths, "fct_policies_written").join(dim, "policyholder_sk")
    assert content(written, "policy_id", "city", "annual_premium") == [
        ("POL-20260910-001", "Pune", "100.25"), ("POL-20260929-001", "Delhi", "200.50"),
        ("POL-20260929-002", "Unknown", "300.00"), ("POL-20260930-001", "Chennai", "50.75"),
    ]
    facts = gold(spark, paths, "fct_claims")
    assert content(facts, "claim_id", "current_status", "claim_amount", "approved_date_key",
                   "paid_date_key", "days_to_settle") == [
        ("CLM-1", "PAID", "12.50", "20260923", "20260929", "9"),
        ("CLM-2", "PAID", "20.00", "None", "20260930", "1"),
        ("CLM-3", "OPEN", "5.00", "None", "None", "None"),
    ]
    places = facts.join(dim, "policyholder_sk")
    assert content(places, "claim_id", "city") == [("CLM-1", "Pune"), ("CLM-2", "Delhi"), ("CLM-3", "Unknown")]


def test_paid_without_approval_only_warns(history):
    assert [(w.name, w.failures) for w in history[3].warnings] == [
        ("fct_claims paid only after approval", 1)]


def test_earlier_attempt_of_the_same_run_is_not_counted(spark, history):
    """A run repeated as a whole lands a second attempt; counts and tables stay right."""
    paths = history[0]
    before = content(gold(spark, paths, "fct_claims"), "claim_id", "current_status")
    again = runs.run_feed(spark, fixtures.feeds(spark), plan("2026-10-01T00:00:00", "day-2"), paths)
    assert all(r.status == "DONE" for r in again.reconciled)
    landed = spark.read.parquet(paths.landing("claims")).filter("run_id = 'day-2'")
    assert landed.select(F.regexp_extract("source_file", "attempt=([^/]+)", 1)).distinct().count() == 2
    assert content(gold(spark, paths, "fct_claims"), "claim_id", "current_status") == before


def test_customer_version_that_arrives_late_reaches_stored_claims(spark, tmp_path):
    paths = fresh(spark, tmp_path)
    feeds = fixtures.feeds(spark)
    runs.run_feed(spark, feeds, plan("2026-09-30T00:00:00", "day-1"), paths)
    # CLM-1's customer moved before the loss, which the source tells with the next day's changes only
    late = fixtures.holders(spark, [(1, "Goa", "LOW", "2026-09-11T00:00:00")])
    feeds["policyholders"] = feeds["policyholders"].unionByName(late)
    p = plan("2026-10-01T00:00:00", "day-2")
    p.buffer = "INTERVAL 30 DAYS"
    runs.run_feed(spark, feeds, p, paths)
    dim = gold(spark, paths, "dim_policyholder")
    got = dict(content(gold(spark, paths, "fct_claims").join(dim, "policyholder_sk"), "claim_id", "city"))
    assert got["CLM-1"] == "Goa"
    full = models.fct_claims(*(gold(spark, paths, n) for n in ("slv_claim_events", "slv_policies", "dim_policy", "dim_policyholder")))
    columns = ("claim_id", "policyholder_sk", "current_status")
    assert content(gold(spark, paths, "fct_claims"), *columns) == content(full, *columns)


def fresh(spark, tmp_path):
    paths = runs.Paths(str(tmp_path / "lake"), str(tmp_path / "wh"))
    runs.seed(spark, paths, "api")
    return paths


def test_failed_gate_leaves_watermarks_and_records_the_failure(spark, tmp_path):
    paths = fresh(spark, tmp_path)
    feeds = fixtures.feeds(spark)
    feeds["policyholders"] = fixtures.holders(spark, [(1, "Pune", "ODD", "2026-09-29T00:00:00")])
    with pytest.raises(GateFailed, match="risk_tier accepted"):
        runs.run_feed(spark, feeds, plan("2026-09-30T00:00:00", "bad"), paths)
    assert set(marks(spark, paths).values()) == {"1970-01-01T00:00:00"}
    assert statuses(spark, paths) == {("bad", e): "FAILED" for e in ("policyholders", "policies", "claims")}


def test_stale_source_stops_the_run(spark, tmp_path):
    paths = fresh(spark, tmp_path)
    with pytest.raises(runs.StaleSource):
        runs.run_feed(spark, fixtures.feeds(spark), plan("2026-10-10T00:00:00", "late"), paths)
    assert set(marks(spark, paths).values()) == {"1970-01-01T00:00:00"}


def test_missing_rows_stop_reconcile_and_advance(spark, tmp_path):
    paths = fresh(spark, tmp_path)
    p = plan("2026-09-30T00:00:00", "short")
    runs.extract(spark, fixtures.feeds(spark), p, paths)
    manifest = landing.read_manifest(spark, landing.manifest_path(paths.lake, "2026-09-29", "short"))
    runs.load(spark, paths)
    inflated = manifest.withColumn("row_count", F.col("row_count") + 1).withColumn("rows", F.col("rows") + 1)
    with pytest.raises(runs.NotLoaded):
        runs.reconcile(spark, paths, inflated)
    with pytest.raises(runs.NotLoaded):
        runs.advance(spark, p, paths, inflated)
    assert set(marks(spark, paths).values()) == {"1970-01-01T00:00:00"}
    runs.reconcile(spark, paths, manifest)


def test_run_needs_watermarks_a_safe_id_and_a_manifest(spark, tmp_path):
    paths = runs.Paths(str(tmp_path / "lake"), str(tmp_path / "wh"))
    with pytest.raises(MissingWatermark):
        runs.extract(spark, fixtures.feeds(spark), plan("2026-09-30T00:00:00", "x"), paths)
    with pytest.raises(ValueError, match="path-safe"):
        runs.check_plan(spark, plan("2026-09-30T00:00:00", "manual__2026-09-30T00:00:00+00:00"))
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(ManifestMissing):
        landing.read_manifest(spark, str(empty))


def test_daily_dumps_build_history_in_order(spark, tmp_path):
    paths = runs.Paths(str(tmp_path / "lake"), str(tmp_path / "wh"))
    days = {
        "2026-09-28": [(1, "Pune", "LOW", "2026-09-01T00:00:00"), (2, "Delhi", "LOW", "2026-09-01T00:00:00")],
        "2026-09-29": [(1, "Delhi", "LOW", "2026-09-29T09:00:00"), (2, "Delhi", "LOW", "2026-09-01T00:00:00")],
        "2026-09-30": [(1, "Mumbai", "LOW", "2026-09-30T09:00:00")],
    }
    from tidemark.sources.landing import ISO_MICROS

    def wire(df):
        return df.select(*[F.date_format(f.name, ISO_MICROS).alias(f.name)
                           if f.dataType.typeName() == "timestamp_ntz" else f.name for f in df.schema.fields])

    for day, rows in days.items():
        dumps = {"policyholders": wire(fixtures.holders(spark, rows)),
                 "policies": wire(fixtures.policies(spark)), "claims": wire(fixtures.claims(spark))}
        report = runs.run_dumps(spark, dumps, dt.date.fromisoformat(day), paths)
        assert {r.status for r in report.reconciled} == {"DONE"}
    history = runs.snapshot_table(spark, paths, "snap_policyholders").read()
    got = content(history, "policyholder_id", "city", "valid_to")
    assert got == [
        ("1", "Delhi", "2026-09-30 09:00:00"), ("1", "Mumbai", "9999-12-31 00:00:00"),
        ("1", "Pune", "2026-09-29 09:00:00"), ("2", "Delhi", "9999-12-31 00:00:00"),
    ]
