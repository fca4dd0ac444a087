"""Keyed upserts, crash recovery, control tables."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.operators import control, selection
from tidemark.operators.upsert import DuplicateKeys, SchemaChanged, merged
from tidemark.sources.tables import ControlStore, KeyedTable, NoPartition, OtherLayout, bucket_of, day_of, last_entry, month_of


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def log(spark, data):
    return spark.createDataFrame(data, "id bigint, at string, v string").select(
        "id", F.col("at").cast("timestamp_ntz").alias("at"), "v")


A = [(1, "2026-01-01", "a"), (2, "2026-01-01", "b")]
B = [(1, "2026-01-02", "a2"), (2, "2026-01-01", "b!"), (3, "2026-01-03", "c")]


def table(spark, tmp_path, keys=("id", "at"), partition=None, newest=()):
    return KeyedTable(spark, str(tmp_path / "t"), keys, day_of("at") if partition is None else partition, newest)


def test_new_matched_mixed_and_empty_batches(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(log(spark, A))
    t.upsert(log(spark, B))
    want = rows(log(spark, [A[0], *B]))
    assert rows(t.read()) == want
    t.upsert(log(spark, B))
    t.upsert(log(spark, []))
    assert rows(t.read()) == want


def test_another_partitioning_is_refused(spark, tmp_path):
    t = table(spark, tmp_path, keys=("id",), partition=bucket_of(["id"], 4), newest=("at",))
    t.upsert(log(spark, A))
    for other in (bucket_of(["id"], 8), day_of("at"), month_of("at")):
        with pytest.raises(OtherLayout):
            table(spark, tmp_path, keys=("id",), partition=other, newest=("at",)).upsert(log(spark, B))
    table(spark, tmp_path, keys=("id",), partition=bucket_of(["id"], 4), newest=("at",)).upsert(log(spark, [B[0]]))
    assert rows(t.read()) == rows(log(spark, [B[0], A[1]]))


def test_null_versions_change_and_block_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(log(spark, A))
    null = log(spark, A).withColumn("at", F.lit(None).cast("timestamp_ntz"))
    for batch in (null, null.unionByName(log(spark, B))):
        with pytest.raises(NoPartition):
            t.upsert(batch)
        assert rows(t.read()) == rows(log(spark, A))
    t.upsert(log(spark, B))
    assert rows(t.read()) == rows(log(spark, [A[0], *B]))


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(log(spark, A + B[2:]))
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    t.upsert(log(spark, [(3, "2026-01-03", "c!")]))
    now = set((tmp_path / "t").rglob("*.parquet"))
    kept = [p for p in files if p in now]
    assert all("2026-01-01" in str(p) for p in kept) and kept


def test_duplicate_keys_and_changed_columns_are_refused(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(log(spark, A))
    with pytest.raises(DuplicateKeys):
        t.upsert(log(spark, [A[0], (1, "2026-01-01", "other")]))
    with pytest.raises(SchemaChanged):
        t.upsert(log(spark, A).withColumn("more", F.lit(1)))
    with pytest.raises(SchemaChanged):
        merged(log(spark, A), log(spark, A).withColumn("v", F.lit(1)), ["id"])
    assert rows(t.read()) == rows(log(spark, A))


def test_arrival_order_does_not_matter_with_an_order_between_versions(spark, tmp_path):
    batches = [[(1, "2026-01-01", "a")], [(1, "2026-01-03", "c"), (2, "2026-01-01", "x")], [(1, "2026-01-02", "b")]]
    results = set()
    for i, order in enumerate(itertools.permutations(batches)):
        current = None
        for batch in order:
            df = log(spark, batch)
            current = df if current is None else merged(current, df, ["id"], ["at"])
        results.add(tuple(rows(current)))
    assert results == {tuple(rows(log(spark, [(1, "2026-01-03", "c"), (2, "2026-01-01", "x")])))}


def test_interrupted_publish_is_finished(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path, keys=("id",), partition=bucket_of(["id"], 2), newest=("at",))
    t.upsert(log(spark, A))

    def crash(self, staged, ident):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_publish", crash)
        with pytest.raises(RuntimeError):
            t.upsert(log(spark, B))
    assert rows(t.read()) == rows(log(spark, A))
    again = table(spark, tmp_path, keys=("id",), partition=bucket_of(["id"], 2), newest=("at",))
    assert again.recover() and not again.recover()
    want = [(1, "2026-01-02", "a2"), (2, "2026-01-01", "b!"), (3, "2026-01-03", "c")]
    assert rows(again.read()) == rows(log(spark, want))
    assert last_entry(spark, again.log).state == "published"


def test_crash_before_the_log_entry_changes_nothing(spark, tmp_path, monkeypatch):
    from tidemark.sources import tables

    t = table(spark, tmp_path)
    t.upsert(log(spark, A))
    with monkeypatch.context() as m:
        m.setattr(tables, "add_entry", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.upsert(log(spark, B))
    assert not t.recover()
    assert rows(t.read()) == rows(log(spark, A))


def test_snapshot_table_rewrites_open_rows_only(spark, tmp_path):
    from tidemark.operators.history import snapshot_merge
    from tidemark.sources.tables import SnapshotTable

    table, plain = SnapshotTable(spark, str(tmp_path / "s"), "id", "at"), None
    states = ([(1, "2026-01-01", "a"), (2, "2026-01-01", "x")], [(1, "2026-01-02", "b"), (2, "2026-01-01", "x")],
              [(1, "2026-01-03", "c"), (3, "2026-01-03", "n")])
    assert table.read() is None
    for state in states:
        table.merge(log(spark, state))
        plain = snapshot_merge(plain, log(spark, state), "id", "at")
        assert rows(table.read().select(plain.columns)) == rows(plain)
    closed = spark.read.parquet(str(tmp_path / "s")).filter("not is_open").groupBy("step").count().collect()
    assert sorted(r["count"] for r in closed) == [1, 1]


# ------------------------------------------------------------ incremental selection


def test_lookback_boundaries(spark):
    source = log(spark, [(1, "2026-01-01 06:59:59", ""), (2, "2026-01-01 07:00:00", ""), (3, "2026-01-01 07:00:01", "")])
    target = log(spark, [(9, "2026-01-01 10:00:00", "")])
    assert [r.id for r in selection.incremental(source, target, "at").collect()] == [3]
    assert selection.incremental(source, None, "at").count() == 3
    assert selection.incremental(source, log(spark, []), "at").count() == 3


def test_change_window_is_open_below_and_closed_above(spark):
    df = log(spark, [(i, f"2026-01-0{i}", "") for i in (1, 2, 3, 4)])
    got = selection.changes_between(df, "at", "2026-01-01", dt.datetime(2026, 1, 3)).collect()
    assert sorted(r.id for r in got) == [2, 3]


def test_pages_by_offset_and_by_last_row_cover_the_feed(spark):
    df = log(spark, [(i, f"2026-01-{1 + i // 4:02d}", str(i)) for i in range(23)])
    by_offset, offset = [], 0
    while True:
        page = selection.feed_page(df, "at", "id", 5, offset).collect()
        by_offset += [r.id for r in page]
        offset += 5
        if not page or not page[0].has_more:
            break
    by_key, after = [], None
    while True:
        page = selection.feed_page(df, "at", "id", 5, after=after).collect()
        by_key += [r.id for r in page]
        if not page[0].has_more:
            break
        after = (page[-1].at, page[-1].id)
    assert by_offset == by_key == list(range(23))


# ------------------------------------------------------------ control tables


def marks(spark, entries):
    data = [("api", e, dt.datetime.fromisoformat(w), "old", dt.datetime(2026, 1, 1)) for e, w in entries.items()]
    return spark.createDataFrame(data, control.WATERMARKS)


def loaded(spark, entries):
    data = [("api", e, w and dt.datetime.fromisoformat(w), "new") for e, w in entries.items()]
    return spark.createDataFrame(
        data, "source_name string, entity string, max_changed_at timestamp_ntz, run_id string")


def test_watermarks_only_move_forward(spark):
    before = marks(spark, {"none": "2026-01-05", "older": "2026-01-05", "newer": "2026-01-05", "absent": "2026-01-05"})
    after = control.advance_watermarks(before, loaded(
        spark, {"none": None, "older": "2026-01-01", "newer": "2026-01-09", "unknown": "2026-01-09"}))
    got = {r.entity: (r.high_watermark.day, r.last_run_id, r.updated_at.year == 2026 and r.updated_at.month == 1)
           for r in after.collect()}
    assert got["none"] == (5, "old", True) and got["absent"] == (5, "old", True)
    assert got["older"][:2] == (5, "new") and got["newer"][:2] == (9, "new")
    assert "unknown" not in got


def test_seed_never_resets(spark):
    live = marks(spark, {"claims": "2026-01-05"})
    wanted = spark.createDataFrame([("api", "claims"), ("api", "policies")], "source_name string, entity string")
    got = {r.entity: (r.high_watermark.year, r.last_run_id) for r in control.seed_watermarks(live, wanted).collect()}
    assert got == {"claims": (2026, "old"), "policies": (1970, "seed")}


def test_audit_rules(spark):
    empty = spark.createDataFrame([], control.EXTRACT_RUNS)
    day = dt.date(2026, 1, 1)
    failure = spark.createDataFrame(
        [("r1", "api", "claims", day, "x" * 5000)],
        "run_id string, source_name string, entity string, business_date date, error_message string")
    success = spark.createDataFrame(
        [("r1", "api", "claims", day, dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2), 5, 5, dt.datetime(2026, 1, 1))],
        "run_id string, source_name string, entity string, business_date date, window_start timestamp_ntz, "
        "window_end timestamp_ntz, row_count_manifest bigint, row_count_loaded bigint, max_updated_at timestamp_ntz")
    failed = control.record_failure(empty, failure)
    row = failed.first()
    assert (row.status, len(row.error_message), row.finished_at is not None) == ("FAILED", 4000, True)
    done = control.record_success(failed, success)
    row = done.first()
    assert (row.status, row.error_message, row.row_count_loaded) == ("SUCCEEDED", None, 5)
    kept = control.record_failure(done, failure)
    assert (kept.first().status, kept.count()) == ("SUCCEEDED", 1)
    assert done.schema == empty.schema or [f.dataType for f in done.schema] == [f.dataType for f in empty.schema]


def test_control_tables_commit_together_or_not_at_all(spark, tmp_path):
    store = ControlStore(spark, str(tmp_path / "control"))
    store.commit({"watermarks": marks(spark, {"claims": "2026-01-01"})})
    broken = marks(spark, {"claims": "2026-02-02"}).withColumn(
        "last_run_id", F.raise_error(F.lit("lost executor")).cast("string"))
    with pytest.raises(Exception, match="lost executor"):
        store.commit({"extract_runs": marks(spark, {"claims": "2026-02-02"}), "watermarks": broken})
    now = store.read("watermarks", control.WATERMARKS).first()
    assert now.high_watermark == dt.datetime(2026, 1, 1)


def test_run_plan(spark):
    runs = spark.createDataFrame(
        [("manual__2026-09-30T00:00:00+00:00", dt.datetime(2026, 9, 30, 0, 0, 0, 5))], "run_id string, run_after timestamp_ntz")
    row = selection.plan_request(runs).first()
    assert row.run_id == "manual__2026-09-30T00_00_00_00_00" and row.is_safe
    assert (row.business_date, row.window_end) == (dt.date(2026, 9, 29), dt.datetime(2026, 9, 30))
