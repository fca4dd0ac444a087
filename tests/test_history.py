"""Version log, validity windows, snapshots and lookups by point in time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history, skew
from tidemark.operators.upsert import merged
from tidemark.operators.versions import latest_per
from tidemark.plans import models

CUSTOMER = [
    ("2026-09-01 00:00:00", "Chennai", "LOW", "0c9f505a3d2ce4e5fdeec0d9fdead1d3"),
    ("2026-09-08 09:00:00", "Bengaluru", "LOW", "375f997db2511f3dea15601d7b1d3e1e"),
    ("2026-09-14 09:00:00", "Pune", "LOW", "ed63c8099560dd3ae963723fd110836b"),
    ("2026-09-24 09:00:00", "Pune", "HIGH", "6ab737ca710ef408108443e7ce5b6e78"),
    ("2026-09-29 09:00:00", "Pune", "MEDIUM", "668b226ce65dffb430a4d1997719cb54"),
    ("2026-09-30 09:00:00", "Pune", "LOW", "b548f6f2ff1b6223f6bd68bd4a1d4865"),
]


def versions(spark, rows):
    """(id, updated_at, city) rows as a version log."""
    return spark.createDataFrame(rows, "id bigint, at string, city string").select(
        "id", F.col("at").cast("timestamp_ntz").alias("updated_at"), "city"
    )


def ts(text):
    return dt.datetime.fromisoformat(text)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_published_customer_history(spark):
    log = spark.createDataFrame(
        [(100, at, city, risk) for at, city, risk, _ in CUSTOMER],
        "policyholder_id bigint, at string, city string, risk_tier string",
    ).select(
        "policyholder_id", F.lit("a").alias("first_name"), F.lit("b").alias("last_name"),
        F.lit("1980-01-01").cast("date").alias("date_of_birth"), "city", F.lit("MH").alias("state"),
        "risk_tier", F.col("at").cast("timestamp_ntz").alias("updated_at"),
    )
    dim = models.dim_policyholder(log)
    got = rows(dim.filter("policyholder_id = 100"), "valid_from", "valid_to", "city", "policyholder_sk")
    starts = [ts(c[0]) for c in CUSTOMER] + [dt.datetime(9999, 12, 31)]
    assert got == [(starts[i], starts[i + 1], c[1], c[3]) for i, c in enumerate(CUSTOMER)]
    assert dim.filter("is_current").count() == 2  # the customer and the unknown member
    unknown = dim.filter("policyholder_sk = '-1'").first()
    assert (unknown.policyholder_id, unknown.date_of_birth) == (-1, None)
    assert unknown.valid_from == dt.datetime(1900, 1, 1)


def test_windows_do_not_depend_on_arrival_order(spark):
    data = [(1, "2026-01-03", "c"), (1, "2026-01-01", "a"), (2, "2026-01-01", "x"),
            (1, "2026-01-02", "b")]
    a = history.scd2_windows(versions(spark, data), "id", "updated_at")
    b = history.scd2_windows(versions(spark, data[::-1]), "id", "updated_at")
    assert rows(a, *a.columns) == rows(b, *b.columns)


def test_two_versions_in_one_second_need_finer_keys(spark):
    log = versions(spark, [(1, "2026-01-01 00:00:00.1", "a"), (1, "2026-01-01 00:00:00.2", "b")])
    coarse = history.scd2_windows(log, "id", "updated_at")
    fine = history.scd2_windows(log, "id", "updated_at", sk_format="yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert coarse.select("version_sk").distinct().count() == 1
    assert fine.select("version_sk").distinct().count() == 2


@pytest.fixture(scope="module")
def hot_log(spark):
    """One key with a third of all rows, among small ones."""
    small = spark.range(600).select((F.col("id") % 100).alias("id"), (F.col("id") * 977).alias("s"))
    hot = spark.range(300).select(F.lit(1000).cast("bigint").alias("id"), (F.col("id") * 61).alias("s"))
    null = spark.range(50).select(F.lit(None).cast("bigint").alias("id"), (F.col("id") * 7).alias("s"))
    start = F.lit("2026-01-01").cast("timestamp_ntz")
    log = small.union(hot).union(null).select(
        "id", (start + F.make_dt_interval(secs=F.col("s"))).alias("updated_at"),
        F.concat(F.lit("c"), "s").alias("city"),
    )
    return log.distinct()


def plain_windows(log):
    from pyspark.sql import Window

    w = Window.partitionBy("id").orderBy("updated_at")
    return log.withColumn("next", F.lead("updated_at").over(w))


@pytest.mark.parametrize("pieces", [2, 7, 64])
def test_lead_in_pieces_equals_plain_lead(spark, hot_log, pieces):
    cut = skew.find_pieces(hot_log, "id", "updated_at", min_rows=40, pieces=pieces)
    assert cut.cuts.count() == 2
    got = skew.lead_within(hot_log, "id", "updated_at", "next", cut)
    want = plain_windows(hot_log)
    assert got.exceptAll(want.select(got.columns)).isEmpty()
    assert want.count() == got.count()
    sizes = skew.with_piece(hot_log, "id", cut, "updated_at").filter("id = 1000").groupBy(skew.PIECE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * 300 / min(pieces, 64) + 2


def test_gaps_between_windows_match_nothing(spark):
    dim = versions(spark, [(1, "2026-01-01", "a"), (1, "2026-01-05", "b"), (1, "2026-01-09", "c")]).select(
        "id", "city", F.col("updated_at").alias("valid_from"),
        (F.col("updated_at") + F.expr("INTERVAL 2 DAYS")).alias("valid_to"))
    fact = versions(spark, [(1, f"2026-01-{d:02d}", str(d)) for d in range(1, 13)]).select(
        "id", F.col("updated_at").alias("at"))
    cut = skew.find_pieces(dim, "id", "valid_from", min_rows=1, pieces=3)
    results = [rows(history.point_in_time(fact, dim, "id", "at", ["city"], pieces=p).na.fill("-"), "at", "city")
               for p in (None, cut)]
    assert results[0] == results[1]
    assert [c for _, c in results[0]] == ["a", "a", "-", "-", "b", "b", "-", "-", "c", "c", "-", "-"]


def test_point_in_time_in_pieces_equals_plain_join(spark, hot_log):
    log = hot_log.filter("id is not null")
    dim = history.scd2_windows(log, "id", "updated_at")
    fact = log.select(
        "id", F.explode(F.array(*[
            F.col("updated_at") + F.make_dt_interval(secs=F.lit(s)) for s in (-1, 0, 1, 30, 5000)
        ])).alias("at"),
    ).union(spark.sql("select 77777L, timestamp_ntz'2026-01-02'")).union(
        spark.sql("select null, timestamp_ntz'2026-01-02'")
    ).union(spark.sql("select 1000L, timestamp_ntz'1999-01-01'"))
    cut = skew.find_pieces(log, "id", "updated_at", min_rows=40, pieces=16)
    plain = history.point_in_time(fact, dim, "id", "at", ["version_sk", "city"])
    split = history.point_in_time(fact, dim, "id", "at", ["version_sk", "city"], pieces=cut)
    assert plain.count() == fact.count() == split.count()
    assert plain.exceptAll(split).isEmpty()
    assert plain.filter("version_sk is null and id = 1000").count() > 0
    inner = [history.point_in_time(fact, dim, "id", "at", ["city"], how="inner", pieces=p) for p in (None, cut)]
    assert inner[0].count() == inner[1].count() < fact.count()
    assert inner[0].exceptAll(inner[1]).isEmpty()


def test_overlapping_windows_fan_out_whatever_the_size(spark):
    spans = [(1, 1, 9, "a"), (1, 2, 4, "b"), (1, 2, 6, "c"), (1, 5, 5, "empty"), (1, 7, 3, "reversed"), (1, 8, 20, "d"),
             (2, 1, 3, "e"), (2, 1, 3, "e"), (None, 1, 9, "n")]
    dim = spark.createDataFrame(spans, "id long, a int, b int, city string").selectExpr(
        "id", "city", "timestamp_ntz'2026-01-01' + make_dt_interval(a) AS valid_from",
        "timestamp_ntz'2026-01-01' + make_dt_interval(b) AS valid_to")
    fact = spark.range(0, 44).selectExpr(
        "CASE WHEN id < 22 THEN 1L WHEN id < 40 THEN 2L END AS id", "timestamp_ntz'2026-01-01' + make_dt_interval(CAST(id % 22 AS INT)) AS at")
    for how in ("left", "inner"):
        plain = history.point_in_time(fact, dim, "id", "at", ["city"], how=how, pieces=None)
        for pieces in (1, 3, 16):
            cut = skew.find_pieces(dim, "id", "valid_from", min_rows=2, pieces=pieces)
            split = history.point_in_time(fact, dim, "id", "at", ["city"], how=how, pieces=cut)
            assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_many_facts_of_one_key_at_one_time(spark):
    dim = versions(spark, [(1, f"2026-01-{d:02d}", str(d)) for d in range(1, 29)])
    dim = history.scd2_windows(dim, "id", "updated_at")
    fact = spark.range(3000).selectExpr(
        "id % 3 AS id", "CASE WHEN id % 3 = 1 THEN timestamp_ntz'2026-01-07 12:00:00' ELSE timestamp_ntz'2026-01-09' END AS at")
    cut = skew.find_pieces(dim, "id", "valid_from", min_rows=5, pieces=8)
    found = history.point_in_time(fact, dim, "id", "at", ["city"], pieces=cut).groupBy("id", "city").count()
    assert sorted(map(tuple, found.na.fill("-").collect())) == [(0, "-", 1000), (1, "7", 1000), (2, "-", 1000)]


def test_snapshot_of_a_null_key_stays_one_row(spark):
    state = versions(spark, [(None, "2026-01-01", "a"), (1, "2026-01-01", "b")])
    once = history.snapshot_merge(None, state, "id", "updated_at")
    assert history.snapshot_merge(once, state, "id", "updated_at").count() == 2


def test_point_in_time_edges(spark):
    dim = history.scd2_windows(
        versions(spark, [(1, "2026-01-10", "a"), (1, "2026-01-20", "b")]), "id", "updated_at"
    )
    facts = versions(spark, [(1, "2026-01-09 23:59:59", "before"), (1, "2026-01-10", "on start"),
                             (1, "2026-01-20", "on end"), (1, "2027-01-01", "after"),
                             (2, "2026-01-15", "no key"), (None, "2026-01-15", "null key")])
    facts = facts.select("id", F.col("updated_at").alias("at"), F.col("city").alias("case"))
    out = history.point_in_time(facts, dim, "id", "at", ["city"])
    assert dict(rows(out.na.fill("-"), "case", "city")) == {
        "before": "-", "on start": "a", "on end": "b", "after": "b", "no key": "-", "null key": "-",
    }


def test_hot_copies_shrink_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = latest_per(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once before the exchange, once after
    assert rows(latest_per(df, ["k"], ["id"]), "id") == [(998,), (999,)]


class TestSnapshot:
    def merge(self, spark, old, data):
        out = history.snapshot_merge(old, versions(spark, data), "id", "updated_at")
        return spark.createDataFrame(out.collect(), out.schema)

    def test_rules(self, spark):
        first = self.merge(spark, None, [(1, "2026-01-01", "a"), (2, "2026-01-01", "x"),
                                         (3, "2026-01-05", "p"), (4, "2026-01-01", "gone")])
        assert first.filter("valid_to = timestamp_ntz'9999-12-31'").count() == 4
        second = self.merge(spark, first, [(1, "2026-01-03", "b"), (2, "2026-01-01", "x"),
                                           (3, "2026-01-04", "older"), (5, "2026-01-02", "new")])
        end = dt.datetime(9999, 12, 31)
        assert rows(second, "id", "city", "valid_to") == [
            (1, "a", ts("2026-01-03")), (1, "b", end), (2, "x", end), (3, "p", end),
            (4, "gone", end), (5, "new", end),
        ]
        again = self.merge(spark, second, [(1, "2026-01-03", "b"), (5, "2026-01-02", "new")])
        assert rows(again, *again.columns) == rows(second, *second.columns)

    def test_changes_between_runs_collapse_and_comparison_says_so(self, spark):
        log = versions(spark, [(1, "2026-01-01", "a"), (1, "2026-01-02", "b"), (1, "2026-01-03", "c")])
        history_ = None
        for day in ("2026-01-01", "2026-01-03"):
            state = latest_per(log.filter(F.col("updated_at") <= F.lit(day).cast("timestamp_ntz")),
                               ["id"], ["updated_at"])
            out = history.snapshot_merge(history_, state, "id", "updated_at")
            history_ = spark.createDataFrame(out.collect(), out.schema)
        assert rows(history_, "city") == [("a",), ("c",)]
        full = history.scd2_windows(log, "id", "updated_at")
        status = history.compare_histories(full, history_, "id")
        assert rows(status, "valid_from", "status") == [
            (ts("2026-01-01"), "matched"), (ts("2026-01-02"), "only_log"),
            (ts("2026-01-03"), "matched"),
        ]


# ------------------------------------------------------------ late versions


def _versions_at(seed, n, keys=4, days=40):
    import random

    r = random.Random(seed)
    pairs = sorted({(r.choice([1] * 3 + list(range(keys))), r.randint(0, days)) for _ in range(n)})
    r.shuffle(pairs)
    return [(k, str(dt.datetime(2026, 1, 1) + dt.timedelta(days=d)), f"{k}-{d}") for k, d in pairs]


@pytest.mark.parametrize("seed,pieces", [(1, None), (3, "cut")])
def test_late_versions_repair_windows(spark, seed, pieces):
    """Batches in any order give what one build of everything gives, and change nothing else."""
    data = _versions_at(seed, 60)
    parts = [data[:20], data[20:25], data[25:50], data[50:]]
    dim = history.scd2_windows(versions(spark, parts[0]), "id", "updated_at", pieces=None)
    for part in parts[1:]:
        batch = versions(spark, part)
        cut = skew.find_pieces(dim, "id", "valid_from", min_rows=3, pieces=4) if pieces else None
        arrived, closed = history.repaired_windows(dim, batch, "id", "updated_at", pieces=cut)
        assert arrived.count() == len(part) and closed.count() <= len(part)
        changed = spark.createDataFrame(arrived.unionByName(closed).collect(), dim.schema)
        assert changed.select("id", "valid_from").distinct().count() == changed.count()
        after = merged(dim, changed, ["id", "valid_from"]).select(*dim.columns)
        dim = spark.createDataFrame(after.collect(), dim.schema)
    whole = history.scd2_windows(versions(spark, data), "id", "updated_at", pieces=None)
    assert rows(dim, *whole.columns) == rows(whole, *whole.columns)


def test_a_version_delivered_again_replaces_its_row(spark):
    dim = history.scd2_windows(versions(spark, [(1, "2026-01-01", "a"), (1, "2026-01-05", "b")]), "id", "updated_at", pieces=None)
    again = versions(spark, [(1, "2026-01-01", "A"), (1, "2026-01-03", "c"), (2, "2026-01-02", "n")])
    arrived, closed = history.repaired_windows(dim, again, "id", "updated_at", pieces=None)
    assert rows(arrived, "id", "city", "valid_from", "valid_to", "is_current") == [
        (1, "A", ts("2026-01-01"), ts("2026-01-03"), False), (1, "c", ts("2026-01-03"), ts("2026-01-05"), False),
        (2, "n", ts("2026-01-02"), ts("9999-12-31"), True)]
    assert closed.count() == 0  # the version that is shortened is in the batch itself


def test_empty_batch_changes_nothing(spark):
    dim = history.scd2_windows(versions(spark, [(1, "2026-01-01", "a")]), "id", "updated_at", pieces=None)
    arrived, closed = history.repaired_windows(dim, versions(spark, []), "id", "updated_at", pieces=None)
    assert arrived.count() == closed.count() == 0


def test_only_facts_of_arrived_windows_are_rekeyed(spark, tmp_path):
    log = [(1, "2026-01-01", "a"), (1, "2026-05-01", "b"), (2, "2026-02-01", "x")]
    dim = history.scd2_windows(versions(spark, log), "id", "updated_at", pieces=None)
    owners = spark.createDataFrame([(f"p{k}", 1 if k < 8 else 2) for k in range(12)], "policy string, id bigint")
    days = [dt.datetime(2026, 1 + k % 6, 15) for k in range(12)]
    facts_ = history.point_in_time(
        spark.createDataFrame([(f"p{k}", days[k]) for k in range(12)], "policy string, t timestamp").withColumn("at", F.col("t").cast("timestamp_ntz")).drop("t")
        .join(owners, "policy"), dim, "id", "at", ["version_sk"], pieces=None).drop("id")
    facts_.withColumn("month", F.to_date(F.trunc("at", "MM"))).write.partitionBy("month").parquet(str(tmp_path / "facts"))
    stored_facts = spark.read.parquet(str(tmp_path / "facts"))
    arrived, _ = history.repaired_windows(dim, versions(spark, [(1, "2026-03-10", "late")]), "id", "updated_at", pieces=None)
    arrived = spark.createDataFrame(arrived.collect(), arrived.schema)
    changed = history.rekeyed(stored_facts, owners, arrived, "policy", "id", "at", "version_sk", period="month")
    assert rows(changed, "policy") == [("p2",), ("p3",)]  # owner 1, March and April
    assert {r[0] for r in changed.select("version_sk").collect()} == {r[0] for r in arrived.select("version_sk").collect()}
    assert changed.columns == stored_facts.columns
    assert months_read(changed) == 3  # March to May of six; the window ends on the first of May


def months_read(df):
    """Partitions of the facts' folder that the scan of an executed plan read."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        metric = node.metrics().get("numPartitions") if node.getClass().getSimpleName() == "FileSourceScanExec" else None
        if metric is not None and metric.isDefined():
            found.append(metric.get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return max(found)


# ------------------------------------------------------------ backfill


@pytest.mark.parametrize("seed", [1, 2])
def test_backfill_in_one_pass_equals_merging_in_order(spark, seed):
    """States go back and forth in time, keys go missing and come back, dumps repeat states."""
    import random

    r = random.Random(seed)
    dumps = []
    for day in range(8):
        for key in range(5):
            if r.random() < 0.8:
                at = r.randint(1, 1 + day * 2)
                dumps.append((key, str(dt.datetime(2026, 1, 1) + dt.timedelta(days=at)), f"{key}-{at}", dt.date(2026, 2, 1 + day)))
    df = spark.createDataFrame(dumps, "id bigint, at string, city string, day date").select(
        "id", "city", F.col("at").cast("timestamp_ntz").alias("updated_at"), "day")
    past = None
    for day in range(8):
        state = df.filter(F.col("day") == F.lit(dt.date(2026, 2, 1 + day))).drop("day")
        past = history.snapshot_merge(past, state, "id", "updated_at")
        past = spark.createDataFrame(past.collect(), past.schema)
        if day == 2:
            early = past
    whole = history.snapshot_backfill(df, "id", "updated_at", "day")
    assert rows(whole, *past.columns) == rows(past, *past.columns)
    rest = history.snapshot_backfill(df.filter("day >= '2026-02-04'"), "id", "updated_at", "day", early)
    assert rows(rest, *past.columns) == rows(past, *past.columns)


# ------------------------------------------------------------ reports by delta


def test_report_by_deltas_equals_the_full_report(spark):
    import random

    from tidemark.operators import facts

    r = random.Random(6)
    draw = lambda k: (k, r.choice("abc"), r.choice([None, "x"]), r.randint(-2, 3))
    table, report, keys = {}, None, ("g", "h")
    frame = lambda rows: spark.createDataFrame(list(rows), "id int, g string, h string, v int")
    for step in range(4):
        new = {k: draw(k) for k in (range(30) if step == 0 else r.sample(range(40), 12))}
        old = [table[k] for k in new if k in table]
        delta = facts.report_delta(frame(old), frame(new.values()), keys, ["v"])
        report = facts.apply_delta(report, delta, keys, ["v"])
        report = spark.createDataFrame(report.collect(), report.schema)
        table |= new
    table = {k: row for k, row in table.items() if row[1] != "c"}
    full = {}
    for _, g, h, v in table.values():
        s, n = full.get((g, h), (0, 0))
        full[g, h] = (s + v, n + 1)
    got = {(x.g, x.h): (x.v, x.rows) for x in report.filter("g <> 'c'").collect()}
    assert got == full
    undone = facts.report_delta(frame(table.values()), frame([]), keys, ["v"])
    left = facts.apply_delta(report.filter("g <> 'c'"), undone, keys, ["v"])
    assert left.isEmpty()  # groups without rows are gone


def test_newest_load_is_read_from_one_partition(spark, tmp_path):
    from tidemark.operators import selection

    rows = spark.range(40).select("id", F.expr("timestamp_ntz'2026-01-01 12:00:00' + make_dt_interval(cast(id div 4 as int))").alias("loaded_at"))
    path = str(tmp_path / "target")
    rows.withColumn("load_day", F.to_date("loaded_at")).write.partitionBy("load_day").parquet(path)
    target = spark.read.parquet(path)
    more = rows.unionByName(rows.select((F.col("id") + 100).alias("id"), (F.col("loaded_at") + F.expr("INTERVAL 9 DAYS 22 HOURS")).alias("loaded_at")))
    got = selection.incremental(more, target, target_day="load_day")
    assert rows_of(got) == rows_of(selection.incremental(more, target)) and got.count() > 4
    newest = target.filter(F.col("load_day") == target.agg(F.max("load_day")).scalar()).agg(F.max("loaded_at"))
    assert months_read(newest) == 1
    assert selection.incremental(more, target.filter("id < 0"), target_day="load_day").count() == 80


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())
