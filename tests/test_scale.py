"""What large inputs rely on: narrow shuffles, lines read in place, few rows carried twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.plans import models
from tidemark.queries import feeds
from tidemark.queries.registry import Lake
from tidemark.sources import landing


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def lake(spark, tmp_path):
    at = F.lit("2024-01-05 22:30:00").cast("timestamp_ntz")
    orders = spark.range(6).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 2).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        at.alias("o_orderdate"), F.lit("2-HIGH").alias("o_orderpriority"))
    lines = spark.range(12).select(
        (F.col("id") % 6).alias("l_orderkey"), (F.col("id") % 3).cast("int").alias("l_linenumber"), F.col("id").alias("l_partkey"),
        F.col("id").alias("l_suppkey"), F.lit(1.5).alias("l_extendedprice"), F.lit("A").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"), at.alias("l_shipdate"))
    events = spark.range(5).select(
        F.col("id").alias("event_id"), at.alias("ts"), F.col("id").alias("user_id"), F.lit("click").alias("event_type"), F.lit(2.0).alias("value"))
    for name, df in {"orders": orders, "lineitem": lines, "events": events}.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return Lake(spark, str(tmp_path))


@pytest.mark.parametrize("feed", ["holders", "claims"])
def test_rows_are_dealt_before_their_copies(lake, feed):
    plan = plan_of(getattr(feeds, feed)(lake))
    assert plan.count("Exchange") == 1
    assert plan.index("Generate") < plan.index("Exchange")  # the top of a plan comes first


def test_policies_are_shuffled_by_their_join_only(lake):
    plan = plan_of(feeds.policies(lake))
    assert plan.count("Exchange") == 2 and plan.index("Join") < plan.index("Exchange")


def test_dealt_rows_are_the_plain_rows(lake):
    for rows in (feeds.holder_rows, feeds.policy_rows, feeds.claim_rows):
        plain, dealt = (sorted(map(str, rows(lake, dealt=d).collect())) for d in (False, True))
        assert plain and plain == dealt


def test_claims_meet_policies_by_left_joins(spark):
    events = spark.createDataFrame([("c1", "p1", "OPEN"), ("c2", "p2", "OPEN"), ("c3", "p3", "OPEN")], "claim_id string, policy_id string, claim_status string")
    at = F.lit("2024-01-05").cast("timestamp_ntz")
    events = events.select("*", at.alias("updated_at"), at.alias("loaded_at"), F.lit("f").alias("source_file"), F.lit(1.0).alias("claim_amount"),
                           F.to_date(at).alias("loss_date"), F.to_date(at).alias("reported_date"))
    policies = spark.createDataFrame([("p1", 1), ("p2", 2)], "policy_id string, policyholder_id bigint")
    dim_policy = spark.createDataFrame([("p1", "k1"), ("p3", "k3")], "policy_id string, policy_sk string")
    dim = spark.createDataFrame([("h1", 1, dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1))],
                                "policyholder_sk string, policyholder_id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz")
    rows = models.fct_claims(events, policies, dim_policy, dim, pieces=None)
    assert "FullOuter" not in plan_of(rows)
    got = {r.claim_id: (r.policy_sk, r.policyholder_sk) for r in rows.collect()}
    assert got == {"c1": ("k1", "h1"), "c2": ("-1", "-1"), "c3": ("k3", "-1")}


@pytest.mark.parametrize("few", [0, 100])
def test_rekeyed_facts_know_the_key_before(spark, monkeypatch, few):
    monkeypatch.setattr(history, "FEW_KEYS", few)
    at = dt.datetime
    facts = spark.createDataFrame([("p1", at(2024, 1, 2), "old1"), ("p2", at(2024, 1, 9), "old2"), ("p3", at(2024, 1, 2), "old3")],
                                  "policy string, at timestamp_ntz, sk string")
    owners = spark.createDataFrame([("p1", 1), ("p2", 1), ("p3", 2)], "policy string, id bigint")
    arrived = spark.createDataFrame([("new", 1, at(2024, 1, 1), at(2024, 1, 5))], "sk string, id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz")
    rows = history.rekeyed(facts, owners, arrived, "policy", "id", "at", "sk", replaced="before")
    assert [tuple(r) for r in rows.collect()] == [("p1", at(2024, 1, 2), "new", "old1")]
    assert ("LeftSemi" in plan_of(rows)) == (few > 0)


def test_lines_of_named_files_are_not_shuffled(spark, tmp_path):
    file = tmp_path / "part-0.json"
    file.write_text('{"a": 1}\n\n{"a": 2}\n')
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = landing.numbered_lines(spark, [str(file)])
        assert "BroadcastHashJoin" in plan_of(lines) and "SortMergeJoin" not in plan_of(lines)
        assert sorted((r.value, r.file_row) for r in lines.collect()) == [('{"a": 1}', 1), ('{"a": 2}', 3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_star_has_what_claims_read_and_gives_the_same_facts(lake):
    from tidemark.queries.model_queries import claim_facts, narrow_star, star

    narrow = narrow_star(lake)
    assert narrow["policies"].columns == ["policy_id", "policyholder_id"] and narrow["dim_policy"].columns == ["policy_sk", "policy_id"]
    assert narrow["dim_holder"].columns == ["policyholder_sk", "policyholder_id", "valid_from", "valid_to"]
    got, want = (sorted(map(str, claim_facts(lake, s).collect())) for s in (narrow, star(lake)))
    assert got and got == want


def test_late_batches_replace_each_other_before_the_facts(lake, spark):
    from tidemark.queries.model_queries import _with_late_keys

    base = spark.createDataFrame([(n, "old") for n in "abcd"], "id string, sk string")
    met = []

    def rekey(facts_, batch):
        met.append(facts_)
        return facts_.filter(F.col("id").isin(*batch)).withColumn("sk", F.lit(batch))

    out = _with_late_keys(lake, base, rekey, ["ab", "bc"], "id")
    assert {r["id"]: r["sk"] for r in out.collect()} == {"a": "ab", "b": "bc", "c": "bc", "d": "old"}
    assert all(m is base for m in met) and out.count() == 4


def test_times_travel_as_iso_text(spark):
    row = spark.range(1).select(F.lit("2024-01-05 22:30:00").cast("timestamp_ntz").alias("a"), F.lit("2024-01-05 22:30:00.5").cast("timestamp").alias("b"),
                                F.lit(None).cast("timestamp_ntz").alias("c"), F.lit("2024-01-05").cast("date").alias("d"))
    out = landing.to_records(row).select(F.to_json("record").alias("j")).first()["j"]
    assert '"a":"2024-01-05T22:30:00"' in out and '"b":"2024-01-05T22:30:00.5"' in out and '"d":"2024-01-05"' in out


def test_folders_and_pattern_are_looked_at_per_block(spark, tmp_path):
    folder = tmp_path / "dt=2024-01-05" / "run=r1"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text('{"a": 1}\r\n\n{"a": 2}\n')
    (folder / "other.json").write_text('not a record\n')
    rows = landing.read_landing(spark, [str(folder / name) for name in ("part-0.json", "other.json")])
    got = sorted((str(r.business_date), r.run_id, r.file_row) for r in rows.select("business_date", "run_id", "file_row").collect())
    assert got == [("2024-01-05", "r1", 1), ("2024-01-05", "r1", 3)]
    plan = plan_of(rows).lower()
    lines, blocks = plan.split("broadcastexchange", 1)
    for asked in ("stringsplitsql", "rlike"):
        assert asked not in lines and asked in blocks
    counted = blocks.index("hashaggregate")  # the top of a plan comes first
    assert blocks.index("rlike") < counted and "rlike" not in blocks[counted:]


def test_first_batch_of_a_table_is_written_once_before_it_is_published(spark, tmp_path, monkeypatch):
    from tidemark.sources import tables

    monkeypatch.setattr(tables, "work_dir", lambda spark, name: f"{tmp_path}/work")
    table = tables.KeyedTable(spark, f"{tmp_path}/t", ["id"], tables.bucket_of(["id"], 4))
    table.upsert(spark.range(20).select("id", F.lit("a").alias("x")))
    assert [p.name for p in (tmp_path / "work").iterdir()] == ["batch"]
    assert table.read().count() == 20 and table.stored().schema[tables.PART].dataType.typeName() == "integer"
    monkeypatch.setattr(tables, "work_dir", lambda spark, name: f"{tmp_path}/work2")
    table.upsert(spark.range(15, 25).select("id", F.lit("b").alias("x")))
    assert {r.id: r.x for r in table.read().collect()} == {n: "a" if n < 15 else "b" for n in range(25)}


def test_packed_keys_are_equal_for_equal_keys_only(spark):
    from tidemark.functions.keys import packed_key, unpacked_key

    md5 = "0123456789abcdef0123456789abcdef"
    texts = [md5, md5.upper(), md5 + "\n", md5[:31], md5 + "0", "-1", "", "é" * 16, "x" * 16, "\0" * 17, None]
    df = spark.createDataFrame([(x,) for x in texts], "k string").withColumn("p", packed_key("k"))
    rows = df.withColumn("back", unpacked_key("p")).collect()
    assert all(r.k == r.back for r in rows) and len({r.p for r in rows}) == len(texts)
    assert len(next(r.p for r in rows if r.k == md5)) == 16


def test_written_facts_and_the_report_shuffle_packed_keys(spark):
    from tidemark.plans import reports

    at = dt.datetime(2024, 1, 5)
    policies = spark.createDataFrame([("p1", 1, 10.0, at), ("p2", 2, 20.0, at), (None, 1, 5.0, at), ("p1", 1, 30.0, at)],
                                     "policy_id string, policyholder_id bigint, annual_premium double, issued_at timestamp_ntz")
    policies = policies.select("*", F.to_date("issued_at").alias("effective_date"), F.lit("AUTO").alias("product_line"))
    dim_policy = models.dim_policy(policies.dropDuplicates(["policy_id"]), ("product_line",))
    versions = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "Pune")], "policyholder_id bigint, updated_at timestamp_ntz, city string")
    dim = models.dim_policyholder(versions, ("city",), pieces=None)
    assert "first_name" not in dim.columns
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fct = models.fct_policies_written(policies, dim_policy, dim, pieces=None, keep=["policyholder_id"])
        days = policies.select(F.lit(20240105).alias("date_key"), F.lit(1).alias("calendar_month")).distinct()
        report = reports.premium_by_month_city_product(fct, dim_policy, dim, days)
        assert "unhex" in plan_of(report)
        keys = {(r.policy_id, r.annual_premium): (r.policy_sk, r.policyholder_sk, r.policyholder_id) for r in fct.collect()}
        sk, holder = {r.policy_id: r.policy_sk for r in dim_policy.collect()}, dim.filter("policyholder_id = 1").first().policyholder_sk
        assert keys == {("p1", 10.0): (sk["p1"], holder, 1), ("p1", 30.0): (sk["p1"], holder, 1), ("p2", 20.0): (sk["p2"], "-1", 2)}
        assert {(r.city, r.premium) for r in report.collect()} == {("Pune", 40.0), ("Unknown", 20.0)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rekeyed_facts_with_their_customer_do_not_meet_the_owners(spark):
    at = dt.datetime
    md5 = "0123456789abcdef0123456789abcdef"
    facts = spark.createDataFrame([("p1", 1, at(2024, 1, 2), "-1", md5), ("p2", 1, at(2024, 1, 9), "-1", "k2")],
                                  "policy string, id bigint, at timestamp_ntz, sk string, other_sk string")
    arrived = spark.createDataFrame([(md5, 1, at(2024, 1, 1), at(2024, 1, 5))], "sk string, id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz")
    rows = history.rekeyed(facts, None, arrived, "policy", "id", "at", "sk", replaced="before", packed=("other_sk",))
    assert [tuple(r) for r in rows.collect()] == [("p1", 1, at(2024, 1, 2), md5, md5, "-1")]
