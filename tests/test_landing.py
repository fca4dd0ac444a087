"""Files of the landing zone and their ingestion."""

import gzip
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.functions.keys import path_part
from tidemark.operators import quality
from tidemark.operators.versions import typed
from tidemark.sources import landing, tables
from tidemark.streaming.ingest import ingest

FIELDS = {"n": ("n", "bigint"), "name": ("name", "string")}


def put(folder, name, rows, raw=False):
    folder.mkdir(parents=True, exist_ok=True)
    body = "".join(json.dumps(r) + "\n" for r in rows)
    data = gzip.compress(body.encode()) if name.endswith(".gz") else body.encode()
    (folder / name).write_bytes(data)


def attempt(root, run="r1", stamp="a1", day="2026-09-29"):
    return root / f"dt={day}" / f"run={run}" / f"attempt={stamp}"


def numbers(df):
    return sorted((r.n, r.file_row) for r in typed(df, FIELDS, ["file_row"]).collect())


@pytest.fixture
def lake(tmp_path):
    root = tmp_path / "claims"
    folder = attempt(root)
    put(folder, "part-00001.json.gz", [{"n": 1, "name": "a"}, {"n": 2, "name": "b", "extra": [1]}])
    put(folder, "part-00002.json", [{"n": 3, "name": None}])
    put(folder, "part-1.json.tmp", [{"n": 99}])
    put(folder, "manifest.json", [{"n": 99}])
    put(folder, "_SUCCESS", [])
    put(folder, "xpart-00001.json", [{"n": 99}])
    return root


def test_only_data_parts_become_rows(spark, lake):
    rows = landing.read_landing(spark, str(lake))
    assert numbers(rows) == [(1, 1), (2, 2), (3, 1)]
    assert rows.columns == list(landing.LANDING_COLUMNS)
    row = rows.first()
    assert (str(row.business_date), row.run_id) == ("2026-09-29", "r1")
    assert rows.select("loaded_at").distinct().count() == 1
    # new fields never break the load
    assert rows.filter(F.variant_get("record", "$.extra[0]", "int") == 1).count() == 1


def test_line_numbers_of_a_file_read_in_blocks(spark, tmp_path):
    put(attempt(tmp_path), "part-00001.json", [{"n": i, "name": "x" * 50} for i in range(1, 501)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = landing.read_landing(spark, str(tmp_path))
        assert numbers(rows) == [(i, i) for i in range(1, 501)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_ends_do_not_depend_on_the_split(spark, tmp_path):
    lines = [f'{{"n":\r {i}}}' for i in range(1, 60)]
    folder = attempt(tmp_path)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part-00001.json").write_bytes(("\r\n".join(lines) + "\n\n\r\n" + '{"n": 60}').encode())
    for size in ("64", "1000", "1000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert numbers(landing.read_landing(spark, str(tmp_path))) == [(i, i) for i in range(1, 60)] + [(60, 62)]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_missing_path_part_is_empty(spark):
    df = spark.createDataFrame([("x/dt=2026-01-02/run=r/f",)], "p string")
    assert tuple(df.select(path_part("p", "dt"), path_part("p", "attempt")).first()) == ("2026-01-02", "")


def test_parts_are_bounded_sorted_and_immutable(spark, tmp_path):
    folder = str(tmp_path / "out")
    df = spark.range(25).repartition(2).select("id", F.lit(None).cast("string").alias("a"))
    landing.write_parts(df, folder, max_rows=10)
    parts = [f for f in os.listdir(folder) if f.startswith("part-")]
    sizes, first = [], None
    for name in parts:
        lines = gzip.decompress((tmp_path / "out" / name).read_bytes()).decode().splitlines()
        sizes.append(len(lines))
        first = first or lines[0]
    assert sum(sizes) == 25 and max(sizes) <= 10
    assert first.startswith('{"a":null,"id":')
    with pytest.raises(AnalysisException):
        landing.write_parts(df, folder)


def test_nested_manifest_keeps_entities_without_files(spark, tmp_path):
    doc = {
        "run_id": "r1", "business_date": "2026-09-29", "source_name": "api", "attempt": "a1", "buffer_hours": 2.0,
        "generated_at": "2026-09-30T00:01:00+00:00",
        "entities": {
            "claims": {"watermark": "2026-09-28T00:00:00", "window_start": "2026-09-27T22:00:00",
                       "window_end": "2026-09-30T00:00:00", "row_count": 12, "max_changed_at": "2026-09-29T15:00:00",
                       "files": [{"key": "k1", "rows": 10}, {"key": "k2", "rows": 2}]},
            "policies": {"watermark": "2026-09-28T00:00:00", "window_start": "2026-09-27T22:00:00",
                         "window_end": "2026-09-30T00:00:00", "row_count": 0, "max_changed_at": None, "files": []},
        },
    }
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps(doc, indent=2))
    rows = landing.read_nested_manifest(spark, str(path))
    got = sorted((r.entity, r.key or "", r.rows, r.row_count, r.file_count) for r in rows.collect())
    assert got == [("claims", "k1", 10, 12, 2), ("claims", "k2", 2, 12, 2), ("policies", "", 0, 0, 0)]
    # a name with a leading underscore is read as nothing, which must not pass for "nothing expected"
    hidden = tmp_path / "_manifest.json"
    hidden.write_text(json.dumps(doc))
    with pytest.raises(landing.ManifestMissing):
        landing.read_nested_manifest(spark, str(hidden))


def test_inventory_counts_by_first_folder(spark, tmp_path):
    for entity, n in (("claims", 2), ("policies", 1)):
        spark.range(10).repartition(n).write.parquet(str(tmp_path / "raw" / entity / "dt=2026-01-01"))
    got = landing.file_inventory(spark, str(tmp_path / "raw"))
    rows = {r.entity: (r.files, r.bytes > 0) for r in got.collect()}
    assert rows == {"claims": (2, True), "policies": (1, True)}


class TestIngest:
    def run(self, spark, lake, tmp_path):
        return ingest(spark, str(lake), str(tmp_path / "table"), str(tmp_path / "checkpoint"))

    def read(self, spark, tmp_path):
        return numbers(spark.read.parquet(str(tmp_path / "table")))

    def test_each_file_name_is_loaded_once(self, spark, lake, tmp_path):
        assert self.run(spark, lake, tmp_path) == 2
        assert self.run(spark, lake, tmp_path) == 0
        put(attempt(lake), "part-00002.json", [{"n": 77, "name": "rewritten"}])
        assert self.run(spark, lake, tmp_path) == 0
        put(attempt(lake, stamp="a2"), "part-00001.json.gz", [{"n": 1, "name": "a"}])
        assert self.run(spark, lake, tmp_path) == 1
        assert self.read(spark, tmp_path) == [(1, 1), (1, 1), (2, 2), (3, 1)]

    def test_old_files_are_neither_dropped_nor_read_again(self, spark, lake, tmp_path):
        import os
        import time

        assert self.run(spark, lake, tmp_path) == 2
        put(attempt(lake, stamp="a2"), "part-00001.json.gz", [{"n": 9, "name": "late"}])
        old = time.time() - 30 * 86400
        for path in lake.rglob("part-*"):
            os.utime(path, (old, old))
        assert self.run(spark, lake, tmp_path) == 1
        put(attempt(lake), "part-00002.json", [{"n": 77, "name": "rewritten"}])
        put(attempt(lake, stamp="a3"), "part-00001.json.gz", [{"n": 10, "name": "new"}])
        assert self.run(spark, lake, tmp_path) == 1
        assert [n for n, _ in self.read(spark, tmp_path)] == [1, 2, 3, 9, 10]

    def test_small_batches_load_everything(self, spark, lake, tmp_path):
        for i in range(3, 8):
            put(attempt(lake), f"part-{i:05d}.json.gz", [{"n": 10 * i, "name": "x"}])
        table = str(tmp_path / "table")
        assert ingest(spark, str(lake), table, str(tmp_path / "cp"), files_per_batch=2) == 7
        assert [n for n, _ in self.read(spark, tmp_path)] == [1, 2, 3, 30, 40, 50, 60, 70]

    def test_a_broken_line_fails_loudly(self, spark, lake, tmp_path):
        (attempt(lake) / "part-00009.json").write_text('{"n": 1}\nnot json\n')
        with pytest.raises(Exception, match="MALFORMED|parse"):
            self.run(spark, lake, tmp_path)


def test_reconcile_outcomes(spark):
    manifest = spark.createDataFrame(
        [("a", "f1", 2), ("b", "f2", 2), ("c", "f3", 1), ("none", None, 0), ("lost", "f4", 3)],
        "entity string, key string, rows bigint")
    landed = spark.createDataFrame(
        [("a", "f1"), ("a", "f1"), ("b", "f2"), ("c", "f3"), ("c", "f3")], "entity string, source_file string")
    got = {r.entity: (r.status, r.file_status) for r in quality.reconcile(manifest, landed).collect()}
    assert got == {"a": ("DONE", "DONE"), "b": ("NOT_YET", "DONE"), "c": ("TOO_MANY", "DONE"),
                   "none": ("DONE", "DONE"), "lost": ("NOT_YET", "NOT_YET")}


def test_swapped_and_unlisted_files_show(spark):
    manifest = spark.createDataFrame([("a", "f1", 2), ("a", "f2", 1), ("none", None, 0)], "entity string, key string, rows bigint")
    landed = spark.createDataFrame([("a", "f1"), ("a", "f1"), ("a", "f3"), ("b", "f9")], "entity string, source_file string")
    got = {(r.entity, r.file): r.status for r in quality.reconcile_files(manifest, landed).collect()}
    assert got == {("a", "f1"): "DONE", ("a", "f2"): "NOT_YET", ("a", "f3"): "NOT_LISTED", ("b", "f9"): "NOT_LISTED"}


def test_overwriting_a_day_never_duplicates(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2)], "dt string, v int")
    tables.overwrite_partition(days, path, "dt")
    tables.overwrite_partition(days.filter("v = 2").withColumn("v", F.lit(20)), path, "dt")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 20]


# ------------------------------------------------------------ counted while written, rejected lines, keyed state


def test_counts_taken_while_writing_are_those_of_the_files(spark, tmp_path):
    df = spark.range(0, 57, 1, 3).select("id", F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, id)").alias("ts"))
    written = landing.write_counted(df, str(tmp_path / "parts"), "ts", max_rows=10)
    read = landing.part_stats(spark, str(tmp_path / "parts"), "ts")
    assert written.complete and written.rows == 57
    got = {(r.key.rsplit("/", 1)[1], r.rows) for r in written.parts(spark).collect()}
    assert got == {(r.key.rsplit("/", 1)[1], r.rows) for r in read.collect()} and len(got) == 6
    assert {r.key for r in written.parts(spark).collect()} == {r.key for r in read.collect()}
    assert written.max_changed_at == read.agg(F.max("max_changed_at")).first()[0]


def test_nothing_written_lists_nothing(spark, tmp_path):
    df = spark.range(0).select("id", F.lit(None).cast("timestamp_ntz").alias("ts"))
    written = landing.write_counted(df, str(tmp_path / "parts"), "ts")
    assert (written.rows, written.max_changed_at, written.parts(spark).count()) == (0, None, 0)


def _text_lake(root, **files):
    folder = root / "events" / "dt=2026-01-01" / "run=r1" / "attempt=a1"
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in files.items():
        (folder / f"part-{name}.json").write_text("\n".join(lines) + "\n")
    return str(root / "events")


def test_rejected_lines_are_kept_with_their_place(spark, tmp_path):
    from tidemark.streaming.ingest import ingest

    lake = _text_lake(tmp_path, **{"00000": ['{"a": 1}', '{"a": ', "", '{"a": 2}', "[1]", "null"], "00001": ['{"a": 3}']})
    table, aside = str(tmp_path / "table"), str(tmp_path / "aside")
    assert ingest(spark, lake, table, str(tmp_path / "cp"), quarantine=aside) == 2
    assert sorted(r[0] for r in spark.read.parquet(table).select(F.variant_get("record", "$.a", "int")).collect()) == [1, 2, 3]
    got = spark.read.parquet(aside)
    assert sorted((r.value, r.reason, r.file_row, r.run_id) for r in got.collect()) == [
        ("[1]", "not an object", 5, "r1"), ("null", "not an object", 6, "r1"), ('{"a": ', "not json", 2, "r1")]
    _text_lake(tmp_path, **{"00002": ['{"a": 4}']})
    ingest(spark, lake, table, str(tmp_path / "cp"), quarantine=aside)
    assert spark.read.parquet(table).count() == 4 and spark.read.parquet(aside).count() == 3


def test_without_a_quarantine_a_bad_line_fails_its_batch(spark, tmp_path):
    from tidemark.streaming.ingest import ingest

    lake = _text_lake(tmp_path, **{"00000": ['{"a": 1}', '{"a": ']})
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        ingest(spark, lake, str(tmp_path / "table"), str(tmp_path / "cp"))
    with pytest.raises(ValueError, match="only lines"):
        ingest(spark, lake, str(tmp_path / "t2"), str(tmp_path / "cp2"), kind="parquet", quarantine=str(tmp_path / "q"))


def test_keyed_state_keeps_the_last_delivery_over_restarts(spark, tmp_path):
    from tidemark.streaming.ingest import dedup_stream, read_deduplicated

    import random

    r = random.Random(3)
    deliveries = [(k, r.randint(0, 50), r.choice("abc")) for k in range(8) for _ in range(6)]
    r.shuffle(deliveries)
    source, table, checkpoint = (str(tmp_path / n) for n in ("source", "table", "cp"))
    schema = "id int, at int, value string"
    for n in range(4):  # four starts of the stream; deliveries of a key are spread over all of them
        for part in (deliveries[n * 12 : n * 12 + 6], deliveries[n * 12 + 6 : n * 12 + 12]):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        dedup_stream(spark, source, table, checkpoint, lambda rows: rows, ["id"], ["at"], files_per_batch=1)
        seen = deliveries[: n * 12 + 12]
        want = sorted({k: max((at, v) for i, at, v in seen if i == k) for k, _, _ in seen}.items())
        got = sorted((row.id, (row.at, row.value)) for row in read_deduplicated(spark, table, ["id"]).collect())
        assert got == want
    batches = spark.read.parquet(table)
    assert batches.groupBy("batch", "id").count().filter("count > 1").isEmpty()
