"""Drops, slices and CSV files."""

import csv
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from masterloom import RunContext
from masterloom.sources import (
    export_csv,
    file_stamps,
    footer_stamps,
    latest_batch,
    newest_file,
    read_drop,
    utc_text,
    watermark_slice,
)

T0 = datetime(2024, 5, 1, tzinfo=timezone.utc)


def put(spark, folder, name, values, schema="id string, ts timestamp"):
    parts = folder.parent / f"parts-{folder.name}-{name}"
    spark.createDataFrame(values, schema).coalesce(1).write.parquet(str(parts))
    folder.mkdir(exist_ok=True)
    next(parts.glob("part-*.parquet")).rename(folder / name)


@pytest.fixture
def drop(spark, tmp_path):
    folder = tmp_path / "drop"
    put(spark, folder, "f1.parquet", [("old", T0), ("older", T0 - timedelta(days=3))])
    put(spark, folder, "f2 [x].parquet", [("new", T0 + timedelta(days=1)), ("undated", None)])
    put(spark, folder, "f3.parquet", [("undated", None)])
    return folder


def test_newest_file_and_its_rows(spark, drop):
    rows = read_drop(spark, str(drop))
    newest = newest_file(rows, "ts")
    assert newest.name == "f2%20%5Bx%5D.parquet"
    assert newest.batch_id == "f2%20%5Bx%5D.parquet-20240502T000000000000"
    assert sorted(r["id"] for r in latest_batch(rows, "ts").collect()) == ["new", "undated"]
    assert sorted(r["id"] for r in read_drop(spark, str(drop), newest.name).collect()) == ["new", "undated"]


def test_only_the_newest_file_is_read(spark, drop):
    rows = read_drop(spark, str(drop))
    batch = latest_batch(rows, "ts")
    assert len(rows.inputFiles()) == 3
    assert len(batch.collect()) == 2
    scan = batch._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert "FileScan" in scan.toString()
    assert scan.metrics().apply("numFiles").value() == 1
    assert len(read_drop(spark, str(drop), "f1.parquet").inputFiles()) == 1


def test_a_tie_goes_to_the_last_name(spark, tmp_path):
    folder = tmp_path / "tie"
    for name in ("b.parquet", "c.parquet", "a.parquet"):
        put(spark, folder, name, [(name, T0)])
    assert newest_file(read_drop(spark, str(folder)), "ts").name == "c.parquet"


def test_no_timestamp_and_no_file(spark, tmp_path):
    folder = tmp_path / "none"
    put(spark, folder, "a.parquet", [("x", None)])
    rows = read_drop(spark, str(folder))
    assert newest_file(rows, "ts") is None and latest_batch(rows, "ts") is None
    (tmp_path / "empty").mkdir()
    assert read_drop(spark, str(tmp_path / "empty")) is None


def test_the_newest_file_has_its_own_schema(spark, tmp_path):
    folder = tmp_path / "grown"
    put(spark, folder, "a.parquet", [("x", T0)])
    put(spark, folder, "b.parquet", [("y", T0, 5)], "id string, ts timestamp, added int")
    for name, wanted in (("a.parquet", ["id", "ts"]), ("b.parquet", ["id", "ts", "added"])):
        assert read_drop(spark, str(folder), name).columns == [*wanted, "sourcefile"]


def test_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", T0, "2024-05-01 00:00:00")], "id string, ts timestamp, txt string").write.parquet(path)
    table = spark.read.parquet(path)
    for column in ("ts", "TXT"):
        kept = watermark_slice(table, column, T0, F.col("id") == "a")
        plan = kept._jdf.queryExecution().executedPlan().toString()
        pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
        assert "GreaterThanOrEqual" in pushed and kept.count() == 1
        assert watermark_slice(table, column, T0 + timedelta(microseconds=1)).isEmpty()


def test_watermark_on_text(spark):
    texts = ["2024-05-01 10:00:00", "2024-05-01 09:59:59.999999", "2024-05-01T12:00:00+01:00", " 2024-05-02", "n/a", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    kept = watermark_slice(df, "t", T0 + timedelta(hours=10))
    assert [r["t"] for r in kept.collect()] == [texts[0], texts[2], texts[3]]


def test_watermark_needs_a_time_zone(spark):
    with pytest.raises(ValueError):
        watermark_slice(spark.range(1), "id", datetime(2024, 5, 1))


VALUES = [("a,b", 'say "hi"'), ("line\nbreak", ""), (None, "plain"), ("", "ü"), (" H1 ", "\tx ")]


@pytest.mark.parametrize("single", [True, False])
def test_csv_round_trip(spark, tmp_path, single):
    df = spark.createDataFrame(VALUES, "one string, two string").repartition(3)
    for _ in range(2):  # an earlier export is replaced
        path = export_csv(df.na.fill(""), str(tmp_path / "out"), "x.csv", single=single)
    assert path == f"{tmp_path}/out/x.csv"
    assert [p.name for p in (tmp_path / "out").iterdir() if p.name[0] != "."] == ["x.csv"]
    files = [tmp_path / "out" / "x.csv"] if single else sorted((tmp_path / "out" / "x.csv").glob("part-*"))
    found = []
    for file in files:
        with open(file, newline="") as handle:
            lines = list(csv.reader(handle))
        assert lines[0] == ["one", "two"]
        found += [tuple(x) for x in lines[1:]]
    assert sorted(found) == sorted((a or "", b) for a, b in VALUES)


def test_csv_form_is_the_callers_choice(spark, tmp_path):
    df = spark.range(10)
    one, many = export_csv(df, str(tmp_path), "one.csv", single=True), export_csv(df, str(tmp_path), "many.csv")
    assert (tmp_path / "one.csv").is_file() and (tmp_path / "many.csv").is_dir()
    assert spark.read.csv(many, header=True).count() == spark.read.csv(one, header=True).count() == 10


def test_a_single_csv_is_written_by_all_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "repartition", None)
    df = spark.range(0, 100, 1, 7).selectExpr("id", "concat('a \"quoted\", line', '\n', id) AS text")
    path = export_csv(df, str(tmp_path), "one.csv", single=True)
    with open(path, newline="") as handle:
        lines = list(csv.reader(handle))
    assert lines == [["id", "text"], *[[str(i), f'a "quoted", line\n{i}'] for i in range(100)]]
    assert [p.name for p in tmp_path.iterdir() if p.name[0] != "."] == ["one.csv"]


def test_csv_of_no_rows_has_a_header(spark, tmp_path):
    export_csv(spark.createDataFrame([], "a string, b string"), str(tmp_path), "none.csv", single=True)
    assert (tmp_path / "none.csv").read_text() == "a,b\n"


def test_batch_id_does_not_follow_the_drivers_zone(spark, monkeypatch):
    df = spark.createDataFrame([("f", datetime(2024, 5, 1, 10, tzinfo=timezone.utc))], "sourcefile string, ts timestamp")
    found = set()
    for zone in ("UTC", "America/New_York"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        found.add(newest_file(df, "ts").batch_id)
    monkeypatch.undo()
    time.tzset()
    assert found == {"f-20240501T100000000000"}


def test_a_text_that_is_no_timestamp_is_passed_over(spark):
    df = spark.createDataFrame([("a", "n/a"), ("b", "2024-05-01 10:00:00"), ("c", None)], "sourcefile string, ts string")
    assert newest_file(df, "ts").name == "b"
    assert newest_file(df.filter("sourcefile <> 'b'"), "ts") is None


def test_text_times_are_utc_in_any_session_zone(spark):
    since = datetime(2024, 11, 3, 6, 30, tzinfo=timezone.utc)
    df = spark.createDataFrame([(utc_text(since),), ("2024-11-03 06:29:59",)], "at string")
    former = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert [r["at"] for r in watermark_slice(df, "at", since).collect()] == ["2024-11-03 06:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", former)


def test_a_context_starts_as_the_sessions_user(spark):
    ctx = RunContext.start(spark, "b1")
    assert ctx.user == spark.sql("SELECT current_user()").first()[0] and ctx.batch_id == "b1"
    assert abs(ctx.ts - datetime.now(timezone.utc)) < timedelta(minutes=1)


def test_footers_tell_the_newest_timestamp_or_that_they_do_not(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    noon = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    stamps = [noon, None, noon + timedelta(microseconds=7), noon - timedelta(days=400)]
    us = 1_714_564_800_000_000

    def write(name, kind, values, **options):
        pq.write_table(pa.table({"Id": pa.array(range(len(values))), "LastModified": pa.array(values, kind)}), tmp_path / name, **options)

    write("a b.parquet", pa.timestamp("us", "UTC"), stamps, row_group_size=1)
    write("milli.parquet", pa.timestamp("ms", "UTC"), [noon, noon + timedelta(milliseconds=3)])
    write("null.parquet", pa.timestamp("us", "UTC"), [None, None])
    write("empty.parquet", pa.timestamp("us", "UTC"), [])
    write("bare.parquet", pa.timestamp("us", "UTC"), stamps, write_statistics=False)
    write("local.parquet", pa.timestamp("us"), [datetime(2024, 5, 1)])
    write("text.parquet", pa.string(), ["2024-05-01 12:00:00"])
    write("old.parquet", pa.timestamp("us", "UTC"), stamps, use_deprecated_int96_timestamps=True)
    pq.write_table(pa.table({"Id": [1]}), tmp_path / "without.parquet")
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 no file PAR1")
    found = {r["file"]: (r["known"], r["file_us"]) for r in footer_stamps(spark, str(tmp_path), "lastmodified").collect()}
    assert found == {
        "a%20b.parquet": (True, us + 7),
        "milli.parquet": (True, us + 3000),
        **{f"{name}.parquet": (True, None) for name in ("null", "empty", "without")},
        **{f"{name}.parquet": (False, None) for name in ("bare", "local", "text", "old", "broken")},
    }
    scanned = file_stamps(read_drop(spark, str(tmp_path), ["a%20b.parquet", "milli.parquet"]), "LastModified").collect()
    assert {r["file"]: (True, r["file_us"]) for r in scanned} == {f: found[f] for f in ("a%20b.parquet", "milli.parquet")}
    (tmp_path / "none").mkdir()
    assert footer_stamps(spark, str(tmp_path / "none"), "lastmodified").count() == 0
