from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from masterloom.context import RunContext
from masterloom.operators import changed_keys, with_row_hash
from masterloom.operators.schema import SchemaDriftError, string_schema, wider_type
from masterloom.sources import keep_newest, read_evolved, tables, watermark_slice, widen_table
from masterloom.sources.tables import DuplicateKeyError, ensure_table, key_range, key_ranges, merge_table, rows_of_keys, staged

CTX = RunContext("etl", datetime(2024, 5, 1, 10, 0, tzinfo=timezone.utc), "b1")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_adds_columns_and_fills_missing(spark, database):
    name = f"{database}.bronze"
    first = spark.createDataFrame([("1", "x")], "id string, a string")
    second = spark.createDataFrame([("2", 7)], "id string, b int")
    tables.append_evolving(first.withColumn("batch_id", F.lit("f-1")), name, "f-1")
    tables.append_evolving(second.withColumn("batch_id", F.lit("it's 2")), name, "it's 2")
    table = spark.table(name)
    assert table.columns == ["id", "a", "b", "batch_id"]
    assert rows(table.select("id", "a", F.coalesce("b", F.lit(0)), "batch_id")) == [
        ("1", "x", 0, "f-1"),
        ("2", None, 7, "it's 2"),
    ]


def test_append_of_the_same_load_adds_no_second_copy(spark, database):
    name = f"{database}.bronze"
    load = spark.createDataFrame([("1", "f"), ("2", "f")], "id string, batch_id string")
    other = spark.createDataFrame([("9", "g")], "id string, batch_id string")
    tables.append_evolving(load, name, "f")
    tables.append_evolving(other, name, "g")
    tables.append_evolving(load, name, "f")
    assert rows(spark.table(name)) == [("1", "f"), ("2", "f"), ("9", "g")]


def test_batch_slice_reads_one_partition(spark, database):
    name = f"{database}.bronze"
    for batch in ("f", "g", "h"):
        load = spark.createDataFrame([("1", batch)], "id string, batch_id string")
        tables.append_evolving(load, name, batch)
    one = spark.table(name).filter(F.col("batch_id") == "g")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_ensure_table_keeps_an_existing_one(spark, database):
    name = f"{database}.gold"
    tables.ensure_table(spark, name, string_schema(["Code", "Name"]))
    tables.ensure_table(spark, name, string_schema(["Other"]))
    assert spark.table(name).columns == ["Code", "Name"]


@pytest.mark.parametrize("buckets", [0, 3])
def test_merge_table_twice(spark, database, buckets):
    name = f"{database}.gold"
    schema = string_schema(["Code", "Name", "Owner", "Chg"])
    tables.ensure_table(spark, name, schema, bucket_by=["Code"], buckets=buckets)
    first = spark.createDataFrame([("a", "A"), ("b", "B")], "code string, name string")
    second = spark.createDataFrame([("b", "B2"), ("c", "C")], "code string, name string")
    stamp = {"chg": F.lit("1")}
    assert tables.merge_table(first, name, ["code"], stamp, {**stamp, "owner": F.lit("me")}) == 2
    assert tables.merge_table(second, name, ["code"], {"chg": F.lit("2")}, {"chg": F.lit("2")}) == 2
    assert rows(spark.table(name)) == [
        ("a", "A", "me", "1"),
        ("b", "B2", "me", "2"),
        ("c", "C", None, "2"),
    ]
    assert spark.table(name).schema == schema


def test_former_contents_stay_until_the_next_replacement(spark, database):
    name = f"{database}.gold"
    tables.ensure_table(spark, name, string_schema(["Code", "Name"]))
    seen = []
    for value in "123":
        batch = spark.createDataFrame([("a", value)], "Code string, Name string")
        tables.merge_table(batch, name, ["Code"])
        seen.append(spark.table(name).inputFiles()[0])
    exists = [Path(f.removeprefix("file://")).exists() for f in seen]
    assert exists == [False, True, True]
    assert rows(spark.table(name)) == [("a", "3")]


def test_merge_table_rejects_repeated_and_null_keys(spark, database):
    name = f"{database}.gold"
    tables.ensure_table(spark, name, string_schema(["Code", "Name"]))
    for bad in ([("a", "1"), ("a", "2")], [(None, "1")]):
        source = spark.createDataFrame(bad, "Code string, Name string")
        with pytest.raises(DuplicateKeyError):
            tables.merge_table(source, name, ["Code"])
    assert spark.table(name).isEmpty()


def test_merge_of_an_empty_batch_changes_nothing(spark, database):
    name = f"{database}.gold"
    tables.ensure_table(spark, name, string_schema(["Code", "Name"]))
    tables.merge_table(spark.createDataFrame([("a", "1")], "Code string, Name string"), name, ["Code"])
    before = spark.table(name).inputFiles()
    empty = spark.createDataFrame([], "Code string, Name string")
    assert tables.merge_table(empty, name, ["Code"]) == 0
    assert spark.table(name).inputFiles() == before


def test_bucketed_target_is_not_shuffled(spark, database):
    from masterloom.operators.upsert import upsert

    name = f"{database}.gold"
    tables.ensure_table(
        spark, name, string_schema(["Code", "Name"]), bucket_by=["Code"], buckets=4
    )
    seed = spark.range(1000).select(F.col("id").cast("string").alias("Code"), F.lit("n").alias("Name"))
    tables.merge_table(seed, name, ["Code"])
    batch = seed.limit(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = upsert(spark.table(name), batch, ["Code"])
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert result.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    target_scans = [line for line in plan.splitlines() if "Bucketed: true" in line]
    assert target_scans
    # One exchange for each use of the batch and none above a target scan.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Bucketed: true" in line:
            above = next(l for l in reversed(lines[:i]) if "Exchange" in l or "SortMergeJoin" in l)
            assert "SortMergeJoin" in above


@pytest.mark.parametrize("as_text", [False, True])
def test_a_slice_of_changed_rows_skips_untouched_files(spark, database, as_text):
    name = f"{database}.silver"

    def at(day):
        moment = F.lit(datetime(2024, 5, day, tzinfo=timezone.utc))
        return {"Chg": moment.cast("string") if as_text else moment}

    rows_ = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("Code"))
    schema = rows_.withColumns(at(1)).schema
    tables.ensure_table(spark, name, schema)
    tables.merge_table(rows_, name, ["Code"], at(1), at(1))
    tables.merge_table(rows_.limit(10), name, ["Code"], at(20), at(20))
    since = datetime(2024, 5, 20, tzinfo=timezone.utc)
    changed = watermark_slice(spark.table(name), "Chg", since).select("Code")
    assert len(changed.collect()) == 10
    scan = changed._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() == 10
    assert spark.table(name).count() == 5000


def test_staged_rows_live_in_the_shared_folder(spark):
    with tables.staged(spark.range(5), "probe") as rows_:
        assert rows_.count() == 5
        files = rows_.inputFiles()
        assert all("/checkpoint/masterloom/probe-" in f for f in files)
    assert not any(Path(f.removeprefix("file://")).exists() for f in files)


def test_row_level_merge_is_well_formed(spark, database):
    """No catalog here merges rows; the statement gets as far as being refused for that."""
    name = f"{database}.gold"
    tables.ensure_table(spark, name, string_schema(["Code", "Name", "Chg"]))
    source = spark.createDataFrame([("a", "A")], "Code string, Name string")
    for only_if_changed in (False, True):
        with pytest.raises(UnsupportedOperationException) as refused:
            stamp = {"Chg": F.lit("1")}
            tables.merge_rows(source, name, ["Code"], stamp, stamp, only_if_changed)
        assert refused.value.getCondition().startswith("UNSUPPORTED_FEATURE")
    assert tables.table_provider(spark, name) == "parquet"


def test_a_load_that_the_table_cannot_hold_is_refused(spark, database):
    name = f"{database}.bronze"
    first = spark.createDataFrame([("1", 2, "f-1")], "id string, n int, batch_id string")
    tables.append_evolving(first, name, "f-1")
    with pytest.raises(SchemaDriftError, match="n: double to int"):
        tables.append_evolving(spark.createDataFrame([("2", 2.75, "f-2")], "id string, n double, batch_id string"), name, "f-2")
    assert rows(spark.table(name)) == [("1", 2, "f-1")]
    with pytest.raises(SchemaDriftError):
        source = spark.createDataFrame([("1", 2.75)], "id string, n double")
        tables.merge_table(source, _table(spark, database, "narrow", "id string, n int", [("1", 2)]), ["id"])


def test_a_wider_type_goes_on_in_a_further_column(spark, database):
    name = f"{database}.bronze"

    def load(batch, schema, values, **options):
        df = spark.createDataFrame([(*v, batch) for v in values], f"{schema}, batch_id string")
        tables.append_evolving(df, name, batch, widen=True)

    load("f-1", "id string, n int", [("1", 2), ("2", None)])
    files = set(spark.table(name).inputFiles())
    assert read_evolved(spark, name).columns == ["id", "n", "batch_id"]
    load("f-2", "id string, N double", [("3", 2.75)])
    load("f-3", "id string, n long, extra date", [("4", 1 << 60, None)])
    load("f-3", "id string, n long, extra date", [("4", 1 << 60, None)])  # loaded again
    load("f-4", "id string, n int", [("5", 9)])
    load("f-5", "id string", [("6",)])
    found = read_evolved(spark, name)
    assert found.columns == ["id", "n", "extra", "batch_id"] and found.schema["n"].dataType.simpleString() == "string"
    assert rows(found.select("id", F.coalesce("n", F.lit("-")), "batch_id")) == [
        ("1", "2", "f-1"), ("2", "-", "f-1"), ("3", "2.75", "f-2"), ("4", str(1 << 60), "f-3"), ("5", "9", "f-4"), ("6", "-", "f-5"),
    ]
    assert files <= set(spark.table(name).inputFiles())
    with pytest.raises(SchemaDriftError, match="no type holds"):
        load("f-6", "id string, n array<int>", [("7", [1])])


def test_a_load_that_dies_before_its_wider_column_is_there_finds_its_plan(spark, database):
    name = f"{database}.bronze"
    tables.append_evolving(spark.createDataFrame([("1", 2, "f-1")], "id string, n int, batch_id string"), name, "f-1")
    wide = spark.createDataFrame([("2", 2.75, "f-2")], "id string, n double, batch_id string")
    tables._into_versions(wide.drop("batch_id"), name)
    assert rows(read_evolved(spark, name)) == [("1", 2.0, "f-1")]
    tables.append_evolving(wide, name, "f-2", widen=True)
    assert rows(read_evolved(spark, name)) == [("1", 2.0, "f-1"), ("2", 2.75, "f-2")]
    assert len(spark.table(name).columns) == 4


@pytest.mark.parametrize(
    "first, second, wide",
    [
        ("int", "bigint", "bigint"), ("double", "int", "double"), ("int", "float", "double"), ("bigint", "double", "string"),
        ("decimal(10,2)", "bigint", "decimal(21,2)"), ("decimal(38,0)", "decimal(38,9)", "string"), ("date", "timestamp", "timestamp"),
        ("date", "int", "string"), ("void", "int", "int"), ("array<int>", "array<int>", "array<int>"),
    ],
)
def test_wider_types(first, second, wide):
    a, b = (StructType.fromDDL(f"x {t}")["x"].dataType for t in (first, second))
    assert wider_type(a, b).simpleString() == wide == wider_type(b, a).simpleString()


@pytest.mark.parametrize("layout", [{}, {"buckets": 4}, {"ranges": 4}, {"partition_by": ["kind"]}])
def test_a_merged_table_takes_wider_types_in_its_layout(spark, database, layout):
    by = {} if "partition_by" in layout else {"bucket_by": ["id"]}
    name, schema = f"{database}.current", "id string, n int, kind string"
    before = spark.createDataFrame([("1", 2, "a"), ("2", None, "b")], schema)
    ensure_table(spark, name, before.schema, **layout, **by)
    with staged(before, "batch") as batch:
        merge_table(batch, name, ["id"])
    assert not widen_table(spark, name, before.schema)
    batch = spark.createDataFrame([("2", 2.5, "a")], "id string, n double, kind string")
    assert widen_table(spark, name, batch.schema)
    if not layout:  # dies after the old table is given up
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__widened")
        assert widen_table(spark, name, batch.schema)
    merge_table(batch, name, ["id"])
    assert rows(spark.table(name).select("id", "n", "kind")) == [("1", 2.0, "a"), ("2", 2.5, "a")]
    assert (key_ranges(spark, name) or (0,))[0] == layout.get("ranges", 0)
    assert [c.name for c in spark.catalog.listColumns(name) if c.isBucket] == (["id"] if "buckets" in layout else [])
    assert not spark.catalog.tableExists(f"{name}__widened")


def test_changes_are_told_by_key_and_hash_alone(spark, database):
    name, schema = f"{database}.hashed", "code string, status string, n int, at timestamp"
    at = datetime(2024, 5, 1, tzinfo=timezone.utc)
    ensure_table(spark, name, StructType.fromDDL(f"{schema}, row_hash string"))
    target = lambda: spark.table(name)
    values = [("a", "x", None, at), ("b", None, 1, at), ("c", "1", 1, None)]
    hashed = with_row_hash(spark.createDataFrame(values, schema), target().schema, ["code"], "row_hash")
    assert hashed.select("row_hash").distinct().count() == 3
    with staged(hashed, "batch") as batch:
        merge_table(batch, name, ["code"])
    again = [("a", None, "x", at), ("b", None, "1", at), ("c", "1", "2", None), ("d", None, None, None)]
    moved = spark.createDataFrame(again, "CODE string, n string, status string, at timestamp").selectExpr("at", "status", "CAST(n AS int) AS N", "CODE")
    batch = with_row_hash(moved, target().schema, ["code"], "row_hash")
    changed = changed_keys(target(), batch, ["code"], row_hash="row_hash")
    assert [r["code"] for r in changed.orderBy("code").collect()] == ["b", "c", "d"]
    plan = changed._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and all(line.split("ReadSchema: ")[1].startswith("struct<code:string,row_hash:string>") for line in scans if "hashed" in line)


def _table(spark, database, label, schema, values, **layout):
    name = f"{database}.{label}"
    df = spark.createDataFrame(values, schema)
    tables.ensure_table(spark, name, df.schema, **layout)
    df.select(*spark.table(name).columns).write.insertInto(name)
    return name


def test_merge_writes_only_touched_partitions(spark, database):
    values = [(str(i), f"p{i % 4}", i) for i in range(40)] + [("n", None, 1)]
    name = _table(spark, database, "parts", "id string, part string, n int", values, partition_by=["part"])

    def files():
        return {r["f"] for r in spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()}

    before = files()
    # A key stays in its partition, one moves, one is new in a new partition.
    batch = spark.createDataFrame([("0", "p0", 100), ("4", "p1", 104), ("new", "p9", 1)], "id string, part string, n int")
    tables.merge_table(batch, name, ["id"])
    got = {r["id"]: (r["part"], r["n"]) for r in spark.table(name).collect()}
    want = {i: (p, n) for i, p, n in values} | {"0": ("p0", 100), "4": ("p1", 104), "new": ("p9", 1)}
    assert got == want and spark.table(name).count() == 42
    untouched = {f for f in before if "part=p2" in f or "part=p3" in f or "HIVE_DEFAULT" in f}
    assert untouched and untouched <= files()
    # The last rows leave a partition; a batch without the partition column keeps it.
    tables.merge_table(spark.createDataFrame([("new", "p0", 2)], "id string, part string, n int"), name, ["id"])
    assert spark.table(name).filter("part = 'p9'").isEmpty()
    tables.merge_table(spark.createDataFrame([("1", -1), ("later", 5)], "id string, n int"), name, ["id"])
    found = {r["id"]: (r["part"], r["n"]) for r in spark.table(name).collect()}
    assert found["1"] == ("p1", -1) and found["later"] == (None, 5) and found["n"] == (None, 1)


def test_merge_into_orc_and_refusal_of_other_formats(spark, database):
    name = _table(spark, database, "orcs", "id string, n int", [("1", 1), ("2", 2)], provider="orc")
    tables.merge_table(spark.createDataFrame([("2", 20), ("3", 30)], "id string, n int"), name, ["id"])
    assert rows(spark.table(name)) == [("1", 1), ("2", 20), ("3", 30)]
    name = _table(spark, database, "texts", "id string, n int", [("1", 1)], provider="csv")
    with pytest.raises(ValueError, match="csv table"):
        tables.merge_table(spark.createDataFrame([("1", 2)], "id string, n int"), name, ["id"])
    assert rows(spark.table(name)) == [("1", 1)]


def test_a_bucketed_merge_writes_few_files(spark, database):
    values = [(str(i), i) for i in range(2000)]
    name = _table(spark, database, "buckets", "id string, n int", values, bucket_by=["id"], buckets=16)
    batch = spark.createDataFrame([(str(i), -i) for i in range(0, 4000, 3)], "id string, n int").repartition(8)
    tables.merge_table(batch, name, ["id"])
    assert spark.table(name).select(F.input_file_name()).distinct().count() <= 32
    assert spark.table(name).count() == len({str(i) for i in range(2000)} | {str(i) for i in range(0, 4000, 3)})


def test_a_small_batch_touches_its_own_ranges_only(spark, database):
    name = f"{database}.ranged"
    rows = spark.range(2000).select(F.col("id").alias("code"), F.lit("old").alias("status"))
    ensure_table(spark, name, rows.schema, bucket_by=["code"], ranges=64)
    for batch in (rows, rows.filter("code % 200 = 7").withColumn("status", F.lit("new"))):
        files = {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}
        with staged(batch, "batch") as source:
            merge_table(source, name, ["code"])
    after = spark.table(name)
    assert after.columns == ["code", "status", "key_range"]
    left = {r[0] for r in after.select("_metadata.file_path").distinct().collect()} & files
    kept = {f.split("key_range=")[1].split("/")[0] for f in left}
    written = {r[0] for r in after.select("key_range").distinct().collect()} - set(map(int, kept))
    assert 1 <= len(written) <= 10
    assert {r[0] for r in after.filter("status = 'new'").select("code").collect()} == set(range(7, 2000, 200))
    assert after.count() == 2000
    assert after.filter(F.col("key_range") != key_range(["code"], 64)).isEmpty()


def test_rows_of_keys_reads_their_ranges(spark, database):
    name = f"{database}.ranged_read"
    rows = spark.range(500).select(F.col("id").alias("code"), F.lit("x").alias("status"))
    ensure_table(spark, name, rows.schema, bucket_by=["code"], ranges=32)
    with staged(rows, "batch") as source:
        merge_table(source, name, ["code"])
    found = rows_of_keys(spark, name, spark.createDataFrame([(3,), (499,), (900,)], "code long"))
    assert sorted(r["code"] for r in found.collect()) == [3, 499]
    assert "PartitionFilters: [" in found._jdf.queryExecution().toString() and len(found.inputFiles()) <= 3 * 8


@pytest.mark.parametrize("ranges", [0, 4])
def test_newest_rows_are_kept_whatever_the_order_of_loads(spark, database, ranges):
    history = [
        [("a", "first", 1, 1), ("b", "only", 5, 1), (None, "no key", 9, 9), ("a", "tie", 3, 1)],
        [("a", "tie too", 3, 1), ("c", None, 2, 2), ("c", "older", 1, 9)],
        [("a", "stale", 2, 8), ("b", None, None, None)],
    ]
    loads = [spark.createDataFrame(load, "id string, name string, at int, seen int") for load in history]
    for number, order in enumerate(((0, 1, 2), (2, 1, 0), (1, 0, 1, 2, 0))):
        name = f"{database}.newest{number}"
        for n in order:
            keep_newest(loads[n], name, "id", ["name"], ["at", "seen"], ranges)
        kept = spark.table(name).select("id", "name", "at", "seen")
        assert sorted(map(tuple, kept.collect())) == [("a", "tie too", 3, 1), ("b", "only", 5, 1), ("c", None, 2, 2)]
    keep_newest(loads[0].limit(0), f"{database}.none", "id", ["name"], ["at", "seen"], ranges)
    assert spark.table(f"{database}.none").isEmpty()


def test_a_load_rewrites_only_its_keys_ranges(spark, database):
    name = f"{database}.newest"
    keep_newest(spark.range(1000).selectExpr("id", "id AS name", "1 AS at"), name, "id", ["name"], ["at"], ranges=50)
    before = set(spark.table(name).inputFiles())
    keep_newest(spark.createDataFrame([(7, 70, 2), (8, 80, 0)], "id long, name long, at int"), name, "id", ["name"], ["at"], ranges=50)
    table = spark.table(name)
    assert len(set(table.inputFiles()) - before) <= 2 * 8
    assert [tuple(r) for r in table.filter("id IN (7, 8)").select("id", "name").orderBy("id").collect()] == [(7, 70), (8, 8)]


# --- many rows


def ranged_table(spark, name, keys, ranges=4):
    ensure_table(spark, name, string_schema(["Code", "Name", "Owner"]), bucket_by=["Code"], ranges=ranges)
    return tables.merge_table(named(spark, keys, "old"), name, ["Code"], {}, {"Owner": F.lit("me")})


def named(spark, keys, text):
    return spark.createDataFrame([(f"k{k}", f"{text} {k}") for k in keys], "Code string, Name string")


def held(spark, name):
    return rows(spark.table(name).select("Code", "Name", "Owner"))


def test_a_batch_of_new_keys_leaves_the_files_of_others_alone(spark, database):
    name = f"{database}.gold"
    ranged_table(spark, name, range(40))
    before = set(spark.table(name).inputFiles())
    new = named(spark, range(40, 80), "new")
    merge_table(new, name, ["Code"], {}, {"Owner": F.lit("you")})
    want = sorted([(f"k{k}", f"old {k}", "me") for k in range(40)] + [(f"k{k}", f"new {k}", "you") for k in range(40, 80)])
    assert held(spark, name) == want
    assert before < set(spark.table(name).inputFiles())
    # A load that died when part of its rows were there is merged again.
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (key_range = 0)")
    merge_table(named(spark, range(40), "old"), name, ["Code"], {}, {"Owner": F.lit("me")})
    merge_table(new, name, ["Code"], {}, {"Owner": F.lit("you")})
    assert held(spark, name) == want


@pytest.mark.parametrize("open_files", [0, 16])
def test_many_rows_are_not_written_twice(spark, database, monkeypatch, open_files):
    name, labels, real = f"{database}.gold", [], tables.staged
    monkeypatch.setattr(tables, "ROWS_PER_PARTITION", 10)
    monkeypatch.setattr(tables, "MAX_BROADCAST_ROWS", 10)
    monkeypatch.setattr(tables, "OPEN_FILES", open_files)
    monkeypatch.setattr(tables, "staged", lambda df, label: labels.append(label) or real(df, label))
    ranged_table(spark, name, range(2000), ranges=8)
    # Ranges and files go by hashes of the same keys: one must not follow from the other.
    assert len(spark.table(name).inputFiles()) > 8
    batch = named(spark, range(1500, 2500), "new")
    changed = changed_keys(spark.table(name), batch, ["Code"], partitions=5)
    assert rows(changed) == sorted((f"k{k}",) for k in range(1500, 2500))
    merge_table(batch, name, ["Code"], {}, {"Owner": F.lit("you")})
    want = [(f"k{k}", f"old {k}", "me") for k in range(1500)]
    want += [(f"k{k}", f"new {k}", "me" if k < 2000 else "you") for k in range(1500, 2500)]
    assert held(spark, name) == sorted(want)
    assert labels == []


def test_rows_of_all_keys_are_not_joined(spark):
    wide = spark.createDataFrame([(f"k{k}", k) for k in range(50)], "Code string, n int")
    keys = wide.select("Code")
    every, some = tables.of_keys(wide, keys.unionAll(keys)), tables.of_keys(wide, keys.filter("Code > 'k4'"))
    assert rows(every) == rows(wide) and "Join" not in every._jdf.queryExecution().optimizedPlan().toString()
    assert rows(some) == rows(wide.filter("Code > 'k4'"))
