"""Table operators on literal rows, and their properties."""

from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from masterloom.context import RunContext
from masterloom.operators import (
    Reference,
    apply_mapping,
    check_foreign,
    conform,
    enrich_reference,
    fits_broadcast,
    frequent_keys,
    key_profile,
    lookup_join,
    merged_schema,
    partitions_of,
    reject_blank_keys,
    sanitized_names,
    schema_drift,
    spread,
    standardize_phones,
    string_schema,
    upsert,
)
from masterloom.operators.phones import dial_heads

QUICK = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rows(df, *columns):
    found = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in found.collect()), key=repr)


# ---- names and schemas ----


def test_sanitized_names():
    given_names = ["Hotel_Brand__c", "HOTEL BRAND C", "hotelbrandc", "!!", "é", "Id"]
    want = ["hotelbrandc", "hotelbrandc_2", "hotelbrandc_3", "col_4", "col_5", "id"]
    assert sanitized_names(given_names) == want


@given(st.lists(st.text(max_size=6), max_size=20))
def test_sanitized_names_are_unique_and_never_empty(names):
    out = sanitized_names(names)
    assert len(set(out)) == len(names) and all(out)


def test_conform_orders_casts_and_fills(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "CODE int, name string, extra double")
    out = conform(df, string_schema(["Name", "Code", "Absent"]))
    assert out.columns == ["Name", "Code", "Absent"]
    assert rows(out) == [("x", "1", None)]
    drift = schema_drift(df, string_schema(["Name", "Code", "Absent"]))
    assert drift == {"missing": ["Absent"], "extra": ["extra"]}


def test_merged_schema_keeps_known_types(spark):
    old = spark.createDataFrame([], "id string, a int").schema
    new = spark.createDataFrame([], "A string, b double, ID string").schema
    assert merged_schema(old, new).simpleString() == "struct<id:string,a:int,b:double>"


def test_apply_mapping(spark):
    df = spark.createDataFrame([(1, "x")], "id int, `odd name` string")
    out = apply_mapping(df, [("A", "odd name"), ("B", "odd name"), ("C", "id")], {"S": 5}, cast="string")
    assert out.columns == ["A", "B", "C", "S"] and rows(out) == [("x", "x", "1", "5")]


def test_run_context_needs_a_time_zone():
    with pytest.raises(ValueError):
        RunContext("etl", datetime(2024, 5, 1))
    RunContext("etl", datetime(2024, 5, 1, tzinfo=timezone.utc))


# ---- lookups ----


@pytest.fixture
def hotels(spark):
    data = [("h1", "b1"), ("h2", "b9"), ("h3", None), ("h4", "b1"), ("h5", "b2")]
    return spark.createDataFrame(data, "hotel string, brand string")


@pytest.mark.parametrize("broadcast", [None, True, False])
def test_lookup_join_takes_the_newest_and_keeps_rows(spark, hotels, broadcast):
    brands = spark.createDataFrame(
        [("b1", "Old", 1), ("b1", "New", 2), ("b2", "Same", 1), ("b2", "Tie", 1), (None, "No key", 9)],
        "id string, name string, changed int",
    )
    out = lookup_join(hotels, brands, ("brand", "id"), {"brandname": "name"}, ["changed"], broadcast)
    assert out.columns == ["hotel", "brand", "brandname"]
    want = [("h1", "New"), ("h2", None), ("h3", None), ("h4", "New"), ("h5", "Tie")]
    assert rows(out, "hotel", "brandname") == want


def test_lookup_columns_may_share_names_with_the_table(spark, hotels):
    brands = spark.createDataFrame([("b1", "x", 1)], "brand string, hotel string, changed int")
    out = lookup_join(hotels, brands, ("brand", "brand"), {"owner": "hotel"}, ["changed"])
    assert ("h1", "x") in rows(out, "hotel", "owner")


keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


@QUICK
@given(st.lists(keys, max_size=8), st.lists(st.tuples(keys, st.integers(0, 3)), max_size=8), st.booleans())
def test_lookup_join_never_changes_the_row_count(spark, left, right, broadcast):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(left)], "i int, k string")
    dim = spark.createDataFrame(right, "k string, v int")
    out = lookup_join(df, dim, ("k", "k"), {"best": "v"}, ["v"], broadcast)
    best = {k: max(v for k2, v in right if k2 == k) for k, _ in right if k is not None}
    assert sorted(r["i"] for r in out.collect()) == list(range(len(left)))
    assert all(r["best"] == best.get(r["k"]) for r in out.collect())


@pytest.mark.parametrize("broadcast", [None, False])
def test_enrich_reference_folds_keys(spark, broadcast):
    df = spark.createDataFrame([(1, " usa"), (2, "GBR"), (3, "??"), (4, " "), (5, None)], "i int, c string")
    country = spark.createDataFrame(
        [("USA", "US"), ("gbr ", "GB"), ("GBR", "UK"), (" ", "blank"), (None, "null")], "iso3 string, iso2 string"
    )
    out = enrich_reference(df, {"c": Reference(country, "iso3", ["iso2"])}, broadcast)
    assert rows(out, "i", "iso2") == [(1, "US"), (2, "UK"), (3, None), (4, None), (5, None)]


def test_fits_broadcast_counts_rows_and_bytes(spark):
    small = spark.createDataFrame([("x" * 10,)] * 5, "v string")
    assert fits_broadcast(small, small.limit(0)) == [True, True]
    assert fits_broadcast(small, max_rows=4) == [False]
    assert fits_broadcast(small, max_bytes=49) == [False]
    assert fits_broadcast(small, max_bytes=50) == [True]


def test_a_large_lookup_side_is_not_broadcast(spark, hotels, monkeypatch):
    from masterloom.operators import lookup

    monkeypatch.setattr(lookup, "fits_broadcast", lambda *tables, **_: [False] * len(tables))
    brands = spark.createDataFrame([("b1", "New", 2)], "id string, name string, changed int")
    out = lookup_join(hotels, brands, ("brand", "id"), {"brandname": "name"}, ["changed"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Only the frequent keys, which are few, are broadcast; the lookup side is merged.
    assert "strategy=merge" in plan and "__salt" in plan
    assert plan.count("strategy=broadcast") == 2
    assert rows(out, "hotel", "brandname")[0] == ("h1", "New")


def test_frequent_keys(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    df = spark.range(0, 9000, numPartitions=7).select(key.alias("k"))
    assert [r["hot"] for r in frequent_keys(df, F.col("k"), 100).collect()] == ["hot"]
    assert frequent_keys(df.limit(0), F.col("k"), 100).isEmpty()


def test_every_one_of_many_hot_keys_is_found(spark):
    df = spark.range(0, 60_000).select((F.col("id") % 300).alias("k"))
    assert frequent_keys(df, F.col("k"), 20_000).count() == 300


def test_one_key_is_spread_over_all_partitions(spark):
    hot = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 != 1, F.concat(F.lit("k"), F.col("id").cast("string")))
    df = spark.range(4000).select("id", hot.alias("k"))
    dim = spark.createDataFrame([("hot", 1), ("k3", 3)], "k string, v int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = lookup_join(df, dim, ("k", "k"), {"v": "v"}, ["v"], broadcast=False, salts=64)
        sizes = out.filter("v = 1").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 2000
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out.count() == 4000 and out.filter("v = 3").count() == 1


def test_standardize_phones(spark):
    df = spark.createDataFrame(
        [(1, "us", "617 555 1234", None), (2, None, "617 555 1234", "x"), (3, "ZZ", "1", "2")],
        "i int, region string, phone string, desk string",
    )
    plan = spark.createDataFrame(
        [("US", "1", "1", 10, 10)],
        "region string, country_code string, trunk_prefix string, min_len int, max_len int",
    )
    out = standardize_phones(df, {"main": "phone", "front": "desk"}, "region", plan, drop_raw=True)
    assert out.columns == ["i", "region", "main", "front"]
    assert rows(out, "i", "main", "front") == [(1, "+16175551234", None), (2, None, None), (3, None, None)]


# ---- upsert ----


def target(spark, data):
    return spark.createDataFrame(data, "Code string, Name string, Note string, Chg int, New int")


def merge(spark, old, batch, stamp=1, **options):
    source = spark.createDataFrame(batch, "code string, name string")
    at = F.lit(stamp)
    return upsert(target(spark, old), source, ["CODE"], {"chg": at}, {"chg": at, "new": at}, **options)


@pytest.mark.parametrize("broadcast_keys", [True, False])
def test_upsert_known_new_and_untouched(spark, broadcast_keys):
    old = [("a", "A", "n", 0, 0), ("b", "B", "m", 0, 0)]
    out = merge(spark, old, [("b", "B2"), ("c", "C")], broadcast_keys=broadcast_keys)
    assert out.columns == ["Code", "Name", "Note", "Chg", "New"]
    assert rows(out) == [("a", "A", "n", 0, 0), ("b", "B2", "m", 1, 0), ("c", "C", None, 1, 1)]


def test_upsert_in_as_many_partitions_as_the_rows_need(spark):
    old = [(f"k{i}", "A", "n", 0, 0) for i in range(50)]
    batch = [(f"k{i}", f"B{i}") for i in range(25, 75)]
    out = merge(spark, old, batch, partitions=7)
    assert rows(out) == rows(merge(spark, old, batch))
    # Both sides are dealt to seven tasks, whatever the session's number is.
    assert "REPARTITION_BY_NUM" in (plan := out._jdf.queryExecution().sparkPlan().toString()) and ", 7)" in plan


def test_rows_of_one_file_are_spread_by_their_number(spark):
    one = spark.range(1000).coalesce(1).withColumn("text", F.lit("same"))
    even = spread(one)
    assert even.rdd.getNumPartitions() == partitions_of(spark, 1000) == spark.sparkContext.defaultParallelism
    assert rows(even) == rows(one) and min(r["n"] for r in even.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) > 100
    assert partitions_of(spark, 54_000_000) == 540


def test_even_partitions_stay_where_they_are(spark):
    cores = spark.sparkContext.defaultParallelism
    for parts, moved in ((2 * cores, False), (cores - 1, True)):
        out = spread(spark.range(0, 1000, 1, parts))
        assert ("Exchange" in out._jdf.queryExecution().executedPlan().toString()) == moved
    # None is idle while the last ones are worked on.
    assert all(partitions_of(spark, n) % cores == 0 for n in (1, 100_001 * cores, 54_100_000))


def test_upsert_with_empty_sides(spark):
    old = [("a", "A", "n", 0, 0)]
    assert rows(merge(spark, old, [])) == old
    assert rows(merge(spark, [], [("a", "A")])) == [("a", "A", None, 1, 1)]


def test_upsert_only_if_changed(spark):
    old = [("a", "A", "n", 0, 0), ("b", None, "m", 0, 0)]
    out = merge(spark, old, [("a", "A"), ("b", "B")], only_if_changed=True)
    assert rows(out) == [("a", "A", "n", 0, 0), ("b", "B", "m", 1, 0)]


def test_upsert_refuses_columns_the_target_lacks(spark):
    source = spark.createDataFrame([("a", 1)], "code string, other int")
    with pytest.raises(ValueError, match="other"):
        upsert(target(spark, []), source, ["code"])


names = st.dictionaries(st.sampled_from("abcdef"), st.sampled_from("xyz"), max_size=5)


@QUICK
@given(names, names, st.booleans())
def test_upsert_is_a_dictionary_update(spark, old, batch, only_if_changed):
    table = [(k, v, "n" + k, 0, 0) for k, v in old.items()]
    out = merge(spark, table, list(batch.items()), only_if_changed=only_if_changed)
    found = {r["Code"]: r for r in out.collect()}
    assert out.count() == len(found)
    assert {k: r["Name"] for k, r in found.items()} == {**old, **batch}
    for key, row in found.items():
        changed = key in batch and not (only_if_changed and old.get(key) == batch[key])
        assert row["Chg"] == (1 if changed else 0)
        assert row["Note"] == ("n" + key if key in old else None)
        assert row["New"] == (0 if key in old else 1)


@QUICK
@given(names, names)
def test_upsert_twice_changes_only_the_stamp(spark, old, batch):
    table = [(k, v, "n", 0, 0) for k, v in old.items()]
    once = merge(spark, table, list(batch.items()))
    source = spark.createDataFrame(list(batch.items()), "code string, name string")
    again = upsert(once, source, ["code"], {"chg": F.lit(2)}, {"chg": F.lit(2), "new": F.lit(2)})
    plain = ["Code", "Name", "Note", "New"]
    assert rows(once, *plain) == rows(again, *plain)


def test_reject_blank_keys(spark):
    df = spark.createDataFrame([("a",), ("",), ("  ",), (None,)], "k string")
    good, rejects = reject_blank_keys(df, ["k"])
    assert rows(good) == [("a",)] and rejects.count() == 3


def test_key_profile(spark):
    df = spark.createDataFrame([("aa",), ("aa",), ("b",)], "k string")
    assert tuple(key_profile(df, ["k"])) == (3, 2, 2, 3)
    assert tuple(key_profile(df.limit(0), ["k"])) == (0, 0, 0, 0)


def test_foreign_numbers_fit_the_longest_code(spark):
    plan = spark.createDataFrame(
        [("US", "1", 10, 10), ("CA", "1", 10, 10), ("BS", "1242", 7, 7), ("GB", "44", 9, 10), ("DE", "49", 7, 11), ("XX", None, 1, 1)],
        "region string, country_code string, min_len int, max_len int",
    )
    numbers = ["+12025550123", "+12425550123", "+1242555012", "+442079460000", "+44207", "+9991234567", "+4930123456", "0301", None, "", "+"]
    df = spark.createDataFrame([(i, n, n) for i, n in enumerate(numbers)], "i int, `a.b` string, other string")
    got = [r[1] for r in check_foreign(df, ["a.b"], plan).orderBy("i").collect()]
    assert got == ["+12025550123", "+12425550123", None, "+442079460000", None, None, "+4930123456", "0301", None, "", None]
    with pytest.raises(ValueError, match="12345"):
        dial_heads(spark.createDataFrame([("12345", 1, 2)], "country_code string, min_len int, max_len int"))
