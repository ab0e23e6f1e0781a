"""What writes: appended loads, merged tables in several layouts, CSV; each read back."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from masterloom.operators import changed_keys, with_row_hash
from masterloom.sources import append_evolving, ensure_table, export_csv, keep_newest, merge_table, read_evolved, widen_table
from masterloom.sources.tables import shared_folder, staged
from registry import query, table
from registry.upserts import SPLIT, _sides

MERGED = f"""
    {SPLIT}
    SELECT coalesce(s.code, t.code) AS code,
           CASE WHEN s.code IS NOT NULL THEN s.status ELSE t.status END AS status,
           t.note, coalesce(t.createdby, 'etl') AS createdby,
           CASE WHEN s.code IS NOT NULL THEN 'etl' ELSE t.lastupdatedby END AS lastupdatedby
    FROM tgt t FULL OUTER JOIN src s ON t.code = s.code
"""


def _new_name(label):
    return f"{label}_{uuid.uuid4().hex}"


@query(
    """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority,
           CASE WHEN o_orderkey % 2 = 1 THEN 'load-b' ELSE 'load-a' END AS batch_id
    FROM orders
    """
)
def append_two_loads(spark, folder):
    """The second load is wider; the first one is then loaded again, as after a failure."""
    name, orders = _new_name("bronze"), table(spark, folder, "orders")
    first = orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_totalprice")
    second = orders.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("priority"))
    for rows, load in ((first, "load-a"), (second, "load-b"), (first, "load-a")):
        append_evolving(rows.withColumn("batch_id", F.lit(load)), name, load)
    return spark.table(name).select("o_orderkey", "o_totalprice", "priority", "batch_id")


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS DOUBLE) ELSE o_totalprice END AS amount,
           CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS STRING) ELSE o_orderpriority END AS mark,
           'load-' || CAST(o_orderkey % 3 AS STRING) AS batch_id
    FROM orders
    """
)
def append_wider_types(spark, folder):
    """Two columns come as integers first, later as a double and as text; the first load is then loaded again."""
    name, orders = _new_name("bronze"), table(spark, folder, "orders")
    later = [F.col("o_totalprice").cast("double").alias("amount"), F.col("o_orderpriority").alias("mark")]
    first = [F.col("o_custkey").cast("int").alias(c) for c in ("amount", "mark")]
    for load, columns in ((0, first), (1, later), (2, later), (0, first)):
        rows = orders.filter(F.col("o_orderkey") % 3 == load).select("o_orderkey", *columns)
        append_evolving(rows.withColumn("batch_id", F.lit(f"load-{load}")), name, f"load-{load}", widen=True)
    return read_evolved(spark, name)


@query(
    """
    SELECT o_orderkey AS code, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE CAST(o_custkey AS DOUBLE) END AS amount
    FROM orders
    """
)
def merge_wider_type(spark, folder):
    """A table laid out by key ranges holds integers until a batch brings doubles for every second key."""
    name, orders = _new_name("widened"), table(spark, folder, "orders").withColumnRenamed("o_orderkey", "code")
    first = orders.select("code", F.col("o_custkey").cast("int").alias("amount"))
    second = orders.filter("code % 2 = 0").select("code", F.col("o_totalprice").cast("double").alias("amount"))
    ensure_table(spark, name, first.schema, bucket_by=["code"], ranges=8)
    for rows in (first, second):
        widen_table(spark, name, rows.schema)
        with staged(rows, "batch") as batch:
            merge_table(batch, name, ["code"])
    return spark.table(name).select("code", "amount")


@query(
    f"""
    {SPLIT}
    SELECT s.code, s.status FROM src s LEFT JOIN tgt t ON s.code = t.code
    WHERE t.code IS NULL OR t.status IS DISTINCT FROM s.status
    """
)
def changes_by_row_hash(spark, folder):
    """What a batch changes in a table that keeps a hash of each row, told from keys and hashes alone."""
    name, (target, source) = _new_name("hashed"), _sides(spark, folder)
    held = target.select("code", "status")
    schema = StructType([*held.schema.fields, StructField("row_hash", StringType())])
    ensure_table(spark, name, schema)
    with staged(with_row_hash(held, schema, ["code"], "row_hash"), "batch") as batch:
        merge_table(batch, name, ["code"])
    hashed = with_row_hash(source, schema, ["code"], "row_hash")
    changed = changed_keys(spark.table(name), hashed, ["code"], row_hash="row_hash")
    return hashed.join(changed, "code", "left_semi").select("code", "status")


def _merged(spark, folder, **layout):
    name = _new_name("merged")
    target, source = _sides(spark, folder)
    ensure_table(spark, name, target.schema, **layout)
    target.select(*spark.table(name).columns).write.insertInto(name)
    by = F.lit("etl")
    with staged(source, "batch") as batch:
        merge_table(batch, name, ["code"], {"lastupdatedby": by}, {"lastupdatedby": by, "createdby": by})
    return spark.table(name).select("code", "status", "note", "createdby", "lastupdatedby")


@query(MERGED)
def merge_plain_table(spark, folder):
    return _merged(spark, folder)


@query(MERGED)
def merge_bucketed_table(spark, folder):
    return _merged(spark, folder, bucket_by=["code"], buckets=8)


@query(MERGED)
def merge_partitioned_table(spark, folder):
    """Rows move between partitions, since the batch sets the column they are parted by."""
    return _merged(spark, folder, partition_by=["status"])


@query(MERGED)
def merge_orc_table(spark, folder):
    return _merged(spark, folder, provider="orc")


@query(
    """
    SELECT c_custkey, concat('  ', c_name, ' "x", ') AS padded, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment
    FROM customer
    """
)
def csv_round_trip(spark, folder):
    """Blanks around values, quotes and commas come back as they were."""
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(' "x", ')).alias("padded"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("segment"),
    )
    path = export_csv(rows, f"{shared_folder(spark)}/{_new_name('csv')}", "customers.csv")
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return spark.read.options(header=True, escape='"', **blanks).schema(rows.schema).csv(path)


@query(
    """
    SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) r
    WHERE rn = 1
    """
)
def newest_of_each_key(spark, folder):
    """Three loads, the newest rows not in the last one, and one load twice."""
    name, orders = _new_name("newest"), table(spark, folder, "orders")
    for load in (1, 2, 0, 1):
        rows = orders.filter(F.col("o_orderkey") % 3 == load)
        keep_newest(rows, name, "o_custkey", ["o_orderpriority"], ["o_orderdate", "o_orderkey"], ranges=16)
    return spark.table(name).select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
