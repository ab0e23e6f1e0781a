"""Drops, slices and distinct rows."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from masterloom.sources import batch_slice, latest_batch, read_drop, watermark_slice
from registry import query, table


@query("SELECT o_orderkey, TRUE AS has_file_name FROM orders")
def source_file(spark, folder):
    drop = read_drop(spark, f"{folder}/orders.parquet")
    return drop.select("o_orderkey", F.col("sourcefile").rlike(r"^[^/]+\.parquet$").alias("has_file_name"))


@query(
    """
    WITH f AS (
      SELECT l_orderkey, l_linenumber, l_extendedprice,
             CASE WHEN l_returnflag <> 'N' THEN date_trunc('month', l_shipdate) END AS ts,
             concat('lineitem_', CAST(l_suppkey % 7 AS STRING), '.parquet') AS sourcefile
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice, sourcefile FROM f
    WHERE sourcefile = (SELECT max(sourcefile) FROM f WHERE ts = (SELECT max(ts) FROM f))
    """
)
def latest_batch_tie(spark, folder):
    """Several files share the newest month; the last name wins."""
    files = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.when(F.col("l_returnflag") != "N", F.date_trunc("month", "l_shipdate")).alias("ts"),
        F.concat(F.lit("lineitem_"), (F.col("l_suppkey") % 7).cast("string"), F.lit(".parquet")).alias(
            "sourcefile"
        ),
    )
    return latest_batch(files, "ts").drop("ts")


@query(
    """
    WITH f AS (
      SELECT o_orderkey, o_orderdate,
             concat('orders_', CAST(year(o_orderdate) AS STRING), '.parquet') AS sourcefile
      FROM orders)
    SELECT o_orderkey, sourcefile FROM f
    WHERE sourcefile = (SELECT max_by(sourcefile, o_orderdate) FROM f WHERE o_orderdate IS NOT NULL)
    """
)
def latest_batch_orders(spark, folder):
    files = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string"), F.lit(".parquet")).alias(
            "sourcefile"
        ),
    )
    return latest_batch(files, "o_orderdate").drop("o_orderdate")


@query(
    """
    SELECT o_orderkey, o_totalprice, 'orders-1998' AS batch_id FROM orders
    WHERE year(o_orderdate) = 1998
    """
)
def batch_of_one_load(spark, folder):
    loads = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.concat(F.lit("orders-"), F.year("o_orderdate").cast("string")).alias("batch_id"),
    )
    return batch_slice(loads, "orders-1998")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '2001-01-01 00:00:00' AND l_returnflag = 'R'
    """
)
def watermark(spark, folder):
    since = datetime(2001, 1, 1, tzinfo=timezone.utc)
    rows = table(spark, folder, "lineitem")
    return watermark_slice(rows, "l_shipdate", since, F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query(
    """
    SELECT event_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 12:00:00' AND event_type IN ('click', 'view', 'signup')
    """
)
def watermark_text(spark, folder):
    """The timestamp is text, as in the gold table; other texts are no timestamps."""
    since = datetime(2024, 1, 10, 12, tzinfo=timezone.utc)
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("ts").cast("string"))
    rows = table(spark, folder, "events").select("event_id", "event_type", text.alias("changed"))
    wanted = F.col("event_type").isin("click", "view", "signup", "error")
    return watermark_slice(rows, "changed", since, wanted).drop("changed")


@query("SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def dedup_distinct(spark, folder):
    return table(spark, folder, "lineitem").select("l_partkey", "l_returnflag").dropDuplicates()
