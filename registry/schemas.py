"""Names, audit columns, mappings and target schemas."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from masterloom.context import RunContext
from masterloom.operators import (
    add_audit,
    apply_mapping,
    conform,
    merged_schema,
    sanitize_columns,
    string_schema,
)
from registry import query, table

CTX = RunContext("etl", datetime(2024, 5, 1, 10, 0, tzinfo=timezone.utc), "orders-1")


@query(
    """
    SELECT o_orderkey AS orderkeyc, o_custkey AS total, o_orderstatus AS total_2,
           o_totalprice AS total_3, o_orderdate AS orderdate, o_orderpriority AS col_6
    FROM orders
    """
)
def sanitized_columns(spark, folder):
    orders = table(spark, folder, "orders")
    return sanitize_columns(orders.toDF("Order_Key__c", "Total", "TOTAL!", "to tal", "Order-Date", "#%"))


@query(
    """
    SELECT o_orderkey, 'orders.parquet' AS filename, 'etl' AS createdby, 'etl' AS lastupdatedby,
           epoch_us(TIMESTAMP '2024-05-01 10:00:00') AS created_us,
           epoch_us(TIMESTAMP '2024-05-01 10:00:00') AS updated_us,
           'orders-1' AS batch_id
    FROM orders
    """
)
def audit_columns(spark, folder):
    audited = add_audit(table(spark, folder, "orders").select("o_orderkey"), CTX, "orders.parquet")
    return audited.select(
        "o_orderkey",
        "filename",
        "createdby",
        "lastupdatedby",
        F.unix_micros("createdtimestamp").alias("created_us"),
        F.unix_micros("lastupdatedtimestamp").alias("updated_us"),
        "batch_id",
    )


@query("SELECT o_orderkey, TRUE AS by_me, TRUE AS now, TRUE AS one_batch FROM orders")
def started_run(spark, folder):
    """A run that is started now is the session user's, at one time, under one batch id."""
    begin = datetime.now(timezone.utc)
    ctx = RunContext.start(spark)
    audited = add_audit(table(spark, folder, "orders").select("o_orderkey"), ctx, "orders.parquet")
    within = F.col("createdtimestamp").between(F.lit(begin), F.lit(datetime.now(timezone.utc)))
    return audited.select(
        "o_orderkey",
        (F.col("createdby") == F.current_user()).alias("by_me"),
        (within & (F.col("createdtimestamp") == F.col("lastupdatedtimestamp"))).alias("now"),
        F.col("batch_id").eqNullSafe(F.lit(ctx.batch_id)).alias("one_batch"),
    )


@query(
    """
    SELECT CAST(o_orderkey AS STRING) AS "Code", o_orderpriority AS "Name",
           o_orderpriority AS "HotelName", CAST(o_custkey AS STRING) AS "CountryCode",
           'Salesforce' AS "SourceSystem"
    FROM orders
    """
)
def mapped_projection(spark, folder):
    pairs = [
        ("Code", "o_orderkey"),
        ("Name", "o_orderpriority"),
        ("HotelName", "o_orderpriority"),
        ("CountryCode", "o_custkey"),
    ]
    orders = table(spark, folder, "orders")
    return apply_mapping(orders, pairs, {"SourceSystem": "Salesforce"}, cast="string")


@query(
    """
    SELECT CAST(o_orderkey AS STRING) AS "Code", o_orderstatus AS "HotelName",
           CAST(o_custkey AS STRING) AS "IDSalesforce",
           CAST(NULL AS STRING) AS "AccountingManagerName"
    FROM orders
    """
)
def conform_schema(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("idsalesforce"),
        F.col("o_orderkey").alias("code"),
        F.col("o_orderstatus").alias("HOTELNAME"),
        "o_totalprice",
    )
    wide = string_schema(["AccountingManagerName", "Code", "HotelName", "IDSalesforce"])
    return conform(orders, wide)


@query(
    """
    SELECT o_orderkey, o_orderstatus, CAST(NULL AS BIGINT) AS o_custkey FROM orders
    WHERE o_orderkey % 2 = 0
    UNION ALL
    SELECT o_orderkey, CAST(NULL AS STRING), o_custkey FROM orders WHERE o_orderkey % 2 = 1
    """
)
def append_with_new_column(spark, folder):
    """Two loads under the schema both fit: what an evolving table holds after them."""
    orders = table(spark, folder, "orders")
    first = orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus")
    second = orders.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_custkey")
    schema = merged_schema(first.schema, second.schema)
    return conform(first, schema).unionByName(conform(second, schema))
