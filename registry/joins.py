"""Lookup joins and reference tables."""

from pyspark.sql import functions as F

from masterloom.operators import Reference, check_foreign, enrich_reference, lookup_join
from registry import query, table

# A third of the rows has one key, a tenth has none, some keys are unknown.
KEY = """
    CASE WHEN l_partkey % 10 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN 'Brand#1'
         ELSE concat('Brand#', CAST(l_partkey % 40 AS STRING)) END
"""
LOOKUP = f"""
    WITH dim AS (
      SELECT p_brand AS id, p_name AS brandname, p_size AS brandsize
      FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) AS rn FROM part) t
      WHERE rn = 1)
    SELECT l_orderkey, l_linenumber, l_partkey, d.brandname, d.brandsize
    FROM (SELECT *, {KEY} AS brand FROM lineitem) l LEFT JOIN dim d ON l.brand = d.id
"""


def _newest_brand(spark, folder, broadcast):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup_join(
        lines.withColumn("brand", F.expr(KEY)),
        table(spark, folder, "part"),
        ("brand", "p_brand"),
        {"brandname": "p_name", "brandsize": "p_size"},
        ["p_partkey"],
        broadcast,
    ).drop("brand")


@query(LOOKUP)
def lookup_join_measured(spark, folder):
    """The lookup side is measured, and broadcast if it is small."""
    return _newest_brand(spark, folder, None)


@query(LOOKUP)
def lookup_join_salted(spark, folder):
    """The way taken for a lookup side too large to broadcast."""
    return _newest_brand(spark, folder, False)


@query(
    """
    SELECT o_orderkey, n.n_name AS isocountryname, n.n_nationkey AS iso2char, r.r_name AS parentname
    FROM (SELECT o_orderkey, o_custkey % 30 AS nk FROM orders) o
    LEFT JOIN nation n ON o.nk = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    """
)
def reference_enrich(spark, folder):
    """Padded and lower-case keys, and a second reference keyed by the first one's column."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.concat(F.lit("  nation_"), (F.col("o_custkey") % 30).cast("string"), F.lit(" ")).alias("countryc"),
    )
    nation = table(spark, folder, "nation").select(
        F.col("n_name").alias("iso3char"),
        F.col("n_name").alias("isocountryname"),
        F.col("n_nationkey").alias("iso2char"),
        F.col("n_regionkey").alias("parent"),
    )
    region = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("parentname")
    )
    return enrich_reference(
        orders,
        {
            "countryc": Reference(nation, "iso3char", ["isocountryname", "iso2char", "parent"]),
            "parent": Reference(region, "id", ["parentname"]),
        },
    ).drop("countryc", "parent")


# Two-digit codes, one that regions share, and longer ones that begin with it.
CODES = """
    SELECT concat('R', CAST(n_nationkey AS STRING)) AS region,
           CASE WHEN n_nationkey % 5 = 0 THEN '1' WHEN n_nationkey % 5 = 1 THEN concat('12', CAST(30 + n_nationkey AS STRING))
                ELSE CAST(20 + n_nationkey AS STRING) END AS country_code,
           '0' AS trunk_prefix, CAST(6 + n_nationkey % 2 AS INTEGER) AS min_len, CAST(8 + n_nationkey % 3 AS INTEGER) AS max_len
    FROM nation
"""
DIALLED = """
    SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN CAST(c_custkey AS STRING)
      ELSE concat('+', CAST(c_custkey % 60 AS STRING), CASE WHEN c_custkey % 3 = 0 THEN '23' ELSE '' END,
                  substring('1234567890123', 1, CAST(4 + c_custkey % 9 AS INTEGER))) END AS phone
    FROM customer
"""


@query(
    f"""
    WITH plan AS (SELECT country_code AS code, min(min_len) AS low, max(max_len) AS high FROM ({CODES}) p GROUP BY country_code),
    dialled AS ({DIALLED}),
    matched AS (
      SELECT c_custkey, phone, code, low, high, row_number() OVER (PARTITION BY c_custkey ORDER BY length(code) DESC) AS rn
      FROM dialled LEFT JOIN plan ON starts_with(phone, '+' || code))
    SELECT c_custkey, CASE WHEN NOT starts_with(phone, '+') OR length(phone) - 1 - length(code) BETWEEN low AND high THEN phone END AS phone
    FROM matched WHERE rn = 1
    """
)
def phone_foreign(spark, folder):
    """The longest dial code that begins a number decides whether it can be one."""
    codes = spark.sql(CODES.replace("FROM nation", "FROM {nation}"), nation=table(spark, folder, "nation"))
    dialled = spark.sql(DIALLED.replace("FROM customer", "FROM {customer}"), customer=table(spark, folder, "customer"))
    return check_foreign(dialled, ["phone"], codes)
