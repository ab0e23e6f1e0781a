"""Keyed upserts."""

from pyspark.sql import functions as F

from masterloom.operators import reject_blank_keys, upsert
from registry import query, table

# The target: two thirds of the orders.  The batch: every second and every third order.
SPLIT = """
    WITH tgt AS (
      SELECT o_orderkey AS code, o_orderstatus AS status, o_orderpriority AS note,
             'seed' AS createdby, 'seed' AS lastupdatedby
      FROM orders WHERE o_orderkey % 3 <> 0),
    src AS (
      SELECT o_orderkey AS code, CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus ELSE 'new' END AS status
      FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)
"""


def _sides(spark, folder):
    orders = table(spark, folder, "orders")
    target = orders.filter("o_orderkey % 3 <> 0").select(
        F.col("o_orderkey").alias("code"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("note"),
        F.lit("seed").alias("createdby"),
        F.lit("seed").alias("lastupdatedby"),
    )
    source = orders.filter("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0").select(
        F.col("o_orderkey").alias("CODE"),
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus ELSE 'new' END").alias("Status"),
    )
    return target, source


@query(
    f"""
    {SPLIT}
    SELECT coalesce(s.code, t.code) AS code,
           CASE WHEN s.code IS NOT NULL THEN s.status ELSE t.status END AS status,
           t.note, coalesce(t.createdby, 'etl') AS createdby,
           CASE WHEN s.code IS NOT NULL THEN 'etl' ELSE t.lastupdatedby END AS lastupdatedby
    FROM tgt t FULL OUTER JOIN src s ON t.code = s.code
    """
)
def upsert_by_key(spark, folder):
    """Known, new and untouched keys; 'note' belongs to others and keeps its value."""
    target, source = _sides(spark, folder)
    by = F.lit("etl")
    return upsert(
        target, source, ["code"], {"lastupdatedby": by}, {"lastupdatedby": by, "createdby": by}
    )


@query(
    f"""
    {SPLIT}
    SELECT coalesce(s.code, t.code) AS code,
           CASE WHEN s.code IS NOT NULL THEN s.status ELSE t.status END AS status,
           t.note, coalesce(t.createdby, 'etl') AS createdby,
           CASE WHEN s.code IS NOT NULL AND s.status IS DISTINCT FROM t.status
                THEN 'etl' ELSE t.lastupdatedby END AS lastupdatedby
    FROM tgt t FULL OUTER JOIN src s ON t.code = s.code
    """
)
def upsert_only_changed(spark, folder):
    target, source = _sides(spark, folder)
    by = F.lit("etl")
    return upsert(
        target,
        source,
        ["code"],
        {"lastupdatedby": by},
        {"lastupdatedby": by, "createdby": by},
        only_if_changed=True,
    )


@query(
    """
    WITH tgt AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey % 2 = 0 OR l_partkey % 3 <> 0),
    src AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS quantity, max(l_tax) AS tax
            FROM lineitem WHERE l_partkey % 3 = 0 GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, coalesce(src.quantity, 0) AS quantity,
           coalesce(src.tax, 0) AS tax,
           CASE WHEN tgt.l_orderkey IS NOT NULL THEN 'seed' END AS owner
    FROM tgt FULL OUTER JOIN src USING (l_orderkey, l_linenumber)
    """
)
def upsert_two_keys(spark, folder):
    """A composite key: lines of even suppliers or other parts, and a batch of every third part's lines."""
    lines = table(spark, folder, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    totals = (
        lines.filter("l_partkey % 3 = 0")
        .groupBy(*keys)
        .agg(F.max("l_quantity").alias("quantity"), F.max("l_tax").alias("tax"))
    )
    target = (
        lines.filter("l_suppkey % 2 = 0 OR l_partkey % 3 <> 0")
        .select(*keys)
        .distinct()
        .select(
            *keys,
            F.lit(0.0).alias("quantity"),
            F.lit(0.0).alias("tax"),
            F.lit("seed").alias("owner"),
        )
    )
    return upsert(target, totals, keys)


@query(
    """
    SELECT o_orderkey, o_orderkey % 4 >= 2 AS filled FROM orders
    """
)
def blank_keys(spark, folder):
    """Both frames, told apart by a flag."""
    coded = table(spark, folder, "orders").select(
        "o_orderkey",
        F.expr(
            "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE o_orderpriority END"
        ).alias("code"),
    )
    good, rejects = reject_blank_keys(coded, ["code"])
    return good.select("o_orderkey", F.lit(True).alias("filled")).unionByName(
        rejects.select("o_orderkey", F.lit(False).alias("filled"))
    )
