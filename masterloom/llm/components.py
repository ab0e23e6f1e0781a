"""Connected components of a link table, by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterloom.llm.common import discard, stage


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges``.

    ``edges`` has two columns of one orderable type; order, repeats and self-links do
    not matter, and links with a null are left out.  Each round joins every node to
    the smallest of its neighbours, first for the larger, then for the smaller ones
    (large star, small star); the number of links never grows, and a path halves.
    Every round is written to the shared folder.  All steps are hash aggregations and
    equality joins; nothing is gathered at the driver but one number.
    """
    x, y = (F.col(f"`{c}`") for c in edges.columns)
    links = stage(
        edges.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
        .filter((x != y) & x.isNotNull() & y.isNotNull())
        .distinct(),
        "links",
    )
    for _ in range(most_rounds):
        if _stars(links):
            break
        former, links = links, stage(_small_star(_large_star(links)), "links")
        discard(former)
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return roots.unionAll(links.select(F.col("a").alias("node"), F.col("b").alias("component")))


def _stars(links: DataFrame) -> bool:
    """Whether each larger node has one link, to a node that has none to a smaller one."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionAll(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root"))
    )
    summed = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return summed.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("root") > 0))).isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (
        both.join(least.withColumnRenamed("a", "k"), F.col("a") == F.col("k"))
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = (
        links.join(least.withColumnRenamed("a", "k"), F.col("a") == F.col("k"))
        .filter(F.col("b") != F.col("m"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
