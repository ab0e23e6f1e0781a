"""Mixing sources to target weights, by Pareto order sampling.

A source's target is its share, by weight, of all words; it stops at ``most`` times the
source's own words, and the excess is reshared by weight.  Target over size is how often
each document is expected in the mix.  The whole part is certain: every document is taken
that often.  The fraction is an inclusion probability p, met by order sampling: with u
uniform per document, rank by (u / (1 - u)) / (p / (1 - p)) and take documents in that
order until the fraction's words are reached; the last one is taken if that comes nearer.
So a source's words miss its target by at most half a document.  Rows that are alike in id
and size have one place in the order; where the words are reached among them, only as many
of them are taken as are needed.

Words before a document in the order are a running sum in two steps: over ``BINS`` ranges
of the rank per source, then within a range, so a source with a third of all rows is
spread.  u is a hash of seed and id: reruns agree, and any task may run again.

Null and empty texts have size 0.  A null source is a source, the last one; a null id is
an id like others.  Rows that repeat an id share u and are told apart by size.  No rows, or
no words, give targets of 0.  Extra columns are kept.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masterloom.llm.common import WORD, column, fresh, stage, uniform

BINS = 4096
MOST = 3
SEED = "mix"
#: Source rows that may be broadcast; a corpus with more sources joins by a shuffle.
BROADCAST_SOURCES = 50_000


def words_of(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target``, ``whole`` and ``need`` per source of ``sizes`` (``source``, ``size``).

    Sources by code point, null last, have the weights of ``cycle`` in turn.  A source
    is at its limit if the limit per weight is no more than the level that is left when
    all sources with smaller limits per weight are at theirs.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(cycle)
    limited = total.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (turn + 1).cast("int")).cast("long"))
    limited = limited.withColumn("limit", most * F.col("source_size"))
    everything = Window.partitionBy()
    by_limit = Window.partitionBy().orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    leveled = (
        limited.withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(after))
        .withColumn("full", F.col("limit") * F.col("weights") <= F.col("rest") * F.col("weight"))
    )
    # The first source below its limit has the level of all such.
    first = F.min(F.when(~F.col("full"), F.struct((F.col("limit") / F.col("weight")).alias("l"), F.isnull("source").alias("n"), F.col("source").alias("s"), F.col("rest"), F.col("weights")))).over(everything)
    level = leveled.withColumn("first", first)
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        (F.col("weight") * F.col("first.rest")).cast("double") / F.col("first.weights")
    )
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        level.withColumn("target", target)
        .withColumn("whole", F.floor(expected))
        .withColumn("chance", expected - F.col("whole"))
        .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("source", "source_size", "target", "whole", "chance", "need")
    )


def order_rank(chance: Column, u: Column) -> Column:
    """The document's odds over its inclusion odds; null where nothing is to be drawn."""
    return F.when(chance > 0, (u / (1 - u)) / (chance / (1 - chance)))


def drawn(sizes: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """Rows of sources from which documents are drawn, with their place (``rank``) and ``bin`` in the order.

    Bins are ranges of the uniform number, which orders a source as the rank does: they
    have alike many rows whatever the chance.
    """
    u = uniform(seed, F.col("id"))
    rows = with_sources(sizes, targets).withColumn("rank", order_rank(F.col("chance"), u))
    rows = rows.filter(F.col("rank").isNotNull()).withColumn("bin", F.floor(u * BINS))
    return rows.select("source", "bin", "rank", "id", "size", "need")


def cutoffs(sizes: DataFrame, seed: str = SEED, cycle: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """Per source its targets and ``cut``, the last place of the order that is taken (null: none).

    ``most_equal`` is how many of the rows at that place are taken, null for all of them.
    ``sizes`` (``id``, ``source``, ``size``) is read three times: pass a written table.
    """
    targets = stage(source_targets(sizes, cycle, most), "targets")
    rows = drawn(sizes, targets, seed)
    earlier = Window.partitionBy("b_source").orderBy("b_bin").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        rows.groupBy(F.col("source").alias("b_source"), F.col("bin").alias("b_bin"))
        .agg(F.sum("size").alias("n"))
        .select("b_source", "b_bin", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("source", "bin").orderBy("rank", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    running = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # Equal rows lie in one bin, one behind another.
    equal = Window.partitionBy("source", "bin", "rank", "id", "size")
    running = running.withColumn("nth", F.row_number().over(equal.orderBy("before")))
    running = running.withColumn("equal", F.count(F.lit(1)).over(equal))
    running = running.join(bases, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bin") == F.col("b_bin")))
    # The document at the border is taken if at least half of it is needed.
    taken = running.filter(2 * (F.col("base") + F.col("before")) + F.col("size") <= 2 * F.col("need"))
    last = taken.groupBy(F.col("source").alias("c_source")).agg(F.max(F.struct("rank", "id", "size", "nth", "equal")).alias("last"))
    cut = last.select(
        "c_source",
        F.struct("last.rank", "last.id", "last.size").alias("cut"),
        F.when(F.col("last.nth") < F.col("last.equal"), F.col("last.nth").cast("long")).alias("most_equal"),
    )
    return targets.join(cut, F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source")


def with_sources(rows: DataFrame, per_source: DataFrame, source: str = "source") -> DataFrame:
    """``rows`` with the columns of ``per_source`` beside them; broadcast only within the bound."""
    name = fresh(rows, "source")
    per_source = per_source.withColumnRenamed("source", name)
    few = per_source.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    side = F.broadcast(per_source) if few else per_source
    return rows.join(side, column(source).eqNullSafe(F.col(name))).drop(name)


def mixed(sizes: DataFrame, seed: str = SEED, cycle: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``sizes`` with its source's targets and ``copies``, how often the mix takes the row."""
    cuts = stage(cutoffs(sizes, seed, cycle, most), "cutoffs")
    rows = with_sources(sizes, cuts).withColumn("whole", F.col("whole").cast("long"))
    found = taken_times(rows, F.struct(*[F.col(c) for c in MIX]), F.col("id"), F.col("size"), seed, "copies")
    return found.drop("most_equal")


#: What a row's source says of how often it is taken.
MIX = ["source", "whole", "chance", "cut", "most_equal"]


def taken_times(rows: DataFrame, mix: Column, key: Column, size: Column, seed: str, into: str) -> DataFrame:
    """``rows`` with how often each is taken, by its source's ``mix``.

    Rows at the place of the cut of which not all are taken, one group a source at most,
    are written down and numbered in two steps: within the part of the table in which
    they were read, and over those parts.  So equal rows need not meet in one task.
    """
    names = {n: fresh(rows, n) for n in ("mix", "place", "border", "read")}
    rank = order_rank(F.col(names["mix"])["chance"], uniform(seed, key))
    place = F.struct(rank.alias("rank"), key.alias("id"), size.alias("size"))
    rows = rows.withColumn(names["mix"], mix).withColumn(names["place"], place)
    mix, place = F.col(names["mix"]), F.col(names["place"])
    reached = F.coalesce(place["rank"].isNotNull() & (place <= mix["cut"]), F.lit(False))
    rows = rows.withColumn(names["border"], reached & mix["most_equal"].isNotNull() & place.eqNullSafe(mix["cut"]))
    border = F.col(names["border"])
    plain = rows.filter(~border).withColumn(into, mix["whole"] + reached.cast("long"))
    there = stage(rows.filter(border).withColumn(names["read"], F.spark_partition_id()), "equal-rows")
    source, read = mix["source"], F.col(names["read"])
    inside = Window.partitionBy(source, read).orderBy(place["rank"])
    counted = there.groupBy(source.alias("c_source"), read.alias("c_read")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("c_source").orderBy("c_read").rowsBetween(Window.unboundedPreceding, -1)
    before, start = fresh(there, "before"), F.coalesce(F.sum("n").over(earlier), F.lit(0))
    bases = counted.select(F.struct("c_source", "c_read", start.alias("start")).alias(before))
    same = source.eqNullSafe(F.col(before)["c_source"]) & (read == F.col(before)["c_read"])
    numbered = there.withColumn(into, F.row_number().over(inside)).join(bases, same)
    first = F.col(before)["start"] + F.col(into) <= mix["most_equal"]
    numbered = numbered.withColumn(into, mix["whole"] + first.cast("long")).select(*plain.columns)
    return plain.unionAll(numbered).drop(names["mix"], names["place"], names["border"])


def document_sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``id``, ``source`` and ``size`` of every row, written to the shared folder."""
    rows = docs.select(column(id_col).alias("id"), column(source_col).alias("source"), words_of(column(text_col)).alias("size"))
    return stage(rows, "sizes")


def mix_documents(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = SEED, cycle: tuple[int, ...] = (1, 2, 3), most: int = MOST
) -> DataFrame:
    """The mix: each row of ``docs`` as often as it is taken.  The texts are not shuffled."""
    cuts = stage(cutoffs(document_sizes(docs, id_col, source_col, text_col), seed, cycle, most), "cutoffs")
    side = cuts.select("source", F.struct(*[(F.col(c).cast("long") if c == "whole" else F.col(c)).alias(c) for c in MIX]).alias(mix := fresh(docs, "mix")))
    rows = with_sources(docs, side, source_col)
    copy = fresh(rows, "copy")
    rows = taken_times(rows, column(mix), column(id_col), words_of(column(text_col)), seed, copy)
    times = F.array_repeat(F.lit(0), F.col(copy).cast("int"))
    return rows.withColumn(copy, F.explode(times)).drop(copy, mix)


#: The same for DuckDB.  Fixed: seed, weights, limit.
ORACLE = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), total AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight, 3 * source_size AS lim FROM total
), leveled AS (
  SELECT *,
    (sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
    (sum(weight) OVER (ORDER BY lim / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights,
    row_number() OVER (ORDER BY lim / weight, source ASC NULLS LAST) AS place
  FROM weighed
), marked AS (
  SELECT *, lim * weights <= rest * weight AS filled FROM leveled
), level AS (
  SELECT rest AS l_rest, weights AS l_weights FROM marked WHERE NOT filled ORDER BY place LIMIT 1
), targets AS (
  SELECT source, source_size,
    CASE WHEN filled THEN lim::DOUBLE ELSE (weight * l_rest)::DOUBLE / l_weights END AS target
  FROM marked LEFT JOIN level ON true
), expected AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS times FROM targets
), chances AS (
  SELECT *, floor(times) AS whole, times - floor(times) AS chance, target - floor(times) * source_size AS need FROM expected
), drawn AS (
  SELECT s.*, c.source_size, c.target, c.whole, c.chance, c.need,
    (('0x' || substr(md5('mix/' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM sizes s JOIN chances c ON s.source IS NOT DISTINCT FROM c.source
), ranked AS (
  SELECT *, CASE WHEN chance > 0 THEN (u / (1 - u)) / (chance / (1 - chance)) END AS rnk FROM drawn
), running AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rnk, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ranked
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN rnk IS NOT NULL AND 2 * before + size <= 2 * need THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running
"""
