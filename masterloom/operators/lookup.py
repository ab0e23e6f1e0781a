"""Lookup joins that never change the row count of the table they widen.

The lookup side is reduced to one row per key before the join.  It is broadcast
only after its size was measured; a larger one is joined by a shuffle in which the
frequent keys, and the rows without a key, are spread over all partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterloom.operators.schema import quoted

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
# A key is spread if it has more rows than so many even shuffle partitions.
FREQUENT_SHARE = 2


def one_row_per_key(
    df: DataFrame, key: Column, columns: Mapping[str, Column], order_by: Sequence[str | Column]
) -> DataFrame:
    """``key`` and ``columns`` of the row that is last in ``order_by``, per key.

    Null keys are left out.  Ties are broken by the columns' values, so the result
    does not depend on the order in which rows arrive.  The maximum is combined
    before the shuffle: a key with very many rows costs one row per task.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    rank = [c.alias(f"o{i}") for i, c in enumerate(order)]
    # Positional names: a value column may have any name, also one of the order columns'.
    values = [c.alias(f"v{i}") for i, c in enumerate(columns.values())]
    return (
        df.select(key.alias("key"), F.struct(*rank, *values).alias("row"))
        .filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max("row").alias("row"))
        .select(
            F.col("key").alias("__key"),
            *[F.col(f"row.v{i}").alias(name) for i, name in enumerate(columns)],
        )
    )


def fits_broadcast(
    *tables: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> list[bool]:
    """Whether each table is small enough to broadcast, by its counted rows and bytes.

    One job for all of them; one row per table comes back to the driver.
    """

    def size(number: int, df: DataFrame) -> DataFrame:
        sizes = [F.coalesce(F.octet_length(F.col(quoted(c)).cast("string")), F.lit(0)) for c in df.columns]
        return df.agg(
            F.lit(number).alias("number"),
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(sum(sizes[1:], sizes[0])), F.lit(0)).alias("bytes"),
        )

    measured = reduce(DataFrame.unionAll, [size(i, df) for i, df in enumerate(tables)]).collect()
    fits = {r["number"]: r["rows"] <= max_rows and r["bytes"] <= max_bytes for r in measured}
    return [fits[i] for i in range(len(tables))]


def frequent_keys(df: DataFrame, key: Column, partitions: int, share: float = FREQUENT_SHARE) -> DataFrame:
    """``hot``: the keys with more than ``share`` times the rows of an even shuffle partition.

    Every such key is in it, and there are at most ``partitions / share`` of them, so
    they can be broadcast.  Counted exactly, and combined before the shuffle; null is
    left out.
    """
    counts = df.groupBy(key.alias("hot")).agg(F.count(F.lit(1)).alias("n"))
    rows = df.select(F.lit(1)).count()
    return counts.filter(F.col("hot").isNotNull() & (F.col("n") * partitions > share * rows)).select("hot")


def attach(
    df: DataFrame,
    dim: DataFrame,
    key: Column,
    broadcast: bool | None = None,
    salts: int | None = None,
    hot: DataFrame | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Left join a table of one row per ``__key``; the key column is dropped.

    ``broadcast=None`` measures the lookup side.  Without a broadcast, rows with a
    frequent key or with none get one of ``salts`` (as many as there are shuffle
    partitions) by a hash of the whole row, and the lookup rows of the frequent
    keys are repeated once per salt.  Exact copies of one row share a salt; what
    they leave of a skew is split by adaptive execution.  ``hot`` gives the frequent
    keys where the caller knows them.  ``hashed`` is for a caller who knows that a
    partition's share of the lookup rows fits in memory: the rows are then not sorted.
    """
    if broadcast is None:
        (broadcast,) = fits_broadcast(dim)
    if broadcast:
        return df.join(F.broadcast(dim), key == F.col("__key"), "left").drop("__key")
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if hot is None:
        hot = frequent_keys(df, key, salts)
    found = [row["hot"] for row in hot.collect()]
    frequent = hot.sparkSession.createDataFrame([(k,) for k in found], hot.schema)
    spread = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in df.columns]), F.lit(salts)).cast("int")
    flagged = df.join(F.broadcast(frequent), key == F.col("hot"), "left")
    salted = flagged.withColumn(
        "__salt", F.when(key.isNull() | F.col("hot").isNotNull(), spread).otherwise(F.lit(0))
    ).drop("hot")
    numbers = F.when(F.col("hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = dim.join(F.broadcast(frequent), F.col("__key") == F.col("hot"), "left")
    copies = copies.withColumn("__copy", F.explode(numbers)).drop("hot")
    on = (key == F.col("__key")) & (F.col("__salt") == F.col("__copy"))
    # Without the hint a compressed size could still talk the planner into a broadcast.
    return salted.join(copies.hint("shuffle_hash" if hashed else "merge"), on, "left").drop("__key", "__salt", "__copy")


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    on: tuple[str | Column, str | Column],
    columns: Mapping[str, str | Column],
    order_by: Sequence[str | Column],
    broadcast: bool | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Left equi-join that adds ``columns`` from the newest row of each key.

    ``on`` is the key in ``df`` and the key in ``dim``; ``columns`` maps new names
    to columns of ``dim``; ``order_by`` says which of several rows is the newest.
    """
    values = {name: F.col(c) if isinstance(c, str) else c for name, c in columns.items()}
    left, right = (F.col(k) if isinstance(k, str) else k for k in on)
    reduced = one_row_per_key(dim, right, values, order_by)
    if broadcast is None:
        # The unreduced rows bound the reduced ones, and cost no shuffle to count.
        whole = dim.select(right.alias("k"), *[c.alias(f"v{i}") for i, c in enumerate(values.values())])
        broadcast = fits_broadcast(whole)[0] or fits_broadcast(reduced)[0]
    return attach(df, reduced, left, broadcast, salts)


@dataclass(frozen=True)
class Reference:
    """A reference table: its key, the columns to take, and which row wins."""

    df: DataFrame
    key: str
    columns: Sequence[str]
    order_by: Sequence[str | Column] = field(default_factory=tuple)


def enrich_reference(
    df: DataFrame,
    references: Mapping[str, Reference],
    broadcast: bool | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Add the columns of several reference tables, keyed by columns of ``df``.

    Keys match by their trimmed, upper-case text.  A blank key matches nothing; an
    unmatched row gets nulls.
    """
    if broadcast is None:
        used = [ref.df.select(ref.key, *ref.columns) for ref in references.values()]
        known = [fits or None for fits in fits_broadcast(*used)]
    else:
        known = [broadcast] * len(references)
    for (column, ref), small in zip(references.items(), known):
        df = lookup_join(
            df,
            ref.df,
            (_folded(column), F.nullif(_folded(ref.key), F.lit(""))),
            {c: c for c in ref.columns},
            ref.order_by,
            small,
            salts,
        )
    return df


def _folded(column: str) -> Column:
    return F.upper(F.trim(F.col(column).cast("string")))
