"""Embedding near-dedup with randomised-rotation binary codes.

Each unit vector o is rotated at random (P o) and stored as the signs of P o, a binary
code x, with the correction factor f = <x, P o> / sqrt(D).  For any other unit vector q,
<x, P q> / sqrt(D) / f estimates <o, q> without bias, and misses it by more than
``EPSILON`` sqrt((1 - f f) / (f f)) / sqrt(D - 1) with vanishing probability.  Pairs whose
estimate plus that bound is below the threshold are dismissed; all others are computed
again from the vectors, in double precision, and only those decide.

Which pairs are looked at: signs of random projections put every vector into one bucket
in each of several tables.  Bits and tables follow from the number of vectors and the
threshold, so that a pair at the threshold shares a bucket with probability ``RECALL`` and
buckets stay near ``BUCKET`` vectors; all vectors are in all tables.  Equal vectors are
one item with a count.  A bucket of more than ``TILE`` items is cut into tiles, and each
pair of tiles is a block; so no task holds a whole bucket, and no pair is left out.  A
block gives each of its items a number of links and one link of a spanning tree, never
its pairs; a pair that shares several buckets counts in the first of them.

A vector that is null, empty or zero, or holds null or non-finite components, and a row
without an id, link with nothing and are kept.  Vectors of different lengths do not
link.  Repeated rows are linked copies.  Rows that repeat an id with other vectors are
one vertex, whose links add up.  Extra columns are not read.
"""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterloom.llm.common import Forest, column, shuffle_partitions, stage
from masterloom.llm.components import connected_components

RECALL = 0.98
BUCKET = 128
TILE = 2048
#: Small buckets are compared together up to this many items.
FILL = 384
EPSILON = 3.0
SEED = 7
#: Queries of a block that are estimated at once.
AT_ONCE = 512


def usable(vector: Column) -> Column:
    """Whether the vector has a direction: finite numbers only, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def tables_for(items: int, threshold: float) -> tuple[int, int]:
    """Bits of a bucket and number of tables for so many items."""
    bits = min(max(round(math.log2(max(items, 1) / BUCKET)), 4), 30) if items > BUCKET else 1
    alike = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - alike**bits))


def rotation(dim: int) -> np.ndarray:
    """A random rotation, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, rotate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (packed signs of the rotated unit vectors) and correction factors."""
    turned = _units(vectors) @ rotate.T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / math.sqrt(vectors.shape[1])


def _units(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small components stay finite.
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def index(items: DataFrame, bits: int, tables: int) -> DataFrame:
    """``items`` (``rep``, ``n``, ``vector``) with ``dim``, ``code``, ``factor`` and ``buckets``, one per table."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple] = {}
        for batch in batches:
            lists = batch.column("vector")
            dims = np.asarray(lists.value_lengths())
            for dim in np.unique(dims).tolist():
                if dim not in made:
                    planes = np.random.default_rng(SEED + 1).standard_normal((tables * bits, dim))
                    made[dim] = rotation(dim), planes
                rotate, planes = made[dim]
                some = batch.filter(pa.array(dims == dim))
                vectors = _matrix(some.column("vector"), dim)
                codes, factors = encode(vectors, rotate)
                sides = (vectors @ planes.T > 0).reshape(len(vectors), tables, bits)
                buckets = (sides * (1 << np.arange(bits, dtype=np.int64))).sum(2)
                yield pa.record_batch(
                    [
                        some.column("rep"),
                        some.column("n"),
                        some.column("vector"),
                        pa.array(np.full(len(vectors), dim, np.int32)),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(factors),
                        pa.array(list(buckets), pa.list_(pa.int64())),
                    ],
                    ["rep", "n", "vector", "dim", "code", "factor", "buckets"],
                )

    kind = items.schema["vector"].dataType.simpleString()
    key = items.schema["rep"].dataType.simpleString()
    schema = f"rep {key}, n long, vector {kind}, dim int, code binary, factor double, buckets array<long>"
    return items.mapInArrow(build, schema)


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def block_links(indexed: DataFrame, threshold: float) -> DataFrame:
    """``rep``, ``root`` and ``links`` of every item in every block in which it has a link.

    ``links`` counts the rows of items that are linked first in this block; ``root`` is
    the smallest item that it is connected with in the block.
    """
    placed = indexed.select("*", F.posexplode("buckets").alias("table", "bucket"))
    key = ["dim", "table", "bucket"]
    sizes = placed.groupBy(*key).count().filter(F.col("count") > TILE)
    large = sizes.select(*[F.col(c).alias(f"l_{c}") for c in key], F.ceil(F.col("count") / TILE).cast("int").alias("tiles"))
    on = (F.col("dim") == F.col("l_dim")) & (F.col("table") == F.col("l_table")) & (F.col("bucket") == F.col("l_bucket"))
    tiles = F.coalesce("tiles", F.lit(1))
    placed = placed.join(large, on, "left").withColumn("tile", F.pmod(F.xxhash64("rep"), tiles).cast("int"))
    other = F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other")
    placed = placed.select("rep", "n", "vector", "code", "factor", "buckets", *key, "tile", other)
    placed = placed.withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other"))
    group = [*key, "i", "j"]
    columns = [*group, "rep", "n", "tile", "vector", "code", "factor", "buckets"]
    spread = placed.select(*columns).repartition(shuffle_partitions(indexed.sparkSession), *group)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            found = _linked(block, threshold)
            if found:
                yield pa.record_batch(found, ["rep", "root", "links"])

    kind = indexed.schema["rep"].dataType.simpleString()
    return spread.sortWithinPartitions(*group, "rep").mapInArrow(compare, f"rep {kind}, root {kind}, links long")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of sorted rows, small ones of one table and length put together."""
    held = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held = pa.Table.from_batches(([] if held is None else held.to_batches()) + [batch])
        if held is None or not held.num_rows:
            continue
        keys = np.stack([held.column(c).to_numpy() for c in ("dim", "table", "bucket", "i", "j")], 1)
        changes = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        other_table = set((np.flatnonzero((keys[1:, :2] != keys[:-1, :2]).any(1)) + 1).tolist())
        ends = changes.tolist() + ([held.num_rows] if batch is None else [])
        begin = 0
        for at, end in enumerate(ends):
            following = ends[at + 1] if at + 1 < len(ends) else None
            if following is None or following - begin > FILL or end in other_table:
                if end - begin > 1:
                    yield held.slice(begin, end - begin)
                begin = end
        held = held.slice(begin)


def _linked(block: pa.Table, threshold: float) -> list[pa.Array] | None:
    block = block.combine_chunks()
    dim, table = block.column("dim")[0].as_py(), block.column("table")[0].as_py()
    vectors = _units(_matrix(block.column("vector").chunk(0), dim))
    codes = np.frombuffer(b"".join(block.column("code").to_pylist()), np.uint8).reshape(len(vectors), -1)
    factors = block.column("factor").to_numpy()
    buckets = np.stack(block.column("buckets").chunk(0).to_numpy(zero_copy_only=False))
    bucket, i, j, tile, n = (block.column(c).to_numpy() for c in ("bucket", "i", "j", "tile", "n"))
    signs = (2.0 * np.unpackbits(codes, axis=1, count=dim) - 1).astype(np.float32) / np.float32(math.sqrt(dim))
    signs /= factors[:, None].astype(np.float32)
    turned = (vectors @ rotation(dim).T).astype(np.float32)
    bound = EPSILON * np.sqrt(np.maximum(1 - factors**2, 0)) / factors / math.sqrt(max(dim - 1, 1))
    least = (threshold - bound - 1e-5).astype(np.float32)
    links, forest = np.zeros(len(vectors), np.int64), Forest(len(vectors))
    for begin in range(0, len(vectors), AT_ONCE):
        estimates = signs[begin : begin + AT_ONCE] @ turned[begin:].T
        a, b = np.nonzero(estimates >= least[begin : begin + AT_ONCE, None])
        a, b = a + begin, b + begin
        apart = (a < b) & (bucket[a] == bucket[b]) & (i[a] == i[b]) & (j[a] == j[b])
        apart &= (i[a] == j[a]) | (tile[a] != tile[b])
        a, b = a[apart], b[apart]
        for part in range(0, len(a), 1 << 16):
            x, y = a[part : part + (1 << 16)], b[part : part + (1 << 16)]
            near = (vectors[x] * vectors[y]).sum(1) >= threshold
            x, y = x[near], y[near]
            forest.join(x, y)
            first = (buckets[x] == buckets[y]).argmax(1) == table
            np.add.at(links, x[first], n[y[first]])
            np.add.at(links, y[first], n[x[first]])
    roots = forest.roots()
    touched = np.flatnonzero((links > 0) | (roots != np.arange(len(roots))))
    if not len(touched):
        return None
    reps = block.column("rep").chunk(0)
    return [reps.take(pa.array(touched)), reps.take(pa.array(roots[touched])), pa.array(links[touched])]


def embedding_components(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """``id``, ``n_links``, ``component`` and ``kept`` of every row."""
    key, vector = column(id_col).alias("id"), column(vector_col).alias("vector")
    rows = rows.select(key, vector)
    good = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    items = stage(good.groupBy("vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "vectors")
    bits, tables = tables_for(items.count(), threshold)
    links = stage(block_links(stage(index(items, bits, tables), "vector-index"), threshold), "vector-links")
    linked = connected_components(links.select("rep", "root"))
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = (
        items.join(counted.withColumnRenamed("rep", "c_rep"), F.col("rep") == F.col("c_rep"), "left")
        .join(linked, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("vector").alias("l_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    found = good.join(labels, F.col("vector") == F.col("l_vector")).select("id", "n_links", "component")
    rest = rows.filter(F.col("id").isNull() | ~usable(F.col("vector")))
    found = found.unionAll(rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")))
    return found.withColumn("kept", F.col("id").eqNullSafe(F.col("component")))
