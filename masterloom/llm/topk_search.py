"""Exact top-k search by integer inner product, with MaxScore over shards of postings.

A vector is a set of weighted terms: component t with weight floor(64 x).  Vectors are
ordered by their leading term and cut into shards; a shard keeps one posting list per
term (its weights, term by term) and each term's largest and smallest weight.  For a query,
a term's bound is the most it can add to a score in the shard.  With terms by falling
bound, those whose remaining sum of bounds still reaches the query's floor are essential:
their postings are traversed.  A vector outside them cannot compete.  The others are probed
one after another, for vectors whose score so far plus the remaining bounds reaches the
floor.  What is left has its exact score.

Queries run twice.  First within their own shard: the k-th best score there is the floor
that all other shards have to reach.  Then every block of queries meets every shard, in
cells of a grid; each shard gives its best k at most, and these are merged per query.

All arithmetic is exact: doubles where no sum can pass 2**53, Python's integers otherwise.

* Vectors that are null, or hold components that are null or whose 64-fold is not finite,
  take no part.  Shorter vectors weigh 0 in the terms that they lack; an empty vector
  scores 0 with all.
* The query's own row, and rows that repeat its id, are no candidates.  Other repeated rows
  are candidates each.  A query id that repeats gives one ranking per row.
* Ties go to the smaller id; rows without an id come last.  A row without an id is no query.
* Scores beyond a long count as the nearest long.  Fewer candidates than k: all of them.
* No rows, or no queries: no result.  Extra columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masterloom.llm.common import column, discard, shuffle_partitions, stage

SCALE = 64
#: Rows and weights of a shard at most (a shard has one vector at least).
SHARD_ROWS = 8192
SHARD_CELLS = 1 << 20
#: Shards, and blocks of queries, that meet in one cell of the grid at most.
CELL = 16
#: Scores that a task holds at once.
AT_ONCE = 1 << 20

INDEX = "shard long, kind string, terms int, ids array<long>, asks array<boolean>, weights binary"
BLOCKS = "shard long, kind string, terms int, ids array<long>, floors array<double>, weights binary"


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x * F.lit(float(SCALE))) < F.lit(float("inf")))), F.lit(False))


def index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard of ``rows`` (``id``, ``vector``, ``asks``): its postings, term by term."""
    size = F.transform("vector", F.abs)
    lead = F.array_position(size, F.array_max(size))
    sign = F.signum(F.try_element_at("vector", lead.cast("int")))
    keys = [F.coalesce(lead * sign, F.lit(0.0)), F.xxhash64("vector"), F.col("id")]
    keyed = rows.select("id", "vector", "asks", *[k.alias(f"key{i}") for i, k in enumerate(keys)])
    names = ["key0", "key1", "key2"]
    spread = keyed.repartitionByRange(shuffle_partitions(rows.sparkSession), *names).sortWithinPartitions(*names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for ids, asks, weights in _shards(batches, shard_rows):
            kind, data = _packed(weights.T)
            row = [[number], [kind], [weights.shape[1]], [ids], [asks], [data]]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary()]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(row, kinds)], ["shard", "kind", "terms", "ids", "asks", "weights"])
            number += 1

    return spread.select("id", "vector", "asks").mapInArrow(build, INDEX)


def _shards(batches: Iterator[pa.RecordBatch], shard_rows: int) -> Iterator[tuple[list, list, np.ndarray]]:
    """Ids, query marks and weights (a row per vector) of one shard after another."""
    ids, asks, vectors, widest = [], [], [], 0

    def made() -> tuple[list, list, np.ndarray]:
        weights = np.zeros((len(vectors), widest))
        for row, vector in zip(weights, vectors):
            row[: len(vector)] = np.floor(vector * SCALE)
        return ids, asks, weights

    for batch in batches:
        lists = batch.column("vector")
        values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        marks = zip(batch.column("id").to_pylist(), batch.column("asks").to_pylist(), offsets, offsets[1:])
        for key, ask, begin, end in marks:
            wider = max(widest, end - begin)
            if vectors and (len(vectors) >= shard_rows or (len(vectors) + 1) * wider > SHARD_CELLS):
                yield made()
                ids, asks, vectors, wider = [], [], [], end - begin
            widest = wider
            ids.append(key)
            asks.append(ask)
            vectors.append(values[begin:end].copy())
    if vectors:
        yield made()


def _packed(weights: np.ndarray) -> tuple[str, bytes]:
    """The numbers in the smallest type that holds all of them."""
    most = np.abs(weights).max(initial=0)
    kind = next((k for k in ("i1", "i2", "i4") if most <= np.iinfo(k).max), "f8")
    return f"<{kind}", weights.astype(f"<{kind}").tobytes()


def _unpacked(kind: str, data: bytes, rows: int, columns: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(rows, columns).astype(np.float64)


class Shard:
    """Posting lists of a shard, term by term, and what each can add at most."""

    def __init__(self, ids: list, postings: np.ndarray) -> None:
        self.null = np.array([i is None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.postings = postings
        none = np.zeros(len(postings))
        self.most = postings.max(1) if postings.size else none
        self.least = postings.min(1) if postings.size else none

    def best(self, queries: np.ndarray, own: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, place in the shard and score of each query's best ``k`` that reach its floor."""
        terms = min(queries.shape[1], len(self.postings))
        queries, postings, most, least = queries[:, :terms], self.postings[:terms], self.most[:terms], self.least[:terms]
        largest = max(np.abs(most).max(initial=0), np.abs(least).max(initial=0))
        if terms * float(np.abs(queries).max(initial=0)) * float(largest) >= 2.0**53:
            queries, postings, most, least = map(_integers, (queries, postings, most, least))
        found = []
        step = max(1, AT_ONCE // max(len(self.ids), 1))
        for begin in range(0, max(len(queries), 1), step):
            part = slice(begin, begin + step)
            q, place, score = self._competitive(queries[part], floors[part], postings, most, least)
            other = self.null[place] | (self.ids[place] != own[part][q])
            q, place, score = q[other], place[other], _longs(score[other])
            order = np.lexsort((self.ids[place], self.null[place], -score, q))
            q, place, score = q[order], place[order], score[order]
            first = np.arange(len(q)) - np.searchsorted(q, q, "left") < k
            found.append((q[first] + begin, place[first], score[first]))
        return tuple(map(np.concatenate, zip(*found)))

    def _competitive(self, queries, floors, postings, most, least) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, place and score of all vectors that reach their query's floor."""
        bounds = np.maximum(queries * most, queries * least)
        order = np.argsort(-bounds, 1, kind="stable")
        falling = np.take_along_axis(bounds, order, 1)
        # rest[:, i]: what the terms from place i on can add.
        rest = np.zeros((len(queries), queries.shape[1] + 1), falling.dtype)
        rest[:, :-1] = np.cumsum(falling[:, ::-1], 1)[:, ::-1]
        hopeless = (rest < floors[:, None]).astype(bool)
        essential = np.where(hopeless.any(1), hopeless.argmax(1), queries.shape[1])
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], 1)
        # Essential postings are traversed for all queries together.
        scores = np.where(rank < essential[:, None], queries, 0) @ postings
        left = np.take_along_axis(rest, essential[:, None], 1)
        q, place = np.nonzero(((scores + left) >= floors[:, None]).astype(bool))
        score, at = scores[q, place], essential[q]
        done = []
        while len(q):  # probe the next term of each, while it is competitive
            over = at == queries.shape[1]
            done.append((q[over], place[over], score[over]))
            q, place, score, at = (x[~over] for x in (q, place, score, at))
            term = order[q, at]
            score, at = score + queries[q, term] * postings[term, place], at + 1
            alive = (score + rest[q, at] >= floors[q]).astype(bool)
            q, place, score, at = (x[alive] for x in (q, place, score, at))
        return tuple(map(np.concatenate, zip(*done))) if done else (q, place, score)


def _integers(weights: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in weights.flat], object).reshape(weights.shape)


def _longs(scores: np.ndarray) -> np.ndarray:
    """Exact scores as longs; what is beyond them as the nearest."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([max(-(1 << 63), min(int(s), (1 << 63) - 1)) for s in scores], np.int64)


def _floors(scores: np.ndarray) -> np.ndarray:
    """Scores as doubles, never above them; the least long may stand for any lower score."""
    floors = scores.astype(np.float64)
    floors[np.abs(floors) >= 2.0**53] = np.nextafter(floors[np.abs(floors) >= 2.0**53], -np.inf)
    return np.where(floors <= -(2.0**63), -np.inf, floors)


def query_blocks(shards: DataFrame, k: int) -> DataFrame:
    """The queries of each shard, with the score of the k-th best vector of their own shard."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asks = np.array(row["asks"], bool)
                if not asks.any():
                    continue
                postings = _unpacked(row["kind"], row["weights"], row["terms"], len(asks))
                shard, queries = Shard(row["ids"], postings), np.ascontiguousarray(postings.T[asks])
                q, _, score = shard.best(queries, shard.ids[asks], np.full(len(queries), -np.inf), k)
                floors = np.full(len(queries), -np.inf)
                ends = np.searchsorted(q, np.arange(len(queries)), "right")
                enough = ends - np.searchsorted(q, np.arange(len(queries)), "left") == k
                floors[enough] = _floors(score[ends[enough] - 1])
                kind, data = _packed(queries)
                yield pa.record_batch(
                    [
                        pa.array([row["shard"]], pa.int64()),
                        pa.array([kind]),
                        pa.array([row["terms"]], pa.int32()),
                        pa.array([shard.ids[asks].tolist()], pa.list_(pa.int64())),
                        pa.array([floors.tolist()], pa.list_(pa.float64())),
                        pa.array([data], pa.binary()),
                    ],
                    ["shard", "kind", "terms", "ids", "floors", "weights"],
                )

    return shards.mapInArrow(ask, BLOCKS)


def grid(shards: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every block of queries (``floors`` not null) beside every shard, by cell (``i``, ``j``).

    Shards per cell grow with their number up to ``CELL``; cells are more than tasks.
    """
    partitions = shuffle_partitions(shards.sparkSession)
    count = max(shards.count(), 1)
    per = min(max(int(count / (2 * partitions) ** 0.5), 1), CELL)
    cells = -(-count // per)
    mine = F.pmod(F.xxhash64("shard"), F.lit(cells)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    common = ["shard", "kind", "terms", "ids", "weights"]
    asked = blocks.select(*common, "floors", mine.alias("i")).select("*", others.alias("j"))
    stored = shards.select(*common, F.lit(None).cast("array<double>").alias("floors"), mine.alias("j")).select("*", others.alias("i"))
    both = asked.unionByName(stored).withColumn("stored", F.col("floors").isNull())
    return both.repartition(partitions, "i", "j").sortWithinPartitions("i", "j", "stored", "shard")


def _answers(cells: DataFrame, k: int) -> DataFrame:
    """``ask`` (a number per query row), ``query_id``, ``vec_id`` and ``score`` of each shard's best."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, blocks = None, []
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                if (row["i"], row["j"]) != cell:
                    cell, blocks = (row["i"], row["j"]), []
                if not row["stored"]:
                    weights = _unpacked(row["kind"], row["weights"], len(row["ids"]), row["terms"])
                    blocks.append((row["shard"], np.array(row["ids"], np.int64), np.array(row["floors"]), weights))
                    continue
                shard = Shard(row["ids"], _unpacked(row["kind"], row["weights"], row["terms"], len(row["ids"])))
                for number, ids, floors, weights in blocks:
                    q, place, score = shard.best(weights, ids, floors, k)
                    yield pa.record_batch(
                        [
                            pa.array(np.full(len(q), number)),
                            pa.array(q, pa.int32()),
                            pa.array(ids[q]),
                            pa.array(shard.ids[place], mask=shard.null[place]),
                            pa.array(score),
                        ],
                        ["block", "ask", "query_id", "vec_id", "score"],
                    )

    return cells.mapInArrow(answer, "block long, ask int, query_id long, vec_id long, score long")


def top_k(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    every: int = 20,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``k`` best of each row whose id is divisible by ``every``."""
    key, vector = column(id_col).cast("long").alias("id"), column(vector_col).cast("array<double>").alias("vector")
    taking = rows.select(key, vector).filter(usable(F.col("vector")))
    taking = taking.withColumn("asks", F.coalesce(F.col("id") % every == 0, F.lit(False)))
    shards = stage(index(taking, shard_rows), "search-index")
    blocks = stage(query_blocks(shards, k), "search-queries")
    found = stage(_answers(grid(shards, blocks), k), "search-answers")
    discard(shards)
    discard(blocks)
    order = Window.partitionBy("block", "ask").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: The same for DuckDB.  Fixed: scale, k, the ids that are queries.
ORACLE = r"""
WITH scaled AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(64 * x::DOUBLE))) = 0
), scored AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM scaled q JOIN scaled c ON c.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id ASC NULLS LAST))::INTEGER AS "rank", vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id ASC NULLS LAST) <= 20
"""
