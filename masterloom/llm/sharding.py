"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Shards are cut into blocks of slots, and rows come in parts.  How many rows of a part go
to each block is drawn from the multivariate hypergeometric distribution, which is that
of a uniform shuffle; so every block gets exactly its size.  Then each part permutes its
rows and deals them out by its row of the matrix, rows are exchanged, and each block
permutes what it has got.  The result is a uniform permutation of all rows, but no task
ever holds more than a part or a block.

Everything drawn follows from the seed and the rows' hashes: a task that runs again draws
the same, and the matrix (parts by blocks, each of about ``ROWS`` rows) is all that the
driver holds.

A row's part is a hash of the whole row.  Rows equal in every column, if they are many,
are counted instead and dealt to all parts in turn, so that no part is larger for them.

Shard sizes differ by one at most; with fewer rows than shards some shards are empty, and
no rows give none.  Null ids and values count as such; rows that are equal in every
column are interchangeable.  Extra columns are kept.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masterloom.llm.common import fresh, quoted

#: Rows of a part or a block, at least where there are that many: a task sorts so many whole rows.
ROWS = 250_000
#: Parts and blocks at most (blocks: and one more per shard); larger tables have larger ones,
#: which Spark sorts outside memory.  So the matrix has at most about a million cells.
MOST_PARTS = 1000
#: Parts of a small table.
LEAST_PARTS = 64
#: Equal rows are dealt to the parts in turn if they are more than this, and than a share of a part.
MANY_EQUAL = 1000
#: Equal rows that one task makes out of their count.
COPIES = 100_000
#: Ranges of places per part in the join with the matrix.
RANGES = 256
#: Up to this many rows numpy draws hypergeometric numbers itself.
NUMPY_ROWS = 10**9 - 1


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` rows out of ``good + bad`` are good; exact at any size."""
    if good + bad <= NUMPY_ROWS:
        return int(rng.hypergeometric(good, bad, drawn))
    # Search outwards from the mode until the probabilities met exceed a uniform number.
    low, high = max(0, drawn - bad), min(good, drawn)
    mode = min(max((drawn + 1) * (good + 1) // (good + bad + 2), low), high)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, drawn - mode) - log_choose(good + bad, drawn))
    left, up, down, p_up, p_down = rng.random() - at_mode, mode, mode, at_mode, at_mode
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up, left = up + 1, left - p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down, left = down - 1, left - p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(parts: list[int], blocks: list[int], seed: int) -> np.ndarray:
    """Rows from each part to each block: exact margins, distributed as in a uniform shuffle."""
    rng, free = np.random.default_rng(seed), list(blocks)
    matrix = np.zeros((len(parts), len(blocks)), np.int64)
    for p, rows in enumerate(parts):
        rest = sum(free)
        for b, room in enumerate(free):
            if not rows:
                break
            rest -= room
            matrix[p, b] = n = hypergeometric(rng, room, rest, rows) if room else 0
            free[b], rows = room - n, rows - n
    return matrix


def shard(df: DataFrame, shards: int, seed: int = 0, rows_each: int = ROWS) -> DataFrame:
    """``df`` with ``shard`` (from 0) and ``slot`` (place in the shard, gapless from 0).

    Columns of these two names, in any case, are replaced; other extra columns are kept.
    The table is read three times: pass a written one if it is costly to make.
    """
    spark = df.sparkSession
    part, place, hashed, number_in_part = (fresh(df, stem) for stem in ("part", "place", "hash", "number"))
    columns = [fresh(df, stem) for stem in ("m_part", "shard", "m_begin", "m_from", "m_to", "m_range")]
    m_part, number, m_begin, m_from, m_to, m_range = columns
    rows = df.count()
    rows_each = max(rows_each, -(-rows // MOST_PARTS))
    # From the rows alone, so that the result does not depend on the session's settings.
    n_parts = max(1, -(-rows // rows_each), min(LEAST_PARTS, rows // 64))
    keyed, counted = _parts(df, part, hashed, rows, n_parts, seed)
    sizes = shard_sizes(rows, shards)
    blocks = [
        (number, begin, min(rows_each, size - begin)) for number, size in enumerate(sizes) for begin in range(0, size, rows_each)
    ]
    matrix = communication_matrix([counted.get(p, 0) for p in range(n_parts)], [n for _, _, n in blocks], seed)
    ends = matrix.cumsum(1)
    # A row meets the cells of its own range of places only, a few of its part's.
    width = max(1, -(-max(counted.values(), default=1) // RANGES))
    cells = [
        (p, to, begin, int(ends[p, b] - matrix[p, b]), int(ends[p, b]), r)
        for p in range(n_parts)
        for b, (to, begin, _) in enumerate(blocks)
        if matrix[p, b]
        for r in range(int(ends[p, b] - matrix[p, b]) // width, int(ends[p, b] - 1) // width + 1)
    ]
    kinds = ("int", "int", "long", "long", "long", "long")
    dealt = spark.createDataFrame(pd.DataFrame(cells, columns=columns), ", ".join(map(" ".join, zip(columns, kinds))))
    # Numbers tell equal rows apart, so that they are permuted like any others.
    numbered = Window.partitionBy(part).orderBy(hashed, *_sortable(df))
    keyed = keyed.withColumn(number_in_part, F.row_number().over(numbered))
    within = Window.partitionBy(part).orderBy(F.xxhash64(F.lit(seed + 1), hashed, number_in_part), number_in_part)
    permuted = keyed.withColumn(place, F.row_number().over(within) - 1)
    inside = (F.col(place) >= F.col(m_from)) & (F.col(place) < F.col(m_to))
    on = (F.col(part) == F.col(m_part)) & (F.floor(F.col(place) / width) == F.col(m_range)) & inside
    kept = [F.col(quoted(c)) for c in df.columns if c.lower() not in ("shard", "slot")]
    sent = permuted.join(F.broadcast(dealt), on).select(*kept, part, hashed, number_in_part, number, m_begin)
    again = F.xxhash64(F.lit(seed + 2), part, hashed, number_in_part)
    in_block = Window.partitionBy(number, m_begin).orderBy(again, part, number_in_part)
    slot = (F.col(m_begin) + F.row_number().over(in_block) - 1).cast("long")
    return sent.select(*kept, F.col(number).alias("shard"), slot.alias("slot"))


def _whole(df: DataFrame) -> list[Column]:
    return [F.col(quoted(c)) for c in df.columns]


def _parts(df: DataFrame, part: str, hashed: str, rows: int, n_parts: int, seed: int) -> tuple[DataFrame, dict[int, int]]:
    """``df`` with the part and the hash of each row, and how many rows each part has.

    At most ``4 * n_parts`` hashes are of rows that are many; only these come to the driver.
    """
    count, number, step, first = (fresh(df, stem) for stem in ("count", "number", "step", "first"))
    hash_ = F.xxhash64(F.lit(seed), *_whole(df))
    own = F.pmod(F.col(hashed), F.lit(n_parts)).cast("int")
    with_hash = df.withColumn(hashed, hash_)
    groupable = all(f.dataType.typeName() != "variant" for f in df.schema.fields)
    most = max(MANY_EQUAL, rows // (4 * n_parts)) if groupable else rows
    counts = with_hash.groupBy(hashed).agg(F.count(F.lit(1)).alias(count))
    per_part = counts.groupBy(own.alias(part)).agg(
        F.sum(F.when(F.col(count) <= most, F.col(count)).otherwise(0)).alias("few"),
        F.collect_list(F.when(F.col(count) > most, F.struct(F.col(hashed).alias("hash"), F.col(count).alias("count")))).alias("many"),
    )
    found = per_part.collect()
    counted = dict.fromkeys(range(n_parts), 0) | {r[part]: r["few"] for r in found}
    many = [(r[part], m["hash"], m["count"]) for r in found for m in r["many"]]
    for begin, _, n in many:
        for k in range(min(n, n_parts)):
            counted[(begin + k) % n_parts] += n // n_parts + (k < n % n_parts)
    if not many:
        return with_hash.withColumn(part, own), counted
    listed = F.col(hashed).isin([h for _, h, _ in many])
    few = with_hash.filter(~listed).withColumn(part, own)
    groups = with_hash.filter(listed).groupBy(hashed, *_whole(df)).agg(F.count(F.lit(1)).alias(count))
    # Rows of one hash that are not equal are numbered on, so that each number is met once.
    before = Window.partitionBy(hashed).orderBy(*_sortable(df)).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn(first, F.coalesce(F.sum(count).over(before), F.lit(0)))
    steps = groups.withColumn(step, F.explode(F.sequence(F.lit(0), F.floor((F.col(count) - 1) / COPIES))))
    steps = steps.repartition(F.col(hashed), F.col(step))
    ends = F.least(F.col(count), (F.col(step) + 1) * COPIES) - 1
    copies = steps.withColumn(number, F.explode(F.sequence(F.col(step) * COPIES, ends)))
    turn = F.pmod(F.col(hashed), F.lit(n_parts)) + F.col(first) + F.col(number)
    dealt = F.pmod(turn, F.lit(n_parts)).cast("int")
    return few.unionByName(copies.select(*_whole(df), hashed, dealt.alias(part))), counted


def _sortable(df: DataFrame) -> list[Column]:
    """Columns that break ties of the hash; maps and the like cannot be ordered."""
    simple = {f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")}
    return [F.col(quoted(c)) for c in df.columns if c in simple]


def write_shards(df: DataFrame, shards: int, path: str, seed: int = 0) -> None:
    """One folder per shard, rows in the order of their slots; blocks are separate files."""
    placed = shard(df, shards, seed)
    block = F.floor(F.col("slot") / ROWS)
    placed.repartition("shard", block).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digests(docs: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``size``, ``text_crc32`` of every document as it lies in its shard, with shard and slot.

    The documents themselves are permuted and exchanged; a null text counts as an empty one.
    """
    id_, text = fresh(docs, "doc_id"), fresh(docs, "text")
    # Names of their own, as a column named like an output is replaced.
    rows = docs.withColumn(id_, F.col(quoted(id_col))) if id_col.lower() in ("shard", "slot") else docs
    rows = rows.withColumn(text, F.col(quoted(text_col))) if text_col.lower() in ("shard", "slot") else rows
    placed = shard(rows, shards, seed)
    doc = F.col(id_ if id_ in rows.columns else quoted(id_col))
    body = F.coalesce(F.col(text if text in rows.columns else quoted(text_col)), F.lit(""))
    size = (F.octet_length(body) + 8).cast("long").alias("size")
    return placed.select(doc.alias("id"), size, F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), "shard", "slot")
