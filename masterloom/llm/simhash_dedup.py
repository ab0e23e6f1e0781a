"""SimHash near-duplicates: fingerprints, bit-sliced comparison, groups of documents.

Exact copies of a fingerprint are one item.  Items that differ in at most ``radius``
bits agree on one of ``radius + 1`` parts of the bits, so only items that agree on a
part are compared.  A part's groups that are larger than a block are divided again by
the same rule on the bits not yet used, until every group fits: exact at every step,
and the more items there are, the more bits their groups agree on.

Within a block the fingerprints lie as bit planes: word ``w`` of plane ``p`` holds bit
``p`` of 64 items.  One operation then updates 64 distances, kept as carry-save
counters (ones, twos, and "over"), and a (query, word) cell whose 64 distances are all
over the radius is abandoned.

Null and empty texts have no words and the fingerprint zero, and link like any other.
A null id is no id: it takes part, but a component's id is the smallest id that is
not null (null if there is none).  Repeated rows are copies.  Extra columns are kept.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from masterloom.llm.common import Forest, column, fresh, shuffle_partitions, stage, word_runs
from masterloom.llm.components import connected_components

#: Groups up to this many fingerprints are compared as one block; larger ones are divided.
BLOCK = 4096
#: Small groups are compared together up to this many, to fill the words of the planes.
FILL = 512
#: Planes between two looks at which cells are over.
STRIDE = 8
SEED = 42
ALL = (1 << 64) - 1


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of one text, as a signed long."""
    counts, total = np.zeros(64, np.int64), 0
    tail: list[bytes] = []
    short: list[bytes] = []
    for words in word_runs((text or "").encode().lower()):
        words = tail + words
        if len(words) < shingle:
            tail = words
            short = words
            continue
        hashes = _shingle_hashes(words, shingle)
        total += len(hashes)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        tail = words[len(words) - shingle + 1 :]
    if not total:
        if not short:
            return 0
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(short), SEED)], "<u8")
        total, counts = 1, np.unpackbits(hashes.view(np.uint8), bitorder="little").astype(np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def _shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]), ">u8")


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The SimHash of a text column, as a signed long; whole texts, never null."""

    @arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())

    # Not to be computed again for a filter that is pushed below it.
    return simhash.asNondeterministic()(text)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """``id``, ``fp`` (long), ``component`` (smallest linked id) and ``root`` of every row.

    ``root`` is the smallest fingerprint of the component, as a signed long.
    """
    marked = docs.select(column(id_col).alias("id"), fingerprints(column(text_col), shingle).alias("fp"))
    return _components(stage(marked, "simhash"), radius)


def _components(marked: DataFrame, radius: int) -> DataFrame:
    """The same for a written table of ids and fingerprints."""
    items = marked.groupBy("fp").agg(F.min("id").alias("first"))
    linked = connected_components(fingerprint_links(items.select("fp"), radius))
    members = items.join(linked, items["fp"] == linked["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    members = stage(members, "simhash-members")
    least = members.groupBy("root").agg(F.min("first").alias("component"))
    labels = members.join(least, "root").select(F.col("fp").alias("key"), "root", "component")
    return marked.join(labels, F.col("fp") == F.col("key")).select("id", "fp", "root", "component")


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each component stays.

    It is the row with the component's id; a component without any id keeps the row
    with its smallest fingerprint.  Of several such rows the first by text stays.
    The documents are written down with their fingerprints, which are computed once.
    """
    fp, turn, k_id, k_fp = (fresh(docs, stem) for stem in ("fp", "turn", "k_id", "k_fp"))
    rows = stage(docs.withColumn(fp, fingerprints(column(text_col), shingle)), "simhash-documents", codec="zstd")
    groups = _components(rows.select(column(id_col).alias("id"), F.col(fp).alias("fp")), radius)
    kept = groups.groupBy("root").agg(F.min(F.struct(F.isnull("id"), F.col("id"), F.col("fp"))).alias("k"))
    kept = kept.select(F.col("k.id").alias(k_id), F.col("k.fp").alias(k_fp))
    rows = rows.join(kept, column(id_col).eqNullSafe(F.col(k_id)) & (column(fp) == F.col(k_fp)), "left_semi")
    first = Window.partitionBy(column(id_col), column(fp)).orderBy(column(text_col))
    return rows.withColumn(turn, F.row_number().over(first)).filter(column(turn) == 1).drop(turn, fp)


def fingerprint_links(items: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints within ``radius`` of each other.

    ``items`` is one long column of distinct fingerprints.  A block gives a tree of
    links for what is connected in it, not its pairs.
    """
    (fp,) = items.columns
    small, level = [], items.select(column(fp).alias("fp"), F.lit(0).alias("mask"))
    masks = [0]
    while masks:
        # The masks of a level are few: four times as many as of the level before, at most.
        finer = [(_signed(m), _signed(m | p)) for m in masks for p in _parts(m, radius)]
        finer = F.broadcast(items.sparkSession.createDataFrame(finer, "coarse long, fine long"))
        level = level.join(finer, F.col("mask") == F.col("coarse")).select("fp", F.col("fine").alias("mask"))
        level = level.withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        large = level.groupBy("mask", "part").count().filter(F.col("count") > BLOCK)
        large = stage(large.select(F.col("mask").alias("m"), F.col("part").alias("p")), "simhash-large")
        on = (F.col("mask") == F.col("m")) & (F.col("part") == F.col("p"))
        masks = [r["m"] % (1 << 64) for r in large.select("m").distinct().collect()]  # one of a level's parts each
        small.append(level.join(large, on, "left_anti") if masks else level)
        level = level.join(large, on, "left_semi").select("fp", "mask") if masks else level
    grouped = small[0]
    for more in small[1:]:
        grouped = grouped.unionAll(more)
    spread = grouped.repartition(shuffle_partitions(items.sparkSession), "mask", "part")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            roots = block_roots(block, radius)
            linked = roots != np.arange(len(block))
            if linked.any():
                a, b = block[linked].view(np.int64), block[roots[linked]].view(np.int64)
                yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    return spread.sortWithinPartitions("mask", "part", "fp").mapInArrow(compare, "a long, b long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _parts(mask: int, radius: int) -> list[int]:
    """The bits outside the mask in ``radius + 1`` parts of consecutive bits."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [sum(1 << int(b) for b in part) for part in np.array_split(rest, radius + 1)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Whole groups of sorted rows, small ones put together; a group has at most BLOCK rows."""
    held = np.zeros((0, 3), np.int64)
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            new = np.stack([batch.column(c).to_numpy() for c in ("mask", "part", "fp")], 1)
            held = np.concatenate([held, new])
        if not len(held):
            continue
        starts = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(1)) + 1
        ends = np.append(starts, len(held)) if batch is None else starts
        begin = 0
        for i, end in enumerate(ends):
            after = ends[i + 1] if i + 1 < len(ends) else None
            if after is None or after - begin > FILL:
                if end - begin > 1:
                    yield np.unique(held[begin:end, 2].view(np.uint64))
                begin = end
        held = held[begin:]


def bit_planes(items: np.ndarray) -> np.ndarray:
    """Planes by words: bit i of word w of plane p is bit p of item 64 w + i."""
    bits = np.unpackbits(items.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    padded = np.zeros((-(-len(items) // 64) * 64, 64), np.uint8)
    padded[: len(items)] = bits
    return np.ascontiguousarray(np.packbits(padded.T, axis=1, bitorder="little")).view("<u8")


def block_roots(items: np.ndarray, radius: int) -> np.ndarray:
    """For each item the smallest place of an item that it is connected with in the block."""
    planes = bit_planes(items)
    # Planes that divide the block evenly bring unlike items over the radius soonest.
    ones = np.bitwise_count(planes).sum(1)
    order = np.argsort(np.abs(2 * ones.astype(np.int64) - len(items)), kind="stable")
    valid = np.packbits(np.arange(planes.shape[1] * 64) < len(items), bitorder="little").view("<u8")
    forest = Forest(len(items))
    step = max(1, (1 << 17) // planes.shape[1])
    for begin in range(0, len(items), step):
        query, found = _within(items[begin : begin + step], planes, order, valid, radius)
        forest.join(query + begin, found)
    return forest.roots()


def _within(queries: np.ndarray, planes: np.ndarray, order: np.ndarray, valid: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, item) within the radius, the query itself included."""
    words = planes.shape[1]
    q, w = np.repeat(np.arange(len(queries)), words), np.tile(np.arange(words), len(queries))
    # Counters start so high that they overflow when a distance passes the radius.
    digits = radius.bit_length()
    start = (1 << digits) - 1 - radius
    counter = [np.full(len(q), ALL if start >> d & 1 else 0, np.uint64) for d in range(digits)]
    over = ~valid[w]
    for at in range(0, 64, STRIDE):
        for plane in order[at : at + STRIDE]:
            flip = (queries >> np.uint64(plane) & np.uint64(1)) * np.uint64(ALL)
            carry = planes[plane][w] ^ flip[q]
            for d in range(digits):  # carry-save: each digit keeps its sum and hands on the carry
                counter[d], carry = counter[d] ^ carry, counter[d] & carry
            over |= carry
        alive = np.flatnonzero(~over)  # a cell whose 64 distances are all over is abandoned
        q, w, over, counter = q[alive], w[alive], over[alive], [c[alive] for c in counter]
    cells = ~over
    bits = np.unpackbits(cells.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    cell, bit = np.nonzero(bits)
    return q[cell], w[cell] * 64 + bit
