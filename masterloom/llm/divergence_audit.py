"""Source divergence audit: how far the word use of a language's sources is apart.

Every group (language, source), and every language, gives each term that the language
keeps p = 1 + floor(scale (count + 1) / (N + V)); a group differs from another by
f = floor((p - q)^2 / q), summed over all kept terms.

The sum is taken over run-length columns.  A term's counts in the sources of its language
are its signature.  Terms with equal signatures are one run; signatures are ordered by
their first source and its count, then the next, so that equal counts of one source lie
together, and cut into blocks.  In a block each group's column is its counts, run-length
encoded, with 0 where it lacks the terms.  For two groups the run boundaries are
intersected, and f, computed once for each stretch between boundaries, is multiplied by its
length.  Sums of blocks are added up.

A block has a bounded number of cells; sources are dealt into tiles, and two tiles of one
block meet in a task, so neither a language nor a source ever lies in one.  A group's total
is sent along with its columns.

* A null text, language or source is ''.  A group without terms is a group.
* Repeated rows count as documents each.  The document's id is not read.
* Arithmetic is exact: whole numbers, in Python's where 64 bits could overflow.
* No rows give no rows; a language with one source has no pairs.  Extra columns are not read.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masterloom.llm.common import column, shuffle_partitions, stage, word_runs

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
#: Cells (counts that are not 0) of a block at most, but for one signature.
BLOCK_CELLS = 1 << 18
#: Sources of a language that are met with as many others in one task.
TILE = 256
#: Terms that a task holds before it hands on their counts.
HELD = 200_000
#: Groups of a language are copied so often when they join its blocks or terms.
SALTS = 16

#: ASCII letters in lower case, other bytes of UTF-8 characters as they are, all else space.
LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs``.

    All rows of a term of a language are in one partition: as many as there are sources
    and tasks that have it.  Tasks have added up their own texts before that shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                terms: Counter[bytes] = Counter()
                for run in word_runs(text.encode().translate(LETTERS)):
                    terms.update(run)
                group = held.setdefault((lang, source), {})
                size -= len(group)
                for term, n in terms.items():
                    known = group.get(term)
                    if known:
                        known[0] += n
                        known[1] += 1
                    else:
                        group[term] = [n, 1]
                size += len(group)
                if size > HELD:
                    yield from _emitted(held)
                    held, size = {}, 0
        yield from _emitted(held)

    texts = [filled(c).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    found = docs.select(*texts).mapInArrow(count, "lang string, source string, term string, n long, docs long")
    spread = found.repartition("lang", "term")
    return spread.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def filled(name: str) -> Column:
    """A column as text, '' where null."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def _emitted(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), terms in held.items():
        words = pa.array(list(terms), pa.binary()).cast(pa.string())
        n, docs = zip(*terms.values()) if terms else ((), ())
        same = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(words), np.int32))) for x in (lang, source)]
        yield pa.record_batch([*same, words, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang``, ``term``, ``n`` and ``cells`` (source and count, by source) of every kept term."""
    cells = F.sort_array(F.collect_list(F.struct("source", "n")))
    found = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), cells.alias("cells"))
    return found.filter(F.col("docs") >= min_docs).select("lang", "term", "n", "cells")


def group_totals(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``total`` (N + V) and ``lang_total`` of ``groups``."""
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("n")).withColumnRenamed("lang", "l_lang")
    cells = kept.select("lang", F.explode("cells").alias("c")).select(F.col("lang").alias("g_lang"), F.col("c.source").alias("g_source"), "c.n")
    sums = cells.groupBy("g_lang", "g_source").agg(F.sum("n").alias("g_n"))
    zero = F.lit(0).cast("long")
    return (
        groups.join(sums, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")), "left")
        .join(langs, F.col("lang") == F.col("l_lang"), "left")
        .select(
            "lang",
            "source",
            (F.coalesce("g_n", zero) + F.coalesce("terms", zero)).alias("total"),
            (F.coalesce("n", zero) + F.coalesce("terms", zero)).alias("lang_total"),
        )
    )


# --- run-length columns


def columns_of(kept: DataFrame, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """``lang``, ``block``, ``length``, ``source``, ``starts`` and ``counts``: one run-length column per group and block.

    A row with a null source stands for the block itself.
    """
    runs = kept.groupBy("lang", "cells").agg(F.count(F.lit(1)).alias("length"))
    ordered = runs.repartitionByRange(shuffle_partitions(kept.sparkSession), "lang", "cells").sortWithinPartitions("lang", "cells")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, block, held = None, None, 0
        for batch in batches:
            for n in range(batch.num_rows):
                cells = batch.column("cells")[n].as_py()
                here = batch.column("lang")[n].as_py()
                if block is None or here != lang or held + len(cells) > block_cells:
                    if block is not None:
                        yield block.columns(lang)
                    lang, block, held = here, Block(), 0
                block.add(cells, batch.column("length")[n].as_py())
                held += len(cells)
        if block is not None:
            yield block.columns(lang)

    return ordered.mapInArrow(encode, "lang string, block string, length long, source string, starts array<long>, counts array<long>")


class Block:
    """Consecutive signatures of a language, as one run-length column per source."""

    def __init__(self) -> None:
        self.length, self.first = 0, None
        self.starts: dict[str, list[int]] = {}
        self.counts: dict[str, list[int]] = {}

    def add(self, cells: list[dict], length: int) -> None:
        """``length`` terms with these counts."""
        # The first signature names the block: it is in no other.
        self.first = self.first or repr([(c["source"], c["n"]) for c in cells])
        for cell in cells:
            source, n = cell["source"], cell["n"]
            if source not in self.starts:
                self.starts[source], self.counts[source] = [0], [0]
            starts, counts = self.starts[source], self.counts[source]
            if counts[-1] == 0 and starts[-1] == self.length:
                starts.pop(), counts.pop()  # the run of zeros that ended here is empty
            if not counts or counts[-1] != n:
                starts.append(self.length)
                counts.append(n)
            # Zeros again, until this source has the next signature too.
            starts.append(self.length + length)
            counts.append(0)
        self.length += length

    def columns(self, lang: str) -> pa.RecordBatch:
        sources = list(self.starts)
        rows = len(sources) + 1
        # A last run of zeros that reaches the end is empty.
        lasts = [self.starts[s][-1] == self.length for s in sources]
        starts = [self.starts[s][:-1] if last else self.starts[s] for s, last in zip(sources, lasts)]
        counts = [self.counts[s][:-1] if last else self.counts[s] for s, last in zip(sources, lasts)]
        return pa.record_batch(
            [
                pa.array([lang] * rows),
                pa.array([self.first] * rows),
                pa.array([self.length] * rows, pa.int64()),
                pa.array([None, *sources], pa.string()),
                pa.array([None, *starts], pa.list_(pa.int64())),
                pa.array([None, *counts], pa.list_(pa.int64())),
            ],
            ["lang", "block", "length", "source", "starts", "counts"],
        )


def probabilities(counts: np.ndarray, total: int, scale: int = SCALE) -> np.ndarray:
    """p of each count, as whole numbers."""
    if (int(counts.max(initial=0)) + 1) * scale >= 1 << 63:
        return np.array([1 + scale * (int(n) + 1) // total for n in counts], np.int64)
    return 1 + scale * (counts + 1) // total


def pair_sums(columns: list[tuple], length: int, scale: int = SCALE) -> Iterator[tuple[int, int, int]]:
    """Numbers of two columns (``side``, ``starts``, ``counts``, ``total``) and f summed over a block, both ways.

    Columns with side 0 or 2 meet those with side 1 or 2.
    """
    made = [(side, starts, probabilities(counts, total, scale)) for side, starts, counts, total in columns]
    for x, (side_x, starts_x, p_x) in enumerate(made):
        for y in range(x + 1, len(made)):
            side_y, starts_y, p_y = made[y]
            if side_x == side_y != 2:
                continue
            bounds = np.union1d(starts_x, starts_y)
            lengths = np.diff(bounds, append=length)
            p = p_x[np.searchsorted(starts_x, bounds, "right") - 1]
            q = p_y[np.searchsorted(starts_y, bounds, "right") - 1]
            square = (p - q) ** 2
            yield x, y, int((square // q * lengths).sum())
            yield y, x, int((square // p * lengths).sum())


def pair_values(columns: DataFrame, groups: DataFrame, tile: int = TILE) -> DataFrame:
    """``lang``, ``source``, ``item`` (another source of the language) and ``value``.

    ``columns`` and ``groups`` are written tables.
    """
    spark = columns.sparkSession
    tiles = groups.groupBy(F.col("lang").alias("t_lang")).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    dealt = groups.join(tiles, F.col("lang") == F.col("t_lang")).withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
    salt = F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int")
    blocks = columns.filter(F.col("source").isNull()).select(F.col("lang").alias("b_lang"), "block", "length", salt.alias("b_salt"))
    salted = dealt.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # Every group in every block of its language: that many columns meet.
    placed = salted.join(blocks, (F.col("lang") == F.col("b_lang")) & (F.col("salt") == F.col("b_salt")))
    own = columns.filter(F.col("source").isNotNull()).select(
        F.col("lang").alias("c_lang"), F.col("block").alias("c_block"), F.col("source").alias("c_source"), "starts", "counts"
    )
    same = (F.col("lang") == F.col("c_lang")) & (F.col("block") == F.col("c_block")) & (F.col("source") == F.col("c_source"))
    full = placed.join(own, same, "left")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    met = full.select("lang", "block", "length", "source", "total", "starts", "counts", "tile", other)
    side = F.when(F.col("tile") == F.col("other"), 2).otherwise((F.col("tile") > F.col("other")).cast("int"))
    met = met.select(
        "lang", "block", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
        side.alias("side"), "source", "length", "total", "starts", "counts",
    )
    key = ["lang", "block", "i", "j"]
    cells = met.repartition(shuffle_partitions(spark), *key).sortWithinPartitions(*key, "source")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[tuple[str, str, str]] = Counter()
        group, columns, sources, length = None, [], [], 0

        def done() -> None:
            for x, y, value in pair_sums(columns, length):
                sums[group[0], sources[x], sources[y]] += value

        for batch in batches:
            for row in batch.to_pylist():
                here = tuple(row[k] for k in key)
                if here != group:
                    done()
                    if len(sums) > HELD:
                        yield _pairs(sums)
                        sums.clear()
                    group, columns, sources, length = here, [], [], row["length"]
                starts, counts = row["starts"] or [0], row["counts"] or [0]
                columns.append((row["side"], np.array(starts, np.int64), np.array(counts, np.int64), row["total"]))
                sources.append(row["source"])
        done()
        yield _pairs(sums)

    partial = cells.mapInArrow(meet, "lang string, source string, item string, value long")
    found = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # A language that keeps no terms has no blocks, but its groups are pairs.
    empty = groups.filter(F.col("lang_total") == 0).select("lang", "source")
    twice = empty.join(empty.select(F.col("lang").alias("o_lang"), F.col("source").alias("item")), (F.col("lang") == F.col("o_lang")) & (F.col("source") != F.col("item")))
    return found.unionByName(twice.select("lang", "source", "item", F.lit(0).cast("long").alias("value")))


def _pairs(sums: Counter) -> pa.RecordBatch:
    columns = list(zip(*sums)) or [(), (), ()]
    return pa.record_batch([*(pa.array(c, pa.string()) for c in columns), pa.array(list(sums.values()), pa.int64())], ["lang", "source", "item", "value"])


# --- terms


def whole_probability(n: Column, total: Column, scale: int = SCALE) -> Column:
    """1 + floor(scale (n + 1) / total), exact beyond 64 bits."""
    up = (n + 1).cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", up, total.cast("decimal(20,0)"))


def term_values(kept: DataFrame, groups: DataFrame, scale: int = SCALE) -> DataFrame:
    """``lang``, ``source``, ``item`` (a term) and ``value`` where a group uses a term more than its language."""
    cells = kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("cells").alias("c"))
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int").alias("salt")
    cells = cells.select("lang", "term", "lang_n", "c.source", "c.n", salt)
    totals = groups.select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "total", "lang_total",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("g_salt"),
    )
    same = (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")) & (F.col("salt") == F.col("g_salt"))
    found = cells.join(totals, same).select(
        "lang", "source", F.col("term").alias("item"),
        whole_probability(F.col("n"), F.col("total"), scale).alias("p"),
        whole_probability(F.col("lang_n"), F.col("lang_total"), scale).alias("q"),
    )
    apart = F.col("p") - F.col("q")
    value = F.call_function("div", apart * apart, F.col("q"))
    return found.filter(F.col("p") > F.col("q")).select("lang", "source", "item", value.alias("value"))


def divergences(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    block_cells: int = BLOCK_CELLS,
    tile: int = TILE,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: all pairs, and each group's ``top`` terms."""
    kept = stage(kept_terms(term_counts(docs, lang_col, source_col, text_col), min_docs), "kept-terms")
    occurring = docs.select(filled(lang_col).alias("lang"), filled(source_col).alias("source")).distinct()
    groups = stage(group_totals(occurring, kept), "groups")
    columns = stage(columns_of(kept, block_cells), "columns")
    pairs = pair_values(columns, groups, tile)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    terms = term_values(kept, groups).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    both = [t.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, t in (("pair", ranked), ("term", terms))]
    return both[0].unionAll(both[1])


#: The same for DuckDB.  Fixed: scale, documents a term needs, ranks of terms.
ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), counted AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM words GROUP BY ALL
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), grp AS (
  SELECT DISTINCT lang, source FROM docs
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT + count(*) AS total FROM kept GROUP BY lang
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS lang_n
  FROM grp g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), totals AS (
  SELECT lang, source, (sum(n) + count(*))::HUGEINT AS total FROM cells GROUP BY lang, source
), p AS (
  SELECT c.lang, c.source, c.term, c.n, 1 + (1000000000 * (c.n + 1)) // t.total AS p, 1 + (1000000000 * (c.lang_n + 1)) // l.total AS q
  FROM cells c JOIN totals t ON c.lang = t.lang AND c.source = t.source JOIN langs l ON c.lang = l.lang
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS "rank"
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, "rank" FROM ranked WHERE part = 'pair' OR "rank" <= 200
"""
