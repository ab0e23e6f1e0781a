"""Line dedup by content-defined chunks of lines.

A document's lines are hashed, a rolling hash runs over windows of two line hashes, and a
chunk begins at each line whose rolling hash is a local minimum.  So boundaries depend
on the lines around them only: lines put in before a passage do not shift the chunks
inside it, and a chunk has two lines or more (but perhaps a text's first or last one).
A chunk that occurs again anywhere in the corpus is removed there; its first occurrence,
in the document with the smallest id, stays.  Occurrences are found by a 64-bit hash, and
a chunk is only removed if its bytes equal the first one's.  Neighbouring chunks that
occur again are a run, and only runs of several lines go: so a long passage goes also where
its chunks are short lines or a paragraph and a blank line each.

Only DataFrame functions are used.  What is shuffled: each task's distinct chunks once,
hashes of all chunks, the repeated chunks, and the documents once, to take them out.
Equal chunks are counted before the shuffle; joins on a chunk that very many documents
share are split by adaptive execution.

Null texts stay null and empty ones empty.  A text whose chunks all go becomes empty; its
row stays.  Rows with the same id and text are one document.  Documents with one id each
keep the first occurrence within them.  A null id comes after all others; where only null
ids have a chunk, none is removed but within a document.  Extra columns are kept.

A chunk at the edge of a repeated passage holds foreign lines too, and a short passage has
no chunk of its own.  ``drop_repeated_passages`` takes passages out whole: repeated chunks
are its anchors, pairs of neighbouring lines, the windows of the rolling hash, lead on from
them and find what is too short for a chunk, and its minimum is for the run of both.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterloom.llm.common import column, fresh, stage

#: Fixed values that the SQL below repeats: factor and modulus of the rolling hash.
FACTOR = 31
MODULUS = 1 << 32
#: A run that may be removed has so many lines with a word, and so many characters.
MIN_LINES = 2
MIN_CHARS = 50
#: A key with more than 1 of so many repeated places is dealt to so many tasks; the result is the same.
SHARE = 1000
SPREAD = 64


def line_chunks(rows: DataFrame, text: str, into: str) -> DataFrame:
    """``rows`` with an array of the text's chunks; joined by line ends they are the text."""
    lines, starts = fresh(rows, "lines"), fresh(rows, "starts")
    rows = rows.withColumn(lines, F.split(column(text), "\n", -1))
    rows = chunk_starts(rows, lines, starts)
    chunk = F.transform(_spans(starts, lines), lambda s: _joined(lines, s["a"], s["b"] - s["a"]))
    return rows.withColumn(into, chunk).drop(lines, starts)


def chunk_starts(rows: DataFrame, lines: str, into: str) -> DataFrame:
    """``rows`` with an array of the places in ``lines`` at which a chunk begins.

    The steps are columns of their own, each an expression over whole arrays, so that
    nothing is computed once per element.
    """
    hashes, rolled = fresh(rows, "hashes"), fresh(rows, "rolled")
    rows = rows.withColumn(hashes, F.transform(lines, _line_hash))
    rows = rows.withColumn(rolled, F.zip_with(hashes, _after(hashes, 0), lambda h, p: (h + FACTOR * p) % MODULUS))
    before, behind = _after(rolled, -1), F.concat(F.slice(rolled, 2, F.size(rolled)), F.array(F.lit(MODULUS).cast("long")))
    low = F.zip_with(
        F.zip_with(rolled, before, lambda r, p: F.when(r < p, r)), behind, lambda r, n: F.coalesce(r <= n, F.lit(False))
    )
    places = F.transform(low, lambda is_low, i: F.when(is_low | (i == 0), i))
    return rows.withColumn(into, F.filter(places, lambda i: i.isNotNull())).drop(hashes, rolled)


def _spans(starts: str, lines: str) -> Column:
    """Each start with the next one, the last with the end of ``lines``."""
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(lines)))
    return F.arrays_zip(F.col(starts).alias("a"), ends.alias("b"))


def _joined(lines: str, k: Column, n: Column) -> Column:
    """The ``n`` lines from place ``k``."""
    return F.array_join(F.slice(F.col(lines), k + 1, n), "\n")


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _after(values: str, first: int) -> Column:
    """The array moved on by one place, with ``first`` before it."""
    return F.concat(F.array(F.lit(first).cast("long")), F.slice(values, 1, F.size(values) - 1))


def several_lines(chunk: Column, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> Column:
    lines = F.filter(F.split(chunk, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (F.char_length(chunk) >= min_chars) & (F.size(lines) >= min_lines)


def drop_repeated_chunks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_lines: int = MIN_LINES,
    min_chars: int = MIN_CHARS,
    n_chunks: str | None = None,
    n_removed: str | None = None,
) -> DataFrame:
    """``docs`` with runs of repeated chunks taken out of the text.

    ``n_chunks`` and ``n_removed`` name columns to add with these counts.
    """
    stems = ("chunks", "print", "verdicts", "again", "d_id", "d_print")
    chunks, print_, verdicts, repeats, d_id, d_print = (fresh(docs, stem) for stem in stems)
    key = column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("print")
    texts = docs.filter(column(text_col).isNotNull()).select(*key, column(text_col).alias("text"))
    # The outer form: for the other one the planner infers a filter on the array, which
    # goes below all steps and computes each of them many times.
    found = line_chunks(texts, "text", "chunks").select("id", "print", F.posexplode_outer("chunks").alias("k", "chunk"))
    found = found.filter("chunk IS NOT NULL").withColumn("hash", F.xxhash64("chunk"))
    repeated = (
        found.groupBy("hash", "chunk")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
        .filter("n > 1")
        .select(F.col("hash").alias("r_hash"), F.col("chunk").alias("again"), "first")
    )
    places = found.groupBy("id", "print", "hash").agg(F.array_sort(F.collect_set("k")).alias("ks"))
    judged = places.join(repeated, F.col("hash") == F.col("r_hash"), "left")
    # In the first one's document only the later occurrences go.
    stays = F.when(F.col("id").eqNullSafe(F.col("first")), F.array_min("ks"))
    judged = judged.select("id", "print", "again", stays.alias("stays"), F.explode("ks").alias("k"))
    goes = F.when(~F.col("k").eqNullSafe(F.col("stays")), F.col("again"))
    per_document = (
        judged.groupBy("id", "print")
        .agg(F.array_sort(F.collect_list(F.struct("k", goes.alias("again")))).alias("entries"), F.count(goes).alias("n"))
        .filter("n > 0")
        .select(F.col("id").alias(d_id), F.col("print").alias(d_print), F.col("entries.again").alias(verdicts))
    )
    rows = docs.withColumn(print_, F.xxhash64(column(text_col)))
    rows = rows.join(per_document, column(id_col).eqNullSafe(F.col(d_id)) & (F.col(print_) == F.col(d_print)), "left")
    rows = rows.drop(d_id, d_print, print_)
    rows = line_chunks(rows, text_col, chunks)
    # A chunk may go if its bytes are those of the repeated one.
    rows = rows.withColumn(repeats, F.zip_with(chunks, verdicts, lambda chunk, again: chunk.eqNullSafe(again)))
    rows = rows.withColumn(verdicts, F.when(F.col(verdicts).isNotNull(), _without_runs(chunks, chunks, repeats, min_lines, min_chars)))
    text = F.when(F.col(verdicts).isNotNull(), F.array_join(verdicts, "\n")).otherwise(column(text_col))
    count = F.coalesce(F.size(chunks), F.lit(0))
    columns = [text.alias(c) if c == text_col else column(c) for c in docs.columns]
    if n_chunks:
        columns.append(F.when(column(text_col).isNull(), 0).otherwise(count).alias(n_chunks))
    if n_removed:
        columns.append(F.when(F.col(verdicts).isNull(), 0).otherwise(count - F.size(verdicts)).alias(n_removed))
    return rows.select(*columns)


def _without_runs(parts: str, shown: str, goes: str, min_lines: int, min_chars: int) -> Column:
    """An array of ``parts`` without the runs of those that go, by an array of booleans.

    A run goes if what is ``shown`` of it has several lines; a smaller one stays.
    """
    stay = F.filter(F.transform(goes, lambda go, i: F.when(~go, i)), lambda i: i.isNotNull())
    begins = F.concat(F.array(F.lit(-1)), stay)
    runs = F.arrays_zip(begins.alias("a"), F.concat(stay, F.array(F.size(parts))).alias("b"))

    def left(run: Column) -> Column:
        own = F.when(run["a"] >= 0, F.slice(parts, run["a"] + 1, 1)).otherwise(F.array().cast("array<string>"))
        inner = F.slice(parts, run["a"] + 2, run["b"] - run["a"] - 1)
        long = several_lines(F.array_join(F.slice(shown, run["a"] + 2, run["b"] - run["a"] - 1), "\n"), min_lines, min_chars)
        return F.when(long, own).otherwise(F.concat(own, inner))

    return F.flatten(F.transform(runs, left))


def lines_with_words(rows: DataFrame, text: str, into: str, units: str | None = None) -> DataFrame:
    """``rows`` with an array of the text's lines that have a word; the first line always counts.

    ``units`` names an array to add of these lines with the blank ones behind each; joined
    by line ends they are the text.
    """
    lines, starts = fresh(rows, "all_lines"), fresh(rows, "starts")
    rows = rows.withColumn(lines, F.split(column(text), "\n", -1))
    places = F.transform(lines, lambda line, i: F.when(line.rlike(r"[^\x20\x09-\x0D]") | (i == 0), i))
    rows = rows.withColumn(starts, F.filter(places, lambda i: i.isNotNull()))
    rows = rows.withColumn(into, F.transform(starts, lambda i: F.get(lines, i)))
    if units:
        rows = rows.withColumn(units, F.transform(_spans(starts, lines), lambda s: _joined(lines, s["a"], s["b"] - s["a"])))
    return rows.drop(lines, starts)


def _pairs(lines: str) -> Column:
    """Each line with the next one."""
    most = F.greatest(F.size(lines) - 1, F.lit(0))
    return F.zip_with(F.slice(lines, 1, most), F.slice(lines, 2, most), lambda a, b: F.concat(a, F.lit("\n"), b))


def _early(rows: DataFrame, hashes: str, into: str, overlapping: bool = False) -> DataFrame:
    """``rows`` with an array of booleans: whether a hash is not that of something further up.

    ``overlapping`` ones share a line with their neighbours: the second one of three equal
    lines shares a line with the first one, so it counts as that.
    """
    marks = fresh(rows, "marks")
    # Sorted by hash, the first of a text is behind another hash.
    rows = rows.withColumn(marks, F.array_sort(F.transform(hashes, lambda h, k: F.struct(h.alias("hash"), k.alias("k")))))
    none = F.array(F.lit(None).cast("struct<hash:bigint,k:int>"))
    back = lambda n: F.slice(F.concat(*[none] * n, F.col(marks)), 1, F.size(marks))
    before = F.arrays_zip(F.col(marks).alias("m"), back(1).alias("p"), back(2).alias("q"))
    new = lambda m, p: ~F.coalesce(m["hash"] == p["hash"], F.lit(False))

    def entry(b: Column) -> Column:
        early = new(b["m"], b["p"])
        if overlapping:
            early = early | (new(b["p"], b["q"]) & (b["m"]["k"] == b["p"]["k"] + 1))
        return F.struct(b["m"]["k"].alias("k"), early.alias("early"))

    return rows.withColumn(into, F.transform(F.array_sort(F.transform(before, entry)), lambda e: e["early"])).drop(marks)


def _firsts(found: DataFrame) -> DataFrame:
    """Of each hash found ``times``, twice or more, the first place: smallest id (null last), print and ``k``."""
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "print", "k", "n")).alias("first")
    repeated = found.groupBy("hash").agg(F.count(F.lit(1)).alias("times"), first).filter("times > 1")
    return repeated.select("hash", "times", "first.id", "first.print", "first.k", "first.n")


def _frequent(firsts: DataFrame) -> DataFrame:
    """The hashes of ``_firsts`` that have a large share of all places, at most ``SHARE`` of them."""
    places = firsts.agg(F.sum("times")).first()[0] or 0
    return firsts.filter(F.col("times") > max(places / SHARE, SPREAD)).select(F.col("hash").alias("h_hash"))


def _dealt(rows: DataFrame, frequent: DataFrame, into: str, copies: bool = False) -> DataFrame:
    """``rows`` with a number to join by beside ``hash``; a frequent one's rows, or their ``copies``, get all numbers."""
    rows = rows.join(F.broadcast(frequent), F.col("hash") == F.col("h_hash"), "left")
    if copies:
        deal = F.explode(F.when(F.col("h_hash").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    else:
        deal = F.when(F.col("h_hash").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", "print", "k"), F.lit(SPREAD)).cast("int"))
    return rows.withColumn(into, deal).drop("h_hash")


def passage_keys(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks found again with pairs of lines beside them, and the first places of both.

    ``texts`` has ``id``, ``print`` and ``text``.  A key is the hash of ``n`` lines with a
    word from place ``k``.  A chunk found again is one key with ``anchor``; of all other
    chunks, and of the borders between chunks, each pair of lines is a key, and ``early``
    unless the same text has it further up.  The pairs inside a chunk found again are
    also where the chunk is first, so they are left out.
    """
    rows = chunk_starts(lines_with_words(texts, "text", "lines"), "lines", "starts")
    rows = rows.withColumn("pairs", F.transform(_pairs("lines"), lambda p: F.xxhash64(p)))
    rows = _early(rows, "pairs", "pairs_early", overlapping=True)
    rows = rows.withColumn("spans", _spans("starts", "lines"))
    rows = rows.withColumn("chunks", F.transform("spans", lambda s: F.xxhash64(_joined("lines", s["a"], s["b"] - s["a"]))))
    rows = _early(rows, "chunks", "chunks_early")

    # A chunk's pairs begin at its lines; the last one reaches into the next chunk.
    def chunk(c: Column) -> Column:
        k, n = c["spans"]["a"], c["spans"]["b"] - c["spans"]["a"]
        own = [F.slice(F.col(name), k + 1, n).alias(name) for name in ("pairs", "pairs_early")]
        return F.struct(c["chunks"].alias("hash"), k.alias("k"), n.alias("n"), c["chunks_early"].alias("early"), *own)

    rows = rows.withColumn("found", F.transform(F.arrays_zip("spans", "chunks", "chunks_early"), chunk))
    found = rows.select("id", "print", F.explode_outer("found").alias("c")).select("id", "print", "c.*").filter("hash IS NOT NULL")
    anchors = stage(_firsts(found.filter("n > 1").drop("pairs", "pairs_early", "early")), "line-anchors")
    frequent = _frequent(anchors)
    first = _dealt(anchors, frequent, "r_deal", copies=True).select(F.col("hash").alias("r_hash"), "r_deal", F.col("id").alias("first"))
    found = _dealt(found, frequent, "deal")
    judged = found.join(first, (F.col("hash") == F.col("r_hash")) & (F.col("deal") == F.col("r_deal")), "left")
    again = (F.col("n") > 1) & F.col("r_hash").isNotNull() & ~(F.col("id").eqNullSafe(F.col("first")) & F.col("early"))

    def key(hash_: Column, k: Column, n: Column, early: Column, anchor: bool) -> Column:
        return F.struct(hash_.alias("hash"), k.alias("k"), n.alias("n"), early.alias("early"), F.lit(anchor).alias("anchor"))

    pairs = F.transform("pairs", lambda p, i: key(p, F.col("k") + i, F.lit(2), F.get("pairs_early", i), False))
    anchor = F.array(key(F.col("hash"), F.col("k"), F.col("n"), F.col("early"), True))
    judged = judged.select("id", "print", "n", again.alias("again"), pairs.alias("pairs"), anchor.alias("anchor"))
    keys = F.when(F.col("again"), F.concat("anchor", F.slice("pairs", F.col("n"), 1))).otherwise(F.col("pairs"))
    keys = judged.select("id", "print", F.explode_outer(keys).alias("key")).select("id", "print", "key.*").filter("hash IS NOT NULL")
    keys = stage(keys, "line-keys")
    return keys, stage(_firsts(keys.filter("NOT anchor")).unionByName(anchors), "line-firsts")


def drop_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_lines: int = MIN_LINES,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` with repeated passages of several lines taken out of the text, from their first line to their last.

    The lines with a word are cut into chunks by their content, blank ones do not count.
    A chunk occurs again if a document with a smaller id has it, or the same document
    further up.  From such chunks matches go on line by line, by pairs of neighbouring
    lines: a pair occurs again as a chunk does, but not by the line before.  Passages too
    short for a chunk are found by their pairs alone.  Neighbouring lines of such chunks
    and pairs form a run, which goes with the blank lines behind them if it has
    ``min_lines`` lines with a word and ``min_chars`` characters.  Every line that goes
    stays where it is found first.

    Chunks and pairs are found by a 64-bit hash and compared byte by byte.  What is
    shuffled: hashes of all chunks and their pairs, hashes of the pairs outside repeated
    chunks twice, the documents once to read the first places and once to take runs out,
    and the repeated chunks and pairs.  The rows of a frequent hash are dealt to many tasks.
    """
    stems = ("lines", "units", "verdicts", "stay", "print", "d_id", "d_print")
    lines, units, verdicts, stay, print_, d_id, d_print = (fresh(docs, stem) for stem in stems)
    key = column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("print")
    texts = docs.filter(column(text_col).isNotNull()).select(*key, column(text_col).alias("text"))
    keys, firsts = passage_keys(texts)
    frequent = _frequent(firsts).distinct()
    wanted = firsts.groupBy(F.col("id").alias(d_id), F.col("print").alias(d_print)).agg(F.collect_list(F.struct("k", "n", "hash")).alias("wanted"))
    read = texts.toDF("f_id", "f_print", "text")
    read = read.join(wanted, F.col("f_id").eqNullSafe(F.col(d_id)) & (F.col("f_print") == F.col(d_print)))
    read = lines_with_words(read.select("f_id", "text", "wanted"), "text", "lines")
    read = read.select("f_id", "lines", F.explode_outer("wanted").alias("w"))
    read = read.select("f_id", "w.hash", _joined("lines", F.col("w.k"), F.col("w.n")).alias("again"))
    read = _dealt(read, frequent, "r_deal", copies=True).withColumnRenamed("hash", "r_hash")
    read = read.groupBy("r_hash", "r_deal").agg(F.min("again").alias("again"), F.min("f_id").alias("first"))
    goes = F.col("anchor") | ~(F.col("id").eqNullSafe(F.col("first")) & F.col("early"))
    hits = _dealt(keys, frequent, "deal").join(read, (F.col("hash") == F.col("r_hash")) & (F.col("deal") == F.col("r_deal"))).filter(goes)
    per_document = hits.groupBy(F.col("id").alias(d_id), F.col("print").alias(d_print)).agg(F.collect_list(F.struct("k", "n", "again")).alias(verdicts))

    rows = docs.withColumn(print_, F.xxhash64(column(text_col)))
    rows = rows.join(per_document, column(id_col).eqNullSafe(F.col(d_id)) & (F.col(print_) == F.col(d_print)), "left")
    rows = rows.drop(d_id, d_print, print_)
    hit_text = fresh(rows, "hit_text")
    rows = rows.withColumn(hit_text, F.when(F.col(verdicts).isNotNull(), column(text_col)))
    rows = lines_with_words(rows, hit_text, lines, units)
    # Lines go if their bytes are those of the first place.
    rows = rows.withColumn(verdicts, F.filter(verdicts, lambda v: _joined(lines, v["k"], v["n"]) == v["again"]))
    covered = F.flatten(F.transform(verdicts, lambda v: F.sequence(v["k"], v["k"] + v["n"] - 1)))
    # Runs lie between lines that stay; a run that is too small stays too.
    apart = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered))
    rows = rows.withColumn(stay, F.concat(F.array(F.lit(-1)), apart))
    ends = F.concat(F.slice(stay, 2, F.size(stay)), F.array(F.size(lines)))
    runs = F.arrays_zip(F.col(stay).alias("a"), ends.alias("b"))

    def left(run: Column) -> Column:
        own = F.when(run["a"] >= 0, F.slice(units, run["a"] + 1, 1)).otherwise(F.array().cast("array<string>"))
        inner = F.slice(units, run["a"] + 2, run["b"] - run["a"] - 1)
        long = several_lines(F.array_join(F.slice(lines, run["a"] + 2, run["b"] - run["a"] - 1), "\n"), min_lines, min_chars)
        return F.when(long, own).otherwise(F.concat(own, inner))

    text = F.when(F.col(hit_text).isNotNull(), F.array_join(F.flatten(F.transform(runs, left)), "\n")).otherwise(column(text_col))
    return rows.select(*[text.alias(c) if c == text_col else column(c) for c in docs.columns])


#: The same for DuckDB, for documents with distinct ids.
ORACLE = r"""
WITH numbered AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM numbered
), rolled AS (
  SELECT *, (h + 31 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % 4294967296 AS r FROM hashed
), cut AS (
  SELECT *, CASE WHEN i = 1 OR (r < lag(r) OVER w AND r <= coalesce(lead(r) OVER w, 4294967296)) THEN 1 ELSE 0 END AS begins
  FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), placed AS (
  SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM cut
), chunks AS (
  SELECT doc_id, k, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_lines
  FROM placed GROUP BY doc_id, k
), repeated AS (
  SELECT chunk, min(doc_id) AS first FROM chunks GROUP BY chunk HAVING count(*) > 1
), found AS (
  SELECT c.*, first IS NOT NULL AND (c.doc_id <> first OR row_number() OVER (PARTITION BY c.doc_id, c.chunk ORDER BY k) > 1) AS again
  FROM chunks c LEFT JOIN repeated r ON c.chunk = r.chunk
), numbered_runs AS (
  SELECT *, sum(CASE WHEN again THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM found
), judged AS (
  SELECT *, again AND sum(n_lines) OVER r >= 2 AND sum(length(chunk)) OVER r + count(*) OVER r - 1 >= 50 AS goes
  FROM numbered_runs WINDOW r AS (PARTITION BY doc_id, run, again)
), summed AS (
  SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (goes) AS n_removed, string_agg(chunk, chr(10) ORDER BY k) FILTER (NOT goes) AS text
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_chunks, 0)::INTEGER AS n_chunks, coalesce(n_removed, 0)::INTEGER AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN coalesce(s.text, '') END AS text
FROM documents d LEFT JOIN summed s ON d.doc_id = s.doc_id
"""
