"""Cross-tokenizer alignment: groups of tokens of two tokenizers over the same bytes.

A text is encoded by a byte-level BPE (A, on a space and the text) and by a piece BPE (B,
which adds that space itself).  Byte offsets where a token of both ends cut the tokens into
groups; all pairs of an A and a B token of one group are linked.

The ends of both sides are merged by merge paths: the merged order of all ends of a slice
of texts is cut at every ``PIECE``-th place, a binary search along each cut's diagonal finds
how many ends of either side lie before it, and every piece of equal work finds its common
ends by itself.  Adding up the pieces' closed groups numbers the groups, and so stitches a
group that runs over a border to its beginning.

How many documents hold a pair of ids linked is counted over the corpus.  Documents then
look up their own pairs: frequent pairs, at most ``FREQUENT`` whatever the corpus, in a
table that every task gets, all others by a join.  That table is chosen by a threshold
from a histogram of counts; a frequent pair thus never meets in one task, and a rare one
is in few documents.

Long texts are encoded and aligned in parts, cut before a space that follows other text:
no token of either side reaches over such a place (checked against B's pieces; A's pattern
grants it), so every cut is a common end.  A document's memory grows with its distinct
linked pairs, not with its links.

Texts that are null or empty, or whose tokens do not spell the space and the text, have no
tokens: zeros, and an empty digest.  Repeated rows are documents of their own, as are rows
with a null id.  No rows give no rows.  Extra columns are not read.
"""

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterloom.llm.common import column, discard, stage

#: Ends in a piece of merging.
PIECE = 1 << 16
#: Characters of text that are aligned at once; longer texts are cut.
AT_ONCE = 1 << 20
#: Links that are listed at once.
LINKS = 1 << 21
#: A group with more links than this has its tokens counted by id first.
LARGE = 4096
#: Pairs that every task is given at most: 2 ** 18 rows of 17 bytes.
FREQUENT = 1 << 18
#: Characters of white space in a row from which the slower encoder is used.
BLANKS = 4096

#: Fixed: the splitting pattern of the byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteSide:
    """A byte-level BPE from its ``tokenizer.json``."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        alphabet = byte_alphabet()
        vocabulary = described["model"]["vocab"]
        self.spelt = [b""] * (max(vocabulary.values()) + 1)
        special = {t["content"] for t in described["added_tokens"] if t["special"]}
        for token, number in vocabulary.items():
            self.spelt[number] = token.encode() if token in special else bytes(alphabet[c] for c in token)
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in described["model"]["merges"]]
        places = [vocabulary[m] for m in merged]
        # Merging by rank is merging by id where merged tokens are numbered in their order.
        self.fast = None
        if described["pre_tokenizer"]["use_regex"] and not described["normalizer"] and places == sorted(places):
            ranks = {self.spelt[n]: n for t, n in vocabulary.items() if t not in special}
            self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        """Ids of a text without special tokens."""
        # The fast one's pattern cannot look past very long runs of white space.
        if self.fast is None or (len(text) > BLANKS and re.search(rf"\s{{{BLANKS}}}", text)):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceSide:
    """A piece BPE with byte fallback, from its model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelt = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        #: Whether no piece goes on beyond a space that follows other text.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Aligner:
    """Both tokenizers, and the tables that turn ids into lengths and digests."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.a, self.b = ByteSide(byte_path), PieceSide(piece_path)
        self.a_size, self.b_size = np.array(list(map(len, self.a.spelt))), np.array(list(map(len, self.b.spelt)))
        # An id as it is written inside a group, and at the end of its side of the group.
        self.written = [b"%d%c" % (i, mark) for mark in b",|" for i in range(len(self.a.spelt))]
        self.written += [b"%d%c" % (i, mark) for mark in b",;" for i in range(len(self.b.spelt))]

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts that tokens do not reach over; all but the first begin with a space."""
        begin = 0
        while self.b.cuttable and len(text) - begin > AT_ONCE:
            cut = next((m.start() + 1 for m in re.compile(r"\S \S").finditer(text, begin + AT_ONCE)), len(text))
            if cut < len(text):
                yield text[begin:cut]
            else:
                break
            begin = cut
        yield text[begin:]

    def tokens(self, part: str, first: bool) -> tuple[list[int], list[int]] | None:
        """Both sides' ids; None if they do not spell a space and the part."""
        text = part if not first else " " + part
        a, b = self.a.encode(text), self.b.encode(text[1:])
        whole = text.encode()
        for ids, spelt in ((a, self.a.spelt), (b, self.b.spelt)):
            if b"".join(map(spelt.__getitem__, ids)) != whole:
                return None
        return a, b


def path_splits(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and of ``b`` lie before each cut of their merged order.

    One binary search per diagonal, all at once.  Equal ends stay on one side of a cut.
    """
    cuts = np.arange(piece, len(a) + len(b), piece)
    low, high = np.maximum(cuts - len(b), 0), np.minimum(cuts, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        before = np.zeros(len(cuts), bool)
        before[open_] = a[middle[open_]] <= b[cuts[open_] - 1 - middle[open_]]
        low, high = np.where(open_ & before, middle + 1, low), np.where(open_ & ~before, middle, high)
    i, j = low, cuts - low
    torn = (i > 0) & (j < len(b))
    torn[torn] = a[i[torn] - 1] == b[j[torn]]
    ends = lambda x, n: np.concatenate([[0], x, [n]])
    return ends(i, len(a)), ends(j + torn, len(b))


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each end of a piece, how many common ends of the piece lie before it; and how many there are."""
    place = np.searchsorted(b, a)
    common = place < len(b)
    common[common] = b[place[common]] == a[common]
    of_b = np.zeros(len(b), bool)
    of_b[place[common]] = True
    return np.cumsum(common) - common, np.cumsum(of_b) - of_b, int(common.sum())


def groups_of(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """The group number of each token of either side, from their increasing ends."""
    i, j = path_splits(a, b, piece)
    of_a, of_b, closed = [], [], 0
    for n in range(len(i) - 1):
        x, y, count = overlaps(a[i[n] : i[n + 1]], b[j[n] : j[n + 1]])
        of_a.append(x + closed)
        of_b.append(y + closed)
        closed += count
    return np.concatenate(of_a), np.concatenate(of_b)


def linked_pairs(group_a, ids_a, group_b, ids_b, doc_of_group, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair (``a * width + b``) and number of links of each distinct pair of a document."""
    groups = len(doc_of_group)
    m, n = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    times_a = times_b = None
    if groups and (m * n).max() > LARGE:
        group_a, ids_a, times_a = _counted(group_a, ids_a)
        group_b, ids_b, times_b = _counted(group_b, ids_b)
        m, n = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    links = m * n
    last = np.cumsum(links)
    start_a, start_b = np.cumsum(m) - m, np.cumsum(n) - n
    total, found = int(last[-1]) if groups else 0, []
    for begin in range(0, total, LINKS):
        link = np.arange(begin, min(begin + LINKS, total))
        group = np.searchsorted(last, link, "right")
        within = link - (last - links)[group]
        x, y = start_a[group] + within // n[group], start_b[group] + within % n[group]
        times = np.ones(len(link), np.int64) if times_a is None else times_a[x] * times_b[y]
        found.append(_summed(doc_of_group[group], ids_a[x] * width + ids_b[y], times))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return found[0] if len(found) == 1 else _summed(*map(np.concatenate, zip(*found)))


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _summed(group, ids, np.ones(len(ids), np.int64))


def _summed(group: np.ndarray, value: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, value), ordered, with the sum of ``times``."""
    order = np.lexsort((value, group))
    group, value = group[order], value[order]
    new = np.ones(len(order), bool)
    new[1:] = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
    starts = np.flatnonzero(new)
    return group[starts], value[starts], np.add.reduceat(times[order], starts) if len(starts) else times


class Document:
    """What is known of one document while its parts come in."""

    def __init__(self, key) -> None:
        self.key, self.counts, self.sound = key, np.zeros(4, np.int64), True
        self.digest, self.pairs, self.times = hashlib.sha256(), [], []

    def result(self) -> tuple:
        if not self.sound or not self.counts[0]:
            return self.key, np.zeros(4, np.int64), "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, times = self.pairs[0], self.times[0]
        if len(self.pairs) > 1:
            pairs, times = np.concatenate(self.pairs), np.concatenate(self.times)
            _, pairs, times = _summed(np.zeros(len(pairs), np.int64), pairs, times)
        return self.key, self.counts, self.digest.hexdigest(), pairs, times


def align(aligner: Aligner, parts: list[tuple[Document, list[int], list[int], bool]]) -> None:
    """Align parts (document, ids of A and of B, whether it is the document's first) as one slice."""
    ids_a = np.concatenate([np.array(a, np.int64) for _, a, _, _ in parts])
    ids_b = np.concatenate([np.array(b, np.int64) for _, _, b, _ in parts])
    group_a, group_b = groups_of(np.cumsum(aligner.a_size[ids_a]), np.cumsum(aligner.b_size[ids_b]))
    ends_a, ends_b = np.cumsum([len(a) for _, a, _, _ in parts]), np.cumsum([len(b) for _, _, b, _ in parts])
    # Parts spell the same bytes on both sides, so every part begins a group.
    last_group = group_a[ends_a - 1] + 1
    m, n = np.bincount(group_a), np.bincount(group_b)
    links = np.concatenate([[0], np.cumsum(m * n)])
    part_of_group = np.searchsorted(last_group, np.arange(len(m)), "right")
    part, pairs, times = linked_pairs(group_a, ids_a, group_b, ids_b, part_of_group, len(aligner.b.spelt))
    part_ends = np.searchsorted(part, np.arange(len(parts)), "right")
    # Tokens in the order of the digest: a group's A tokens, then its B tokens.
    ends = lambda group: np.append(group[1:] != group[:-1], True)
    before_a, before_b = np.cumsum(m), np.cumsum(n) - n
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    order[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + len(aligner.a.spelt) * ends(group_a)
    order[np.arange(len(ids_b)) + before_a[group_b]] = ids_b + 2 * len(aligner.a.spelt) + len(aligner.b.spelt) * ends(group_b)
    written, at_a, at_b, at_group, at_pair = list(map(aligner.written.__getitem__, order.tolist())), 0, 0, 0, 0
    for (doc, _, _, first), end_a, end_b, end_group, end_pair in zip(parts, ends_a.tolist(), ends_b.tolist(), last_group.tolist(), part_ends.tolist()):
        doc.counts += (end_a - at_a, end_b - at_b, end_group - at_group, links[end_group] - links[at_group])
        text = b"".join(written[at_a + at_b : end_a + end_b])[:-1]
        doc.digest.update(text if first else b";" + text)
        doc.pairs.append(pairs[at_pair:end_pair])
        doc.times.append(times[at_pair:end_pair])
        at_a, at_b, at_group, at_pair = end_a, end_b, end_group, end_pair


def aligned_documents(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (a number of its own), ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``digest``, ``pairs`` and ``times`` per row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = Aligner(byte_path, piece_path), TaskContext.get().partitionId() << 36
        for batch in batches:
            for results in _results(aligner, batch):
                keys, counts, digests, pairs, times = zip(*results)
                sizes = pa.array(np.concatenate([[0], np.cumsum(list(map(len, pairs)))]), pa.int32())
                n = [pa.array(c) for c in np.stack(counts, 1)]
                lists = [pa.ListArray.from_arrays(sizes, np.concatenate(x).astype(np.int64)) for x in (pairs, times)]
                rows = pa.array(np.arange(row, row + len(results)))
                key = pa.array(keys, batch.schema.field("id").type)
                yield pa.record_batch([rows, key, *n, pa.array(digests), *lists], names)
                row += len(results)

    names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "digest", "pairs", "times"]
    schema = f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, digest string, pairs array<long>, times array<long>"
    return docs.select(column(id_col).alias("id"), column(text_col).alias("text")).mapInArrow(run, schema)


def _results(aligner: Aligner, batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """Results of a batch's documents, slice by slice."""
    documents, waiting, held = [], [], 0
    for key, text in zip(batch.column("id"), batch.column("text")):
        doc, text, first = Document(key.as_py()), text.as_py() or "", True
        documents.append(doc)
        for part in aligner.parts(text) if text else ():
            ids = aligner.tokens(part, first)
            if ids is None:
                doc.sound = False
                break
            waiting.append((doc, *ids, first))
            held, first = held + len(part), False
            if held >= AT_ONCE:
                align(aligner, waiting)
                waiting, held = [], 0
        if not waiting and len(documents):
            yield [d.result() for d in documents]
            documents = []
    if waiting:
        align(aligner, waiting)
    if documents:
        yield [d.result() for d in documents]


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair``, ``docs`` (documents that hold it) and ``best`` (no pair of its A id is in more)."""
    counted = stage(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "pair-counts")
    a = F.floor(F.col("pair") / width)
    # One row per id of A's vocabulary, whatever the corpus.
    most = counted.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    joined = counted.withColumn("of", a).join(F.broadcast(most), F.col("of") == F.col("a"))
    return joined.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The smallest power-like count that at most ``most`` pairs reach."""
    step = F.floor(8 * F.log2("docs")).cast("int")
    bins = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("docs").alias("docs"), F.max("docs").alias("last")).collect()
    total, least = 0, max((b["last"] for b in bins), default=0) + 1
    for b in sorted(bins, key=lambda b: -b["step"]):
        total += b["n"]
        if total > most:
            break
        least = b["docs"]
    return least


def scored_documents(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned`` without its pairs, with ``n_best`` and ``count_sum``; both tables are read more than once."""
    spark = aligned.sparkSession
    least = frequent_from(counts, frequent)
    table = counts.filter(F.col("docs") >= least).toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "docs", "best")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, docs, best = known.value
        for batch in batches:
            lists = batch.column("pairs")
            mine, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            place = np.searchsorted(pair, mine)
            found = place < len(pair)
            found[found] = pair[place[found]] == mine[found]
            sums = np.zeros((2, batch.num_rows), np.int64)
            hit, at = row[found], place[found]
            np.add.at(sums[0], hit, times[found] * best[at])
            np.add.at(sums[1], hit, times[found] * docs[at])
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[~found], minlength=batch.num_rows))])
            rest = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x[~found]) for x in (mine, times)]
            yield pa.record_batch([*batch.columns[:-2], pa.array(sums[0]), pa.array(sums[1]), *rest], names)

    kept = aligned.columns[:-2]
    names = [*kept, "n_best", "count_sum", "pairs", "times"]
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name in kept]
    schema = ", ".join([*kinds, "n_best long, count_sum long, pairs array<long>, times array<long>"])
    looked = stage(aligned.mapInArrow(look_up, schema), "alignment-frequent")
    known.destroy()
    rest = looked.select(F.col("row").alias("of"), F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("of", "x.pairs", "x.times")
    rare = counts.filter(F.col("docs") < least)
    added = (
        rest.join(rare, F.col("pairs") == F.col("pair"))
        .groupBy("of")
        .agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more_sum"))
    )
    joined = looked.drop("pairs", "times").join(added, F.col("row") == F.col("of"), "left")
    more = {"n_best": "more_best", "count_sum": "more_sum"}
    return joined.select(*kept, *[(F.col(c) + F.coalesce(F.col(m), F.lit(0))).alias(c) for c, m in more.items()])


def alignment(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``digest`` of every document."""
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    aligned = stage(aligned_documents(docs, byte_path, piece_path, id_col, text_col), "alignment")
    counts = stage(pair_counts(aligned, width), "alignment-counts")
    result = scored_documents(aligned, counts, frequent)
    discard(aligned)
    return result.drop("row")
