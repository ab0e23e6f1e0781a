"""Best-fit packing of token pieces into sequences, planned over a length histogram.

The plan never looks at documents: it takes how many pieces there are of each length,
at most ``capacity`` numbers, and does best-fit decreasing over counts.  Sequences with
the same free space are one group; a length goes to the group whose free space is the
smallest that holds it, and a group splits only where its sequences or the pieces run
out.  The plan is a list of slots (length, first rank, sequences, pieces in each, first
sequence, offset) whose size depends on the capacity, not on the corpus.

A piece then takes the slot of its rank within its length.  Ranks are counted in parts
of a length (by a hash of the id), so a length that many documents share is spread, and
the plan is joined on length and block of ranks.

Null and empty texts are documents of the end token alone.  Longer documents than the
capacity are cut into pieces of ``capacity`` tokens; the last may be shorter.  Repeated
rows are packed as often as they occur.  A null id is an id like others.  Extra columns
are not read.
"""

import os
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from masterloom.llm.common import column, shuffle_partitions, slices, stage

CAPACITY = 4096
END = 1
#: Bytes of text that a task tokenizes at once.
TEXT_BYTES = 2 << 20
#: Words whose ids a task remembers; the memory starts anew when they are this many.
REMEMBERED = 300_000
#: Words that go to the encoder as one text, and texts that go to it at once: what it
#: returns for a token takes far more memory than the token's id.
JOINED = 64
AT_ONCE = 64
#: ASCII punctuation without the apostrophe, which may begin a word of its own.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
MARKS = r"^(?s:.*?)([!-&(-/:-@\[-`{-~]*)$"
#: Latin letters that have one lower-case form of one code point.
LETTERS = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+$"
#: Blocks of ranks per length in the join with the plan.
RANK_BLOCKS = 64


class WordTokenizer:
    """Token ids of many texts, by encoding each distinct word once.

    For word tokenizers with an end-of-word mark that drop ASCII white space, fold case
    and split letters from punctuation: a text's ids are its words' ids in order.  A word
    of Latin letters with punctuation after it is encoded as its letters and its
    punctuation; many such parts go to the encoder as one text, whose ids the marks tell
    apart.  Any other word is encoded by itself.
    """

    def __init__(self, path: str, end_of_word: str = "</w>") -> None:
        # One thread: a task has one core, and each further thread keeps memory of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        vocabulary = self.encoder.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for t, i in vocabulary.items() if t.endswith(end_of_word)]] = True
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {"": 0}
        self.ids, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of parts that each end in one end-of-word token and hold no other."""
        ids, _ = self._alone([" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)])
        ends = np.flatnonzero(self.is_end[ids]) + 1
        if len(ends) != len(words):
            return self._alone(words)
        return ids, np.diff(ends, prepend=0)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = [np.zeros(0, np.uint32)], [0]
        for i in range(0, len(words), AT_ONCE):
            for encoding in self.encoder.encode_batch_fast(words[i : i + AT_ONCE], add_special_tokens=False):
                ids.append(np.array(encoding.ids, np.uint32))
                lengths.append(len(ids[-1]))
        return np.concatenate(ids), np.array(lengths[1:], np.int64)

    def _learn(self, words: list[str], encode) -> None:
        new = [w for w in words if w not in self.places]
        if not new:
            return
        ids, lengths = encode(new)
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])

    def _places(self, parts: pa.Array) -> np.ndarray:
        """The place of each part in the memory; parts not yet there are encoded."""
        coded = parts.dictionary_encode()
        plain = pc.match_substring_regex(coded.dictionary, LETTERS)
        self._learn(pc.filter(coded.dictionary, plain).to_pylist(), self._together)
        self._learn(pc.filter(coded.dictionary, pc.invert(plain)).to_pylist(), self._alone)
        found = np.fromiter(map(self.places.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        return found[coded.indices.to_numpy(zero_copy_only=False)]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words one after another, with each word's start and length."""
        if len(self.places) > REMEMBERED:
            self._forget()
        letters = pc.utf8_rtrim(words, characters=PUNCTUATION)
        plain = pc.match_substring_regex(letters, LETTERS)
        marks = pc.if_else(plain, pc.replace_substring_regex(words, MARKS, "\\1"), "")
        letters = pc.if_else(plain, pc.utf8_lower(letters), words)
        parts = np.stack([self._places(letters), self._places(marks)], 1).reshape(-1)
        ids, _ = _gather(self.ids, self.starts[parts], self.lengths[parts])
        lengths = self.lengths[parts].reshape(-1, 2).sum(1)
        return ids, np.cumsum(lengths) - lengths, lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, and where each text's begin and the last ends."""
        split = pc.ascii_split_whitespace(texts)
        per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.list_flatten(split).dictionary_encode()
        ids, starts, lengths = self._words(coded.dictionary)
        numbers = coded.indices.to_numpy(zero_copy_only=False)
        ids, ends = _gather(ids, starts[numbers], lengths[numbers])
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, bounds


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of ``values`` one after another, and where each one ends."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return values[:0], ends
    return values[np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)], ends


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``) of every piece.

    ``tokenizer`` is a tokenizer file of a word tokenizer (see ``WordTokenizer``) at the
    same place on every machine.
    """
    rows = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokenizer(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(pc.binary_length(texts).to_numpy(zero_copy_only=False), TEXT_BYTES):
                ids, bounds = encoder.encode(texts[a:b])
                yield _pieces(batch.column("id")[a:b], ids, bounds, capacity, end, with_ids)
                # What the last slice took goes back before the next one, and before other tasks run.
                pa.default_memory_pool().release_unused()

    fields = [
        StructField("id", rows.schema["id"].dataType),
        StructField("piece", IntegerType()),
        *[StructField(c, LongType()) for c in ("start", "length", "ids_crc32")],
    ]
    schema = StructType(fields)
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
    return rows.mapInArrow(cut, schema)


def _pieces(keys: pa.Array, ids: np.ndarray, bounds: np.ndarray, capacity: int, end: int, with_ids: bool) -> pa.RecordBatch:
    last = np.array([end], np.uint32)
    row, piece, start, length, crc, values = [], [], [], [], [], []
    for number in range(len(keys)):
        whole = np.concatenate([ids[bounds[number] : bounds[number + 1]], last])
        for place, begin in enumerate(range(0, len(whole), capacity)):
            part = whole[begin : begin + capacity]
            row.append(number)
            piece.append(place)
            start.append(begin)
            length.append(len(part))
            crc.append(zlib.crc32(part.astype("<u4").tobytes()))
            if with_ids:
                values.append(part.astype(np.int32))
    columns = [keys.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
    columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
    names = ["id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        columns.append(pa.array(values, pa.list_(pa.int32())))
        names.append("ids")
    return pa.record_batch(columns, names)


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, sequences, pieces in each, first sequence, offset).

    Best-fit decreasing over counts.  ``groups[free]`` holds runs of sequences with that
    much free space; a run is a range of sequence numbers filled alike.
    """
    groups: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []  # sorted free spaces, as a heap per search would lose the order
    slots, opened = [], 0

    def add(free: int, first: int, n: int) -> None:
        if free:
            if free not in groups:
                groups[free] = []
                _insert(spaces, free)
            groups[free].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        while left:
            place = _first_at_least(spaces, length)
            if place < len(spaces):
                free = spaces[place]
                first, n = groups[free].pop()
                if not groups[free]:
                    del groups[free]
                    spaces.pop(place)
            else:
                free, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            each = min(free // length, left)
            full = min(n, left // each)
            slots.append((length, rank, full, each, first, capacity - free))
            add(free - each * length, first, full)
            rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if n and left:  # fewer pieces than the next sequence has room for
                slots.append((length, rank, 1, left, first, capacity - free))
                add(free - left * length, first, 1)
                left, first, n = 0, first + 1, n - 1
            if n:
                add(free, first, n)
    return slots


def _insert(spaces: list[int], free: int) -> None:
    spaces.insert(_first_at_least(spaces, free), free)


def _first_at_least(spaces: list[int], length: int) -> int:
    low, high = 0, len(spaces)
    while low < high:
        middle = (low + high) // 2
        if spaces[middle] < length:
            low = middle + 1
        else:
            high = middle
    return low


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``pieces`` (with ``id``, ``piece``, ``length``) and their ``sequence_id`` and ``offset``.

    ``pieces`` is read twice: pass a written table.  The driver gets the histogram, at
    most ``capacity`` rows, and broadcasts the plan, whose size the capacity bounds.
    """
    spark = pieces.sparkSession
    counted = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = plan(counted, capacity)
    width = {n: -(-count // RANK_BLOCKS) for n, count in counted.items()}
    ranked = _ranks(pieces)
    columns = ["length", "rank", "sequences", "each", "first", "at", "width", "block"]
    rows = [
        (length, rank, n, each, first, offset, width[length], block)
        for length, rank, n, each, first, offset in slots
        for block in range(rank // width[length], (rank + n * each - 1) // width[length] + 1)
    ]
    planned = spark.createDataFrame(_frame(rows, columns), ", ".join(f"{c} long" for c in columns)).alias("p")
    widths = spark.createDataFrame(
        _frame([(n, w) for n, w in width.items()], ["w_length", "w_width"]), "w_length long, w_width long"
    )
    ranked = ranked.join(F.broadcast(widths), F.col("length") == F.col("w_length"))
    ranked = ranked.withColumn("w_block", F.floor(F.col("__rank") / F.col("w_width"))).alias("r")
    inside = (F.col("r.__rank") >= F.col("p.rank")) & (F.col("r.__rank") < F.col("p.rank") + F.col("p.sequences") * F.col("p.each"))
    on = (F.col("r.length") == F.col("p.length")) & (F.col("r.w_block") == F.col("p.block")) & inside
    place = F.col("r.__rank") - F.col("p.rank")
    return ranked.join(F.broadcast(planned), on).select(
        *[F.col(f"r.{c}") for c in pieces.columns],
        (F.col("p.first") + F.floor(place / F.col("p.each"))).alias("sequence_id"),
        (F.col("p.at") + place % F.col("p.each") * F.col("p.length")).alias("offset"),
    )


def _frame(rows: list[tuple], columns: list[str]):
    import pandas as pd

    return pd.DataFrame(rows, columns=columns)


def _ranks(pieces: DataFrame) -> DataFrame:
    """``__rank`` of each piece within its length, from 0, counted in parts of a length."""
    parts = shuffle_partitions(pieces.sparkSession)
    rows = pieces.withColumn("__part", F.pmod(F.xxhash64("id", "piece"), F.lit(parts)))
    before = Window.partitionBy("b_length").orderBy("b_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        rows.groupBy(F.col("length").alias("b_length"), F.col("__part").alias("b_part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("b_length", "b_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("length", "__part").orderBy("id", "piece")
    rows = rows.withColumn("__rank", F.row_number().over(within) - 1)
    on = (F.col("length") == F.col("b_length")) & (F.col("__part") == F.col("b_part"))
    return rows.join(bases, on).select(*pieces.columns, (F.col("__rank") + F.col("base")).alias("__rank"))


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return pack(stage(token_pieces(docs, tokenizer, id_col, text_col, capacity, end), "pieces"), capacity)


def sequences(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``sequence_id``, ``ids`` (the packed tokens) and ``offsets`` (where each piece begins).

    A sequence has at most ``capacity`` tokens, so its group is bounded.
    """
    placed = pack(stage(token_pieces(docs, tokenizer, id_col, text_col, capacity, end, with_ids=True), "pieces"), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("offsets")
    )
