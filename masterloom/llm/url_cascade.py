"""URL filters: rules, and a list tested by a Bloom filter cascade.

The first level is a Bloom filter of the listed keys.  The second one holds the keys of
the corpus that are not listed but pass the first; the third the listed keys that pass
the second, and so on until no key passes wrongly.  Over the corpus's complete key
universe (every host and every domain above it) the number of levels that a key passes
then says exactly whether it is listed: odd means yes.  Pages are tested one by one,
without a join.

Levels are built by tasks that set bits and by an aggregation that joins the words.  A
level's size follows from the listed keys, not from the corpus; a cascade beyond
``MOST_BYTES`` is not broadcast, and membership is then decided by joining hosts.

A null url, or one without ``://``, has empty host and path: no rule fits it, and it is
allowed unless the empty host is listed.  Null and empty listed keys are left out.
Listed keys repeat without effect, and may be absent from the corpus.  An empty corpus
or list gives an empty cascade.  Repeated rows are judged alike; extra columns are kept.
"""

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from masterloom.llm.common import column, fresh, stage

#: Bytes of all levels that may go to every executor.
MOST_BYTES = 128 << 20
#: Levels after which two keys must have the same 128 bits of hash.
MOST_LEVELS = 64
GOLDEN = 0x9E3779B97F4A7C15
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def domains_of(host: Column) -> Column:
    """The host and every domain above it, as an array; none for an empty host."""
    labels = F.split(host, "[.]", -1)
    tails = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(tails)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the urls of a host and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    ordered = sorted(rules, key=lambda r: -len(r.name))
    none = F.lit(None).cast("string")
    name = F.coalesce(*[F.when(r.fits(host, path), r.name) for r in ordered], none)
    return name, F.coalesce(*[F.when(name == r.name, r.verdict) for r in ordered], none)


def key_hashes(key: Column) -> Column:
    """Two 64-bit hashes of a key, as a struct; the levels mix their own from them."""
    return F.struct(F.xxhash64(F.lit(0), key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def _mixed(x: np.ndarray, level: int) -> np.ndarray:
    x = x.view(np.uint64) + np.uint64(GOLDEN * (level + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Level:
    """A Bloom filter: ``bits`` places, ``hashes`` per key, kept in words."""

    number: int
    bits: int
    hashes: int
    words: np.ndarray

    def places(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Rows by hashes: the places of each key."""
        step = _mixed(h2, self.number) | np.uint64(1)
        rounds = np.arange(self.hashes, dtype=np.uint64)
        return (_mixed(h1, self.number)[:, None] + step[:, None] * rounds) % np.uint64(self.bits)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.places(h1, h2)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).all(1)


def passed(levels: Sequence[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """How many levels each key passes before the first that it does not."""
    count, inside = np.zeros(len(h1), np.int64), np.arange(len(h1))
    for level in levels:
        inside = inside[level.has(h1[inside], h2[inside])]
        count[inside] += 1
    return count


def level_shape(keys: int, false_positives: float) -> tuple[int, int]:
    """Bits and hashes of a level for so many keys."""
    hashes = max(1, round(math.log2(1 / false_positives)))
    bits = math.ceil(keys * hashes / math.log(2) / 64) * 64
    return max(bits, 64), hashes


def build_cascade(universe: DataFrame, listed: DataFrame) -> list[Level] | None:
    """The levels for two one-column tables of keys; None if they would be too large.

    ``universe`` must hold every key that is ever tested; listed keys are added to it.
    """
    known = universe.select(F.col(universe.columns[0]).alias("key")).filter("key IS NOT NULL").distinct()
    chosen = listed.select(F.col(listed.columns[0]).alias("l_key")).filter("l_key <> ''").distinct()
    # Keys that are listed but not in the corpus are never tested: they need no bits.
    keys = known.join(chosen, F.col("key") == F.col("l_key"), "left")
    keys = stage(keys.select(key_hashes(F.col("key")).alias("h"), F.col("l_key").isNotNull().alias("listed")), "url-keys")
    counts = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
    inside, outside = counts.get(True, 0), counts.get(False, 0)
    levels: list[Level] = []
    todo, rest = inside, outside
    while todo and len(levels) < MOST_LEVELS:
        # The first level lets about as many others through as there are listed keys.
        rate = min(0.5, max(inside * math.sqrt(0.5) / max(outside, 1), 1e-9)) if not levels else 0.5
        bits, hashes = level_shape(todo, rate)
        if bits // 8 + sum(level.words.nbytes for level in levels) > MOST_BYTES:
            return None
        wrong = keys.filter((F.col("listed") == (len(levels) % 2 == 0)) & (_passed(levels, F.col("h")) == len(levels)))
        levels.append(_filled(wrong, Level(len(levels), bits, hashes, np.zeros(0, np.uint64))))
        wrong = keys.filter((F.col("listed") == (len(levels) % 2 == 0)) & (_passed(levels, F.col("h")) == len(levels)))
        todo = wrong.count()
    if todo:
        raise RuntimeError("a listed and another key have the same 128 bits of hash")
    return levels


def _filled(keys: DataFrame, level: Level) -> Level:
    """The level with the bits of all keys: words joined by an aggregation, at most ``bits / 64``."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (c.to_numpy() for c in batch.column("h").flatten())
            at = np.unique(level.places(h1, h2))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            if len(at):
                bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.record_batch([pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    joined = keys.select("h").mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    filled = np.zeros(level.bits // 64, np.int64)
    for row in joined.toLocalIterator():
        filled[row["word"]] = row["bits"]
    return Level(level.number, level.bits, level.hashes, filled.view(np.uint64))


def _passed(levels: Sequence[Level], hashes: Column) -> Column:
    if not levels:
        return F.lit(0)
    levels = list(levels)

    @arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            h1, h2 = (c.to_numpy() for c in batch.flatten())
            yield pa.array(passed(levels, h1, h2))

    return count(hashes)


def any_listed(levels: Sequence[Level], domains: Column) -> Column:
    """Whether any of an array of keys is listed, by the cascade."""
    levels = list(levels)

    @arrow_udf("boolean")
    def test(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            h1, h2 = (c.to_numpy() for c in batch.flatten().flatten())
            listed = (passed(levels, h1, h2) % 2 == 1).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(listed)])
            ends = np.cumsum(np.asarray(batch.value_lengths()))
            yield pa.array(sums[ends] > sums[ends - np.asarray(batch.value_lengths())])

    return test(F.transform(domains, key_hashes))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of the url.

    The longest rule that fits decides; without one, a url is blocked if its host or a
    domain above it is listed, and allowed otherwise.
    """
    url = column(url_col)
    hosts = pages.select(host_of(url).alias("host")).distinct()
    universe = hosts.select(F.explode(domains_of(F.col("host"))).alias("key"))
    levels = build_cascade(universe, listed)
    added = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*map(column, added), host_of(url).alias("host"), path_of(url).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name)
    flag = fresh(rows, "listed")
    if levels is None:
        rows = _joined(rows, universe, listed, flag)
    elif levels:
        rows = rows.withColumn(flag, any_listed(levels, domains_of(F.col("host"))))
    else:
        rows = rows.withColumn(flag, F.lit(False))
    method = F.when(F.col(flag), "block").otherwise("allow")
    return rows.withColumn("verdict", F.coalesce(verdict, method)).drop(flag)


def _joined(rows: DataFrame, universe: DataFrame, listed: DataFrame, flag: str) -> DataFrame:
    """The same for a list too large to broadcast: hosts with a listed domain, by joins."""
    keys = listed.select(F.col(listed.columns[0]).alias("l_key")).filter("l_key <> ''").distinct()
    hosts = rows.select("host").distinct().select("host", F.explode(domains_of(F.col("host"))).alias("key"))
    host = fresh(rows, "host")
    blocked = hosts.join(keys, F.col("key") == F.col("l_key"), "left_semi").select(F.col("host").alias(host)).distinct()
    rows = rows.join(blocked, F.col("host") == F.col(host), "left")
    return rows.withColumn(flag, F.col(host).isNotNull()).drop(host)
