"""Quality rules: an isolation forest on rule statistics, calibrated from labels.

Each text gets rule statistics (words, symbols, repeated lines and words, ...), and
from them a few shares.  Trees split the box that the labelled rows span at random
places, and are grown over labelled good rows: a document in a corner where no good
document lies ends after few splits.  The mean path length gives the anomaly score; the
threshold is the one that tells good from bad labels best, over all labelled rows.

Contract for odd rows: a null or empty text has no words, fails the base rules and is
not kept.  Texts are read whole, in time linear in their length.  Labels of ids that no
document has, null ids and null labels teach nothing; an id with both labels counts for
both.  Without labelled good rows there is no forest, scores are null and the base rules
decide alone; without bad rows the threshold is the highest score of a good row.
Repeated rows are judged alike.  Extra columns are kept.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from masterloom.llm.common import column, fresh, stage

TREES = 100
#: Good rows that a tree is grown over: enough that rare but good shares are among them.
TREE_ROWS = 4096
#: Labelled rows of each label that the trees and their box are made from, at most.
FIT_ROWS = 8192
DEPTH = 16
#: Scores are compared in steps of 1 / STEPS.
STEPS = 2000
SEED = "quality forest"

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
_SYMBOLS, _SPACES, _UPPER = b"#*$%&|<>", b" \t\n\r\x0b\x0c", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_statistics(text: str | None) -> tuple[int, ...]:
    """``STATISTICS`` of one whole text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - len(data) + len(data.translate(None, _SPACES)),
        len(data) - len(data.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeat_words(words),
        len(lines),
        len(data) - len(data.translate(None, _UPPER)),
    )


def _repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three which the text has more than once."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words], np.int64)
    pairs = w[:-1] * len(numbers) + w[1:]
    if len(numbers) >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    codes = pairs[:-1] * len(numbers) + w[2:]
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(codes), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(codes)] |= again
    return int(covered.sum())


def rule_statistics(text: Column) -> Column:
    """A struct of ``STATISTICS`` for a text column."""

    @arrow_udf("struct<" + ",".join(f"{name}:bigint" for name in STATISTICS) + ">")
    def statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = np.array([text_statistics(t.as_py()) for t in texts], np.int64).reshape(-1, len(STATISTICS))
            yield pa.StructArray.from_arrays([pa.array(c) for c in rows.T], list(STATISTICS))

    # Not to be computed again for a filter that is pushed below it.
    return statistics.asNondeterministic()(text)


def base_failed(stats: str) -> Column:
    """Too short, or more than half of the words in repeats."""
    words, repeats = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < 50) | (100 * repeats > 50 * words)


def features(statistics: np.ndarray) -> np.ndarray:
    """Characters and symbols a word, shares of repeated lines and words, words a line, share of capitals.

    Of rows of ``STATISTICS``; what has a long tail is taken in logarithms.
    """
    n, chars, symbols, dups, repeats, lines, upper = statistics.astype(float).T
    words = np.maximum(n, 1)
    return np.stack(
        [
            np.log(np.maximum(chars, 1) / words),
            np.log1p(symbols / words),
            dups / np.maximum(lines, 1),
            repeats / words,
            np.log(words / np.maximum(lines, 1)),
            upper / np.maximum(chars, 1),
        ],
        1,
    )


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1: leaf), threshold, child for below (above: the next), path length."""

    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    length: np.ndarray
    typical: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / typical one), between 0 and 1; high is odd."""
        total = np.zeros(len(x))
        for feature, threshold, below, length in zip(self.feature, self.threshold, self.below, self.length):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                inner = f >= 0
                goes_below = x[np.arange(len(x)), np.maximum(f, 0)] < threshold[node]
                node = np.where(inner, below[node] + ~goes_below, node)
            total += length[node]
        return 2.0 ** (-total / len(self.feature) / self.typical)


def _rest(n: int) -> float:
    """Mean path length of a search among n rows: what a leaf with n rows stands for."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(good: np.ndarray, low: np.ndarray, high: np.ndarray, seed: int = 0) -> Forest:
    """A forest over good rows; splits fall anywhere in the box from ``low`` to ``high``."""
    rng = np.random.default_rng(seed)
    trees = []
    for _ in range(TREES):
        rows = good[rng.permutation(len(good))[:TREE_ROWS]]
        size = 2 ** (DEPTH + 1)
        feature, threshold = np.full(size, -1), np.zeros(size)
        below, length, used = np.zeros(size, np.int64), np.zeros(size), 1
        todo = [(0, rows, low, high, 0)]
        while todo:
            node, inside, a, b, depth = todo.pop()
            wide = np.flatnonzero(b > a)
            if depth == DEPTH or len(inside) <= 1 or not len(wide):
                length[node] = depth + _rest(len(inside))
                continue
            f = rng.choice(wide)
            cut = rng.uniform(a[f], b[f])
            feature[node], threshold[node], below[node] = f, cut, used
            left, right = b.copy(), a.copy()
            left[f] = right[f] = cut
            is_below = inside[:, f] < cut
            todo += [(used, inside[is_below], a, left, depth + 1), (used + 1, inside[~is_below], right, b, depth + 1)]
            used += 2
        trees.append((feature[:used], threshold[:used], below[:used], length[:used]))
    most = max(len(t[0]) for t in trees)
    padded = [np.stack([np.pad(t[i], (0, most - len(t[i]))) for t in trees]) for i in range(4)]
    return Forest(*padded, typical=_rest(min(TREE_ROWS, len(good))) or 1.0)


@dataclass(frozen=True)
class QualityModel:
    """A forest and the highest score that is kept; no forest: the base rules alone."""

    forest: Forest | None
    threshold: float


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> QualityModel:
    """Forest and threshold from ``stats`` (``id``, ``stats``) and labels (1 good, 0 bad).

    The forest takes at most ``FIT_ROWS`` rows of each label, those with the smallest
    hash.  The threshold takes every labelled row that passes the base rules: it
    maximises the share of good rows kept plus that of bad rows dropped, and of equal
    thresholds the highest wins.  ``stats`` is read once.
    """
    known = labels.select(column(id_col).alias("l_id"), column(label_col).cast("int").alias("good")).filter(
        F.col("l_id").isNotNull() & F.col("good").isin(0, 1)
    ).distinct()
    rows = stats.join(known, F.col("id") == F.col("l_id")).filter(~base_failed("stats")).select("id", "good", "stats")
    rows = stage(rows, "labelled")
    samples = [
        np.array(
            [
                tuple(r["stats"])
                for r in rows.filter(F.col("good") == good)
                .orderBy(F.xxhash64(F.lit(SEED), F.col("id").cast("string")), "id", *[f"stats.{c}" for c in STATISTICS])
                .limit(FIT_ROWS)
                .collect()
            ],
            np.int64,
        ).reshape(-1, len(STATISTICS))
        for good in (0, 1)
    ]
    if not len(samples[1]):
        return QualityModel(None, 1.0)
    box = features(np.concatenate(samples))
    forest = grow(features(samples[1]), box.min(0), box.max(0))
    counted = rows.groupBy("good", F.floor(scores(forest, "stats") * STEPS).alias("step")).count().collect()
    counts = np.zeros((2, STEPS + 1))
    for r in counted:
        counts[r["good"], r["step"]] = r["count"]
    return QualityModel(forest, best_threshold(counts))


def best_threshold(counts: np.ndarray) -> float:
    """The score up to which rows are kept; ``counts`` has bad and good rows by step of the score."""
    up_to = counts.cumsum(1)
    if not up_to[0, -1]:
        last = int(np.flatnonzero(counts[1]).max())
    else:
        gain = up_to[1] / max(up_to[1, -1], 1) - up_to[0] / up_to[0, -1]
        last = int(np.flatnonzero(gain >= gain.max() - 1e-12).max())
    return (last + 1) / STEPS


def scores(forest: Forest, stats: str) -> Column:
    """The anomaly score of a struct column of ``STATISTICS``."""

    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.flatten()], 1)
            yield pa.array(forest.scores(features(rows)))

    # Not to be computed again for a filter that is pushed below it.
    return score.asNondeterministic()(F.col(stats))


def judged(rows: DataFrame, model: QualityModel, stats: str = "stats") -> DataFrame:
    """``rows`` with ``base_failed``, ``score`` and ``kept``, from their struct of statistics."""
    score = scores(model.forest, stats) if model.forest else F.lit(None).cast("double")
    rows = rows.withColumn("base_failed", base_failed(stats)).withColumn("score", score)
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") < model.threshold, F.lit(True)))


def statistics_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``stats`` of every row, written to the shared folder."""
    return stage(docs.select(column(id_col).alias("id"), rule_statistics(column(text_col)).alias("stats")), "statistics")


def with_statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """The documents that pass the base rules, with their statistics, and the name of that column.

    Written to the shared folder: ``fit`` and ``keep_good`` need no others.
    """
    stats = fresh(docs, "stats")
    passing = docs.withColumn(stats, rule_statistics(column(text_col))).filter(~base_failed(stats))
    return stage(passing, "measured", codec="zstd"), stats


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", stats: str | None = None) -> DataFrame:
    """The rows that the rules and the forest keep, with their own columns; no shuffle.

    ``stats`` names a column that holds the statistics already; it is dropped.
    """
    if stats is None:
        stats = fresh(docs, "stats")
        docs = docs.withColumn(stats, rule_statistics(column(text_col)))
    score = scores(model.forest, stats) if model.forest else F.lit(0.0)
    return docs.filter(~base_failed(stats)).filter(score < model.threshold).drop(stats)
