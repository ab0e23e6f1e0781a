"""Divergence audit, token alignment and top-k search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from masterloom.llm import divergence_audit, token_alignment, topk_search
from masterloom.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, `Row` int, term string, block string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 1, "t", "b") for i, (t, lang, s) in enumerate(rows)], DOCS)


# --- divergence audit


def brute_divergences(rows, min_docs=3, top=200):
    rows = [tuple(x or "" for x in row) for row in rows]
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(lower)) for t, _, _ in rows]
    found = set()
    for lang in {r[1] for r in rows}:
        mine = [(w, r[2]) for w, r in zip(words, rows) if r[1] == lang]
        seen = Counter(t for w, _ in mine for t in set(w))
        kept = {t for t, n in seen.items() if n >= min_docs}
        counts = defaultdict(Counter)
        for w, s in mine:
            counts[s].update(t for t in w if t in kept)
            counts[None].update(t for t in w if t in kept)

        def p(s, t):
            return 1 + 10**9 * (counts[s][t] + 1) // (sum(counts[s].values()) + len(kept))

        for s in {s for _, s in mine}:
            pairs = [(sum((p(s, t) - p(o, t)) ** 2 // p(o, t) for t in kept), o) for o in {x for _, x in mine} - {s}]
            terms = [((p(s, t) - p(None, t)) ** 2 // p(None, t), t) for t in counts[s] if p(s, t) > p(None, t)]
            for part, values, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                values.sort(key=lambda v: (-v[0], v[1].encode()))
                found |= {(lang, s, part, item, value, n + 1) for n, (value, item) in enumerate(values[:most])}
    return found


@pytest.mark.parametrize(("seed", "cells", "tile"), [(0, 1 << 18, 256), (1, 7, 2), (2, 20, 3)])
def test_divergences_equal_brute_force(spark, seed, cells, tile):
    rng = random.Random(seed)
    pool = ["a", "b", "The", "the", "é", "Éa", "x1y", "don't", "日本", "zz", "q", "İ"]
    rows = [
        (" ".join(rng.choices(pool, k=rng.randrange(12))), rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s2", "s3", "s4", None, ""]))
        for _ in range(80)
    ] + [(None, "en", "s9"), ("", "de", "s1"), ("only here", "de", "s2"), ("x", "it", "s1")] + [("the the é", "en", "s1")] * 20
    got = divergence_audit.divergences(documents(spark, rows), block_cells=cells, tile=tile)
    assert [f.simpleString() for f in got.schema] == ["lang:string", "source:string", "part:string", "item:string", "value:bigint", "rank:int"]
    found = list(map(tuple, got.collect()))
    assert len(found) == len(set(found))
    assert set(found) == brute_divergences(rows)


def test_divergences_of_nothing(spark):
    assert divergence_audit.divergences(documents(spark, [])).count() == 0


def test_probabilities_beyond_64_bits():
    counts, total = np.array([0, 5, 10**12]), 10**13
    assert divergence_audit.probabilities(counts, total).tolist() == [1 + 10**9 * (c + 1) // total for c in (0, 5, 10**12)]


def test_long_texts_are_counted_whole(spark):
    text = "ab, " * 700_000 + "cd"
    got = divergence_audit.term_counts(documents(spark, [(text, "en", "s")]))
    assert {(r["term"], r["n"], r["docs"]) for r in got.collect()} == {("ab", 700_000, 1), ("cd", 1, 1)}


# --- alignment


def paths():
    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def aligner():
    return token_alignment.Aligner(*paths())


def brute_alignment(aligner, rows):
    """Groups by walking both token lists, links by listing all pairs."""
    docs, found = Counter(), []
    for key, text in rows:
        a = aligner.a.slow.encode(" " + text, add_special_tokens=False).ids if text else []
        b = aligner.b.model.encode(text) if text else []
        spelt = [[side.spelt[i] for i in ids] for side, ids in ((aligner.a, a), (aligner.b, b))]
        if not text or any(b"".join(s) != b" " + text.encode() for s in spelt):
            found.append((key, 0, 0, [], Counter()))
            continue
        ends = [set(np.cumsum(list(map(len, s))).tolist()) for s in spelt]
        groups, current, at = [], ([], []), [0, 0]
        common, numbers = sorted(ends[0] & ends[1]), (a, b)
        places = [0, 0]
        for end in common:
            current = ([], [])
            for side in (0, 1):
                while at[side] < end:
                    current[side].append(numbers[side][places[side]])
                    at[side] += len(spelt[side][places[side]])
                    places[side] += 1
            groups.append(current)
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        docs.update(links.keys())
        found.append((key, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    for key, n_a, n_b, groups, links in found:
        written = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        top = sum(n for p, n in links.items() if docs[p] == best[p[0]])
        yield key, n_a, n_b, len(groups), sum(links.values()), top, sum(n * docs[p] for p, n in links.items()), digest


COLUMNS = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "digest"]


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("frequent", [1 << 18, 40, 0])
def test_alignment_equals_brute_force(spark, aligner, frequent, monkeypatch):
    rng = random.Random(3)
    pool = "the quick brown fox <|endoftext|> </s> <0x41> don't naïve 日本語 🙂 1234567 ==== \n\t  　 ▁ \x00 qqqqqqqqqq".split(" ") + ["", "  "]
    texts = [" ".join(rng.choices(pool, k=rng.randrange(1, 40))) for _ in range(60)]
    texts += [None, "", " ", "a", " lead", "tail ", "=" * 5000, " " * 9000, "ab " * 3000] + ["same text"] * 10
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(7, "again"), (7, "again")]
    docs = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], "doc_id long, text string, `Row` int, pair string")
    got = token_alignment.alignment(docs, *paths(), frequent=frequent).select(*COLUMNS)
    assert sorted_rows(got.collect()) == sorted_rows(brute_alignment(aligner, rows))


def test_alignment_in_parts_is_the_same(aligner, monkeypatch):
    import pyarrow as pa

    text = "One two  three,\n four's 55 " * 400 + "=" * 300 + " end"
    batch = pa.record_batch([pa.array([1, 2]), pa.array([text, "short"])], ["id", "text"])
    whole = [d for r in token_alignment._results(aligner, batch) for d in r]
    monkeypatch.setattr(token_alignment, "AT_ONCE", 100)
    monkeypatch.setattr(token_alignment, "LINKS", 64)
    monkeypatch.setattr(token_alignment, "LARGE", 4)
    assert len(list(aligner.parts(text))) > 50
    parts = [d for r in token_alignment._results(aligner, batch) for d in r]
    for x, y in zip(whole, parts, strict=True):
        assert x[0] == y[0] and x[2] == y[2]
        assert all(np.array_equal(x[n], y[n]) for n in (1, 3, 4))


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_merge_paths_number_groups_alike(piece):
    rng = np.random.default_rng(piece)
    for _ in range(30):
        total = int(rng.integers(1, 200))
        a, b = (np.append(np.sort(rng.choice(total, int(rng.integers(0, total)), replace=False)), total) + 1 for _ in "ab")
        common = np.intersect1d(a, b)
        got = token_alignment.groups_of(a, b, piece)
        assert got[0].tolist() == np.searchsorted(common, a).tolist()
        assert got[1].tolist() == np.searchsorted(common, b).tolist()


def test_both_byte_encoders_agree(aligner):
    rng = random.Random(1)
    assert aligner.a.fast is not None
    for _ in range(300):
        text = "".join(rng.choice(" \n\tabé日🙂'st0,<|>　\x00ǅ") if rng.random() < 0.7 else chr(rng.randrange(1, 0xD800)) for _ in range(60))
        assert aligner.a.encode(text) == aligner.a.slow.encode(text, add_special_tokens=False).ids


def test_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.alignment(docs, *paths()).count() == 0


# --- top-k search


def brute_top(rows, k, every):
    whole = {n: [math.floor(64.0 * x) for x in v] for n, (_, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(64.0 * x) for x in v)}
    for n, q in whole.items():
        key = rows[n][0]
        if key is None or key % every:
            continue
        scores = [(max(-(2**63), min(sum(x * y for x, y in zip(q, v)), 2**63 - 1)), rows[m][0]) for m, v in whole.items() if rows[m][0] != key]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        yield from ((key, r + 1, i, s) for r, (s, i) in enumerate(scores[:k]))


@pytest.mark.parametrize(("seed", "shard_rows", "big"), [(0, 8192, 1), (1, 16, 1), (2, 9, 1e9), (3, 5, 1e300)])
def test_top_k_equals_brute_force(spark, seed, shard_rows, big):
    rng = np.random.default_rng(seed)
    vectors = [rng.standard_normal(6).tolist() for _ in range(120)] + [(rng.random(6) < 0.3).astype(float).tolist() for _ in range(60)]
    vectors += [[1.0] * 6] * 40 + [[0.0] * 6] * 3 + [[], [1.0], [-2.5] * 9, [float(big)] * 6, [-float(big), big / 2]]
    vectors += [None, [float("nan")] * 6, [float("inf")] + [0.0] * 5, [None] + [1.0] * 5, [1.7e308] * 6]
    ids = rng.permutation(len(vectors) * 2)[: len(vectors)].tolist()
    rows = [(int(i), v) for i, v in zip(ids, vectors)] + [(None, [1.0] * 6), (None, [0.5] * 6), (20, [1.0] * 6), (20, [1.0] * 6), (20, [0.1] * 6), (0, [1.0])]
    frame = spark.createDataFrame([(i, v, 1, "k") for i, v in rows], "vec_id long, embedding array<double>, `Shard` int, kind string")
    got = topk_search.top_k(frame, k=20, every=5, shard_rows=shard_rows)
    assert sorted_rows(got.collect()) == sorted_rows(brute_top(rows, 20, 5))


def test_fewer_candidates_than_k(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [2.0])], "vec_id int, embedding array<float>")
    assert list(map(tuple, topk_search.top_k(frame).orderBy("rank").collect())) == [(0, 1, 2, 64 * 128), (0, 2, 1, 64 * 32)]


def test_top_k_of_nothing(spark):
    for rows in ([], [(1, [1.0])], [(20, None)], [(20, [1.0])]):
        assert topk_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).count() == 0


def test_non_essential_postings_are_probed_only_while_competitive():
    rng = np.random.default_rng(0)
    weights = np.round(rng.standard_normal((8, 400)) * [[40], [20], [10], [5], [2], [1], [1], [1]])
    shard = topk_search.Shard(list(range(400)), weights)
    queries = np.round(rng.standard_normal((10, 8)) * 30)
    floors = np.sort(queries @ weights, 1)[:, -5]
    q, place, score = shard.best(queries, np.full(10, -1), floors, 5)
    for n in range(10):
        assert sorted(score[q == n], reverse=True) == sorted((queries[n] @ weights).tolist(), reverse=True)[:5]


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_token_alignment", "op13_maxscore_search"])
def test_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
