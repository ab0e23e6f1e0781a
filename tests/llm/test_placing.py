"""Mixing, packing and sharding, the pipeline, and the queries that have SQL."""

import os
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
from test_oracle import canonical  # noqa: E402

from masterloom.llm import mixing, packing, quality_forest, queries, sharding, simhash_dedup  # noqa: E402

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got, want = canonical(queries.QUERIES[name](spark, FOLDER).toPandas()), canonical(duck.sql(queries.ORACLE[name]).df())
    assert list(got.columns) == list(want.columns) and len(want) > 0
    assert got.equals(want)


# --- mixing


def brute_targets(sizes, weights, most=3):
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        share = sum(w for i, w in enumerate(weights) if i not in capped)
        targets = [most * s if i in capped else weights[i] * rest / share for i, s in enumerate(sizes)]
        over = {i for i, t in enumerate(targets) if i not in capped and t >= most * sizes[i]}
        if not over:
            return targets
        capped |= over
        if len(capped) == len(sizes):
            return [most * s for s in sizes]


def test_targets_equal_resharing(spark):
    rows = [("b", 10), ("a", 5), ("a", 0), ("c", 2000), (None, 1), ("é", 40), ("z", 0), ("B", 300)]
    sizes = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(rows)], "id long, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    order = ["B", "a", "b", "c", "z", "é", None]
    totals = [sum(n for s, n in rows if s == o) for o in order]
    want = brute_targets(totals, [1, 2, 3, 1, 2, 3, 1])
    assert got == pytest.approx(dict(zip(order, want)))
    assert sum(got.values()) == pytest.approx(sum(totals))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(0, 60)), "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    rows += [(1000, None, "hot"), (1001, "", None), (None, "a b c", None), (5, "twice the id", "hot"), (5, "twice the id", "hot")]
    docs = documents(spark, rows)
    runs = [sorted(map(str, mixing.mixed(mixing.document_sizes(docs)).collect())) for _ in range(2)]
    assert runs[0] == runs[1]
    mix = mixing.mixed(mixing.document_sizes(docs)).collect()
    taken, targets = Counter(), {}
    for r in mix:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        targets[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 30 for s, t in targets.items())
    copies = mixing.mix_documents(docs.withColumn("copy", F.lit(1)).withColumn("whole", F.lit(2)))
    assert copies.columns == docs.columns + ["copy", "whole"]
    want = Counter()
    for r in mix:
        want[r["id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in copies.collect()) == +want
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def mix_in_sql(docs):
    """The operator's SQL on the same rows: (id, size, taken) with counts."""
    import duckdb

    base = duckdb.connect()
    base.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    return Counter((i, size, taken) for i, size, _, _, taken in base.execute(mixing.ORACLE).fetchall())


@pytest.mark.parametrize("case", ["equal rows", "null ids", "one document"])
def test_only_as_many_equal_rows_are_taken_as_are_needed(spark, case):
    if case == "equal rows":
        rows = [(7, "w " * 5, "a")] * 500 + [(100 + i, "w " * 5, "a") for i in range(500)]
    elif case == "null ids":
        rows = [(None, "w " * 9, "a")] * 300 + [(i, "w " * 8, "a") for i in range(200)]
    else:
        rows = [(1, "w w", "a")] * 700
    rows += [(5000 + i, "w " * 10, "b") for i in range(30)]
    docs = documents(spark, rows).repartition(7)
    mix = mixing.mixed(mixing.document_sizes(docs)).collect()
    taken = Counter()
    for r in mix:
        taken[r["source"]] += r["copies"] * r["size"]
    targets = {r["source"]: r["target"] for r in mix}
    assert all(abs(taken[s] - t) <= 5 for s, t in targets.items())
    assert Counter((r["id"], r["size"], r["copies"] * r["size"]) for r in mix) == mix_in_sql(docs)
    whole = mixing.mix_documents(docs).collect()
    assert Counter((r["doc_id"], r["source"]) for r in whole) == +sum_of((r["id"], r["source"], r["copies"]) for r in mix)


def sum_of(rows):
    found = Counter()
    for i, source, n in rows:
        found[i, source] += n
    return found


def test_a_small_chance_spreads_over_the_bins(spark):
    rows = spark.range(20_000).select("id", F.lit("hot").alias("source"), F.lit(1).cast("long").alias("size"))
    targets = spark.createDataFrame([("hot", 20_000, 2.0, 0, 0.0001, 2.0)], "source string, source_size long, target double, whole long, chance double, need double")
    drawn = mixing.drawn(rows, targets).collect()
    assert len(drawn) == 20_000
    most = max(Counter(r["bin"] for r in drawn).values())
    assert most <= 20_000 / mixing.BINS * 2 + 20
    # The bins are in the order of the ranks.
    ordered = sorted(drawn, key=lambda r: r["rank"])
    assert [r["bin"] for r in ordered] == sorted(r["bin"] for r in drawn)


# --- packing


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


PATH, ENCODER = tokenizer()
WORDS = packing.WordTokenizer(PATH)
LETTERS = st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("aäßÉİé's 1.,!#\t\ń̸<=>'reltdvm")))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=LETTERS, max_size=30), min_size=1, max_size=5))
def test_word_ids_are_the_texts_ids(texts):
    ids, bounds = WORDS.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ENCODER.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 60), st.data())
def test_plans_fill_sequences_without_gaps(capacity, data):
    histogram = data.draw(st.dictionaries(st.integers(1, capacity), st.integers(1, 50), max_size=12))
    sequences, ranks = defaultdict(list), Counter()
    for length, rank, n, each, first, at in sorted(packing.plan(histogram, capacity), key=lambda s: (s[0], s[1])):
        assert rank == ranks[length]
        ranks[length] += n * each
        for s in range(n):
            sequences[first + s] += [(at + k * length, length) for k in range(each)]
    assert ranks == Counter(histogram)
    for placed in sequences.values():
        placed.sort()
        assert [a for a, _ in placed] == [0, *np.cumsum([n for _, n in placed])[:-1].tolist()]
        assert sum(n for _, n in placed) <= capacity
    total = sum(n * c for n, c in histogram.items())
    assert len(sequences) <= 11 / 9 * -(-total // capacity) * 2 + 1


def test_packing_of_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, "hello world"), (3, "hello world"), (None, "x"), (4, "token " * 9000), (5, "a b c " * 300)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, length int")
    out = packing.pack_documents(docs, PATH).collect()
    by = defaultdict(list)
    for r in out:
        by[r["id"]].append(r)
    for i, t in texts:
        ids = ENCODER.encode(t or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by[i], key=lambda r: r["piece"])
        if i == 3:
            assert len(pieces) == 2
            continue
        assert [r["start"] for r in pieces] == list(range(0, len(ids), 4096))
        for r in pieces:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["length"] == len(part) and r["ids_crc32"] == zlib.crc32(part.tobytes())
    places = defaultdict(list)
    for r in out:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in places.values():
        placed.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(placed, placed[1:])) and placed[0][0] == 0
        assert sum(placed[-1]) <= 4096
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0
    packed = packing.sequences(docs, PATH).collect()
    assert sum(len(r["ids"]) for r in packed) == sum(r["length"] for r in out)
    flat = Counter(i for r in packed for i in r["ids"])
    assert flat == sum((Counter(ENCODER.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in texts), Counter())


# --- sharding


def test_matrix_margins_and_distribution():
    parts, blocks = [7, 0, 20, 13], [10, 10, 0, 20]
    drawn = np.array([sharding.communication_matrix(parts, blocks, seed) for seed in range(2000)])
    assert (drawn.sum(2) == parts).all() and (drawn.sum(1) == blocks).all()
    assert np.abs(drawn.mean(0) - np.outer(parts, blocks) / 40).max() < 0.2
    # Variance of a hypergeometric number: 20 of 40 rows into a block of 20.
    assert abs(drawn[:, 2, 3].var() - 20 * 0.5 * 0.5 * 20 / 39) < 0.3


def test_large_hypergeometric_numbers(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(sharding, "NUMPY_ROWS", 0)
    own = np.array([sharding.hypergeometric(rng, 30, 50, 20) for _ in range(20_000)])
    assert abs(own.mean() - 7.5) < 0.06 and abs(own.var() - 20 * 0.375 * 0.625 * 60 / 79) < 0.15
    assert 0 <= sharding.hypergeometric(rng, 5 * 10**9, 5 * 10**9, 10**6) <= 10**6
    assert [sharding.hypergeometric(rng, *x) for x in ((0, 5, 3), (5, 0, 3), (4, 4, 0), (4, 4, 8))] == [0, 3, 0, 4]


@pytest.mark.parametrize("rows, shards, each", [(1000, 7, 50), (5, 24, 10), (0, 3, 10), (300, 4, 10_000)])
def test_shards_have_exact_sizes_and_gapless_slots(spark, rows, shards, each):
    df = spark.range(rows).select(F.when(F.col("id") > 3, F.col("id")).alias("doc_id"), F.lit("x").alias("slot"), F.lit("same").alias("text"))
    out = sharding.shard(df, shards, seed=5, rows_each=each).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r["doc_id"] for r in df.collect())
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted((len(s) for s in slots.values()), reverse=True) == [n for n in sharding.shard_sizes(rows, shards) if n]
    again = sharding.shard(df, shards, seed=5, rows_each=each).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_the_shuffle_is_uniform(spark):
    df = spark.range(24)
    hits = np.zeros((24, 4))
    for seed in range(12):
        for r in sharding.shard(df, 4, seed=seed, rows_each=3).collect():
            hits[r["id"], r["shard"]] += 1
    assert hits.sum(0).tolist() == [72] * 4 and ((hits - 3) ** 2 / 3).sum() < 130


def test_equal_rows_are_spread_over_all_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "MANY_EQUAL", 100)
    monkeypatch.setattr(sharding, "COPIES", 64)
    ids = F.when(F.col("id") >= 5000, F.col("id"))
    df = spark.range(6000).select(ids.alias("doc_id"), F.when(F.col("id") < 3000, F.lit("same")).alias("text"), F.lit(1.5).alias("part"))
    keyed, counted = sharding._parts(df, "__part", "__hash", 6000, 64, seed=1)
    assert {r["__part"]: r["count"] for r in keyed.groupBy("__part").count().collect()} == counted
    assert max(counted.values()) < 2 * 6000 / 64
    out = sharding.shard(df, 7, seed=1, rows_each=500)
    assert Counter((r["doc_id"], r["text"], r["part"]) for r in out.collect()) == Counter(map(tuple, df.collect()))
    slots = [sorted(r["slots"]) for r in out.groupBy("shard").agg(F.collect_list("slot").alias("slots")).collect()]
    assert sorted(map(len, slots)) == sorted(sharding.shard_sizes(6000, 7)) and all(s == list(range(len(s))) for s in slots)
    # Each shard gets about its share of the equal rows.
    equal = [r["count"] for r in out.filter("text = 'same'").groupBy("shard").count().collect()]
    assert len(equal) == 7 and all(abs(n - 3000 / 7) < 90 for n in equal)


def test_digests_are_those_of_the_documents_in_their_shards(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    digests = sharding.shard_digests(docs, 24).collect()
    assert {r["id"]: (r["size"], r["text_crc32"]) for r in digests} == {i: (len(t) + 8, zlib.crc32(t)) for i, t in want.items()}
    sharding.write_shards(docs, 24, str(tmp_path / "shards"))
    written = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert {r["doc_id"]: (r["text"] or "").encode() for r in written} == want and len(written) == len(digests)
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in written} == {(r["id"], r["shard"], r["slot"]) for r in digests}


def test_odd_columns_of_digests(spark):
    rows = spark.createDataFrame([(1, "é", "x"), (None, None, None), (1, "é", "x")], "slot long, shard string, lang string")
    out = sharding.shard_digests(rows, 2, id_col="slot", text_col="Shard").collect()
    assert sorted((r["id"] or 0, r["size"], r["text_crc32"]) for r in out) == [(0, 8, 0), *[(1, 10, zlib.crc32("é".encode()))] * 2]


# --- extra columns


#: Names that operators use for helper columns, in both cases.
HELPERS = """s_source k_id k_fp d_id d_print m_part m_begin m_from m_to m_range b_host l_key l_id id text print hash
chunks chunk lines pairs marks e fp turn stats score mix copy copies place border read before cut whole chance need rank
source_size target most_equal size n first again r_hash part key node component root bin base nth equal b_source b_bin
c_source c_read start shard slot row term block n_a digest pair docs ask asks vector floors stored host path rule verdict""".split()


def widened(df):
    """The table with an extra column of every helper's name, in lower or upper case, that it lacks."""
    own = {c.lower() for c in df.columns}
    names = [n if i % 2 else n.upper() for i, n in enumerate(HELPERS) if n not in own]
    return df.select("*", *[F.lit("x").alias(n) for n in names], *[F.lit("y").alias(f"__{n}") for n in names])


def test_pipeline_stages_with_clashing_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(120)
    extra = widened(docs)
    for name, function in corpus_pipeline.STAGES:
        plain, wide = (function(spark, d, FOLDER) for d in (docs, extra))
        if name != "best-fit packing":
            assert wide.columns == extra.columns
        assert Counter(map(tuple, wide.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect())), name


def test_operators_with_clashing_columns(spark):
    from masterloom.llm import divergence_audit, line_chunks, topk_search, url_cascade

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url").limit(60)
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").limit(60)
    listed = spark.createDataFrame([("ads-track.example.com",)], "key string")
    calls = {
        "chunks": (line_chunks.drop_repeated_chunks, docs),
        "shard": (lambda d: sharding.shard(d.select("doc_id", *[c for c in d.columns if c not in docs.columns]), 5), docs),
        "urls": (lambda d: url_cascade.filter_urls(d, [url_cascade.Rule("block", "net")], listed), pages),
        "divergence": (divergence_audit.divergences, docs),
        "search": (topk_search.top_k, vectors),
    }
    for name, (call, table) in calls.items():
        plain, wide = call(table), call(widened(table))
        assert set(plain.columns) <= set(wide.columns), name
        if name != "shard":  # its shuffle depends on whole rows
            assert Counter(map(str, wide.select(*plain.columns).collect())) == Counter(map(str, plain.collect())), name
        else:
            assert wide.count() == plain.count()


# --- pipeline


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    from masterloom.llm.common import stage

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "mixing sources", "best-fit packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    steps = [docs]
    for name, function in corpus_pipeline.STAGES:
        steps.append(stage(function(spark, steps[-1], FOLDER), "test"))
    for before, after in zip(steps, steps[1:-1]):
        assert after.columns == docs.columns
    base, lines, near, mix, packed = steps[1:]
    first = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"]: r["text"] for r in base.collect()}
    for i, text in kept.items():
        s = quality_forest.text_statistics(text)
        assert text == first[i] and s[0] >= 50 and 100 * s[4] <= 50 * s[0]
    assert len(kept) >= 0.5 * len(first)
    deduped = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.collect()}
    assert deduped.keys() == kept.keys() and all(n == len(t) for t, n in deduped.values())
    prints = {i: simhash_dedup.fingerprint(t) % (1 << 64) for i, (t, _) in deduped.items()}
    ids, group = sorted(prints), {}
    for i in ids:
        group[i] = i
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if group[b] < group[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    group[a], changed = group[b], True
    left = {r["doc_id"]: r["text"] for r in near.collect()}
    assert sorted(left) == sorted({min(i for i in ids if group[i] == g) for g in set(group.values())})
    mixed = Counter(r["doc_id"] for r in mix.collect())
    assert mixed.keys() <= left.keys() and max(mixed.values()) <= 3
    want = Counter()
    for i, n in mixed.items():
        want[i] += n * (len(ENCODER.encode(left[i], add_special_tokens=False).ids) + 1)
    got = Counter()
    for r in packed.collect():
        got[r["doc_id"]] += r["length"]
    assert got == want
