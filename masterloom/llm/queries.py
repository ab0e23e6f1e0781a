"""Each operator on its whole table: ``QUERIES`` and, where SQL can say it, ``ORACLE``."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterloom.llm import divergence_audit, license_scan, line_chunks, mixing, quality_forest, sharding, topk_search, url_cascade
from masterloom.llm.embedding_dedup import embedding_components
from masterloom.llm.html_text import extract_text
from masterloom.llm.packing import pack_documents
from masterloom.llm.simhash_dedup import simhash_components
from masterloom.llm.token_alignment import alignment

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL it must equal if there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages").select("page_id", "html"), "html", "text")


@query()
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    placed = pack_documents(table(spark, folder, "documents"), tokenizer_path(), capacity=4096, end=1)
    return placed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a tokenizer's file is, on the driver and on every executor alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op3_quality_forest(spark: SparkSession, folder: str) -> DataFrame:
    stats = quality_forest.statistics_table(table(spark, folder, "documents"))
    model = quality_forest.fit(stats, table(spark, folder, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = quality_forest.judged(stats, model)
    return found.select(F.col("id").alias("doc_id"), *[F.col(f"stats.{c}") for c in counts], "base_failed", "kept", "score")


@query(mixing.ORACLE)
def op4_pareto_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(mixing.document_sizes(table(spark, folder, "documents")))
    taken = (F.col("size") * F.col("copies")).cast("long")
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"))


@query()
def op5_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_components(table(spark, folder, "documents"), shingle=3, radius=3)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query()
def op6_uniform_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_digests(table(spark, folder, "documents"), shards=24)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


RULES = [
    url_cascade.Rule("allow", "com"),
    url_cascade.Rule("block", "example.com", "/en/"),
    url_cascade.Rule("allow", "www.example.com", "/en/"),
    url_cascade.Rule("block", "net", "/es/"),
    url_cascade.Rule("block", "net", "/fr/"),
]

#: The listed domains of the query below and of its SQL.
LISTED = [
    f"{name}.example.{top}"
    for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
]


@query(
    rf"""
WITH urls AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM urls
), listed AS (
  SELECT unnest({LISTED!r}) AS domain
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN EXISTS (SELECT 1 FROM listed WHERE host = domain OR ends_with(host, '.' || domain)) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
)
def op7_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    listed = spark.createDataFrame([(domain,) for domain in LISTED], "key string")
    found = url_cascade.filter_urls(table(spark, folder, "pages").select("page_id", "url"), RULES, listed)
    return found.select("page_id", "host", "path", "rule", "verdict")


@query()
def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = embedding_components(table(spark, folder, "embeddings"), threshold=0.9)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


@query(license_scan.ORACLE)
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_of_documents(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query(line_chunks.ORACLE)
def op10_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = line_chunks.drop_repeated_chunks(docs, n_chunks="n_chunks", n_removed="n_removed")
    return found.select("doc_id", "n_chunks", "n_removed", "text")


@query(divergence_audit.ORACLE)
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence_audit.divergences(table(spark, folder, "documents"))


@query()
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    found = alignment(table(spark, folder, "documents"), *paths)
    return found.select(F.col("id").cast("long").alias("doc_id"), *counts, F.col("digest").alias("groups_sha256"))


@query(topk_search.ORACLE)
def op13_maxscore_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), k=20, every=20)
