"""The corpus pipeline: documents through filtering, two dedups, mixing and packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written as
Parquet and read again as the next one's ``docs``.  All but the last return the columns
of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterloom.llm import quality_forest
from masterloom.llm.common import stage
from masterloom.llm.line_chunks import drop_repeated_passages
from masterloom.llm.mixing import mix_documents
from masterloom.llm.packing import pack_documents
from masterloom.llm.queries import tokenizer_path
from masterloom.llm.simhash_dedup import keep_one_per_component


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or that the calibrated forest finds odd, go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    measured, stats = quality_forest.with_statistics(docs, "text")
    rows = measured.select(F.col("doc_id").alias("id"), F.col(stats).alias("stats"))
    return quality_forest.keep_good(measured, quality_forest.fit(rows, labels), "text", stats)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of several lines that occur again, by chunks and the lines beside them, are taken out.

    ``n_chars`` follows the text.
    """
    left = drop_repeated_passages(docs, "doc_id", "text")
    if "n_chars" in left.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one_per_component(docs, "doc_id", "text", shingle=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_documents(docs, "doc_id", "source", "text", cycle=(1, 2, 3), most=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document (as often as it is mixed in) with its place in a sequence."""
    placed = pack_documents(docs, tokenizer_path(), "doc_id", "text", capacity=4096, end=1)
    return placed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL cannot say the stages' random splits and 64-bit hashes; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{number}")
    return docs
