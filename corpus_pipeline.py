"""From raw documents to tokens: stages, each written as Parquet and read again."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.llm import bpe, decontaminate, language, line_dedup, simhash
from ledgerlake.llm.common import bound_batches, table
from ledgerlake.session import shared_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters or below 0.5 go."""
    bound_batches(spark)
    return language.keep_identified(docs)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many share; ``n_chars`` counts what is left."""
    cut = line_dedup.dedup_lines(docs)
    return cut.select(*(
        F.length("text").cast(docs.schema[name].dataType).alias(name) if name == "n_chars" else F.col(f"`{name}`")
        for name in docs.columns
    ))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    bound_batches(spark)
    return simhash.keep_representatives(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with digests of the ids and of the decoded text."""
    bound_batches(spark)
    return bpe.encode_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("BPE encoding", encode_tokens),
]

# SQL cannot express naive Bayes over hashed n-grams, XXH64 or BPE; the stages are tested
# against plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``; stages meet in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
