"""A corpus pipeline of five operators: rules, exact dedup, near-duplicate
join, source mixing, packing.  Each stage reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadflow.session import scratch_path

ORACLE_SQL = None       # packing has tokenizer ids, which SQL cannot give


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    from leadflow.llm.quality import keep_good
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    from leadflow.llm.exact import keep_first_copies
    return keep_first_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word shingles (five words, 0.8)."""
    from leadflow.llm.ngram_join import keep_one_of_each
    return keep_one_of_each(docs, shingle=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    from leadflow.llm.mixing import mixed_documents
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed-length sequences, ids included."""
    import public_tokenizers

    from leadflow.llm.packing import pack
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("ngram_join", ngram_join),
          ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        path = scratch_path(spark, "pipeline", name, unique=True)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return last(spark, docs, sf_dir)
