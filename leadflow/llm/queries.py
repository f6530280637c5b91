"""One query per operator, over its whole table: ``QUERIES[name](spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op7_exact_dedup")
def op7(spark: SparkSession, d: str) -> DataFrame:
    from leadflow.llm.exact import exact_dedup
    return exact_dedup(table(spark, d, "documents"))


@query("op8_mixing")
def op8(spark: SparkSession, d: str) -> DataFrame:
    from leadflow.llm.mixing import mix
    return mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_quality_rules")
def op10(spark: SparkSession, d: str) -> DataFrame:
    from leadflow.llm.quality import judge
    return judge(table(spark, d, "documents"))


@query("op5_packing")
def op5(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    from leadflow.llm.packing import pieces
    return pieces(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op6_token_output")
def op6(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    from leadflow.llm.token_store import token_output
    return token_output(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op2_substring_dedup")
def op2(spark: SparkSession, d: str) -> DataFrame:
    from leadflow.llm.substring import substring_dedup
    return (substring_dedup(table(spark, d, "documents"))
            .select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")))


@query("op3_chat_formatting")
def op3(spark: SparkSession, d: str) -> DataFrame:
    from leadflow.llm.chat import format_turns
    tricky = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                    "conv_id long, turn long, role string, text string")
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return format_turns(turns.unionByName(planted))


@query("op4_quality_classifier")
def op4(spark: SparkSession, d: str) -> DataFrame:
    from leadflow.llm.ranker import classify
    return classify(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op1_ngram_join")
def op1(spark: SparkSession, d: str) -> DataFrame:
    from leadflow.llm.ngram_join import ngram_join
    return ngram_join(table(spark, d, "documents"))


@query("op9_license_scan")
def op9(spark: SparkSession, d: str) -> DataFrame:
    from leadflow.llm.license_scan import license_scan
    return license_scan(table(spark, d, "documents"), best_only=True)


@query("op11_periodic_runs")
def op11(spark: SparkSession, d: str) -> DataFrame:
    from leadflow.llm.periodic import listing, longest, periodic_runs, repeat_tails
    docs = table(spark, d, "documents").select("doc_id", repeat_tails(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs(docs).withColumn("best", longest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listing(F.col("runs")), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"))


@query("op12_document_fingerprints")
def op12(spark: SparkSession, d: str) -> DataFrame:
    from leadflow.llm.piecewise import compare_with_next
    return compare_with_next(table(spark, d, "documents")).select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")


@query("op13_token_alignment")
def op13(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    from leadflow.llm.alignment import align
    return align(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model")).withColumnRenamed("groups", "groups_sha256")
