"""The queries of this subpackage: thin wrappers that apply each operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, decontaminate, license_scan, line_dedup, minhash_forest, pii_surrogates, quality_rank, risk_rules, toxicity, vector_code, whitening, word_bpe
from .oracles import ORACLES as ORACLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3, of=4, remainder=2)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rank.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5, of=3, remainder=1)


def op6_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.groups(table(spark, sf_dir, "documents"), width=5, percent=85)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat_format.against_neighbours(table(spark, sf_dir, "conversations"))
    learned = lambda spans: F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return chat_format.format_pairs(pairs, "conv_id").select(
        "conv_id", F.col("n_common").cast("long").alias("n_common"), F.md5("prompt").alias("prompt_md5"), F.md5("chosen").alias("chosen_md5"), F.md5("rejected").alias("rejected_md5"),
        learned("chosen_spans").alias("chosen_learned"), learned("rejected_spans").alias("rejected_learned"),
    )


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The key is the caller's; without one a fixed key makes runs repeatable.
    done = pii_surrogates.replace(table(spark, sf_dir, "documents"), secret=spark.conf.get("spark.tidemark.surrogateKey", "not a secret"))
    return done.select("doc_id", "text", "n_entities", F.array_join("kinds", ",").alias("kinds"))


def op9_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = risk_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), alpha=0.05)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_va_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_code.encode(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return word_bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), most=32)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_quality_rank": op5_quality_rank,
    "op6_minhash_forest": op6_minhash_forest,
    "op7_decontamination": op7_decontamination,
    "op8_chat_format": op8_chat_format,
    "op9_risk_rules": op9_risk_rules,
    "op10_pii_surrogates": op10_pii_surrogates,
    "op11_va_codes": op11_va_codes,
    "op12_word_bpe": op12_word_bpe,
    "op13_jacobi_whitening": op13_jacobi_whitening,
}
