"""Queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinlink.llm.mixing import MIX_ORACLE


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinlink.llm.fingerprints import fingerprint_report

    return fingerprint_report(_read(spark, sf_dir, "documents"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinlink.llm.chat import expand, read_back

    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return read_back(expand(turns.unionByName(extra)), ordered=True)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinlink.llm.line_crf import quality_report

    return quality_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinlink.llm.mixing import mix_report

    return mix_report(_read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from kinlink.llm.common import fresh_path
    from kinlink.llm.token_cache import count_tokens

    return count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), fresh_path(spark, "token-cache"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinlink.llm.licenses import licence_hits

    return licence_hits(_read(spark, sf_dir, "documents"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinlink.llm.simhash_dedup import groups

    return groups(_read(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinlink.llm.common import fresh_path
    from kinlink.llm.warc import read_archives, write_archives

    return read_archives(write_archives(_read(spark, sf_dir, "pages"), fresh_path(spark, "warc")))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinlink.llm.url_filter import judge

    return judge(_read(spark, sf_dir, "pages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinlink.llm.decontaminate import contaminated

    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_token_counts": op5_token_counts,
    "op6_license_scan": op6_license_scan,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_warc": op8_warc,
    "op9_url_filter": op9_url_filter,
    "op10_decontamination": op10_decontamination,
}

ORACLES: dict[str, str] = {
    "op4_mixing": MIX_ORACLE,
}
