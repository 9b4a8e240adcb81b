"""The queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_spans

    return find_spans(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hmm import language_model

    return language_model(table(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan

    return scan(table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


#: (host, path, verdict) of the production list.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import byte_bpe, pack

    path = public_tokenizers.path
    return pack(table(spark, sf_dir, "documents"), byte_bpe(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), 0))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import embedding_duplicates

    return embedding_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
