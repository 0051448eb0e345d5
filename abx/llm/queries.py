"""Registered queries of this package: name -> callable(spark, sf_dir), and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abx.llm.main_text import ORACLE as MAIN_TEXT_ORACLE
from abx.llm.merkle import ORACLE as MERKLE_ORACLE
from abx.llm.mixing import ORACLE as MIXING_ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


@register("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@register("op10_outliers")
def op10_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.outliers import judge

    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2"]
    return judge(table(spark, sf_dir, "documents")).select(*cols)


@register("op5_mixing", MIXING_ORACLE)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


@register("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.pii import report

    return report(table(spark, sf_dir, "documents"))


@register("op2_ppm")
def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.ppm import score

    return score(table(spark, sf_dir, "documents"))


@register("op8_ann")
def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.ann import search

    return search(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0)


@register("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.knn_quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_langid")
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.langid import fit, identify_pages

    return identify_pages(table(spark, sf_dir, "pages"), fit(table(spark, sf_dir, "documents")))


@register("op1_chat")
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.chat import format_chats
    from abx.llm.common import id_mod

    # A fifth of the transcripts is never learned from.
    return format_chats(table(spark, sf_dir, "conversations"), learn_from=id_mod(F.col("conv_id"), 5) != 0)


@register("op13_merkle", MERKLE_ORACLE)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.merkle import report

    return report(table(spark, sf_dir, "documents"))


@register("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.align import align

    return align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


@register("op12_main_text", MAIN_TEXT_ORACLE)
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abx.llm.main_text import extract

    return extract(table(spark, sf_dir, "pages"))
