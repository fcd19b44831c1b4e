"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harvest.llm import op01_substring_dedup as op1
from harvest.llm import op02_bpe_lexicon as op2
from harvest.llm import op03_decontaminate as op3
from harvest.llm import op04_suffix_dedup as op4
from harvest.llm import op05_language_id as op5
from harvest.llm import op06_simhash_dedup as op6
from harvest.llm import op07_sharding as op7
from harvest.llm import op08_quality_rules as op8
from harvest.llm import op09_html_text as op9
from harvest.llm import op10_chat_format as op10
from harvest.llm import op11_url_filter as op11
from harvest.llm import op12_whitening as op12
from harvest.llm import op13_merkle_manifest as op13
from harvest.llm._text import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.digest(op1.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op2_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.digest(op2.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.digest(op3.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.digest(op4.suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.digest(op5.with_language(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.digest(op6.simhash_dedup(table(spark, sf_dir, "documents")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.digest(op7.shuffled(table(spark, sf_dir, "documents")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.digest(op8.quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels")))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.digest(op9.extract(table(spark, sf_dir, "pages")))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.format_chat(op10.tool_use(table(spark, sf_dir, "conversations")), op10.tool_table(spark))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.digest(op11.judged(table(spark, sf_dir, "pages").select("page_id", "url")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.whitened(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.digest(op13.manifest(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_bpe_lexicon, op3_decontaminate, op4_suffix_dedup, op5_language_id,
                             op6_simhash_dedup, op7_sharding, op8_quality_rules, op9_html_text, op10_chat_format, op11_url_filter, op12_whitening, op13_merkle_manifest)}

#: The other operators can't be written as SQL of reasonable cost over whole tables; tests/llm holds each
#: against a brute-force version, an exact round trip or held-out accuracy.
ORACLE: dict[str, str] = {"op11_url_filter": op11.oracle(), "op13_merkle_manifest": op13.oracle()}
