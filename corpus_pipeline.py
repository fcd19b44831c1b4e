"""A training-corpus pipeline: documents -> language ID -> near-dedup -> repeated-string removal -> decontamination
-> BPE ids. Each stage takes the documents that its predecessor kept, as rows with the columns of ``documents``, and
all but the last return such rows. Nulls, empty and repeated rows are defined in the operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvest.llm import op02_bpe_lexicon as bpe
from harvest.llm import op03_decontaminate as decontamination
from harvest.llm import op04_suffix_dedup as suffixes
from harvest.llm import op05_language_id as language
from harvest.llm import op06_simhash_dedup as simhash
from harvest.llm._text import table
from harvest.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; ``lang`` becomes the predicted language of the others."""
    found = language.with_language(docs.select(COLUMNS)).where("not rejected")
    return found.select("rest.doc_id", "text", F.col("lang_pred").alias("lang"), "rest.source", "rest.n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least id."""
    return simhash.one_of_each(docs.select(COLUMNS))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in strings of 200 bytes that start elsewhere too go, with the rest of characters they cut. Documents stay,
    if need be with an empty text; ``n_chars`` is counted anew."""
    found = suffixes.suffix_dedup(docs.select(COLUMNS), whole_characters=True)
    text = F.col("kept").cast("string")
    return found.select("rest.doc_id", text.alias("text"), "rest.lang", "rest.source", F.length(text).cast("long").alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or reworked, go."""
    found = decontamination.decontaminate(docs.select(COLUMNS), table(spark, sf_dir, "benchmark")).where("not contaminated")
    return found.select("rest.doc_id", "text", "rest.lang", "rest.source", "rest.n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids, and as text what the ids decode to."""
    found = bpe.encode_and_decode(docs.select(COLUMNS), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("rest.doc_id", "text", "rest.lang", "rest.source", "rest.n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("near_dedup", near_dedup), ("repeated_strings", repeated_strings),
    ("decontaminate", decontaminate), ("tokens", tokens)]

#: SQL cannot express the stages; tests/llm compares them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage returns is written as Parquet in the shared folder of
    spark.checkpoint.dir before the next reads it, so that lost executors repeat a stage at most; a stage's files are
    deleted when the next one's are complete, and the last stage is returned as a plan over those of the one before."""
    docs, before = table(spark, sf_dir, "documents"), None
    folder = os.path.join(checkpoint_dir(spark), f"corpus-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        path = os.path.join(folder, name)
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
