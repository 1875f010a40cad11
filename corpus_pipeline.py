"""The training-data pipeline: language, near copies, repeats, benchmark passages, tokens.

STAGES are applied in order; each takes (spark, docs, sf_dir) and returns a DataFrame, which
is written and read again as the docs of the next. All but the last return the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.bpe import tokenize
from riskloom.llm.common import held_out, keyed
from riskloom.llm.decontaminate import decontaminate
from riskloom.llm.language_id import fit, has_letter, identify
from riskloom.llm.minhash import near_duplicates
from riskloom.llm.suffix_dedup import remove_repeats, whole_text
from riskloom.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter or without text: no language can be told. Where no
    row is labelled there is no model, and documents with letters stay."""
    net = fit(docs, ~held_out("doc_id", 4))
    if net is None:
        return docs.select(*COLUMNS).where(has_letter())
    return identify(docs.select(*COLUMNS), net, COLUMNS).where("lang_pred <> 'und'").select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with ``row``, unique and in order of doc_id even where ids are not."""
    return keyed(docs, *COLUMNS)[0].withColumnRenamed("_u", "row")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each class of near copies."""
    rows = _numbered(docs)
    first = near_duplicates(rows, "row").where("row = class_id").select("row")
    return rows.join(first, "row", "left_semi").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts byte strings of 100 that repeat; bytes of characters cut in two go as well."""
    rows = _numbered(docs)
    kept = remove_repeats(rows, "row").select("row", "kept")
    others = rows.select("row", "doc_id", "lang", "source", F.col("text").isNull().alias("none"))
    cut = others.join(kept, "row").withColumn("text", F.when(~F.col("none"), whole_text("kept")))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents."""
    rows = _numbered(docs)
    found = decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "row")
    return rows.join(found.where("not contaminated").select("row"), "row", "left_semi").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document left."""
    return tokenize(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id", "lang", "source"], ids=False)


STAGES = [("language", language), ("near_copies", near_copies), ("repeats", repeats), ("benchmark", benchmark), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
