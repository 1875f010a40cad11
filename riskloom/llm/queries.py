"""The registered queries of this folder, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.bpe import tokenize
from riskloom.llm.common import held_out
from riskloom.llm.decontaminate import decontaminate
from riskloom.llm.language_id import fit, identify
from riskloom.llm.minhash import near_duplicates
from riskloom.llm.oracles import ORACLES
from riskloom.llm.packing import pack
from riskloom.llm.periodic import digests, periodic_runs
from riskloom.llm.ppm import score
from riskloom.llm.repair import damage, repair
from riskloom.llm.suffix_dedup import remove_repeats
from riskloom.llm.token_files import token_files
from riskloom.llm.topk import top_k
from riskloom.llm.url_filter import judge
from riskloom.llm.warc import read_archives, write_archives
from riskloom.session import fresh_path

URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return judge(_table(spark, sf_dir, "pages"), rules, ["page_id"])


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), length=100, keep=False)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id"], ids=False)


def op4_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archives(_table(spark, sf_dir, "pages"), path)
    rows = read_archives(spark, path, payloads=False).where("kind = 'record'")
    return rows.select(F.expr("try_cast(page AS BIGINT)").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.expr("try_cast(refers_to AS BIGINT)").alias("refers_to"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1, spelled=False)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    net = fit(docs, ~held_out("doc_id", 4))
    rows = docs.select("doc_id", "text", held_out("doc_id", 4).alias("held_out"))
    return identify(rows, net, ["doc_id", "held_out"])


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(_table(spark, sf_dir, "conversations")))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1, ids=False)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(_table(spark, sf_dir, "documents"), plant=True))


_ALL = (op1_url_filter, op2_suffix_dedup, op3_byte_bpe, op4_ppm_score, op5_minhash_near_dedup, op6_warc, op7_decontaminate, op8_exact_topk, op9_token_files, op10_language_id, op11_conversation_repair, op12_best_fit_packing, op13_periodic_runs)
QUERIES = {f.__name__: f for f in _ALL}
__all__ = ["ORACLES", "QUERIES"]
