"""The thin ``opN_<name>`` queries: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm import topk

    return topk.top_k(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm import mixing

    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm import common, langid

    docs = _table(spark, sf_dir, "documents")
    held_out = common.crc_mod("doc_id", 4) == 2
    model = langid.train(docs.select("doc_id", "text", "lang"), ~held_out)
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    answered = langid.identify(rows, model)
    return answered.select("row.doc_id", "row.held_out", "language.lang_pred", "language.score", "language.rejected")


def op4_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm import tokencount

    return tokencount.count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_dac(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm import common, dac

    path = common.scratch_path(spark, "dac")
    dac.write(_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    common.delete_on_exit(spark, path)
    return dac.read_digest(spark, path)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm import quality

    judged = quality.assess(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("row.doc_id", *[F.col(f"quality.{x}") for x in names])


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm import common, lm

    return lm.score(_table(spark, sf_dir, "documents").select("doc_id", "text"), common.crc_mod("doc_id", 5) == 1)


def op8_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm import sharding

    return sharding.place(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), shards=24)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm import simhash

    return simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), words=4, most=4)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm import packing

    packed = packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_mixing": op2_mixing,
    "op3_langid": op3_langid,
    "op4_tokencount": op4_tokencount,
    "op5_dac": op5_dac,
    "op6_quality": op6_quality,
    "op7_ppm": op7_ppm,
    "op8_hilbert": op8_hilbert,
    "op9_simhash": op9_simhash,
    "op10_packing": op10_packing,
}
