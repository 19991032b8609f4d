"""Registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import bpe, chat, jaccard, langid, lines, merkle, mixing, ordermin, packing, passages, quality, repair, suffix

TOKENIZER = "byte_bpe_50k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def share_code(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package from wherever the driver did."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("ids")
        bounds = np.array(ids.offsets) - ids.offsets[0].as_py()
        raw = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4").view(np.uint8)
        marks = [hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
        texts = [hashlib.sha256(text.encode()).hexdigest() for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(marks, pa.string()), pa.array(texts, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return bpe.round_trip(documents(spark, sf_dir), tokenizer_path(), digest,
                          "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.measure(docs, quality.fit(docs, labels.filter("quality = 1 AND coalesce(toxic, 0) = 0")))


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256"))


def op4_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    shown = chat.format_preferences(*chat.reply_swaps(table))
    mask = F.array_join(F.transform("mask", lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string"))), ",")
    return shown.select(F.col("pair_id").alias("conv_id"), "part", F.col("segment").cast("long").alias("segment"),
                        "text", mask.alias("mask"), F.col("turns").cast("long").alias("turns"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_repeated_lines(documents(spark, sf_dir))
    worded = F.filter(F.split("text", "\n", -1), lambda x: ~x.rlike(lines.BLANK))
    mark = F.when(F.size(worded) > 0, F.md5(F.array_join(worded, "\n"))).otherwise("")
    return found.select("doc_id", "n_lines", "n_deleted", mark.alias("kept_lines_md5"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.filter(~F.coalesce(held_out(), F.lit(False))))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.edit_study(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir), tokenizer_path(), with_ids=False)
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                         "sequence_id", F.col("offset").cast("long").alias("offset"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(documents(spark, sf_dir))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair.report(table, repair.damaged(table))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    found = [op1_bpe, op2_quality, op3_suffix, op4_preferences, op5_lines, op6_jaccard, op7_language, op8_passages,
             op9_fingerprints, op10_packing, op11_manifest,
             op12_repair, op13_mixing]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op4_preferences": chat.oracle_sql(), "op5_lines": lines.oracle_sql()}
