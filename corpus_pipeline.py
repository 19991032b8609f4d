"""A training corpus from raw documents, in five stages; each is written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import jaccard, langid, lines, packing, suffix
from tillwright.llm.registry import share_code, tokenizer_path
from tillwright.session import scratch_path

#: Phrases a letter above which a text of at least so many characters is like none of the languages.
MOST_RATE, LEAST_CHARS = 0.5, 40
#: Pieces that one task packs at a time; their token ids travel with them.
GROUP_ITEMS = 6_000
#: SQL has no suffix automata, so the pipeline is tested against brute force.
ORACLE_SQL = None


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``documents``, the number of characters brought up to date."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; the others go."""
    share_code(spark)
    found = langid.predict(docs, langid.train(docs))
    strange = (F.col("lang_rate") > MOST_RATE) & (F.length("text") >= LEAST_CHARS)
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & ~strange).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and documents of which nothing is left."""
    found = lines.drop_repeated_lines(docs)
    return _sized(found.filter((F.col("n_lines") == 0) | (F.col("n_deleted") < F.col("n_lines"))), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    share_code(spark)
    return jaccard.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated byte strings go, and documents of which nothing is left."""
    share_code(spark)
    found = suffix.remove_repeats(docs, spelled=True)
    return _sized(found.filter((F.col("n_bytes") == 0) | (F.col("n_removed") < F.col("n_bytes"))), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its token ids and its place in a sequence."""
    share_code(spark)
    placed = packing.pack(packing.pieces(docs, tokenizer_path()), group_items=GROUP_ITEMS)
    return placed.drop("row")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
