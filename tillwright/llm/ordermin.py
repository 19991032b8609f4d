"""Document fingerprints by order MinHash.

A text's words, in runs of ``k``, are numbered by occurrence, so that a run seen twice counts as
two elements. For each of ``sketches`` hash functions the ``ell`` least elements are selected,
put back into text order, and hashed as a tuple. Two texts that share elements in another order
thus differ, which makes the likeness, the share of equal tuples, follow edit distance rather
than mere overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.textbatch import Texts, Words, combine, mix, slices
from tillwright.session import scratch_path


#: Text of one part of the order, at most on average; a small input has as many parts as shuffles have partitions.
PART_BYTES = 128 << 20


@dataclass(frozen=True)
class Settings:
    k: int = 3
    ell: int = 2
    sketches: int = 24


def _elements(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-numbered runs of ``k`` words of all texts, and where each text's begin.

    A text of fewer words is one run.
    """
    at, runs = words.grams(k)
    owner = np.searchsorted(words.bounds, at, "right") - 1
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        whole = [combine([words.hashes[w:w + 1] for w in range(words.bounds[i], words.bounds[i + 1])])[0] for i in short]
        places = np.searchsorted(owner, short)
        runs, owner = np.insert(runs, places, whole), np.insert(owner, places, short)
    keys = mix(runs + mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])[:len(ranked)]
    place = np.arange(len(runs))
    number = np.empty(len(runs), np.uint64)
    number[order] = (place - np.maximum.accumulate(np.where(first, place, 0))).astype(np.uint64)
    return combine([runs, number]), np.searchsorted(owner, np.arange(len(words.texts) + 1))


def marks_of(words: Words, settings: Settings) -> np.ndarray:
    """(texts x sketches) tuple hashes; all zero for a text without words."""
    elements, bounds = _elements(words, settings.k)
    counts = np.diff(bounds)
    marks = np.zeros((len(counts), settings.sketches), np.uint32)
    full = np.flatnonzero(counts)
    if not len(full):
        return marks
    starts, counts = bounds[:-1][full], counts[full]
    salts = mix(np.arange(1, settings.sketches + 1, dtype=np.uint64))
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for s, salt in enumerate(salts):
        # An odd multiplier: a permutation of the 64-bit numbers for each function.
        ranks = (elements ^ salt) * (salt | np.uint64(1))
        picked = np.full((settings.ell, len(full)), len(elements), np.int64)
        for i in range(settings.ell):
            least = np.minimum.reduceat(ranks, starts)
            found = np.flatnonzero(ranks == np.repeat(least, counts))
            mine = np.searchsorted(found, starts)
            has = counts > i
            picked[i, has] = found[mine[has]]
            ranks[picked[i, has]] = top
        picked.sort(axis=0)
        values = np.append(elements, np.uint64(0))
        value = np.full(len(full), salt, np.uint64)
        for i in range(settings.ell):
            value = mix(value * np.uint64(3) + values[picked[i]])
        marks[full, s] = np.maximum((value >> np.uint64(32)).astype(np.uint32), np.uint32(1))
    return marks


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of hash functions whose tuples agree."""
    return float(np.mean(a == b))


def _text(mark: np.ndarray) -> str:
    return mark.astype("<u4").tobytes().hex()


def _marks(texts: list[bytes], settings: Settings) -> np.ndarray:
    return marks_of(Words.of(Texts.of(pa.array(texts, pa.binary()))), settings)


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (hexadecimal) of every row's text; a null text is empty.

    Equal texts have equal fingerprints. Nothing is shuffled; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            marks = _marks([(t or "").encode() for t in batch.column("text").to_pylist()], settings)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(_text, marks), pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, fingerprint string")


def parts_for(docs: DataFrame) -> int:
    """How many parts the order of ``docs`` is cut into; grows with the bytes of their text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def with_next(docs: DataFrame, partitions: int) -> DataFrame:
    """Rows in partitions by descending doc_id; columns (part, guest, doc_id, text).

    Each partition also holds, as ``guest``, the rows of the least key of the partition that
    follows it, so that every row's next one is at hand. After the last comes the first. Keys are
    cut at quantiles of doc_id, of which the driver sees one a partition. A null doc_id comes
    last. The text is shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = sorted(set(rows.stat.approxQuantile("doc_id", [i / partitions for i in range(1, partitions)], 0.25 / partitions))) \
        if partitions > 1 else []
    edges = np.array(cuts, np.float64)
    last = len(edges) + 1  # part of the null keys

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        parts = len(edges) - np.searchsorted(edges, ids.to_numpy(np.float64, na_value=np.nan), "left")
        return pd.Series(np.where(ids.isna(), last, parts).astype(np.int32))

    # The first key of each part: part numbers and keys only.
    path = scratch_path(spark, "parts")
    rows.select(part_of("doc_id").alias("part"), "doc_id").groupBy("part").agg(
        F.max("doc_id").alias("doc_id")).write.parquet(path)
    heads = {r.part: r.doc_id for r in spark.read.parquet(path).collect()}
    present = sorted(heads)
    before = {p: present[i - 1] for i, p in enumerate(present)}

    host = F.struct(F.col("part").alias("host"), F.lit(False).alias("guest"))
    visits = spark.createDataFrame([(p, heads[p], before[p]) for p in present], "head_part int, head long, visited int")
    keyed = rows.withColumn("part", part_of("doc_id"))
    joined = keyed.join(F.broadcast(visits), (F.col("part") == F.col("head_part")) & F.col("doc_id").eqNullSafe(F.col("head")), "left")
    visit = F.struct(F.col("visited").alias("host"), F.lit(True).alias("guest"))
    places = F.when(F.col("visited").isNull(), F.array(host)).otherwise(F.array(host, visit))
    return joined.select(F.explode(places).alias("at"), "doc_id", "text").select(
        F.col("at.host").alias("part"), F.col("at.guest").alias("guest"), "doc_id", "text")


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edit_study(docs: DataFrame, settings: Settings = Settings(), partitions: int | None = None) -> DataFrame:
    """How fingerprints bear an edit: the last third of each text gives way to the next text's head.

    The last floor(n / 3) code points are replaced by the first as many, or all, of the next
    document by descending doc_id. One row for each row of ``docs``; rows of one doc_id follow
    each other by the hash of their text. A null text is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows arrive by part, hosts before guests, in descending order.
        held: list[tuple] = []  # the part's rows that still wait for their next one
        size, part, first = 0, None, None

        def flush(rows: list[tuple], after: tuple | None) -> pa.RecordBatch:
            chain = [t for _, t in rows] + ([after[1]] if after else [])
            texts = [t.encode() for t in chain]
            count = len(rows)
            edited = []
            for i in range(count):
                text, cut = chain[i], len(chain[i]) // 3
                edited.append((text[:len(text) - cut] + chain[i + 1][:cut]).encode() if cut else texts[i])
            marks = _marks(texts + edited, settings)
            plain, changed = marks[:len(chain)], marks[len(chain):]
            return pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in rows], pa.int64()), pa.array([len(t) for _, t in rows], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array([_text(m) for m in plain[:count]]),
                pa.array([_text(m) for m in changed]), pa.array([likeness(a, b) for a, b in zip(plain, changed)]),
                pa.array([likeness(plain[i], plain[i + 1]) for i in range(count)]),
            ], [c.split()[0] for c in SCHEMA.split(", ")])

        done_part = object()
        for batch in batches:
            for p, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text"))):
                row = (doc_id, text or "")
                if p != part:
                    part, done_part, held, size = p, object(), [], 0
                if done_part is part:
                    continue  # a second guest: only the first is next to the part's last row
                if guest:
                    yield flush(held, row)
                    held, size, done_part = [], 0, part
                    continue
                if size > 1 << 21:
                    yield flush(held, row)
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
        if held:
            raise ValueError("a part has no guest")

    count = partitions or parts_for(docs)
    # Each part has a partition of its own; hashed, several would meet in one.
    ordered = with_next(docs, count).repartitionById(count, F.col("part") % count).sortWithinPartitions(
        "part", "guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    return ordered.mapInArrow(run, SCHEMA)
