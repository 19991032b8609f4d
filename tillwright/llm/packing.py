"""Best-fit packing of token sequences by hierarchical residual packing.

Items are first packed best-fit where they lie, in groups of bounded size. Bins that are nearly
full are done. The others become items, each as one piece of its fill, of a next round with
fewer groups, and so on up the tree until one group holds them all or a round closes nothing.
A group never holds more than ``group_items`` items, whatever the size of the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.bpe import Encoder
from tillwright.llm.textbatch import release, slices
from tillwright.session import scratch_path

CAPACITY = 1024
END_ID = 2
#: Most items that one task packs at a time.
GROUP_ITEMS = 100_000
#: A bin with at most this much room left is closed before the last round.
SLACK = 4


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than the capacity."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = ([0] if first else []) + list(range(first, length, capacity))
    return [(s, (first if s == 0 and first else capacity)) for s in starts]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = True) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32, ids) of the ids of each text and ``end_id``.

    A null or empty text is the end id alone. Each row is a document of its own, also if its
    doc_id is repeated or null; ``row`` tells rows apart. Other columns are ignored.
    """
    schema = "row long, doc_id long, piece int, start long, length int, ids_crc32 long"
    schema += ", ids binary" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = end_id.to_bytes(4, "little")
        encoder, row = Encoder(path), TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text"):
            out: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encoder.encode(text or "") + end
                for n, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + length)]
                    values = (row, doc_id, n, start, length, zlib.crc32(part), part)
                    for column, value in zip(out.values(), values):
                        column.append(value)
                row += 1
            yield pa.RecordBatch.from_pydict({
                c.split()[0]: pa.array(out[c.split()[0]], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]])
                for c in schema.split(", ")})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item: largest first, each into the fullest bin that still has room."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, bins = 0, 0
    result = np.empty(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, number = capacity, bins
            bins += 1
        result[i] = number
        left = room - size
        if left:
            by_room[left].append(number)
            open_rooms |= 1 << left
    return result


def _pack_group(fills: np.ndarray, lists: pa.ListArray, capacity: int) -> pa.RecordBatch:
    """Bins of the given bins: fill, and the members of all that went into each, in that order."""
    bins = best_fit(fills, capacity)
    order = np.argsort(bins, kind="stable")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)[order]
    count = int(bins.max()) + 1 if len(bins) else 0
    total = np.bincount(bins, weights=fills, minlength=count).astype(np.int32)
    members = np.bincount(bins, weights=lists.value_lengths().to_numpy(zero_copy_only=False), minlength=count)
    taken = lists.take(pa.array(order))
    bounds = np.concatenate([[0], np.cumsum(members)]).astype(np.int32)
    assert bounds[-1] == sizes.sum()
    return pa.RecordBatch.from_arrays([pa.array(total), pa.ListArray.from_arrays(pa.array(bounds), taken.flatten())],
                                      ["fill", "members"])


def _pack_batches(batches: Iterator[pa.RecordBatch], capacity: int, group_items: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        for start in range(0, batch.num_rows, group_items):
            part = batch.slice(start, group_items)
            if count and count + part.num_rows > group_items:
                yield _pack_held(held, capacity)
                held, count = [], 0
            held.append(part)
            count += part.num_rows
    if count:
        yield _pack_held(held, capacity)
    release()


def _pack_held(held: list[pa.RecordBatch], capacity: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    return _pack_group(table.column("fill").to_numpy().astype(np.int64), table.column("members").chunk(0), capacity)


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY,
         group_items: int = GROUP_ITEMS, slack: int = SLACK) -> DataFrame:
    """``items`` with (sequence_id, offset): as few sequences of at most ``capacity`` as it can.

    Lengths lie between 1 and the capacity. The columns of an item travel with its bin, so bulky
    ones are better joined afterwards. Offsets have no gaps and begin at 0. Equal lengths are
    taken in any order. An empty input gives an empty result.
    """
    spark = items.sparkSession
    kind = items.schema.simpleString()
    names = items.columns
    schema = f"fill int, members array<{kind}>"
    bins = items.select(F.col(length).cast("int").alias("fill"), F.array(F.struct(*names)).alias("members"))
    done: list[DataFrame] = []
    before = None
    while True:
        path = scratch_path(spark, "pack")
        bins.mapInArrow(lambda batches: _pack_batches(batches, capacity, group_items), schema).write.parquet(path)
        packed = spark.read.schema(schema).parquet(path)
        open_bins = F.col("fill") < capacity - slack
        left = packed.filter(open_bins).count()
        if left == 0 or before == 1 or (before is not None and left > 0.98 * previous):
            done.append(packed)
            break
        done.append(packed.filter(~open_bins))
        before = -(-left // group_items) if left <= group_items else max(2, -(-2 * left // group_items))
        previous = left
        bins = packed.filter(open_bins).repartition(before)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    placed = result.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    before_it = F.expr(f"transform(members, (m, i) -> named_struct('m', m, 'at', "
                       f"aggregate(slice(members, 1, i), 0L, (a, x) -> a + x.{length})))")
    rows = placed.select("sequence_id", F.explode(before_it).alias("x"))
    return rows.select(*[F.col(f"x.m.{c}").alias(c) for c in names], "sequence_id", F.col("x.at").alias("offset"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   with_ids: bool = True) -> DataFrame:
    """All pieces of all documents, with the sequence and the offset of each.

    With ``with_ids`` the ids of each piece, as little-endian unsigned 32-bit integers, come along.
    """
    return pack(pieces(docs, path, capacity, end_id, with_ids), capacity=capacity)
