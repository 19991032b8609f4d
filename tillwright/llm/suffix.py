"""Removal of repeated byte strings by prefix doubling.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in its own
document or another. Positions are ranked by the strings that start there, at growing lengths,
and leave as soon as their rank is theirs alone:

1. Rank of ``FIRST`` bytes, at anchors only. Of every string of ``LENGTH`` bytes the anchor is
   the place within it whose first bytes have the least hash; equal strings have it at the same
   place, so about one position in fifty stands for all. Anchors of unique rank are done: none of
   the strings they stand for is repeated.
2. Rank of the whole stretch that an anchor's strings cover, up to ``2 * LENGTH - FIRST`` bytes.
   If it is not unique all of them are repeated.
3. Only for anchors that are left, mostly at the ends of copies: each of their positions, by the
   pair of ranks at the position and ``FIRST`` bytes on. Pairs are counted; a pair found twice is a
   repeated string. Of stretches that step 2 found often, one takes part.

Blocks of documents exchange ranks, packed and cut by hash range. Equal stretches or pairs of a
block go out once; where a block has many stretches with one first rank, they are dealt out by
stretch, so that a passage in a third of all documents loads no single task.

The input is read twice and must give the same rows in the same order each time, as files do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm.jaccard import pack_numbers, to_bytes, unpack_numbers
from tillwright.llm.textbatch import Texts, mix, release, slices
from tillwright.session import scratch_path

LENGTH = 200
FIRST = 100
BLOCK_BYTES = 512 << 10
FRAGMENT_BYTES = 8 << 20
#: A block's rows travel in pieces: the JVM sets larger arrays apart and frees them late.
PIECE_BYTES = 192 << 10
#: Positions ranked in one go; each takes some ten numbers meanwhile.
RANKED_AT_ONCE = 64 << 10
#: Stretches with one first rank that a block sends to the rank's own task.
CROWD = 2
UNIQUE, REPEATED, OPEN, SAMPLE = 0, 1, 2, 3
#: A reader holds a row group's payloads at once, and a writer checks its size by the row: both stay small.
SMALL_GROUPS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1",
                "parquet.block.size.row.check.max": "4"}
#: Number of an entry that no one asks about.
NOBODY = 0xFFFFFFFF
RESULTS = ("n_bytes", "n_removed", "n_spans", "spans", "kept")


def anchors(texts: Texts, length: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each anchor: the first and last start of the strings it stands for, rank of ``first`` bytes, rank of all."""
    n = len(texts.data)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if n < length:
        return none
    sums = texts.sums()
    ranks = np.empty(n - first + 1, np.uint64)
    for i in range(0, len(ranks), RANKED_AT_ONCE):
        starts = np.arange(i, min(i + RANKED_AT_ONCE, len(ranks)))
        ranks[i:i + len(starts)] = texts.hashes(starts, starts + first, sums)
    bits = np.uint64(max(1, int(n).bit_length()))
    least = ranks >> bits
    least <<= bits
    least |= np.arange(len(ranks), dtype=np.uint64)
    span, width = 1, length - first + 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    at = np.arange(n - length + 1)
    ends = np.repeat(texts.bounds[1:], np.diff(texts.bounds))[:len(at)]
    at = at[at + length <= ends]
    if not len(at):
        return none
    chosen = (least[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)])
    opens = np.flatnonzero(new)
    low, high = at[opens], at[np.concatenate([opens[1:], [len(at)]]) - 1]
    return low, high, ranks[chosen[opens]], texts.hashes(low, high + length, sums)


@dataclass
class _Block:
    """Anchors of a block, grouped by first rank and stretch."""

    name: str
    batch: pa.RecordBatch
    low: np.ndarray
    high: np.ndarray
    stretch: np.ndarray  # group of each anchor
    ranks: np.ndarray  # of each group, in order
    wholes: np.ndarray
    counts: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch], length: int, first: int) -> Iterator[_Block]:
    task = TaskContext.get().partitionId()
    for number, batch in enumerate(slices(batches, "text", BLOCK_BYTES)):
        low, high, ranks, wholes = anchors(Texts.of(batch.column("text")), length, first)
        order = np.lexsort((wholes, ranks))
        k, u = ranks[order], wholes[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (u[1:] != u[:-1])
        groups = np.cumsum(new) - 1
        own = np.empty(len(k), np.int64)
        own[order] = groups
        name = f"{task}-{number}-{zlib.crc32(ranks)}"
        yield _Block(name, batch, low, high, own, k[new], u[new], np.minimum(np.bincount(groups, minlength=int(new.sum())), 2))


def _deal(target: np.ndarray, fragments: int, block: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (fragment, block, payload) of the columns, those of one fragment in order of the first."""
    order = np.lexsort((columns[0], target))
    bounds = np.searchsorted(target[order], np.arange(fragments + 1))
    held = np.flatnonzero(np.diff(bounds))
    payloads = [pack_numbers(*(c[order[bounds[f]:bounds[f + 1]]] for c in columns)) for f in held]
    return pa.RecordBatch.from_arrays(
        [pa.array(held, pa.int32()), pa.array([block] * len(held), pa.string()), pa.array(payloads, pa.binary())],
        ["fragment", "block", "payload"])


def _ranks(batches: Iterator[pa.RecordBatch], fragments: int, length: int, first: int) -> Iterator[pa.RecordBatch]:
    """Ranks and stretches of each block, under their fragment."""
    for block in _blocks(batches, length, first):
        k, u = block.ranks, block.wholes
        # Stretches of one rank: so many, and dealt out by stretch if they are a crowd.
        lead = np.concatenate([[True], k[1:] != k[:-1]])[:len(k)]
        sizes = np.diff(np.concatenate([np.flatnonzero(lead), [len(k)]]))
        crowd = np.repeat(sizes > CROWD, sizes) if len(k) else lead
        # An anchor's rank is the least of many, so ranks crowd at the low end; mixed, they spread evenly.
        cut = (mix(k) >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
        salted = np.uint64(fragments) + ((mix(u) >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32))
        known = np.flatnonzero(lead & crowd)  # the rank's own task must know that it is shared
        target = np.concatenate([np.where(crowd, salted, cut), cut[known]]).astype(np.int64)
        u = np.concatenate([u, np.zeros(len(known), np.uint64)])
        yield _deal(target, 2 * fragments, block.name, [
            np.concatenate([k, k[known]]), u & np.uint64(0xFFFFFFFF), u >> np.uint64(32),
            np.concatenate([np.arange(len(k)), np.full(len(known), NOBODY)]), np.concatenate([block.counts, np.full(len(known), 2)])])


def _rows(batches: Iterator[pa.RecordBatch], length: int, first: int) -> Iterator[pa.RecordBatch]:
    """Rows and anchors of each block."""
    for block in _blocks(batches, length, first):
        rows = to_bytes(block.batch)
        payload = rows + pack_numbers(block.low, block.high - block.low, block.stretch)
        pieces = [payload[i:i + PIECE_BYTES] for i in range(0, len(payload), PIECE_BYTES)]
        n = len(pieces)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block.name] * n), pa.array([len(rows)] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([n] * n, pa.int32()),
             pa.array(pieces, pa.binary())], ["block", "head", "piece", "pieces", "payload"])


def _judge(key: tuple, table: pa.Table, fragments: int) -> pa.Table:
    """What each block's stretches are: (block, payload of index and kind), unique ones left out."""
    fragment = key[0].as_py()
    blocks = table.column("block").to_pylist()
    parts = [unpack_numbers(p, 5) for p in table.column("payload").to_pylist()]
    k = np.concatenate([p[0] for p in parts])
    u = np.concatenate([p[1].astype(np.uint64) | (p[2].astype(np.uint64) << np.uint64(32)) for p in parts])
    index, counts = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts]).astype(np.int64)
    source = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    told = index == NOBODY
    order = np.lexsort((source, u, k))
    k, u, index, counts, source, told = (x[order] for x in (k, u, index, counts, source, told))
    new_k = np.concatenate([[True], k[1:] != k[:-1]])
    new = new_k | np.concatenate([[True], (u[1:] != u[:-1]) | (told[1:] != told[:-1])])
    by_k, by_u = np.cumsum(new_k) - 1, np.cumsum(new) - 1
    of_k = np.bincount(by_k, weights=counts)[by_k]
    of_u = np.bincount(by_u, weights=counts)[by_u]
    salted = fragment >= fragments
    kind = np.where(of_u > 1, REPEATED, np.where((of_k > 1) | salted, OPEN, UNIQUE))
    # Where any stretch of a rank is open, one of each repeated stretch takes part in step 3.
    any_open = np.bincount(by_k, weights=(kind == OPEN) | told)[by_k] > 0
    kind = np.where((kind == REPEATED) & new & (any_open | salted), SAMPLE, kind)
    keep = np.flatnonzero((kind != UNIQUE) & ~told)
    keep = keep[np.argsort(source[keep], kind="stable")]
    bounds = np.searchsorted(source[keep], np.arange(len(parts) + 1))
    out, payloads = [], []
    for i, block in enumerate(blocks):
        mine = keep[bounds[i]:bounds[i + 1]]
        if len(mine):
            mine = mine[np.argsort(index[mine])]
            out.append(block)
            payloads.append(pack_numbers(index[mine], kind[mine]))
    del parts, k, u, index, counts, source, told, order, keep
    release()
    return pa.table({"block": pa.array(out, pa.string()), "payload": pa.array(payloads, pa.binary())})


def finish(batch: pa.RecordBatch, texts: Texts, low: np.ndarray, high: np.ndarray, length: int) -> pa.RecordBatch:
    """The columns of ``batch`` but its text, and what is left, if the strings that start at ``low`` to ``high`` go."""
    edges = np.zeros(len(texts.data) + 1, np.int32)
    np.add.at(edges, low, 1)
    np.add.at(edges, high + length, -1)
    gone = np.cumsum(edges[:-1]) > 0
    opens = gone & ~np.concatenate([[False], gone[:-1]])[:len(gone)]
    begins = texts.bounds[:-1][texts.bounds[:-1] < len(gone)]
    opens[begins] = gone[begins]
    closes = gone & ~np.concatenate([gone[1:], [False]])[:len(gone)]
    lasts = texts.bounds[1:][texts.bounds[1:] > 0] - 1
    closes[lasts] = gone[lasts]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    base = texts.bounds[texts.text_of(starts)] if len(starts) else starts
    spans = pa.StructArray.from_arrays([pa.array(starts - base, pa.int64()), pa.array(ends - base, pa.int64())], ["start", "end"])
    n_spans = texts.per_text(opens)
    removed = texts.per_text(gone)
    left = texts.data[~gone].tobytes()
    bounds = np.concatenate([[0], np.cumsum(np.diff(texts.bounds) - removed)])
    known = batch.column("text").is_valid().to_pylist()
    kept = [left[a:b] if k else None for a, b, k in zip(bounds[:-1].tolist(), bounds[1:].tolist(), known)]
    others = [n for n in batch.schema.names if n != "text"]
    return pa.RecordBatch.from_arrays(
        [*[batch.column(n) for n in others], pa.array(np.diff(texts.bounds), pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
         pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_spans)]).astype(np.int32)), spans), pa.array(kept, pa.binary())],
        [*others, *RESULTS])


STAGED = "kind int, fragment int, block string, payload binary"
DONE, PENDING, PAIRS = 0, 1, 2


def _spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All positions of the ranges, in their order."""
    sizes = high - low + 1
    return np.arange(int(sizes.sum())) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)


def _pairs(texts: Texts, positions: np.ndarray, length: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the first bytes at each position, and of those ``first`` bytes on up to the whole length."""
    sums = texts.sums()
    one = texts.hashes(positions, positions + first, sums)
    two = texts.hashes(positions + first, positions + length, sums)
    return one, (two >> np.uint64(32)).astype(np.uint32)


def _groups(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each pair's group, in order of the pairs, and where each group is first met."""
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group, order[new]


def _resolve(key: tuple, replies: pa.Table, rows: pa.Table, fragments: int, length: int, first: int) -> pa.Table:
    """A block after step 2: finished rows, rows that wait, and pairs of ranks of step 3."""
    block = key[0].as_py()
    rows = rows.sort_by("piece")
    if rows.column("piece").to_pylist() != list(range(rows.column("pieces")[0].as_py() if len(rows) else 1)):
        raise ValueError(f"block {block} lacks rows or has some twice")
    head, body = rows.column("head")[0].as_py(), b"".join(rows.column("payload").to_pylist())
    batch = _read_batch(body[:head])
    texts = Texts.of(batch.column("text"))
    low, width, stretch = unpack_numbers(body[head:], 3)
    low, high, stretch = low.astype(np.int64), (low + width).astype(np.int64), stretch.astype(np.int64)
    kinds = np.zeros(int(stretch.max()) + 1 if len(stretch) else 0, np.int64)
    for payload in replies.column("payload").to_pylist():
        index, kind = unpack_numbers(payload, 2)
        kinds[index.astype(np.int64)] = kind
    kind = kinds[stretch] if len(stretch) else stretch
    sure, asks = (kind == REPEATED) | (kind == SAMPLE), kind == OPEN
    lone = np.zeros(len(stretch), bool)
    lone[np.unique(stretch, return_index=True)[1]] = True
    waits = np.zeros(len(texts), bool)
    owner = texts.text_of(low)
    waits[owner[asks]] = True
    out: list[tuple] = []
    if not waits.all():
        out.append((DONE, -1, to_bytes(_part(batch, texts, np.flatnonzero(~waits), low[sure], high[sure], owner[sure], length))))
    if waits.any():
        rest = np.flatnonzero(waits)
        mine = sure & waits[owner]
        # Positions are those of the whole block.
        facts = pa.RecordBatch.from_arrays(
            [pa.array([x], pa.list_(pa.int64())) for x in (texts.bounds[rest], low[mine], high[mine], low[asks], high[asks])],
            ["base", "low", "high", "open_low", "open_high"])
        out.append((PENDING, -1, to_bytes(batch.take(pa.array(rest))) + to_bytes(facts)))
    table = pa.table({"kind": pa.array([r[0] for r in out], pa.int32()), "fragment": pa.array([r[1] for r in out], pa.int32()),
                      "block": pa.array([block] * len(out), pa.string()), "payload": pa.array([r[2] for r in out], pa.binary())})
    sample = (kind == SAMPLE) & lone
    if not (asks.any() or sample.any()):
        return table
    asked = _spread(low[asks], high[asks])
    one, two = _pairs(texts, np.concatenate([asked, _spread(low[sample], high[sample])]), length, first)
    group, firsts = _groups(one, two)
    counts = np.minimum(np.bincount(group), 2)
    wanted = np.zeros(len(firsts), bool)
    wanted[group[:len(asked)]] = True
    number = np.where(wanted, np.cumsum(wanted) - 1, NOBODY)
    one, two = one[firsts], two[firsts]
    target = ((one >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
    dealt = _deal(target, fragments, block, [one, two, number, counts])
    pairs = pa.Table.from_batches([dealt]).add_column(0, "kind", pa.array([PAIRS] * dealt.num_rows, pa.int32()))
    return pa.concat_tables([table, pairs])


def _match(table: pa.Table) -> pa.Table:
    """Of a fragment of pairs, the numbers of those that occur twice, to each block that asks."""
    blocks = table.column("block").to_pylist()
    parts = [unpack_numbers(p, 4) for p in table.column("payload").to_pylist()]
    one, two, number, counts = (np.concatenate([p[i] for p in parts]) for i in range(4))
    group, _ = _groups(one, two)
    repeated = np.bincount(group, weights=counts)[group] > 1
    bounds = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])
    out, payloads = [], []
    for i, block in enumerate(blocks):
        mine = np.arange(bounds[i], bounds[i + 1])
        mine = mine[repeated[mine] & (number[mine] != NOBODY)]
        if len(mine):
            out.append(block)
            payloads.append(pack_numbers(np.sort(number[mine])))
    del parts, one, two, number, counts, group
    release()
    return pa.table({"block": pa.array(out, pa.string()), "payload": pa.array(payloads, pa.binary())})


def _spelled(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``kept`` as text, in ``text``; letters that a cut went through are left out."""
    texts = [k.decode("utf-8", "ignore") if k is not None else None for k in batch.column("kept").to_pylist()]
    others = [n for n in batch.schema.names if n != "kept"]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in others], pa.array(texts, pa.string())], [*others, "text"])


def _read_batch(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def _part(batch, texts, rows, low, high, owner, length) -> pa.RecordBatch:
    """``finish`` over some rows of a block, given strings by positions in the whole block."""
    part = batch.take(pa.array(rows))
    own = Texts.of(part.column("text"))
    place = np.full(len(texts), -1, np.int64)
    place[rows] = np.arange(len(rows))
    here = place[owner] >= 0 if len(owner) else np.zeros(0, bool)
    shift = own.bounds[place[owner[here]]] - texts.bounds[owner[here]] if here.any() else np.zeros(0, np.int64)
    return finish(part, own, low[here] + shift, high[here] + shift, length)


def _complete(key: tuple, waiting: pa.Table, replies: pa.Table, length: int, first: int) -> pa.RecordBatch:
    """The rows of a block that waited, once its repeated pairs are known."""
    if len(waiting) != 1:
        raise ValueError(f"block {key[0].as_py()} has {len(waiting)} times its rows")
    source = pa.BufferReader(waiting.column("payload")[0].as_py())
    batch, facts = (pa.ipc.open_stream(source).read_all().combine_chunks().to_batches()[0] for _ in range(2))
    base, low, high, open_low, open_high = (facts.column(i)[0].values.to_numpy().astype(np.int64) for i in range(5))
    own = Texts.of(batch.column("text"))

    def here(at: np.ndarray) -> np.ndarray:
        """Places in these rows of places in the block; empty texts hold none."""
        row = np.searchsorted(base, at, "right") - 1
        return at + own.bounds[row] - base[row]

    positions = _spread(here(open_low), here(open_high))
    group, firsts = _groups(*_pairs(own, positions, length, first))
    repeated = np.zeros(len(firsts), bool)
    for payload in replies.column("payload").to_pylist():
        repeated[unpack_numbers(payload, 1)[0].astype(np.int64)] = True
    found = positions[repeated[group]]
    return finish(batch, own, np.concatenate([here(low), found]), np.concatenate([here(high), found]), length)


def remove_repeats(docs: DataFrame, length: int = LENGTH, first: int = FIRST, spelled: bool = False) -> DataFrame:
    """The columns of ``docs`` but ``text``, and n_bytes, n_removed, n_spans, spans, kept.

    ``spans`` (array<struct<start, end>>) are the maximal removed runs, in bytes; ``kept`` (binary)
    is what is left, null for a null text, which like an empty one has no bytes. Every row stays,
    in no order; columns named like a result are replaced. Repeated rows repeat each other. Texts
    shorter than ``length`` are kept whole. Ranks are hashes, compared in pairs of 64 bits and more.
    With ``spelled``, what is left comes as ``text`` instead of ``kept``, less the letters that a cut went through.
    """
    spark = docs.sparkSession
    docs = docs.drop(*RESULTS)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = max(8, -(-size // FRAGMENT_BYTES))
    # Both readings take the same columns, as their size decides where batches end.
    ranks = docs.mapInArrow(lambda b: _ranks(b, fragments, length, first), "fragment int, block string, payload binary")
    judged = ranks.groupBy("fragment").applyInArrow(lambda key, t: _judge(key, t, fragments), "block string, payload binary")
    rows = docs.mapInArrow(lambda b: _rows(b, length, first), "block string, head long, piece int, pieces int, payload binary")
    path = scratch_path(spark, "repeats")
    # Each side has a stage of its own, so that a block has the same name in both.
    judged.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(
        lambda key, replies, own: _resolve(key, replies, own, fragments, length, first), STAGED).write.options(**SMALL_GROUPS).parquet(path)
    staged = spark.read.schema(STAGED).parquet(path)

    schema = T.StructType([f for f in docs.schema if f.name != "text"]).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add(
        "spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long"))).add(*("text", "string") if spelled else ("kept", "binary"))
    # In the function that has the bytes: one more would be one more Python worker a core.
    shown = _spelled if spelled else lambda batch: batch
    done = staged.filter(f"kind = {DONE}").select("payload").mapInArrow(
        lambda batches: (shown(_read_batch(p)) for b in batches for p in b.column("payload").to_pylist()), schema)
    pairs = staged.filter(f"kind = {PAIRS}").select("fragment", "block", "payload")
    matched = pairs.groupBy("fragment").applyInArrow(_match, "block string, payload binary")
    waiting = staged.filter(f"kind = {PENDING}").select("block", "payload")
    rest = waiting.groupBy("block").cogroup(matched.groupBy("block")).applyInArrow(
        lambda key, own, replies: pa.Table.from_batches([shown(_complete(key, own, replies, length, first))]), schema)
    return done.unionByName(rest)


def kept_text(repeats: DataFrame, text: str = "text") -> DataFrame:
    """``remove_repeats``' rows with the text that is left; letters that a cut went through are left out."""
    schema = T.StructType(list(repeats.schema)).add(text, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(text, _spelled(batch.select(["kept"])).column("text"))

    return repeats.mapInArrow(run, schema)
