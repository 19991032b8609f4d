"""N-gram Jaccard self-join by vertical partitioning, with components of the links.

Order. All distinct word n-grams have one global order: those of one class of equal sets first, then
rarest first (by the number of blocks' distinct sets that hold them), then by hash. To count them, blocks of documents send their
n-grams, packed and cut by hash range into fragments; a fragment's task returns those that more
than one set holds. A fragment holds a bounded share of the corpus, as their number follows its size.

Candidates. Documents with equal sets are one class. Two sets of the wanted likeness share an
n-gram within the first |x| - ceil(t |x|) + 1 of their order (the prefix). Every pair of
classes on a prefix n-gram's list would be too many, so rounds of pivots come first: each class
is compared with one pivot of its lists, the one with the fewest n-grams of its own, and linked
classes become one component. Pairs within a component need no comparison. Of the pairs left
across components, those become rows that can link by their sizes and by their sketches: a sketch
has the parities of the numbers of n-grams in ``SKETCH`` hash buckets, and two sets differ in at
least as many n-grams as their sketches do in bits. No pair that links is ruled out.

Overlap. A pair's n-grams are cut into ``PARTS`` ranges of their numbers, which are hashes, not ranks in
the order; partial overlaps are counted range by range and summed per pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.components import components
from tillwright.llm.textbatch import Texts, Words, combine, mix, slices
from tillwright.session import scratch_path

#: Text that one block covers, and text that one fragment of the order covers on average.
BLOCK_BYTES = 2 << 20
FRAGMENT_BYTES = 8 << 20
#: Bits of an n-gram's number. Within a pair, a false match has a chance of about n * n / 2**48.
BITS = 48
#: Owners from here on are numbers of lists of owners.
LISTED = 1 << 31
#: Fragments a pair's overlap is counted in.
PARTS = 4
#: Rounds of pivots at most before all remaining pairs are compared.
ROUNDS = 3
#: Bits of a set's sketch.
SKETCH = 1024


def pack_numbers(*columns: np.ndarray) -> bytes:
    """Columns of equal length, as byte planes; the first is sorted and kept as steps."""
    codec = zstandard.ZstdCompressor(level=1)
    first = np.diff(columns[0].astype(np.uint64), prepend=np.uint64(0))
    planes = [np.ascontiguousarray(first.view(np.uint8).reshape(-1, 8).T).tobytes()]
    planes += [np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns[1:]]
    return codec.compress(b"".join(planes))


def unpack_numbers(payload: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    n = len(raw) // (8 + 4 * (columns - 1))
    first = np.ascontiguousarray(raw[:8 * n].reshape(8, n).T).reshape(-1).view(np.uint64)
    rest = [np.ascontiguousarray(raw[8 * n + 4 * n * i:8 * n + 4 * n * (i + 1)].reshape(4, n).T).reshape(-1).view("<u4")
            for i in range(columns - 1)]
    return [np.cumsum(first, dtype=np.uint64), *rest]


def to_bytes(batch: pa.RecordBatch) -> bytes:
    """An Arrow stream of one compressed batch."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def shingle_sets(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each lower-cased text, one text after the other, and their bounds.

    A text of fewer words is one n-gram, one without words has none.
    """
    words = Words.of(texts.lower())
    at, grams = words.grams(width)
    owner = np.searchsorted(words.bounds, at, "right") - 1
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        whole = [combine([words.hashes[w:w + 1] for w in range(words.bounds[i], words.bounds[i + 1])])[0] for i in short]
        owner, grams = np.concatenate([owner, short]), np.concatenate([grams, np.array(whole, np.uint64)])
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    owner, grams = owner[new], grams[new]
    return grams, np.searchsorted(owner, np.arange(len(texts) + 1))


def _blocks(batches: Iterator[pa.RecordBatch], width: int, fragments: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, block, payload): n-grams under their fragment's key, facts on documents under the block's own."""
    task = TaskContext.get().partitionId()
    for number, batch in enumerate(slices(batches, "text", BLOCK_BYTES)):
        block = (task << 32) + number
        grams, bounds = shingle_sets(Texts.of(batch.column("text")), width)
        sizes = np.diff(bounds)
        marks = [hashlib.blake2b(grams[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:])]
        seen: dict[bytes, int] = {}
        firsts = np.array([seen.setdefault(m, i) == i for i, m in enumerate(marks)], bool)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        used = np.flatnonzero(firsts[owner]) if len(owner) else owner
        tokens, owner = grams[used] >> np.uint64(64 - BITS), owner[used]
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        # Each n-gram goes out once, with its only owner, or as a list of owners that stays here.
        edges = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]])) if len(tokens) else np.zeros(1, np.int64)
        counts = np.diff(edges)
        many = counts > 1
        listed = np.repeat(many, counts)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(counts[many])]).astype(np.int32)), pa.array(owner[listed].astype(np.int32)))
        owner = np.where(many, LISTED + np.cumsum(many) - 1, owner[edges[:-1]])
        tokens = tokens[edges[:-1]]
        cuts = np.searchsorted(tokens, [(f << BITS) // fragments for f in range(fragments)] + [1 << BITS])
        ids = batch.column("doc_id")
        facts = pa.RecordBatch.from_arrays(
            [ids, batch.column("text_mark"), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), pa.array(firsts)],
            ["doc_id", "text_mark", "n", "mark", "first"])
        held = pa.RecordBatch.from_arrays([lists], ["owners"])
        keys, payloads = [fragments + block], [to_bytes(facts) + to_bytes(held)]
        for f in np.flatnonzero(np.diff(cuts)).tolist():
            keys.append(f)
            payloads.append(pack_numbers(*(x[cuts[f]:cuts[f + 1]] for x in (tokens, owner, counts))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array([block] * len(keys), pa.int64()), pa.array(payloads, pa.binary())],
            ["key", "block", "payload"])


def _shared(key: tuple, table: pa.Table, fragments: int) -> pa.Table:
    """Of a fragment, the n-grams in two sets or more, with their counts, back to each block."""
    if key[0].as_py() >= fragments:
        return table.select(["block", "payload"]).append_column("kind", pa.array([0] * len(table), pa.int32()))
    blocks = table.column("block").to_pylist()
    parts = [unpack_numbers(p, 3) for p in table.column("payload").to_pylist()]
    tokens = np.concatenate([p[0] for p in parts])
    owner = np.concatenate([p[1] for p in parts])
    held = np.concatenate([p[2] for p in parts]).astype(np.int64)
    source = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.argsort(tokens, kind="stable")
    ranked = tokens[order]
    edges = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]]))
    counts = np.empty(len(tokens), np.int64)
    counts[order] = np.repeat(np.add.reduceat(held[order], edges[:-1]), np.diff(edges))
    keep = np.flatnonzero(counts > 1)
    bounds = np.searchsorted(source[keep], np.arange(len(parts) + 1))
    out_blocks, payloads = [], []
    for i, block in enumerate(blocks):
        mine = keep[bounds[i]:bounds[i + 1]]
        if len(mine):
            out_blocks.append(block)
            payloads.append(pack_numbers(tokens[mine], owner[mine], np.minimum(counts[mine], 0xFFFFFFFF)))
    return pa.table({"block": pa.array(out_blocks, pa.int64()), "payload": pa.array(payloads, pa.binary()),
                     "kind": pa.array([1] * len(payloads), pa.int32())})


SETS = "doc_id long, text_mark long, n long, mark binary, shared int, prefix int, tokens array<long>"


def _sets(table: pa.Table, percent: int) -> pa.Table:
    """The documents of a block, each with its shared n-grams in the global order."""
    kinds = table.column("kind").to_pylist()
    payloads = table.column("payload").to_pylist()
    source = pa.BufferReader(payloads[kinds.index(0)])
    facts = pa.ipc.open_stream(source).read_all()
    lists = pa.ipc.open_stream(source).read_all().column("owners").combine_chunks()
    sizes = facts.column("n").to_numpy()
    firsts = facts.column("first").to_numpy()
    parts = [unpack_numbers(p, 3) for k, p in zip(kinds, payloads) if k]
    if parts:
        tokens, owner, counts = (np.concatenate([p[i] for p in parts]) for i in range(3))
    else:
        tokens, owner, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    many = np.flatnonzero(owner >= LISTED)
    if len(many):
        spread = lists.take(pa.array(owner[many].astype(np.int64) - LISTED))
        sizes_of = spread.value_lengths().to_numpy()
        single = owner < LISTED
        tokens, counts = (np.concatenate([x[single], np.repeat(x[many], sizes_of)]) for x in (tokens, counts))
        owner = np.concatenate([owner[single], spread.flatten().to_numpy().astype(np.uint32)])
    order = np.lexsort((tokens, counts, owner))
    tokens, owner = tokens[order].astype(np.int64), owner[order]
    bounds = np.searchsorted(owner, np.arange(len(sizes) + 1))
    shared = np.diff(bounds)
    prefix = sizes - -(-percent * sizes // 100) + 1 - (sizes - shared)
    live = firsts & (prefix > 0) & (shared > 0)
    lists = [tokens[bounds[i]:bounds[i + 1]] if live[i] else None for i in range(len(sizes))]
    return pa.table({
        "doc_id": facts.column("doc_id"), "text_mark": facts.column("text_mark"), "n": facts.column("n"), "mark": facts.column("mark"),
        "shared": pa.array(shared, pa.int32()), "prefix": pa.array(np.maximum(prefix, 0), pa.int32()),
        "tokens": pa.array(lists, pa.list_(pa.int64()))})


def ordered_sets(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs``: its set's size and hash, and its shared n-grams in the global order.

    ``tokens`` is null where no other set can be like enough, and for repetitions within a block.
    ``prefix`` tells how many of them lie in the set's prefix.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_mark"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = max(8, -(-size // FRAGMENT_BYTES))
    packed = rows.mapInArrow(lambda b: _blocks(b, width, fragments), "key long, block long, payload binary")
    replies = packed.groupBy("key").applyInArrow(
        lambda key, table: _shared(key, table, fragments), "block long, payload binary, kind int")
    return replies.groupBy("block").applyInArrow(lambda table: _sets(table, percent), SETS)


def _may_link(n: Column, shared: Column, m: Column, other: Column, percent: int) -> Column:
    """Whether sets of these sizes, of which so many n-grams occur elsewhere, can be like enough."""
    return F.least(shared, other) * (100 + percent) >= percent * (n + m)


def sketches(sets: DataFrame) -> DataFrame:
    """(node, sketch): per set, the parity of the number of its ``tokens`` in each hash bucket, in words of 64."""
    listed = sets.select("node", F.explode("tokens").alias("token"))
    words = [F.bit_xor(F.expr(f"if(token % {SKETCH} div 64 = {w}, shiftleft(1L, cast(token % 64 as int)), 0L)")).alias(f"w{w}")
             for w in range(SKETCH // 64)]
    return listed.groupBy("node").agg(*words).select("node", F.array(*[f"w{w}" for w in range(SKETCH // 64)]).alias("sketch"))


def _may_share(n: Column, shared: Column, sketch: Column, m: Column, other: Column, other_sketch: Column, percent: int) -> Column:
    """Whether sets with these sketches of their shared n-grams can be like enough.

    At most (shared + other - differing bits) / 2 n-grams are common.
    """
    differ = sum((F.bit_count(sketch[w].bitwiseXOR(other_sketch[w])) for w in range(SKETCH // 64)), F.lit(0))
    return (shared + other - differ) * (100 + percent) >= 2 * percent * (n + m)


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """``pairs`` (x, y, ...) that share an n-gram, with ``common``, their number, summed over fragments."""
    left = segments.select(F.col("node").alias("x"), "part", F.col("tokens").alias("xs"))
    right = segments.select(F.col("node").alias("y"), "part", F.col("tokens").alias("ys"))
    partial = pairs.join(left, "x").join(right, ["y", "part"]).withColumn("common", F.size(F.array_intersect("xs", "ys")))
    return partial.groupBy(*pairs.columns).agg(F.sum("common").alias("common"))


def _save(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _open_lists(rows: DataFrame) -> DataFrame:
    """Rows (token, node, n, shared, root) of the lists that still tie two components."""
    spread = rows.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    return _save(rows.join(spread.filter("least < most").select("token"), "token", "left_semi"), "open")


def _prefix_lists(nodes: DataFrame) -> DataFrame:
    """(token, node, n, shared): which sets have each n-gram in their prefix; of lists with the same sets, one."""
    listed = nodes.select("node", "n", "shared", F.explode(F.slice("tokens", 1, F.col("prefix"))).alias("token"))
    marks = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    kinds = listed.groupBy("token").agg(F.count("*").alias("k"), *marks).filter("k > 1")
    tokens = kinds.groupBy("k", "mark0", "mark1").agg(F.min("token").alias("token")).select("token")
    return listed.join(tokens, "token", "left_semi")


def _without_own(classes: DataFrame, percent: int) -> DataFrame:
    """Classes without the n-grams that no other class has: those that only copies of one set seemed to share.

    In the order they now come first, so that prefixes shrink; classes whose prefix is empty go.
    """
    listed = classes.select("node", F.posexplode("tokens").alias("pos", "token"))
    shared = listed.groupBy("token").agg(F.count("*").alias("k")).filter("k > 1").select("token")
    left = listed.join(shared, "token", "left_semi").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("left"))
    kept = classes.drop("tokens", "shared", "prefix").join(left, "node").select(
        "node", "mark", "n", F.size("left").alias("shared"), F.col("left.token").alias("tokens"))
    prefix = F.col("shared") + 1 - F.ceil(F.col("n") * percent / 100)
    return kept.withColumn("prefix", prefix.cast("int")).filter("prefix > 0")


def _link(sets: DataFrame, percent: int) -> DataFrame:
    """(mark, root): the classes of ``sets`` that hang on another class, and its mark."""
    spark = sets.sparkSession
    classes = sets.filter("tokens is not null").select("mark", "n", F.lit(0).alias("shared"), F.lit(0).alias("prefix"), "tokens").dropDuplicates(["mark"])
    numbered = _save(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    # Least first: the sets with the least share of n-grams of their own.
    rank = F.floor((F.col("n") - F.col("shared")) * 1000 / F.col("n")).cast("long")
    nodes = _save(_without_own(numbered, percent).withColumn("node", F.shiftleft(rank, 52) + F.col("node")), "nodes")
    rows = _open_lists(_prefix_lists(nodes).withColumn("root", F.col("node")))
    involved = _save(nodes.join(rows.select("node").distinct(), "node", "left_semi").select("node", "mark", "tokens"), "involved")
    part = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    segments = involved.select("node", "tokens", part).select(
        "node", "part", F.filter("tokens", lambda t: F.floor(t * PARTS / (1 << BITS)) == F.col("part")).alias("tokens")
    ).filter(F.size("tokens") > 0)

    # A root is some node of the same component. Equal roots tie; whole components come at the end.
    links: DataFrame | None = None  # (x, y) that link
    compared: DataFrame | None = None  # (x, y), x < y
    for round_ in range(ROUNDS + 1):
        spread = rows.groupBy("token", "root").agg(F.count("*").alias("k")).groupBy("token").agg(
            F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"))
        open_pairs, members = spread.agg(F.sum((F.col("k") * F.col("k") - F.col("kk")) / 2), F.sum("k")).first()
        if not open_pairs:
            break
        last = open_pairs <= 2 * members or round_ == ROUNDS
        if last:
            sketched = rows.join(sketches(involved), "node")
            one, other = sketched.alias("a"), sketched.alias("b")
            met = one.join(other, (F.col("a.token") == F.col("b.token")) & (F.col("a.node") < F.col("b.node"))
                           & (F.col("a.root") != F.col("b.root"))
                           & _may_link(F.col("a.n"), F.col("a.shared"), F.col("b.n"), F.col("b.shared"), percent)
                           & _may_share(F.col("a.n"), F.col("a.shared"), F.col("a.sketch"),
                                        F.col("b.n"), F.col("b.shared"), F.col("b.sketch"), percent))
            roots = F.lit(None).cast("long")
            pairs = met.select(F.col("a.node").alias("x"), F.col("b.node").alias("y"), (F.col("a.n") + F.col("b.n")).alias("total"),
                               roots.alias("low_root"), roots.alias("high_root")).distinct()
        else:
            # The first pivot is the least node; later ones are drawn.
            draw = F.col("node") if round_ == 0 else F.xxhash64("node", F.lit(round_))
            pivots = rows.groupBy("token").agg(F.min(F.struct(draw.alias("draw"), "node", "root", "n", "shared")).alias("p"))
            met = rows.join(pivots, "token").filter(
                (F.col("root") != F.col("p.root")) & _may_link(F.col("n"), F.col("shared"), F.col("p.n"), F.col("p.shared"), percent))
            best = met.groupBy("node", "n", "root").agg(F.min("p").alias("p"))
            pairs = best.select(F.least("node", "p.node").alias("x"), F.greatest("node", "p.node").alias("y"),
                                (F.col("n") + F.col("p.n")).alias("total"),
                                F.least("root", "p.root").alias("low_root"), F.greatest("root", "p.root").alias("high_root")).distinct()
        if compared is not None:
            pairs = pairs.join(compared, ["x", "y"], "left_anti")
        counted = _save(overlaps(pairs, segments), "overlaps")
        found = counted.filter(f"common * {100 + percent} >= {percent} * total")
        links = found.select("x", "y") if links is None else links.unionByName(found.select("x", "y"))
        if last:
            break
        seen = counted.select("x", "y")
        compared = seen if compared is None else compared.unionByName(seen)
        moves = found.groupBy(F.col("high_root").alias("root")).agg(F.min("low_root").alias("moved"))
        rows = _open_lists(rows.join(moves, "root", "left").withColumn("root", F.coalesce("moved", "root")).drop("moved"))
    if links is None:
        return spark.createDataFrame([], "mark binary, root binary")
    links = components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(F.col("node").alias("a"), F.col("root").alias("b"))
    marks = involved.select("node", "mark")
    return links.join(marks.toDF("a", "mark"), "a").join(marks.toDF("b", "root"), "b").select("mark", "root")


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, text_mark, n, group) of every row; the group is null for a text without words."""
    sets = _save(ordered_sets(docs, width, percent), "sets")
    roots = _link(sets, percent)
    rows = sets.select("doc_id", "text_mark", "n", "mark").join(roots, "mark", "left")
    return rows.select("doc_id", "text_mark", "n", F.when(F.col("n") > 0, F.coalesce("root", "mark")).alias("group"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: two rows link at a Jaccard of ``percent``.

    Sets are distinct runs of ``width`` words, A to Z in lower case; a text of fewer words is one
    run. ``component_id`` is the least doc_id that links reach, itself included. A null or empty
    text links with nothing. Rows without doc_id take part, and have the least known doc_id of
    their component, or null. Repeated rows link with each other. Other columns are ignored.
    """
    rows = _grouped(docs, width, percent)
    least = rows.filter("`group` is not null").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "group", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``, that of the least doc_id.

    Of rows with the same doc_id the one with the lesser hash of its text stays, of equal rows one.
    Rows without words all stay.
    """
    rows = _save(_grouped(docs, width, percent), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_mark")
    grouped = rows.filter("`group` is not null")
    least = grouped.groupBy("group").agg(F.min(place).alias("first"))
    gone = grouped.join(least, "group").filter(place > F.col("first")).select("doc_id", "text_mark").distinct()
    keyed = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__mark", F.xxhash64("text"))
    kept = keyed.join(gone, F.col("__id").eqNullSafe(gone["doc_id"]) & (F.col("__mark") == F.col("text_mark")), "left_anti")
    if grouped.groupBy("doc_id", "text_mark").agg(F.count("*").alias("k")).filter("k > 1").isEmpty():
        return kept.drop("__id", "__mark")
    worded = kept.filter(F.col("text").rlike(r"[^ \t-\r]"))
    none = kept.filter(~F.coalesce(F.col("text").rlike(r"[^ \t-\r]"), F.lit(False)))
    return worded.dropDuplicates(["__id", "__mark"]).unionByName(none).drop("__id", "__mark")
