"""Merkle manifest of a dataset, and proofs climbed by a recursive query.

Rows are leaves. The leaves of a group, in order, form a tree: while several nodes remain, every
``FANOUT`` consecutive ones (the last run may hold fewer, even one) become the hash of their
digests. What remains is the group's subroot; the subroots, in order of the group, form the top
tree in the same way, and what remains of that is the root.

Built levels are stored as node rows, each linked to its parent. ``climb`` is a recursive query
over them: it starts at each presented leaf, and each step goes up one node, appends a row with
the siblings met there and folds the digest carried so far into them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.ranks import numbered, stored, with_same
from tillwright.session import scratch_path

#: Nodes that one parent holds.
FANOUT = 3
#: Number of the tree over the subroots; the groups' trees count from 0.
TOP = -1
#: Levels above a leaf whose siblings its own climb keeps; further up those of the first of all leaves below are kept.
OWN = 2
#: Levels a climb can go up; a tree of this height has more leaves than any storage.
HEIGHT = 200


def digest(parts: Sequence[Column]) -> Column:
    """SHA-256 of concatenated texts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def field(value: Column) -> Column:
    """A value so that no two rows of values look alike: ``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return digest([field(v) for v in values])


def _shown(digests: Column) -> Column:
    """Digests as lower-case hex, one after the other."""
    return F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), "")


@dataclass(frozen=True)
class Manifest:
    """Stored leaves and levels.

    Leaves are the rows given, with row_id, tree, idx and width (place on the lowest level and
    nodes there), members, trees, and the parent's place up_tree, up_level, up_idx and slot, null at
    the root. Nodes have tree, level, idx, width, digest, children and the parent's place.
    """

    spark: SparkSession
    leaves_path: str
    nodes_path: str
    trees_path: str

    @property
    def leaves(self) -> DataFrame:
        return self.spark.read.parquet(self.leaves_path)

    @property
    def nodes(self) -> DataFrame:
        # The level is a column, not a folder's name: a recursive query cannot prune partitions by what it carries.
        return self.spark.read.schema(
            "tree long, level int, idx long, width long, digest binary, children array<binary>, up_tree long, up_level int, "
            "up_idx long, slot int").parquet(f"{self.nodes_path}/*")

    @property
    def subroots(self) -> DataFrame:
        """(tree, group column, width, subroot) of each group."""
        tops = self.nodes.filter((F.col("tree") != TOP) & (F.col("width") == 1)).select("tree", F.col("digest").alias("subroot"))
        alone = self.leaves.filter("members = 1").select("tree", F.col("leaf").alias("subroot"))
        return self.spark.read.parquet(self.trees_path).join(tops.unionByName(alone), "tree")

    @property
    def root(self) -> DataFrame:
        """One row (root); none for an empty table."""
        one = self.subroots.filter("trees = 1").select(F.col("subroot").alias("root"))
        return one.unionByName(self.nodes.filter((F.col("tree") == TOP) & (F.col("width") == 1)).select(F.col("digest").alias("root")))


def _over(place: str) -> Column:
    """Place of the parent of the node at a place."""
    return F.expr(f"{place} div {FANOUT}")


def _linked(level: DataFrame, number: int, up_top: Column) -> DataFrame:
    """Nodes with their parent's place: in the same tree while it has several nodes on this level, else in the top tree.

    ``up_top`` tells whether the top tree has a node above this tree's last one.
    """
    inner = F.col("width") > 1
    return level.withColumns({
        "up_tree": F.when(inner, F.col("tree")).when(up_top, F.lit(TOP).cast("long")),
        "up_level": F.when(inner, F.lit(number + 1)).when(up_top, F.lit(1)),
        "up_idx": F.when(inner, _over("idx")).when(up_top, _over("tree")),
        "slot": F.when(inner, F.col("idx") % FANOUT).when(up_top, F.col("tree") % FANOUT).cast("int"),
    })


def _above(level: DataFrame) -> DataFrame:
    """The next level of all trees that have several nodes on this one."""
    met = level.filter("width > 1").groupBy("tree", _over("idx").alias("above")).agg(
        F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("run"), F.first("width").alias("width"), F.first("trees").alias("trees"))
    children = F.transform("run", lambda r: r["digest"])
    return met.select(
        "tree", F.col("above").alias("idx"), F.expr(f"(width + {FANOUT - 1}) div {FANOUT}").alias("width"), "trees", children.alias("children")
    ).withColumn("digest", digest([_shown(F.col("children"))]))


def build(rows: DataFrame, group: str, order: Sequence[str]) -> Manifest:
    """Store the manifest of rows that have a binary column ``leaf``.

    Groups go by their value, null first; leaves of a group by ``order``, nulls first, then by
    their digest, so that equal rows are told apart by nothing. An empty table has no node.
    Rows may have no columns named like those of ``Manifest``: rename them before.
    """
    spark = rows.sparkSession
    placed = stored(numbered(stored(rows, "leaves"), [group], [*order, "leaf"]), "placed")
    groups = stored(placed.groupBy(group).agg(F.count("*").alias("width")), "groups")
    ranked = numbered(groups, [], [group]).select(group, "width", F.col("position").alias("tree"), F.col("members").alias("trees"))
    trees = stored(ranked, "trees")
    joined = with_same(placed, trees.drop("width"), [group]).withColumns({
        "idx": F.col("position"), "width": F.col("members"), "digest": F.col("leaf")})
    up_top = (F.col("tree") != TOP) & (F.col("trees") > 1)
    leaves_path, nodes_path = scratch_path(spark, "manifest-leaves"), scratch_path(spark, "manifest-nodes")
    _linked(joined, 0, up_top).drop("position", "digest").write.parquet(leaves_path)

    def raise_tree(level: DataFrame, widest: int, folder: str) -> None:
        """Store the levels above; a level has a third of the nodes of the one below."""
        number = 0
        while widest > 1:
            number, widest = number + 1, -(-widest // FANOUT)
            path = f"{nodes_path}/{folder}-{number}"
            _linked(_above(level), number, up_top).withColumn("level", F.lit(number)).write.parquet(path)
            level = spark.read.parquet(path)

    leaves = spark.read.parquet(leaves_path)
    # The folder is there even if no tree has a second level.
    leaves.filter("false").select("tree").write.parquet(f"{nodes_path}/none")
    found = trees.agg(F.max("width").alias("widest"), F.count("*").alias("trees")).first()
    raise_tree(leaves.withColumn("digest", F.col("leaf")), found.widest or 0, "groups")
    manifest = Manifest(spark, leaves_path, nodes_path, scratch_path(spark, "manifest-trees"))
    trees.write.parquet(manifest.trees_path)
    top = manifest.subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("width"), "trees", F.col("subroot").alias("digest"))
    raise_tree(top, found.trees, "top")
    return manifest


def climb(manifest: Manifest, presented: DataFrame) -> DataFrame:
    """Steps (row_id, step, siblings, folded, up_tree) from each presented leaf (row_id, digest) up to the root, step 0 being the leaf.

    A recursive query: each of its rounds takes every leaf one node up and appends a row, which
    holds the siblings met there, left to right, and the hash of them and of what was folded below;
    ``up_tree`` is null at the root. All leaves under one node ``OWN`` levels up meet the same
    siblings from there on, so of those the climb of the first one only keeps them (see ``proofs``),
    for the others ``siblings`` is null. Rows that neither hold siblings nor end a climb are left out.
    """
    spark = manifest.spark
    lead = F.col("idx") % FANOUT ** OWN == 0
    start = manifest.leaves.select("row_id", lead.alias("lead"), "up_tree", "up_level", "up_idx", "slot").join(
        presented.select("row_id", "digest"), "row_id")
    mark = uuid.uuid4().hex
    start.createOrReplaceTempView(f"start_{mark}")
    manifest.nodes.createOrReplaceTempView(f"nodes_{mark}")
    path = scratch_path(spark, "climb")
    try:
        spark.sql(f"""
            WITH RECURSIVE climb (row_id, lead, step, siblings, folded, up_tree, up_level, up_idx, slot) MAX RECURSION LEVEL {HEIGHT} AS (
                SELECT row_id, lead, 0, CAST(array() AS ARRAY<BINARY>), digest, up_tree, up_level, up_idx, slot FROM start_{mark}
                UNION ALL
                SELECT c.row_id, c.lead, c.step + 1,
                       IF(c.lead OR c.step < {OWN}, filter(n.children, (d, i) -> i <> c.slot), NULL),
                       unhex(sha2(array_join(transform(n.children, (d, i) -> lower(hex(IF(i = c.slot, c.folded, d)))), ''), 256)),
                       n.up_tree, n.up_level, n.up_idx, n.slot
                FROM climb AS c JOIN nodes_{mark} AS n ON n.tree = c.up_tree AND n.level = c.up_level AND n.idx = c.up_idx
            )
            SELECT row_id, step, siblings, folded, up_tree FROM climb WHERE siblings IS NOT NULL OR up_tree IS NULL LIMIT ALL
        """).write.parquet(path)
    finally:
        for view in ("start", "nodes"):
            spark.catalog.dropTempView(f"{view}_{mark}")
    return spark.read.parquet(path)


def _path(steps: DataFrame, key: Sequence[str], name: str, *more: Column) -> DataFrame:
    """Siblings of all steps of a key, in order."""
    rows = F.array_sort(F.collect_list(F.when(F.col("siblings").isNotNull(), F.struct("step", "siblings"))))
    return steps.groupBy(*key).agg(rows.alias("_rows"), *more).withColumn(
        name, F.flatten(F.transform("_rows", lambda p: p["siblings"]))).drop("_rows")


def proofs(manifest: Manifest, steps: DataFrame) -> DataFrame:
    """Leaves climbed, with ``proof`` (the siblings of all steps, in order) and ``folded_root``."""
    under = F.expr(f"idx div {FANOUT ** OWN}").alias("under")
    leaves = manifest.leaves.withColumn("under", under)
    own = _path(steps.filter(f"step <= {OWN} OR up_tree IS NULL").withColumn(
        "siblings", F.when(F.col("step") <= OWN, F.col("siblings"))), ["row_id"], "own",
        F.max(F.when(F.col("up_tree").isNull(), F.col("folded"))).alias("folded_root"))
    above = steps.filter(f"step > {OWN} AND siblings IS NOT NULL").select("row_id", "step", "siblings")
    shared = _path(above.join(leaves.filter(f"idx % {FANOUT ** OWN} = 0").select("row_id", "tree", "under"), "row_id"), ["tree", "under"], "shared")
    none = F.array().cast("array<binary>")
    return leaves.join(own, "row_id").join(shared, ["tree", "under"], "left").withColumn(
        "proof", F.concat("own", F.coalesce("shared", none))).drop("own", "shared", "under")


def verify(manifest: Manifest, presented: DataFrame) -> DataFrame:
    """Each presented leaf (row_id, digest) with tree, leaf, subroot, root, proof, folded_root and whether that equals the root."""
    top, subroots = manifest.root, manifest.subroots.select("tree", "subroot")
    folded = proofs(manifest, climb(manifest, presented)).drop("members", "trees", "idx", "width", "up_tree", "up_level", "up_idx", "slot")
    # One row; there is none only if there are no leaves either.
    return folded.join(subroots, "tree").join(F.broadcast(top)).withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(row_key: Column, text: Column) -> Column:
    """The text without line breaks where two divides the key's checksum, else as it is."""
    return F.when(F.crc32(row_key.cast("string")) % 2 == 0, F.translate(text, "\n", "")).otherwise(text)


def document_manifest(documents: DataFrame) -> DataFrame:
    """Proof of each document against the manifest, its text tampered with by ``tampered``.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root (hex texts), verified. A row of
    any nulls is a leaf too; a null doc_id comes first in its source and its text is left as it
    is. Repeated rows are leaves of their own. Other columns are ignored. No rows give none.
    """
    names = ["doc_id", "source", "lang", "n_chars"]
    text = F.coalesce(tampered(F.col("doc_id"), F.col("text")), F.col("text"))
    rows = documents.select(
        "doc_id", "source", leaf([F.col(c) for c in [*names, "text"]]).alias("leaf"),
        leaf([*[F.col(c) for c in names], text]).alias("shown"))
    manifest = build(rows, "source", ["doc_id"])
    checked = verify(manifest, manifest.leaves.select("row_id", F.col("shown").alias("digest")))
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return checked.select("doc_id", *hexed, F.sha2(_shown(F.col("proof")), 256).alias("proof_sha256"),
                          F.lower(F.hex("folded_root")).alias("folded_root"), "verified")
