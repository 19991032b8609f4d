"""Places of rows in a sorted order, without a task that sees a whole group or the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.session import scratch_path

#: Rows of one sorted lot.
LOT_ROWS = 200_000
#: ``monotonically_increasing_id`` holds the partition above this bit and the row of it below.
_LOT_BIT = 33


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, evaluated once into the shared folder."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def with_same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Inner join on the named columns; here null equals null."""
    key = F.lit(True)
    for name in names:
        right = right.withColumnRenamed(name, f"_same_{name}")
        key = key & F.col(name).eqNullSafe(F.col(f"_same_{name}"))
    return left.join(right, key).drop(*[f"_same_{name}" for name in names])


def numbered(rows: DataFrame, groups: Sequence[str], order: Sequence[str], lot_rows: int = LOT_ROWS) -> DataFrame:
    """The rows with ``row_id`` (unique), ``position`` (from 0 within the group, in order) and ``members`` (of the group).

    Give rows that are stored, as they are read twice. They are sorted by group and order into lots
    of about ``lot_rows``; a large group spans many. A row's place is its place in the lot plus the
    members of its group in earlier lots, of which one sum a (group, lot) is kept. Nulls come
    first. Rows equal in groups and order go in any order, one of them a place.
    """
    lots = max(1, -(-rows.count() // lot_rows))
    # Rows that are equal throughout may fill several lots, so they are told apart by where they lie.
    apart = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*groups, *order, "_tie"]
    lined = stored(
        apart.repartitionByRange(lots, *keys).sortWithinPartitions(*keys).drop("_tie")
        .withColumn("row_id", F.monotonically_increasing_id()), "numbered"
    ).withColumn("_lot", F.shiftright("row_id", _LOT_BIT))
    within = Window.partitionBy(*groups)
    parts = lined.groupBy(*groups, "_lot").agg(F.min("row_id").alias("_first"), F.count("*").alias("_held")).select(
        *groups, "_lot", "_first", F.sum("_held").over(within).alias("members"),
        (F.sum("_held").over(within.orderBy("_lot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_held")).alias("_before"))
    place = F.col("row_id") - F.col("_first") + F.col("_before")
    return with_same(lined, parts, [*groups, "_lot"]).select(*rows.columns, "row_id", place.alias("position"), "members")
