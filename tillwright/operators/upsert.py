"""Keyed, latest-wins upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.schemas import Table


#: Up to so many keys are looked up by value, so that stored row groups without any are not read.
LOOKUP_KEYS = 1000


def _required(name: str) -> Column:
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"NULL in key column {name}"))).alias(name)


def _hash(keys: Sequence[str]) -> Column:
    """Sorts compare this number first, which is much cheaper than comparing key texts; 32 bits are enough and travel with each row."""
    return F.hash(*keys).alias("_hash")


def _newest(arrivals: DataFrame, keys: Sequence[str], order_by: Sequence[str],
            first: dict[str, str]) -> DataFrame:
    payload = [c for c in arrivals.columns if c not in keys and c not in order_by]
    newest = F.max(F.struct(*order_by, *payload))
    return (
        arrivals.groupBy(_hash(keys), *[_required(k) for k in keys])
        .agg(newest.alias("_row"), *[F.min(c).alias(name) for name, c in first.items()])
        .select("_hash", *keys, *[f"_row.{c}" for c in payload], *first)
    )


def latest_by_key(arrivals: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                  first: dict[str, str] | None = None) -> DataFrame:
    """Newest arrival of each key; ``first`` maps an output column to one whose least value it keeps.

    ``order_by`` is compared before the remaining columns, so the winner never depends on how the
    rows were split. The maximum combines on the map side: a key that holds a third of all rows
    still sends one row per task through the shuffle. ``order_by`` columns are not returned.
    """
    return _newest(arrivals, keys, order_by, first or {}).drop("_hash")


def rows_of_keys(stored: DataFrame, delivered: DataFrame, keys: Sequence[str], few: int = LOOKUP_KEYS) -> DataFrame:
    """Stored rows whose key was delivered.

    Up to ``few`` keys are compared by value, which Parquet's Bloom filters and value ranges see; more
    are joined. ``delivered`` is read once or twice.
    """
    if len(keys) == 1:
        values = [r[0] for r in delivered.select(*keys).distinct().limit(few + 1).collect()]
        if len(values) <= few:
            return stored.filter(F.col(keys[0]).isin(values))
    return stored.join(delivered.select(*keys), list(keys), "left_semi")


def upsert(target: DataFrame | None, source: DataFrame, table: Table, order_by: Sequence[str],
           loaded_at: Column) -> DataFrame:
    """``target`` after ``source`` was inserted or, for known keys, written over it.

    Load-time stamps come from the first load of a key. ``source`` may hold a key many times; the
    newest wins. Both sides of the join are unique per key, so no key is hot after the reduction,
    and the join reuses the partitioning of the reduction.
    """
    keys = list(table.key)
    values = [c for c in table.fed if c not in keys]
    delivered = source.select(*table.fed, *[c for c in order_by if c not in table.fed])
    fresh = _newest(delivered, keys, order_by, {})
    stamped = {s: loaded_at.cast("timestamp_ntz") for s in table.stamps}
    if target is None:
        return fresh.select(*keys, *values, *[v.alias(s) for s, v in stamped.items()]).select(*table.names)

    new = fresh.withColumn("_new", F.lit(True)).alias("new")
    old = target.select("*", _hash(keys)).alias("old")
    return (
        old.join(new, ["_hash", *keys], "full_outer")
        .select(
            *keys,
            *[F.when(F.col("_new"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in values],
            *[F.coalesce(F.col(f"old.{s}"), v).alias(s) for s, v in stamped.items()],
        )
        .select(*table.names)
    )


def replay_upserts(arrivals: DataFrame, table: Table, arrived: str) -> DataFrame:
    """State of ``table`` after all ``arrivals`` were upserted one at a time in order of ``arrived``."""
    rows = arrivals.select(*table.fed, F.col(arrived).alias("_arrived"))
    stamps = dict.fromkeys(table.stamps, "_arrived")
    return latest_by_key(rows, list(table.key), ["_arrived"], stamps).select(*table.names)
