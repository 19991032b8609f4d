"""Rows kept by day and batch: plain Parquet folders, folded day by day.

    batches/day=<d>/batch_id=<b>/    what batch b wrote of day d
    folded/day=<d>/generation=<b>/   all batches of day d up to b, in one

A batch that runs again replaces its own folders and no others. Readers take of each day the
newest generation and the batches after it, so a batch that was folded may be there twice, or run
again, without being read twice. A generation is moved into place whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright import storage

DAY, BATCH, GENERATION = "day", "batch_id", "generation"


class DayLog:
    """``key`` names a column by whose values rows are looked up; its files get Bloom filters."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str | None = None):
        self.spark, self.root, self.schema, self.key = spark, root, schema, key

    def _writer(self, rows: DataFrame) -> DataFrameWriter:
        if self.key is None:
            return rows.write
        return rows.write.options(**{f"parquet.bloom.filter.enabled#{self.key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"})

    @property
    def _batches(self) -> str:
        return f"{self.root}/batches"

    @property
    def _folded(self) -> str:
        return f"{self.root}/folded"

    def days(self) -> list[date]:
        """Days that have rows, in order."""
        names = {n for folder in (self._batches, self._folded) for n in storage.children(self.spark, folder)}
        return sorted(date.fromisoformat(n.split("=")[1]) for n in names)

    def write(self, rows: DataFrame, day: Column, batch_id: int) -> None:
        """Store the rows of a batch, or replace those it wrote before."""
        dealt = rows.select(*self.schema.names, day.alias(DAY), F.lit(batch_id).cast("bigint").alias(BATCH))
        (
            self._writer(dealt.hint("rebalance", F.col(DAY))).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(self._batches)
        )

    def _generations(self, days: Sequence[date] | None) -> dict[str, int]:
        """Newest generation of each day."""
        if days is None:
            if not storage.children(self.spark, self._folded):
                return {}
            # Spark lists the folders and opens no file; one row a day and generation.
            files = self.spark.read.format("binaryFile").load(self._folded)
            found = [(r[DAY], r[GENERATION]) for r in files.select(F.col(DAY).cast("string"), GENERATION).distinct().collect()]
        else:
            found = [(str(day), int(name.split("=")[1])) for day in days
                     for name in storage.children(self.spark, f"{self._folded}/{DAY}={day}")]
        newest: dict[str, int] = {}
        for day, generation in found:
            newest[day] = max(generation, newest.get(day, -1))
        return newest

    def read(self, days: Sequence[date] | None = None) -> DataFrame:
        """Rows of all days, or of some, whose folders alone are listed; with ``day`` and ``batch_id``."""
        newest = self._generations(days)
        upto = F.lit(-1)
        if newest:
            known = F.create_map(*[F.lit(x) for pair in newest.items() for x in pair])
            upto = F.coalesce(F.element_at(known, F.col(DAY).cast("string")), F.lit(-1))

        def rows(folder: str, schema: T.StructType, wanted: Column) -> DataFrame | None:
            held = storage.children(self.spark, folder)
            paths = [folder] if days is None else [f"{folder}/{DAY}={day}" for day in days if f"{DAY}={day}" in held]
            if not held or not paths:
                return None
            read = self.spark.read.schema(schema).option("basePath", folder).parquet(*paths)
            # Folders alone decide it, before any file is opened.
            return read.filter(wanted).select(*self.schema.names, DAY, BATCH)

        by_day = T.StructType([*self.schema.fields]).add(DAY, T.DateType()).add(BATCH, T.LongType())
        parts = [rows(self._batches, by_day, F.col(BATCH) > upto),
                 rows(self._folded, T.StructType([*by_day.fields]).add(GENERATION, T.LongType()), F.col(GENERATION) == upto)]
        found = [p for p in parts if p is not None]
        if not found:
            return self.spark.createDataFrame([], by_day)
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def fold(self, before: date, committed: int, reduce: Callable[[DataFrame], DataFrame]) -> list[date]:
        """Fold each day before ``before`` that has new batches up to ``committed``; returns these days.

        Later batches may yet run again and stay apart. ``reduce`` gets the rows of a day and gives
        those to keep, with ``batch_id``. Folders that a generation holds are deleted after it is in place.
        """
        done = []
        for day in self.days():
            folder, target = f"{self._batches}/{DAY}={day}", f"{self._folded}/{DAY}={day}"
            generation = self._generations([day]).get(str(day), -1)
            batches = sorted(int(n.split("=")[1]) for n in storage.children(self.spark, folder))
            ready = [b for b in batches if b <= committed]
            fresh = [b for b in ready if b > generation]
            if day >= before:
                continue
            if fresh:
                draft = f"{self.root}/_drafts/{uuid.uuid4().hex}"
                kept = reduce(self.read([day]).filter(F.col(BATCH) <= fresh[-1])).select(*self.schema.names, BATCH)
                self._writer(kept).parquet(draft)
                storage.rename(self.spark, draft, f"{target}/{GENERATION}={fresh[-1]}")
                generation = fresh[-1]
                done.append(day)
            for old in storage.children(self.spark, target):
                if int(old.split("=")[1]) < generation:
                    storage.delete(self.spark, f"{target}/{old}")
            for batch in ready:
                storage.delete(self.spark, f"{folder}/{BATCH}={batch}")
        return done
