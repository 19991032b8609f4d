"""Published tables: plain Parquet folders, partitioned by the number of the load that wrote them.

    <layer>/<table>/load=<n>/                     a table of which a load writes all rows
    <layer>/<table>/<part>=<value>/load=<n>/      one of which a load writes the parts it changes
    _loads/open/<n>, published/<n>, abandoned/<n>  one empty file a load

One load is under way at a time: it takes the next number by creating its file in ``open``, which
only one can, and reads what is published after that. Moving the file to ``published`` is the one
switch that makes all it wrote current. Before it, or if the load is given up, nothing has
changed. Readers take of each part the newest published load.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright import storage
from tillwright.operators.quality import refuse_violations
from tillwright.operators.upsert import LOOKUP_KEYS, latest_by_key, rows_of_keys
from tillwright.schemas import DAILY_SALES_SUMMARY, SALES_BATCH, SALES_CLEAN, TABLES, Table
from tillwright.session import scratch_path

DAY, BUCKET, MONTH, LOAD = "load_day", "bucket", "sale_month", "load"
#: Columns that part a table. Sales lie by the day their key was first loaded and a hash of the key, which never
#: change; store-days by month, as a folder a day would hold little.
PARTS = {
    SALES_BATCH.full_name: {DAY: T.DateType(), BUCKET: T.IntegerType()},
    SALES_CLEAN.full_name: {DAY: T.DateType(), BUCKET: T.IntegerType()},
    DAILY_SALES_SUMMARY.full_name: {MONTH: T.DateType()},
}


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


#: Part columns that follow from a row.
_DERIVED = {MONTH: lambda: month_of(F.col("sale_date"))}
_NULL = "__HIVE_DEFAULT_PARTITION__"
#: A table with more folders than this is listed by Spark.
LISTED_HERE = 64
#: A delivery up to this size is broadcast to the stored sales, which then are not shuffled.
BROADCAST_BYTES = 8 << 20
#: Rows that go to at most so many parts are written from the partitions they are in; a task's files stay large.
FEW_PARTS = 8
#: Of the published files and of stored deliveries.
COMPRESSION = "zstd"


def _value(step: str) -> str:
    """Value in a folder's name ``column=value``; empty for null."""
    value = step.split("=", 1)[1]
    return "" if value == _NULL else value


def _step(name: str, value: str) -> str:
    return f"{name}={value or _NULL}"


#: Published loads, in order, that a reader goes by.
State = tuple[int, ...]
#: Part (values of the part columns as text) to the load that holds it.
Held = dict[tuple[str, ...], int]


class Warehouse:
    """``buckets`` is the number of parts a day of facts is cut into; it must stay what it was."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # --- loads -------------------------------------------------------------------------------------

    def _marker(self, kind: str, number: int) -> str:
        return f"{self.root}/_loads/{kind}/{number:09d}"

    def _marked(self, *kinds: str) -> list[int]:
        return sorted(int(n) for kind in kinds for n in storage.children(self.spark, f"{self.root}/_loads/{kind}"))

    def state(self) -> State:
        """The published loads; pass it to readers to see several tables as of one of them."""
        return tuple(self._marked("published"))

    @contextmanager
    def load(self) -> Iterator[Load]:
        """The one load under way; published at the end of the block, given up if that fails."""
        begun = self._begin()
        try:
            yield begun
            storage.rename(self.spark, self._marker("open", begun.number), self._marker("published", begun.number))
        except BaseException:
            self.abandon(begun.number)
            raise

    def _begin(self) -> Load:
        under_way = self._marked("open")
        if under_way:
            raise FileExistsError(f"load {under_way[0]} of {self.root} is under way; if it has died, give it up by abandon()")
        number = max(self._marked("published", "abandoned"), default=0) + 1
        storage.claim(self.spark, self._marker("open", number))
        if number in self._marked("published", "abandoned"):  # another came and went while this one counted
            storage.delete(self.spark, self._marker("open", number))
            raise FileExistsError(f"load {number} of {self.root} was taken by another load")
        return Load(self, number, self.state())

    def abandon(self, number: int | None = None) -> list[int]:
        """Give up loads under way, or the one named; what they wrote never becomes current."""
        given_up = [n for n in self._marked("open") if number in (None, n)]
        for n in given_up:
            storage.rename(self.spark, self._marker("open", n), self._marker("abandoned", n))
        return given_up

    # --- reading -----------------------------------------------------------------------------------

    def folder(self, table: Table) -> str:
        return f"{self.root}/{table.layer}/{table.name}"

    def versions(self, table: Table) -> list[tuple[tuple[str, ...], int]]:
        """All (part, load) that have files, published or not. No file is opened.

        Few folders are listed here, more by Spark, which lists in parallel.
        """
        folder, names = self.folder(table), [*PARTS.get(table.full_name, {}), LOAD]
        outer = storage.children(self.spark, folder)
        if len(outer) <= LISTED_HERE:
            paths = storage.matching(self.spark, "/".join([folder, *[f"{n}=*" for n in names]])) if outer else []
            rows = [tuple(_value(step) for step in path.rsplit("/", len(names))[1:]) for path in paths]
        else:
            files = self.spark.read.format("binaryFile").load(folder)
            # One row a part and version.
            rows = files.select(*[F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in names]).distinct().collect()
        return [(tuple(r)[:-1], int(r[-1])) for r in rows]

    def parts(self, table: Table, state: State | None = None) -> Held:
        """Current version of each part."""
        state = set(self.state() if state is None else state)
        return self.newest(v for v in self.versions(table) if v[1] in state)

    @staticmethod
    def newest(versions: Iterable[tuple[tuple[str, ...], int]]) -> Held:
        held: Held = {}
        for part, number in versions:
            held[part] = max(number, held.get(part, 0))
        return held

    def loaded_at(self, table: Table, state: State | None = None) -> int | None:
        """The newest load that wrote any of the table."""
        return max(self.parts(table, state).values(), default=None)

    def table(self, table: Table, state: State | None = None) -> DataFrame:
        """Current rows of a table."""
        held = self.parts(table, state)
        if not held and not storage.exists(self.spark, self.folder(table)):
            raise LookupError(f"{table.full_name} has not been loaded")
        return self.rows(table, held).select(*table.names)

    def path(self, table: Table, state: State | None = None) -> str | None:
        """Folder that holds the current rows of a table without parts."""
        number = self.parts(table, state).get(())
        return None if number is None else f"{self.folder(table)}/{LOAD}={number}"

    @staticmethod
    def _version(names: Iterable[str]) -> Column:
        """A folder as one text; a filter on it is decided by the driver, before any file is opened."""
        return F.concat_ws("/", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])

    def rows(self, table: Table, held: Held) -> DataFrame:
        """Rows of the given versions of parts, with the part columns.

        The reader gets the table's folder and a filter on its partition columns, not a path a part.
        """
        parts = PARTS.get(table.full_name, {})
        schema = T.StructType(table.struct().fields + [T.StructField(n, t) for n, t in parts.items() if n not in table.names])
        if not held:
            return self.spark.createDataFrame([], schema)
        if not parts:
            return self.spark.read.schema(schema).parquet(f"{self.folder(table)}/{LOAD}={held[()]}")
        wanted = ["/".join([*part, str(number)]) for part, number in held.items()]
        return self.spark.read.schema(schema.add(LOAD, T.LongType())).parquet(self.folder(table)).filter(
            self._version([*parts, LOAD]).isin(wanted)).drop(LOAD)

    # --- writing -----------------------------------------------------------------------------------

    def publish(self, contents: dict[Table, DataFrame]) -> None:
        """Replace the contents of all given tables at once or, if anything fails, not at all."""
        with self.load() as load:
            for table, rows in contents.items():
                load.replace(table, rows)

    def upsert_facts(self, source: DataFrame, table: Table, order_by: Sequence[str], loaded_at: Column) -> None:
        """One upsert of facts as a load of its own."""
        with self.load() as load:
            load.upsert_facts(source, table, order_by, loaded_at)

    # --- upkeep ------------------------------------------------------------------------------------

    def drop_old(self, keep: int = 2, needed: int | None = None) -> list[str]:
        """Delete all but the ``keep`` newest versions of each part, and what loads that were given up wrote.

        Keep more than one while readers of an earlier version may still run. Of versions up to load
        ``needed`` the newest stays too: a refresh since then compares with it. No load may be under
        way meanwhile; this takes a number itself.
        """
        begun, deleted = self._begin(), []
        try:
            published, given_up = set(begun.state), set(self._marked("abandoned"))
            for table in TABLES.values():
                names, lines = list(PARTS.get(table.full_name, {})), {}
                versions = self.versions(table)
                for part, number in versions:
                    lines.setdefault(part, []).extend([number] if number in published else [])
                for part, number in versions:
                    line = sorted(lines[part])
                    stays = line[-max(keep, 1):] + [n for n in line if needed is not None and n <= needed][-1:]
                    if number in given_up or (number in published and number not in stays):
                        values = [_step(n, v) for n, v in zip(names, part)]
                        path = "/".join([self.folder(table), *values, f"{LOAD}={number}"])
                        deleted += [path] if storage.delete(self.spark, path) else []
        finally:
            self.abandon(begun.number)
        return deleted

    def register(self, prefix: str = "") -> list[str]:
        """Views of these names, layer by layer, that show the current contents; returns them.

        They can be read by any SQL but not written to. Call it again after a load. A name that is
        a table's is refused, and then no view is changed.
        """
        spark, state, views = self.spark, self.state(), {}
        for name, table in TABLES.items():
            if not self.parts(table, state):
                continue
            view = f"{prefix}{name}"
            if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
                raise ValueError(f"{view} is a table of the catalog; a view of that name would hide its rows")
            views[view] = self._view(table, state)
        for layer in dict.fromkeys(view.split(".")[0] for view in views):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for view, text in views.items():
            spark.sql(f"CREATE OR REPLACE VIEW {view} AS {text}")
        return list(views)

    def _view(self, table: Table, state: State) -> str:
        columns = ", ".join(table.names)
        parts = list(PARTS.get(table.full_name, {}))
        if not parts:
            return f"SELECT {columns} FROM parquet.`{self.path(table, state)}`"
        version = ", ".join(f"coalesce(cast({n} AS STRING), '')" for n in [*parts, LOAD])
        wanted = ", ".join("'" + "/".join([*part, str(n)]) + "'" for part, n in sorted(self.parts(table, state).items()))
        return f"SELECT {columns} FROM parquet.`{self.folder(table)}` WHERE concat_ws('/', {version}) IN ({wanted})"


class Load:
    """A load under way: writes folders of its number, which nobody reads before it is published."""

    def __init__(self, warehouse: Warehouse, number: int, state: State):
        self.warehouse, self.number, self.state = warehouse, number, state
        self._parts: dict[str, Held] = {}

    def parts(self, table: Table) -> Held:
        """Parts as they were when the load began."""
        if table.full_name not in self._parts:
            self._parts[table.full_name] = self.warehouse.parts(table, self.state)
        return self._parts[table.full_name]

    def table(self, table: Table) -> DataFrame:
        """Rows as they were when the load began."""
        if not self.parts(table):
            return self.warehouse.table(table, self.state)
        return self.warehouse.rows(table, self.parts(table)).select(*table.names)

    def replace(self, table: Table, rows: DataFrame) -> None:
        """Write all rows of a table; a row that its declaration forbids fails the load.

        Executors write the rows, from whatever partitions they are in.
        """
        if table.full_name in PARTS:
            self.replace_parts(table, rows, self.parts(table))
        else:
            checked = refuse_violations(rows.select(*table.names), table)
            checked.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{self.warehouse.folder(table)}/{LOAD}={self.number}")

    def replace_parts(self, table: Table, rows: DataFrame, touched: Iterable[tuple[str, ...]], spread: bool = True) -> None:
        """Write the parts that ``rows`` belong to; those of ``touched`` that get no row become empty.

        ``rows`` has the part columns that do not follow from others. ``spread`` gathers a part's rows before they are written.
        """
        w, parts = self.warehouse, list(PARTS[table.full_name])
        extra = [n for n in parts if n not in table.names]
        given = rows.withColumns({n: make() for n, make in _DERIVED.items() if n in extra})
        checked = refuse_violations(given.select(*table.names, *extra), table).withColumn(LOAD, F.lit(self.number))
        if spread:
            checked = checked.hint("rebalance", *[F.col(n) for n in parts])
        writer = checked.write.mode("overwrite").option("compression", COMPRESSION).option("partitionOverwriteMode", "dynamic")
        for key in table.key if len(table.key) == 1 else ():
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.partitionBy(*parts, LOAD).parquet(w.folder(table))
        touched = set(touched)
        if touched:
            written = {part for part, number in w.versions(table) if number == self.number}
            empty = rows.sparkSession.createDataFrame([], T.StructType([f for f in table.struct() if f.name not in parts]))
            for part in touched - written:
                values = [_step(n, v) for n, v in zip(parts, part)]
                empty.coalesce(1).write.mode("overwrite").parquet("/".join([w.folder(table), *values, f"{LOAD}={self.number}"]))

    def _part(self, table: Table) -> list[Column]:
        (stamp,) = table.stamps
        return [F.to_date(stamp).alias(DAY), F.pmod(F.xxhash64(*table.key), F.lit(self.warehouse.buckets)).cast("int").alias(BUCKET)]

    def upsert_facts(self, source: DataFrame, table: Table, order_by: Sequence[str], loaded_at: Column) -> None:
        """Insert ``source`` into keyed facts or write it over rows of its keys; parts without any stay as they are.

        The source is reduced to one row a key, so that no key is hot after that. Into empty facts it
        goes as it is. Else it is stored, so it is evaluated once, and its keys are looked up in the
        parts of their buckets; the parts that hold some are written anew. A delivery below
        ``BROADCAST_BYTES`` is broadcast for both, so that stored rows go from their files to new ones
        without a shuffle. Of a larger one the hashes of keys are shuffled to find the parts, then its
        rows and those of the parts once, by key.
        """
        w, spark, keys = self.warehouse, self.warehouse.spark, list(table.key)
        (stamp,) = table.stamps
        extra = [c for c in order_by if c not in table.fed]
        newest = latest_by_key(source.select(*table.fed, *extra), keys, extra)
        fresh_rows = refuse_violations(newest.select(*table.fed), table).withColumn(stamp, loaded_at.cast("timestamp_ntz"))
        fresh_rows = fresh_rows.select("*", *self._part(table))
        held = self.parts(table)
        if not held:
            self.replace_parts(table, fresh_rows, (), spread=w.buckets > FEW_PARTS)
            return
        reduced = scratch_path(spark, "delivery")
        fresh_rows.write.option("compression", COMPRESSION).parquet(reduced)
        fresh = spark.read.parquet(reduced)
        # At most one row a bucket; and, below, one a day and bucket.
        buckets = {str(r[BUCKET]) for r in fresh.select(BUCKET).distinct().collect()}
        today = self._parts_of(fresh)
        merge = self._merge_small if storage.size(spark, reduced) <= BROADCAST_BYTES else self._merge_large
        merge(table, fresh, held, buckets, today)
        storage.delete(spark, reduced)

    @staticmethod
    def _parts_of(rows: DataFrame) -> set[tuple[str, ...]]:
        return {tuple(r) for r in rows.select(F.col(DAY).cast("string"), F.col(BUCKET).cast("string")).distinct().collect()}

    def _merge_small(self, table: Table, fresh: DataFrame, held: Held, buckets: set[str], today: set[tuple[str, ...]]) -> None:
        w, keys, (stamp,) = self.warehouse, list(table.key), table.stamps
        stored = w.rows(table, {part: n for part, n in held.items() if part[1] in buckets})
        matched = scratch_path(w.spark, "matched")
        rows_of_keys(stored.select(*keys, DAY, BUCKET), F.broadcast(fresh), keys).write.parquet(matched)
        found = w.spark.read.parquet(matched)
        touched = self._parts_of(found) | today
        current = w.rows(table, {part: n for part, n in held.items() if part in touched}).alias("old")
        new = F.broadcast(fresh.select(*table.fed, F.lit(True).alias("_new"))).alias("new")
        values = [c for c in table.fed if c not in keys]
        written_over = current.join(new, keys, "left").select(
            *keys, *[F.when(F.col("_new"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in values], stamp, DAY, BUCKET)
        added = fresh.join(F.broadcast(found.select(*keys)), keys, "left_anti")
        self.replace_parts(table, written_over.unionByName(added.hint("rebalance", F.col(DAY), F.col(BUCKET))), (), spread=False)
        storage.delete(w.spark, matched)

    def _merge_large(self, table: Table, fresh: DataFrame, held: Held, buckets: set[str], today: set[tuple[str, ...]]) -> None:
        w, keys, (stamp,) = self.warehouse, list(table.key), table.stamps
        # A few keys often tell of every part; the others are looked up in the rest. Two keys of one
        # hash only have a part written anew that need not be.
        hashed, rest = F.xxhash64(*keys).alias("_hash"), {part: n for part, n in held.items() if part not in today and part[1] in buckets}
        touched = set(today)
        if rest:
            some = fresh.select(*keys).limit(LOOKUP_KEYS)
            touched |= self._parts_of(rows_of_keys(w.rows(table, rest).select(*keys, DAY, BUCKET), some, keys))
            rest = {part: n for part, n in rest.items() if part not in touched}
        if rest:
            touched |= self._parts_of(w.rows(table, rest).select(hashed, DAY, BUCKET).join(fresh.select(hashed), "_hash", "left_semi"))
        old = w.rows(table, {part: n for part, n in held.items() if part in touched}).select(*table.names, F.lit(True).alias("_old")).alias("old")
        new = fresh.select(*table.names, F.lit(True).alias("_new")).alias("new")
        # What was loaded before keeps its stamp, and so its part.
        chosen = {c: "_new" for c in table.fed if c not in keys} | {stamp: "_old"}
        other = {"_new": "old", "_old": "new"}
        merged = old.join(new, keys, "full_outer").select(
            *keys, *[F.when(F.col(flag), F.col(f"{flag[1:]}.{c}")).otherwise(F.col(f"{other[flag]}.{c}")).alias(c) for c, flag in chosen.items()])
        self.replace_parts(table, merged.select("*", *self._part(table)), (), spread=len(touched) > FEW_PARTS)
