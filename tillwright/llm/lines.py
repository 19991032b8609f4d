"""Line deduplication by winnowing over line hashes, in DataFrame operations only.

Lines with a word are numbered within their document; blank lines are not, and are always kept.
In each window of ``width`` lines the least line hash, the last of equals, is selected, so two documents
that share ``width`` lines in a row share a selected fingerprint. Fingerprints that occur at one
position only rule out the windows that select them; all other windows are grouped by all their line
hashes, and windows that follow each other join to longer runs. No match is extended from a
position. The first occurrence, by doc_id and line, of every window stays; lines covered by a later
one are deleted.

So a line goes if and only if it lies in ``width`` lines in a row that occurred earlier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines in a window: the shortest run that is found.
WIDTH = 3
#: ASCII white space, as a pattern.
BLANK = r"^[ \t-\r]*$"


def _blank(line: Column) -> Column:
    return line.rlike(BLANK)


def line_table(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, lines): per document, (hash, at) of its lines with a word, ``at`` among all lines."""
    lines = F.transform(F.split(F.col("text"), "\n", -1),
                        lambda x, i: F.struct(F.when(~_blank(x), F.xxhash64(x)).alias("hash"), i.alias("at")))
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), F.filter(lines, lambda x: x["hash"].isNotNull()).alias("lines"))


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, mark, start, from, to): windows of ``width`` lines that occurred earlier.

    ``start`` counts lines with a word, ``from`` and ``to`` all lines. ``mark`` is the hash of the
    document's text. Rows with the same doc_id and text are one document here. A null doc_id comes
    last; other ids go by their order, then by mark.
    """
    tables = line_table(docs).filter(F.size("lines") >= width)
    windows = (tables.select("doc_id", "mark", "lines", F.explode(F.sequence(F.lit(0), F.size("lines") - width)).alias("start"))
               .select("doc_id", "mark", "start", F.expr(f"slice(lines, start + 1, {width})").alias("w"))
               .select("doc_id", "mark", "start", F.col("w.hash").alias("hashes"),
                       F.element_at("w", 1)["at"].alias("from"), (F.element_at("w", width)["at"] + 1).alias("to")))
    # A fingerprint is one line of one document, however many windows select it. Equal hashes: the last.
    least = F.array_min("hashes")
    at = F.col("start") + width - F.array_position(F.reverse("hashes"), least)
    placed = windows.withColumn("fingerprint", least).withColumn("spot", F.xxhash64("doc_id", "mark", at))
    shared = (placed.groupBy("fingerprint").agg(F.min("spot").alias("least"), F.max("spot").alias("most"))
              .filter("least < most").select("fingerprint"))
    matched = placed.join(shared, "fingerprint", "left_semi")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "mark", "start")
    first = matched.groupBy("hashes").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first < last")
    return (matched.join(first.select("hashes", "first"), "hashes").filter(place > F.col("first"))
            .select("doc_id", "mark", "start", "from", "to"))


def repeated_runs(windows: DataFrame) -> DataFrame:
    """(doc_id, mark, runs): per document, [from, to) of its maximal runs of repeated lines, over all lines.

    Windows that overlap or touch are merged into one run. A document's windows are gathered in
    one row, as its text is.
    """
    spans = windows.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set(F.struct("from", "to"))).alias("spans"))
    opens = F.expr("filter(spans, (s, i) -> i = 0 or s.from > element_at(spans, i).to).from")
    closes = F.expr("filter(spans, (s, i) -> i = size(spans) - 1 or element_at(spans, i + 2).from > s.to).to")
    return spans.select("doc_id", "mark", F.arrays_zip(opens.alias("from"), closes.alias("to")).alias("runs"))


def drop_repeated_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from ``text``, and what was deleted.

    Adds ``n_lines`` (lines with a word), ``n_deleted`` (of these), ``runs`` (array<struct<from,
    to>> over the numbers of all lines; blank lines within a run stay). A null text stays null and
    has no lines. All rows stay, in no order; other columns are kept, those named like an added
    one are replaced.
    """
    docs = docs.drop("n_lines", "n_deleted", "runs")
    found = repeated_runs(repeated_windows(docs, width)).select(
        F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), "runs")
    keyed = docs.withColumn("__text_mark", F.xxhash64("text"))
    joined = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_mark") == F.col("__mark")), "left")
    lines = F.split(F.col("text"), "\n", -1)
    worded = F.size(F.filter(lines, lambda x: ~_blank(x)))
    kept = F.filter(lines, lambda x, i: _blank(x) | ~F.exists("runs", lambda r: (i >= r["from"]) & (i < r["to"])))
    changed = F.col("runs").isNotNull()
    left = F.when(changed, F.size(F.filter(kept, lambda x: ~_blank(x)))).otherwise(worded)
    none = F.expr("cast(array() as array<struct<from:int,to:int>>)")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(worded).cast("long")
    n_deleted = F.when(changed, worded - left).otherwise(0).cast("long")
    names = [c for c in docs.columns if c != "text"]
    return joined.select(
        *[F.col(f"`{c}`") for c in names[:docs.columns.index("text")]],
        F.when(changed, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text"),
        *[F.col(f"`{c}`") for c in names[docs.columns.index("text"):]],
        n_lines.alias("n_lines"), n_deleted.alias("n_deleted"), F.coalesce("runs", none).alias("runs"))


def oracle_sql(width: int = WIDTH) -> str:
    """DuckDB SQL of the query over ``documents`` with whole, non-null texts and ids."""
    return f"""
WITH l AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
  WHERE NOT regexp_full_match(line, '[ \\t\\n\\v\\f\\r]*')
), w AS (
  SELECT doc_id, n, list(line) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN CURRENT ROW AND {width - 1} FOLLOWING) AS win
  FROM l
), r AS (
  SELECT doc_id, n, row_number() OVER (PARTITION BY win ORDER BY doc_id, n) AS k FROM w WHERE len(win) = {width}
), d AS (
  SELECT DISTINCT doc_id, n + o AS n FROM r, range({width}) t(o) WHERE k > 1
)
SELECT x.doc_id, x.n_lines, coalesce(y.n_deleted, 0) AS n_deleted, coalesce(z.kept, '') AS kept_lines_md5
FROM (SELECT documents.doc_id, count(l.n) AS n_lines FROM documents LEFT JOIN l USING (doc_id) GROUP BY 1) x
LEFT JOIN (SELECT doc_id, count(*) AS n_deleted FROM d GROUP BY 1) y USING (doc_id)
LEFT JOIN (SELECT doc_id, md5(string_agg(line, chr(10) ORDER BY n)) AS kept FROM l ANTI JOIN d USING (doc_id, n) GROUP BY 1) z USING (doc_id)
"""
