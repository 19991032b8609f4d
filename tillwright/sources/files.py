"""CSV and Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.schemas import TIME_TEXT, Table


#: Columns that tell a later line of a delivery from an earlier one.
LINE_ORDER = ("_file", "_block", "_line")
#: Quotes within a field are doubled, as spreadsheets and other writers do.
_QUOTES = {"quote": '"', "escape": '"'}


def read_csv_text(spark: SparkSession, path: str, table: Table, multi_line: bool = False, numbered: bool = False) -> DataFrame:
    """Columns of ``table`` as text, picked by name from CSV with a header.

    Other columns are ignored; a missing path or column is an error, and so is a file of a folder
    whose header is not that of the others. Only header lines are read ahead, no type is inferred.
    ``multi_line`` allows line breaks within quoted fields; a file is then read by one task.
    ``numbered`` adds the columns of ``LINE_ORDER``.
    """
    # With a mark for NULL that no field holds, an empty field is NULL and a quoted empty one is empty text.
    reader = spark.read.options(header=True, mode="FAILFAST", multiLine=multi_line, nullValue="\0", **_QUOTES)
    header = reader.csv(path).columns
    rows = reader.options(enforceSchema=False).schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).csv(path)
    places = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
              F.monotonically_increasing_id().alias("_line")] if numbered else []
    return rows.select(*table.fed, *places)


def read_csv(spark: SparkSession, path: str, table: Table, multi_line: bool = False, numbered: bool = False) -> DataFrame:
    """The same columns with their declared types; text that does not fit is an error."""
    types = table.struct(only_fed=True)
    order = LINE_ORDER if numbered else ()
    return read_csv_text(spark, path, table, multi_line, numbered).select(
        *[F.col(f.name).cast(f.dataType) for f in types], *order)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; texts keep their blanks and quotes, and empty text differs from NULL."""
    (
        df.write.mode("overwrite")
        .options(header=True, timestampNTZFormat=TIME_TEXT, ignoreLeadingWhiteSpace=False,
                 ignoreTrailingWhiteSpace=False, **_QUOTES)
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_parquet(df: DataFrame, columns: list[str], path: str) -> None:
    """Add the named columns of ``df``, in that order, to the files at ``path``."""
    df.select(*columns).write.mode("append").parquet(path)
