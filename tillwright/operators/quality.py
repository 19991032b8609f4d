"""Declared constraints, row counts and schema listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.schemas import Column, Table
from tillwright.session import cut

# Name of each rule, and of each type as an information schema shows it.
NOT_NULL, TOO_LONG, NOT_A_VALUE, REPEATED = "not_null", "max_length", "type_range", "primary_key"
INFORMATION_TYPES = {
    "string": "character varying",
    "int": "integer",
    "bigint": "bigint",
    "date": "date",
    "timestamp_ntz": "timestamp without time zone",
}


def _rules(column: Column) -> dict[str, Expr]:
    value = F.col(column.name)
    rules = {}
    if column.required:
        rules[NOT_NULL] = value.isNull()
    if column.max_length is not None:
        rules[TOO_LONG] = F.length(value) > column.max_length
    else:
        rules[NOT_A_VALUE] = value.isNotNull() & value.try_cast(column.spark_type).isNull()
    return rules


def refuse_violations(rows: DataFrame, table: Table) -> DataFrame:
    """``rows`` unchanged; reading one that breaks a value rule is an error. Nothing is evaluated twice."""
    checked = []
    for c in table.columns:
        value = F.col(c.name)
        for rule, broken in (_rules(c).items() if c.name in rows.columns and not c.stamped else ()):
            message = F.concat(F.lit(f"{table.full_name}: {rule} of {c.name} is broken by "), F.coalesce(F.col(c.name).cast("string"), F.lit("NULL")))
            value = F.when(broken, F.raise_error(message)).otherwise(value)
        if c.name in rows.columns:
            checked.append(value.cast(rows.schema[c.name].dataType).alias(c.name))
    rest = [c for c in rows.columns if c not in table.names]
    return rows.select(*checked, *rest).select(*rows.columns)


def _faults(rows: DataFrame, table: Table) -> Expr:
    checks = [
        F.when(broken, F.struct(F.lit(c.name).alias("column_name"), F.lit(rule).alias("rule"),
                                F.col(c.name).cast("string").alias("value")))
        for c in table.columns if c.name in rows.columns
        for rule, broken in _rules(c).items()
    ]
    return F.filter(F.array(*checks), lambda v: v.isNotNull())


def set_aside(rows: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects): rows without a broken value rule, typed, and one row per broken rule of the others.

    The input is evaluated once and stored in the shared folder with what was found.
    """
    checked = cut(rows.withColumn("_faults", _faults(rows, table)))
    types = {c.name: c.spark_type for c in table.columns}
    accepted = checked.filter(F.size("_faults") == 0).select(*[F.col(c).cast(types[c]) if c in types else F.col(c) for c in rows.columns])
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in table.key]).alias("row_key")
    return accepted, checked.select(key, F.explode("_faults").alias("v")).select("row_key", "v.column_name", "v.rule", "v.value")


def repeated_keys(rows: DataFrame, table: Table) -> DataFrame:
    """One row per key that occurs more than once; a hot key is counted before the shuffle."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in table.key]).alias("row_key")
    return (
        rows.dropna(subset=list(table.key))
        .groupBy(*table.key).agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select(key, F.lit(",".join(table.key)).alias("column_name"), F.lit(REPEATED).alias("rule"),
                F.col("n").cast("string").alias("value"))
    )


def violations(rows: DataFrame, table: Table) -> DataFrame:
    """Everything in ``rows`` (typed or text) that the declaration of ``table`` forbids.

    The input is evaluated once; its keys and what breaks a rule are stored in the shared folder.
    """
    kept = cut(rows.select(*table.key, _faults(rows, table).alias("_faults")))
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in table.key]).alias("row_key")
    broken = kept.select(key, F.explode("_faults").alias("v")).select("row_key", "v.column_name", "v.rule", "v.value")
    return broken.unionByName(repeated_keys(kept, table))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def information_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.DecimalType):
        return "numeric"
    return INFORMATION_TYPES[data_type.simpleString()]


def table_schema(spark: SparkSession, name: str, stored: DataFrame) -> DataFrame:
    """Columns of a stored table with their position and type."""
    rows = [(name, i, f.name, information_type(f.dataType)) for i, f in enumerate(stored.schema.fields, start=1)]
    return spark.createDataFrame(
        rows, "table_name string, ordinal_position int, column_name string, data_type string"
    ).orderBy("ordinal_position")
