"""Relational databases over JDBC: parallel reads, executor-side batched writes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    batch_size: int = 10_000
    options: dict[str, str] = field(default_factory=dict)

    def settings(self) -> dict[str, str]:
        named = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {k: v for k, v in named.items() if v is not None} | self.options


def range_settings(column: str, lower: object, upper: object, partitions: int) -> dict[str, str]:
    """Options that split a read into ranges of ``column``; rows outside the bounds are kept."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_table(spark: SparkSession, db: Database, table: str, split: dict[str, str] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**db.settings(), **(split or {}), dbtable=table).load()


def read_query(spark: SparkSession, db: Database, sql: str) -> DataFrame:
    return spark.read.format("jdbc").options(**db.settings(), query=sql).load()


def append_table(df: DataFrame, db: Database, table: str, columns: list[str]) -> None:
    (
        df.select(*columns).write.format("jdbc").mode("append")
        .options(**db.settings(), dbtable=table, batchsize=str(db.batch_size))
        .save()
    )


def reload_table(df: DataFrame, db: Database, table: str, columns: list[str]) -> None:
    """Empty the table and fill it again, keeping its definition."""
    (
        df.select(*columns).write.format("jdbc").mode("overwrite")
        .options(**db.settings(), dbtable=table, batchsize=str(db.batch_size), truncate="true")
        .save()
    )
