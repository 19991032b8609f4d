"""Sale events as JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.times import format_time
from tillwright.schemas import SALES_STREAM

EVENT_TEXT = SALES_STREAM.text_struct()


def encode(sales: DataFrame, arrived: str | None = None) -> DataFrame:
    """``key`` and JSON ``value`` of each sale, and ``timestamp`` if ``arrived`` names its column."""
    fields = [
        format_time(F.col(c)).alias(c) if c == "sale_timestamp" else F.col(c) for c in SALES_STREAM.fed
    ]
    arrival = [F.col(arrived).alias("timestamp")] if arrived else []
    return sales.select(F.col("sale_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"), *arrival)


def _is_valid() -> Column:
    """Every delivered column is there and fits its declaration."""
    checks = []
    for c in SALES_STREAM.columns:
        if c.stamped:
            continue
        checks.append(F.col(c.name).isNotNull())
        if c.max_length is not None:
            checks.append(F.length(c.name) <= c.max_length)
    valid = checks[0]
    for check in checks[1:]:
        valid = valid & check
    return valid


def decode(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Typed sale columns next to the message columns, and ``is_valid``.

    ``strict`` fails the query at a malformed, incomplete or mistyped message. Otherwise such a
    message keeps its text and is marked, so that it can be set aside.
    """
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    # As a generator, the parser runs once per message: filters on its output stay above it.
    parsed = messages.select("*", F.inline(F.array(F.from_json("value", EVENT_TEXT, options))))
    types = {f.name: f.dataType for f in SALES_STREAM.struct(only_fed=True).fields}
    typed = parsed.withColumns({
        n: F.col(n).cast(t) if strict else F.col(n).try_cast(t) for n, t in types.items()
    })
    if not strict:
        return typed.withColumn("is_valid", F.coalesce(_is_valid(), F.lit(False)))
    refuse = F.raise_error(F.concat(F.lit("invalid sale event: "), F.coalesce("value", F.lit("NULL"))))
    return typed.withColumn("is_valid", F.when(_is_valid(), True).otherwise(refuse.cast("boolean")))


def accepted(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Sales of the valid messages, ``ingestion_timestamp`` being the arrival."""
    valid = decode(messages, strict).filter("is_valid")
    return valid.withColumnRenamed("timestamp", "ingestion_timestamp").select(*SALES_STREAM.names)


def rejected(messages: DataFrame) -> DataFrame:
    """The messages that are not valid, as they arrived."""
    return decode(messages).filter(~F.col("is_valid")).select("key", "value", "timestamp")
