"""Text ids of the sales model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix and zero-padded width of each generated id.
ID_FORMATS = {
    "product": "P%03d",
    "store": "S%03d",
    "sale": "BATCH-%06d",
    "customer": "CUST-%06d",
    "stream_sale": "STREAM-%012X",
}


def format_id(kind: str, number: Column) -> Column:
    return F.format_string(ID_FORMATS[kind], number)
