"""Size checks that a table has to pass before it may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BROADCAST_BYTES = 128 * 1024 * 1024
_ROW_BYTES = 64
_VALUE_BYTES = 8


def measured_bytes(table: DataFrame) -> int:
    """Rough in-memory size of a table, from one pass that returns one row."""
    width = _ROW_BYTES + _VALUE_BYTES * len(table.columns)
    texts = [f.name for f in table.schema if isinstance(f.dataType, StringType)]
    sums = [F.sum(F.octet_length(F.col(f"`{name}`"))) for name in texts]
    rows, *lengths = table.agg(F.count(F.lit(1)), *sums).first()
    return rows * width + sum(length or 0 for length in lengths)


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(table) <= limit
