"""Row filters, row counts and ordered previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lacks_coords() -> Column:
    return F.col("lat").isNull() | F.col("lng").isNull()


def missing_coords(rows: DataFrame) -> DataFrame:
    """Rows without a latitude or without a longitude."""
    return rows.filter(lacks_coords())


def complete_coords(rows: DataFrame) -> DataFrame:
    """Rows with both coordinates."""
    return rows.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())


def by_franchise(rows: DataFrame, name: str) -> DataFrame:
    return rows.filter(F.col("franchise_name") == name)


def row_count(rows: DataFrame) -> DataFrame:
    """The number of rows, as a table of one row."""
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def preview(
    rows: DataFrame,
    n: int = 20,
    columns: Sequence[str] | None = None,
    order_by: Sequence[str | Column] = (),
) -> DataFrame:
    """The first ``n`` rows. Which rows these are is fixed only under a total order."""
    if order_by:
        rows = rows.orderBy(*order_by)
    if columns is not None:
        rows = rows.select(*columns)
    return rows.limit(n)
