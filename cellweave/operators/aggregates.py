"""Restaurant counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def restaurant_counts(restaurants: DataFrame) -> DataFrame:
    """Restaurants with a known country per franchise and city, largest count first.

    Counts non-null ids; null names form groups of their own. Ties are ordered by
    franchise and then city (nulls first).
    """
    return (
        restaurants.filter(F.col("country").isNotNull())
        .groupBy("franchise_name", "city")
        .agg(F.count("id").alias("restaurant_count"))
        .orderBy(F.col("restaurant_count").desc(), F.col("franchise_name"), F.col("city"))
    )
