from cellweave.sources.tables import (
    by_geohash,
    by_prefix,
    csv_inferred,
    parquet,
    restaurants_csv,
    weather_csv,
    weather_parquet,
)
from cellweave.sources.weather_zip import weather_zip

__all__ = [
    "by_geohash",
    "by_prefix",
    "csv_inferred",
    "parquet",
    "restaurants_csv",
    "weather_csv",
    "weather_parquet",
    "weather_zip",
]
