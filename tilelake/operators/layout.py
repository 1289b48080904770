"""Partition columns of the silver table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Partition of a tile whose date cannot be read.
DEFAULT_YEAR = "2019"
DEFAULT_MONTH = "01"


def partition_year(tile: Column) -> Column:
    """Characters 1-4 of a tile longer than 4 characters, else the default year."""
    return F.when(F.length(tile) > 4, F.substring(tile, 1, 4)).otherwise(F.lit(DEFAULT_YEAR))


def partition_month(tile: Column) -> Column:
    """Characters 6-7 of a tile longer than 7 characters, else the default month."""
    return F.when(F.length(tile) > 7, F.substring(tile, 6, 2)).otherwise(F.lit(DEFAULT_MONTH))


def has_default_partition(tile: Column) -> Column:
    """True when a partition column of this tile is a default, not read from the tile."""
    return F.coalesce(F.length(tile) <= 7, F.lit(True))


def add_partition_columns(df: DataFrame) -> DataFrame:
    tile = F.col("tile")
    return df.withColumns({"partition_year": partition_year(tile), "partition_month": partition_month(tile)})
