"""Per-city analytics, numeric summaries and quality reports.

All are hash aggregations with map-side partial sums, so a city that holds a large
share of the rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.functions import percent
from tilelake.operators.layout import has_default_partition


def city_stats(df: DataFrame, digits: int = 0) -> DataFrame:
    """Rounded mean speeds and latency, tests and tiles per city."""
    return df.groupBy("city").agg(
        F.round(F.avg("avg_d_kbps"), digits).alias("avg_download_kbps"),
        F.round(F.avg("avg_u_kbps"), digits).alias("avg_upload_kbps"),
        F.round(F.avg("avg_lat_ms"), digits).alias("avg_latency_ms"),
        F.sum("tests").alias("total_tests"),
        F.count(F.lit(1)).alias("tile_count"),
    )


def city_speed(df: DataFrame) -> DataFrame:
    """Mean download Mbps and number of tiles with a quadkey per city."""
    return df.groupBy("city").agg(
        F.avg("download_mbps").alias("avg_download_mbps"), F.count("quadkey").alias("tile_count")
    )


def top_cities(stats: DataFrame, by: str, n: int) -> DataFrame:
    """The ``n`` cities with the largest ``by``; ties in order of name."""
    return stats.orderBy(F.desc(by), "city").limit(n)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """A reproducible sample: the first ``n`` rows in the order of all columns."""
    return df.orderBy(*df.columns).limit(n)


def gold_city_month(df: DataFrame) -> DataFrame:
    """Tests, devices, tiles and test-weighted mean speeds per city and month."""
    weighted = lambda c: F.sum(F.col(c) * F.col("tests")) / F.sum("tests")
    return df.groupBy("city", "partition_year", "partition_month").agg(
        F.count(F.lit(1)).alias("tile_count"),
        F.sum("tests").alias("total_tests"),
        F.sum("devices").alias("total_devices"),
        weighted("download_mbps").alias("avg_download_mbps"),
        weighted("upload_mbps").alias("avg_upload_mbps"),
        weighted("avg_lat_ms").alias("avg_latency_ms"),
    )


def quality_histogram(df: DataFrame) -> DataFrame:
    """Rows per quality score and flag combination."""
    keys = ["data_quality_score", "is_outlier_download", "is_outlier_upload", "is_high_latency"]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def _long_table(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """Compute every measure of every column in one aggregation; one row per column."""
    wide = df.agg(*(f(F.col(c)).alias(f"{c}__{m}") for c in columns for m, f in measures.items()))
    return wide.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(c).alias("column"), *(F.col(f"{c}__{m}").alias(m) for m in measures))
                    for c in columns
                )
            )
        )
    )


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum of each column."""
    return _long_table(
        df.select(*(F.col(c).cast("double").alias(c) for c in columns)),
        columns,
        {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max},
    )


def describe_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """``describe_numeric`` with booleans read as 0 and 1."""
    return describe_numeric(df.select(*(F.col(c).cast("int").alias(c) for c in columns)), columns)


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, first and last value of each text column."""
    return _long_table(df, columns, {"count": F.count, "min": F.min, "max": F.max})


def silver_measures() -> list[Column]:
    """Aggregates of a run over its silver rows."""
    return [
        F.count(F.lit(1)).alias("silver_rows"),
        F.avg("data_quality_score").alias("avg_quality_score"),
        F.count_if("city_lookup_success").alias("cities_found"),
        F.avg("download_mbps").alias("avg_download_mbps"),
        F.avg("upload_mbps").alias("avg_upload_mbps"),
        F.avg("avg_lat_ms").alias("avg_latency_ms"),
        F.count_if(has_default_partition(F.col("tile"))).alias("default_partition_rows"),
    ]


def run_statistics(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row of run statistics: row counts, retention, quality, lookup success, means."""
    # counting bronze reads parquet footers only
    counted = bronze.agg(F.count(F.lit(1)).alias("bronze_rows"))
    measured = silver.agg(*silver_measures())
    # each has exactly one row, so the maximum of a column is its only value
    merged = counted.unionByName(measured, allowMissingColumns=True)
    one = merged.agg(*(F.max(c).alias(c) for c in merged.columns))
    filtered = F.col("bronze_rows") - F.col("silver_rows")
    return one.select(
        "bronze_rows",
        "silver_rows",
        filtered.alias("filtered_rows"),
        percent(F.col("silver_rows"), F.col("bronze_rows")).alias("retention_pct"),
        "avg_quality_score",
        percent(F.col("cities_found"), F.col("silver_rows")).alias("city_success_pct"),
        "avg_download_mbps",
        "avg_upload_mbps",
        "avg_latency_ms",
        "default_partition_rows",
    )
