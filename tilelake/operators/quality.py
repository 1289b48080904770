"""Row validation, outlier flags, quality score and derived metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.functions import is_quadkey, percent
from tilelake.schemas import BRONZE

# Limits and score deductions of the cleaning rules.
MAX_QUADKEY_LENGTH = 30
SHORT_QUADKEY_LENGTH = 10
OUTLIER_DOWNLOAD_KBPS = 1_000_000
OUTLIER_UPLOAD_KBPS = 500_000
HIGH_LATENCY_MS = 1000
FULL_SCORE = 100
SHORT_QUADKEY_DEDUCTION = 10
OUTLIER_DEDUCTION = 20
KBPS_PER_MBPS = 1024.0


def trim_keys(df: DataFrame) -> DataFrame:
    """Strip leading and trailing spaces (spaces only) from ``quadkey`` and ``tile``."""
    return df.withColumns({"quadkey": F.trim("quadkey"), "tile": F.trim("tile")})


def has_usable_quadkey() -> Column:
    """Quadkey length after trimming is 1..30."""
    return F.length(F.trim("quadkey")).between(1, MAX_QUADKEY_LENGTH)


def has_positive_speed() -> Column:
    return (F.col("avg_d_kbps") > 0) & (F.col("avg_u_kbps") > 0)


def has_valid_latency() -> Column:
    return F.col("avg_lat_ms") >= 0


def has_positive_counts() -> Column:
    return (F.col("tests") > 0) & (F.col("devices") > 0)


def is_clean() -> Column:
    """Whole validity predicate on raw bronze columns; null when a tested column is null."""
    return has_positive_speed() & has_valid_latency() & has_positive_counts() & has_usable_quadkey()


def has_location() -> Column:
    """The trimmed quadkey holds only the digits 0-3, so its cell exists."""
    return is_quadkey(F.trim("quadkey"), MAX_QUADKEY_LENGTH)


def _is_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def flags() -> dict[str, Column]:
    """Outlier and latency flags; a missing measurement is not flagged."""
    return {
        "is_outlier_download": _is_true(F.col("avg_d_kbps") > OUTLIER_DOWNLOAD_KBPS),
        "is_outlier_upload": _is_true(F.col("avg_u_kbps") > OUTLIER_UPLOAD_KBPS),
        "is_high_latency": _is_true(F.col("avg_lat_ms") > HIGH_LATENCY_MS),
    }


def quality_score() -> Column:
    """100, less 10 for a short quadkey, less 20 once for any speed outlier."""
    outlier = _is_true(F.col("avg_d_kbps") > OUTLIER_DOWNLOAD_KBPS) | _is_true(
        F.col("avg_u_kbps") > OUTLIER_UPLOAD_KBPS
    )
    return (
        F.lit(FULL_SCORE)
        - F.when(F.length(F.trim("quadkey")) < SHORT_QUADKEY_LENGTH, SHORT_QUADKEY_DEDUCTION).otherwise(0)
        - F.when(outlier, OUTLIER_DEDUCTION).otherwise(0)
    )


def derived_metrics() -> dict[str, Column]:
    """Speeds in Mbps and tests per device; apply only to rows with devices > 0."""
    return {
        "download_mbps": F.col("avg_d_kbps") / KBPS_PER_MBPS,
        "upload_mbps": F.col("avg_u_kbps") / KBPS_PER_MBPS,
        "tests_per_device": F.col("tests") / F.col("devices"),
    }


def clean(df: DataFrame, processed_at: dt.datetime | None = None) -> DataFrame:
    """Keep the valid rows and add timestamp, score, flags and derived metrics.

    One filter on raw columns, so its numeric parts reach the parquet scan, and one
    projection. ``processed_at`` fixes the timestamp of a run; by default it is the
    query's current time. Columns beyond the bronze schema pass through.
    """
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    extra = [c for c in df.columns if c not in BRONZE.names]
    added = {
        "processed_at": stamp,
        "data_quality_score": quality_score(),
        **flags(),
        **derived_metrics(),
    }
    return df.filter(is_clean()).select(
        F.trim("quadkey").alias("quadkey"),
        F.trim("tile").alias("tile"),
        *BRONZE.names[2:],
        *extra,
        *(expr.alias(name) for name, expr in added.items()),
    )


def cleaning_report(bronze: DataFrame) -> DataFrame:
    """Rows before and after cleaning, rows removed and their share, in one pass."""
    counts = bronze.agg(
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(is_clean()).alias("cleaned_rows"),
    )
    removed = F.col("initial_rows") - F.col("cleaned_rows")
    return counts.withColumns(
        {"removed_rows": removed, "removal_pct": percent(removed, F.col("initial_rows"))}
    )
