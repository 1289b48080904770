"""The bronze-to-silver job."""

from __future__ import annotations

import datetime as dt
import logging
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from tilelake.functions import with_centers
from tilelake.operators.analytics import silver_measures
from tilelake.operators.geocode import MAX_BROADCAST_BYTES, PlaceIndex, build_place_index, with_cities
from tilelake.operators.layout import add_partition_columns
from tilelake.operators.quality import clean, has_location
from tilelake.schemas import ORIGIN, PARTITION_COLUMNS, SILVER
from tilelake.sinks.silver import write_silver
from tilelake.sinks.tables import rebalanced
from tilelake.sources.bronze import require_rows, scan_quarter

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunStatistics:
    """What a run read, kept and found; means are None when nothing was kept."""

    bronze_rows: int
    silver_rows: int
    filtered_rows: int
    retention_pct: float
    avg_quality_score: float | None
    city_success_pct: float
    avg_download_mbps: float | None
    avg_upload_mbps: float | None
    avg_latency_ms: float | None
    default_partition_rows: int
    duration_sec: float


def locate(bronze: DataFrame, processed_at: dt.datetime | None = None, projection: str = "linear") -> DataFrame:
    """Clean rows whose quadkey has a cell, with the cell's centre."""
    rows = clean(bronze.filter(has_location()), processed_at)
    return with_centers(rows, projection=projection, checked=True)


def to_silver(
    bronze: DataFrame,
    index: PlaceIndex | None,
    processed_at: dt.datetime | None = None,
    projection: str = "linear",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Silver rows for bronze rows, columns in table order; extra columns come before
    the partition columns.

    With a place index of broadcast size this is one narrow pass: no shuffle at all.
    """
    located = locate(bronze, processed_at, projection)
    silver = add_partition_columns(with_cities(located, index, max_broadcast_bytes))
    known = [c for c in SILVER.names if c not in PARTITION_COLUMNS]
    extra = [c for c in silver.columns if c not in SILVER.names]
    return silver.select(*known, *extra, *PARTITION_COLUMNS)


def _percent(part: int, whole: int) -> float:
    return 100.0 * part / whole if whole else 0.0


def bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    gazetteer: DataFrame | None = None,
    index: PlaceIndex | None = None,
    processed_at: dt.datetime | None = None,
    projection: str = "linear",
    rebalance: bool = True,
    quarter: str | None = None,
    **write_options,
) -> RunStatistics:
    """Read bronze, clean and enrich it, write the partitioned silver table.

    The statistics are gathered while the table is written: the data is read once.
    They are observed in the writing stage, after the shuffle, where a lost executor
    cannot make a row count twice. With a ``quarter`` only its bronze rows are read (see
    ``scan_quarter``), and they replace what that quarter wrote to silver before. Bronze rows are counted from the parquet footers.
    """
    started = time.monotonic()
    bronze = scan_quarter(spark, bronze_path, quarter, origin=quarter is None)
    bronze = bronze.drop("quarter")  # of a landed table; in silver it is the unit
    require_rows(bronze, bronze_path)
    if index is None and gazetteer is not None:
        index = build_place_index(gazetteer)
    stamp = processed_at or dt.datetime.now(dt.timezone.utc)
    silver = to_silver(bronze, index, stamp, projection)
    if rebalance:
        silver = rebalanced(silver, [*([] if quarter is not None else [ORIGIN]), *PARTITION_COLUMNS])
    observed = Observation("silver")
    write_silver(silver.observe(observed, *silver_measures()), silver_path, quarter=quarter, rebalance=False, **write_options)
    measured = observed.get
    bronze_rows = bronze.count()
    silver_rows = measured["silver_rows"]
    statistics = RunStatistics(
        bronze_rows=bronze_rows,
        silver_rows=silver_rows,
        filtered_rows=bronze_rows - silver_rows,
        retention_pct=_percent(silver_rows, bronze_rows),
        avg_quality_score=measured["avg_quality_score"],
        city_success_pct=_percent(measured["cities_found"], silver_rows),
        avg_download_mbps=measured["avg_download_mbps"],
        avg_upload_mbps=measured["avg_upload_mbps"],
        avg_latency_ms=measured["avg_latency_ms"],
        default_partition_rows=measured["default_partition_rows"],
        duration_sec=time.monotonic() - started,
    )
    for name, value in asdict(statistics).items():
        log.info("%s: %s", name, value)
    return statistics
