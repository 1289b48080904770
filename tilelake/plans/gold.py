"""Gold per city and month, kept up to date from what is new in silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.schemas import ORIGIN, SILVER
from tilelake.sinks.live import BATCH, Layout, load, read_live, snapshot
from tilelake.sinks.silver import SILVER_LAYOUT

_KEYS = ["city", "partition_year", "partition_month"]
_SUMS = ["tile_count", "total_tests", "total_devices"]
_WEIGHTED = {"download_mbps": "avg_download_mbps", "upload_mbps": "avg_upload_mbps", "avg_lat_ms": "avg_latency_ms"}
#: A state is the sums of one city and month in one live folder of silver, named by ``state_of``.
STATES = T.StructType(
    [T.StructField(c, T.StringType()) for c in _KEYS]
    + [T.StructField(c, T.LongType()) for c in _SUMS]
    + [T.StructField(f"weighted_{c}", T.DoubleType()) for c in _WEIGHTED]
    + [T.StructField("state_of", T.StringType())]
)
_LAYOUT = Layout("state_of", (), unit_in_folders=False)


def _entry(batch: Column, unit: Column, part: Column) -> Column:
    return F.concat_ws("/", batch, unit, part)


def refresh_gold(spark: SparkSession, silver_path: str, gold_path: str) -> int:
    """Bring the states in ``gold_path`` up to date with the silver table; returns how many silver entries were read.

    Only what silver has loaded since is read, and states of what it has replaced end, all in one commit: after quarters and batches were loaded
    again the result is that of a full recomputation.
    """
    live = snapshot(spark, silver_path).filter("live")
    wanted = live.select(BATCH, F.col("unit").alias(ORIGIN), "part", _entry(F.col(BATCH), F.col("unit"), F.col("part")).alias("state_of"))
    known = snapshot(spark, gold_path).filter("live").select(F.col("unit").alias("state_of"))
    new = wanted.join(known, "state_of", "left_anti").cache()
    try:
        # one row for each new batch; its folders prune the scan
        batches = [r[BATCH] for r in new.select(BATCH).distinct().collect()]
        if not batches and known.join(wanted, "state_of", "left_anti").isEmpty():
            return 0
        rows = read_live(spark, silver_path, SILVER_LAYOUT, SILVER).filter(F.col(BATCH).isin(batches))
        rows = rows.withColumn("part", SILVER_LAYOUT.part()).join(F.broadcast(new), [BATCH, ORIGIN, "part"])
        weighted = [F.sum((F.col(c) * F.col("tests")).cast("double")).alias(f"weighted_{c}") for c in _WEIGHTED]
        states = rows.groupBy(*_KEYS, "state_of").agg(
            F.count(F.lit(1)).alias("tile_count"), F.sum("tests").alias("total_tests"), F.sum("devices").alias("total_devices"), *weighted
        )
        ended = lambda old, _: old.join(wanted.select(F.col("state_of").alias("unit")), "unit", "left_anti")
        load(states.select(*STATES.names), gold_path, _LAYOUT, ended)
        return new.count()
    finally:
        new.unpersist()


def read_gold(spark: SparkSession, gold_path: str) -> DataFrame:
    """Tests, devices, tiles and test-weighted mean speeds per city and month, merged from the states."""
    states = read_live(spark, gold_path, _LAYOUT, STATES)
    means = [(F.sum(f"weighted_{c}") / F.sum("total_tests")).alias(name) for c, name in _WEIGHTED.items()]
    return states.groupBy(*_KEYS).agg(*(F.sum(c).alias(c) for c in _SUMS), *means)
