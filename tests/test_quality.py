"""Boundaries of the cleaning rules."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tilelake.operators import quality
from tilelake.operators.layout import add_partition_columns
from tilelake.operators.quality import clean
from tilelake.schemas import BRONZE, validate_schema

GOOD = dict(quadkey="0" * 16, tile="2019-03-01_x", avg_d_kbps=100, avg_u_kbps=50, avg_lat_ms=10, tests=3, devices=2)


def bronze(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **c}[n] for n in BRONZE.names) for c in changes], BRONZE)


def cleaned(spark, **change):
    return clean(bronze(spark, change), dt.datetime(2024, 1, 1)).collect()


@pytest.mark.parametrize(
    "change, kept",
    [
        (dict(quadkey=None), False),
        (dict(quadkey=""), False),
        (dict(quadkey="    "), False),
        (dict(quadkey="1"), True),
        (dict(quadkey="1" * 30), True),
        (dict(quadkey="1" * 31), False),
        (dict(quadkey="  " + "1" * 30 + " "), True),
        (dict(quadkey="\t"), True),
        (dict(avg_d_kbps=None), False),
        (dict(avg_d_kbps=0), False),
        (dict(avg_d_kbps=1), True),
        (dict(avg_u_kbps=-1), False),
        (dict(avg_u_kbps=None), False),
        (dict(avg_lat_ms=None), False),
        (dict(avg_lat_ms=-1), False),
        (dict(avg_lat_ms=0), True),
        (dict(tests=0), False),
        (dict(tests=None), False),
        (dict(devices=0), False),
        (dict(devices=None), False),
        (dict(tile=None), True),
    ],
)
def test_rows_kept(spark, change, kept):
    assert bool(cleaned(spark, **change)) is kept


@pytest.mark.parametrize(
    "change, score, down, up",
    [
        ({}, 100, False, False),
        (dict(quadkey="1" * 9), 90, False, False),
        (dict(quadkey="1" * 10), 100, False, False),
        (dict(quadkey=" " + "1" * 9 + " "), 90, False, False),
        (dict(avg_d_kbps=1_000_000), 100, False, False),
        (dict(avg_d_kbps=1_000_001), 80, True, False),
        (dict(avg_u_kbps=500_000), 100, False, False),
        (dict(avg_u_kbps=500_001), 80, False, True),
        (dict(avg_d_kbps=1_000_001, avg_u_kbps=500_001), 80, True, True),
        (dict(quadkey="1" * 9, avg_u_kbps=500_001), 70, False, True),
    ],
)
def test_score_and_outliers(spark, change, score, down, up):
    (row,) = cleaned(spark, **change)
    assert (row.data_quality_score, row.is_outlier_download, row.is_outlier_upload) == (score, down, up)


@pytest.mark.parametrize("latency, flagged", [(1000, False), (1001, True)])
def test_high_latency(spark, latency, flagged):
    assert cleaned(spark, avg_lat_ms=latency)[0].is_high_latency is flagged


def test_metrics_and_trimming(spark):
    (row,) = cleaned(spark, quadkey="  0123012301 ", tile=" 2019-03-01_x ", avg_d_kbps=2048, avg_u_kbps=512)
    assert (row.quadkey, row.tile) == ("0123012301", "2019-03-01_x")
    assert (row.download_mbps, row.upload_mbps, row.tests_per_device) == (2.0, 0.5, 1.5)


def test_tabs_are_not_trimmed_and_have_no_location(spark):
    (row,) = cleaned(spark, quadkey="\t0123")
    assert row.quadkey == "\t0123"
    keys = ["\t0123", "0123\n", "0124", "", None, " 0123 ", "1" * 30, "1" * 31]
    df = bronze(spark, *(dict(quadkey=k) for k in keys)).filter(quality.has_location())
    assert [r.quadkey for r in df.collect()] == [" 0123 ", "1" * 30]


def test_extra_columns_pass_and_timestamp_is_fixed(spark):
    stamp = dt.datetime(2024, 5, 6, 7, 8, 9)
    (row,) = clean(bronze(spark, {}).withColumn("source", F.lit("a")), stamp).collect()
    assert row.source == "a" and row.processed_at == stamp


def test_missing_measurements_are_not_flagged(spark):
    df = bronze(spark, dict(avg_d_kbps=None, avg_u_kbps=None, avg_lat_ms=None))
    (row,) = df.select(*(c.alias(n) for n, c in quality.flags().items())).collect()
    assert tuple(row) == (False, False, False)


def test_cleaning_report(spark):
    report = quality.cleaning_report(bronze(spark, {}, dict(tests=0), dict(quadkey=None), {})).first()
    assert tuple(report) == (4, 2, 2, 50.0)
    assert tuple(quality.cleaning_report(bronze(spark, {}).limit(0)).first()) == (0, 0, 0, 0.0)


@pytest.mark.parametrize(
    "tile, year, month",
    [
        (None, "2019", "01"),
        ("", "2019", "01"),
        ("2020", "2019", "01"),
        ("2020-", "2020", "01"),
        ("2020-07", "2020", "01"),
        ("2020-07-", "2020", "07"),
        ("2020-07-01_fixed", "2020", "07"),
        ("not a date", "not ", " d"),
    ],
)
def test_partition_columns(spark, tile, year, month):
    row = add_partition_columns(spark.createDataFrame([(tile,)], "tile string")).first()
    assert (row.partition_year, row.partition_month) == (year, month)


def test_schema_check(spark):
    df = bronze(spark, {})
    assert validate_schema(df.withColumn("more", F.lit(1)))
    with pytest.raises(ValueError, match="Missing required columns.*devices"):
        validate_schema(df.drop("devices"))
    narrow = df.withColumn("tests", F.col("tests").cast("int"))
    assert validate_schema(narrow)
    with pytest.raises(ValueError, match="tests: expected bigint, found int"):
        validate_schema(narrow, check_types=True)
