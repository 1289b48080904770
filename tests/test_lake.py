"""Sources, sinks, the bronze-to-silver job and the incremental job."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from tilelake.operators import build_place_index
from tilelake.operators.analytics import run_statistics, silver_measures
from tilelake.plans import bronze_to_silver, locate, to_silver
from tilelake.runtime import new_table_path, shared_dir
from tilelake.schemas import BRONZE, GAZETTEER, SILVER
from tilelake.sinks import drop_table, read_silver, register_silver, write_silver, write_table
from tilelake.sources import (
    check_bronze,
    file_count,
    freshness,
    land_bronze,
    list_files,
    read_with_fallback,
    require_rows,
    resolve_bronze_path,
    scan_bronze,
    scan_quarter,
    validate_files,
    verify_silver,
)
from tilelake.sources.landing import tile_quarter
from tilelake.streaming import incremental_silver, read_incremental

STAMP = dt.datetime(2024, 1, 1)
TILES = [
    ("0331", "2019-01-01_performance_fixed_tiles", 1024, 512, 10, 5, 2),
    ("1200", "2019-02-01_performance_fixed_tiles", 2048, 1024, 20, 1, 1),
    (" 2130 ", "2020-11-01_performance_mobile_tiles", 4096, 512, 30, 2, 2),
    ("3012", "", 1024, 512, 40, 2, 1),
    ("40", "2019-01-01_x", 1024, 512, 10, 5, 2),
    (None, "2019-01-01_x", 1024, 512, 10, 5, 2),
    ("0331", "2019-01-01_x", 0, 512, 10, 5, 2),
]
PLACES = [("A", "a", "AA", 40.0, -90.0), ("B", "b", "BB", -40.0, 90.0), ("C", "c", "CC", 40.0, 90.0)]


@pytest.fixture()
def bronze_path(spark, tmp_path):
    path = str(tmp_path / "bronze")
    spark.createDataFrame(TILES, BRONZE).repartition(2).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(PLACES, GAZETTEER)


@pytest.fixture(scope="module")
def index(places):
    return build_place_index(places)


def same_rows(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# --- sources ---------------------------------------------------------------------


def test_bronze_paths():
    assert resolve_bronze_path("s3a://lake/bronze") == "s3a://lake/bronze/"
    assert resolve_bronze_path("s3a://lake/bronze/", "2019-q1") == "s3a://lake/bronze/2019-q1/"


def test_scan_bronze(spark, bronze_path, tmp_path):
    assert scan_bronze(spark, bronze_path).count() == len(TILES)
    other = str(tmp_path / "other")
    spark.range(3).write.parquet(other)
    with pytest.raises(ValueError, match="Missing required columns"):
        scan_bronze(spark, other)
    with pytest.raises(RuntimeError, match="No rows found"):
        require_rows(spark.createDataFrame([], BRONZE), "x")


def test_fallback_source(spark, bronze_path):
    first = lambda: spark.read.parquet(bronze_path + "-absent")
    assert read_with_fallback(spark, first, bronze_path).count() == len(TILES)
    assert read_with_fallback(spark, lambda: spark.range(2), bronze_path).count() == 2
    absent = lambda: spark.read.format("shapefile").load(bronze_path)
    assert read_with_fallback(spark, absent, bronze_path).count() == len(TILES)


def test_file_listing(spark, bronze_path):
    listing = list_files(spark, bronze_path)
    names = sorted(n for n in os.listdir(bronze_path) if not n.endswith(".crc"))
    assert sorted(r.path.rsplit("/", 1)[1] for r in listing.collect()) == names
    report = validate_files(listing).first()
    parquet = [n for n in names if n.endswith(".parquet")]
    assert (report.total_objects, report.parquet_files, report.valid) == (len(names), len(parquet), True)
    assert [f.rsplit("/", 1)[1] for f in report.files] == parquet
    assert tuple(file_count(listing).first()) == (len(names), True)


def test_listing_of_a_missing_or_empty_folder(spark, tmp_path):
    for path in (str(tmp_path / "absent"), str(tmp_path)):
        listing = list_files(spark, path)
        report = validate_files(listing).first()
        assert (report.total_objects, report.parquet_files, report.valid, report.files) == (0, 0, False, [])
        assert tuple(file_count(listing).first()) == (0, False)
        assert freshness(listing, STAMP).first().is_fresh is False


def test_validation_names_the_first_ten(spark):
    rows = [(f"f{i:03d}.parquet", 1, STAMP) for i in range(30)] + [("a.txt", 1, STAMP)]
    report = validate_files(spark.createDataFrame(rows, "path string, length long, modificationTime timestamp")).first()
    assert (report.total_objects, report.parquet_files) == (31, 30)
    assert report.files == [f"f{i:03d}.parquet" for i in range(10)]


def test_freshness(spark):
    rows = [("a", 1, STAMP), ("b", 1, STAMP - dt.timedelta(days=9))]
    listing = spark.createDataFrame(rows, "path string, length long, modificationTime timestamp")
    fresh = lambda hours: freshness(listing, STAMP + dt.timedelta(hours=hours)).first().is_fresh
    assert fresh(24) and not fresh(25)
    assert freshness(listing, STAMP + dt.timedelta(hours=48), max_age_hours=48).first().is_fresh


def test_quarter_checks(spark, bronze_path, tmp_path):
    root = str(tmp_path / "root")
    spark.createDataFrame(TILES, BRONZE).write.parquet(f"{root}/2019-q1")
    assert check_bronze(spark, root, "2019-q1") and not check_bronze(spark, root, "2019-q2")
    assert verify_silver(spark, f"{root}/2019-q1")["valid"]
    with pytest.raises(ValueError, match="no parquet files"):
        verify_silver(spark, f"{root}/2019-q2")


def test_landing(spark, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "landed")
    spark.createDataFrame(TILES[:2], BRONZE).coalesce(1).write.parquet(f"{source}/a/b")
    spark.createDataFrame(TILES[2:], BRONZE).coalesce(1).write.parquet(f"{source}/c")
    manifest = land_bronze(spark, source, target)
    assert sorted(r.rows for r in manifest.collect()) == [2, 5]
    landed = spark.read.parquet(target)
    found = {r.quarter: r["count"] for r in landed.groupBy("quarter").count().collect()}
    assert found == {"2019-q1": 5, "2020-q4": 1, "undated": 1}
    with open(f"{source}/c/bad.parquet", "wb") as f:
        f.write(b"not parquet")
    manifest = land_bronze(spark, source, str(tmp_path / "again"), skip_unreadable=True)
    assert sum(r.rows for r in manifest.collect()) == len(TILES)


def test_landing_keeps_and_repeats(spark, tmp_path):
    target, sources = str(tmp_path / "landed"), [str(tmp_path / n) for n in ("raw1", "raw2")]
    for source, rows in zip(sources, (TILES[:2], TILES[2:])):
        spark.createDataFrame(rows, BRONZE).coalesce(1).write.parquet(source)
    for source in (sources[0], sources[1], sources[0], sources[1]):
        land_bronze(spark, source, target)
        landed = spark.read.parquet(target)
    assert landed.count() == len(TILES)
    assert scan_quarter(spark, target, "2020-q4").count() == 1 and scan_quarter(spark, target, None).count() == 7
    assert check_bronze(spark, target, "2020-q4") and not check_bronze(spark, target, "2021-q4")
    plan = scan_quarter(spark, target, "2020-q4")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quarter" in plan


def test_landing_names_damaged_files_wherever_they_sort(spark, tmp_path):
    source = str(tmp_path / "raw")
    spark.createDataFrame(TILES, BRONZE).coalesce(1).write.parquet(source)
    for name in ("a_bad.parquet", "z_bad.parquet"):
        with open(f"{source}/{name}", "wb") as f:
            f.write(b"not parquet")
    manifest = land_bronze(spark, source, str(tmp_path / "landed"), skip_unreadable=True).collect()
    assert sorted(r.source_file.rsplit("/", 1)[1] for r in manifest if not r.landed) == ["a_bad.parquet", "z_bad.parquet"]
    assert sum(r.rows for r in manifest) == len(TILES)


def test_nested_bronze_reads_every_file(spark, tmp_path):
    root = str(tmp_path / "root")
    spark.createDataFrame(TILES[:3], BRONZE).write.parquet(f"{root}/2019-q1/a")
    spark.createDataFrame(TILES[3:], BRONZE).coalesce(1).write.mode("append").parquet(root)
    assert scan_bronze(spark, root).count() == len(TILES)


def test_old_writers_text(spark, tmp_path):
    path = str(tmp_path / "binary")
    rows = spark.createDataFrame(TILES, BRONZE)
    rows.withColumns({c: F.encode(c, "utf-8") for c in ("quadkey", "tile")}).write.parquet(path)
    assert same_rows(rows, scan_bronze(spark, path, binary_as_string=True))


def test_listing_has_empty_and_hidden_files(spark, tmp_path):
    names = ["_SUCCESS", "empty.parquet", "_delta_log/0.json", "a.txt", ".hidden"]
    os.makedirs(tmp_path / "_delta_log")
    for name in names:
        (tmp_path / name).write_bytes(b"" if name in ("_SUCCESS", "empty.parquet") else b"x")
    listing = list_files(spark, str(tmp_path))
    assert sorted(r.path.removeprefix(f"file:{tmp_path}/") for r in listing.collect()) == sorted(names)
    report = validate_files(listing).first()
    assert (report.total_objects, report.parquet_files, report.valid) == (5, 1, True)


def test_rerun_of_a_quarter_replaces_only_its_rows(spark, places, tmp_path):
    root, silver = str(tmp_path / "root"), str(tmp_path / "silver")
    spark.createDataFrame(TILES[:2], BRONZE).write.parquet(f"{root}/2019-q1")
    spark.createDataFrame(TILES[2:4], BRONZE).write.parquet(f"{root}/2020-q4")
    index = build_place_index(places)
    for quarter in ("2019-q1", "2020-q4", "2020-q4", "2019-q1"):
        bronze_to_silver(spark, root, silver, index=index, processed_at=STAMP, quarter=quarter)
        kept = read_silver(spark, silver)
    assert sorted(r.quadkey for r in kept.collect()) == ["0331", "1200", "2130", "3012"]


def test_incremental_stops_at_a_file_without_a_column(spark, bronze_path, index, tmp_path):
    silver, progress = str(tmp_path / "silver"), str(tmp_path / "progress")
    spark.createDataFrame(TILES, BRONZE).drop("tests").write.mode("append").parquet(bronze_path)
    for _ in range(2):
        with pytest.raises(Exception, match="Missing required columns"):
            incremental_silver(spark, bronze_path, silver, progress, index, STAMP).awaitTermination()


def test_incremental_layout_is_the_same_for_every_index(spark, bronze_path, index, tmp_path):
    silver, progress = str(tmp_path / "silver"), str(tmp_path / "progress")
    for limit, tile in ((10**9, "2021-05-01_x"), (0, "2021-06-01_x")):
        extra = spark.createDataFrame([("22", tile, 9, 9, 9, 9, 9)], BRONZE).withColumn("note", F.lit("n"))
        extra.write.mode("append").parquet(bronze_path)
        incremental_silver(spark, bronze_path, silver, progress, index, STAMP, max_broadcast_bytes=limit).awaitTermination()
    found = read_incremental(spark, silver)
    assert found.count() == 6 and found.filter("note = 'n'").count() == 2
    assert all(n.startswith("batch_id=") for n in os.listdir(silver) if n[0] not in "._")


def test_tile_quarters(spark):
    tiles = ["2019-01-31_x", "2019-04-01", "2019-13-01_x", "2019-02-30_x", "x", "", None, " 2019-12-31_x"]
    df = spark.createDataFrame([(t,) for t in tiles], "tile string")
    assert [r[0] for r in df.select(tile_quarter(F.col("tile"))).collect()] == [
        "2019-q1", "2019-q2", "undated", "undated", "undated", "undated", "undated", "2019-q4",
    ]


# --- the job ---------------------------------------------------------------------


def test_bronze_to_silver(spark, bronze_path, places, tmp_path):
    path = str(tmp_path / "silver")
    stats = bronze_to_silver(spark, bronze_path, path, gazetteer=places, processed_at=STAMP)
    silver = read_silver(spark, path)
    assert silver.schema == SILVER
    rows = {r.quadkey: r for r in silver.collect()}
    assert set(rows) == {"0331", "1200", "2130", "3012"}
    assert rows["2130"].partition_year == "2020" and rows["2130"].partition_month == "11"
    assert rows["3012"].partition_month == "01" and rows["0331"].city == "A, a, AA"
    assert {r.processed_at for r in rows.values()} == {STAMP}
    assert (stats.bronze_rows, stats.silver_rows, stats.filtered_rows) == (7, 4, 3)
    assert stats.retention_pct == pytest.approx(400 / 7) and stats.city_success_pct == 100.0
    assert (stats.avg_download_mbps, stats.avg_upload_mbps, stats.avg_latency_ms) == (2.0, 0.625, 25.0)
    assert stats.avg_quality_score == 90.0 and stats.default_partition_rows == 1
    one = run_statistics(scan_bronze(spark, bronze_path), silver).first().asDict()
    assert one == {k: pytest.approx(v) for k, v in vars(stats).items() if k != "duration_sec"}


def test_job_without_gazetteer_and_with_no_valid_row(spark, bronze_path, tmp_path):
    path = str(tmp_path / "silver")
    assert bronze_to_silver(spark, bronze_path, path).city_success_pct == 0.0
    assert {r.city for r in read_silver(spark, path).collect()} == {"Unknown"}
    bad = str(tmp_path / "bad")
    spark.createDataFrame(TILES[4:], BRONZE).write.parquet(bad)
    stats = bronze_to_silver(spark, bad, path)
    assert (stats.silver_rows, stats.retention_pct, stats.avg_quality_score) == (0, 0.0, None)
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], BRONZE).write.parquet(empty)
    with pytest.raises(RuntimeError, match="No rows found"):
        bronze_to_silver(spark, empty, path)


def test_silver_keeps_extra_columns(spark, bronze_path, index):
    silver = to_silver(scan_bronze(spark, bronze_path).withColumn("source", F.lit("s")), index, STAMP)
    assert silver.columns == SILVER.names[:-2] + ["source", "partition_year", "partition_month"]


def test_silver_plan_is_one_narrow_pass(spark, bronze_path, index):
    silver = to_silver(scan_bronze(spark, bronze_path), index, STAMP)
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(avg_d_kbps)" in plan and "Python" not in plan
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the leaves of the broadcast index


def test_filters_on_coordinates_stay_above_the_bit_steps(spark, bronze_path):
    located = locate(scan_bronze(spark, bronze_path), STAMP).filter("latitude > 0 AND tests > 1")
    plan = located._jdf.queryExecution().executedPlan().toString()
    assert plan.count("conv(") == 3
    above, below = plan.split("Generate inline", 1)
    assert "Filter (latitude" in above and re.search(r"Filter .*tests#\d+L > 1", below)


# --- sinks -----------------------------------------------------------------------


def test_partitions_can_be_replaced_one_by_one(spark, bronze_path, index, tmp_path):
    path = str(tmp_path / "silver")
    silver = to_silver(scan_bronze(spark, bronze_path), index, STAMP)
    write_silver(silver, path)
    for _ in range(2):
        write_silver(silver.filter("partition_year = '2020'"), path, replace_partitions=True)
        assert same_rows(silver, read_silver(spark, path))
    write_silver(silver.filter("partition_year = '2020'"), path, rebalance=False)
    assert read_silver(spark, path).count() == 1


def test_partition_pruning(spark, bronze_path, index, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(to_silver(scan_bronze(spark, bronze_path), index, STAMP), path)
    query = read_silver(spark, path).filter("partition_year = '2019' AND partition_month = '02'").select("tests")
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_year" in plan and "ReadSchema: struct<tests:bigint>" in plan
    assert [r.tests for r in query.collect()] == [1]


def test_flat_table(spark, tmp_path):
    path = str(tmp_path / "flat")
    write_table(spark.range(5), path)
    write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_catalog(spark, bronze_path, index, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(to_silver(scan_bronze(spark, bronze_path), index, STAMP), path)
    drop_table(spark, "silver_tiles")
    register_silver(spark, "silver_tiles", path)
    register_silver(spark, "silver_tiles", path)
    count = spark.sql("SELECT count(*) FROM silver_tiles WHERE partition_month = '02'").first()[0]
    assert count == 1
    drop_table(spark, "silver_tiles")
    assert not spark.catalog.tableExists("silver_tiles") and read_silver(spark, path).count() == 4


# --- streaming -------------------------------------------------------------------


@pytest.mark.parametrize("limit", [10**9, 0])
def test_incremental_equals_batch(spark, bronze_path, index, tmp_path, limit):
    silver, progress = str(tmp_path / "silver"), str(tmp_path / "progress")

    def run():
        incremental_silver(
            spark, bronze_path, silver, progress, index, STAMP, max_files=1, max_broadcast_bytes=limit
        ).awaitTermination()

    def batch():
        return to_silver(scan_bronze(spark, bronze_path), index, STAMP)

    run()
    assert same_rows(batch(), read_incremental(spark, silver))
    run()
    assert read_incremental(spark, silver).count() == 4
    spark.createDataFrame([("22", "2021-05-01_x", 9, 9, 9, 9, 9)], BRONZE).write.mode("append").parquet(bronze_path)
    run()
    assert read_incremental(spark, silver).count() == 5
    assert same_rows(batch(), read_incremental(spark, silver))


# --- shared folder ---------------------------------------------------------------


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert spark.sparkContext.getCheckpointDir()
    assert new_table_path(spark, "x") != new_table_path(spark, "x")
    assert new_table_path(spark, "x").startswith(shared_dir(spark))


def test_quarter_of_a_tile_is_read_without_a_date_parser(spark):
    from tilelake.functions import tile_quarter

    days = ["1995-01-31_x", " 1996-12-01", "2020-02-29_f", "2019-02-29_f", "2019-04-31", "2019-13-01", "2019-00-10", "0000-03-01", "2019-1-01", "2019-", "", None, "2019-01-01T", "٢٠١٩-٠١-٠١"]
    rows = spark.createDataFrame([(d,) for d in days], "tile string").select(tile_quarter(F.col("tile")).alias("quarter"))
    known = ["1995-q1", "1996-q4", "2020-q1", "undated", "undated", "undated", "undated", "0-q1", "undated", "undated", "undated", "undated", "2019-q1", "undated"]
    assert [r.quarter for r in rows.collect()] == known
    assert "gettimestamp" not in rows._jdf.queryExecution().executedPlan().toString()


def test_raw_files_of_the_landing_queries_are_as_many_as_cores(spark, monkeypatch):
    import __spark_entry__ as driver

    files = []
    monkeypatch.setattr(driver, "_correct_files", lambda spark, path, corrected: files.append(len(driver._files(spark, path))))
    for name in ("land_corrected", "scan_bronze_mixed"):
        driver.queries()[name](spark, "/root/testdata/sf0.001")
    assert len(files) == 2 and min(files) >= spark.sparkContext.defaultParallelism
