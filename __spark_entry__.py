"""

Bronze tiles are derived from ``lineitem`` and written once per application and data
folder, as are the place index and a silver table, the way a lake keeps them: a query
then reads the table it would read in production. ``write_silver_roundtrip``,
``write_flat_roundtrip``, ``land_bronze`` and ``incremental_silver`` run their whole
write on each call, and ``place_index`` builds the index on each call.
"""

from __future__ import annotations

import datetime as dt
import functools
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from tilelake import fixtures  # noqa: E402
from tilelake.functions import place_preference, quarter_of, tile_quarter, with_centers  # noqa: E402
from tilelake.operators import (  # noqa: E402
    analytics,
    boxes,
    geocode,
    layout,
    polygons,
    quality,
)
from tilelake.plans import bronze_to_silver, locate, read_gold, refresh_gold, to_silver, with_kept_cities  # noqa: E402
from tilelake.runtime import new_table_path  # noqa: E402
from tilelake.schemas import BRONZE, SILVER  # noqa: E402
from tilelake.sinks import read_silver, register_silver, write_table  # noqa: E402
from tilelake.sources import (  # noqa: E402
    file_count,
    freshness,
    land_bronze,
    list_files,
    read_landed,
    read_with_fallback,
    scan_bronze,
    scan_quarter,
    schema_report,
    validate_files,
)
from tilelake.streaming import incremental_silver, read_incremental  # noqa: E402

try:  # the only guard for a copy of the library without these operators
    import corpus_pipeline
    from tilelake.llm import queries as llm_queries
except ImportError as error:
    print(f"without the operators of tilelake.llm: {error}", file=sys.stderr)
    corpus_pipeline = llm_queries = None

_SMALL = "/root/testdata/sf0.001"
PROCESSED_AT = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
_kept: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable):
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), what)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def _bronze_path(spark, sf_dir) -> str:
    def make():
        path = new_table_path(spark, "bronze")
        fixtures.tiles(spark, sf_dir).write.parquet(path)
        return path

    return _once(spark, sf_dir, "bronze", make)


def _bronze(spark, sf_dir) -> DataFrame:
    return scan_bronze(spark, _bronze_path(spark, sf_dir))


def _index(spark, sf_dir) -> geocode.PlaceIndex:
    return _once(
        spark, sf_dir, "index", lambda: geocode.build_place_index(fixtures.gazetteer(spark, sf_dir))
    )


def _silver_path(spark, sf_dir) -> str:
    def make():
        path = new_table_path(spark, "silver")
        bronze_to_silver(
            spark, _bronze_path(spark, sf_dir), path, index=_index(spark, sf_dir), processed_at=PROCESSED_AT
        )
        return path

    return _once(spark, sf_dir, "silver", make)


def _silver(spark, sf_dir) -> DataFrame:
    """Silver rows computed from bronze."""
    return to_silver(_bronze(spark, sf_dir), _index(spark, sf_dir), PROCESSED_AT)


def _stored_silver(spark, sf_dir) -> DataFrame:
    return read_silver(spark, _silver_path(spark, sf_dir))


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _comparable(silver: DataFrame) -> DataFrame:
    """Silver rows without the run's timestamp; coordinates to 6 digits."""
    return _rounded(silver.select(*SILVER.names).drop("processed_at"), "latitude", "longitude")


# --- sources ---------------------------------------------------------------------


def q_list_files(spark, sf_dir):
    name = F.element_at(F.split("path", "/"), -1)
    return _listed(spark, sf_dir).select(
        name.alias("file_name"), F.endswith("path", F.lit(".parquet")).alias("is_parquet"), (F.col("length") > 0).alias("has_bytes")
    )


def q_file_count(spark, sf_dir):
    return file_count(_listed(spark, sf_dir))


def _listed(spark, sf_dir) -> DataFrame:
    """The listing without the checksum and marker files that other writers may leave beside the tables."""
    return list_files(spark, sf_dir).filter(~F.element_at(F.split("path", "/"), -1).rlike("^[._]"))


def q_validate_files(spark, sf_dir):
    names = F.transform("files", lambda f: F.element_at(F.split(f, "/"), -1))
    return validate_files(_listed(spark, sf_dir)).withColumn("files", F.array_join(names, ","))


def q_freshness(spark, sf_dir):
    """Freshness 24 and 25 hours after the newest file."""
    listing = _listed(spark, sf_dir)
    newest = listing.agg(F.max(F.unix_micros("modificationTime"))).first()[0]
    at = lambda hours: dt.datetime.fromtimestamp(newest / 1e6, dt.timezone.utc) + dt.timedelta(hours=hours)
    checks = (freshness(listing, at(h)).select(F.lit(h).alias("hours"), "is_fresh") for h in (24, 25))
    return functools.reduce(DataFrame.unionByName, checks)


def q_read_with_fallback(spark, sf_dir):
    """A reader that this session does not have, and the bronze folder behind it."""
    return read_with_fallback(spark, lambda: spark.read.format("shapefile").load(sf_dir), _bronze_path(spark, sf_dir))


def _by_quarter(landed: DataFrame) -> DataFrame:
    return landed.groupBy("quarter").agg(F.count(F.lit(1)).alias("rows"), F.sum("tests").alias("total_tests"))


def q_land_bronze(spark, sf_dir):
    target = new_table_path(spark, "landed")
    land_bronze(spark, _bronze_path(spark, sf_dir), target)
    return (
        read_landed(spark, target)
        .groupBy("quarter")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("tests").alias("total_tests"),
            F.count("source_file").alias("rows_with_source"),
        )
    )


def q_landing_manifest(spark, sf_dir):
    manifest = land_bronze(spark, _bronze_path(spark, sf_dir), new_table_path(spark, "landed"))
    is_parquet = F.endswith("source_file", F.lit(".parquet"))
    return manifest.agg(F.sum("rows").alias("rows"), F.bool_and(is_parquet).alias("only_parquet"))


def _quarter(tile="tile"):
    return tile_quarter(F.col(tile))


def q_land_two_quarters(spark, sf_dir):
    """One quarter, then all others, then the first again, each twice: nothing is lost and nothing doubled."""
    target, sources = new_table_path(spark, "landed"), []
    for rows in (_quarter() == "1995-q1", _quarter() != "1995-q1"):
        sources.append(new_table_path(spark, "raw"))
        _bronze(spark, sf_dir).filter(rows).write.parquet(sources[-1])
    for source in (sources[0], sources[0], sources[1], sources[1], sources[0]):
        land_bronze(spark, source, target)
    return _by_quarter(read_landed(spark, target))


def _hadoop(spark, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _files(spark, path: str) -> list:
    system, folder = _hadoop(spark, path)
    return sorted((s.getPath() for s in system.listStatus(folder) if s.getPath().getName().endswith(".parquet")), key=lambda p: p.getName())


def _file_number(spark, least: int) -> int:
    """How many files to write, so that every core writes some of them: a fixed few would each grow with the input."""
    return max(least, spark.sparkContext.defaultParallelism)


def _correct_files(spark, path: str, corrected: DataFrame) -> None:
    """Put other rows into the files of ``path``, which keep their names."""
    old, new_path = _files(spark, path), new_table_path(spark, "corrected")
    corrected.repartition(len(old)).write.parquet(new_path)
    system, _ = _hadoop(spark, path)
    for name, file in zip(old, _files(spark, new_path), strict=True):
        system.delete(name, False)
        if not system.rename(file, name):
            raise OSError(f"{file} cannot be moved")


def q_land_corrected(spark, sf_dir):
    """Files with wrong and too many rows are landed, corrected and landed again; others are withdrawn, others stay."""
    raw, target = new_table_path(spark, "raw"), new_table_path(spark, "landed")
    tiles, early = _bronze(spark, sf_dir), F.coalesce(F.col("tile") < "1995", F.lit(False))
    wrong = tiles.withColumn("tests", F.col("tests") + 7).unionByName(tiles).filter(early)
    wrong.repartition(_file_number(spark, 3)).write.parquet(f"{raw}/early")
    tiles.filter(~early).write.parquet(f"{raw}/late")
    tiles.sample(0.5, 1).write.parquet(f"{raw}/mistaken")
    land_bronze(spark, raw, target)
    _correct_files(spark, f"{raw}/early", tiles.filter(early))
    system, folder = _hadoop(spark, f"{raw}/mistaken")
    system.delete(folder, True)
    land_bronze(spark, raw, target, withdraw_missing=True)
    return _by_quarter(read_landed(spark, target))


def q_scan_landed_quarter(spark, sf_dir):
    target = new_table_path(spark, "landed")
    land_bronze(spark, _bronze_path(spark, sf_dir), target)
    return scan_quarter(spark, target, "1995-q2").select(*BRONZE.names)


def _quarter_folders(spark, sf_dir) -> str:
    """All bronze rows, each quarter's in files of a plain folder of its own."""

    def make():
        root, parts = new_table_path(spark, "nested"), new_table_path(spark, "parts")
        tiles = _bronze(spark, sf_dir).withColumn("quarter", _quarter())
        tiles.repartition("quarter").write.partitionBy("quarter").parquet(parts)
        system, folder = _hadoop(spark, parts)
        for status in system.listStatus(folder):
            if status.isDirectory():
                target = _hadoop(spark, f"{root}/{status.getPath().getName().partition('=')[2]}/tiles")[1]
                system.mkdirs(target.getParent())
                if not system.rename(status.getPath(), target):
                    raise OSError(f"{status.getPath()} cannot be moved")
        return root

    return _once(spark, sf_dir, "nested", make)


def q_scan_bronze_nested(spark, sf_dir):
    return scan_bronze(spark, _quarter_folders(spark, sf_dir))


def q_scan_bronze_mixed(spark, sf_dir):
    """Files in the root, in plain folders, in partitions and in a landed table that had a correction, side by side; narrow
    integers in some of them."""
    root, raw = new_table_path(spark, "mixed"), new_table_path(spark, "raw")
    tiles = _bronze(spark, sf_dir).withColumn("_part", F.pmod(F.xxhash64("quadkey", "tile"), F.lit(4)))
    some = lambda k: tiles.filter(F.col("_part") == k).drop("_part")
    some(0).repartition(_file_number(spark, 2)).write.parquet(raw)
    land_bronze(spark, raw, f"{root}/landed")
    _correct_files(spark, raw, some(0))
    land_bronze(spark, raw, f"{root}/landed")
    some(1).withColumn("quarter", _quarter()).repartition("quarter").write.partitionBy("quarter").parquet(f"{root}/by_quarter")
    some(2).write.parquet(f"{root}/plain/folder")
    narrow = {c: F.col(c).cast("int") for c in ("avg_lat_ms", "tests", "devices")}
    some(3).withColumns(narrow).write.mode("append").parquet(root)
    return scan_bronze(spark, root).select(*BRONZE.names)


def q_schema_report(spark, sf_dir):
    """Rows by the required columns that their files lack."""
    root = new_table_path(spark, "schemas")
    part = F.pmod(F.col("avg_d_kbps"), F.lit(3))
    tiles = _bronze(spark, sf_dir)
    tiles.filter(part == 0).write.parquet(f"{root}/whole")
    tiles.filter(part == 1).drop("devices", "tests").write.parquet(f"{root}/narrow")
    tiles.filter((part == 2) | part.isNull()).drop("devices").write.parquet(f"{root}/old")
    found = schema_report(spark, root).groupBy(F.array_join("missing", ",").alias("missing"))
    return found.agg(F.sum("rows").alias("rows"), F.max("damaged").alias("damaged"))


# --- row operators ---------------------------------------------------------------


def q_filter(predicate):
    return lambda spark, sf_dir: _bronze(spark, sf_dir).filter(predicate())


def q_flags(spark, sf_dir):
    return _bronze(spark, sf_dir).select(
        "avg_d_kbps", "avg_u_kbps", "avg_lat_ms", *(c.alias(n) for n, c in quality.flags().items())
    )


def q_quality_score(spark, sf_dir):
    return _bronze(spark, sf_dir).select(
        "quadkey", "avg_d_kbps", "avg_u_kbps", quality.quality_score().alias("data_quality_score")
    )


def q_derived_metrics(spark, sf_dir):
    rows = _bronze(spark, sf_dir).filter(quality.is_clean())
    return rows.select(
        "avg_d_kbps", "avg_u_kbps", "tests", "devices", *(c.alias(n) for n, c in quality.derived_metrics().items())
    )


def q_centers(**how):
    def run(spark, sf_dir):
        keys = _bronze(spark, sf_dir).select(F.trim("quadkey").alias("quadkey"))
        return _rounded(with_centers(keys, **how), "latitude", "longitude")

    return run


def q_place_preference(spark, sf_dir):
    rows = fixtures.addresses(*(fixtures.table(spark, sf_dir, t) for t in ("supplier", "nation", "region")))
    place = place_preference(*(F.col(c) for c in ("city", "town", "village", "state", "country")))
    return rows.select("s_suppkey", place.alias("place"))


def q_quarter_of(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "orders").select("o_orderkey", quarter_of(F.col("o_orderdate")).alias("quarter"))


# --- places ----------------------------------------------------------------------


def q_place_index(spark, sf_dir):
    """What each place's own spot is looked up as, and the share of the globe that leaves cover."""
    gazetteer = fixtures.gazetteer(spark, sf_dir)
    index = geocode.build_place_index(gazetteer)
    leaves = index.places.select("level", "cell_x", "cell_y").distinct()
    covered = leaves.agg(F.sum(F.pow(F.lit(4.0), -F.col("level"))).alias("covered")).first()["covered"]
    spots = gazetteer.select(F.col("glat").alias("latitude"), F.col("glon").alias("longitude")).distinct()
    return geocode.with_cities(spots, index).select("latitude", "longitude", "city", F.lit(covered).alias("covered"))


def q_nearest_city(spark, sf_dir):
    return _silver(spark, sf_dir).select("quadkey", "tile", "city", "city_lookup_success")


def q_nearest_city_shuffled(spark, sf_dir):
    located = locate(_bronze(spark, sf_dir), PROCESSED_AT)
    cities = geocode.with_cities(located, _index(spark, sf_dir), max_broadcast_bytes=0)
    return cities.select("quadkey", "tile", "city", "city_lookup_success")


def q_nearest_city_dense(spark, sf_dir):
    """Places that crowd around one point: every coordinate is drawn to within some 100 m of it."""
    places = fixtures.gazetteer(spark, sf_dir)
    crowded = places.withColumns({"glat": 40 + F.col("glat") / 100_000, "glon": -90 + F.col("glon") / 100_000})
    index = geocode.build_place_index(places.unionByName(crowded))
    located = locate(_bronze(spark, sf_dir), PROCESSED_AT)
    return geocode.with_cities(located, index).select("quadkey", "tile", "city", "city_lookup_success")


def q_city_unavailable(spark, sf_dir):
    return to_silver(_bronze(spark, sf_dir), None, PROCESSED_AT).select("quadkey", "city", "city_lookup_success")


def q_tiles_in_box(**how):
    def run(spark, sf_dir):
        located = locate(_bronze(spark, sf_dir), PROCESSED_AT)
        return boxes.tiles_in_boxes(located, fixtures.boxes(fixtures.gazetteer(spark, sf_dir)), **how)

    return run


def q_tiles_in_polygons(**how):
    def run(spark, sf_dir):
        located = locate(_bronze(spark, sf_dir), PROCESSED_AT)
        return polygons.tiles_in_polygons(located, fixtures.polygons(fixtures.gazetteer(spark, sf_dir)), **how)

    return run


# --- analytics -------------------------------------------------------------------


def _city_stats(spark, sf_dir):
    return analytics.city_stats(_silver(spark, sf_dir), digits=6)


def q_city_stats_sample(spark, sf_dir):
    columns = ["quadkey", "tile", "avg_d_kbps", "avg_u_kbps", "avg_lat_ms", "tests", "devices", "city"]
    sample = analytics.first_rows(_silver(spark, sf_dir).select(*columns), 100)
    return analytics.top_cities(analytics.city_stats(sample, digits=6), "avg_download_kbps", 20)


def q_city_dict_agg(spark, sf_dir):
    return _rounded(analytics.city_speed(_stored_silver(spark, sf_dir)), "avg_download_mbps")


def q_top10_cities_mbps(spark, sf_dir):
    return _rounded(
        analytics.top_cities(analytics.city_speed(_stored_silver(spark, sf_dir)), "avg_download_mbps", 10),
        "avg_download_mbps",
    )


_NUMBERS = ["avg_d_kbps", "avg_u_kbps", "avg_lat_ms", "tests", "devices"]
_QUALITY = ["data_quality_score", "is_outlier_download", "is_outlier_upload", "city_lookup_success"]


def q_describe_tiles(spark, sf_dir):
    return _rounded(analytics.describe_numeric(_bronze(spark, sf_dir), _NUMBERS), "mean", "stddev")


def q_describe_text(spark, sf_dir):
    return analytics.describe_text(_bronze(spark, sf_dir), ["quadkey", "tile"])


def q_describe_quality(spark, sf_dir):
    return _rounded(analytics.describe_flags(_stored_silver(spark, sf_dir), _QUALITY), "mean", "stddev")


def q_run_statistics(spark, sf_dir):
    measures = ["retention_pct", "avg_quality_score", "city_success_pct", "avg_download_mbps", "avg_upload_mbps", "avg_latency_ms"]
    return _rounded(analytics.run_statistics(_bronze(spark, sf_dir), _silver(spark, sf_dir)), *measures)


def q_silver_sample(spark, sf_dir):
    columns = [
        "quadkey", "latitude", "longitude", "city", "download_mbps", "upload_mbps", "avg_lat_ms",
        "data_quality_score", "partition_year", "partition_month",
    ]
    return _rounded(analytics.first_rows(_stored_silver(spark, sf_dir).select(*columns), 10), "latitude", "longitude")


def q_gold_city_month(spark, sf_dir):
    # the weighted sums are exact in binary, so the means need no rounding to compare
    return analytics.gold_city_month(_stored_silver(spark, sf_dir))


# --- sinks and streaming ---------------------------------------------------------


def q_write_silver_roundtrip(spark, sf_dir):
    path = new_table_path(spark, "silver")
    bronze_to_silver(spark, _bronze_path(spark, sf_dir), path, index=_index(spark, sf_dir), processed_at=PROCESSED_AT)
    return _comparable(read_silver(spark, path))


def q_write_flat_roundtrip(spark, sf_dir):
    path = new_table_path(spark, "flat")
    tiles = with_centers(_bronze(spark, sf_dir), lenient=True)
    write_table(geocode.with_cities(tiles, _index(spark, sf_dir)), path, fmt="parquet")
    return _rounded(spark.read.parquet(path).drop("city_lookup_success"), "latitude", "longitude")


def q_scan_silver_pruned(spark, sf_dir):
    silver = _stored_silver(spark, sf_dir)
    return (
        silver.filter((F.col("partition_year") == "1995") & (F.col("partition_month") <= "03"))
        .groupBy("partition_year", "partition_month")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("tests").alias("total_tests"))
    )


def q_incremental_silver(spark, sf_dir):
    silver_path = new_table_path(spark, "incremental")
    incremental_silver(
        spark,
        _bronze_path(spark, sf_dir),
        silver_path,
        new_table_path(spark, "progress"),
        _index(spark, sf_dir),
        PROCESSED_AT,
    ).awaitTermination()
    return _comparable(read_incremental(spark, silver_path))


def q_incremental_two_runs(spark, sf_dir):
    """Two runs with new files between them, the second with an index above the broadcast limit."""
    bronze, silver, progress = (new_table_path(spark, n) for n in ("growing", "incremental", "progress"))
    early = F.col("tile") < "1995"
    for rows, limit in ((early, geocode.MAX_BROADCAST_BYTES), (~early | early.isNull(), 0)):
        _bronze(spark, sf_dir).filter(rows).write.mode("append").parquet(bronze)
        incremental_silver(
            spark, bronze, silver, progress, _index(spark, sf_dir), PROCESSED_AT, max_broadcast_bytes=limit
        ).awaitTermination()
    return _comparable(read_incremental(spark, silver))


def q_incremental_two_sources(spark, sf_dir):
    """Two bronze folders feed one table; the progress of one is lost and its files are loaded anew in place of its rows."""
    silver = new_table_path(spark, "incremental")
    early = F.coalesce(F.col("tile") < "1995", F.lit(False))
    sources = []
    for rows in (early, ~early):
        sources.append(new_table_path(spark, "growing"))
        _bronze(spark, sf_dir).filter(rows).write.parquet(sources[-1])
    for source, restart in ((sources[0], False), (sources[1], False), (sources[0], True)):
        progress = new_table_path(spark, "progress")
        incremental_silver(
            spark, source, silver, progress, _index(spark, sf_dir), PROCESSED_AT, restart=restart
        ).awaitTermination()
    return _comparable(read_incremental(spark, silver))


def q_rerun_quarter(spark, sf_dir):
    """A quarter, all of them, then the undated tiles and the first again: each load replaces its own rows only."""
    root, silver = _quarter_folders(spark, sf_dir), new_table_path(spark, "silver")
    for quarter in ("1995-q1", None, "undated", "1995-q1"):
        bronze_to_silver(spark, root, silver, index=_index(spark, sf_dir), processed_at=PROCESSED_AT, quarter=quarter)
    return _comparable(read_silver(spark, silver))


def q_catalog_silver(spark, sf_dir):
    """The table by its name in the catalog, registered before and after a quarter was loaded again."""
    root, silver = _quarter_folders(spark, sf_dir), new_table_path(spark, "silver")
    name = f"silver_{silver.rpartition('-')[2]}"
    for quarter in (None, "1995-q1"):
        bronze_to_silver(spark, root, silver, index=_index(spark, sf_dir), processed_at=PROCESSED_AT, quarter=quarter)
        register_silver(spark, name, silver)
    return _comparable(spark.table(name))


def q_gold_kept_up(spark, sf_dir):
    """Gold after two micro-batches of one folder, then of another whose progress is lost, each time from what is new."""
    silver, gold = new_table_path(spark, "silver"), new_table_path(spark, "gold")
    early = F.coalesce(F.col("tile") < "1995", F.lit(False))
    sources = []
    for rows in (early, ~early):
        sources.append(new_table_path(spark, "growing"))
        _bronze(spark, sf_dir).filter(rows).write.parquet(sources[-1])
    for source, restart in ((sources[0], False), (sources[1], False), (sources[0], True)):
        incremental_silver(
            spark, source, silver, new_table_path(spark, "progress"), _index(spark, sf_dir), PROCESSED_AT, restart=restart
        ).awaitTermination()
        refresh_gold(spark, silver, gold)
    return read_gold(spark, gold)


def q_nearest_city_kept(spark, sf_dir):
    """Cities by the kept table of quadkeys: filled from early tiles, extended by the quadkeys that only all tiles have."""
    located, kept = locate(_bronze(spark, sf_dir), PROCESSED_AT), new_table_path(spark, "quadkeys")
    with_kept_cities(located.filter(F.col("tile") < "1995"), _index(spark, sf_dir), kept)
    return with_kept_cities(located, _index(spark, sf_dir), kept).select("quadkey", "tile", "city", "city_lookup_success")


def entry(spark: SparkSession) -> DataFrame:
    """Top 30 cities by mean download speed: scan, clean, locate, look up, aggregate."""
    return queries()["top_cities_download"](spark, _SMALL)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    llm = {} if llm_queries is None else {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    return llm | {
        "scan_bronze": _bronze,
        "list_files": q_list_files,
        "file_count": q_file_count,
        "validate_files": q_validate_files,
        "freshness": q_freshness,
        "land_bronze": q_land_bronze,
        "landing_manifest": q_landing_manifest,
        "land_two_quarters": q_land_two_quarters,
        "land_corrected": q_land_corrected,
        "scan_landed_quarter": q_scan_landed_quarter,
        "scan_bronze_nested": q_scan_bronze_nested,
        "scan_bronze_mixed": q_scan_bronze_mixed,
        "schema_report": q_schema_report,
        "read_with_fallback": q_read_with_fallback,
        "trim_keys": lambda spark, d: quality.trim_keys(_bronze(spark, d)).select("quadkey", "tile"),
        "filter_quadkey": q_filter(quality.has_usable_quadkey),
        "filter_speed": q_filter(quality.has_positive_speed),
        "filter_latency": q_filter(quality.has_valid_latency),
        "filter_counts": q_filter(quality.has_positive_counts),
        "filter_bad_quadkey": q_filter(quality.has_location),
        "flags": q_flags,
        "quality_score": q_quality_score,
        "derived_metrics": q_derived_metrics,
        "clean": lambda spark, d: quality.clean(_bronze(spark, d), PROCESSED_AT).drop("processed_at"),
        "cleaning_report": lambda spark, d: _rounded(quality.cleaning_report(_bronze(spark, d)), "removal_pct"),
        "partition_columns": lambda spark, d: layout.add_partition_columns(
            quality.trim_keys(_bronze(spark, d)).select("tile")
        ),
        "quarter_of": q_quarter_of,
        "place_preference": q_place_preference,
        "quadkey_center": q_centers(),
        "quadkey_center_lenient": q_centers(lenient=True),
        "quadkey_center_mercator": q_centers(projection="mercator"),
        "place_index": q_place_index,
        "nearest_city": q_nearest_city,
        "nearest_city_shuffled": q_nearest_city_shuffled,
        "nearest_city_dense": q_nearest_city_dense,
        "city_unavailable": q_city_unavailable,
        "tiles_in_box": q_tiles_in_box(),
        "tiles_in_box_shuffled": q_tiles_in_box(max_broadcast_bytes=0),
        "tiles_in_polygons": q_tiles_in_polygons(),
        "tiles_in_polygons_shuffled": q_tiles_in_polygons(max_broadcast_bytes=0),
        "city_stats": _city_stats,
        "city_stats_sample": q_city_stats_sample,
        "city_dict_agg": q_city_dict_agg,
        "top_cities_download": lambda spark, d: analytics.top_cities(_city_stats(spark, d), "avg_download_kbps", 30),
        "top_cities_tiles": lambda spark, d: analytics.top_cities(_city_stats(spark, d), "tile_count", 30),
        "top10_cities_mbps": q_top10_cities_mbps,
        "describe_tiles": q_describe_tiles,
        "describe_text": q_describe_text,
        "describe_quality": q_describe_quality,
        "quality_histogram": lambda spark, d: analytics.quality_histogram(
            quality.clean(_bronze(spark, d), PROCESSED_AT)
        ),
        "run_statistics": q_run_statistics,
        "silver_sample": q_silver_sample,
        "gold_city_month": q_gold_city_month,
        "write_silver_roundtrip": q_write_silver_roundtrip,
        "write_flat_roundtrip": q_write_flat_roundtrip,
        "scan_silver_pruned": q_scan_silver_pruned,
        "incremental_silver": q_incremental_silver,
        "incremental_two_runs": q_incremental_two_runs,
        "incremental_two_sources": q_incremental_two_sources,
        "rerun_quarter": q_rerun_quarter,
        "catalog_silver": q_catalog_silver,
        "gold_kept_up": q_gold_kept_up,
        "nearest_city_kept": q_nearest_city_kept,
    }


def oracle_sql() -> dict[str, str]:
    """The same results in SQL for DuckDB, for every key that SQL can express."""
    llm = {} if llm_queries is None else llm_queries.STATEMENTS
    return llm | oracle.statements()
