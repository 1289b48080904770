"""File listings as DataFrames: counts, validation, freshness.

Only names, sizes and times are listed; file contents are never read.
"""

from __future__ import annotations

import datetime as dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.runtime import new_table_path
from tilelake.sinks.live import is_live_table, snapshot
from tilelake.sources.bronze import resolve_bronze_path

LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
    ]
)
# Fixed value: how many file names a validation report shows.
SAMPLE_FILES = 10
LISTING_BATCH = 20_000


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path``, empty and hidden ones too; no rows when the path cannot be listed.

    The file system's own recursive iterator is walked and handed to Spark ``LISTING_BATCH`` files at a time, so the
    driver never holds a longer list.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    table, rows = None, []
    try:
        found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(folder, True)
        while found.hasNext():
            status = found.next()
            time = dt.datetime.fromtimestamp(status.getModificationTime() / 1000, dt.timezone.utc)
            rows.append((status.getPath().toString(), status.getLen(), time))
            if len(rows) == LISTING_BATCH:
                table = table or new_table_path(spark, "listing")
                spark.createDataFrame(rows, LISTING).write.mode("append").parquet(table)
                rows = []
    except Py4JJavaError as error:
        if "FileNotFoundException" not in str(error.java_exception):
            raise
    last = spark.createDataFrame(rows, LISTING)
    return last if table is None else spark.read.schema(LISTING).parquet(table).unionByName(last)


def file_count(listing: DataFrame) -> DataFrame:
    """How many files there are, and whether there is any."""
    return listing.agg(
        F.count(F.lit(1)).alias("files"), (F.count(F.lit(1)) > 0).alias("path_exists")
    )


def validate_files(listing: DataFrame) -> DataFrame:
    """One row: all files, parquet files, whether there is any, and the first names.

    The names come from a top-k, so no task ever holds the whole listing.
    """
    is_parquet = F.endswith("path", F.lit(".parquet"))
    no_name = F.lit(None).cast("string")
    counts = listing.agg(
        F.count(F.lit(1)).alias("total_objects"),
        F.count_if(is_parquet).alias("parquet_files"),
        F.first(no_name).alias("path"),
    )
    first_names = (
        listing.filter(is_parquet)
        .orderBy("path")
        .limit(SAMPLE_FILES)
        .select(F.lit(0).cast("long").alias("total_objects"), F.lit(0).cast("long").alias("parquet_files"), "path")
    )
    return counts.unionByName(first_names).agg(
        F.sum("total_objects").alias("total_objects"),
        F.sum("parquet_files").alias("parquet_files"),
        (F.sum("parquet_files") > 0).alias("valid"),
        F.sort_array(F.collect_list("path")).alias("files"),
    )


def freshness(listing: DataFrame, now: dt.datetime, max_age_hours: int = 24) -> DataFrame:
    """Newest modification time and whether it is at most ``max_age_hours`` old."""
    newest = F.max("modificationTime")
    limit = F.lit(now) - F.make_interval(hours=F.lit(max_age_hours))
    return listing.agg(newest.alias("newest"), F.coalesce(newest >= limit, F.lit(False)).alias("is_fresh"))


def check_bronze(spark: SparkSession, root: str, quarter: str) -> bool:
    """Whether the quarter's bronze folder, or its partition of a landed table, holds any file."""
    if is_live_table(spark, root):
        return not snapshot(spark, root).filter(F.col("live") & (F.col("part") == quarter)).isEmpty()
    places = resolve_bronze_path(root, quarter), resolve_bronze_path(root, f"quarter={quarter}")
    return any(file_count(list_files(spark, p)).first()["path_exists"] for p in places)


def verify_silver(spark: SparkSession, path: str) -> dict:
    """The validation report of a silver table; raises when it has no parquet file."""
    report = validate_files(list_files(spark, path)).first().asDict()
    if not report["valid"]:
        raise ValueError(f"Validation failed: no parquet files found in {path}")
    return report
