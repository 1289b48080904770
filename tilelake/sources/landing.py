"""Landing raw files in the bronze table, with lineage."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.functions import tile_quarter
from tilelake.functions.text import UNDATED
from tilelake.runtime import checkpointed
from tilelake.schemas import BRONZE
from tilelake.sinks.live import load, snapshot
from tilelake.sources.bronze import LANDED, read_landed
from tilelake.sources.footers import FOOTER, footers, list_parquet, merged_schema, missing_columns, schemas_of

__all__ = ["UNDATED", "land_bronze", "landed_files", "read_landed", "tile_quarter"]


def land_bronze(
    spark: SparkSession,
    source: str,
    target: str,
    skip_unreadable: bool = False,
    schema: T.StructType | None = None,
    rebalance: bool = True,
    withdraw_missing: bool = False,
) -> DataFrame:
    """Copy all parquet files below ``source`` into the table ``target`` and return this run's manifest:
    source file, rows, whether the file was landed, and why not.

    A file is replaced as a whole: landing it again, changed, shorter or empty, leaves exactly its new rows, and other files stay.
    With ``withdraw_missing`` files of an earlier landing from below ``source`` that are no longer there lose their rows as well. The table is
    partitioned by quarter within each landing and is read with ``read_landed``; ``source_file`` keeps each row's origin. Rows
    are written first and made live by one last file, so a run that stops leaves the table as it was.

    Every file's footer is checked before: ``skip_unreadable`` leaves out damaged files and files without a required column instead of
    failing, and the manifest names them; what they had landed before stays. Files are read with ``schema`` (default: the columns of all
    files). Files that already hold one quarter each can be landed without a shuffle: ``rebalance=False``.
    """
    files = list_parquet(spark, source)
    # kept as a table: the footers decide what is read, written and replaced
    found = footers(spark, files).select(*(f.split()[0] for f in FOOTER.split(", "))).cache()
    try:
        fits = _usable(found, skip_unreadable)
        schema = schema or merged_schema(fits)
        raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").schema(schema or BRONZE)
        raw = raw.option("ignoreCorruptFiles", str(skip_unreadable).lower()).parquet(source)
        raw = raw.select("*", F.col("_metadata.file_path").alias("source_file"))
        if skip_unreadable:
            raw = raw.join(found.select(F.col("path").alias("source_file")).join(fits.select(F.col("path").alias("source_file")), "source_file", "left_anti"), "source_file", "left_anti")
            raw = raw.select(*schema.names, "source_file")
        quarter = tile_quarter(F.col("tile")) if "tile" in schema.names else F.lit(UNDATED)
        ended = fits.select(F.col("path").alias("unit"))
        under = _under(source)

        def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
            again = old.join(ended, "unit", "left_semi")
            if not withdraw_missing:
                return again
            listed = found.select(F.col("path").alias("unit"))
            return again.unionByName(old.filter(under).join(listed, "unit", "left_anti").select(*old.columns))

        load(raw.drop("quarter").withColumn("quarter", quarter), target, LANDED, replaced, rebalance)
        usable = fits.select(F.col("path"), F.lit(True).alias("fits"))
        manifest = found.join(usable, "path", "left").select(
            F.col("path").alias("source_file"),
            F.when(F.col("fits"), F.col("rows")).otherwise(F.lit(0)).cast("long").alias("rows"),
            F.coalesce("fits", F.lit(False)).alias("landed"),
            F.when(F.col("fits").isNull(), F.coalesce("problem", F.lit("a required column is missing"))).alias("problem"),
        )
        # the files it was taken from may go
        return checkpointed(manifest)
    finally:
        found.unpersist()


def _usable(found: DataFrame, skip: bool) -> DataFrame:
    """Footers of the files to land; raises on the first that cannot be, unless they are to be skipped."""
    bad = found.filter(F.col("problem").isNotNull())
    first = [] if skip else bad.orderBy("path").limit(1).collect()
    if first:
        raise ValueError(f"{first[0]['path']} cannot be read: {first[0]['problem']}")
    readable = found.filter(F.col("problem").isNull())
    if not skip:
        return readable
    lacking = [json.dumps([list(c) for c in s.columns]) for s in schemas_of(readable) if missing_columns(s)]
    return readable.filter(~F.col("columns").isin(lacking)) if lacking else readable


def _under(source: str):
    """Whether a unit's file lies below ``source``; schemes of local paths are written in different ways."""
    plain = lambda c: F.regexp_replace(c, "^file:/+|^/+", "/")
    return F.startswith(plain(F.col("unit")), F.concat(plain(F.lit(source.rstrip("/"))), F.lit("/")))


def landed_files(spark: SparkSession, target: str) -> DataFrame:
    """Every live file of a landed table with its rows by quarter."""
    live = snapshot(spark, target).filter("live")
    return live.select(F.col("unit").alias("source_file"), F.col("part").alias("quarter"), "rows", "batch_id")
