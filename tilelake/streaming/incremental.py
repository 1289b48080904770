"""Incremental bronze-to-silver: each new bronze file is processed exactly once."""

from __future__ import annotations

import datetime as dt
import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tilelake.operators.geocode import MAX_BROADCAST_BYTES, PlaceIndex
from tilelake.plans.silver import to_silver
from tilelake.sinks.live import path_exists, snapshot
from tilelake.sinks.silver import read_with_extras, write_batch
from tilelake.sources.bronze import read_files

# Bytes of the files of one micro-batch; their names pass through the driver.
MAX_BYTES = 64 << 30
_FILES = "path string, modificationTime timestamp, length long, content binary"
_IDENTITY = "tilelake-stream"


def _new_files(spark: SparkSession, path: str, max_files: int | None, max_bytes: int) -> DataFrame:
    """A stream of new parquet files, one row each; nothing of a file is read."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.parquet")
    reader = reader.option("recursiveFileLookup", "true")
    limit = ("maxBytesPerTrigger", max_bytes) if max_files is None else ("maxFilesPerTrigger", max_files)
    return reader.option(*limit).load(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))


def stream_of(bronze_path: str) -> str:
    """The name of the stream over a bronze folder: the same for every way to write a local path."""
    plain = re.sub("^file:/+", "/", bronze_path.rstrip("/"))
    return "s" + hashlib.sha256(plain.encode()).hexdigest()[:16]


def _identity(spark: SparkSession, bronze_path: str, silver_path: str, progress: str, restart: bool) -> tuple[str, int]:
    """The stream and its epoch, as kept with the progress; new progress starts epoch 0, or the next one if ``restart`` allows it."""
    stream = stream_of(bronze_path)
    known = snapshot(spark, silver_path).filter("live").filter(F.col("unit").startswith(f"{stream}-"))
    newest = known.agg(F.max(F.split("unit", "-")[1].cast("int"))).first()[0]
    identity = f"{progress.rstrip('/')}/{_IDENTITY}"
    kept = spark.read.schema("stream string, epoch int").json(identity).first() if path_exists(spark, identity) else None
    if kept is not None:
        if kept["stream"] != stream:
            raise ValueError(f"{progress} is the progress of another bronze folder than {bronze_path}")
        if newest is not None and newest > kept["epoch"]:
            raise ValueError(f"{bronze_path} was started anew with other progress than {progress}")
        return stream, kept["epoch"]
    if newest is not None and not restart:
        raise ValueError(
            f"{silver_path} has rows of {bronze_path}, but their progress is not in {progress}; restart=True loads all files anew in their place"
        )
    epoch = 0 if newest is None else newest + 1
    spark.createDataFrame([(stream, epoch)], "stream string, epoch int").coalesce(1).write.mode("overwrite").json(identity)
    return stream, epoch


def incremental_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint_path: str,
    index: PlaceIndex | None,
    processed_at: dt.datetime | None = None,
    projection: str = "linear",
    max_files: int | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    max_bytes: int = MAX_BYTES,
    restart: bool = False,
) -> StreamingQuery:
    """Process the bronze files that arrived since the last run, then stop.

    The stream carries one row per file, up to ``max_bytes`` of files (or ``max_files``) a batch; each micro-batch checks all footers in
    one job, reads its files as the batch job does and becomes live as a unit of the silver table, named by
    bronze folder, epoch and batch: a repeated batch replaces itself, and any number of bronze folders can feed one table. Layout and writer are the same
    for every size of the place index. A file without a required column stops the query before its batch is committed,
    so it is not passed over.

    Progress that was lost would load every file a second time: the run is refused, unless ``restart`` begins a new
    epoch, whose first batch replaces all rows of the epochs before.
    """
    stream, epoch = _identity(spark, bronze_path, silver_path, checkpoint_path, restart)

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        session = batch.sparkSession
        silver = to_silver(read_files(session, batch), index, processed_at, projection, max_broadcast_bytes)
        unit = f"{stream}-{epoch:04d}-{batch_id:09d}"
        earlier = F.col("unit").startswith(f"{stream}-") & (F.col("unit") < f"{stream}-{epoch:04d}-")
        write_batch(silver, silver_path, unit, (F.col("unit") == unit) | earlier)

    return (
        _new_files(spark, bronze_path, max_files, max_bytes)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def read_incremental(spark: SparkSession, silver_path: str) -> DataFrame:
    """Silver rows written so far, extra columns before the partition columns."""
    return read_with_extras(spark, silver_path)
