"""Tables that are loaded batch by batch, in units that later loads replace.

A load writes its rows to a folder of its own, ``batch_id=<id>/``, and then a snapshot to ``_live/<number>/`` that says of every
unit and partition of every batch whether it is live. Readers take the newest complete snapshot, so a load that stops anywhere
before its last step leaves the table as it was, and what a load replaces is exactly what it names: there are no
rows of an older version beside newer ones. A unit is a source file, a quarter or a micro-batch.

Two loads at a time would write the same snapshot number: the second one fails and can be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.sinks.tables import write_table

BATCH = "batch_id"
_LIVE = "_live"
SNAPSHOT = T.StructType(
    [T.StructField(n, T.StringType()) for n in (BATCH, "unit", "part")]
    + [T.StructField("rows", T.LongType()), T.StructField("live", T.BooleanType())]
)
# Replaced units that may be broadcast to every task that reads the table.
MAX_BROADCAST_UNITS = 1_000_000


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    system, folder = hadoop_path(spark, path)
    return system.exists(folder)


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path``; none if it does not exist."""
    system, folder = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()) if system.exists(folder) else []


def _delete(spark: SparkSession, path: str) -> None:
    system, folder = hadoop_path(spark, path)
    system.delete(folder, True)


def _complete(spark: SparkSession, path: str) -> list[str]:
    """Snapshots that were written to their end, oldest first."""
    done = lambda name: path_exists(spark, f"{path}/{_LIVE}/{name}/_SUCCESS")
    return [name for name in _names(spark, f"{path}/{_LIVE}") if name.isdigit() and done(name)]


def is_live_table(spark: SparkSession, path: str) -> bool:
    return bool(_complete(spark, path.rstrip("/")))


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """batch_id, unit, part, rows and live of everything in the batches that are still read; no rows without a table."""
    path = path.rstrip("/")
    found = _complete(spark, path)
    return spark.read.schema(SNAPSHOT).parquet(f"{path}/{_LIVE}/{found[-1]}") if found else spark.createDataFrame([], SNAPSHOT)


@dataclass(frozen=True)
class Layout:
    """Where a table's unit stands (a column of the rows, or the first partition) and its other partitions."""

    unit: str
    partitions: tuple[str, ...]
    unit_in_folders: bool

    @property
    def folders(self) -> list[str]:
        return [*([self.unit] if self.unit_in_folders else []), *self.partitions]

    def part(self) -> Column:
        return F.concat_ws("/", *(F.coalesce(F.col(c), F.lit("")) for c in self.partitions))


def load(
    df: DataFrame,
    path: str,
    layout: Layout,
    replaced: Callable[[DataFrame, DataFrame], DataFrame],
    rebalance: bool = True,
    options: dict[str, str] | None = None,
    keep_replaced: bool = False,
) -> DataFrame:
    """Add the rows of ``df`` as a batch and make it live; returns its unit, part and rows.

    ``replaced(old, new)`` selects from the live entries ``old`` those that are no longer live, given the entries
    ``new`` of this batch. Batches without a live row are deleted afterwards, unless ``keep_replaced`` leaves them to readers
    that may still be on the snapshot before.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    batch = f"b{uuid.uuid4().hex}"
    folder = f"{path}/{BATCH}={batch}"
    write_table(df, folder, partitions=layout.folders, fmt="parquet", rebalance=rebalance, options=options)
    keys = T.StructType([T.StructField(c, T.StringType()) for c in [layout.unit, *layout.partitions]])
    written = spark.read.schema(keys).parquet(folder)
    new = written.groupBy(F.col(layout.unit).alias("unit"), layout.part().alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    commit(spark, path, new.select(F.lit(batch).alias(BATCH), "unit", "part", "rows", F.lit(True).alias("live")), replaced, keep_replaced)
    return new


def commit(
    spark: SparkSession, path: str, new: DataFrame, replaced: Callable[[DataFrame, DataFrame], DataFrame], keep_replaced: bool = False
) -> None:
    """Write the snapshot that adds ``new`` and ends what it replaces; the table changes with its last file."""
    done = _complete(spark, path)
    before = snapshot(spark, path)
    keys = (BATCH, "unit", "part")
    ended = replaced(before.filter("live"), new).select(*(F.col(c).alias(f"_{c}") for c in keys)).distinct()
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    after = before.join(ended, on, "left").select(*keys, "rows", (F.col("live") & F.col(f"_{BATCH}").isNull()).alias("live"))
    number = int(done[-1]) + 1 if done else 0
    every = after.unionByName(new)
    alive = every.groupBy(BATCH).agg(F.max("live").alias("alive")).filter("alive").select(BATCH)
    # entries of a batch without a live row are forgotten
    every.join(alive, BATCH, "left_semi").select(*SNAPSHOT.names).write.mode("error").parquet(f"{path}/{_LIVE}/{number:012d}")
    if not keep_replaced:
        vacuum(spark, path)


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete snapshots but the newest, and the batches that it does not read. No other load may be running."""
    path = path.rstrip("/")
    done = _complete(spark, path)
    if not done:
        return
    read = {r[BATCH] for r in snapshot(spark, path).select(BATCH).distinct().collect()}
    for name in _names(spark, f"{path}/{_LIVE}"):
        if name != done[-1]:
            _delete(spark, f"{path}/{_LIVE}/{name}")
    for name in _names(spark, path):
        if name.startswith(f"{BATCH}=b") and name.partition("=")[2] not in read:
            _delete(spark, f"{path}/{name}")


def read_live(spark: SparkSession, path: str, layout: Layout, schema: T.StructType | None = None) -> DataFrame:
    """The live rows with their batch_id. Columns of the files are merged unless a ``schema`` is given.

    Whole batches are read as they are. Of a batch that was replaced in part, replaced folders are pruned by a filter on
    partition columns; replaced units that are no folders of their own are taken out of its rows by an anti-join.
    """
    path = path.rstrip("/")
    known = snapshot(spark, path)
    batches = [r[BATCH] for r in known.select(BATCH).distinct().collect()]
    text = [T.StructField(c, T.StringType()) for c in [BATCH, *layout.folders]]
    if schema is not None:
        schema = T.StructType([*(f for f in schema.fields if f.name not in {t.name for t in text}), *text])
    if not batches:
        if schema is None:
            raise FileNotFoundError(f"no live rows below {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    df = reader.parquet(*(f"{path}/{BATCH}={b}" for b in sorted(batches)))
    dead = known.filter(~F.col("live"))
    if layout.unit_in_folders:
        for r in dead.groupBy(BATCH).agg(F.collect_set(F.struct("unit", "part")).alias("gone")).collect():
            units: dict[str, list[str]] = {}
            for unit, part in r["gone"]:
                units.setdefault(unit, []).append(part)
            for unit, parts in units.items():
                df = df.filter(~((F.col(BATCH) == r[BATCH]) & F.col(layout.unit).eqNullSafe(F.lit(unit)) & layout.part().isin(parts)))
        return df
    gone = dead.select(BATCH, F.col("unit").alias(layout.unit)).distinct()
    n = gone.count()
    if not n:
        return df
    return df.join(F.broadcast(gone) if n <= MAX_BROADCAST_UNITS else gone, [BATCH, layout.unit], "left_anti").select(*df.columns)


def everything(old: DataFrame, new: DataFrame) -> DataFrame:
    """A full load replaces all."""
    return old


def same_parts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every live row of the partitions that the load has rows for."""
    return old.join(new.select("part").distinct(), "part", "left_semi")


def entries(condition: Column) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """The live entries that meet a condition on unit and part."""
    return lambda old, new: old.filter(condition)


def units_of(units: DataFrame) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """The live entries of some units, whether or not they still have rows."""
    return lambda old, new: old.join(units.select("unit").distinct(), "unit", "left_semi")
