"""The silver table: one layout for full loads, single quarters and micro-batches."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.functions import tile_quarter
from tilelake.schemas import ORIGIN, PARTITION_COLUMNS, SILVER
from tilelake.sinks.live import BATCH, Layout, entries, everything, is_live_table, load, path_exists, read_live, same_parts, snapshot
from tilelake.sinks.tables import default_format, write_table

#: Rows lie below their batch, their unit (quarter of origin or micro-batch), year and month.
SILVER_LAYOUT = Layout(ORIGIN, tuple(PARTITION_COLUMNS), unit_in_folders=True)
# Partitions added to or dropped from the catalog in one statement.
PER_STATEMENT = 500


def write_silver(
    df: DataFrame,
    path: str,
    quarter: str | None = None,
    mode: str = "overwrite",
    fmt: str | None = None,
    options: dict[str, str] | None = None,
    replace_partitions: bool = False,
    rebalance: bool = True,
) -> None:
    """Write the silver table, partitioned by quarter of origin, year and month.

    A full load replaces everything. With a ``quarter`` of origin, rows replace what this quarter loaded before, by whichever load, and
    nothing else: undated tiles, which share the partition columns of January 2019, stay with the quarter they came
    from (``load_unit`` of ``df``, else the quarter of the tile). ``replace_partitions`` replaces the years and months that ``df`` has rows for, and
    ``mode="append"`` nothing. Rows become live all at once, with the last file of the load. A table of the earlier layouts
    is taken over by the first load that does not replace all of it.
    """
    spark = df.sparkSession
    if (fmt or default_format(spark)) == "delta":
        _write_delta(df, path, quarter, mode, options, replace_partitions, rebalance)
        return
    if quarter is not None:
        unit, replaced = F.lit(quarter), entries(F.col("unit") == quarter)
    else:
        unit = F.col(ORIGIN) if ORIGIN in df.columns else tile_quarter(F.col("tile"))
        replaced = entries(F.lit(False)) if mode == "append" else same_parts if replace_partitions else everything
    if replaced is not everything:
        adopt(spark, path)
    load(df.withColumn(ORIGIN, unit), path, SILVER_LAYOUT, replaced, rebalance, options)


def _write_delta(df, path, quarter, mode, options, replace_partitions, rebalance) -> None:
    partitions = PARTITION_COLUMNS
    if quarter is not None:
        options = {**(options or {}), "replaceWhere": f"quarter = '{quarter}'"}
        df, partitions = df.withColumn("quarter", F.lit(quarter)), ["quarter", *PARTITION_COLUMNS]
    write_table(df.drop(ORIGIN), path, partitions, mode, "delta", options, replace_partitions, rebalance)


def write_batch(df: DataFrame, path: str, unit: str, ended: Column) -> None:
    """Write one micro-batch as a unit of its own; live entries that meet ``ended`` are replaced."""
    adopt(df.sparkSession, path)
    load(df.withColumn(ORIGIN, F.lit(unit)), path, SILVER_LAYOUT, entries(ended))


def adopt(spark: SparkSession, path: str) -> None:
    """Take the rows of an earlier layout (year and month, below a quarter or a batch, or all of these side by side) over.

    They are written as one batch, and from then on the earlier files are not read; nothing happens to a table of the present layout or
    an empty folder.
    """
    old = _plain_rows(spark, path)
    if old is None:
        return
    load(old, path, SILVER_LAYOUT, everything)


def _plain_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of a table without snapshots, with their unit; None where there is none."""
    if is_live_table(spark, path) or not path_exists(spark, path):
        return None
    stored = T.StructType([f for f in SILVER.fields if f.name not in PARTITION_COLUMNS])
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").schema(stored)
    rows = reader.parquet(path)
    if rows.isEmpty():
        return None
    of = lambda key: F.nullif(F.regexp_extract(F.col("_metadata.file_path"), f"/{key}=([^/]*)/", 1), F.lit(""))
    batch = of(BATCH)
    unit = F.coalesce(of("quarter"), F.when(batch.isNotNull(), F.concat(F.lit("batch-"), batch)), tile_quarter(F.col("tile")))
    return rows.select(*stored.names, *(of(c).alias(c) for c in PARTITION_COLUMNS), unit.alias(ORIGIN))


def read_silver(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Read the silver table; the explicit schema keeps partition values as text ("03", not 3)."""
    if is_live_table(spark, path):
        return read_live(spark, path, SILVER_LAYOUT, SILVER).select(*SILVER.names)
    fmt = fmt or default_format(spark)
    reader = spark.read.format(fmt)
    return (reader if fmt == "delta" else reader.schema(SILVER)).load(path).select(*SILVER.names)


def read_with_extras(spark: SparkSession, path: str) -> DataFrame:
    """The silver table with columns beyond its schema, before the partition columns."""
    if not is_live_table(spark, path) or snapshot(spark, path).isEmpty():
        return read_silver(spark, path)
    found = read_live(spark, path, SILVER_LAYOUT).schema
    extra = [f for f in found.fields if f.name not in {*SILVER.names, BATCH, ORIGIN}]
    rows = read_live(spark, path, SILVER_LAYOUT, T.StructType([*SILVER.fields, *extra]))
    known = [c for c in SILVER.names if c not in PARTITION_COLUMNS]
    return rows.select(*known, *(f.name for f in extra), *PARTITION_COLUMNS)


def _identifier(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def register_silver(spark: SparkSession, name: str, path: str, fmt: str | None = None) -> None:
    """Make a written silver table known to the catalog under ``name``, or bring what is known up to date.

    The view ``name`` has the columns of the table; the table ``name_files`` below it has exactly the live partitions, so it
    reads the same rows as ``read_silver``, whichever loads have written them. Calling it again adds and drops partitions.
    """
    fmt = fmt or default_format(spark)
    if fmt == "delta":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING delta LOCATION '{path}'")
        return
    adopt(spark, path)
    files, keys = f"{name}_files", [BATCH, *SILVER_LAYOUT.folders]
    columns = [f for f in SILVER.fields if f.name not in keys]
    listed = ", ".join(f"{_identifier(f.name)} {f.dataType.simpleString()}" for f in columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {files} ({listed}, {', '.join(f'{_identifier(k)} string' for k in keys)}) USING parquet "
        f"PARTITIONED BY ({', '.join(map(_identifier, keys))}) LOCATION '{path}'"
    )
    # one row a partition: as many as the table has folders
    live = snapshot(spark, path).filter("live").select(BATCH, "unit", F.split("part", "/").alias("part"))
    wanted = {(r[BATCH], r["unit"], *r["part"]) for r in live.collect()}
    known = {tuple(_values(r["partition"])) for r in spark.sql(f"SHOW PARTITIONS {files}").collect()}
    _alter(spark, files, keys, "ADD IF NOT EXISTS", " ", sorted(wanted - known))
    _alter(spark, files, keys, "DROP IF EXISTS", ", ", sorted(known - wanted))
    spark.catalog.refreshTable(files)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(map(_identifier, SILVER.names))} FROM {files}")


def _values(partition: str) -> list[str]:
    values = [unquote(step.partition("=")[2]) for step in partition.split("/")]
    return ["" if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values]


def _alter(spark: SparkSession, table: str, keys: list[str], what: str, between: str, partitions: list[tuple]) -> None:
    value = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if v else "null"
    specs = ["PARTITION (" + ", ".join(f"{_identifier(k)} = {value(v)}" for k, v in zip(keys, p)) + ")" for p in partitions]
    for i in range(0, len(specs), PER_STATEMENT):
        spark.sql(f"ALTER TABLE {table} {what} {between.join(specs[i : i + PER_STATEMENT])}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a registered table; its files stay."""
    view = spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"
    spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}_files")
