"""Reading raw bronze tiles."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.functions import tile_quarter
from tilelake.functions.text import UNDATED
from tilelake.schemas import BRONZE, ORIGIN, validate_schema
from tilelake.sinks.live import BATCH, Layout, hadoop_path, is_live_table, read_live, snapshot
from tilelake.sources.footers import footers, list_parquet, merged_schema


def resolve_bronze_path(root: str, quarter: str | None = None) -> str:
    """``root`` with one trailing slash, followed by the quarter's folder if one is named."""
    path = root.rstrip("/") + "/"
    return f"{path}{quarter}/" if quarter else path


def scan_bronze(
    spark: SparkSession, path: str, quarter: str | None = None, binary_as_string: bool = False, origin: bool = False
) -> DataFrame:
    """All parquet files below ``path``, whatever the layout; raises with the files' names if a required column is missing.

    Columns come from the files, so columns beyond the bronze schema pass through, and so do partition columns. Files of
    several layouts may lie side by side: in the root, in plain folders, in partitions of different columns and in landed tables, of
    which the live rows are read. Integers of different widths are read as the widest. ``quarter`` selects a partition of a landed
    table. ``binary_as_string`` reads required text columns that old writers stored as plain bytes. With ``origin`` each row has the
    quarter it came from as ``load_unit``: of its landed partition or its folder (``2019-q1`` or ``quarter=2019-q1``), else of its tile.
    """
    if is_live_table(spark, path):
        df = read_landed(spark, path)
        validate_schema(df)
        df = df.withColumn(ORIGIN, F.col("quarter")) if origin else df
    else:
        files = list_parquet(spark, path).select("*", *_place(spark, path))
        df = _scan_files(spark, path, files, binary_as_string, origin)
    return df if quarter is None else df.filter(F.col("quarter") == quarter)


def _place(spark: SparkSession, root: str) -> list[Column]:
    """Of a file below ``root``: the names of its partition columns, its plain folders, and the landed table it belongs to."""
    plain = F.regexp_replace("path", "^([A-Za-z0-9+.-]+):/+", "$1:/")
    steps = F.slice(F.split(plain, "/"), 1, F.size(F.split(plain, "/")) - 1)
    # folders above the root are the same for every file; a root named column=value gives no column
    system, folder = hadoop_path(spark, root)
    above = len(re.sub("^([A-Za-z0-9+.-]+):/+", r"\1:/", system.makeQualified(folder).toString()).rstrip("/").split("/"))
    below = F.slice(steps, above + 1, F.greatest(F.size(steps) - above, F.lit(0)))
    keys = F.transform(F.filter(below, lambda x: x.contains("=")), lambda x: F.substring_index(x, "=", 1))
    return [
        F.array_join(keys, "/").alias("keys"),
        F.exists(below, lambda x: ~x.contains("=")).alias("in_folder"),
        F.nullif(F.regexp_extract(plain, f"^(.*)/{BATCH}=b[0-9a-f]{{32}}/", 1), F.lit("")).alias("table"),
    ]


def _scan_files(spark: SparkSession, path: str, files: DataFrame, binary_as_string: bool, origin: bool) -> DataFrame:
    layouts = files.groupBy("table", "keys").agg(F.max("in_folder").alias("in_folder")).collect()
    tables = sorted({r["table"] for r in layouts if r["table"]})
    raw = [r for r in layouts if not r["table"]]
    own = footers(spark, files.filter(F.col("table").isNull()).select("path", "length"))
    own.cache()
    try:
        bad = own.filter(F.col("problem").isNotNull()).orderBy("path").limit(1).collect()
        if bad:
            raise ValueError(f"{bad[0]['path']} cannot be read: {bad[0]['problem']}")
        parts = [scan_bronze(spark, unquote(table), origin=origin) for table in tables]
        if raw or not parts:
            schema = merged_schema(own, binary_as_string=binary_as_string)
            parts.insert(0, _read_raw(spark, path, schema, raw, tables, origin))
    finally:
        own.unpersist()
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read_raw(spark: SparkSession, path: str, schema: T.StructType, layouts: list, tables: list[str], origin: bool) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if not schema.fields:
        # no file at all: the reader's own error names the path
        df = reader.parquet(path)
        validate_schema(df)
        return df
    keys = sorted({k for r in layouts for k in r["keys"].split("/") if k and k not in schema.names})
    if not tables and keys and len(layouts) == 1 and not layouts[0]["in_folder"]:
        # one partitioned table: Spark prunes its partitions
        df = reader.schema(schema).parquet(path)
        return df.select("*", _origin().alias(ORIGIN)) if origin else df
    df = reader.option("recursiveFileLookup", "true").schema(schema).parquet(path)
    file = F.col("_metadata.file_path")
    for table in tables:
        df = df.filter(~F.regexp_replace(file, "^([A-Za-z0-9+.-]+):/+", "$1:/").startswith(f"{table}/{BATCH}="))
    # partition columns of mixed layouts, as text, from the file's folders
    return df.select("*", *(_partition_value(file, k).alias(k) for k in keys), *([_origin().alias(ORIGIN)] if origin else []))


def _origin() -> Column:
    folder = F.regexp_extract(F.col("_metadata.file_path"), rf"/(?:quarter=)?(\d{{4}}-q[1-4]|{UNDATED})/", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), tile_quarter(F.col("tile")))


def _partition_value(file: Column, key: str) -> Column:
    value = F.regexp_extract(file, f"/{re.escape(key)}=([^/]*)/", 1)
    return F.when(~value.isin("", "__HIVE_DEFAULT_PARTITION__"), F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))))


def read_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The rows of the listed files (``path``, ``length``), checked and typed as ``scan_bronze`` does; their names pass through the driver."""
    found = footers(spark, files).cache()
    try:
        bad = found.filter(F.col("problem").isNotNull()).orderBy("path").limit(1).collect()
        if bad:
            raise ValueError(f"{bad[0]['path']} cannot be read: {bad[0]['problem']}")
        schema = merged_schema(found)
        names = sorted(r["path"] for r in found.select("path").collect())
    finally:
        found.unpersist()
    keys = sorted({k for n in names for k in re.findall(r"/([^/=]+)=[^/]*(?=/)", n) if k not in schema.names})
    df = spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(*(unquote(n) for n in names))
    return df.select("*", *(_partition_value(F.col("_metadata.file_path"), k).alias(k) for k in keys))


#: Landed rows keep their file's name; a file is the unit that a later landing replaces.
LANDED = Layout("source_file", ("quarter",), unit_in_folders=False)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The live rows of a landed table, with source_file and quarter."""
    if snapshot(spark, path).filter("live").isEmpty():
        extra = [T.StructField(c, T.StringType()) for c in ("source_file", "quarter")]
        return spark.createDataFrame([], T.StructType([*BRONZE.fields, *extra]))
    return read_live(spark, path, LANDED).drop(BATCH)


def scan_quarter(spark: SparkSession, root: str, quarter: str | None, origin: bool = False) -> DataFrame:
    """One quarter below ``root``: its own folder, or its partition of a landed table; without a quarter, everything."""
    if quarter is None:
        return scan_bronze(spark, root, origin=origin)
    try:
        return scan_bronze(spark, resolve_bronze_path(root, quarter))
    except AnalysisException:
        return scan_bronze(spark, root, quarter)


def read_with_fallback(spark: SparkSession, first: Callable[[], DataFrame], path: str) -> DataFrame:
    """The first source, or the parquet folder ``path`` when it cannot be read: an unknown
    format, a missing path or any other error of the reader."""
    try:
        df = first()
        df.schema
        return df
    except (PySparkException, Py4JJavaError):
        return spark.read.parquet(path)


def require_rows(df: DataFrame, path: str) -> DataFrame:
    """Raise when the input has no rows; reads at most one of them."""
    if df.isEmpty():
        raise RuntimeError(f"No rows found under {path}")
    return df
