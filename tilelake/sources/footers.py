"""What parquet files say of themselves: rows, columns, damage. One small read per file, in tasks.

Listings come from Spark's own distributed file index. Footers are read where the file lies; only for stores that Arrow cannot
open is the whole file read, by Spark.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.schemas import BRONZE

# executors need pyarrow but not this library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WIDTHS = ("tinyint", "smallint", "int", "bigint")
_FRACTIONS = ("float", "double")
#: Stores that Arrow opens by the name Spark uses, and the name Arrow has for them.
_STORES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
# How many file names an error shows.
SHOWN = 10
FOOTER = "path string, length long, rows long, columns string, problem string"


def list_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path and length of every parquet file below ``path``; contents are not opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))


def _columns_of(source) -> tuple[int, str]:
    """Rows and (name, type) pairs of one file."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type
    from pyspark.sql.types import StructType

    footer = pq.ParquetFile(source)
    stored = (footer.schema_arrow.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    if stored is None:
        stored = (footer.metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    if stored:
        fields = [(f.name, f.dataType.simpleString()) for f in StructType.fromJson(json.loads(stored)).fields]
    else:
        unsigned = {"uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)"}
        fields = [(f.name, unsigned.get(str(f.type)) or from_arrow_type(f.type).simpleString()) for f in footer.schema_arrow]
    return footer.metadata.num_rows, json.dumps(fields)


def _read(batches) -> Iterator:
    import io
    from urllib.parse import unquote

    import pyarrow as pa
    from pyarrow import fs

    def opened(path: str, content):
        if content is not None:
            return io.BytesIO(content)
        scheme, _, rest = path.partition(":")
        if _STORES[scheme] == "file":
            return fs.LocalFileSystem().open_input_file(unquote("/" + rest.lstrip("/")))
        system, inside = fs.FileSystem.from_uri(f"{_STORES[scheme]}:{unquote(rest)}")
        return system.open_input_file(inside)

    for batch in batches:
        out = []
        contents = batch.column("content").to_pylist() if "content" in batch.schema.names else [None] * batch.num_rows
        for path, length, content in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), contents):
            try:
                out.append((path, length, *_columns_of(opened(path, content)), None))
            except Exception as error:  # whatever a damaged file may raise, it is reported under its name
                out.append((path, length, None, None, f"{type(error).__name__}: {error}"[:200]))
        names = ("path", "length", "rows", "columns", "problem")
        types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=list(names))


def footers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """path, length, rows, columns (JSON pairs of name and type) and problem of the listed ``files``."""
    schemes = [r[0] for r in files.select(F.regexp_extract("path", "^([A-Za-z0-9+.-]+):", 1)).distinct().collect()]
    if all(s in _STORES for s in schemes):
        return files.select("path", "length").mapInArrow(_read, FOOTER)
    whole = spark.read.format("binaryFile").load([r["path"] for r in files.select("path").collect()])
    return whole.select("path", "length", "content").mapInArrow(_read, FOOTER)


@dataclass(frozen=True)
class FileSchema:
    """Columns that some files share: how many files, the first of them by name, and their rows."""

    columns: tuple[tuple[str, str], ...]
    files: int
    names: tuple[str, ...]


def schemas_of(found: DataFrame) -> list[FileSchema]:
    """The different schemas of readable files, each with its first SHOWN names; they are few, whatever the number of files."""
    readable = found.filter(F.col("columns").isNotNull())
    each = readable.groupBy("columns").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("first")).collect()
    out = []
    for r in sorted(each, key=lambda r: r["first"]):
        out.append(FileSchema(tuple(map(tuple, json.loads(r["columns"]))), r["files"], (r["first"],)))
    return out


def _named(found: DataFrame, condition) -> str:
    names = [r["path"] for r in found.filter(condition).orderBy("path").limit(SHOWN).select("path").collect()]
    return ", ".join(names)


def missing_columns(schema: FileSchema, required: T.StructType = BRONZE) -> list[str]:
    return sorted(set(required.names) - {n for n, _ in schema.columns})


def merged_schema(found: DataFrame, required: T.StructType = BRONZE, binary_as_string: bool = False) -> T.StructType:
    """One schema for all files, after checking each: raises ``ValueError`` with the files that lack a required column or
    whose column has a type that cannot be read as the others'.

    Integers of different widths are read as the widest, floats as doubles; with ``binary_as_string`` bytes in a
    required text column are text.
    """
    known = schemas_of(found)
    lacking = {s.columns: m for s in known if (m := missing_columns(s, required))}
    if lacking:
        columns = sorted({c for m in lacking.values() for c in m})
        stored = F.col("columns").isin([json.dumps([list(c) for c in s]) for s in lacking])
        files = sum(s.files for s in known if s.columns in lacking)
        raise ValueError(f"Missing required columns: {columns} in {files} files: {_named(found, stored)}")
    text = {f.name for f in required.fields if f.dataType == T.StringType()}
    types: dict[str, set[str]] = {}
    for schema in known:
        for name, kind in schema.columns:
            types.setdefault(name, set()).add("string" if binary_as_string and kind == "binary" and name in text else kind)
    merged = []
    for name, kinds in types.items():
        for order in (_WIDTHS, _FRACTIONS):
            if kinds <= set(order):
                kinds = {max(kinds, key=order.index)}
        kinds -= {"void"} if len(kinds) > 1 else set()
        if len(kinds) > 1:
            odd = min(known, key=lambda s: s.files)
            raise ValueError(f"Column {name} has the types {sorted(kinds)}; one of the files: {odd.names[0]}")
        merged.append(f"`{name.replace('`', '``')}` {kinds.pop()}")
    return T.StructType.fromDDL(", ".join(merged)) if merged else T.StructType([])


def schema_report(spark: SparkSession, path: str, required: T.StructType = BRONZE) -> DataFrame:
    """Files and rows by schema: columns as text, whether a required one is missing, and the first file's name."""
    found = footers(spark, list_parquet(spark, path))
    names = F.transform(F.from_json("columns", "array<array<string>>"), lambda c: c[0])
    missing = F.array_sort(F.array_except(F.array(*(F.lit(n) for n in required.names)), names))
    return found.groupBy("columns", F.col("problem").isNotNull().alias("damaged")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.min("path").alias("first_file")
    ).withColumn("missing", missing)
