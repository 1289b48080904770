"""Writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
# Table options of the silver table; they apply to the delta format only.
DELTA_OPTIONS = {
    "overwriteSchema": "true",
    "delta.logRetentionDuration": "interval 30 days",
    "delta.deletedFileRetentionDuration": "interval 7 days",
}


def default_format(spark: SparkSession) -> str:
    """``delta`` in a session set up for it, else ``parquet``."""
    return "delta" if "DeltaSparkSessionExtension" in spark.conf.get("spark.sql.extensions", "") else "parquet"


def rebalanced(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Group rows by partition value into evenly sized tasks.

    Adaptive execution splits a value that holds a large share of the rows and merges
    small ones, so a partition gets few, well-sized files however skewed it is.
    """
    return df.hint("rebalance", *partitions) if partitions else df


def write_table(
    df: DataFrame,
    path: str,
    partitions: list[str] | None = None,
    mode: str = "overwrite",
    fmt: str | None = None,
    options: dict[str, str] | None = None,
    replace_partitions: bool = False,
    rebalance: bool = True,
) -> None:
    """Write ``df`` to ``path``.

    ``replace_partitions`` overwrites only the partitions present in ``df``, whoever wrote
    them. Without ``rebalance`` the rows are
    written where they are, with no shuffle: right for input already grouped by
    partition value.
    """
    partitions = partitions or []
    fmt = fmt or default_format(df.sparkSession)
    if rebalance:
        df = rebalanced(df, partitions)
    writer = df.write.format(fmt).mode(mode)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "delta":
        # the whole-schema option and partition replacement exclude each other
        writer = writer.options(
            **{k: v for k, v in DELTA_OPTIONS.items() if not (replace_partitions and k == "overwriteSchema")}
        )
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.options(**(options or {})).save(path)
