"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"
_COPIES = "__copies"


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    key_counts: DataFrame,
    how: str = "left",
    shares: int | None = None,
) -> DataFrame:
    """Equi-join ``left`` with ``right``, splitting the hot keys of ``left``.

    ``key_counts`` holds ``keys`` and ``rows``: how often each key occurs in ``left``.
    It is read more than once, so it should come from a materialised table.
    A key with more than 1/shares of all rows is hot, so fewer than ``shares`` keys
    are, which bounds the broadcast list of hot keys whatever the data. Rows of a hot
    key are dealt over several salts and its ``right`` rows copied to each of them
    (fewer than 2 * shares copied keys in all). Rows with a null key never match and
    are dealt out too. The result equals that of the plain join.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    shares = shares or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = key_counts.agg(F.sum("rows")).first()[0] or 0
    limit = max(total / shares, 1.0)
    hot = key_counts.filter(F.col("rows") > limit).select(
        *keys, F.ceil(F.col("rows") / limit).cast("int").alias(_COPIES)
    )
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    copies = F.when(null_key, shares).otherwise(F.coalesce(F.col(_COPIES), F.lit(1)))
    # a hash of the row, not its place: a repeated task deals its rows out as before
    hashable = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    dealt = (
        left.join(F.broadcast(hot), keys, "left")
        .withColumn(_SALT, F.pmod(F.xxhash64(*hashable), copies).cast("int"))
        .drop(_COPIES)
    )
    copied = (
        right.join(F.broadcast(hot), keys, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_COPIES), F.lit(1)) - 1)))
        .drop(_COPIES)
    )
    return dealt.join(copied, [*keys, _SALT], how).drop(_SALT)
