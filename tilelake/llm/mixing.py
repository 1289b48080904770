"""Mix sources to target weights by hash-threshold histograms. DataFrame functions only.

Every document has a 60-bit hash of its id. A source takes each of its documents
``copies`` whole times, and once more those whose hash lies below the source's threshold.
The threshold is found without sorting: sizes are summed by source and the upper 12 bits of
the hash, the running sum names the bucket in which the source's remaining budget ends, and only that
bucket is cut by the next 12 bits, until one hash is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilelake.llm.common import WORD, free_names
from tilelake.runtime import checkpointed

HASH_BITS, LEVEL_BITS = 60, 12
#: A table of one row per source is broadcast up to this many rows (some tens of bytes each).
MAX_BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(doc_id: Column) -> Column:
    """The first 60 bits of the md5 of the id as text, the same in every run and on every machine."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """One row per source: its size and its target.

    Sources in order of code points, null last, get ``weights``, repeating, of ``share`` times all
    sizes. A target stops at ``limit`` times the source's size and what it leaves is shared
    by weight among the others: in order of limit by weight, the first source that
    stays below its limit fixes the level for it and all after it.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    ranked = by_source.select("source", "source_size", place.alias("place"), weight.alias("weight"))
    most = F.col("source_size") * F.lit(float(limit))
    order = Window.orderBy(most / F.col("weight"), "place")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = ranked.select(
        "*",
        most.alias("most"),
        (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum(most).over(before), F.lit(0.0))).alias("left"),
        F.sum("weight").over(after).alias("sharers"),
    )
    open_ = F.when(F.col("most") / F.col("weight") > F.col("left") / F.col("sharers"), F.struct(F.col("most") / F.col("weight"), "place", "left", "sharers"))
    level = F.min(open_).over(everything)
    target = F.least(F.col("most"), F.coalesce(F.col("weight") * level["left"] / level["sharers"], F.col("most")))
    return levels.select("source", "source_size", target.alias("target"))


def _attach(rows: DataFrame, few: DataFrame, n_few: int, condition: Column, how: str = "inner") -> DataFrame:
    """Join a table of one row per source: broadcast while its counted rows are few; else adaptive execution splits hot sources."""
    return rows.join(F.broadcast(few) if n_few <= MAX_BROADCAST_SOURCES else few, condition, how)


def thresholds(sizes: DataFrame, wanted: DataFrame, n_sources: int) -> DataFrame:
    """One row per source: ``copies`` of every document and ``cut``, below which a hash takes one more.

    ``sizes`` has source, size and hash; ``wanted`` is what :func:`targets` gives. The sum of
    what is taken is as near to the target as whole documents in order of hash allow.
    """
    size, target = F.col("source_size"), F.col("target")
    copies = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("int")
    plan = checkpointed(wanted.select("*", copies.alias("copies"), F.greatest(target - copies * size, F.lit(0.0)).alias("rest")))
    rows = sizes.filter(F.col("size") > 0)
    open_ = plan.filter(F.col("rest") > 0).select(F.col("source").alias("s"), "rest")
    decided = None
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        sums = rows.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("sum"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        upto = F.sum("sum").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        running = sums.select("*", upto.alias("upto"))
        ends = _attach(running, open_, n_sources, F.col("source").eqNullSafe(F.col("s"))).filter(
            (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("sum") <= F.col("rest"))
        )
        ends = checkpointed(ends.select("s", "bucket", "sum", "low", "high", (F.col("rest") - F.col("upto") + F.col("sum")).alias("rest")))
        nearer = F.when(F.col("sum") - F.col("rest") <= F.col("rest"), 1).otherwise(0)
        single = ends.filter(F.col("low") == F.col("high")).select("s", (F.col("low") + nearer).alias("cut"))
        decided = single if decided is None else decided.unionByName(single)
        open_ = ends.filter(F.col("low") < F.col("high")).select("s", "rest", F.col("bucket").alias("b"))
        if open_.isEmpty():
            break
        rows = _attach(rows, open_.drop("rest"), n_sources, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("hash", shift) == F.col("b"))).drop("s", "b")
        open_ = open_.drop("b")
    found = _attach(plan, decided, n_sources, F.col("source").eqNullSafe(F.col("s")), "left")
    return checkpointed(found.select("source", "source_size", "target", "copies", F.coalesce("cut", F.lit(0)).alias("cut")))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    limit: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (copies times size, in words).

    Null and empty texts have size 0 and follow the same rule. A null source is a source of its own. Rows of
    equal id share their decision, so repeated rows are taken or left together. An empty table gives an empty result.
    Result columns replace input columns of the same name.
    """
    sizes = checkpointed(
        docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), hash60(F.col(id_col)).alias("hash"))
    )
    wanted = checkpointed(targets(sizes, weights, share, limit))
    n_sources = wanted.count()
    names = ["source", "source_size", "target", "copies", "cut"]
    key, size_s, target, copies, cut, size, hash_ = free_names(docs, "_source", "_source_size", "_target", "_copies", "_cut", "_size", "_hash")
    few = thresholds(sizes, wanted, n_sources).select(*(F.col(a).alias(b) for a, b in zip(names, [key, size_s, target, copies, cut])))
    sized = docs.select("*", word_count(F.col(text_col)).alias(size), hash60(F.col(id_col)).alias(hash_))
    joined = _attach(sized, few, n_sources, sized[source_col].eqNullSafe(few[key]))
    taken_copies = F.col(copies) + F.when(F.col(hash_) < F.col(cut), 1).otherwise(0)
    kept = [c for c in docs.columns if c.lower() not in {"size", "source_size", "target", "copies", "taken"}]
    return joined.select(
        *kept, F.col(size).alias("size"), F.col(size_s).alias("source_size"), F.col(target).alias("target"),
        taken_copies.alias("copies"), (taken_copies * F.col(size)).alias("taken"),
    )


def take(mixed: DataFrame) -> DataFrame:
    """The rows of a mix: each document as often as it is taken."""
    times = F.expr("sequence(1, copies)")
    return mixed.filter(F.col("copies") > 0).withColumn("copies", F.explode(times))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h
  FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM per_source),
weighed AS (
  SELECT *, CAST(CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight,
    CAST(source_size AS DOUBLE) * 2 AS most FROM ranked),
levels AS (
  SELECT *, CAST((SELECT sum(source_size) FROM per_source) AS DOUBLE) * 1.5 - coalesce(sum(most) OVER (
      ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS budget,
    sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharers
  FROM weighed),
level AS (
  SELECT budget, sharers FROM levels WHERE most / weight > budget / sharers ORDER BY most / weight, place LIMIT 1),
targets AS (
  SELECT source, source_size, least(most, coalesce(weight * (SELECT budget FROM level) / (SELECT sharers FROM level), most)) AS target
  FROM levels),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM targets),
running AS (
  SELECT s.doc_id, s.size, s.h, p.source_size, p.target, p.copies, p.target - p.copies * p.source_size AS rest,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS DOUBLE) AS upto,
    CAST(sum(s.size) OVER (PARTITION BY s.source, s.h) AS DOUBLE) AS tied
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * (copies + CASE
    WHEN rest > 0 AND (upto <= rest OR upto - tied <= rest AND upto - rest <= rest - upto + tied) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running
"""


def op4(spark, sf_dir) -> DataFrame:
    from tilelake.llm.common import documents

    return mix(documents(spark, sf_dir).select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")
