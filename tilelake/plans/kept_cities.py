"""Cities of quadkeys, kept from run to run so that only unseen quadkeys are looked up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.operators.geocode import MAX_BROADCAST_BYTES, PlaceIndex, with_cities, without_cities
from tilelake.operators.skew import salted_join
from tilelake.runtime import checkpointed
from tilelake.sinks.live import BATCH, Layout, entries, load, read_live, snapshot

_VERSION = "index_version"
_LAYOUT = Layout(_VERSION, (), unit_in_folders=True)
_KEPT = T.StructType(
    [T.StructField(n, t) for n, t in (("quadkey", T.StringType()), ("latitude", T.DoubleType()), ("longitude", T.DoubleType()))]
    + [T.StructField("city", T.StringType()), T.StructField("city_lookup_success", T.BooleanType())]
)
# Upper estimate of a kept quadkey in memory.
_ROW_BYTES = 200
# From so many new quadkeys on, each task writes its own; fewer are gathered first, so that small additions make few files.
_MANY_NEW = 1_000_000


def index_version(index: PlaceIndex) -> str:
    """A name for the content of an index: another gazetteer gives another one."""
    places = index.places
    row = F.xxhash64(*places.columns).cast("decimal(38,0)")
    found = places.agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("hash")).first()
    return f"v{found['rows']}x{abs(int(found['hash'] or 0)):x}"


def with_kept_cities(
    located: DataFrame, index: PlaceIndex | None, kept_path: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``with_cities`` for rows with quadkey, latitude and longitude, by the table of quadkeys in ``kept_path``.

    Quadkeys that the table lacks for this version of the index are looked up, each once, and added; a quadkey with other coordinates
    (another projection) counts as another one. The table is broadcast while it is small enough, and beyond that joined with
    hot quadkeys split. Rows with the same quadkey always get the same city, as their coordinates are the same.
    """
    if index is None or index.is_empty:
        return without_cities(located)
    spark, version, keys = located.sparkSession, index_version(index), ["quadkey", "latitude", "longitude"]

    def known() -> DataFrame:
        return read_live(spark, kept_path, _LAYOUT, _KEPT).filter(F.col(_VERSION) == version).select(*_KEPT.names)

    def kept_rows() -> int:
        return snapshot(spark, kept_path).filter(F.col("live") & (F.col("unit") == version)).agg(F.sum("rows")).first()[0] or 0

    def kept_rows() -> int:
        return snapshot(spark, kept_path).filter(F.col("live") & (F.col("unit") == version)).agg(F.sum("rows")).first()[0] or 0

    counts = checkpointed(located.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")))
    unseen, rows = counts.select(*keys), kept_rows()
    # the table has each quadkey once, so at least so many are new: then no join is needed to see whether any is
    least_new = counts.count() - rows
    if rows:
        unseen = unseen.join(known(), keys, "left_anti")
    if least_new > 0 or not unseen.isEmpty():
        found = with_cities(unseen, index, max_broadcast_bytes).withColumn(_VERSION, F.lit(version))
        # quadkeys are spread evenly by their grouping, so many of them need no shuffle before the write
        load(found, kept_path, _LAYOUT, entries(F.lit(False)), rebalance=least_new < _MANY_NEW)
        rows = kept_rows()
    if rows * _ROW_BYTES <= max_broadcast_bytes:
        return located.join(F.broadcast(known()), keys).select(*located.columns, "city", "city_lookup_success")
    return salted_join(located, known(), keys, counts, "inner").select(*located.columns, "city", "city_lookup_success")
