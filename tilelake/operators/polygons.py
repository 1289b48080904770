"""Tiles inside named boundaries: regions of the globe meet the boundaries that touch them, each searched within a task."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.functions import grid_cell, is_location
from tilelake.operators import ring_search
from tilelake.operators.area_sums import MAX_BROADCAST_BYTES
from tilelake.operators.ring_search import DEEPEST, Regions
from tilelake.runtime import checkpointed

# Locations of a region: at most, and as many as one may have however few there are.
_MOST_LOCATIONS = 250_000
_FEW_LOCATIONS = 20_000
# Levels by which crowded regions are cut at once.
_STEP = 3
_EDGE_BYTES = 32
# One area of a region in memory, without its name and edges.
_AREA_BYTES = 64
# Areas that meet a region's locations in one task.
_PART_BYTES = 8 * 1024 * 1024


def _edges(polygons: DataFrame) -> DataFrame:
    """One row per edge, closing edges included, each the short way round: at 170 and -170 degrees it ends at 190."""
    corners = F.filter("ring", lambda p: is_location(p["lat"], p["lon"]))
    following = F.concat(F.slice("at", 2, F.greatest(F.size("at") - 1, F.lit(0))), F.slice("at", 1, 1))
    pairs = polygons.select("name", corners.alias("at")).select(
        "name", F.inline(F.arrays_zip(F.col("at").alias("a"), following.alias("b")))
    )
    x1, x2 = F.col("a.lon"), F.col("b.lon")
    short = F.when(x2 - x1 > 180.0, x2 - 360.0).when(x2 - x1 < -180.0, x2 + 360.0).otherwise(x2)
    return pairs.select("name", x1.alias("x1"), F.col("a.lat").alias("y1"), short.alias("x2"), F.col("b.lat").alias("y2"))


def _regions(spots: DataFrame, count: int, most: int) -> Regions:
    """Cells over the whole globe with at most ``most`` locations each, as long as cells can be cut."""
    level, down, crowded, cells, crowd = 0, math.ceil(math.log(max(count / most, 1), 4)) + 1, {(0, 0)}, [], spots
    if count <= most:
        return Regions.of([(0, 0, 0)])
    while crowded:
        deepest = min(level + down, DEEPEST)
        x, y = grid_cell(F.col("latitude"), F.col("longitude"), deepest)
        counted = crowd.groupBy(x.alias("x"), y.alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()
        held = {deepest: Counter({(r["x"], r["y"]): r["n"] for r in counted})}
        for above in range(deepest - 1, level, -1):
            held[above] = Counter()
            for (x, y), n in held[above + 1].items():
                held[above][x >> 1, y >> 1] += n
        while level < deepest:
            level += 1
            quarters = [(2 * x + i, 2 * y + j) for x, y in crowded for i in (0, 1) for j in (0, 1)]
            crowded = {c for c in quarters if held[level][c] > most and level < DEEPEST}
            cells += [(level, *c) for c in quarters if c not in crowded]
        if crowded:
            x, y = grid_cell(F.col("latitude"), F.col("longitude"), level)
            known = spots.sparkSession.createDataFrame(sorted(crowded), "x int, y int")
            crowd = spots.withColumns({"x": x, "y": y}).join(F.broadcast(known), ["x", "y"], "left_semi").drop("x", "y")
        down = _STEP
    return Regions.of(cells)


def _parts(areas: DataFrame, regions: Regions, shares: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Into how many parts each region's areas are dealt, the number of its first part, and the bytes of all areas.

    A region with more than 1/shares of all, or more than a task should hold, has several; each meets all its locations.
    """
    size = F.coalesce(F.octet_length(F.col("name").cast("string")), F.lit(0)) + _AREA_BYTES + _EDGE_BYTES * F.size("edges") / 4
    bytes_of = np.zeros(len(regions.level))
    for row in areas.groupBy("region").agg(F.sum(size).alias("bytes")).collect():
        bytes_of[row["region"]] = row["bytes"]
    copies = np.ceil(bytes_of / min(max(bytes_of.sum() / shares, 1.0), _PART_BYTES)).astype(np.int64)
    return copies, np.cumsum(copies) - copies, int(bytes_of.sum())


def tiles_in_polygons(
    tiles: DataFrame,
    polygons: DataFrame,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    shares: int | None = None,
) -> DataFrame:
    """Tiles and tests inside each boundary; boundaries without tiles are left out.

    ``polygons`` has a name and a ring, an array of (lon, lat), open or closed, in either direction. The rings of one name
    make one boundary by the even-odd rule: holes and separate parts are further rings. Edges are straight in longitude
    and latitude, shorter than 180 degrees, and may cross the 180th meridian. Of a ring round a pole the side away from the
    north pole is inside. Corners that are null or off the globe are passed over, rings of fewer than three hold nothing.
    A tile on an edge is on one side of it only, so that neighbours with a common border share no tile; 180 degrees east counts as
    180 west. ``tests`` are whole numbers; others are summed as doubles.

    Locations are summed up once and dealt by region, cells of the globe with so many of them that one task can hold them.
    Boundaries go to the regions they touch, with the edges in them or north of them, and ``ring_search`` finds the sums there. While
    these rows fit ``max_broadcast_bytes`` they are broadcast to the locations, beyond that both are shuffled; a region of very
    many boundaries is split in both cases. What is written grows with locations and boundaries, not with the length of borders in cells.
    """
    x = F.col("longitude")
    located = tiles.filter(is_location(F.col("latitude"), x)).withColumn("longitude", F.when(x == 180.0, -180.0).otherwise(x))
    whole = isinstance(located.schema["tests"].dataType, T.IntegralType)
    tests = F.sum("tests").cast("long" if whole else "double")
    spots = checkpointed(located.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("tile_count"), tests.alias("total_tests")))
    shares = shares or int(spots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = spots.count()
    regions = _regions(spots, count, min(max(count // (4 * shares), _FEW_LOCATIONS), _MOST_LOCATIONS))

    edges = _edges(polygons).filter(F.col("name").isNotNull())
    rings = edges.groupBy("name").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    name = rings.schema["name"]
    routed = T.StructType([name, *T.StructType.fromDDL("region int, flips int, edges array<double>")])
    areas = checkpointed(rings.mapInArrow(ring_search.route(regions), routed))
    copies, first, size = _parts(areas, regions, shares)
    parts = int(copies.sum())
    with_part = T.StructType([*spots.schema, T.StructField("part", T.IntegerType())])
    dealt_out = spots.mapInArrow(ring_search.deal(regions, first, copies), with_part)
    number = min(max(parts, 1), 4 * shares)
    dealt_out = dealt_out.repartition(number, "part").groupBy("part")
    of_region = spots.sparkSession.createDataFrame([(i, int(c), int(f)) for i, (c, f) in enumerate(zip(copies, first)) if c], "region int, copies int, first int")
    part = F.col("first") + F.pmod(F.xxhash64("name"), F.col("copies")).cast("int")
    areas = areas.join(F.broadcast(of_region), "region").select(*areas.columns, part.alias("part"))
    found = T.StructType([name, T.StructField("tile_count", T.LongType()), spots.schema["total_tests"]])
    if size <= max_broadcast_bytes:
        held = spots.sparkSession.sparkContext.broadcast(areas.toArrow().combine_chunks().sort_by("part"))
        sums = dealt_out.applyInArrow(ring_search.sum_up_held(regions, held), found)
    else:
        areas_dealt = areas.repartition(number, "part").groupBy("part")
        sums = dealt_out.cogroup(areas_dealt).applyInArrow(ring_search.sum_up(regions), found)
    return sums.groupBy("name").agg(*(F.sum(c).alias(c) for c in ("tile_count", "total_tests")))
