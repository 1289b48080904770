"""Tiles and tests inside areas of any form: sums of whole cells inside, single locations along the border.

Tiles are summed up once per location and per cell of a pyramid of grids, whose finest cells hold few locations. Areas go
down that pyramid: of the cells that an area touches, those inside it give their sums, those on its border are cut, and
only the finest border cells meet their locations. So the work of an area grows with the length of its border, as the
square root of the locations inside, and copies of a tile cost nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.functions import grid_cell
from tilelake.operators.skew import salted_join
from tilelake.runtime import checkpointed

# Areas start at this level at most; crowded cells are cut down to cells of 2 m.
MAX_LEVEL = 20
_DEEPEST = 24
# Widens every cell in degrees, so that rounding cannot hide a border from a cell that it touches.
SLACK = 1e-9
# Locations in a finest cell on average, and the most before it is cut further.
_LEAF_LOCATIONS = 64
_MOST_LOCATIONS = 4 * _LEAF_LOCATIONS
# Levels that a cell on a border is cut by at once, into 4^2 cells.
_STEP = 2
# Upper estimate of one cell in memory, without the name and payload of its area.
CELL_BYTES = 120
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# So many crowded cells are broadcast for certain.
_FEW_CELLS = 100_000

_CELL = ["level", "cell_x", "cell_y"]
_SUMS = ["tile_count", "total_tests"]


@dataclass(frozen=True)
class CellTree:
    """Sums of all occupied cells down to level ``base`` and of the cells of crowded cells below it, and the locations by the
    finest cell they are in."""

    sums: DataFrame
    locations: DataFrame
    base: int


def _total() -> list:
    return [F.sum(c).alias(c) for c in _SUMS]


def cell_tree(located: DataFrame, shares: int | None = None) -> CellTree:
    """The pyramid over tiles with valid ``latitude`` and ``longitude`` and their ``tests``."""
    at = ["latitude", "longitude"]
    spots = checkpointed(located.groupBy(*at).agg(F.count(F.lit(1)).alias("tile_count"), F.sum("tests").alias("total_tests")))
    count = spots.count()
    base = level = min(max(math.ceil(math.log(max(count, 1) / _LEAF_LOCATIONS, 4)), 0), MAX_LEVEL)
    sums, locations, crowd = [], [], spots
    while True:
        x, y = grid_cell(F.col("latitude"), F.col("longitude"), level)
        keyed = crowd.select(*at, *_SUMS, F.lit(level).alias("level"), x.alias("cell_x"), y.alias("cell_y"))
        cells = checkpointed(keyed.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("locations"), *_total()))
        is_crowded = (F.col("locations") > _MOST_LOCATIONS) & F.lit(level < _DEEPEST)
        sums.append(cells.withColumn("finest", ~is_crowded))
        crowded = cells.filter(is_crowded).select(*_CELL, F.col("locations").alias("rows"))
        few = crowded.count()
        if not few:
            locations.append(keyed)
            break
        if few <= _FEW_CELLS:
            crowded = F.broadcast(crowded)
            locations.append(keyed.join(crowded, _CELL, "left_anti"))
            crowd = keyed.join(crowded, _CELL, "left_semi")
        else:
            marked = checkpointed(salted_join(keyed, crowded.withColumn("crowded", F.lit(True)).drop("rows"), _CELL, cells.withColumnRenamed("locations", "rows"), "left", shares))
            locations.append(marked.filter(F.col("crowded").isNull()).drop("crowded"))
            crowd = marked.filter("crowded")
        level = min(level + _STEP, _DEEPEST)
    above = sums[0]
    for level in range(base - 1, -1, -1):
        up = [F.lit(level).alias("level"), *(F.shiftright(c, 1).alias(c) for c in _CELL[1:])]
        above = above.groupBy(*up).agg(F.sum("locations").alias("locations"), *_total()).withColumn("finest", F.lit(False))
        # from here the cells are few
        above = checkpointed(above) if level in (base - 1, base - 3) else above
        sums.append(above)
    return CellTree(checkpointed(reduce(DataFrame.unionByName, sums)), reduce(DataFrame.unionByName, locations), base)


def _dealt(cells: DataFrame, shares: int | None, *also: str) -> DataFrame:
    return cells.repartition(shares or int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), *_CELL, *also)


def _met(areas: DataFrame, cells: DataFrame, size: int, max_broadcast_bytes: int, shares: int | None) -> DataFrame:
    """``areas`` with what is at their cells: broadcast if small, else with the cells of very many areas split."""
    if size <= max_broadcast_bytes:
        # dealt out: few bytes of cells meet very many areas
        return _dealt(cells, shares).join(F.broadcast(areas), _CELL)
    return salted_join(areas, cells, _CELL, areas.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("rows")), "inner", shares)


def sums_of_areas(tree: CellTree, areas: DataFrame, shape, max_broadcast_bytes: int, shares: int | None) -> DataFrame:
    """Tiles and tests by the name of the areas that they are in; names without tiles are left out.

    ``shape`` says how areas are cut: ``cells(areas, tree)`` gives the cells that an area touches, as name, level (up to the
    tree's base), cell_x, cell_y, its ``payload`` columns and ``inner``, whether the area holds all of the cell; ``cut`` places
    smaller cells of these alike and drops those outside; ``holds`` tests one location against the payload. Of the
    sums, only rows per name leave a task. While the areas' cells fit ``max_broadcast_bytes`` they are broadcast to the sums and
    locations, beyond that both are joined by a shuffle, cells of very many areas split.
    """
    found, border = [], []
    around = checkpointed(shape.cells(areas, tree))
    while True:
        size = _size(around, shape)
        if not size["cells"]:
            break
        met = checkpointed(_met(around, tree.sums, size["bytes"], max_broadcast_bytes, shares))
        found.append(met.filter("inner").groupBy("name").agg(*_total()))
        border.append(met.filter("NOT inner AND finest").select("name", *_CELL, *shape.payload))
        open_cells = met.filter("NOT inner AND NOT finest").select("name", *_CELL, *shape.payload)
        # down to the base, and below it by whole steps, as the tree was made
        cuts = F.when(F.col("level") < tree.base, F.least(tree.base - F.col("level"), F.lit(_STEP)))
        cuts = cuts.otherwise(F.least(_DEEPEST - F.col("level"), F.lit(_STEP))).cast("int")
        around = checkpointed(shape.cut(_children(_dealt(open_cells.withColumn("cuts", cuts), shares, "name"))))
    if not found:
        return around.groupBy("name").agg(*(F.sum(F.lit(0).cast("long")).alias(c) for c in _SUMS))
    pairs = checkpointed(reduce(DataFrame.unionByName, border))
    met = _met(pairs, tree.locations, _size(pairs, shape)["bytes"], max_broadcast_bytes, shares)
    alone = met.filter(shape.holds(F.col("latitude"), F.col("longitude"))).groupBy("name").agg(*_total())
    return reduce(DataFrame.unionByName, found, alone).groupBy("name").agg(*_total())


def _size(cells: DataFrame, shape):
    name_bytes = F.coalesce(F.octet_length("name"), F.lit(0))
    return cells.agg(
        F.count(F.lit(1)).alias("cells"),
        F.coalesce(F.sum(name_bytes + F.expr(shape.payload_bytes) + CELL_BYTES), F.lit(0)).alias("bytes"),
    ).first()


def _children(cells: DataFrame) -> DataFrame:
    """The 4^cuts cells that each cell is cut into."""
    kept = [c for c in cells.columns if c not in (*_CELL, "cuts")]
    return cells.select("*", F.expr("explode(sequence(0, shiftleft(1, 2 * cuts) - 1)) AS sub")).selectExpr(
        *(f"`{c}`" for c in kept),
        "level + cuts AS level",
        "shiftleft(cell_x, cuts) + sub % shiftleft(1, cuts) AS cell_x",
        "shiftleft(cell_y, cuts) + shiftright(sub, cuts) AS cell_y",
    )
