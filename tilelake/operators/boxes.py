"""Tiles inside named bounding boxes, by sums of cells inside and tiles along the border."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.functions import is_location
from tilelake.operators.area_sums import MAX_BROADCAST_BYTES, MAX_LEVEL, SLACK, CellTree, cell_tree, sums_of_areas

# Corners of a box besides its name, in memory.
_CORNER_BYTES = 32


def _box_cells(boxes: DataFrame, max_level: int = MAX_LEVEL) -> DataFrame:
    """Each box with the cells it touches (the whole globe for boxes larger than it), on the finest level whose cells are at least
    half as wide and high as the box: nine cells at most. Boxes over the 180th meridian
    (lon_min > lon_max) are cut in two there."""
    whole = F.struct(F.col("lon_min").alias("west"), F.col("lon_max").alias("east"))
    eastern = F.struct(F.col("lon_min").alias("west"), F.lit(180.0).alias("east"))
    western = F.struct(F.lit(-180.0).alias("west"), F.col("lon_max").alias("east"))
    pieces = boxes.select(
        "name", "lat_min", "lat_max",
        F.inline(F.when(F.col("lon_min") <= F.col("lon_max"), F.array(whole)).otherwise(F.array(eastern, western))),
    )
    finest = 2.0**-max_level
    share = F.greatest(
        (F.col("east") - F.col("west")) / 360.0, (F.col("lat_max") - F.col("lat_min")) / 180.0, F.lit(finest)
    )
    level = F.least(F.greatest(F.floor(-F.log2(share)) + 1, F.lit(0)), F.lit(max_level))
    leveled = pieces.withColumn("level", level.cast("int"))
    n = F.call_function("shiftleft", F.lit(1), F.col("level"))
    index = lambda value, offset, extent: F.least(
        F.greatest(F.floor((value + offset) / extent * n), F.lit(0)), n - 1
    ).cast("int")
    return leveled.withColumn(
        "cell_x", F.explode(F.sequence(index(F.col("west"), 180.0, 360.0), index(F.col("east"), 180.0, 360.0)))
    ).withColumn(
        "cell_y", F.explode(F.sequence(index(F.col("lat_min"), 90.0, 180.0), index(F.col("lat_max"), 90.0, 180.0)))
    )


class _Boxes:
    """How boxes are cut: a cell is inside when it is, with a slack, between the corners."""

    payload = ["lat_min", "lat_max", "west", "east"]
    payload_bytes = str(_CORNER_BYTES)

    @staticmethod
    def cells(boxes: DataFrame, tree: CellTree) -> DataFrame:
        return _Boxes._placed(_box_cells(boxes, min(tree.base, MAX_LEVEL)))

    @staticmethod
    def _placed(cells: DataFrame) -> DataFrame:
        """Cells that the box touches, told whether it holds all of them."""
        n = F.call_function("shiftleft", F.lit(1), F.col("level"))
        low = lambda at, extent: F.col(at) / n * extent - extent / 2
        high = lambda at, extent: (F.col(at) + 1) / n * extent - extent / 2
        # a bound beyond the globe's edge holds whatever is at the edge
        apart = lambda a, b, at, extent: (F.col(a) > high(at, extent) + SLACK) | (F.col(b) < low(at, extent) - SLACK)
        within = lambda a, b, at, extent: (F.col(a) <= low(at, extent) - SLACK) & (F.col(b) >= high(at, extent) + SLACK)
        ways = (("west", "east", "cell_x", 360.0), ("lat_min", "lat_max", "cell_y", 180.0))
        return cells.filter(~apart(*ways[0]) & ~apart(*ways[1])).withColumn("inner", within(*ways[0]) & within(*ways[1]))

    @staticmethod
    def cut(children: DataFrame) -> DataFrame:
        return _Boxes._placed(children)

    @staticmethod
    def holds(latitude: Column, longitude: Column) -> Column:
        return latitude.between(F.col("lat_min"), F.col("lat_max")) & longitude.between(F.col("west"), F.col("east"))


def tiles_in_boxes(
    tiles: DataFrame,
    boxes: DataFrame,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    shares: int | None = None,
) -> DataFrame:
    """Tiles and tests inside each box, borders included; boxes without tiles are left out.

    ``boxes`` has name, lat_min, lat_max, lon_min, lon_max. Tiles are summed up per location and per cell; a box takes the
    sums of the cells inside it and meets single locations only in cells along its border (see ``sums_of_areas``).
    """
    located = tiles.filter(is_location(F.col("latitude"), F.col("longitude")))
    return sums_of_areas(cell_tree(located, shares), boxes, _Boxes, max_broadcast_bytes, shares)
