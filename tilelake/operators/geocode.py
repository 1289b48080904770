"""Exact nearest-place lookup as equi-joins on grid cells.

The gazetteer is turned into a *place index* once: the globe is cut into leaf cells,
finer where places are dense, and each leaf keeps every place that may be nearest to
some point of it. A location then only meets the few places of its own leaf. While the
index is small enough to broadcast (its size is measured), the measurements are never
shuffled; beyond that, distinct locations are joined on their leaf and the answer is
joined back, with hot leaves and hot locations split.

Distances are chords of the unit sphere. They obey the triangle inequality and order
pairs as great-circle distances do, without special cases at the poles or the 180th
meridian. Equal distances (to within 1e-12 of the earth's radius) go to the
alphabetically first label.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tilelake.functions import UNKNOWN, chord, city_label, grid_cell, is_location, unit_vector
from tilelake.operators.skew import salted_join
from tilelake.runtime import checkpointed

# A cell is a leaf once at most this many places are in reach of it.
LEAF_PLACES = 16
# Query cells start at 256 cells and go down to 2 m, place cells to 4 cm: a place cell that holds several places blurs
# which of them is on the near side, for all query cells around.
FIRST_LEVEL = 4
MAX_LEVEL = 24
MAX_PLACE_LEVEL = 30
_PLACE_LEVEL_STEP = 4
# A query cell is cut before its place cells are single places only above so many leaves' worth of them.
_WIDE_REACH = 8
# Cells with at most this many places are refined to single places in one round.
_SMALL_CROWD = 64
# Grids up to this level have at most 65,536 cells: small enough to broadcast always.
_BROADCAST_LEVEL = 8
# Up to so many levels a row is copied for each, which costs less than looking them up.
_FEW_LEVELS = 2
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
# Size of one place in a broadcast leaf, without its label.
_PLACE_BYTES = 80
# Bounds are compared with this margin, far above rounding errors and about 1 cm.
_MARGIN = 2e-9
_TIE_SCALE = 1e12
# Known places that every other place in reach of a cell is held against. The margin of their bisectors keeps
# places whose distances may agree to within a tie: it grows with the distance (above 1 / _TIE_SCALE of it), so that places a
# few metres apart are told from each other nearby as well; the fixed part is above rounding errors.
_RIVALS = 48
_BISECTOR_TIE = 2e-12
_BISECTOR_ROUNDING = 1e-14

_LEAF = ["level", "cell_x", "cell_y"]
# Places of a leaf that are compared in generated code, a column expression each; leaves with more are walked place by place.
_SLOTS = LEAF_PLACES


@dataclass(frozen=True)
class PlaceIndex:
    """Leaf cells and their candidate places, one row per (leaf, place)."""

    places: DataFrame
    levels: tuple[int, ...]
    rows: int
    size_bytes: int

    @property
    def is_empty(self) -> bool:
        return self.rows == 0


def _xyz(prefix: str) -> tuple[Column, Column, Column]:
    return F.col(f"{prefix}x"), F.col(f"{prefix}y"), F.col(f"{prefix}z")


def _vector_columns(prefix: str, lat: Column, lon: Column) -> dict[str, Column]:
    return dict(zip((f"{prefix}x", f"{prefix}y", f"{prefix}z"), unit_vector(lat, lon)))


def _distinct_places(gazetteer: DataFrame) -> DataFrame:
    """One row per coordinate with its first label; places without coordinates drop out."""
    labelled = gazetteer.filter(is_location(F.col("glat"), F.col("glon"))).select(
        # adding 0.0 turns -0.0 into 0.0
        (F.col("glat") + 0.0).alias("glat"),
        (F.col("glon") + 0.0).alias("glon"),
        city_label(F.col("name"), F.col("admin1"), F.col("cc")).alias("label"),
        F.col("name").isNotNull().alias("named"),
    )
    first = labelled.groupBy("glat", "glon").agg(F.min(F.struct("label", "named")).alias("place"))
    return first.select("glat", "glon", "place.label", "place.named", *(
        c.alias(n) for n, c in _vector_columns("p", F.col("glat"), F.col("glon")).items()
    ))


def _distance(a: str, b: str) -> Column:
    """Chord between the vectors in columns ``ax, ay, az`` and ``bx, by, bz``."""
    squares = (f"({a}{axis} - {b}{axis}) * ({a}{axis} - {b}{axis})" for axis in "xyz")
    return F.expr(f"sqrt({' + '.join(squares)})")


def _cell_geometry(prefix: str, level: str, x: str, y: str) -> dict[str, Column]:
    """Centre of a grid cell as a unit vector, and the chord to its farthest point.

    For cells at most 180 degrees wide that point is a corner.
    """
    n = f"double(shiftleft(1, {level}))"
    lat, lon = f"radians(({y} + 0.5D) * 180D / {n} - 90D)", f"radians(({x} + 0.5D) * 360D / {n} - 180D)"
    # half the height of the cell; half its width is twice that
    half = f"radians(90D / {n})"
    widest = f"greatest(cos({lat} - {half}), cos({lat} + {half}), 0D)"
    height, width = f"sin({half} / 2D) * sin({half} / 2D)", f"sin({half}) * sin({half})"
    return {
        f"{prefix}x": F.expr(f"cos({lat}) * cos({lon})"),
        f"{prefix}y": F.expr(f"cos({lat}) * sin({lon})"),
        f"{prefix}z": F.expr(f"sin({lat})"),
        f"{prefix}_radius": F.expr(f"2D * sqrt({height} + cos({lat}) * {widest} * {width})"),
    }


def _occupied_cells(places: DataFrame, level: int, parent_level: int) -> DataFrame:
    """Cells of one level that hold places: how many, one of them, the cell's centre
    and radius, and its parent cell. A cell with a single place shrinks to that place."""
    x, y = grid_cell(F.col("glat"), F.col("glon"), level)
    steps = level - parent_level
    cells = (
        places.groupBy(x.alias("gx"), y.alias("gy"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("px", "py", "pz")).alias("known"))
        .withColumns(_cell_geometry("c", str(level), "gx", "gy"))
        .selectExpr(
            "gx", "gy", "n", "known",
            *(f"if(n = 1, known.p{axis}, c{axis}) AS c{axis}" for axis in "xyz"),
            "if(n = 1, 0D, c_radius) AS c_radius",
            f"shiftright(gx, {steps}) AS up_x",
            f"shiftright(gy, {steps}) AS up_y",
        )
    )
    return F.broadcast(cells) if level <= _BROADCAST_LEVEL else cells


def _cells_in_reach(pairs: DataFrame) -> DataFrame:
    """Cut each query cell of ``pairs`` into 4^cuts subcells and keep the pairs where
    the place cell may hold the nearest place of some point of the subcell.

    Let q be the subcell's centre, R its radius, r the known place closest to q, and
    c and S the place cell's centre and radius. The advantage of r, |p-c| - |p-r|,
    changes by at most L per unit of way from p = q to another point p of the subcell,
    with L = 2|c-r| / (|p-c| + |p-r|) (Dunkl and Williams 1964) and never above 2. If it
    exceeds L * R + S at q, then r is closer than every place of the cell throughout
    the subcell. Seen from afar L is small, so a distant dense cluster is reduced to
    the places on its near side without cutting the query cell.

    A cell is also held against the known places closest to q, each as b: p is closer to b
    than to a where p.(b - a) > 0. For a single place at c, p.(b - c) is at least
    q.(b - c) - R |b - c| in the subcell; a place up to S away from c takes at most
    S (|p-c| + S / 2) from that. So a leaf keeps the places that may own a part of it, few
    of a cluster however dense, since from outside only its hull owns anything.

    Pairs are shuffled once, before they are multiplied: subcells stay with their
    parent cell, which also serves the windows. ``reach`` counts the place cells left
    to a subcell and ``crowd`` is the most places one of them holds.
    """
    partitions = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_subcell = Window.partitionBy(*_LEAF, "sub_x", "sub_y")
    distances = (
        pairs.repartition(partitions, *_LEAF)
        .selectExpr("*", "explode(sequence(0, shiftleft(1, 2 * cuts) - 1)) AS sub")
        .selectExpr(
            "*",
            "level + cuts AS sub_level",
            "shiftleft(cell_x, cuts) + sub % shiftleft(1, cuts) AS sub_x",
            "shiftleft(cell_y, cuts) + shiftright(sub, cuts) AS sub_y",
        )
        .withColumns(_cell_geometry("q", "sub_level", "sub_x", "sub_y"))
        .withColumns({"center_distance": _distance("q", "c"), "distance": _distance("q", "known.p")})
        .withColumn("nearest", F.min(F.struct("distance", "known")).over(per_subcell))
        .withColumn("rank", F.row_number().over(per_subcell.orderBy("distance", "known")))
        .withColumn("rivals", F.collect_list(F.when(F.col("rank") <= _RIVALS, F.col("known"))).over(per_subcell))
    )
    toward = " + ".join(f"q{axis} * (b.p{axis} - c{axis})" for axis in "xyz")
    apart = " + ".join(f"(b.p{axis} - c{axis}) * (b.p{axis} - c{axis})" for axis in "xyz")
    owns_nothing = f"exists(rivals, b -> {toward} > q_radius * sqrt({apart}) + allowance)"
    allowance = (
        f"c_radius * (center_distance + q_radius + c_radius / 2D)"
        f" + {_BISECTOR_TIE}D * (center_distance + q_radius + c_radius) + {_BISECTOR_ROUNDING}D"
    )
    closest_way = "(center_distance + nearest.distance - 2D * q_radius)"
    return (
        distances.withColumn("apart", _distance("c", "nearest.known.p"))
        .withColumn("steepness", F.expr(f"if({closest_way} > 0D, least(2D, 2D * apart / {closest_way}), 2D)"))
        .filter(f"center_distance - nearest.distance <= steepness * q_radius + c_radius + {_MARGIN}D")
        .withColumn("allowance", F.expr(allowance))
        .filter(f"NOT ({owns_nothing})")
        .withColumns(
            {"reach": F.count(F.lit(1)).over(per_subcell), "crowd": F.max("n").over(per_subcell)}
        )
        .selectExpr(
            "sub_level AS level", "sub_x AS cell_x", "sub_y AS cell_y", "gx", "gy", "reach", "crowd"
        )
    )


def _places_of(leaves: DataFrame, places: DataFrame, place_level: int) -> DataFrame:
    x, y = grid_cell(F.col("glat"), F.col("glon"), place_level)
    return leaves.join(places.withColumns({"gx": x, "gy": y}), ["gx", "gy"]).select(
        *_LEAF, "px", "py", "pz", "label", "named"
    )


def build_place_index(
    gazetteer: DataFrame, leaf_places: int = LEAF_PLACES, max_level: int = MAX_LEVEL
) -> PlaceIndex:
    """Cut the globe into leaf cells and list each leaf's candidate places.

    Place cells are refined level by level until they hold one place each; a query
    cell is cut only while more than ``leaf_places`` place cells are in reach of it. A pair of cells is dropped as soon as the place cell is provably too far.
    Depends on the gazetteer only; each round is an equi-join of place cells with their
    parents and one shuffle.
    """
    places = checkpointed(_distinct_places(gazetteer))
    root = F.lit(0).cast("int")
    leaves = []
    if places.count() <= leaf_places:
        # few places: the whole globe is a single leaf
        leaves.append(
            places.select(*(root.alias(c) for c in _LEAF), "px", "py", "pz", "label", "named")
        )
    else:
        parent, level = 0, FIRST_LEVEL
        # the root cell with every occupied first-level cell: at most 4^4 pairs
        pairs = _occupied_cells(places, level, parent).withColumns(
            {**{c: root for c in _LEAF}, "cuts": F.lit(min(FIRST_LEVEL, max_level))}
        )
        while True:
            reached = checkpointed(_cells_in_reach(pairs))
            # cells of several places are refined first: of a crowd few places may be left, and then no cut is needed
            wanted = F.when((F.col("crowd") > 1) & F.lit(level < MAX_PLACE_LEVEL), F.when(F.col("reach") > _WIDE_REACH * leaf_places, 1).otherwise(0))
            wanted = wanted.when(F.col("reach") > 16 * leaf_places, 3).when(F.col("reach") > 4 * leaf_places, 2).when(F.col("reach") > leaf_places, 1).otherwise(0)
            cuts = F.least(wanted, F.lit(max_level) - F.col("level"))
            is_leaf = (cuts == 0) & ((F.col("crowd") == 1) | F.lit(level >= MAX_PLACE_LEVEL))
            leaves.append(_places_of(reached.filter(is_leaf), places, level))
            open_pairs = reached.filter(~is_leaf).select(
                *_LEAF, F.col("gx").alias("up_x"), F.col("gy").alias("up_y"), "crowd", cuts.alias("cuts")
            )
            crowd = open_pairs.agg(F.max("crowd")).first()[0]
            if crowd is None:
                break
            step = _PLACE_LEVEL_STEP if crowd > _SMALL_CROWD else MAX_PLACE_LEVEL
            parent, level = level, min(level + step, MAX_PLACE_LEVEL)
            pairs = open_pairs.join(_occupied_cells(places, level, parent), ["up_x", "up_y"])
    return _measured(checkpointed(reduce(DataFrame.unionByName, leaves)))


def _measured(candidates: DataFrame) -> PlaceIndex:
    size = candidates.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.octet_length("label")).alias("label_bytes"),
        F.array_sort(F.collect_set("level")).alias("levels"),
    ).first()
    return PlaceIndex(
        places=candidates,
        levels=tuple(size["levels"] or ()),
        rows=size["rows"],
        size_bytes=size["rows"] * _PLACE_BYTES + (size["label_bytes"] or 0),
    )


def write_place_index(index: PlaceIndex, path: str) -> None:
    """Store an index, to be built once for a gazetteer and read by every later run."""
    index.places.write.mode("overwrite").parquet(path)


def read_place_index(spark: SparkSession, path: str) -> PlaceIndex:
    """A stored index, measured again."""
    return _measured(spark.read.parquet(path))


def _tie_distance(distance: Column) -> Column:
    return F.floor(distance * _TIE_SCALE)


def _leaf_keys(levels: tuple[int, ...], prefix: str = "") -> Column:
    """The location's cell on every level of the index; exactly one of them is a leaf."""
    cells = []
    for level in levels:
        x, y = grid_cell(F.col("latitude"), F.col("longitude"), level)
        values = (F.lit(level), x, y)
        cells.append(F.struct(*(v.alias(prefix + c) for v, c in zip(values, _LEAF))))
    return F.array(*cells)


def _levels_directory(index: PlaceIndex, coarse: int) -> DataFrame:
    """The levels of the leaves in each cell of the level ``coarse``, at most 4^coarse rows."""
    below = f"greatest(level - {coarse}, 0)"
    above = f"greatest({coarse} - level, 0)"
    leaves = index.places.select(*_LEAF).distinct()
    steps = F.expr(f"sequence(0, shiftleft(1, 2 * {above}) - 1)")
    cells = leaves.select("*", F.explode(steps).alias("sub")).selectExpr(
        "level",
        f"shiftleft(shiftright(cell_x, {below}), {above}) + sub % shiftleft(1, {above}) AS __dir_x",
        f"shiftleft(shiftright(cell_y, {below}), {above}) + shiftright(sub, {above}) AS __dir_y",
    )
    return cells.groupBy("__dir_x", "__dir_y").agg(F.collect_set("level").alias("__levels"))


def _query_vector(prefix: str) -> dict[str, Column]:
    lat, lon = F.col("latitude"), F.col("longitude")
    valid = is_location(lat, lon)
    return {n: F.when(valid, c) for n, c in _vector_columns(prefix, lat, lon).items()}


def _with_match(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the city columns for the place in ``__match``, null if there is none."""
    match = F.col("__match")
    return df.select(
        *columns,
        F.coalesce(match["label"], F.lit(UNKNOWN)).alias("city"),
        F.coalesce(match["named"], F.lit(False)).alias("city_lookup_success"),
    )


def _leaf_name(prefix: str = "") -> Column:
    """A leaf's level and cell as one number, so that joins hash and compare a long."""
    level, x, y = (f"{prefix}{c}" for c in _LEAF)
    # from 4^level up, below 2 * 4^level: no two levels share a number
    return F.expr(f"shiftleft(1L, 2 * {level}) + shiftleft(bigint({x}), {level}) + {y}")


def _leaves(index: PlaceIndex) -> DataFrame:
    """One row per leaf with all its places in order of label, coordinates as arrays of their own."""
    place = F.struct("label", "named", "px", "py", "pz")
    leaves = index.places.groupBy(*_LEAF).agg(F.sort_array(F.collect_list(place)).alias("__sorted"))
    of = lambda c: F.col("__sorted")[c].alias(f"__{c}s")
    names = F.transform("__sorted", lambda p: F.struct(p["label"].alias("label"), p["named"].alias("named")))
    return leaves.select(_leaf_name().alias("__leaf"), names.alias("__names"), of("px"), of("py"), of("pz"))


def _nearest_of_leaf() -> Column:
    """The best of the leaf's places for the row's coordinates; null without valid coordinates.

    Places are in order of label, so of equal distances the first is the one with the first label: a place's distance and
    position make one number, whose minimum names the place.
    """
    query = _xyz("__q")
    at = lambda i: tuple(F.get(f"__{c}s", i) for c in ("px", "py", "pz"))
    numbered = lambda d, i, n: d * F.lit(n).cast("long") + i
    slots = F.least(*(numbered(_tie_distance(chord(query, at(F.lit(i)))), F.lit(i), _SLOTS) for i in range(_SLOTS)))
    # distances are below 2^41, so more than 4 million places would fit the number
    wide = 1 << 22
    every = F.array_min(
        F.transform(F.sequence(F.lit(0), F.size("__names") - 1), lambda i: numbered(_tie_distance(chord(query, at(i))), i, wide))
    )
    few = F.size("__names") <= _SLOTS
    best = F.when(few, F.pmod(slots, F.lit(_SLOTS))).otherwise(F.pmod(every, F.lit(wide)))
    return F.get("__names", F.when(F.col("__qx").isNotNull(), best).cast("int"))


def _with_leaf_keys(df: DataFrame, index: PlaceIndex) -> DataFrame:
    """``df`` with the cells that may be a row's leaf; exactly one of a row's copies has a leaf of the index."""
    # The leaves tile the globe and null coordinates are given a cell as well, so the
    # inner join with the leaves keeps each row exactly once.
    if len(index.levels) <= _FEW_LEVELS:
        return df.select("*", F.inline(_leaf_keys(index.levels, "__"))).select(*df.columns, _leaf_name("__").alias("__leaf"))
    # A directory tells which levels there are in a row's part of the globe, so that a row is
    # copied once for each of these and not for every level of the index.
    finest = max(index.levels)
    coarse = min(_BROADCAST_LEVEL, finest)
    x, y = grid_cell(F.col("latitude"), F.col("longitude"), finest)
    cells = df.withColumns({"__fine_x": x, "__fine_y": y})
    up = {f"__dir_{c}": F.shiftright(f"__fine_{c}", finest - coarse) for c in "xy"}
    return (
        cells.withColumns(up)
        .join(F.broadcast(_levels_directory(index, coarse)), ["__dir_x", "__dir_y"])
        .select(*df.columns, "__fine_x", "__fine_y", F.explode("__levels").alias("__level"))
        # a cell's column and row on a level are those of the finest level without their last bits
        .withColumns({f"__cell_{c}": F.expr(f"shiftright(__fine_{c}, {finest} - __level)") for c in "xy"})
        .select(*df.columns, _leaf_name("__").alias("__leaf"))
    )


def _with_cities_broadcast(df: DataFrame, index: PlaceIndex) -> DataFrame:
    looked_up = (
        _with_leaf_keys(df, index)
        .join(F.broadcast(_leaves(index)), "__leaf")
        .withColumns(_query_vector("__q"))
        .withColumn("__match", _nearest_of_leaf())
    )
    return _with_match(looked_up, df.columns)


def _with_cities_shuffled(df: DataFrame, index: PlaceIndex, shares: int | None) -> DataFrame:
    location, leaf = ["latitude", "longitude"], ["__leaf"]
    valid = is_location(F.col("latitude"), F.col("longitude"))
    rows_per_location = checkpointed(
        df.filter(valid).groupBy(*location).agg(F.count(F.lit(1)).alias("rows"))
    )
    probes = _with_leaf_keys(rows_per_location.select(*location), index)
    locations_per_leaf = probes.groupBy(*leaf).agg(F.count(F.lit(1)).alias("rows"))
    # a location meets its leaf once, with all places of the leaf, so its answer needs no further grouping
    nearest = (
        salted_join(probes, _leaves(index), leaf, locations_per_leaf, "inner", shares)
        .withColumns(_query_vector("__q"))
        .select(*location, _nearest_of_leaf().alias("__match"))
    )
    # rows without a valid location join on null, which is dealt out and never matches
    key = [f"__{c}" for c in location]
    joined = salted_join(
        df.withColumns({k: F.when(valid, F.col(c)) for k, c in zip(key, location)}),
        nearest.withColumnsRenamed(dict(zip(location, key))),
        key,
        rows_per_location.withColumnsRenamed(dict(zip(location, key))),
        "left",
        shares,
    )
    return _with_match(joined, df.columns)


def without_cities(df: DataFrame) -> DataFrame:
    """City columns for when no gazetteer is available."""
    return df.withColumns({"city": F.lit(UNKNOWN), "city_lookup_success": F.lit(False)})


def is_broadcast(index: PlaceIndex, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the lookup needs no shuffle: the measured index fits the broadcast limit."""
    return index.size_bytes <= max_broadcast_bytes


def with_cities(
    df: DataFrame,
    index: PlaceIndex | None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    shares: int | None = None,
) -> DataFrame:
    """Add ``city`` and ``city_lookup_success`` for the nearest place of each row.

    ``df`` has ``latitude`` and ``longitude``. Rows without valid coordinates, and all
    rows when there is no place at all, get "Unknown" and false.
    """
    if index is None or index.is_empty:
        return without_cities(df)
    if is_broadcast(index, max_broadcast_bytes):
        return _with_cities_broadcast(df, index)
    return _with_cities_shuffled(df, index, shares)
