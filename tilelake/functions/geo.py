"""Quadkey and sphere geometry as column expressions (no UDF, whole-stage codegen)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Latitude limit of the tile pyramid, and its extent in degrees.
LAT_LIMIT = 85.05112878
LON_LIMIT = 180.0


def is_quadkey(quadkey: Column, max_length: int = 30) -> Column:
    """True when the text has 1..max_length characters, all of them 0-3; false for null.

    ``\\z`` rather than ``$``: the latter also accepts a trailing newline.
    """
    return F.coalesce(quadkey.rlike(rf"^[0-3]{{1,{max_length}}}\z"), F.lit(False))


# Masks of the steps that gather every second bit of a 64-bit integer.
_EVERY_SECOND_BIT = 0x5555555555555555
_GATHER_STEPS = [
    (1, 0x3333333333333333),
    (2, 0x0F0F0F0F0F0F0F0F),
    (4, 0x00FF00FF00FF00FF),
    (8, 0x0000FFFF0000FFFF),
    (16, 0x00000000FFFFFFFF),
]
# Keys up to this length fit a 64-bit integer, two bits per digit.
_PACKED_DIGITS = 31
# Digits past this one move a cell centre by less than the precision of a double.
_MAX_DIGITS = 52


def _row_latitude(y: Column, cells: Column, projection: str) -> Column:
    if projection == "linear":
        return LAT_LIMIT - (y + 0.5) * (2 * LAT_LIMIT) / cells
    return F.degrees(F.atan(F.sinh(math.pi * (1.0 - 2.0 * (y + 0.5) / cells))))


def with_centers(
    df: DataFrame,
    quadkey: str = "quadkey",
    projection: str = "linear",
    lenient: bool = False,
    checked: bool = False,
) -> DataFrame:
    """Add ``latitude`` and ``longitude``, the centre of each quadkey's cell.

    Strict: null, empty or a character outside 0-3 gives (0, 0).
    Lenient: characters outside 0-3 are skipped; nothing left gives (0, 0).
    ``linear`` halves the latitude range once per digit; ``mercator`` gives the
    true latitude of the tile row. ``checked`` says that the keys were already
    filtered with ``is_quadkey`` and skips the test.

    The key is read once as a base-4 number whose even bits are the cell's column and
    odd bits its row; integer arithmetic separates them. Each step is a projection of
    its own so that its two uses of the step before are not expanded into copies.
    """
    if projection not in ("linear", "mercator"):
        raise ValueError(f"unknown projection {projection!r}: use 'linear' or 'mercator'")
    columns = [c for c in df.columns if c not in ("latitude", "longitude")]
    key = F.col(quadkey)
    if lenient:
        digits = F.regexp_replace(key, "[^0-3]", "")
        digits = F.when(digits != "", digits)
    elif checked:
        digits = key
    else:
        digits = F.when(key.rlike(r"^[0-3]+\z"), key)
    out = df.select(*columns, digits.alias("__digits"))
    out = out.withColumns(
        {
            "__bits": F.conv(F.substring("__digits", 1, _PACKED_DIGITS), 4, 10).cast("long"),
            "__length": F.length("__digits"),
        }
    )
    out = out.withColumns(
        {
            "__x": F.col("__bits").bitwiseAND(F.lit(_EVERY_SECOND_BIT)),
            "__y": F.shiftright("__bits", 1).bitwiseAND(F.lit(_EVERY_SECOND_BIT)),
        }
    )
    for shift, mask in _GATHER_STEPS:
        out = out.withColumns(
            {c: F.col(c).bitwiseOR(F.shiftright(c, shift)).bitwiseAND(F.lit(mask)) for c in ("__x", "__y")}
        )
    # longer keys are rare: their bits are spelled out as binary text instead
    is_long = F.col("__length") > _PACKED_DIGITS
    digits = F.substring("__digits", 1, _MAX_DIGITS)
    binary = lambda ones, bits: F.conv(F.translate(digits, ones, bits), 2, 10).cast("long")
    x = F.when(is_long, binary("23", "01")).otherwise(F.col("__x"))
    y = F.when(is_long, binary("123", "011")).otherwise(F.col("__y"))
    cells = F.call_function("shiftleft", F.lit(1).cast("long"), F.least("__length", F.lit(_MAX_DIGITS)))
    cells = cells.cast("double")
    center = F.struct(
        F.coalesce(_row_latitude(y, cells, projection), F.lit(0.0)).alias("latitude"),
        F.coalesce((x + 0.5) * (2 * LON_LIMIT) / cells - LON_LIMIT, F.lit(0.0)).alias("longitude"),
    )
    # A generator keeps filters on the coordinates above it; pushed through the steps
    # they would evaluate each step's input twice, 64 times in all.
    return out.select(*columns, F.inline(F.array(center)))


def is_location(lat: Column, lon: Column) -> Column:
    """True for finite coordinates on the globe; false for null and NaN."""
    return F.coalesce(lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0), F.lit(False))


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The point on the unit sphere; straight-line distance between two such points
    orders pairs exactly as great-circle distance does, with no seam and no poles."""
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def chord(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    """Straight-line distance between two points of the unit sphere."""
    dx, dy, dz = (p - q for p, q in zip(a, b))
    return F.sqrt(dx * dx + dy * dy + dz * dz)


def grid_cell(lat: Column, lon: Column, level: int) -> tuple[Column, Column]:
    """Column and row of a location in the 2^level x 2^level grid over the whole globe.

    Null or NaN coordinates fall in some cell of the grid too, so that a join on
    cells keeps their rows.
    """
    n = 1 << level
    x = F.floor((F.coalesce(F.nanvl(lon, F.lit(0.0)), F.lit(0.0)) + 180.0) / 360.0 * n)
    y = F.floor((F.coalesce(F.nanvl(lat, F.lit(0.0)), F.lit(0.0)) + 90.0) / 180.0 * n)
    bound = lambda c: F.least(F.greatest(c, F.lit(0)), F.lit(n - 1)).cast("int")
    return bound(x), bound(y)
