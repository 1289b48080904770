from tilelake.functions.geo import (
    chord,
    grid_cell,
    is_location,
    is_quadkey,
    unit_vector,
    with_centers,
)
from tilelake.functions.text import UNKNOWN, city_label, percent, place_preference, quarter_of, tile_quarter

__all__ = [
    "UNKNOWN",
    "chord",
    "city_label",
    "grid_cell",
    "is_location",
    "is_quadkey",
    "percent",
    "place_preference",
    "quarter_of",
    "tile_quarter",
    "unit_vector",
    "with_centers",
]
