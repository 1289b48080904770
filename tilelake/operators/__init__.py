from tilelake.operators.analytics import (
    city_speed,
    city_stats,
    describe_flags,
    describe_numeric,
    describe_text,
    first_rows,
    gold_city_month,
    quality_histogram,
    run_statistics,
    top_cities,
)
from tilelake.operators.boxes import tiles_in_boxes
from tilelake.operators.geocode import (
    PlaceIndex,
    build_place_index,
    read_place_index,
    with_cities,
    without_cities,
    write_place_index,
)
from tilelake.operators.layout import add_partition_columns
from tilelake.operators.polygons import tiles_in_polygons
from tilelake.operators.quality import clean, cleaning_report, trim_keys

__all__ = [
    "PlaceIndex",
    "add_partition_columns",
    "build_place_index",
    "city_speed",
    "city_stats",
    "clean",
    "cleaning_report",
    "describe_flags",
    "describe_numeric",
    "describe_text",
    "first_rows",
    "gold_city_month",
    "quality_histogram",
    "read_place_index",
    "run_statistics",
    "tiles_in_boxes",
    "tiles_in_polygons",
    "top_cities",
    "trim_keys",
    "with_cities",
    "without_cities",
    "write_place_index",
]
