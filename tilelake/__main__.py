"""``python -m tilelake BRONZE SILVER [--gazetteer PATH]``: the bronze-to-silver job.

Also runs under spark-submit; masters, memory and storage access are its settings.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from tilelake.operators.geocode import PlaceIndex, build_place_index, read_place_index, write_place_index
from tilelake.plans import bronze_to_silver
from tilelake.sources import file_count, list_files


def stored_index(spark: SparkSession, path: str, gazetteer: DataFrame | None) -> PlaceIndex:
    """The index in ``path``; without one it is built from the gazetteer and stored there."""
    if file_count(list_files(spark, path)).first()["path_exists"] or gazetteer is None:
        return read_place_index(spark, path)
    index = build_place_index(gazetteer)
    write_place_index(index, path)
    return index


def main() -> None:
    parser = argparse.ArgumentParser(prog="tilelake", description="Clean and enrich bronze tiles into silver.")
    parser.add_argument("bronze", help="folder of raw tiles")
    parser.add_argument("silver", help="folder of the silver table")
    parser.add_argument("--quarter", help="quarter to read, a sub-folder or landed partition such as 2019-q1; its earlier rows are replaced")
    parser.add_argument("--gazetteer", help="parquet places: name, admin1, cc, glat, glon")
    parser.add_argument("--index", help="folder of a stored place index; built from the gazetteer and stored there if it does not exist")
    parser.add_argument("--projection", choices=["linear", "mercator"], default="linear")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("tilelake bronze to silver").getOrCreate()
    try:
        gazetteer = spark.read.parquet(args.gazetteer) if args.gazetteer else None
        index = stored_index(spark, args.index, gazetteer) if args.index else None
        bronze_to_silver(
            spark,
            args.bronze,
            args.silver,
            gazetteer=gazetteer,
            index=index,
            projection=args.projection,
            quarter=args.quarter,
        )
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
