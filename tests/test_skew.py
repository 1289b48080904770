from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tilelake.operators.boxes import tiles_in_boxes
from tilelake.operators.skew import salted_join


def hot_rows(spark):
    """A third of 3,000 rows has key 7, a third has none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50)
    return spark.range(3000).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    left = hot_rows(spark)
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    right = right.union(spark.sql("SELECT 7L, 71L"))
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("rows"))
    salted = salted_join(left, right, ["k"], counts, how, shares=8).select("id", "k", "v")
    plain = left.join(right, ["k"], how).select("id", "k", "v")
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_hot_and_missing_keys_are_spread(spark):
    left = hot_rows(spark).repartition(4)
    right = spark.range(40).select(F.col("id").alias("k"), F.col("id").alias("v"))
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("rows"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(left, right, ["k"], counts, shares=8)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 3000
    assert max(r["count"] for r in sizes) < 1000


def test_unknown_join_type(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="unsupported join type"):
        salted_join(df, df, ["id"], df, "full")


BOXES = [
    ("world", -90.0, 90.0, -180.0, 180.0),
    ("seam", -10.0, 10.0, 170.0, -170.0),
    ("point", 5.0, 5.0, 5.0, 5.0),
    ("pole", 80.0, 90.0, -180.0, 180.0),
    ("small", 5.0, 5.25, 5.0, 5.25),
    ("wide", -1.0, 1.0, -100.0, 100.0),
    ("nowhere", 60.0, 60.1, 60.0, 60.1),
]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_tiles_in_boxes(spark, limit):
    points = [(5.0, 5.0)] * 50 + [(5.25, 5.25), (5.3, 5.0), (0.0, 180.0), (0.0, -180.0), (10.0, 170.0), (10.0, 169.9)]
    points += [(90.0, 0.0), (-90.0, 0.0), (85.0, 12.0), (0.5, 99.0), (None, 0.0)]
    tiles = spark.createDataFrame([(a, b, 2) for a, b in points], "latitude double, longitude double, tests long")
    boxes = spark.createDataFrame(BOXES, "name string, lat_min double, lat_max double, lon_min double, lon_max double")
    expected = {}
    for name, south, north, west, east in BOXES:
        inside = [
            p for p in points
            if p[0] is not None and south <= p[0] <= north
            and (west <= p[1] <= east if west <= east else p[1] >= west or p[1] <= east)
        ]
        if inside:
            expected[name] = (len(inside), 2 * len(inside))
    found = tiles_in_boxes(tiles, boxes, max_broadcast_bytes=limit, shares=4).collect()
    assert {r.name: (r.tile_count, r.total_tests) for r in found} == expected
    assert tiles_in_boxes(tiles, boxes.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [0, 10**9])
def test_boxes_meet_only_locations_along_their_border(spark, limit, monkeypatch):
    """Every box holds most of the tiles, but is tested against few of them."""
    from tilelake.operators import area_sums

    met = []
    monkeypatch.setattr(area_sums, "_met", lambda areas, cells, *how, _met=area_sums._met: met.append(_met(areas, cells, *how)) or met[-1])
    side = 90
    spots = [((i // side) * 1.0 - 44.5, (i % side) * 2.0 - 89.5, 3) for i in range(side * side)]
    tiles = spark.createDataFrame(spots, "latitude double, longitude double, tests long")
    corners = [(f"box {k}", -30.0 - k / 7, 30.0 + k / 7, -60.0 - k / 7, 60.0 + k / 7) for k in range(40)]
    boxes = spark.createDataFrame(corners, "name string, lat_min double, lat_max double, lon_min double, lon_max double")
    found = {r.name: (r.tile_count, r.total_tests) for r in tiles_in_boxes(tiles, boxes, max_broadcast_bytes=limit, shares=4).collect()}
    expected = {n: sum(s <= a <= t and w <= b <= e for a, b, _ in spots) for n, s, t, w, e in corners}
    assert found == {n: (c, 3 * c) for n, c in expected.items()}
    assert sum(m.count() for m in met) < sum(expected.values())


def test_boxes_around_crowded_tiles(spark):
    """Most locations lie in one small cell, which is cut further than the others."""
    spots = [(10 + i / 1e5, 20 + j / 1e5, 1) for i in range(60) for j in range(60)] + [(float(i), float(-i), 1) for i in range(80)]
    tiles = spark.createDataFrame(spots, "latitude double, longitude double, tests long")
    corners = [(f"box {k}", 10.0, 10 + k / 1e5, 20.0, 20 + 2 * k / 1e5) for k in range(0, 60, 7)] + [("all", -90.0, 90.0, -180.0, 180.0)]
    boxes = spark.createDataFrame(corners, "name string, lat_min double, lat_max double, lon_min double, lon_max double")
    found = {r.name: r.tile_count for r in tiles_in_boxes(tiles, boxes, shares=4).collect()}
    assert found == {n: sum(s <= a <= t and w <= b <= e for a, b, _ in spots) for n, s, t, w, e in corners}
