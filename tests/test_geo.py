"""Quadkey centres against exact rational arithmetic."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tilelake.functions import chord, grid_cell, is_location, unit_vector, with_centers

LIMIT = Fraction("85.05112878")


def exact_center(key: str) -> tuple[float, float]:
    x = sum(int(d) % 2 * 2**i for i, d in enumerate(reversed(key)))
    y = sum(int(d) // 2 * 2**i for i, d in enumerate(reversed(key)))
    size = 2 ** len(key)
    lat = LIMIT - Fraction(2 * y + 1, 2 * size) * 2 * LIMIT
    lon = Fraction(2 * x + 1, 2 * size) * 360 - 180
    return float(lat), float(lon)


def centers(spark, keys, **how):
    df = spark.createDataFrame([(k,) for k in keys], "quadkey string")
    return {r.quadkey: (r.latitude, r.longitude) for r in with_centers(df, **how).collect()}


def random_keys(count, lengths, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice("0123") for _ in range(draw.choice(lengths))) for _ in range(count)]


@pytest.mark.parametrize("lengths", [range(1, 31), [31, 32, 33, 51, 52, 53, 60]])
def test_centers_are_exact(spark, lengths):
    keys = random_keys(1500, list(lengths)) + ["3" * n for n in lengths] + ["0" * n for n in lengths]
    for how in ({}, {"lenient": True}):
        for key, (lat, lon) in centers(spark, keys, **how).items():
            assert (lat, lon) == pytest.approx(exact_center(key), abs=1e-12)


def test_strict_gives_zero_for_bad_keys(spark):
    found = centers(spark, [None, "", "4", "01a", "012 ", "0123\n", "01-2"])
    assert set(found.values()) == {(0.0, 0.0)}


def test_lenient_skips_bad_characters(spark):
    found = centers(spark, [None, "", "abc", "0a1 2\n3", "9999"], lenient=True)
    assert found.pop("0a1 2\n3") == pytest.approx(exact_center("0123"), abs=1e-12)
    assert set(found.values()) == {(0.0, 0.0)}


def test_no_valid_key_has_the_center_of_bad_keys(spark):
    assert (0.0, 0.0) not in centers(spark, random_keys(500, range(1, 31))).values()


def test_mercator_rows(spark):
    keys = random_keys(500, range(1, 31), seed=2)
    linear = centers(spark, keys)
    for key, (lat, lon) in centers(spark, keys, projection="mercator").items():
        row = (1 - exact_center(key)[0] / float(LIMIT)) / 2
        assert lat == pytest.approx(math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * row)))), abs=1e-9)
        assert lon == linear[key][1]
    with pytest.raises(ValueError, match="unknown projection"):
        centers(spark, keys, projection="other")


def test_other_columns_stay_and_coordinates_are_replaced(spark):
    df = spark.createDataFrame([("03", 7, 1.0)], "quadkey string, n int, latitude double")
    assert with_centers(df).columns == ["quadkey", "n", "latitude", "longitude"]


def test_locations_and_cells(spark):
    nan = float("nan")
    rows = [(0.0, 0.0), (90.0, 180.0), (-90.0, -180.0), (90.1, 0.0), (0.0, -180.1), (None, 0.0), (0.0, None), (nan, 0.0), (0.0, nan)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    x, y = grid_cell(F.col("lat"), F.col("lon"), 3)
    got = df.select(is_location(F.col("lat"), F.col("lon")), x, y).collect()
    assert [r[0] for r in got] == [True] * 3 + [False] * 6
    assert all(0 <= r[1] < 8 and 0 <= r[2] < 8 for r in got)
    assert [tuple(r)[1:] for r in got[:3]] == [(4, 4), (7, 7), (0, 0)]


def test_chord_orders_like_the_great_circle(spark):
    df = spark.sql("SELECT rand(3)*180-90 a, rand(4)*360-180 b, rand(5)*180-90 c, rand(6)*360-180 d FROM range(500)")
    d = chord(unit_vector(F.col("a"), F.col("b")), unit_vector(F.col("c"), F.col("d")))
    for a, b, c, e, found in df.select("a", "b", "c", "d", d).collect():
        p, q = math.radians(a), math.radians(c)
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(e - b) / 2) ** 2
        assert found == pytest.approx(2 * math.sqrt(h), abs=1e-12)
