"""Nearest places against a full comparison, on awkward point sets."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tilelake.operators import geocode
from tilelake.operators.geocode import build_place_index, with_cities

NAN = float("nan")


def sphere(n, seed):
    draw = np.random.default_rng(seed)
    return np.degrees(np.arcsin(draw.uniform(-1, 1, n))), draw.uniform(-180, 180, n)


def gazetteer(spark, lat, lon, names=None):
    names = names if names is not None else [f"p{i:05d}" for i in range(len(lat))]
    rows = pd.DataFrame({"name": names, "admin1": "a", "cc": "XX", "glat": lat, "glon": lon})
    return spark.createDataFrame(rows, "name string, admin1 string, cc string, glat double, glon double")


def locations(spark, lat, lon):
    return spark.createDataFrame(
        pd.DataFrame({"id": np.arange(len(lat)), "latitude": lat, "longitude": lon}),
        "id long, latitude double, longitude double",
    )


def vectors(lat, lon):
    p, q = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)], axis=1)


def brute_force(lat, lon, glat, glon, names):
    """Nearest label of each location; equal distances go to the first label."""
    order = np.argsort(names, kind="stable")
    places, labels = vectors(np.asarray(glat)[order], np.asarray(glon)[order]), np.asarray(names)[order]
    found = []
    for v in vectors(lat, lon):
        d = np.floor(np.sqrt(((places - v) ** 2).sum(axis=1)) * 1e12)
        found.append(f"{labels[np.argmin(d)]}, a, XX")
    return found


def cities(df, index, **how):
    rows = with_cities(df, index, **how).select("id", "city", "city_lookup_success").collect()
    assert len(rows) == df.count()
    assert all(r.city_lookup_success == (r.city != "Unknown") for r in rows)
    return [r.city for r in sorted(rows)]


def edges():
    """Poles, the seam, cell corners and the equator."""
    lat, lon = [], []
    for a in (-90, -89.999, -85.05, -45, -22.5, 0, 1e-9, 45, 67.5, 89.999, 90):
        for b in (-180, -179.999, -90, -22.5, 0, 1e-9, 22.5, 90, 179.999, 180):
            lat.append(float(a))
            lon.append(float(b))
    return np.array(lat), np.array(lon)


def spread(seed):
    return sphere(700, seed)


def dense_cluster(seed):
    """A third of the places within 2 km, far from the others."""
    lat, lon = sphere(400, seed)
    draw = np.random.default_rng(seed)
    return (
        np.concatenate([lat, 51.5 + draw.uniform(-0.01, 0.01, 200)]),
        np.concatenate([lon, -0.1 + draw.uniform(-0.01, 0.01, 200)]),
    )


def around_edges(seed):
    lat, lon = edges()
    return lat[::2], lon[::2]


def ring(seed):
    """Places all equally far from one point."""
    return np.full(120, 89.0), np.linspace(-180, 177, 120)


@pytest.mark.parametrize(
    "places, leaf_places, max_level",
    [(spread, 4, 16), (spread, 32, 16), (dense_cluster, 4, 16), (around_edges, 16, 8), (ring, 40, 6)],
)
def test_nearest_equals_full_comparison(spark, places, leaf_places, max_level):
    glat, glon = places(5)
    names = np.array([f"p{i:05d}" for i in range(len(glat))])
    lat, lon = (np.concatenate(c) for c in zip(sphere(400, 8), edges(), (glat[:50], glon[:50]), dense_cluster(9)))
    index = build_place_index(gazetteer(spark, glat, glon), leaf_places, max_level)
    df = locations(spark, lat, lon)
    expected = brute_force(lat, lon, glat, glon, names)
    assert cities(df, index) == expected
    if leaf_places == 4:
        assert cities(df, index, max_broadcast_bytes=0, shares=3) == expected


def test_leaves_tile_the_globe_and_stay_few(spark):
    glat, glon = dense_cluster(3)
    index = build_place_index(gazetteer(spark, glat, glon), leaf_places=4, max_level=12)
    leaves = index.places.select("level", "cell_x", "cell_y").distinct().collect()
    assert len(index.levels) > 1 and {r.level for r in leaves} == set(index.levels)
    assert sum(4.0**-r.level for r in leaves) == 1.0
    # cells far from the cluster are not cut because of it
    assert index.rows < 100 * len(glat)
    lat, lon = sphere(300, 4)
    probes = locations(spark, lat, lon).select("id", F.inline(geocode._leaf_keys(index.levels)))
    matches = probes.join(index.places.select("level", "cell_x", "cell_y").distinct(), ["level", "cell_x", "cell_y"])
    assert matches.groupBy("id").count().filter("count = 1").count() == 300


def test_stopping_at_a_coarse_level_stays_exact(spark):
    glat, glon = dense_cluster(3)
    lat, lon = sphere(200, 6)
    index = build_place_index(gazetteer(spark, glat, glon), leaf_places=4, max_level=3)
    assert index.levels == (3,)
    expected = brute_force(lat, lon, glat, glon, [f"p{i:05d}" for i in range(len(glat))])
    assert cities(locations(spark, lat, lon), index) == expected


def test_places_at_one_spot_go_to_the_first_label(spark):
    lat = [10.0] * 100 + [-10.0]
    lon = [20.0] * 100 + [-20.0]
    names = [f"n{(i * 37) % 100:03d}" for i in range(100)] + ["far"]
    index = build_place_index(gazetteer(spark, lat, lon, names))
    assert index.rows == 2
    assert cities(locations(spark, [10.1, 0.0, -9.0], [20.1, 20.0, -20.0]), index) == [
        "n000, a, XX",
        "n000, a, XX",
        "far, a, XX",
    ]


def test_equal_distances_go_to_the_first_label(spark):
    index = build_place_index(gazetteer(spark, [0.0, 0.0], [-10.0, 10.0], ["b", "a"]))
    assert cities(locations(spark, [0.0, 40.0], [0.0, 0.0]), index) == ["a, a, XX"] * 2
    assert cities(locations(spark, [0.0], [0.0]), index, max_broadcast_bytes=0) == ["a, a, XX"]


@pytest.mark.parametrize("how", [{}, {"max_broadcast_bytes": 0, "shares": 4}])
def test_rows_without_a_location_are_kept_as_unknown(spark, how):
    index = build_place_index(gazetteer(spark, *sphere(100, 1)))
    bad = [(None, 1.0), (1.0, None), (NAN, 1.0), (1.0, NAN), (91.0, 0.0), (0.0, 181.0), (None, None)]
    rows = [(i, a, b) for i, (a, b) in enumerate(bad * 20 + [(1.0, 1.0)])]
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double")
    found = cities(df, index, **how)
    assert found[:-1] == ["Unknown"] * (len(bad) * 20) and found[-1] != "Unknown"


def test_gazetteer_rows_without_coordinates_are_left_out(spark):
    lat, lon = [NAN, None, 95.0, 10.0], [1.0, 1.0, 1.0, 10.0]
    index = build_place_index(gazetteer(spark, lat, lon, ["w", "x", "y", "z"]))
    assert cities(locations(spark, [1.0], [1.0]), index) == ["z, a, XX"]


def test_no_gazetteer_or_no_places(spark):
    df = locations(spark, [1.0, 2.0], [3.0, 4.0])
    empty = build_place_index(gazetteer(spark, [1.0], [1.0]).limit(0))
    for index in (None, empty):
        assert cities(df, index) == ["Unknown", "Unknown"]


def test_place_without_a_name_is_no_success(spark):
    df = spark.createDataFrame(
        [(None, None, None, 1.0, 1.0), ("n", None, "CC", 50.0, 50.0)],
        "name string, admin1 string, cc string, glat double, glon double",
    )
    rows = with_cities(locations(spark, [0.0, 51.0], [0.0, 51.0]), build_place_index(df)).orderBy("id").collect()
    assert [(r.city, r.city_lookup_success) for r in rows] == [("Unknown, , ", False), ("n, , CC", True)]


@pytest.mark.parametrize("how", [{}, {"max_broadcast_bytes": 0, "shares": 5}])
def test_columns_of_any_name_pass_through(spark, how):
    index = build_place_index(gazetteer(spark, [1.0, 50.0], [1.0, 50.0], ["a", "b"]))
    df = locations(spark, [2.0], [2.0]).selectExpr("*", "7 AS level", "8 AS cell_x", "9 AS label", "1 AS qx", "2 AS px")
    row = with_cities(df, index, **how).first()
    assert (row.level, row.cell_x, row.label, row.qx, row.px, row.city) == (7, 8, 9, 1, 2, "a, a, XX")


@pytest.mark.parametrize("how", [{}, {"max_broadcast_bytes": 0, "shares": 5}])
def test_one_location_with_most_of_the_rows(spark, how):
    glat, glon = sphere(200, 2)
    lat, lon = sphere(300, 3)
    lat, lon = np.concatenate([np.full(600, 12.5), lat]), np.concatenate([np.full(600, 33.25), lon])
    index = build_place_index(gazetteer(spark, glat, glon))
    expected = brute_force(lat, lon, glat, glon, [f"p{i:05d}" for i in range(200)])
    assert cities(locations(spark, lat, lon), index, **how) == expected


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_lookup_does_not_shuffle_the_rows(spark):
    index = build_place_index(gazetteer(spark, *sphere(200, 2)))
    text = plan(with_cities(locations(spark, *sphere(10, 1)), index))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Python" not in text
    # the one exchange builds the leaves of the index
    assert text.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(level" in text


def test_shuffled_lookup_has_no_broadcast_of_places_and_no_nested_loop(spark):
    index = build_place_index(gazetteer(spark, *sphere(200, 2)))
    text = plan(with_cities(locations(spark, *sphere(10, 1)), index, max_broadcast_bytes=0))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_stored_index(spark, tmp_path):
    from tilelake.__main__ import stored_index

    lat, lon = sphere(60, 5)
    places, path = gazetteer(spark, lat, lon), str(tmp_path / "index")
    built, read = stored_index(spark, path, places), stored_index(spark, path, None)
    assert (built.levels, built.rows, built.size_bytes) == (read.levels, read.rows, read.size_bytes)
    rows = locations(spark, *sphere(40, 6))
    assert with_cities(rows, built).collect() == with_cities(rows, read).collect()


def test_dense_cluster_stays_small(spark):
    lat, lon = sphere(60, 8)
    draw = np.random.default_rng(9)
    near = 48 + draw.uniform(0, 0.0009, 400), 11 + draw.uniform(0, 0.0009, 400)
    index = build_place_index(gazetteer(spark, np.r_[lat, near[0]], np.r_[lon, near[1]]))
    leaves = index.places.groupBy("level", "cell_x", "cell_y").count().agg(F.max("count")).first()[0]
    assert leaves <= 4 * geocode.LEAF_PLACES


def test_places_closer_than_the_finest_query_cells_stay_few_around(spark):
    lat, lon = sphere(40, 12)
    draw = np.random.default_rng(13)
    near = 40 + draw.uniform(0, 0.0004, 150), -90 + draw.uniform(0, 0.0004, 150)
    # each with another one some 20 cm away
    glat, glon = np.r_[lat, near[0], near[0] + 2e-6], np.r_[lon, near[1], near[1] + 1e-6]
    names = [f"p{i:03d}" for i in range(len(glat))]
    index = build_place_index(gazetteer(spark, glat, glon, names))
    assert index.rows < 40 * len(glat)
    away = np.r_[draw.uniform(-0.0004, 0.0008, 300), draw.uniform(-0.05, 0.05, 300)], np.r_[draw.uniform(-0.0004, 0.0008, 300), draw.uniform(-0.05, 0.05, 300)]
    qlat, qlon = 40 + away[0], -90 + away[1]
    assert cities(locations(spark, qlat, qlon), index) == brute_force(qlat, qlon, glat, glon, names)


def test_shuffled_lookup_meets_a_leaf_once_and_copies_a_location_for_its_own_levels(spark):
    lat, lon = sphere(60, 14)
    index = build_place_index(gazetteer(spark, np.r_[lat, 20 + lat / 1000], np.r_[lon, 20 + lon / 1000]))
    assert len(index.levels) > geocode._FEW_LEVELS
    rows = locations(spark, *sphere(100, 15))
    text = plan(with_cities(rows, index, max_broadcast_bytes=0))
    assert "__levels" in text and "SortAggregate" not in text
    assert cities(rows, index, max_broadcast_bytes=0) == cities(rows, index)


@pytest.mark.parametrize("slots", [16, 2])
@pytest.mark.parametrize("how", [{}, {"max_broadcast_bytes": 0}])
def test_leaves_of_few_and_of_many_places_agree_with_a_full_comparison(spark, monkeypatch, slots, how):
    monkeypatch.setattr(geocode, "_SLOTS", slots)
    glat, glon = sphere(150, 21)
    # some spots mirror each other in the equator, so that distances from it are equal; labels are not in order of place
    glat, glon = np.r_[glat, -glat[:40]], np.r_[glon, glon[:40]]
    names = [f"p{i * 77 % 191:03d}" for i in range(len(glat))]
    index = build_place_index(gazetteer(spark, glat, glon, names))
    crowd = index.places.groupBy("level", "cell_x", "cell_y").count().agg(F.max("count")).first()[0]
    assert (crowd > slots) == (slots == 2)
    lat, lon = sphere(200, 22)
    qlat, qlon = np.r_[lat, np.zeros(40)], np.r_[lon, glon[:40]]
    assert cities(locations(spark, qlat, qlon), index, **how) == brute_force(qlat, qlon, glat, glon, names)


def test_a_leaf_is_met_by_one_number_and_its_places_compared_in_generated_code(spark):
    index = build_place_index(gazetteer(spark, *sphere(200, 2)))
    text = plan(with_cities(locations(spark, *sphere(10, 1)), index))
    assert "BroadcastHashJoin [__leaf" in text and "least(" in text
    lat, lon = sphere(60, 14)
    dense = build_place_index(gazetteer(spark, np.r_[lat, 20 + lat / 1000], np.r_[lon, 20 + lon / 1000]))
    # no list of a row's cells on all levels is built and filtered
    assert "filter(array(" not in plan(with_cities(locations(spark, *sphere(10, 1)), dense))


def test_names_of_leaves_differ_between_and_within_levels(spark):
    cells = [(level, x, y) for level in (0, 1, 2, 23, 24, 30) for x in {0, 1, (1 << level) - 1} for y in {0, 1, (1 << level) - 1} if max(x, y) < 1 << level]
    named = spark.createDataFrame(cells, "level int, cell_x int, cell_y int").select(geocode._leaf_name())
    assert named.distinct().count() == len(cells)
