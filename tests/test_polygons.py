from __future__ import annotations

import random

import pytest

from tilelake.operators.polygons import tiles_in_polygons

RINGS = [
    ("square", [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]),
    ("square", [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0), (4.0, 4.0)]),  # a hole, closed
    ("beside", [(10.0, 0.0), (20.0, 0.0), (20.0, 10.0), (10.0, 10.0)]),
    ("seam", [(170.0, -5.0), (-175.0, -8.0), (-170.0, 5.0), (175.0, 9.0)]),
    ("seam", [(-179.0, 0.0), (-178.0, 0.0), (-178.5, 1.0)]),
    ("parts", [(30.0, 30.0), (31.0, 30.0), (30.5, 31.0)]),
    ("parts", [(-60.0, -30.0), (-61.0, -30.0), (-60.5, -31.0)]),
    ("south", [(float(x), -60.0 - 3 * (x % 90 == 0)) for x in range(-180, 180, 30)]),
    ("tiny", [(5.0, 5.0), (5.001, 5.0), (5.001, 5.001)]),
    ("line", [(0.0, 0.0), (10.0, 10.0)]),
    ("nothing", []),
    ("missing", None),
    ("gaps", [(0.0, 0.0), None, (10.0, 0.0), (None, 3.0), (500.0, 0.0), (10.0, 10.0)]),
]


def star(rng: random.Random, corners: int) -> list[tuple[float, float]]:
    lon, lat, size = rng.uniform(-180, 180), rng.uniform(-60, 60), rng.uniform(0.5, 20)
    at = [(lon + size * rng.uniform(-1, 1), lat + size * rng.uniform(-1, 1)) for _ in range(corners)]  # crossing itself too
    return [(x - 360 if x >= 180 else x + 360 if x < -180 else x, y) for x, y in at]


def inside(rings, lat, lon):
    """Every edge in turn, by the way due north."""
    odd, lon = False, -180.0 if lon == 180.0 else lon
    for ring in rings:
        ring = [p for p in ring or [] if p and None not in p and abs(p[0]) <= 180 and abs(p[1]) <= 90]
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            x2 += -360 if x2 - x1 > 180 else 360 if x2 - x1 < -180 else 0
            for x in (lon - 360, lon, lon + 360):
                odd ^= (x1 > x) != (x2 > x) and lat < y1 + (x - x1) * (y2 - y1) / (x2 - x1)
    return odd


@pytest.mark.parametrize("limit", [0, 10**9])
def test_tiles_in_polygons(spark, limit):
    rng = random.Random(4)
    rings = RINGS + [(f"star {i}", star(rng, c)) for i, c in enumerate([3, 5, 9, 40, 200, 1500])]
    points = [(5.0, 5.0)] * 50 + [(0.0, 0.0), (3.0, 10.0), (3.0, 0.0), (0.5, 180.0), (0.5, -180.0), (-90.0, 0.0), (90.0, 0.0), (-90.0, 180.0)]
    points += [(0.2, -178.4), (5.0005, 5.0008), (30.2, 30.5), (-30.2, -60.5), (None, 0.0), (0.0, None), (float("nan"), 0.0)]
    points += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(3000)]
    for _, ring in rings[-6:]:
        points += [(min(90, y + rng.uniform(-1, 1)), min(180, x + rng.uniform(-1, 1))) for x, y in ring[:60]]
    tiles = spark.createDataFrame([(a, b, 2) for a, b in points], "latitude double, longitude double, tests long")
    shapes = spark.createDataFrame(rings, "name string, ring array<struct<lon:double,lat:double>>")
    valid = [(a, b) for a, b in points if a is not None and b is not None and abs(a) <= 90 and abs(b) <= 180]
    expected = {}
    for name in {n for n, _ in rings}:
        found = sum(inside([r for n, r in rings if n == name], a, b) for a, b in valid)
        if found:
            expected[name] = (found, 2 * found)
    found = tiles_in_polygons(tiles, shapes, max_broadcast_bytes=limit, shares=4).collect()
    assert {r.name: (r.tile_count, r.total_tests) for r in found} == expected
    assert {"square", "beside", "seam", "parts", "south", "tiny", "star 5"} <= expected.keys()
    assert tiles_in_polygons(tiles, shapes.limit(0)).count() == 0
    assert tiles_in_polygons(tiles.limit(0), shapes).count() == 0


@pytest.mark.parametrize("limit", [0, 10**9])
def test_boundaries_meet_only_locations_along_their_border(spark, limit, monkeypatch):
    """Every boundary holds many tiles, but is tested against few of them."""
    from tilelake.operators import area_sums

    met = []
    monkeypatch.setattr(area_sums, "_met", lambda areas, cells, *how, _met=area_sums._met: met.append(_met(areas, cells, *how)) or met[-1])
    side = 90
    spots = [((i // side) * 1.0 - 44.5, (i % side) * 2.0 - 89.5) for i in range(side * side)]
    tiles = spark.createDataFrame([(a, b, 3) for a, b in spots], "latitude double, longitude double, tests long")
    rings = [(f"area {k}", [(-80.3 - k / 7, -33.1), (3.7, -42.9 + k / 9), (77.9, -31.3), (81.1 + k / 7, 35.7), (-69.3, 41.9)]) for k in range(20)]
    shapes = spark.createDataFrame(rings, "name string, ring array<struct<lon:double,lat:double>>")
    found = {r.name: (r.tile_count, r.total_tests) for r in tiles_in_polygons(tiles, shapes, max_broadcast_bytes=limit, shares=4).collect()}
    expected = {n: sum(inside([ring], a, b) for a, b in spots) for n, ring in rings}
    assert found == {n: (c, 3 * c) for n, c in expected.items()}
    assert sum(m.count() for m in met) < sum(expected.values())


def shapes_and_spots(spark, rng):
    """Boundaries over all regions, small ones that crowd in one of them, tiles everywhere, close together and at one spot."""
    rings = RINGS + [(f"star {i}", star(rng, c)) for i, c in enumerate([3, 6, 30, 300])]
    rings += [(f"small {i}", [(20 + i / 1e3, 20.0), (20.01 + i / 1e3, 20.0), (20.005, 20.02 + i / 1e4)]) for i in range(60)]
    spots = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(1200)] + [(20 + rng.random() / 50, 20 + rng.random() / 15) for _ in range(500)]
    spots += [(20.001 + k / 1e9, 20.005) for k in range(80)] + [(20.002, 20.006)] * 90 + [(-90.0, 180.0), (90.0, -180.0), (0.5, 180.0)]
    shapes = spark.createDataFrame(rings, "name string, ring array<struct<lon:double,lat:double>>")
    return rings, shapes, spots


@pytest.mark.parametrize("limit", [0, 10**9])
def test_boundaries_over_many_regions(spark, limit, monkeypatch):
    """Regions of few locations, some of them with several parts, blocks of few edges and points in a task."""
    from tilelake.operators import polygons, ring_search

    for module, name, value in ((polygons, "_FEW_LOCATIONS", 40), (polygons, "_MOST_LOCATIONS", 40), (polygons, "_PART_BYTES", 600), (ring_search, "_AT_ONCE", 70), (ring_search, "_FEW_POINTS", 3)):
        monkeypatch.setattr(module, name, value)
    seen = []
    monkeypatch.setattr(polygons, "_parts", lambda *a, _parts=polygons._parts: seen.append(_parts(*a)) or seen[-1])
    rings, shapes, spots = shapes_and_spots(spark, random.Random(5))
    tiles = spark.createDataFrame([(a, b, 2) for a, b in spots], "latitude double, longitude double, tests int")
    found = {r.name: (r.tile_count, r.total_tests) for r in tiles_in_polygons(tiles, shapes, max_broadcast_bytes=limit, shares=4).collect()}
    expected = {n: sum(inside([r for m, r in rings if m == n], a, b) for a, b in spots) for n in {n for n, _ in rings}}
    assert found == {n: (c, 2 * c) for n, c in expected.items() if c}
    copies = seen[0][0]
    assert len(copies) > 50 and copies.max() > 3


@pytest.mark.parametrize("limit", [0, 10**9])
def test_tests_and_names_that_are_not_known(spark, limit):
    """Sums skip null tests and are null where all are; a boundary without a name is left out."""
    square = lambda x: [(x, 0.0), (x + 9.0, 0.0), (x + 9.0, 9.0), (x, 9.0)]
    shapes = spark.createDataFrame([("a", square(0.0)), ("b", square(20.0)), (None, square(0.0))], "name string, ring array<struct<lon:double,lat:double>>")
    rows = [(float(i % 8) + 0.5, x + i / 40, None if x or i % 2 else 1.5) for i in range(300) for x in (0.0, 20.0)]
    tiles = spark.createDataFrame(rows, "latitude double, longitude double, tests double")
    found = {r.name: (r.tile_count, r.total_tests) for r in tiles_in_polygons(tiles, shapes, max_broadcast_bytes=limit, shares=4).collect()}
    assert found == {"a": (300, 225.0), "b": (300, None)}


@pytest.mark.parametrize("limit", [0, 10**9])
def test_written_rows_do_not_grow_with_the_length_of_borders(spark, limit, monkeypatch):
    """What is stored on the way: every location once, and a boundary once in each region that it touches."""
    side, written = 90, []
    spots = [((i // side) * 1.0 - 44.5, (i % side) * 2.0 - 89.5) for i in range(side * side)]
    tiles = spark.createDataFrame([(a, b, 3) for a, b in spots], "latitude double, longitude double, tests long")
    rings = [(f"area {k}", [(-80.3 - k / 70, -33.1), (3.7, -42.9 + k / 90), (77.9, -31.3), (81.1 + k / 70, 35.7), (-69.3, 41.9)]) for k in range(200)]
    shapes = spark.createDataFrame(rings, "name string, ring array<struct<lon:double,lat:double>>")

    def checkpoint(df, *a, _checkpoint=type(tiles).checkpoint, **how):
        kept = _checkpoint(df, *a, **how)
        written.append(kept.count())
        return kept

    monkeypatch.setattr(type(tiles), "checkpoint", checkpoint)
    found = {r.name: r.tile_count for r in tiles_in_polygons(tiles, shapes, max_broadcast_bytes=limit, shares=4).collect()}
    for name, ring in rings[::50]:
        assert found[name] == sum(inside([ring], a, b) for a, b in spots)
    assert sum(written) <= len(spots) + 4 * len(rings)


def test_few_locations_are_tested_one_by_one():
    """With 16 times as many locations, some 4 times as many are close enough to a border to be tested."""
    import numpy as np
    import pyarrow as pa

    from tilelake.operators import ring_search

    rng, zero = np.random.default_rng(1), np.zeros(1, np.int64)
    ring = [(-80.3, -33.1), (3.7, -42.9), (77.9, -31.3), (81.1, 35.7), (-69.3, 41.9)]
    edges = ring_search.Edges(*np.array([(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1])]).T)
    tested = []
    for n in (10_000, 160_000):
        at = {"latitude": rng.uniform(-90, 90, n), "longitude": rng.uniform(-180, 180, n)}
        points = ring_search.Points(pa.table({**at, "tile_count": np.ones(n, np.int64), "total_tests": np.full(n, 5)}))
        search = ring_search.Sums(points, edges, 1).search(ring_search.Cells(zero, 0, zero, zero, zero, np.zeros(5, np.int64), np.arange(5)))
        expected = sum(inside([ring], a, b) for a, b in zip(at["latitude"].tolist(), at["longitude"].tolist()))
        assert [int(s[0]) for s in search.sums] == [expected, 5 * expected, expected]
        tested.append(search.tested)
    assert 0 < tested[1] < 6 * tested[0]
