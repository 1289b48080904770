"""Points inside boundaries, in tasks: down the cells of one region, edges alongside.

Points lie in the order of their cells (bits of column and row interleaved), so the points of a cell of any level are one
stretch, and its sums are a difference of running sums. Boundaries go down from the region's cell: a cell keeps the edges in
it or north of it, cells inside give their sums, cells along the border are cut until they hold few points, and only
these are tested one by one. Nothing of that leaves the task but the sums.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# executors need numpy and pyarrow but not this library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells of 2 m.
DEEPEST = 24
# Widens every cell in degrees, so that rounding cannot hide an edge from a cell that it touches.
SLACK = 1e-9
# Points that a cell on a border is not cut for.
_FEW_POINTS = 32
# Edges of cells, or points, that are worked on at a time.
_AT_ONCE = 150_000
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def cell_code(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Column and row with their bits interleaved; the column has the lowest."""
    for shift, mask in _SPREAD:
        x, y = (x | x << shift) & mask, (y | y << shift) & mask
    return x | y << 1


def point_code(latitude: np.ndarray, longitude: np.ndarray) -> np.ndarray:
    n = 1 << DEEPEST
    cell = lambda at, extent: np.clip(np.floor((at + extent / 2) / extent * n), 0, n - 1).astype(np.int64)
    return cell_code(cell(longitude, 360.0), cell(latitude, 180.0))


def _stretches(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each stretch, one stretch after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Edges:
    """Edges and the box around each."""

    def __init__(self, x1, y1, x2, y2):
        self.x1, self.y1, self.x2, self.y2 = x1, y1, x2, y2
        self.west, self.east = np.minimum(x1, x2), np.maximum(x1, x2)
        self.south, self.north = np.minimum(y1, y2), np.maximum(y1, y2)
        self.upright = self.east - self.west < SLACK
        self.slope = (y2 - y1) / np.where(self.upright, 1.0, x2 - x1)

    def between(self, edge: np.ndarray, west: np.ndarray, east: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest latitude of each edge from ``west`` to ``east``, where it reaches that far."""
        x1, y1, slope = self.x1[edge], self.y1[edge], self.slope[edge]
        at = lambda x: y1 + (np.clip(x, self.west[edge], self.east[edge]) - x1) * slope
        a, b, upright = at(west), at(east), self.upright[edge]
        return np.where(upright, self.south[edge], np.minimum(a, b)), np.where(upright, self.north[edge], np.maximum(a, b))

    def crossed(self, edge: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For which i the way due north from (x, y)[i] crosses edge[i]; of an edge's two ends the eastern one belongs to the next edge."""
        x1, x2 = self.x1[edge], self.x2[edge]
        met = np.flatnonzero((x1 > x) != (x2 > x))
        edge, x, y, x1, x2 = edge[met], x[met], y[met], x1[met], x2[met]
        y1, y2 = self.y1[edge], self.y2[edge]
        return met[y < y1 + (x - x1) * (y2 - y1) / (x2 - x1)]


@dataclass
class Cells:
    """Cells of areas with the edges that each has, by cell: ``edge[i]`` is of cell ``own[i]``. ``flips`` edges more lie north of a
    cell and span its whole width."""

    area: np.ndarray
    level: int | np.ndarray
    x: np.ndarray
    y: np.ndarray
    flips: np.ndarray
    own: np.ndarray
    edge: np.ndarray

    def edges_each(self) -> np.ndarray:
        return np.bincount(self.own, minlength=len(self.area))

    def only(self, which: np.ndarray) -> Cells:
        """The cells of a mask."""
        kept, place = which[self.own], np.cumsum(which) - 1
        level = self.level[which] if isinstance(self.level, np.ndarray) else self.level
        return Cells(self.area[which], level, self.x[which], self.y[which], self.flips[which], place[self.own[kept]], self.edge[kept])

    def placed(self, edges: Edges) -> tuple[Cells, np.ndarray, np.ndarray]:
        """The cells with the edges that are in them or north of them, which ones are on the border, and which are all inside.

        A cell that no edge touches is all inside or all outside, as its centre is.
        """
        n, own, edge, many = np.ldexp(1.0, self.level), self.own, self.edge, len(self.area)
        lon, lat = lambda x: x / n * 360.0 - 180.0, lambda y: y / n * 180.0 - 90.0
        west, east = (lon(self.x) - SLACK)[own], (lon(self.x + 1) + SLACK)[own]
        south, north = (lat(self.y) - SLACK)[own], (lat(self.y + 1) + SLACK)[own]
        e_west, e_east = edges.west[edge], edges.east[edge]
        lowest, highest = edges.between(edge, west, east)
        beyond = lowest > north
        spans = beyond & (e_west < west) & (e_east > east)
        kept = (e_east >= west) & (e_west <= east) & (highest >= south) & ~spans
        flips = self.flips + np.bincount(own[spans], minlength=many)
        border = np.zeros(many, bool)
        border[own[kept & ~beyond]] = True
        own, edge = own[kept], edge[kept]
        away = ~border[own]
        at, center_x, center_y = own[away], lon(self.x + 0.5), lat(self.y + 0.5)
        north_of = flips + np.bincount(at[edges.crossed(edge[away], center_x[at], center_y[at])], minlength=many)
        return Cells(self.area, self.level, self.x, self.y, flips, own, edge), border, ~border & (north_of % 2 == 1)


class Points:
    """The points of a region in the order of their cells, with running sums of tiles, tests and points whose tests are known."""

    def __init__(self, table: pa.Table):
        latitude, longitude = (table.column(c).to_numpy() for c in ("latitude", "longitude"))
        code = point_code(latitude, longitude)
        order = np.argsort(code, kind="stable")
        self.code, self.latitude, self.longitude = code[order], latitude[order], longitude[order]
        tests = table.column("total_tests")
        counted = (table.column("tile_count").to_numpy(), tests.fill_null(0).to_numpy(), tests.is_valid().to_numpy().astype(np.int64))
        self.values = [c[order] for c in counted]
        self.upto = [np.concatenate([np.zeros(1, c.dtype), np.cumsum(c)]) for c in self.values]

    def __len__(self) -> int:
        return len(self.code)


class Sums:
    """Sums of ``points`` in each area: ``search`` goes down from ``cells``, which all hold all points."""

    def __init__(self, points: Points, edges: Edges, areas: int):
        self.points, self.edges, self.tested = points, edges, 0
        self.sums = [np.zeros(areas, c.dtype) for c in points.values]

    def _add(self, area: np.ndarray, start: np.ndarray, stop: np.ndarray) -> None:
        for total, upto in zip(self.sums, self.points.upto):
            np.add.at(total, area, upto[stop] - upto[start])

    def _test(self, cells: Cells, start: np.ndarray, stop: np.ndarray) -> None:
        """Every point of each cell by the edges of the cell. Cells of many edges come first, so that the next edge is always one of the
        first few cells'."""
        edges_each = cells.edges_each()
        first = np.cumsum(edges_each) - edges_each
        order = np.argsort(-edges_each, kind="stable")
        ends = np.cumsum((stop - start)[order])
        cuts = np.unique(np.searchsorted(ends, np.arange(_AT_ONCE, ends[-1] if len(ends) else 0, _AT_ONCE)))
        for some in np.split(order, cuts):
            size = (stop - start)[some]
            point, cell = _stretches(start[some], size), np.repeat(some, size)
            x, y, at, more = self.points.longitude[point], self.points.latitude[point], first[cell], -edges_each[cell]
            odd = cells.flips[cell] % 2 == 1
            for k in range(int(-more[0]) if len(more) else 0):
                m = np.searchsorted(more, -k)
                met = self.edges.crossed(cells.edge[at[:m] + k], x[:m], y[:m])
                odd[met] = ~odd[met]
            self.tested += len(point)
            self._add(cells.area[cell[odd]], point[odd], point[odd] + 1)

    def search(self, cells: Cells) -> Sums:
        """``cells`` are the region's own, placed; those without an edge are all inside."""
        edged, everything = cells.edges_each() > 0, np.full(len(cells.area), len(self.points))
        inner = ~edged & (cells.flips % 2 == 1)
        self._add(cells.area[inner], 0 * everything[inner], everything[inner])
        # the last first, and large ones in parts: a few levels of a few cells are kept, whatever the number of areas
        stack = [(cells.only(edged), 0 * everything[edged], everything[edged])]
        while stack:
            cells, start, stop = stack.pop()
            if len(cells.edge) > _AT_ONCE and len(cells.area) > 1:
                low = np.arange(len(cells.area)) < len(cells.area) // 2
                stack += [(cells.only(part), start[part], stop[part]) for part in (low, ~low)]
                continue
            few = (stop - start <= _FEW_POINTS) | (cells.level >= DEEPEST)
            self._test(cells.only(few), start[few], stop[few])
            if few.all():
                continue
            cells, start, stop = self._cut(cells.only(~few), start[~few], stop[~few])
            cells, border, inner = cells.placed(self.edges)
            self._add(cells.area[inner], start[inner], stop[inner])
            stack.append((cells.only(border), start[border], stop[border]))
        return self

    def _cut(self, cells: Cells, start: np.ndarray, stop: np.ndarray):
        """The quarters that hold points, each with all edges of its cell."""
        width = 1 << 2 * (DEEPEST - cells.level - 1)
        inside = 4 * width * cell_code(cells.x, cells.y)[:, None] + width * np.arange(1, 4)
        ends = np.column_stack([start, np.searchsorted(self.points.code, inside), stop])
        cell, quarter = np.nonzero(ends[:, 1:] > ends[:, :-1])
        edges_each = cells.edges_each()
        first, size = (np.cumsum(edges_each) - edges_each)[cell], edges_each[cell]
        x, y = 2 * cells.x[cell] + quarter % 2, 2 * cells.y[cell] + quarter // 2
        own, edge = np.repeat(np.arange(len(cell)), size), cells.edge[_stretches(first, size)]
        return Cells(cells.area[cell], cells.level + 1, x, y, cells.flips[cell], own, edge), ends[cell, quarter], ends[cell, quarter + 1]


@dataclass
class Regions:
    """Cells that cover the globe, in the order of their codes."""

    level: np.ndarray
    x: np.ndarray
    y: np.ndarray

    @staticmethod
    def of(cells: list[tuple[int, int, int]]) -> Regions:
        level, x, y = np.array(cells, np.int64).reshape(-1, 3).T
        order = np.argsort(Regions(level, x, y).starts())
        return Regions(level[order], x[order], y[order])

    def starts(self) -> np.ndarray:
        """The code at which each region begins."""
        return cell_code(self.x, self.y) << 2 * (DEEPEST - self.level)

    def bounds(self) -> tuple[np.ndarray, ...]:
        n = np.ldexp(1.0, self.level)
        west, south = self.x / n * 360.0 - 180.0, self.y / n * 180.0 - 90.0
        return west - SLACK, west + 360.0 / n + SLACK, south - SLACK, south + 180.0 / n + SLACK


def _struct_arrays(column: pa.Array, *names: str) -> list[np.ndarray]:
    return [column.field(n).to_numpy(zero_copy_only=False) for n in names]


def route(regions: Regions):
    """Areas (name, edges) to the regions that they touch: region, the parity of the edges that are only counted, and the region's own
    edges as x1, y1, x2, y2 one after the other; none where all of the region is inside."""

    def touched(batch: pa.RecordBatch):
        lists = batch.column("edges")
        many = np.diff(lists.offsets.to_numpy())
        x1, y1, x2, y2 = _struct_arrays(lists.flatten(), "x1", "y1", "x2", "y2")
        plain, begin = Edges(x1, y1, x2, y2), np.cumsum(many) - many
        own = np.repeat(np.arange(len(many)), many)
        # a boundary that has gone round the globe reaches the south pole
        round_globe = np.abs(np.bincount(own, x2 - x1, len(many))) > 180.0
        south = np.where(round_globe, -90.0, np.minimum.reduceat(plain.south, begin)) - SLACK
        north = np.maximum.reduceat(plain.north, begin) + SLACK
        west, east = np.minimum.reduceat(plain.west, begin), np.maximum.reduceat(plain.east, begin)
        # what is beyond the 180th meridian, once more on its other side
        turns = [(slice(None), 0.0), (np.flatnonzero(plain.east + SLACK >= 180.0), -360.0), (np.flatnonzero(plain.west - SLACK < -180.0), 360.0)]
        own = np.concatenate([own[i] for i, _ in turns])
        order = np.argsort(own, kind="stable")
        x1, x2 = (np.concatenate([x[i] + t for i, t in turns])[order] for x in (x1, x2))
        y1, y2 = (np.concatenate([y[i] for i, _ in turns])[order] for y in (y1, y2))
        edges, many = Edges(x1, y1, x2, y2), np.bincount(own, minlength=len(many))
        begin = np.cumsum(many) - many
        r_west, r_east, r_south, r_north = regions.bounds()
        rows = max(1, 4 * _AT_ONCE // len(r_west))
        for some in np.array_split(np.arange(len(many)), -(-len(many) // rows)):
            column = lambda v: v[some][:, None]
            near = (column(south) <= r_north) & (column(north) >= r_south)
            near &= np.logical_or.reduce([(column(west) + t <= r_east) & (column(east) + t >= r_west) for t in (0.0, -360.0, 360.0)])
            area, region = np.nonzero(near)
            area = some[area]
            ends = np.cumsum(many[area])
            cuts = np.unique(np.searchsorted(ends, np.arange(_AT_ONCE, ends[-1] if len(ends) else 0, _AT_ONCE)))
            for part in np.split(np.arange(len(area)), cuts):
                a, r = area[part], region[part]
                own, edge = np.repeat(np.arange(len(a)), many[a]), _stretches(begin[a], many[a])
                cells = Cells(a, regions.level[r], regions.x[r], regions.y[r], np.zeros(len(a), np.int64), own, edge)
                cells, border, inner = cells.placed(edges)
                found = border | inner
                own_edges, place = border[cells.own], np.cumsum(found) - 1
                edge, counts = cells.edge[own_edges], np.bincount(place[cells.own[own_edges]], minlength=found.sum())
                flat = np.column_stack([edges.x1[edge], edges.y1[edge], edges.x2[edge], edges.y2[edge]]).ravel()
                offsets = np.concatenate([[0], np.cumsum(4 * counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("name").take(pa.array(a[found])),
                        pa.array(r[found].astype(np.int32)),
                        pa.array(np.where(inner, 1, cells.flips % 2)[found].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.float64())),
                    ],
                    ["name", "region", "flips", "edges"],
                )

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from touched(batch)

    return run


def deal(regions: Regions, first: np.ndarray, copies: np.ndarray):
    """Points to the parts of their region: numbers from ``first`` on, as many as ``copies`` says; points of regions without an area have none."""
    starts = regions.starts()

    def run(batches):
        for batch in batches:
            code = point_code(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("latitude", "longitude")))
            region = np.searchsorted(starts, code, "right") - 1
            row = np.repeat(np.arange(len(region)), copies[region])
            part = _stretches(first[region], copies[region])
            columns = [batch.column(i).take(pa.array(row)) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(part.astype(np.int32))], [*batch.schema.names, "part"])

    return run


def _sum_up(regions: Regions, points: pa.Table, areas: pa.Table) -> pa.Table:
    """Tiles and tests of one part's points in each of its areas that has any."""
    names = areas.column("name").combine_chunks()
    found, totals = np.zeros(0, np.int64), None
    if len(areas) and len(points):
        lists = areas.column("edges").combine_chunks()
        edges = Edges(*lists.flatten().to_numpy().reshape(-1, 4).T.copy())
        each, region = np.diff(lists.offsets.to_numpy()) // 4, areas.column("region")[0].as_py()
        at = lambda v: np.full(len(areas), v[region])
        flips, own = areas.column("flips").to_numpy().astype(np.int64), np.repeat(np.arange(len(areas)), each)
        cells = Cells(np.arange(len(areas)), int(regions.level[region]), at(regions.x), at(regions.y), flips, own, np.arange(len(own)))
        totals = Sums(Points(points), edges, len(areas)).search(cells).sums
        found = np.flatnonzero(totals[0])
    tests_type = points.schema.field("total_tests").type
    if totals is None:
        sums = [pa.array([], pa.int64()), pa.array([], tests_type)]
    else:
        sums = [pa.array(totals[0][found]), pa.array(totals[1][found], tests_type, mask=totals[2][found] == 0)]
    return pa.Table.from_arrays([names.take(pa.array(found)), *sums], ["name", "tile_count", "total_tests"])


def sum_up(regions: Regions):
    """Sums of one part, by its points and its areas."""

    def run(points: pa.Table, areas: pa.Table) -> pa.Table:
        return _sum_up(regions, points, areas)

    return run


def sum_up_held(regions: Regions, held):
    """Sums of one part, by its points; the broadcast ``held`` has the areas of all parts, in their order."""

    def run(key: tuple, points: pa.Table) -> pa.Table:
        part = held.value.column("part").to_numpy()
        start, stop = (int(np.searchsorted(part, key[0].as_py(), side)) for side in ("left", "right"))
        return _sum_up(regions, points, held.value.slice(start, stop - start))

    return run
