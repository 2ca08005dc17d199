"""Exact nearest-site search with all ties kept, by a quadtree of the sites.

For every point the result holds each site whose great-circle distance equals
the minimum over all sites -- the rows that ``rank() == 1`` over a cross join
of points and sites would keep -- without materialising that cross join.

Both sides are first reduced to their distinct coordinates, so a location
shared by many rows is solved once.

The tree. The globe is cut into square cells of ``360 / 2**b`` degrees for
every second ``b`` up to ``_FINEST`` (centimetres). One aggregation counts the
sites of every cell of every level, with the bounding box of its sites and one
of them as its representative. A cell with more than ``max_cell_sites``
locations is opened into its sixteen sub-cells; the cells that are not are the
leaves. Empty cells do not occur. The capacity of a leaf grows with the number
of sites, so that the open cells, which every task needs, stay within a proven
bound (``_OPEN_PER_LEVEL`` per level, sixteen sub-cells each); the sites
themselves stay in a written table, keyed by leaf.

The search. Every point goes down the tree with a bound of its own: the least
distance to a representative met so far. Cells whose box lies beyond the bound
are left out, so a point reaches the few leaves that can hold its nearest site,
wherever it lies: inside a city, in a tight cluster, or an ocean away. Points
and sites of a leaf then meet in one equi join, and the minimum per point is a
rank that ``WindowGroupLimit`` prunes before its shuffle. Cells left out are
strictly farther than a real site, so neither the minimum nor a tie is lost.

The number of jobs does not depend on the data: there are no rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_KM, haversine_km
from ..session import materialize

# slack between a distance found and a bound: relative, plus an absolute one of
# about 1 um on the globe for the finest cells (centimetres), where the rounding
# error of angles in radians would exceed the relative part alone. Both are far
# above floating-point error, so no nearer site is ever missed.
_SLACK = 1e-9
_ABS_SLACK = 1e-13
_STEP, _FINEST = 2, 30  # each level splits a cell into 4 x 4; the finest level's cells are leaves whatever they hold
DEFAULT_MAX_CELL_SITES = 64
_OPEN_PER_LEVEL = 4096  # open cells of one level at most
_CHUNK = 4096  # points that go down the tree together


class Quadtree:
    """The cells of the tree as arrays. Distances are compared as the sine of
    half their angle, which grows with them; no radius is needed. An open cell
    with one sub-cell is passed over."""

    def __init__(self, cells: pd.DataFrame, capacity: int):
        cells = cells.sort_values(["b", "ci", "cj"], ignore_index=True)
        b, ci, cj = (cells[c].to_numpy(np.int64) for c in ("b", "ci", "cj"))
        self.leaf = (cells["n"].to_numpy() <= capacity) | (b == _FINEST)
        self.lat0, self.lat1, self.x0, self.x1, self.rlat, self.rx = (
            np.radians(cells[c].to_numpy(np.float64)) for c in ("lat0", "lat1", "x0", "x1", "rlat", "rx"))
        self.least_cos = np.maximum(np.minimum(np.cos(self.lat0), np.cos(self.lat1)), 0.0)
        self.rcos = np.cos(self.rlat)
        self.numbers = {key: k for k, key in enumerate(zip(b.tolist(), ci.tolist(), cj.tolist()))}
        parent = [self.numbers.get((x - _STEP, i >> _STEP, j >> _STEP), -1) for x, i, j in zip(b.tolist(), ci.tolist(), cj.tolist())]
        parent = np.array(parent, dtype=np.int64)
        children = np.argsort(parent, kind="stable")
        self.first = np.searchsorted(parent[children], np.arange(len(cells) + 1))
        down = np.arange(len(cells))
        while (single := ~self.leaf[down] & (self.first[down + 1] - self.first[down] == 1)).any():
            down[single] = children[self.first[down[single]]]
        self.children, self.roots = down[children], down[np.flatnonzero(b == _STEP)]

    def to_representative(self, lat, cos, x, cell):
        a = np.sin((self.rlat[cell] - lat) / 2) ** 2 + cos * self.rcos[cell] * np.sin((self.rx[cell] - x) / 2) ** 2
        return np.sqrt(a)

    def beyond(self, lat, cos, x, cell):
        """Lower bound on the distance to any site of the cell: latitude gap,
        wrapped longitude gap, least cosine of the cell's latitudes."""
        dphi = np.maximum(np.maximum(self.lat0[cell] - lat, lat - self.lat1[cell]), 0.0)
        west, east = self.x0[cell] - x, x - self.x1[cell]
        gap = np.maximum(np.maximum(west, east), 0.0)  # the other way round the globe is shorter where a gap exceeds half
        gap = np.minimum(gap, np.where(west > 0, 2 * np.pi + east, 2 * np.pi + west))
        return np.sqrt(np.sin(dphi / 2) ** 2 + cos * self.least_cos[cell] * np.sin(gap / 2) ** 2)

    def leaves_for(self, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) pairs: all leaves that can hold a nearest site."""
        phi, x = np.radians(lat), np.radians(np.mod(lon + 180.0, 360.0))
        cos = np.cos(phi)
        bound = np.full(len(lat), np.inf)
        point, cell = np.repeat(np.arange(len(lat)), len(self.roots)), np.tile(self.roots, len(lat))
        points, leaves, bounds = [], [], []
        while len(point):
            at = phi[point], cos[point], x[point], cell
            np.minimum.at(bound, point, self.to_representative(*at))
            least = self.beyond(*at) * (1.0 - _SLACK) - _ABS_SLACK
            keep = least <= bound[point]
            point, cell, least = point[keep], cell[keep], least[keep]
            end = self.leaf[cell]
            points.append(point[end])
            leaves.append(cell[end])
            bounds.append(least[end])
            point, cell = point[~end], cell[~end]
            n = self.first[cell + 1] - self.first[cell]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            point, cell = np.repeat(point, n), self.children[np.repeat(self.first[cell], n) + place]
        point, leaf, least = map(np.concatenate, (points, leaves, bounds))
        keep = least <= bound[point]  # by the last bounds
        return point[keep], leaf[keep]

    def leaf_of(self, ci: int, cj: int) -> int:
        """The leaf of a site, by its cell of the finest level."""
        for b in range(_STEP, _FINEST + 1, _STEP):
            k = self.numbers[b, ci >> (_FINEST - b), cj >> (_FINEST - b)]
            if self.leaf[k]:
                return k
        raise KeyError((ci, cj))


def _cells(places: DataFrame) -> DataFrame:
    """Every occupied cell of every level, with ``above``: the sites of the
    cell that holds it."""
    b = F.explode(F.sequence(F.lit(_STEP), F.lit(_FINEST), F.lit(_STEP)))
    rows = places.select("_slat", "_slon", "_ci", "_cj", b.alias("b")).select(
        "b", F.expr(f"shiftright(_ci, {_FINEST} - b)").alias("ci"), F.expr(f"shiftright(_cj, {_FINEST} - b)").alias("cj"),
        "_slat", F.pmod(F.col("_slon") + F.lit(180.0), F.lit(360.0)).alias("x"))
    cells = rows.groupBy("b", "ci", "cj").agg(
        F.count(F.lit(1)).alias("n"), F.min("_slat").alias("lat0"), F.max("_slat").alias("lat1"), F.min("x").alias("x0"),
        F.max("x").alias("x1"), F.min("_slat").alias("rlat"), F.min_by("x", "_slat").alias("rx"))
    above = Window.partitionBy("b", F.expr(f"shiftright(ci, {_STEP})"), F.expr(f"shiftright(cj, {_STEP})"))
    return cells.withColumn("above", F.sum("n").over(above))


def quadtree(places: DataFrame, n_sites: int, max_cell_sites: int) -> Quadtree:
    """The tree over a table of distinct sites. What the driver collects are
    the sub-cells of open cells: a bounded number, however many sites there are."""
    capacity = max(max_cell_sites, n_sites // _OPEN_PER_LEVEL)
    cells = _cells(places).where((F.col("above") > capacity) | (F.col("b") == _STEP)).drop("above")
    return Quadtree(cells.toPandas(), capacity)


def _searching(tree):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), _CHUNK):
                lat, lon = (batch[c].to_numpy(np.float64)[k:k + _CHUNK] for c in ("_plat", "_plon"))
                point, leaf = tree.value.leaves_for(lat, lon)
                yield pd.DataFrame({"_plat": lat[point], "_plon": lon[point], "_leaf": leaf})
    return search


def _placing(tree):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaf = [tree.value.leaf_of(i, j) for i, j in zip(batch["_ci"].tolist(), batch["_cj"].tolist())]
            yield batch[["_slat", "_slon"]].assign(_leaf=np.array(leaf, dtype=np.int64))
    return place


def distinct_sites(sites: DataFrame) -> tuple[DataFrame, int]:
    """The distinct ``_slat, _slon``, with their cells of the finest level, as
    a written table, and how many there are."""
    g = 360.0 / (1 << _FINEST)
    ci = F.floor((F.col("_slat") + F.lit(90.0)) / F.lit(g))
    cj = F.floor(F.pmod(F.col("_slon") + F.lit(180.0), F.lit(360.0)) / F.lit(g))
    places = sites.select("_slat", "_slon").distinct().withColumns({"_ci": ci, "_cj": cj})
    places, seen = materialize(places, "nearest-sites", {"n": F.count(F.lit(1))})
    return places, seen["n"]


def nearest_coordinates(points: DataFrame, sites: DataFrame, radius: float = EARTH_RADIUS_KM,
                        max_cell_sites: int = DEFAULT_MAX_CELL_SITES) -> DataFrame:
    """Nearest site coordinates for distinct point coordinates.

    ``points`` has double columns ``_plat, _plon`` (distinct); ``sites`` has
    ``_slat, _slon``; all finite, latitudes in [-90, 90]. Returns ``_plat,
    _plon, _slat, _slon, _d`` with every tied nearest site.
    """
    places, n_sites = distinct_sites(sites)
    if not n_sites:
        nul = F.lit(None).cast("double")
        return points.limit(0).select("_plat", "_plon", nul.alias("_slat"), nul.alias("_slon"), nul.alias("_d"))
    tree = points.sparkSession.sparkContext.broadcast(quadtree(places, n_sites, max_cell_sites))
    asked = points.select("_plat", "_plon").mapInPandas(_searching(tree), "_plat double, _plon double, _leaf long")
    held = places.mapInPandas(_placing(tree), "_slat double, _slon double, _leaf long")
    met = asked.join(held, "_leaf").select(
        "_plat", "_plon", "_slat", "_slon", haversine_km("_plat", "_plon", "_slat", "_slon", radius).alias("_d"))
    order = Window.partitionBy("_plat", "_plon").orderBy("_d")
    return met.withColumn("_rk", F.rank().over(order)).filter("_rk = 1").drop("_rk")


def nearest_sites(points: DataFrame, sites: DataFrame, lat: str = "lat", lon: str = "lon",
                  site_lat: str = "site_lat", site_lon: str = "site_lon",
                  distance_col: str = "distance_km", radius: float = EARTH_RADIUS_KM,
                  materialize_points: bool = True, max_cell_sites: int = DEFAULT_MAX_CELL_SITES,
                  per: str | None = None) -> DataFrame:
    """Every point row joined with every site at its minimum distance.

    ``per`` names a column grouping point rows (an id seen at several
    locations): then only the rows at the group's smallest distance are kept,
    like ranking all (row, site) pairs of the group and keeping rank 1. NULL
    ids form one group. The rank is pruned before its shuffle.

    Points or sites with a NULL, NaN or infinite coordinate, or a latitude
    outside [-90, 90], take no part. Output: all point columns, all site
    columns and ``distance_col``. ``materialize_points`` writes the points out
    first so an expensive upstream plan is not evaluated twice (once for the
    distinct coordinates, once for the final join back). The distinct site
    locations are always written, as they are read twice.
    """
    def valid(la: str, lo: str) -> Column:
        return F.col(la).between(-90.0, 90.0) & (F.abs(F.col(lo).cast("double")) < float("inf"))

    pts = (points.filter(valid(lat, lon))
           .withColumn("_plat", F.col(lat).cast("double")).withColumn("_plon", F.col(lon).cast("double")))
    if materialize_points:
        pts = materialize(pts, "nearest-points")
    sts = (sites.filter(valid(site_lat, site_lon))
           .withColumn("_slat", F.col(site_lat).cast("double"))
           .withColumn("_slon", F.col(site_lon).cast("double")))
    nn = nearest_coordinates(pts.select("_plat", "_plon").distinct(), sts, radius, max_cell_sites)
    near = pts.join(nn, ["_plat", "_plon"])
    if per is not None:
        near = near.withColumn("_rk", F.rank().over(Window.partitionBy(per).orderBy("_d"))).filter("_rk = 1").drop("_rk")
    return (near.join(sts, ["_slat", "_slon"])
            .withColumnRenamed("_d", distance_col)
            .drop("_plat", "_plon", "_slat", "_slon"))
