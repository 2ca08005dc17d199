"""The tree search must return exactly what ranking every site per point does."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcivic.operators import nearest_sites


def brute(points, sites):
    """point id -> (min distance, set of nearest site ids), numpy over all pairs."""
    out = {}
    s = np.array([(la, lo) for _, la, lo in sites], dtype=float)
    ids = [i for i, _, _ in sites]
    p2, l2 = np.radians(s[:, 0]), np.radians(s[:, 1])
    for pid, la, lo in points:
        p1, l1 = math.radians(la), math.radians(lo)
        a = np.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * np.cos(p2) * np.sin((l2 - l1) / 2) ** 2
        a = np.clip(a, 0.0, 1.0)
        d = 6371.0 * 2 * np.arctan2(np.sqrt(a), np.sqrt(1 - a))
        m = d.min()
        out[pid] = (m, {ids[k] for k in np.nonzero(d <= m * (1 + 1e-12) + 1e-12)[0]})
    return out


def run(spark, points, sites, **kw):
    p = spark.createDataFrame(points, "pid long, lat double, lon double")
    s = spark.createDataFrame(sites, "sid long, site_lat double, site_lon double")
    got = {}
    for r in nearest_sites(p, s, **kw).collect():
        d, ids = got.get(r.pid, (r.distance_km, set()))
        ids.add(r.sid)
        got[r.pid] = (min(d, r.distance_km), ids)
    return got


def check(spark, points, sites, **kw):
    want = brute(points, sites)
    got = run(spark, points, sites, **kw)
    assert set(got) == set(want)
    for pid, (d, ids) in want.items():
        assert got[pid][1] == ids, (pid, got[pid], want[pid])
        assert got[pid][0] == pytest.approx(d, rel=1e-9, abs=1e-9)


def test_random_city(spark):
    rng = np.random.default_rng(7)
    pts = [(i, 33.7 + rng.random() * 0.6, -118.7 + rng.random() * 0.6) for i in range(400)]
    sts = [(j, 33.7 + rng.random() * 0.5, -118.6 + rng.random() * 0.5) for j in range(60)]
    check(spark, pts, sts)


@pytest.mark.parametrize("cap", [1, 4, 1000])
def test_whole_globe_at_any_capacity(spark, cap):
    rng = np.random.default_rng(cap)
    pts = [(i, rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(150)]
    sts = [(j, rng.uniform(-60, 60), rng.uniform(-180, 180)) for j in range(25)]
    check(spark, pts, sts, max_cell_sites=cap)


@pytest.mark.parametrize("cap", [1, 3])
def test_crowded_cells_descend(spark, cap):
    """A tight cluster seen from near and far: with a tiny cell capacity the
    cluster cells are descended rather than paired wholesale."""
    rng = np.random.default_rng(11 + cap)
    sts = [(j, 34.0 + rng.random() * 1e-3, -118.3 + rng.random() * 1e-3) for j in range(120)]
    sts += [(500 + j, 33.7 + rng.random() * 0.6, -118.7 + rng.random() * 0.6) for j in range(15)]
    sts += [(900, 34.0005, -118.2995), (901, 34.0005, -118.2995)]  # duplicate location inside the cluster
    pts = [(i, 34.0 + rng.normal() * 0.01, -118.3 + rng.normal() * 0.01) for i in range(80)]
    pts += [(100 + i, rng.uniform(30, 38), rng.uniform(-125, -110)) for i in range(40)]
    pts += [(200, 34.0005, -118.2995), (201, -60.0, 60.0)]
    check(spark, pts, sts, max_cell_sites=cap)


def test_a_point_meets_few_leaves():
    """The bounds really leave out most of a cluster, seen from near and far."""
    from sparkcivic.operators import nearest as N
    rng = np.random.default_rng(5)
    lat, lon = 10.0 + rng.random(2000) * 1e-3, 10.0 + rng.random(2000) * 1e-3
    g, rows = 360.0 / (1 << N._FINEST), {}
    ci, cj = ((lat + 90.0) // g).astype(int), ((lon + 180.0) // g).astype(int)
    for b in range(N._STEP, N._FINEST + 1, N._STEP):
        for k, key in enumerate(zip((ci >> (N._FINEST - b)).tolist(), (cj >> (N._FINEST - b)).tolist())):
            rows.setdefault((b, *key), []).append(k)
    cells = [(b, i, j, len(k), lat[k].min(), lat[k].max(), lon[k].min() + 180, lon[k].max() + 180, lat[k[0]], lon[k[0]] + 180)
             for (b, i, j), k in rows.items() if b == N._STEP or len(rows[b - N._STEP, i >> N._STEP, j >> N._STEP]) > 8]
    import pandas as pd
    tree = N.Quadtree(pd.DataFrame(cells, columns=["b", "ci", "cj", "n", "lat0", "lat1", "x0", "x1", "rlat", "rx"]), 8)
    assert tree.leaf.sum() > 200
    plat, plon = np.r_[10.0 + rng.random(50) * 1e-3, rng.uniform(5, 15, 50)], np.r_[10.0 + rng.random(50) * 1e-3, rng.uniform(5, 15, 50)]
    point, leaf = tree.leaves_for(plat, plon)
    assert len(leaf) < 8 * 100
    site_leaf = np.array([tree.leaf_of(i, j) for i, j in zip(ci.tolist(), cj.tolist())])
    for p in range(100):
        a = np.sin(np.radians(lat - plat[p]) / 2) ** 2 + np.cos(np.radians(lat)) * np.cos(np.radians(plat[p])) * np.sin(np.radians(lon - plon[p]) / 2) ** 2
        assert site_leaf[np.argmin(a)] in leaf[point == p]


def test_open_cells_stay_bounded(spark, monkeypatch):
    """More sites than the bound allows to open: leaves grow, answers do not change."""
    from sparkcivic.operators import nearest as N
    monkeypatch.setattr(N, "_OPEN_PER_LEVEL", 2)
    rng = np.random.default_rng(6)
    sts = [(j, rng.uniform(-60, 60), rng.uniform(-180, 180)) for j in range(200)]
    pts = [(i, rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(50)]
    check(spark, pts, sts, max_cell_sites=1)


def test_poles_antimeridian_and_clusters(spark):
    rng = np.random.default_rng(3)
    pts = [(0, 89.9, 10.0), (1, -89.99, -170.0), (2, 0.0, 179.99), (3, 0.0, -179.99), (4, 10.0, 180.0)]
    pts += [(10 + i, rng.uniform(-5, 5), rng.uniform(170, 190) - 360 * (rng.random() < 0.5)) for i in range(50)]
    sts = [(0, 0.0, -179.95), (1, 0.5, 179.5), (2, 88.0, -100.0), (3, -89.0, 20.0)]
    sts += [(10 + j, 40.0 + rng.random() * 1e-3, 2.0 + rng.random() * 1e-3) for j in range(40)]  # dense cluster
    check(spark, pts, sts)


def test_ties_are_all_kept(spark):
    pts = [(1, 0.0, 0.0), (2, 10.0, 10.0), (3, 10.0, 10.0)]
    # same coordinates twice, and two sites symmetric about point 1
    sts = [(1, 0.0, 1.0), (2, 0.0, -1.0), (3, 10.0, 10.5), (4, 10.0, 10.5), (5, 30.0, 30.0)]
    got = run(spark, pts, sts)
    assert got[1][1] == {1, 2}
    assert got[2][1] == {3, 4} and got[3][1] == {3, 4}


def test_null_and_invalid_points_take_no_part(spark):
    pts = [(1, None, 0.0), (2, float("nan"), 1.0), (3, 95.0, 0.0), (4, 1.0, 1.0)]
    sts = [(1, 1.0, 1.0), (2, None, 2.0)]
    got = run(spark, pts, sts)
    assert set(got) == {4} and got[4][1] == {1} and got[4][0] == 0.0


def test_no_sites_gives_no_rows(spark):
    pts = [(1, 1.0, 1.0)]
    p = spark.createDataFrame(pts, "pid long, lat double, lon double")
    s = spark.createDataFrame([], "sid long, site_lat double, site_lon double")
    assert nearest_sites(p, s).count() == 0


def test_plan_has_no_cartesian_product(spark):
    p = spark.range(50).select(F.col("id").alias("pid"), (F.col("id") / 100.0).alias("lat"),
                               (F.col("id") / 50.0).alias("lon"))
    s = spark.range(10).select(F.col("id").alias("sid"), (F.col("id") / 10.0).alias("site_lat"),
                               (F.col("id") / 7.0).alias("site_lon"))
    plan = nearest_sites(p, s)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_per_group_keeps_the_closest_location(spark):
    # id 1 seen at two locations: only the closer location's nearest site counts
    pts = spark.createDataFrame([(1, 0.0, 0.0), (1, 5.0, 5.0), (2, 5.0, 5.0)], "pid long, lat double, lon double")
    sts = spark.createDataFrame([(7, 0.0, 0.1), (8, 5.0, 5.5)], "sid long, site_lat double, site_lon double")
    got = sorted((r.pid, r.sid) for r in nearest_sites(pts, sts, per="pid").collect())
    assert got == [(1, 7), (2, 8)]


def test_finest_level_keeps_crowded_cells(spark):
    """More sites than a cell may hold, centimetres apart, at the last level."""
    rng = np.random.default_rng(5)
    sts = [(j, 34.0 + 1e-9 * j, -118.0 + 1e-9 * (j % 10)) for j in range(100)] + [(900, 34.0 + 4e-7, -118.0)]
    pts = [(1, 34.0, -118.0), (2, 34.0 + 5e-8, -118.0), (3, 34.0 + 3e-7, -118.0), (4, 33.0, -117.0)]
    pts += [(10 + i, 34.0 + rng.random() * 4e-7, -118.0 + rng.random() * 1e-8) for i in range(20)]
    want = brute(pts, sts)
    for kw in ({}, {"max_cell_sites": 8}, {"max_cell_sites": 1}):
        got = run(spark, pts, sts, **kw)
        for pid, (d, _) in want.items():
            assert got[pid][0] == pytest.approx(d, rel=1e-6, abs=1e-9), (kw, pid)


def test_null_group_and_infinite_coordinates(spark):
    inf = float("inf")
    pts = [(None, 34.0, -118.0), (None, 36.0, -118.0), (1, 34.0, -118.0), (2, 34.0, inf), (3, 34.0, -inf), (4, 34.0, float("nan"))]
    sts = [(1, 34.0, -118.1), (2, 34.0, inf), (3, float("nan"), 1.0), (4, inf, 1.0), (5, -33.0, 100.0)]
    p = spark.createDataFrame(pts, "pid long, lat double, lon double")
    s = spark.createDataFrame(sts, "sid long, site_lat double, site_lon double")
    got = [(r.pid, r.lat, r.sid) for r in nearest_sites(p, s, per="pid").collect()]
    assert sorted(got, key=str) == [(1, 34.0, 1), (None, 34.0, 1)]


def test_jobs_are_few_whatever_the_points(spark):
    rng = np.random.default_rng(9)
    pts = [(i, 33.7 + rng.random() * 0.6, -118.7 + rng.random() * 0.6) for i in range(500)]
    sts = [(j, 33.7 + rng.random() * 0.6, -118.7 + rng.random() * 0.6) for j in range(1000)]
    tracker = spark.sparkContext.statusTracker()

    def jobs(points):
        spark.sparkContext.setJobGroup(f"n{len(points)}", "nearest")
        check(spark, points, sts)
        n = len(tracker.getJobIdsForGroup(f"n{len(points)}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return n
    few = jobs(pts)
    assert few <= 14 and jobs(pts + [(999, -45.0, 170.0)]) == few


def test_ranks_are_pruned_before_the_shuffle(spark):
    p = spark.createDataFrame([(1, 34.0, -118.0), (1, 34.1, -118.0)], "pid long, lat double, lon double")
    s = spark.createDataFrame([(1, 34.0, -118.1)], "sid long, site_lat double, site_lon double")
    plan = nearest_sites(p, s, per="pid")._jdf.queryExecution().executedPlan().toString()
    top = plan[:plan.index("Exchange hashpartitioning(pid")]
    assert "WindowGroupLimit" in top and "WindowGroupLimit" in plan[len(top):]
