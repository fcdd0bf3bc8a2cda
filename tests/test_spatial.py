import math
import random

from pyspark.sql import functions as F

from tussock.functions.geo import EARTH_RADIUS_KM
from tussock.operators.spatial import count_within_distance, within_distance


def _hav(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
        (math.radians(lon2) - math.radians(lon1)) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(a))


def test_walking_distance_fixture(spark):
    centres = spark.createDataFrame([("a", -36.85, 174.76), ("b", -36.0, 175.4)],
                                    "suburb string, centroid_lat double, centroid_lon double")
    stops = spark.createDataFrame([(1, -36.85, 174.76), (2, -36.85 + 0.0071, 174.76), (3, -36.85 + 0.0073, 174.76)],
                                  "stop_id long, lat double, lon double")
    got = {r.suburb: r.n for r in count_within_distance(centres, stops, 0.8, "suburb", "stop_id", "n").collect()}
    assert got == {"a": 2, "b": 0}


def test_grid_equals_brute_force(spark):
    rnd = random.Random(7)
    anchors = [(-36.85, 174.76), (0.0, 0.0), (60.0, 10.0), (84.0, -30.0), (-89.99, 40.0), (10.0, 179.995),
               (-45.0, -179.99)]
    centres, points = [], []
    for radius in (0.8, 25.0):
        for ai, (alat, alon) in enumerate(anchors):
            spread = radius / 111.0 * 3
            for j in range(6):
                lat = max(-90.0, min(90.0, alat + rnd.uniform(-spread, spread)))
                lon = ((alon + rnd.uniform(-spread * 4, spread * 4) + 180) % 360) - 180
                centres.append((f"{radius}-{ai}-{j}", radius, lat, lon))
            for j in range(120):
                lat = max(-90.0, min(90.0, alat + rnd.uniform(-spread, spread)))
                lon = ((alon + rnd.uniform(-spread * 4, spread * 4) + 180) % 360) - 180
                points.append((len(points), lat, lon))
    pdf = spark.createDataFrame(points, "pid long, lat double, lon double")
    for radius in (0.8, 25.0):
        cs = [c for c in centres if c[1] == radius]
        cdf = spark.createDataFrame([(c[0], c[2], c[3]) for c in cs], "cid string, centroid_lat double, centroid_lon double")
        got = {(r.cid, r.pid) for r in within_distance(cdf, pdf, radius).select("cid", "pid").collect()}
        want = {(c[0], p[0]) for c in cs for p in points if _hav(c[2], c[3], p[1], p[2]) < radius}
        assert got == want, (radius, len(got), len(want))
        assert len(want) > 0


def test_transit_plan_has_no_nested_loop(spark):
    centres = spark.createDataFrame([("a", -36.85, 174.76)], "suburb string, centroid_lat double, centroid_lon double")
    stops = spark.range(1000).select(F.col("id").alias("stop_id"), (F.lit(-36.85) + F.col("id") / 1e5).alias("lat"),
                                     F.lit(174.76).alias("lon"))
    plan = count_within_distance(centres, stops, 0.8, "suburb", "stop_id", "n")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_split_cells_equal_whole_ones(spark):
    rnd = random.Random(3)
    cs = [(f"c{i}", -36.85 + rnd.uniform(-0.02, 0.02), 174.76 + rnd.uniform(-0.02, 0.02)) for i in range(20)]
    ps = [(i, -36.85 + rnd.uniform(-0.03, 0.03), 174.76 + rnd.uniform(-0.03, 0.03)) for i in range(2000)]
    ps += [(5000 + i, -36.85, 174.76) for i in range(1000)]
    cs += [("near", -36.85, 174.76), ("edge", -36.85 + 0.0071, 174.76), ("pole", 89.9999, 10.0), ("line", -10.0, 179.9999)]
    ps += [(9000 + i, 89.9999, 10.0 + i) for i in range(120)] + [(9500 + i, -10.0, -179.9999 if i % 2 else 179.9998) for i in range(120)]
    cdf = spark.createDataFrame(cs, "cid string, centroid_lat double, centroid_lon double")
    pdf = spark.createDataFrame(ps, "pid long, lat double, lon double")
    base = {(r.cid, r.pid) for r in within_distance(cdf, pdf, 0.8, cell_points=10 ** 9).collect()}
    for cell_points in (4, 50, 400):
        split = within_distance(cdf, pdf, 0.8, cell_points=cell_points)
        assert split.columns == ["pid", "lat", "lon", "cid", "centroid_lat", "centroid_lon"]
        rows = split.collect()
        assert len(rows) == len(base) and base == {(r.cid, r.pid) for r in rows} and len(base) > 3000


def test_crowded_cells_are_dealt_out(spark):
    """A third of all points in one block: no key holds much more than the limit, and every point has a key."""
    from tussock.operators.spatial import crowded_parts, point_cells

    points = spark.range(9000).select(
        F.col("id").alias("pid"), F.when(F.col("id") % 3 == 0, F.lit(-36.85)).otherwise(F.lit(-36.8) - (F.col("id") % 700) / 3000.0).alias("lat"),
        F.when(F.col("id") % 3 == 0, F.lit(174.76)).otherwise(F.lit(174.6) + (F.col("id") % 531) / 3000.0).alias("lon"))
    parts = crowded_parts(point_cells(points, "lat", "lon", 0.8), cell_points=100).collect()
    assert max(p._salts for p in parts) == 30 and {p._level for p in parts} == {3}
    centres = spark.createDataFrame([("c", -36.85, 174.76)], "cid string, centroid_lat double, centroid_lon double")
    assert within_distance(centres, points, 0.8, cell_points=100).count() == within_distance(centres, points, 0.8).count() > 3000


def _counts(spark, cs, ps, radius, **kw):
    cdf = spark.createDataFrame(cs, "cid string, centroid_lat double, centroid_lon double")
    pdf = spark.createDataFrame(ps, "pid long, lat double, lon double")
    return cdf, pdf, {r.cid: r.n for r in count_within_distance(cdf, pdf, radius, "cid", "pid", "n", **kw).collect()}


def test_counts_equal_brute_force(spark):
    """Cells met place by place and cells cut into parts; copies, null ids and places, both sides of the date line, poles."""
    rnd = random.Random(11)
    anchors = [(-36.85, 174.76), (0.0, 0.0), (60.0, 179.999), (-89.995, 40.0), (89.9999, -10.0)]
    nan = float("nan")
    for radius in (0.8, 25.0, 21000.0):
        spread = min(radius, 30) / 111.0 * 2
        cs, ps = [(None, -36.85, 174.76), ("none", None, 1.0), ("nan", nan, 1.0)], [(None, -36.85, 174.76), (1, None, 5.0), (2, nan, 5.0), (3, -36.85, nan)]
        for a, (lat, lon) in enumerate(anchors):
            def place():
                return (max(-90.0, min(90.0, lat + rnd.uniform(-spread, spread))), (lon + rnd.uniform(-spread * 2, spread * 2) + 180) % 360 - 180)
            cs += [(f"{a}-{j % 7}", *place()) for j in range(10)]
            ps += [(100 * a + j, *place()) for j in range(400)]
            ps += [(9000, lat, lon)] * 5
        want = {}
        for c, lat, lon in cs:
            near = [] if lat is None else [1 for p in ps if p[0] is not None and p[1] is not None and _hav(lat, lon, p[1], p[2]) < radius]
            want[c] = want.get(c, 0) + len(near)
        for cell_points in (0, 40, 10 ** 9):
            assert _counts(spark, cs, ps, radius, cell_points=cell_points)[2] == want, (radius, cell_points)


def test_copies_and_whole_parts_are_not_paired(spark):
    """100 x 4,000 copies and 4,000 distinct places around: far fewer rows meet than there are pairs."""
    rnd = random.Random(5)
    ps = [(i, -36.85, 174.76) for i in range(4000)]
    ps += [(i, -36.85 + rnd.uniform(-0.006, 0.006), 174.76 + rnd.uniform(-0.007, 0.007)) for i in range(4000)]
    cs = [(f"c{i}", -36.85, 174.76) for i in range(100)]
    cdf, pdf, got = _counts(spark, cs, ps, 0.8)
    n = sum(_hav(-36.85, 174.76, p[1], p[2]) < 0.8 for p in ps)
    assert set(got.values()) == {n} and len(got) == 100 and n > 7000
    df = count_within_distance(cdf, pdf, 0.8, "cid", "pid", "n")
    df.collect()

    def joined(plan):
        own = [plan.metrics().apply("numOutputRows").value()] if plan.nodeName().endswith("Join") else []
        name = plan.nodeName()
        below = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if name.endswith("QueryStage") else []
        inner = plan.children()
        return own + sum((joined(p) for p in [*below, *(inner.apply(i) for i in range(inner.size()))]), [])

    assert 0 < max(joined(df._jdf.queryExecution().executedPlan())) < 10_000
