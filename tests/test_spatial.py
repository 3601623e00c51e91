"""grid/run point-in-polygon join against an exact brute force."""

import json
import random
from fractions import Fraction

import pytest

from tripdemand.operators.spatial import PolygonIndex
from tripdemand.sources.boroughs import edges_per_borough, geojson_edges, geojson_text_frame, read_borough_geojson

SQUARE_WITH_HOLE = [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]],
                    [[3, 3], [6, 3], [6, 6], [3, 6], [3, 3]]]
FEATURES = [
    ("A", 1, "Polygon", SQUARE_WITH_HOLE),
    ("B", 2, "MultiPolygon", [[[[12, 0], [18, 0], [15, 5], [12, 0]]],
                              [[[12, 6], [16, 6], [16, 10], [12, 10]]]]),  # ring left open
    ("C", 3, "Polygon", [[[8, 8], [14, 8], [14, 14], [8, 14], [8, 8]]]),     # overlaps A and B
    ("D", 4, "Polygon", [[[20, 0], [26, 0], [26, 6], [20, 6], [20, 0]]]),
    ("D", 4, "Polygon", [[[23, 3], [29, 3], [29, 9], [23, 9], [23, 3]]]),   # overlaps D's first part
]


def geojson(features=FEATURES):
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"borough": n, "boroughCode": c},
         "geometry": {"type": t, "coordinates": coords}} for n, c, t, coords in features]})


def polygons(features=FEATURES):
    """(code, name, rings) per polygon, each MultiPolygon part separately."""
    out = []
    for n, c, t, coords in features:
        for poly in ([coords] if t == "Polygon" else coords):
            out.append((c, n, poly))
    return out


def brute_force(x, y, polys):
    """Exact even-odd per polygon, on-edge is outside, smallest code wins, else EWR."""
    if x != x or y != y or abs(x) == float("inf") or abs(y) == float("inf"):
        return "EWR"
    px, py = Fraction(x), Fraction(y)
    best = None
    for code, name, rings in polys:
        inside, on_edge = False, False
        for ring in rings:
            n = len(ring)
            for i in range(n):
                (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
                x1, y1, x2, y2 = map(Fraction, (x1, y1, x2, y2))
                if (x1, y1) == (x2, y2):
                    continue
                cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
                if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                    on_edge = True
                if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                    inside = not inside
        if inside and not on_edge and (best is None or code < best[0]):
            best = (code, name)
    return best[1] if best else "EWR"


def locate(spark, pts, cells_per_side, features=FEATURES):
    index = PolygonIndex(geojson_edges(geojson_text_frame(spark, geojson(features))),
                         cells_per_side=cells_per_side)
    df = spark.createDataFrame(pts, "pid long, x double, y double")
    return {r.pid: r.borough_name for r in index.locate(df, "x", "y").collect()}


SPECIAL = [
    (0, 0.0, 0.0), (1, 10.0, 10.0),       # vertices of A; (10,10) is inside C
    (2, 3.0, 4.0), (3, 4.0, 4.0),         # on the hole's edge; inside the hole
    (4, 9.0, 9.0),                        # in A and C -> A (smaller code)
    (5, 1.0, 1.0), (6, 15.0, 2.0),        # inside A; inside B's triangle
    (7, 13.0, 9.0),                       # in B's square and C -> B
    (8, 24.0, 4.0),                       # where D's two parts overlap -> D
    (9, 27.0, 1.0), (10, -5.0, 3.0),      # outside everything
    (11, float("nan"), 1.0), (12, float("inf"), 1.0), (13, 5.0, 0.0),  # NaN, inf, on edge
    (14, 15.0, 5.0), (15, 12.0, 6.0),     # apex of B's triangle; corner of open ring
]


@pytest.mark.parametrize("cells", [7, 29, 64, 512])
def test_special_points(spark, cells):
    got = locate(spark, SPECIAL, cells)
    polys = polygons()
    for pid, x, y in SPECIAL:
        assert got[pid] == brute_force(x, y, polys), (pid, x, y, cells)
    assert got[1] == "C" and got[4] == "A" and got[8] == "D" and got[3] == "EWR"


@pytest.mark.parametrize("cells", [29, 100])
def test_random_points_match_brute_force(spark, cells):
    rng = random.Random(7)
    pts = [(i, rng.randrange(-40, 260) / 8, rng.randrange(-40, 130) / 8) for i in range(3000)]
    got = locate(spark, pts, cells)
    polys = polygons()
    bad = [(p, x, y, got[p]) for p, x, y in pts if got[p] != brute_force(x, y, polys)]
    assert not bad, bad[:10]


def test_edges_per_borough(spark):
    edges = geojson_edges(geojson_text_frame(spark, geojson()))
    counts = {r.borough_code: (r.n_edges, r.n_polygons) for r in edges_per_borough(edges).collect()}
    assert counts == {1: (8, 1), 2: (7, 2), 3: (4, 1), 4: (8, 2)}


def test_geojson_file(spark, tmp_dir):
    path = f"{tmp_dir}/boroughs.geojson"
    with open(path, "w") as f:
        f.write(geojson())
    edges = read_borough_geojson(spark, path)
    assert edges.count() == 27
    assert {r.borough for r in edges.select("borough").distinct().collect()} == {"A", "B", "C", "D"}


def test_point_side_does_not_shuffle(spark):
    import contextlib
    import io
    index = PolygonIndex(geojson_edges(geojson_text_frame(spark, geojson())), cells_per_side=64)
    pts = spark.range(1000).selectExpr("id as pid", "id % 30 as x", "id % 11 as y")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        index.locate(pts, "x", "y").explain("formatted")
    plan = buf.getvalue()
    tree = plan.split("\n\n")[0]
    spine = tree.split("BroadcastExchange")[0]  # root down to the point-side leaf
    assert spine.count("BroadcastHashJoin LeftOuter") == 3  # cells, runs, names
    assert "Range" in spine and "Exchange" not in spine
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def _blob(rng, cx, cy, r, n, jitter):
    import math
    pts = []
    for i in range(n):
        a = 2 * math.pi * i / n
        rr = r * (1 + jitter * (rng.random() - 0.5))
        pts.append([cx + rr * math.cos(a), cy + rr * math.sin(a)])
    return pts + [pts[0]]


def test_jagged_boroughs_with_holes_and_islands(spark):
    """~1,900 edges, auto grid: every point agrees with the brute force."""
    import numpy as np
    rng = random.Random(11)
    feats = []
    for code in (1, 2, 3):
        cx, cy = -74.0 + 0.1 * code, 40.6 + 0.04 * (code % 2)
        outer = _blob(rng, cx, cy, 0.08, 500, 0.3)
        hole = _blob(rng, cx, cy, 0.02, 60, 0.2)[::-1]
        island = _blob(rng, cx + 0.1, cy + 0.03, 0.02, 60, 0.4)
        feats.append((f"B{code}", code, "MultiPolygon", [[outer, hole], [island]]))
    edges = geojson_edges(geojson_text_frame(spark, geojson(feats)))
    index = PolygonIndex(edges)
    assert index.cells_per_side > 100
    prng = np.random.default_rng(5)
    xs, ys = prng.uniform(-74.0, -73.55, 6000), prng.uniform(40.45, 40.8, 6000)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(xs, ys))],
                               "pid long, x double, y double")
    got = {r.pid: r.borough_name for r in index.locate(df, "x", "y").collect()}
    x, y = xs[:, None], ys[:, None]
    best = np.full(len(xs), "EWR", dtype=object)
    bestc = np.full(len(xs), 99)
    for code, name, rings in polygons(feats):
        segs = [(a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1]) if a != b]
        x1, y1 = np.array([s[0][0] for s in segs])[None, :], np.array([s[0][1] for s in segs])[None, :]
        x2, y2 = np.array([s[1][0] for s in segs])[None, :], np.array([s[1][1] for s in segs])[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
        inside = hit.sum(axis=1) % 2 == 1
        upd = inside & (code < bestc)
        bestc[upd], best[upd] = code, name
    bad = [i for i in range(len(xs)) if got[i] != best[i]]
    assert not bad, bad[:10]
    assert len({v for v in got.values()}) == 4


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@st.composite
def lattice_star(draw, cx, cy):
    """A star-shaped polygon with integer vertices around (cx, cy)."""
    import math
    n = draw(st.integers(3, 9))
    pts = []
    for i in range(n):
        a = 2 * math.pi * i / n
        r = draw(st.integers(1, 6))
        pts.append([cx + round(r * math.cos(a)), cy + round(r * math.sin(a))])
    dedup = [p for i, p in enumerate(pts) if p != pts[i - 1]]
    return dedup if len(dedup) >= 3 else [[cx, cy], [cx + 2, cy], [cx, cy + 2]]


@settings(max_examples=4, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow,
                                 HealthCheck.data_too_large, HealthCheck.large_base_example])
@given(data=st.data())
def test_lattice_polygons_property(spark, data):
    """Vertices on grid lines, points on edges and vertices: grid = exact brute force."""
    feats = [(f"P{c}", c, "Polygon", [data.draw(lattice_star(cx, cy))])
             for c, (cx, cy) in enumerate([(0, 0), (3, 1), (9, 4)], start=1)]
    cells = data.draw(st.integers(3, 40))
    pts = [(i, x / 2, y / 2) for i, (x, y) in
           enumerate((x, y) for x in range(-16, 34) for y in range(-16, 24))]
    got = locate(spark, pts, cells, feats)
    polys = polygons(feats)
    bad = [(x, y, got[p]) for p, x, y in pts if got[p] != brute_force(x, y, polys)]
    assert not bad, (cells, feats, bad[:5])


def test_index_diagnostics(spark):
    index = PolygonIndex(geojson_edges(geojson_text_frame(spark, geojson())), cells_per_side=29)
    info = index.summary()
    assert info["cells_per_side"] == 29 and info["index_cells"] > 0 and info["runs"] > 0
    pts = spark.range(2000).selectExpr("(id % 40) * 0.75 - 1 as x", "(id % 23) * 0.75 - 1 as y")
    row = index.edge_cell_share(pts, "x", "y").first()
    assert row.points == 2000 and 0 < row.in_edge_cells < 2000
    assert 0 < row.share < 1 and row.mean_candidate_edges >= 1


def numpy_located(xs, ys, polys):
    """Even-odd per polygon in double precision, smallest code wins (points off all edges)."""
    import numpy as np
    best, bestc = np.full(len(xs), "EWR", dtype=object), np.full(len(xs), 99)
    for code, name, rings in polys:
        seg = np.array([(*a, *b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1]) if a != b])
        hits = np.zeros(len(xs), int)
        for part in np.array_split(seg, max(1, len(seg) // 500)):
            x1, y1, x2, y2 = (part[None, :, k] for k in range(4))
            with np.errstate(divide="ignore", invalid="ignore"):
                hits += (((y1 > ys[:, None]) != (y2 > ys[:, None]))
                         & (xs[:, None] < (x2 - x1) * (ys[:, None] - y1) / (y2 - y1) + x1)).sum(axis=1)
        upd = (hits % 2 == 1) & (code < bestc)
        bestc[upd], best[upd] = code, name
    return best


def test_detailed_coast_has_short_lists(spark):
    """16,000 edges along one wavy shore next to plain squares: every list stays within the bound,
    and cells are spent on the shore only."""
    import math

    import numpy as np
    n = 16_000
    shore = [[8 * i / n, 1 + 0.3 * math.sin(9 * i / n * 8) + 0.004 * math.sin(i * 1.7) + 0.002 * (i % 2)] for i in range(n + 1)]
    feats = [("Coast", 1, "Polygon", [shore + [[8, 3], [0, 3], shore[0]]]),
             ("Plain", 2, "Polygon", [[[0, 3], [8, 3], [8, 9], [0, 9], [0, 3]]]),
             ("Under", 3, "Polygon", [[[1, 0.2], [7, 0.2], [7, 4], [1, 4], [1, 0.2]]])]
    index = PolygonIndex(geojson_edges(geojson_text_frame(spark, geojson(feats))))
    info = index.summary()
    assert info["longest_list"] <= 64 and info["levels"] >= 2
    # A uniform grid as fine as the smallest cells would need far more cells.
    fine = (info["cells_per_side"] * 16 ** (info["levels"] - 1)) ** 2
    assert info["index_cells"] < fine / 40
    rng = np.random.default_rng(2)
    xs = np.concatenate([rng.uniform(-0.5, 8.5, 3000), rng.uniform(0, 8, 5000)])
    ys = np.concatenate([rng.uniform(-0.5, 9.5, 3000), 1 + 0.3 * np.sin(9 * xs[3000:]) + rng.uniform(-0.01, 0.01, 5000)])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(xs, ys))], "pid long, x double, y double")
    got = {r.pid: r.borough_name for r in index.locate(df, "x", "y").collect()}
    want = numpy_located(xs, ys, polygons(feats))
    bad = [(xs[i], ys[i], got[i], want[i]) for i in range(len(xs)) if got[i] != want[i]]
    assert not bad, bad[:5]


@pytest.mark.parametrize("max_edges", [1, 3])
def test_split_cells_match_brute_force(spark, max_edges):
    """Lists so short that cells split to the last level: still equal to the exact test, on vertices and edges too."""
    index = PolygonIndex(geojson_edges(geojson_text_frame(spark, geojson())), cells_per_side=5, max_edges=max_edges)
    assert index.summary()["levels"] >= 2
    pts = SPECIAL + [(100 + i, x / 2, y / 2) for i, (x, y) in enumerate((x, y) for x in range(-4, 60) for y in range(-4, 32))]
    df = spark.createDataFrame(pts, "pid long, x double, y double")
    got = {r.pid: r.borough_name for r in index.locate(df, "x", "y").collect()}
    polys = polygons()
    bad = [(x, y, got[p]) for p, x, y in pts if got[p] != brute_force(x, y, polys)]
    assert not bad, bad[:5]


def test_many_edges_across_one_row(spark):
    """A comb of 600 upright teeth: all edges span the same heights, so only splitting by x shortens the lists."""
    import numpy as np
    teeth = [[4 * i / 300 + off, y] for i in range(300) for off, y in ((0.0, 0.1), (0.003, 1.0), (0.006, 1.0), (0.009, 0.1))]
    feats = [("Comb", 1, "Polygon", [[[0, 0], *teeth, [4, 0], [0, 0]]])]
    index = PolygonIndex(geojson_edges(geojson_text_frame(spark, geojson(feats))), cells_per_side=16)
    assert index.summary()["longest_list"] <= 64
    rng = np.random.default_rng(4)
    xs, ys = rng.uniform(-0.1, 4.1, 4000), rng.uniform(-0.05, 1.05, 4000)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(xs, ys))], "pid long, x double, y double")
    got = {r.pid: r.borough_name for r in index.locate(df, "x", "y").collect()}
    want = numpy_located(xs, ys, polygons(feats))
    assert [got[i] for i in range(len(xs))] == list(want)
