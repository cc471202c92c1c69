from __future__ import annotations

import math
import random

import pytest

from statewatt import operators as op
from statewatt.operators import geo

SHAPE = "array<array<array<struct<x: double, y: double>>>>"


def ring(*points):
    return [(float(x), float(y)) for x, y in points]


def box(x, y, w, h):
    return ring((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))


@pytest.fixture
def lands(spark):
    data = [
        (0, "square", [[box(0, 0, 4, 4)]]),
        (1, "ringed", [[box(10, 0, 8, 8), box(12, 2, 3, 3)]]),
        (2, "islands", [[box(20, 0, 2, 2)], [box(24, 0, 2, 2)]]),
        (3, "overlap", [[box(2, 2, 4, 4)]]),
        (4, "open ring", [[ring((30, 0), (34, 0), (34, 4), (30, 4))]]),
        (5, None, [[box(40, 0, 2, 2)]]),
    ]
    return spark.createDataFrame(data, f"ordinal long, NAME string, shape {SHAPE}")


@pytest.mark.parametrize("edges", [0, 3, 16])
def test_strictly_within(spark, lands, edges, rows, monkeypatch):
    monkeypatch.setattr(geo, "CELL_EDGES", edges)
    points = spark.createDataFrame(
        [
            ("inside", 1.0, 1.0),
            ("both", 3.0, 3.0),
            ("edge", 0.0, 1.0),
            ("vertex", 4.0, 4.0),  # a corner of one, inside the other
            ("hole", 13.0, 3.0),
            ("hole edge", 12.0, 3.0),
            ("beside hole", 11.0, 3.0),
            ("first island", 21.0, 1.0),
            ("between", 23.0, 1.0),
            ("second island", 25.0, 1.0),
            ("open", 33.0, 3.0),
            ("nameless", 41.0, 1.0),
            ("outside", -1.0, 1.0),
            ("nowhere", None, 1.0),
            ("half placed", 1.0, None),
        ],
        "id string, lon double, lat double",
    )
    got = rows(op.spatial_join(points, lands, "lon", "lat", "shape", ["ordinal", "NAME"]), "id", "ordinal")
    assert len(got) == 16
    assert set(got) == (
        {
            ("inside", 0),
            ("both", 0),
            ("both", 3),
            ("edge", None),
            ("vertex", 3),
            ("hole", None),
            ("hole edge", None),
            ("beside hole", 1),
            ("first island", 2),
            ("between", None),
            ("second island", 2),
            ("open", 4),
            ("nameless", 5),
            ("outside", None),
            ("nowhere", None),
            ("half placed", None),
        }
    )
    inner = op.spatial_join(points, lands, "lon", "lat", "shape", ["ordinal"], how="inner")
    assert inner.count() == 9


def winding_inside(rings, x, y):
    """Even-odd test by crossing count, written independently."""
    odd = False
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


@pytest.mark.parametrize("small", ["10MB", "-1"])
def test_random_polygons_agree_with_a_plain_scan(spark, small, rows, request, monkeypatch):
    """With an index that may be sent to the points, and with one that may not."""
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    rnd = random.Random(5)
    polys = []
    for i in range(25):
        cx, cy, n = rnd.uniform(-20, 20), rnd.uniform(-10, 10), rnd.randint(3, 40)
        polys.append((i, [[[(cx + r * math.cos(a), cy + r * math.sin(a)) for a, r in ((2 * math.pi * k / n, rnd.uniform(0.3, 9)) for k in range(n))]]]))
    # a third of the points crowd into one cell
    pts = [(i, *((0.2 + rnd.random() / 10, 0.3 + rnd.random() / 10) if i % 3 == 0 else (rnd.uniform(-30, 30), rnd.uniform(-20, 20)))) for i in range(900)]
    expected = sorted((i, p) for i, x, y in pts for p, shape in polys if winding_inside(shape[0], x, y))
    points = spark.createDataFrame(pts, "id long, lon double, lat double")
    lands = spark.createDataFrame(polys, f"land long, shape {SHAPE}")
    for edges in (2, 16):
        monkeypatch.setattr(geo, "CELL_EDGES", edges)
        joined = op.spatial_join(points, lands, "lon", "lat", "shape", ["land"])
        assert rows(joined.filter("land IS NOT NULL"), "id", "land") == expected
        assert joined.filter("land IS NULL").count() == len({i for i, _, _ in pts} - {i for i, _ in expected})
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_inner_cells_carry_no_edges_and_outer_cells_vanish(spark, monkeypatch):
    monkeypatch.setattr(geo, "CELL_EDGES", 0)
    wide = spark.createDataFrame([(1, [[box(0, 0, 40, 40), box(10, 10, 20, 20)]])], f"land long, shape {SHAPE}")
    cells = op.polygon_cells(wide, "shape", ["land"]).collect()
    for r in cells:
        w = 4.0**r._level
        a, b, c, d = r._cx * w, (r._cx + 1) * w, r._cy * w, (r._cy + 1) * w
        middle = winding_inside([box(0, 0, 40, 40), box(10, 10, 20, 20)], (a + b) / 2, (c + d) / 2)
        # a cell without edges is inside; the hole and the world around hold none
        assert middle if not r._edges else all(min(e.x1, e.x2) <= b and max(e.x1, e.x2) >= a for e in r._edges)
    assert sum(not r._edges for r in cells) > 0 and len({r._level for r in cells}) > 1


def test_cells_follow_the_outline_not_the_area(spark, rows):
    """A country next to a parcel: the country's cells are wide, the parcel's small."""
    n = 2_000
    coast = [(10 + (5 + math.sin(40 * a) / 9) * math.cos(a), 50 + (5 + math.sin(40 * a) / 9) * math.sin(a)) for a in (2 * math.pi * k / n for k in range(n))]
    parcel = box(10.00001, 50.00001, 0.00002, 0.00001)
    data = [("world", [[box(-180, -90, 360, 180)]]), ("country", [[coast]]), ("parcel", [[parcel]])]
    lands = spark.createDataFrame(data, f"name string, shape {SHAPE}")
    cells = op.polygon_cells(lands, "shape", ["name"])
    counts = {r["name"]: r["count"] for r in cells.groupBy("name").count().collect()}
    assert counts["world"] < 1000 and counts["parcel"] <= 9 and counts["country"] < n
    assert cells.selectExpr("max(size(_edges))").first()[0] <= 2 * geo.CELL_EDGES
    rnd = random.Random(4)
    spots = [(10.00001 + rnd.uniform(-1, 3) * 1e-5, 50.00001 + rnd.uniform(-1, 2) * 1e-5) for _ in range(100)]
    spots += [(10 + 5.05 * math.cos(a) + rnd.uniform(-0.1, 0.1), 50 + 5.05 * math.sin(a) + rnd.uniform(-0.1, 0.1)) for a in (rnd.uniform(0, 7) for _ in range(300))]
    spots += [(rnd.uniform(-200, 200), rnd.uniform(-100, 100)) for _ in range(100)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "id long, lon double, lat double")
    got = rows(op.spatial_join(points, lands, "lon", "lat", "shape", ["name"], how="inner"), "id", "name")
    assert got == sorted((i, name) for i, (x, y) in enumerate(spots) for name, shape in data if winding_inside(shape[0], x, y))


def test_points_on_cell_borders_and_vertices(spark, rows):
    """Integer shapes and points: ways run through vertices and along edges."""
    rnd = random.Random(8)
    polys = []
    for i in range(40):
        ring_ = [(float(rnd.randrange(0, 33)), float(rnd.randrange(0, 33))) for _ in range(rnd.randrange(3, 40))]
        polys.append((i, [[ring_]]))
    spots = [(x, y) for x in range(0, 33, 2) for y in range(0, 33, 3)] + [(x + 0.25, y + 0.5) for x in range(0, 33, 3) for y in range(0, 33, 4)]
    points = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(spots)], "id long, lon double, lat double")

    def on_edge(r, x, y):
        return any((b - a) * (y - c) == (x - a) * (d - c) and min(a, b) <= x <= max(a, b) and min(c, d) <= y <= max(c, d) for (a, c), (b, d) in zip(r, r[1:] + r[:1]))

    want = sorted((k, i) for k, (x, y) in enumerate(spots) for i, shape in polys if winding_inside(shape[0], x, y) and not on_edge(shape[0][0], x, y))
    got = rows(op.spatial_join(points, spark.createDataFrame(polys, f"land long, shape {SHAPE}"), "lon", "lat", "shape", ["land"], how="inner"), "id", "land")
    assert got == want and len(want) > 1000


def test_projection_round_trip(spark):
    lon, lat = -97.5, 35.25
    x = math.radians(lon) * geo.EARTH_RADIUS_M
    y = math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) * geo.EARTH_RADIUS_M
    df = spark.createDataFrame([(x, y, [[[(x, y)]]])], f"lon double, lat double, shape {SHAPE}")
    r = op.normalise_crs(df, 3857, "lon", "lat", "shape").first()
    assert math.isclose(r.lon, lon) and math.isclose(r.lat, lat)
    assert math.isclose(r.shape[0][0][0].x, lon) and math.isclose(r.shape[0][0][0].y, lat)
    assert op.normalise_crs(df, 4326) is df
    with pytest.raises(ValueError):
        op.normalise_crs(df, 2163)


def test_rollup_drops_unknown_keys_and_counts_known_ids(spark, rows):
    df = spark.createDataFrame([("A", "TX", "1", 10.9), ("A", "TX", None, 5.5), ("B", None, "2", 1.0), ("C", "OK", "3", None)], "NAME string, STATE string, id string, sqft double")
    assert rows(op.territory_rollup(df, ["NAME", "STATE"], "id", "sqft")) == [("A", "TX", 1, 16), ("C", "OK", 1, 0)]
