import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.functions import spatial
from loamline.operators import composite, polygon_index, terrain, zones


def polygon(ord_, points, name):
    return (ord_, name, [{"x": float(x), "y": float(y)} for x, y in points])


SCHEMA = "ord INT, name STRING, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame(
        [
            polygon(2, [(0, 0), (10, 0), (10, 10), (0, 10)], "square"),
            polygon(1, [(5, 5), (15, 5), (15, 15), (5, 15)], "shifted"),
            polygon(3, [(-20, -20), (-10, -20), (-15, -10)], "triangle"),
            polygon(4, [(20, 0), (30, 0), (30, 10), (20, 10)], "two parts"),
            polygon(4, [(40, 0), (50, 0), (50, 10), (40, 10)], "two parts"),
        ],
        SCHEMA,
    )


def points(spark, places):
    return spark.createDataFrame([(i, float(y), float(x)) for i, (x, y) in enumerate(places)], "point_id INT, lat DOUBLE, lon DOUBLE")


def test_first_polygon_wins(spark, shapes):
    places = [(1, 1), (7, 7), (12, 12), (-15, -15), (-11, -11), (45, 5), (60, 60)]
    found = zones.pip_first(points(spark, places), shapes, ["name"])
    got = {r["point_id"]: r["name"] for r in found.collect()}
    assert got == {0: "square", 1: "shifted", 2: "shifted", 3: "triangle", 4: None, 5: "two parts", 6: None}


def test_shared_edges_count_once(spark):
    tiles = spark.createDataFrame(
        [polygon(10 * i + j, [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)], f"{i}{j}") for i in range(3) for j in range(3)],
        SCHEMA,
    )
    places = [(x / 2, y / 2) for x in range(1, 6) for y in range(1, 6)]
    hits = zones.candidates(points(spark, places), tiles, 1.0).where("inside").groupBy("point_id").count()
    assert hits.count() == len(places) and hits.where("count <> 1").count() == 0


def test_union_of_polygons(spark, shapes):
    got = {r["point_id"]: r["inside"] for r in zones.inside_any(points(spark, [(1, 1), (99, 9)]), shapes).collect()}
    assert got == {0: True, 1: False}


def test_holes_and_islands(spark):
    def square(low, high):
        return [(low, low), (high, low), (high, high), (low, high)]

    rings = [polygon(1, square(0, 12), "donut"), polygon(1, square(2, 10), "donut"),
             polygon(1, square(5, 7), "donut"), polygon(2, square(2, 10), "filling")]
    shapes = spark.createDataFrame(rings, SCHEMA)
    found = zones.pip_first(points(spark, [(1, 1), (3, 3), (6, 6), (13, 1)]), shapes, ["name"])
    assert {r["point_id"]: r["name"] for r in found.collect()} == {0: "donut", 1: "filling", 2: "donut", 3: None}
    hole = zones.inside_any(points(spark, [(1, 1), (3, 3)]), shapes.where("ord = 1"))
    assert {r["point_id"]: r["inside"] for r in hole.collect()} == {0: True, 1: False}


def test_projection(spark):
    df = spark.createDataFrame([(0.0, 0.0), (180.0, 89.9), (-98.2, 26.3), (-0.001, -0.001)], "lon DOUBLE, lat DOUBLE")
    x, y = spatial.web_mercator(F.col("lon"), F.col("lat"))
    rows = df.select(x, y, spatial.pixel_id(x), spatial.pixel_id(y)).collect()
    assert rows[0][0] == 0 and rows[0][1] == pytest.approx(0, abs=1e-8)
    assert rows[1][0] == pytest.approx(20037508.342789, abs=1e-5) and rows[1][1] == pytest.approx(20037508.34, abs=0.01)
    assert rows[2][1] == pytest.approx(6378137 * math.log(math.tan(math.pi / 4 + math.radians(26.3) / 2)))
    assert rows[3][2:] == (-1, -1)


def test_slope_across_block_borders(spark, monkeypatch):
    monkeypatch.setattr(terrain, "BLOCK", 4)
    rng = np.random.default_rng(0)
    grid = rng.normal(100, 20, (11, 9))
    rows = [(r, c, float(grid[r, c])) for r in range(11) for c in range(9) if (r, c) != (6, 6)]
    rows.append((6, 6, None))
    df = spark.createDataFrame(rows, "row INT, col INT, elv DOUBLE")
    got = {(r["row"], r["col"]): r for r in terrain.slope_aspect(df, cell_size=10.0).collect()}
    assert len(got) == 99
    grid[6, 6] = np.nan
    for (r, c), row in got.items():
        near = [grid[r, c], *(grid[a, b] if 0 <= a < 11 and 0 <= b < 9 else np.nan for a, b in ((r, c + 1), (r, c - 1), (r - 1, c), (r + 1, c)))]
        if np.isnan(near).any():
            assert row["slope"] is None and row["aspect"] is None
            continue
        east, north = (near[1] - near[2]) / 20, (near[3] - near[4]) / 20
        assert row["slope"] == pytest.approx(math.degrees(math.atan(math.hypot(east, north))))
        assert row["aspect"] == pytest.approx(math.degrees(math.atan2(-east, -north)) % 360)


def test_flat_ground_and_downhill_east(spark):
    flat = [(r, c, 5.0) for r in range(3) for c in range(3)]
    east = [(r, c, -1.0 * c) for r in range(3) for c in range(3)]
    for rows, slope, aspect in ((flat, 0.0, 0.0), (east, 45.0, 90.0)):
        df = spark.createDataFrame(rows, "row INT, col INT, elv DOUBLE")
        got = terrain.slope_aspect(df, cell_size=1.0).where("row = 1 AND col = 1").first()
        assert (got["slope"], got["aspect"]) == (pytest.approx(slope), pytest.approx(aspect))


def test_asof_falls_back_to_the_first_release(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(y, 5, 1),) for y in (1999, 2001, 2007, 2018, 2030)], "cutoff DATE")
    got = [r["release_year"] for r in zones.asof_release(df, [2001, 2006, 2011, 2016, 2019]).collect()]
    assert got == [2001, 2001, 2006, 2016, 2019]


def test_mosaic_takes_the_last_valid(spark):
    rows = [(1, 10, 1), (1, None, 2), (2, None, 1)]
    df = spark.createDataFrame(rows, "cell INT, v INT, p INT")
    assert {r["cell"]: r["v"] for r in composite.mosaic(df, "cell", "v", "p").collect()} == {1: 10, 2: None}


def test_sampling_keeps_every_point(spark):
    pts = spark.createDataFrame([(1, 1), (2, 9)], "point_id INT, cell_id INT")
    stack = spark.createDataFrame([(1, 2.5)], "cell_id INT, v DOUBLE")
    got = {r["point_id"]: r["v"] for r in zones.sample_cells(pts, stack, -9999.0).collect()}
    assert got == {1: 2.5, 2: -9999.0}


def test_slope_beside_negative_block_border(spark):
    cells = [(r, c, float(r * r + c)) for r in range(-3, 2) for c in range(-3, 2)]
    df = spark.createDataFrame(cells, "row INT, col INT, elv DOUBLE")
    got = terrain.slope_aspect(df, cell_size=10.0).where("row BETWEEN -2 AND 0 AND col BETWEEN -2 AND 0").collect()
    assert len(got) == 9 and all(r["slope"] is not None for r in got)


def even_odd(x, y, rings):
    """The plain test over all edges."""
    count = np.zeros(len(x), int)
    for ring in rings:
        a, b = np.asarray(ring), np.roll(np.asarray(ring), -1, axis=0)
        for (x1, y1), (x2, y2) in zip(a, b):
            if y1 != y2:
                straddles = (y1 <= y) != (y2 <= y)
                count += straddles & (x < x1 + (y - y1) * (x2 - x1) / (y2 - y1))
    return count % 2 == 1


def star(rng, n, centre, low, high):
    angle = np.sort(rng.uniform(0, 2 * np.pi, n))
    radius = rng.uniform(low, high, n)
    return np.round(np.column_stack([centre[0] + radius * np.cos(angle), centre[1] + radius * np.sin(angle)]), 3)


@pytest.mark.parametrize("most", [4, 48, 10**6])
def test_leaves_equal_the_plain_test(spark, monkeypatch, most):
    """Parts, holes and islands across many leaf borders; points on vertices, borders and edges."""
    rng = np.random.default_rng(21)
    shapes = {
        1: [star(rng, 300, (0, 0), 5, 9), star(rng, 60, (0, 0), 1, 3), star(rng, 20, (0, 0), 0.3, 0.9)],
        2: [star(rng, 40, (6, -7), 2, 4)],
        3: [np.array([(-8.0, -8), (8, -8), (8, 8), (-8, 8)]), np.array([(-4.0, -4), (4, -4), (4, 4), (-4, 4)])],
    }
    rows = [polygon(o, ring.tolist(), f"p{o}") for o, rings in shapes.items() for ring in rings]
    places = [*rng.uniform(-12, 12, (800, 2)).tolist(), *np.concatenate([r for v in shapes.values() for r in v]).tolist()]
    places += [(i / 2, j / 2) for i in range(-20, 21) for j in range(-20, 21)]
    x, y = np.array(places).T
    monkeypatch.setattr(polygon_index.polygon_index, "__defaults__", (4.0, most))
    hits = zones.candidates(points(spark, places), spark.createDataFrame(rows, SCHEMA)).where("inside")
    got = {(r["point_id"], r["ord"]) for r in hits.select("point_id", "ord").collect()}
    want = {(i, o) for o, rings in shapes.items() for i in np.flatnonzero(even_odd(x, y, rings))}
    assert got == want


def test_point_of_a_large_polygon_meets_few_edges(spark):
    """100,000 edges: a leaf holds tens of them, and so does a point's test."""
    n = 100_000
    angle = np.arange(n) * 2 * np.pi / n
    radius = 30 + np.sin(50 * angle) + 0.02 * np.sin(9000 * angle)
    ring = np.column_stack([radius * np.cos(angle) - 100, radius * np.sin(angle) + 10])
    shapes = spark.createDataFrame([polygon(1, ring.tolist(), "coast")], SCHEMA)
    index = polygon_index.polygon_index(shapes)
    rng = np.random.default_rng(3)
    places = rng.uniform(-135, -65, (400, 2)) * [1, 0] + rng.uniform(-25, 45, (400, 2)) * [0, 1]
    keyed = index.keyed(points(spark, places.tolist())).join(index.leaves, polygon_index.KEY)
    assert keyed.agg(F.max(F.size("__edges"))).first()[0] <= polygon_index.EDGES
    assert keyed.groupBy("point_id").count().where("count > 1").count() == 0
    got = {r["point_id"]: r["inside"] for r in zones.inside_any(points(spark, places.tolist()), shapes).collect()}
    x, y = places.T
    off = np.hypot(x + 100, y - 10) - (30 + np.sin(50 * np.arctan2(y - 10, x + 100)))
    clear = np.abs(off) > 0.1
    assert clear.sum() > 380 and all(got[i] == (off[i] < 0) for i in np.flatnonzero(clear))


def test_points_without_a_place(spark, shapes):
    odd = spark.createDataFrame(
        [(1, None, 1.0), (2, 1.0, None), (3, float("nan"), 1.0), (4, 1.0, 1.0)], "point_id INT, lat DOUBLE, lon DOUBLE"
    )
    assert {r["point_id"]: r["name"] for r in zones.pip_first(odd, shapes, ["name"]).collect()} == {1: None, 2: None, 3: None, 4: "square"}
    assert zones.pip_first(odd, shapes.limit(0), ["name"]).where("name is not null").count() == 0
