"""WKB of all kinds: envelope, kind, text, EWKB and the exact box test."""

import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from geolayers import bbox_filter, bbox_meets, common_kind, encode_points, envelope, geometry_kind, intersects_box, line_wkb, make_box, read_layer, strip_ewkb, to_wkt
from geolayers.functions import wkb
from geolayers.operators.spatial import encode_boxes


def frame(spark, values, name="geom"):
    rows = [(i, None if v is None else bytearray(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"fid bigint, {name} binary").repartition(3)


def results(df, column):
    return [r[0] for r in df.orderBy("fid").select(column).collect()]


def big_endian_point(x, y):
    return struct.pack(">BI2d", 0, 1, x, y)


RING = [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)]
HOLE = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
XY = lambda points: np.array(points, float)
W = wkb.write_geometry
CASES = [
    (W(wkb.POINT, XY([(1.5, -2)])), "Point", "POINT(1.5 -2)", (1.5, -2, 1.5, -2)),
    (big_endian_point(3, 4), "Point", "POINT(3 4)", (3, 4, 3, 4)),
    (W(wkb.POINT, XY([(1, 2, 3)]), True), "PointZ", "POINT Z (1 2 3)", (1, 2, 1, 2)),
    (W(wkb.POINT, XY([(1, 2, 3)]), False, True), "PointM", "POINT M (1 2 3)", (1, 2, 1, 2)),
    (W(wkb.POINT, XY([(1, 2, 3, 4)]), True, True), "PointZM", "POINT ZM (1 2 3 4)", (1, 2, 1, 2)),
    (W(wkb.POINT, XY([(np.nan, np.nan)])), "Point", "POINT EMPTY", None),
    (W(wkb.LINESTRING, XY([(0, 1), (2, -1)])), "LineString", "LINESTRING(0 1,2 -1)", (0, -1, 2, 1)),
    (W(wkb.LINESTRING, XY([]).reshape(0, 2)), "LineString", "LINESTRING EMPTY", None),
    (W(wkb.POLYGON, [XY(RING), XY(HOLE)]), "Polygon", "POLYGON((0 0,0 4,4 4,4 0,0 0),(1 1,2 1,2 2,1 2,1 1))", (0, 0, 4, 4)),
    (W(wkb.POLYGON, [XY(RING[:-1])]), "Polygon", "POLYGON((0 0,0 4,4 4,4 0))", (0, 0, 4, 4)),
    (
        W(wkb.MULTIPOINT, [(wkb.POINT, False, False, XY([p])) for p in [(1, 2), (3, 0)]]),
        "MultiPoint", "MULTIPOINT((1 2),(3 0))", (1, 0, 3, 2),
    ),
    (
        W(wkb.MULTILINESTRING, [(wkb.LINESTRING, False, False, XY([(0, 0), (1, 1)]))]),
        "MultiLineString", "MULTILINESTRING((0 0,1 1))", (0, 0, 1, 1),
    ),
    (
        W(wkb.MULTIPOLYGON, [(wkb.POLYGON, False, False, [XY(RING)])]),
        "MultiPolygon", "MULTIPOLYGON(((0 0,0 4,4 4,4 0,0 0)))", (0, 0, 4, 4),
    ),
    (
        W(wkb.COLLECTION, [(wkb.POINT, False, False, XY([(9, 9)])), (wkb.LINESTRING, False, False, XY([(0, 0), (1, 1)]))]),
        "GeometryCollection", "GEOMETRYCOLLECTION(POINT(9 9),LINESTRING(0 0,1 1))", (0, 0, 9, 9),
    ),
    (W(wkb.CIRCULARSTRING, XY([(-1, 0), (0, 1), (1, 0)])), "CircularString", "CIRCULARSTRING(-1 0,0 1,1 0)", (-1, 0, 1, 1)),
    (
        W(wkb.COMPOUNDCURVE, [(wkb.CIRCULARSTRING, False, False, XY([(-1, 0), (0, -1), (1, 0)])), (wkb.LINESTRING, False, False, XY([(1, 0), (1, 3)]))]),
        "CompoundCurve", "COMPOUNDCURVE(CIRCULARSTRING(-1 0,0 -1,1 0),(1 0,1 3))", (-1, -1, 1, 3),
    ),
    (
        W(wkb.CURVEPOLYGON, [(wkb.CIRCULARSTRING, False, False, XY([(0, 0), (2, 0), (0, 0)]))]),
        "CurvePolygon", "CURVEPOLYGON(CIRCULARSTRING(0 0,2 0,0 0))", (0, -1, 2, 1),
    ),
    (
        W(11, [(wkb.LINESTRING, False, False, XY([(0, 0), (1, 1)]))]),
        "MultiCurve", "MULTICURVE((0 0,1 1))", (0, 0, 1, 1),
    ),
    (
        W(12, [(wkb.POLYGON, False, False, [XY(RING)])]),
        "MultiSurface", "MULTISURFACE(((0 0,0 4,4 4,4 0,0 0)))", (0, 0, 4, 4),
    ),
    (None, None, None, None),
]


def test_all_kinds(spark):
    df = frame(spark, [c[0] for c in CASES])
    assert results(df, geometry_kind(F.col("geom"))) == [c[1] for c in CASES]
    assert results(df, to_wkt(F.col("geom"))) == [c[2] for c in CASES]
    for got, case in zip(results(df, envelope(F.col("geom"))), CASES):
        assert (got is None) == (case[3] is None), case[2]
        assert got is None or tuple(got) == pytest.approx(case[3], abs=1e-12), case[2]


def test_ewkb_kinds_and_strip(spark):
    # EWKB of two points in SRID 4326.
    stored = ["0101000020E610000000000000000000000000000000000000", "0101000020E610000000000000000059400000000000000000"]
    big = struct.pack(">BII2d", 0, 0x20000001, 4326, 5, 6)
    deep = struct.pack("<BII3d", 1, 0xA0000001, 4326, 5, 6, 7)
    df = frame(spark, [bytes.fromhex(s) for s in stored] + [big, deep, CASES[0][0], None])
    plain = df.withColumn("geom", strip_ewkb(F.col("geom")))
    assert results(df, geometry_kind(F.col("geom"))) == ["Point", "Point", "Point", "PointZ", "Point", None]
    assert results(plain, to_wkt(F.col("geom"))) == ["POINT(0 0)", "POINT(100 0)", "POINT(5 6)", "POINT Z (5 6 7)", "POINT(1.5 -2)", None]
    assert [v and len(v) for v in results(plain, "geom")] == [21, 21, 21, 29, 21, None]
    assert results(plain, "geom")[2] == big_endian_point(5, 6)


def test_unknown_kind_is_an_error(spark):
    df = frame(spark, [struct.pack("<BI", 1, 99)])
    with pytest.raises(Exception, match="no geometry has the type number 99"):
        df.select(geometry_kind(F.col("geom"))).collect()


finite = st.floats(allow_nan=False, allow_infinity=False, width=64)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(finite, finite), min_size=1, max_size=30))
def test_points_round_trip(spark, points):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "fid bigint, x double, y double")
    layer = encode_points(df, "x", "y", srid=26910)
    rows = layer.select("fid", envelope(F.col("geom")).alias("e")).orderBy("fid").collect()
    assert [(r["e"]["xmin"], r["e"]["ymin"]) for r in rows] == points
    assert layer.schema["geom"].metadata["geometry"] == {"kind": "Point", "srid": 26910}


coordinate = st.integers(-6, 6)
path = st.lists(st.tuples(coordinate, coordinate), min_size=2, max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(path, min_size=1, max_size=20))
def test_lines_meet_box_as_by_dense_points(spark, paths):
    """A segment meets the box iff some point of a fine walk along it does."""
    df = frame(spark, [W(wkb.LINESTRING, XY(p)) for p in paths])
    box = (-2, -1, 3, 2)
    got = {r["fid"] for r in intersects_box(df, box).collect()}
    steps = np.linspace(0, 1, 2521)[:, None]  # all simple fractions of small integers
    for i, p in enumerate(paths):
        walk = np.vstack([a + steps * (b - a) for a, b in zip(XY(p)[:-1], XY(p)[1:])])
        near = ((walk >= np.array(box[:2]) - 1e-9) & (walk <= np.array(box[2:]) + 1e-9)).all(axis=1).any()
        assert (i in got) == bool(near), p


def test_polygons_meet_box(spark):
    big, hole = [(-10, -10), (-10, 10), (10, 10), (10, -10), (-10, -10)], [(-5, -5), (5, -5), (5, 5), (-5, 5), (-5, -5)]
    cases = [
        (W(wkb.POLYGON, [XY(big)]), True),  # box inside the area
        (W(wkb.POLYGON, [XY(big), XY(hole)]), False),  # box inside the hole
        (W(wkb.POLYGON, [XY([(3, 0), (4, 0), (4, 1), (3, 0)])]), True),  # touches the edge
        (W(wkb.POLYGON, [XY([(3.5, 3.5), (3.5, -9), (-9, 9), (3.5, 3.5)])]), True),
        (W(wkb.POLYGON, [XY([(3, 9), (9, 9), (9, -1), (3, 9)])]), False),  # boxes meet, shapes do not
        (W(wkb.CURVEPOLYGON, [(wkb.CIRCULARSTRING, False, False, XY([(-9, 0), (9, 0), (-9, 0)]))]), True),
        (W(wkb.POINT, XY([(3, 2)])), True),
        (W(wkb.POINT, XY([(3.1, 2)])), False),
        (None, False),
    ]
    df = frame(spark, [c[0] for c in cases])
    got = {r["fid"] for r in intersects_box(df, (-2, -1, 3, 2)).collect()}
    assert got == {i for i, c in enumerate(cases) if c[1]}


def test_several_geometry_columns(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 5.0, 5.0), (2, 9.0, 9.0, 0.5, 0.5)], "fid bigint, x double, y double, u double, v double")
    layer = encode_points(encode_points(df, "x", "y"), "u", "v", name="target")
    assert [r["fid"] for r in bbox_filter(layer, (-1, -1, 1, 1)).collect()] == [1]
    assert [r["fid"] for r in bbox_filter(layer, (-1, -1, 1, 1), "target").collect()] == [2]


def test_filter_without_stored_box(spark):
    df = encode_points(spark.createDataFrame([(1, 0.0, 0.0), (2, 9.0, 9.0), (3, None, 1.0)], "fid bigint, x double, y double"), "x", "y")
    assert [r["fid"] for r in bbox_filter(df.drop("geom_bbox"), (-1, -1, 1, 1)).collect()] == [1]
    assert [r["fid"] for r in df.filter(~bbox_meets(F.col("geom_bbox"), (-1, -1, 1, 1))).collect()] == [2]


def test_nan_makes_no_box(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 2.0), (None, 2.0)], "x double, y double")
    boxes = [r[0] for r in df.select(make_box(F.col("x"), F.col("y"), F.col("x"), F.col("y"))).collect()]
    assert [b is None for b in boxes] == [False, True, True]


def test_rectangles(spark):
    df = encode_boxes(spark.createDataFrame([(1, 0.0, 1.0, 2.0, 3.0)], "fid bigint, a double, b double, c double, d double"), "a", "b", "c", "d")
    row = df.select(to_wkt(F.col("geom")).alias("t"), envelope(F.col("geom")).alias("e"), "geom_bbox").first()
    assert row["t"] == "POLYGON((0 1,0 3,2 3,2 1,0 1))" and row["e"] == row["geom_bbox"]


def test_database_geometry_column(spark, tmp_path):
    """EWKB as a database returns it, declared on reading."""
    stored = "0101000020E610000000000000000059400000000000000000"
    frame(spark, [bytes.fromhex(stored), None], "shape").write.parquet(str(tmp_path / "places.parquet"))
    df = read_layer(spark, str(tmp_path), "places", "fid bigint, shape binary", geometry=["shape"], srid=4326)
    assert df.schema["shape"].metadata["geometry"]["srid"] == 4326
    rows = bbox_filter(df, (99, -1, 101, 1), "shape").select("fid", to_wkt(F.col("shape"))).collect()
    assert [tuple(r) for r in rows] == [(0, "POINT(100 0)")]


def test_common_kind(spark):
    def kind(values):
        return common_kind(frame(spark, values)).first()["kind"]

    assert kind([c[0] for c in CASES]) == "Geometry"
    assert kind([CASES[2][0], None]) == "PointZ"
    assert kind([None]) == "Geometry"


def test_lines_from_arrays(spark):
    rows = [(0, [0.0, 1.0], [2.0, 3.0]), (1, None, [1.0]), (2, [], []), (3, [1.0, 2.0, 3.0], [4.0, 5.0, 6.0]), (4, [9.0, 8.0], [7.0, 6.0])]
    df = spark.createDataFrame(rows, "fid bigint, xs array<double>, ys array<double>").coalesce(1)
    df = df.filter("fid >= 0").select("fid", line_wkb(F.col("xs"), F.col("ys")).alias("geom"))
    assert results(df, to_wkt(F.col("geom"))) == [
        "LINESTRING(0 2,1 3)", None, "LINESTRING EMPTY", "LINESTRING(1 4,2 5,3 6)", "LINESTRING(9 7,8 6)",
    ]
