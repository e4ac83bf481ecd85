"""Folders of shapefiles: records, attributes, encodings, import, ingest."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import shapes
from conftest import plan_of
from geolayers import LayerError, bbox_filter, import_layers, ingest_shapefiles, layer_catalog, read_layer, read_shapefile, to_wkt

WGS84 = 'GEOGCS["WGS 84",DATUM["D",SPHEROID["S",6378137,298.25,AUTHORITY["EPSG","7030"]]],AUTH["EPSG",4326]]'
PEOPLE = [("name", "C", 50, 0), ("age", "N", 4, 0), ("height", "N", 12, 6), ("birthdate", "D", 8, 0)]
LAUNDER = [("2ame", "C", 50, 0), ("age", "N", 4, 0), ("Height", "N", 12, 6), ("b-rthdate", "D", 8, 0)]
ROWS = [("Peter", 45, "5.600000", "19650412"), ("Paul", 33, "5.840000", "19710325")]
POINTS = [
    "0101000000c00497d1162cb93f8cbaef08a080e63f",
    "010100000054e943acd697e2bfc0895ee54a46cf3f",
]


def content(wkb_hex):
    import struct

    return shapes.point(*struct.unpack("<2d", bytes.fromhex(wkb_hex)[5:]))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    records = [content(p) for p in POINTS]
    shapes.write(root, "two_points", 1, records, PEOPLE, ROWS, prj=WGS84)
    shapes.write(root, "2people", 1, records, LAUNDER, ROWS)
    shapes.write(root, "latin", 1, records, [("name", "C", 20, 0)], [("Peter",), ("Pàul",)])
    shapes.write(root, "natural", 0, [shapes.null()] * 2, [("id", "N", 10, 2), ("natural", "C", 10, 0)], [("1.00", "wood"), ("2.00", "land")])
    return root


def test_point_layer(spark, folder):
    df = read_shapefile(spark, str(folder), "two_points")
    assert df.schema["geom"].metadata == {"geometry": {"kind": "Point", "srid": 4326}}
    rows = df.orderBy("fid").collect()
    assert [r["geom"].hex() for r in rows] == POINTS
    assert [tuple(r)[3:] for r in rows] == [
        ("Peter", 45, 5.6, dt.date(1965, 4, 12)),
        ("Paul", 33, 5.84, dt.date(1971, 3, 25)),
    ]
    assert [r["fid"] for r in rows] == [0, 1]


def test_attribute_and_box_filter(spark, folder):
    df = read_shapefile(spark, str(folder), "two_points")
    found = bbox_filter(df, (0, 0, 1, 1)).filter("height < 5.7")
    assert [r["name"] for r in found.collect()] == ["Peter"]


def test_latin1_text(spark, folder):
    for encoding in (None, "LATIN1", "ISO-8859-1", "WIN1252"):
        rows = read_shapefile(spark, str(folder), "latin", encoding).filter("fid = 1").collect()
        assert rows[0]["name"] == "Pàul"


def test_catalog_and_import(spark, folder):
    catalog = layer_catalog(spark, str(folder), limit_to=["n2people"]).orderBy("ordinal").collect()
    assert [(r["column_name"], r["data_type"], r["column_option"]) for r in catalog] == [
        ("fid", "bigint", None),
        ("geom", "Geometry(Point)", None),
        ("n2ame", "varchar(50)", "2ame"),
        ("age", "integer", None),
        ("height", "double precision", None),
        ("b_rthdate", "date", "b-rthdate"),
    ]
    assert import_layers(spark, str(folder), limit_to=["n2people"]) == 1
    row = spark.sql("select n2ame, age, height, b_rthdate, geom from n2people where fid = 0").first()
    assert tuple(row)[:4] == ("Peter", 45, 5.6, dt.date(1965, 4, 12)) and row["geom"].hex() == POINTS[0]


def test_geometry_type_carries_srid(spark, folder):
    rows = layer_catalog(spark, str(folder), prefix="two_").filter("column_name = 'geom'").collect()
    assert [r["data_type"] for r in rows] == ["Geometry(Point,4326)"]


def test_reserved_word_without_geometry(spark, folder):
    columns = layer_catalog(spark, str(folder), limit_to=["natural"]).orderBy("ordinal").collect()
    assert [(r["column_name"], r["data_type"]) for r in columns] == [
        ("fid", "bigint"),
        ("id", "double precision"),
        ("natural", "varchar(10)"),
    ]
    assert import_layers(spark, str(folder), limit_to=["natural"]) == 1
    assert [r[0] for r in spark.sql("select `natural` from `natural` order by fid").collect()] == ["wood", "land"]


def test_import_all_counts(spark, folder):
    assert import_layers(spark, str(folder)) == 4
    assert import_layers(spark, str(folder), except_=["latin", "natural"]) == 2
    with pytest.raises(TypeError):
        import_layers(spark, str(folder), unknown_option=True)


def test_record_ranges_keep_ids_and_skip_deleted(spark, tmp_path):
    n = 997
    records = [shapes.point(i, -i) for i in range(n)]
    rows = [(i if i % 5 else None, f"n{i}" if i % 3 else "", "T" if i % 2 else "N") for i in range(n)]
    fields = [("num", "N", 12, 0), ("label", "C", 8, 0), ("flag", "L", 1, 0)]
    shapes.write(tmp_path, "many", 1, records, fields, rows, deleted={3, 500})
    df = read_shapefile(spark, str(tmp_path), "many", records_per_task=100)
    assert df.rdd.getNumPartitions() == 10
    got = {r["fid"]: r for r in df.collect()}
    assert sorted(got) == [i for i in range(n) if i not in (3, 500)]
    for i, r in got.items():
        assert (r["geom_bbox"]["xmin"], r["geom_bbox"]["ymax"]) == (i, -i)
        assert (r["num"], r["label"], r["flag"]) == (i if i % 5 else None, f"n{i}" if i % 3 else None, bool(i % 2))


def test_kinds_of_geometry(spark, tmp_path):
    square = lambda x, y, s: [(x, y), (x, y + s), (x + s, y + s), (x + s, y), (x, y)]  # clockwise
    hole = square(2, 2, 1)[::-1]
    records = [
        shapes.parts(5, [square(0, 0, 10), hole, square(20, 0, 1)]),
        shapes.parts(5, [square(0, 0, 10), hole]),
        shapes.null(),
    ]
    shapes.write(tmp_path, "poly", 5, records, [("name", "C", 5, 0)], [("multi",), ("one",), ("none",)])
    lines = [shapes.parts(3, [[(0, 0), (1, 1)]]), shapes.parts(3, [[(0, 0), (1, 1)], [(5, 5), (6, 7)]])]
    shapes.write(tmp_path, "line", 3, lines, [("id", "N", 3, 0)], [(1,), (2,)])
    shapes.write(tmp_path, "multi", 8, [shapes.multipoint([(1, 2), (3, 4)])], [("id", "N", 3, 0)], [(1,)])
    shapes.write(tmp_path, "high", 11, [shapes.point_z(1, 2, 3), shapes.point_z(1, 2, 3, 4)], [("id", "N", 3, 0)], [(1,), (2,)])

    def texts(layer):
        df = read_shapefile(spark, str(tmp_path), layer).orderBy("fid")
        return [r[0] for r in df.select(to_wkt(F.col("geom"))).collect()]

    ring = "(0 0,0 10,10 10,10 0,0 0),(2 2,3 2,3 3,2 3,2 2)"
    assert texts("poly") == [f"MULTIPOLYGON(({ring}),((20 0,20 1,21 1,21 0,20 0)))", f"POLYGON({ring})", None]
    assert texts("line") == ["LINESTRING(0 0,1 1)", "MULTILINESTRING((0 0,1 1),(5 5,6 7))"]
    assert texts("multi") == ["MULTIPOINT((1 2),(3 4))"]
    assert texts("high") == ["POINT Z (1 2 3)", "POINT ZM (1 2 3 4)"]


def test_length_of_two_polygons(spark, tmp_path):
    ring = lambda x, n: [(x, 0)] + [(x + i, 9 + i % 2) for i in range(n - 2)] + [(x, 0)]
    shapes.write(tmp_path, "poly", 5, [shapes.parts(5, [ring(0, 9), ring(50, 8)])], [("name", "C", 5, 0)], [("Three",)])
    df = read_shapefile(spark, str(tmp_path), "poly").filter("name = 'Three'")
    assert df.select(F.octet_length("geom")).first()[0] == 307


def test_ingest_stores_prunable_layers(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    assert ingest_shapefiles(spark, str(folder), out) == ["2people", "latin", "natural", "two_points"]
    stored = read_layer(spark, out, "two_points")
    assert stored.schema["geom"].metadata["geometry"]["srid"] == 4326
    found = bbox_filter(stored, (0, 0, 1, 1)).filter("height < 5.7").select("name")
    assert [r["name"] for r in found.collect()] == ["Peter"]
    plan = plan_of(found)
    assert "LessThanOrEqual(geom_bbox.xmin,1.0)" in plan and "geom:binary" not in plan


def test_table_without_geometry_file(spark, tmp_path):
    shapes.write(tmp_path, "table", None, [], [("id", "N", 5, 0)], [(1,), (2,)])
    assert [tuple(r) for r in read_shapefile(spark, str(tmp_path), "table").orderBy("fid").collect()] == [(0, 1), (1, 2)]
    rows = layer_catalog(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [(r["fmt"], r["column_name"], r["data_type"]) for r in rows] == [
        ("shapefile", "fid", "bigint"), ("shapefile", "id", "integer"),
    ]


def test_unknown_layer(spark, folder):
    with pytest.raises(LayerError):
        read_shapefile(spark, str(folder), "missing")
