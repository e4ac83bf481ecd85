"""Nothing of a source is left out: headers, part files, ranges, names, empty sides."""

import codecs
import os
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import shapes
from conftest import plan_of
from geolayers import LayerError, bbox_filter, bbox_join, import_layers, layer_catalog, line_wkb, make_box, read_layer, read_shapefile
from geolayers.functions.text import charset
from geolayers.functions.values import coerce_write
from geolayers.operators.spatial import encode_boxes
from geolayers.session import drop_staged, shared_path
from geolayers.sources.catalog import list_layers
from geolayers.sources.fids import file_fids, lookup_fids
from geolayers.sources.layers import write_layer
from geolayers.sources.shapefile import srid_of_wkt
from pyspark.sql import types as T


def columns(catalog):
    return [r["column_name"] for r in catalog.orderBy("layer", "ordinal").collect()]


def test_long_csv_header(spark, tmp_path):
    names = [f"column_number_{i:06d}_of_a_wide_table" for i in range(40_000)]
    (tmp_path / "wide.csv").write_text(",".join(names) + "\n")
    assert columns(layer_catalog(spark, str(tmp_path))) == ["fid", *names]


def test_csv_header_over_a_line_break(spark, tmp_path):
    (tmp_path / "broken.csv").write_text('a,"b\nc",d\n1,2,3\n')
    with pytest.raises(PySparkException, match="multiLine"):
        layer_catalog(spark, str(tmp_path)).collect()
    options = {"multiLine": "true"}
    assert columns(layer_catalog(spark, str(tmp_path), options=options, launder_column_names=False)) == ["fid", "a", "b\nc", "d"]
    assert import_layers(spark, str(tmp_path), options=options) == 1
    assert tuple(spark.table("broken").first())[1:] == ("1", "2", "3")


def test_csv_encodings_and_separators(spark, tmp_path):
    (tmp_path / "wide.csv").write_bytes(codecs.BOM_UTF16_LE + "name;wert\nä;1\n".encode("utf-16-le"))
    catalog = layer_catalog(spark, str(tmp_path), encoding="UTF-16", options={"sep": ";"})
    assert columns(catalog) == ["fid", "name", "wert"]
    (tmp_path / "wide.csv").write_text("name;wert\nä;1\nb;2\n")
    assert import_layers(spark, str(tmp_path), options={"sep": ";"}) == 1
    rows = spark.table("wide").orderBy("fid").collect()
    assert [tuple(r) for r in rows] == [(1, "ä", "1"), (2, "b", "2")]


def test_folders_with_partitions_and_late_columns(spark, tmp_path):
    df = spark.range(6).select(F.col("id").alias("fid"), (F.col("id") % 2).alias("part"), (F.col("id") * 2).alias("twice"))
    df.write.partitionBy("part").parquet(str(tmp_path / "split.parquet"))
    df.select("fid", "twice").coalesce(1).write.parquet(str(tmp_path / "late"))
    df.select((F.col("fid") + 6).alias("fid"), F.lit("x").alias("label")).write.mode("append").parquet(str(tmp_path / "late"))
    df.select("twice").write.option("header", "true").csv(str(tmp_path / "text.csv"))
    assert {tuple(r) for r in list_layers(spark, str(tmp_path)).collect()} == {("split", "parquet"), ("late", "parquet"), ("text", "csv")}
    found = layer_catalog(spark, str(tmp_path)).collect()
    assert {r["column_name"] for r in found if r["layer"] == "split"} == {"fid", "part", "twice"}
    assert {r["column_name"] for r in found if r["layer"] == "late"} == {"fid", "twice", "label"}
    assert import_layers(spark, str(tmp_path)) == 3
    assert spark.table("split").filter("part = 1").count() == 3
    assert spark.table("late").filter("label = 'x'").count() == 6
    assert spark.table("text").selectExpr("count(distinct fid)", "count(distinct twice)").first()[:] == (6, 6)


def points(tmp_path, name="two", n=4, **options):
    shapes.write(tmp_path, name, 1, [shapes.point(i, i) for i in range(n)], [("id", "N", 4, 0)], [(i,) for i in range(n)], **options)
    return tmp_path


def test_short_attribute_table_is_an_error(spark, tmp_path):
    points(tmp_path)
    path = tmp_path / "two.dbf"
    whole = path.read_bytes()
    path.write_bytes(whole[: -2 * 5 - 1])
    with pytest.raises((LayerError, OSError, PySparkException), match="shorter|ends"):
        read_shapefile(spark, str(tmp_path), "two").count()


def test_long_reference_text(spark, tmp_path):
    text = 'PROJCS["long",' + " " * 100_000 + 'AUTHORITY["EPSG","1"],AUTHORITY["EPSG","31467"]]'
    points(tmp_path, prj=text)
    assert read_shapefile(spark, str(tmp_path), "two").schema["geom"].metadata["geometry"]["srid"] == srid_of_wkt(text) == 31467


def test_names_in_any_case_and_geometry_alone(spark, tmp_path):
    points(tmp_path, "upper")
    for extension in ("shp", "shx", "dbf"):
        shutil.copy(tmp_path / f"upper.{extension}", tmp_path / f"COPY.{extension.upper()}")
    for extension in ("shp", "shx"):
        shutil.copy(tmp_path / f"upper.{extension}", tmp_path / f"alone.{extension}")
    os.mkdir(tmp_path / "deeper")
    points(tmp_path / "deeper", "upper", n=1)
    assert {r["layer"] for r in list_layers(spark, str(tmp_path)).collect()} == {"upper", "COPY", "alone"}
    assert read_shapefile(spark, str(tmp_path), "COPY").count() == 4
    alone = read_shapefile(spark, str(tmp_path), "alone")
    assert alone.columns == ["fid", "geom", "geom_bbox"] and alone.count() == 4
    assert read_shapefile(spark, str(tmp_path), "upper").count() == 4


def test_encodings_of_attribute_tables(spark, tmp_path):
    for name, cpg, raw in (("utf", "UTF-8", "Pàul".encode()), ("win", "ANSI 1252", "Pàul".encode("cp1252"))):
        shapes.write(tmp_path, name, 0, [shapes.null()], [("name", "C", 20, 0)], [("x",)])
        path = tmp_path / f"{name}.dbf"
        path.write_bytes(path.read_bytes().replace(b"x" + b" " * (len(raw) - 1), raw, 1))
        (tmp_path / f"{name}.cpg").write_text(cpg)
    assert read_shapefile(spark, str(tmp_path), "utf", "LATIN1").first()["name"] == "Pàul"
    assert read_shapefile(spark, str(tmp_path), "win").first()["name"] == "Pàul"
    assert charset("OEM 850").upper() == "CP850" and charset("88591").upper() == "ISO-8859-1"


def test_lines_of_unequal_lists(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0, 2.0])], "x array<double>, y array<double>")
    with pytest.raises(PySparkException, match="differ in length"):
        df.select(line_wkb(F.col("x"), F.col("y"))).collect()


def squares(spark, rows, name):
    df = spark.createDataFrame(rows, f"{name} bigint, x double, y double, w double, text_{name} string")
    return df.select(name, f"text_{name}", make_box(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("w")).alias(f"g{name}_bbox"))


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_join_with_nothing_in_common(spark, conf, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    corners = squares(spark, [(1, -100.0, -100.0, 0.0, "a"), (2, 100.0, 100.0, 0.0, "b")], "p")
    middle = squares(spark, [(i, 0.0, 0.0, 1.0, "c") for i in range(9)], "q")
    assert bbox_join(corners, middle, "gp", "gq").count() == 0
    assert bbox_join(middle.limit(0), corners, "gq", "gp").count() == 0


def test_join_on_a_cell_that_is_hot_on_both_sides(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = squares(spark, [(i, i / 1e4, 0.0, 1.0, "a") for i in range(300)], "p")
    right = squares(spark, [(i, 0.0, i / 1e4, 1.0, "b") for i in range(300)], "q")
    assert bbox_join(left, right, "gp", "gq").count() == 90_000


def test_inverted_box_is_none(spark):
    assert spark.range(1).select(make_box(170, 0, -170, 1)).first()[0] is None


def test_time_of_day_at_midnight(spark):
    df = spark.sql("select TIME '23:59:59.7' t union all select TIME '12:00:00.5' union all select cast(null as time)")
    rows = df.select(coerce_write(F.col("t"), T.TimeType(6)).cast("string")).collect()
    assert [r[0] for r in rows] == ["23:59:59", "12:00:01", None]


def test_outlier_leaves_stored_layer_prunable(spark, tmp_path):
    rows = spark.range(4000).select(
        F.col("id").alias("fid"), (F.col("id") % 63 * 1.0).alias("x"), F.floor(F.col("id") / 63).cast("double").alias("y")
    )
    rows = rows.union(spark.sql("select 99999L, 1e9D, 1e9D"))
    layer = encode_boxes(rows, "x", "y", "x", "y").drop("x", "y")
    write_layer(layer, str(tmp_path / "l.parquet"), 16)
    stored = read_layer(spark, str(tmp_path), "l")
    near = bbox_filter(stored, (0, 0, 3, 3))
    assert "PushedFilters: [" in plan_of(near) and "LessThanOrEqual(geom_bbox.xmin,3.0)" in plan_of(near)
    assert near.select("_metadata.file_path").distinct().count() <= 4
    assert bbox_filter(stored, (0.9e9, 0.9e9, 1.1e9, 1.1e9)).count() == 1


def test_ids_without_a_shuffle_of_the_layer(spark, conf, tmp_path):
    spark.range(0, 1000, 1, 8).select((F.col("id") * 3).alias("v")).write.parquet(str(tmp_path / "l.parquet"))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = spark.read.parquet(str(tmp_path / "l.parquet"))
    numbered = file_fids(df)
    assert "Exchange hashpartitioning" not in plan_of(numbered) and "BroadcastHashJoin" in plan_of(numbered)
    every = {r["fid"]: r["v"] for r in numbered.collect()}
    assert sorted(every) == list(range(1000))
    found = lookup_fids(df, [0, 500, 999, 5000])
    assert {r["fid"]: r["v"] for r in found.collect()} == {f: every[f] for f in (0, 500, 999)}
    one = lookup_fids(df, [500])
    assert one.select("fid").count() == 1 and "file_path" in plan_of(one)


def test_import_stores_nothing_and_lists_once(spark, tmp_path):
    for i in range(50):
        (tmp_path / f"layer{i:02d}.csv").write_text(f"a,b\n{i},2\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one", "")
    import_layers(spark, str(tmp_path), prefix="layer00")
    spark.sparkContext.setJobGroup("all", "")
    assert import_layers(spark, str(tmp_path)) == 50
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    few, many = (len(tracker.getJobIdsForGroup(g)) for g in ("one", "all"))
    assert 0 < many < few + 10  # the same jobs; adaptive ones may take another stage
    assert spark.table("layer07").first()[:] == (1, "7", "2")


def test_staged_folders_can_be_dropped(spark):
    path = shared_path(spark, "test")
    spark.range(3).write.parquet(path)
    assert drop_staged(spark) >= 1
    assert not os.path.exists(path.removeprefix("file:"))
