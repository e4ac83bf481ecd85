"""Column matching, types, ids, changes, names, encodings and plans."""

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from conftest import plan_of
from geolayers import (
    Field,
    LayerError,
    as_layer,
    assign_fid,
    bbox_filter,
    delete,
    delete_where,
    encode_points,
    insert,
    launder,
    launder_name,
    layer_catalog,
    layer_count,
    read_layer,
    transcode,
    update,
    update_where,
    write_layer,
)
from geolayers.functions.values import coerce_read, coerce_write
from geolayers.model import READABLE_AS, STORED_AS, check_storable, source_type
from geolayers.plans.layers import points
from geolayers.sources.catalog import columns_of, import_layers
from geolayers.sources.layers import srid_of

SF = "/root/testdata/sf0.001"


# --- names ---------------------------------------------------------------------


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\0"), max_size=80), min_size=1, max_size=30))
def test_launder_column_equals_launder_name(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for row in df.select("name", launder(F.col("name")).alias("clean")).collect():
        assert row["clean"] == launder_name(row["name"])
        assert re.fullmatch("[a-z0-9_]*", row["clean"]) and not re.match("[0-9]", row["clean"])
        assert len(row["clean"]) <= 63


def test_launder_examples():
    names = ["Pàul", "2ame", "person's value", "Height", "b-rthdate", "9" * 80]
    assert [launder_name(n) for n in names] == ["p__ul", "n2ame", "person_s_value", "height", "b_rthdate", "n" + "9" * 62]


# --- matching -------------------------------------------------------------------


def test_unknown_layer(spark):
    with pytest.raises(LayerError, match="unable to find layer"):
        read_layer(spark, SF, "nothing")


def test_layer_names_are_literal(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "odd [x] *1.parquet"))
    assert read_layer(spark, str(tmp_path), "odd [x] *1").count() == 3
    with pytest.raises(LayerError):
        read_layer(spark, str(tmp_path), "odd*")


def test_fid_rules(spark):
    df = spark.createDataFrame([(7, "a", "x")], "fid bigint, name string, other string")
    assert as_layer(df, "FID int, name string").first()["FID"] == 7
    with pytest.raises(LayerError, match="more than one fid"):
        as_layer(df, [Field("fid", T.LongType()), Field("FID", T.IntegerType())])
    text = as_layer(df.withColumnRenamed("fid", "id"), "fid string, name string").first()
    assert text["fid"] is None  # not an integer: an ordinary field, here unmatched


def test_geometries_bind_by_position(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0)], "fid bigint, x double, y double")
    layer = encode_points(encode_points(df, "x", "y"), "y", "x", name="target").withColumn("raw", F.lit(b"z"))
    read = as_layer(layer, "fid bigint, one binary, two binary, raw binary")
    assert read.columns == ["fid", "one", "one_bbox", "two", "two_bbox", "raw"]
    row = read.first()
    assert (row["one_bbox"]["ymin"], row["two_bbox"]["ymin"], bytes(row["raw"])) == (5.0, 0.0, b"z")


def test_type_errors_name_the_column(spark):
    df = spark.createDataFrame([("1", 2)], "text string, num int")
    with pytest.raises(LayerError, match='"t"."text": a String field cannot be read as int'):
        as_layer(df, "text int", table="t")
    with pytest.raises(LayerError):
        as_layer(df, "num smallint")


ALL_TYPES = [
    "boolean", "smallint", "int", "bigint", "float", "double", "decimal(9,2)", "string", "varchar(5)", "char(5)",
    "binary", "date", "time", "timestamp_ntz", "variant", "array<boolean>", "array<smallint>", "array<int>",
    "array<bigint>", "array<float>", "array<double>", "array<string>",
]


def test_every_readable_pair_resolves(spark):
    for source_text in ALL_TYPES:
        source = T.StructType.fromDDL(f"v {source_text}")["v"].dataType
        stored = source if not isinstance(source, (T.CharType, T.VarcharType)) else T.StringType()
        df = spark.createDataFrame([], T.StructType([T.StructField("v", stored)]))
        for target_text in ALL_TYPES:
            target = T.StructType.fromDDL(f"v {target_text}")["v"].dataType
            allowed = re.sub(r"\(.*?\)", "", target_text) in READABLE_AS[source_type(source)]
            if allowed:
                df.select(coerce_read(F.col("v"), source, target)).schema
            else:
                with pytest.raises(LayerError):
                    coerce_read(F.col("v"), source, target)


def test_every_stored_type_resolves(spark):
    for text in ALL_TYPES:
        declared = T.StructType.fromDDL(f"v {text}")["v"].dataType
        stored = declared if not isinstance(declared, (T.CharType, T.VarcharType)) else T.StringType()
        df = spark.createDataFrame([], T.StructType([T.StructField("v", stored)]))
        df.select(coerce_write(F.col("v"), declared)).schema
    with pytest.raises(LayerError):
        coerce_write(F.col("v"), T.MapType(T.StringType(), T.StringType()))
    with pytest.raises(LayerError):
        check_storable(T.LongType(), "String", "v", "t")
    assert set(STORED_AS.values()) < set(READABLE_AS)


def test_text_widths(spark):
    df = spark.createDataFrame([("abcde  ",)], "v string")
    assert as_layer(df, "v varchar(5)").first()["v"] == "abcde"
    assert as_layer(df, "v char(9)").first()["v"] == "abcde    "
    with pytest.raises(Exception, match="too long"):
        as_layer(df, "v varchar(4)").collect()


def test_values_as_text_and_boolean(spark):
    df = spark.createDataFrame([(5.0, 1, 0), (5.25, 0, None)], "real double, num int, flag int")
    rows = as_layer(df, "real string, num string, flag boolean").collect()
    assert [tuple(r) for r in rows] == [("5", "1", False), ("5.25", "0", None)]
    with pytest.raises(Exception, match="invalid boolean"):
        as_layer(spark.createDataFrame([(2,)], "flag int"), "flag boolean").collect()


def test_srid_is_declared_not_transformed(spark):
    df = encode_points(spark.createDataFrame([(1, 2.0, 3.0)], "fid bigint, x double, y double"), "x", "y", srid=3005)
    assert df.select(srid_of(df)).first()[0] == 3005


@pytest.mark.parametrize("encoding,text", [("LATIN1", "Pàul"), ("WIN1250", "Žluťoučký"), ("SJIS", "東京"), ("UTF8", "日本")])
def test_encodings(spark, encoding, text):
    from geolayers.functions.text import charset

    df = spark.createDataFrame([(bytearray(text.encode(charset(encoding))),), (None,)], "v binary")
    assert [r[0] for r in df.select(transcode(F.col("v"), encoding)).collect()] == [text, None]
    utf8 = spark.createDataFrame([(bytearray(text.encode()),)], "v binary")
    assert utf8.select(transcode(F.col("v"), encoding, utf8_layer=True)).first()[0] == text
    with pytest.raises(LookupError):
        charset("no-such")


# --- ids --------------------------------------------------------------------------


def test_file_ids_follow_paths_and_rows(spark, tmp_path):
    path = str(tmp_path / "many.parquet")
    spark.range(0, 1000, 1, 7).select(F.col("id").alias("n")).write.parquet(path)
    df = read_layer(spark, str(tmp_path), "many", "fid bigint, n bigint")
    rows = df.orderBy("fid").collect()
    assert [r["fid"] for r in rows] == list(range(1000))
    assert [r["n"] for r in rows] == list(range(1000))  # part files in path order


def test_file_ids_do_not_depend_on_splits(spark, conf, tmp_path):
    path = str(tmp_path / "one.parquet")
    frame = spark.range(0, 20000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    frame.write.option("parquet.block.size", 65536).parquet(path)
    before = read_layer(spark, str(tmp_path), "one", "fid bigint, id bigint").collect()
    conf("spark.sql.files.maxPartitionBytes", "70000")
    after = read_layer(spark, str(tmp_path), "one", "fid bigint, id bigint")
    assert after.rdd.getNumPartitions() > 4
    assert all(r["fid"] == r["id"] for r in before) and all(r["fid"] == r["id"] for r in after.collect())


def test_csv_ids_over_splits_and_files(spark, conf, tmp_path):
    for number in range(3):
        lines = [f"{number * 5000 + i},{'x' * (i % 40)}" for i in range(5000)]
        (tmp_path / "rows.csv").mkdir(exist_ok=True)
        (tmp_path / "rows.csv" / f"part-{number}.csv").write_text("\n".join(["n,text", *lines]) + "\n")
    conf("spark.sql.files.maxPartitionBytes", "30000")
    df = read_layer(spark, str(tmp_path), "rows", "fid bigint, n string", fmt="csv")
    assert [int(r["n"]) + 1 for r in df.orderBy("fid").collect()] == list(range(1, 15001))
    assert [r["fid"] for r in df.orderBy("fid").collect()] == list(range(1, 15001))


def test_assigned_ids_are_dense(spark):
    df = spark.range(0, 5000, 1, 11).repartition(13, F.col("id") % 5)
    got = assign_fid(df, 100)
    assert sorted(r["fid"] for r in got.collect()) == list(range(100, 5100))
    ordered = assign_fid(df, 0, ["id"])
    assert all(r["fid"] == r["id"] for r in ordered.collect())
    assert assign_fid(df.filter("id < 0")).count() == 0


# --- changes ----------------------------------------------------------------------


@pytest.fixture
def base(spark):
    return spark.range(0, 50, 1, 4).select(F.col("id").alias("fid"), F.concat(F.lit("n"), "id").alias("name"), F.lit(1).alias("size"))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_update_sets_null_and_keeps_rest(spark, conf, base, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    changes = spark.createDataFrame([(3, None), (4, "four")], "fid bigint, name string")
    rows = {r["fid"]: (r["name"], r["size"]) for r in update(base, changes).collect()}
    assert len(rows) == 50 and rows[3] == (None, 1) and rows[4] == ("four", 1) and rows[5] == ("n5", 1)


def test_update_refuses_bad_changes(spark, base):
    for rows, message in (([(99, "x")], "lacks"), ([(1, "x"), (1, "y")], "twice")):
        with pytest.raises(LayerError, match=message):
            update(base, spark.createDataFrame(rows, "fid bigint, name string"))
    with pytest.raises(LayerError, match="no columns"):
        update(base, spark.createDataFrame([(1, 2)], "fid bigint, other int"))
    with pytest.raises(LayerError, match="cannot be changed"):
        update_where(base, F.col("fid") == 1, {"fid": F.lit(5)})
    with pytest.raises(LayerError, match="needs its fid"):
        delete(base.drop("fid"), base)


def test_insert_keeps_given_ids(spark, base):
    new = spark.createDataFrame([(70, "given", 2), (None, "auto", 3), (None, "auto", 3)], "fid bigint, name string, size int")
    grown, added = insert(base, new)
    assert sorted(r["fid"] for r in added.collect()) == [70, 71, 72] and grown.count() == 53
    with pytest.raises(LayerError, match="exists already"):
        insert(base, spark.createDataFrame([(7, "taken", 1)], "fid bigint, name string, size int"))
    first, _ = insert(base.filter("fid < 0"), spark.createDataFrame([("only",)], "name string"))
    assert [tuple(r) for r in first.collect()] == [(0, "only", None)]


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "fid bigint, n int")
    assert [r["fid"] for r in delete_where(df, F.col("n") > 1).collect()] == [1]


def test_changed_geometries_get_new_boxes(spark):
    start = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 5.0)], "fid bigint, x double, y double")
    layer = encode_points(start, "x", "y").drop("x", "y")
    # Fixed value: EWKB of POINT(100 0) in SRID 4326.
    ewkb = bytearray.fromhex("0101000020E610000000000000000059400000000000000000")
    moved = spark.createDataFrame([(2, ewkb)], "fid bigint, geom binary")
    there = (99, -1, 101, 1)
    for changed in (
        insert(layer, moved.drop("fid"))[0],
        update(layer, moved),
        update_where(layer, F.col("fid") == 2, {"geom": F.lit(bytes(ewkb))}),
    ):
        found = bbox_filter(changed, there).collect()
        assert len(found) == 1 and len(found[0]["geom"]) == 21
        assert changed.schema["geom"].metadata == layer.schema["geom"].metadata


def test_written_values_follow_the_storage_rules(spark):
    import datetime as dt

    base = spark.createDataFrame([(1, None, None)], "fid bigint, stamp timestamp_ntz, nums array<int>")
    late = dt.datetime(2001, 2, 11, 9, 59, 59, 600000)
    new = spark.createDataFrame([(late, [1, None, 2])], "stamp timestamp_ntz, nums array<int>")
    row = insert(base, new)[1].first()
    assert (row["stamp"], row["nums"]) == (dt.datetime(2001, 2, 11, 10, 0), [1, 2])
    assert update(base, new.withColumn("fid", F.lit(1))).first()["stamp"] == dt.datetime(2001, 2, 11, 10, 0)


# --- catalog ----------------------------------------------------------------------


def test_import_registers_views(spark):
    assert import_layers(spark, SF, limit_to=["nation", "region"]) == 2
    rows = spark.sql("select n.fid, r.r_name from nation n join region r on n_regionkey = r_regionkey").collect()
    assert sorted(r["fid"] for r in rows) == list(range(25))


def test_name_clash_is_reported(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "`a-b` int, `a b` int")
    df.write.parquet(str(tmp_path / "clash.parquet"))
    with pytest.raises(LayerError, match="same laundered name"):
        import_layers(spark, str(tmp_path))


def test_folder_layers_with_geometry(spark, tmp_path):
    layer = encode_points(points(spark, SF).drop("geom_bbox"), "x", "y", srid=4326)
    write_layer(layer, str(tmp_path / "Customer Points.parquet"))
    rows = layer_catalog(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [(r["table_name"], r["column_name"], r["data_type"]) for r in rows][:3] == [
        ("customer_points", "fid", "bigint"),
        ("customer_points", "geom", "Geometry(Point,4326)"),
        ("customer_points", "name", "varchar"),
    ]
    raw = layer_catalog(spark, str(tmp_path), launder_table_names=False, limit_to=["Customer Points"])
    assert raw.count() == len(rows)
    assert import_layers(spark, str(tmp_path)) == 1
    assert bbox_filter(spark.table("customer_points"), (-180, -90, 180, 90)).count() == layer.count()


def test_json_and_list_columns(spark):
    schema = T.StructType.fromDDL("doc variant, nums array<int>, name varchar(7), tm time")
    assert columns_of(schema) == [
        ("fid", "bigint"), ("doc", "jsonb"), ("nums", "integer[]"), ("name", "varchar(7)"), ("tm", "time"),
    ]
    with pytest.raises(LayerError):
        columns_of(T.StructType.fromDDL("m map<string,int>"))


# --- plans ------------------------------------------------------------------------


def test_filters_and_columns_reach_the_scan(spark):
    df = read_layer(spark, SF, "orders", "fid bigint, total double, o_orderstatus string", column_names={"total": "o_totalprice"}, fid_column="o_orderkey")
    plan = plan_of(df.filter((F.col("total") < 10) & (F.col("fid") == 5)).select("fid"))
    assert "LessThan(o_totalprice,10.0)" in plan and "EqualTo(o_orderkey,5)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    plan = plan_of(df.filter((F.col("total") < 10) | F.col("o_orderstatus").isNull()))
    assert "Or(LessThan(o_totalprice,10.0),IsNull(o_orderstatus))" in plan


def test_box_filter_prunes_stored_layer(spark, tmp_path):
    base = spark.range(0, 40000, 1, 4).select(
        F.col("id").alias("fid"), ((F.col("id") * 7919) % 36000 / 100 - 180).alias("x"), ((F.col("id") * 104729) % 18000 / 100 - 90).alias("y")
    )
    path = str(tmp_path / "grid.parquet")
    write_layer(encode_points(base, "x", "y").drop("x", "y"), path, partitions=16)
    df = bbox_filter(read_layer(spark, str(tmp_path), "grid"), (-180, -90, -150, -60)).select("fid")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(geom_bbox.xmax,-180.0)" in plan and "geom:binary" not in plan and "Python" not in plan
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), "geom_bbox")
    extents = files.groupBy("f").agg(F.min("geom_bbox.xmin").alias("x0"), F.min("geom_bbox.ymin").alias("y0"))
    assert extents.count() == 16
    assert extents.filter("x0 <= -150 and y0 <= -60").count() <= 4  # files the box can touch


def test_count_comes_from_footers(spark):
    assert "PushedAggregation: [COUNT(*)]" in plan_of(layer_count(spark, SF, "lineitem"))


def test_changes_do_not_shuffle_the_layer(spark, conf):
    base = read_layer(spark, SF, "orders", "fid bigint, o_orderstatus string", fid_column="o_orderkey")
    changes = spark.createDataFrame([(1, "X")], "fid bigint, o_orderstatus string")
    assert "Exchange hashpartitioning" not in plan_of(update(base, changes))
    assert "Exchange" not in plan_of(update_where(base, F.col("fid") == 1, {"o_orderstatus": F.lit("X")}))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "SortMergeJoin" in plan_of(update(base, changes))
