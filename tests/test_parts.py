"""Layers of part files: headers, types, packed files, special paths, ids and views."""

import bz2
import gzip
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from conftest import plan_of
from geolayers import LayerError, import_layers, layer_catalog, list_layers, read_layer
from geolayers.sources import fids
from geolayers.sources.fids import file_fids, lookup_fids, running_offsets
from geolayers.sources.parts import merged_schema, wider


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy(columns[0]).collect()]


@pytest.fixture
def mixed(tmp_path):
    """Part files with swapped, late, missing and no columns, one packed, in the order of their names."""
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("a,b\n1,2\n")
    (folder / "b.csv").write_text("b,a\n2,1\n")
    with gzip.open(folder / "c.csv.gz", "wt") as f:
        f.write("a,c,b\n1,3,2\n4,,5\n")
    (folder / "d.csv").write_text("a\n7\n")
    (folder / "e.csv").write_text("")
    (folder / "f.csv").write_text("a,b\n8,9\n")
    return tmp_path


def test_csv_files_by_their_headers(spark, mixed):
    expected = [(1, "1", "2", None), (2, "1", "2", None), (3, "1", "2", "3"), (4, "4", "5", ""), (5, "7", None, None), (6, "8", "9", None)]
    df = read_layer(spark, str(mixed), "mixed", "fid bigint, a string, b string, c string", fmt="csv")
    assert rows(df, "fid", "a", "b", "c") == expected
    assert read_layer(spark, str(mixed), "mixed", fmt="csv").columns == ["a", "b", "c"]
    assert import_layers(spark, str(mixed)) == 1
    assert rows(spark.table("mixed"), "fid", "a", "b", "c") == expected
    found = layer_catalog(spark, str(mixed)).orderBy("ordinal").collect()
    assert [r["column_name"] for r in found] == ["fid", "a", "b", "c"] == spark.table("mixed").columns


def test_csv_headers_random(spark, tmp_path):
    """Against a plain reader: every value stays under its header's name, ids follow the files."""
    draw = random.Random(5)
    expected = []
    (tmp_path / "many").mkdir()
    for number in range(12):
        names = draw.sample("abcdef", draw.randint(1, 6))
        body = [[str(draw.randint(0, 99)) for _ in names] for _ in range(draw.randint(0, 5))]
        (tmp_path / "many" / f"{number:02d}.csv").write_text("\n".join(",".join(r) for r in [names, *body]) + "\n")
        expected += [dict(zip(names, r)) for r in body]
    df = read_layer(spark, str(tmp_path), "many", "fid bigint, a string, b string, c string, d string, e string, f string", fmt="csv")
    found = [{k: v for k, v in r.asDict().items() if k != "fid" and v is not None} for r in df.orderBy("fid").collect()]
    assert found == expected


def test_a_header_that_names_a_column_twice_is_an_error(spark, tmp_path):
    (tmp_path / "twice.csv").write_text("a,A,b\n1,2,3\n")
    with pytest.raises(PySparkException, match="more than once"):
        layer_catalog(spark, str(tmp_path)).collect()


def test_agreeing_files_are_one_scan(spark, tmp_path):
    (tmp_path / "same").mkdir()
    for k in range(3):
        (tmp_path / "same" / f"{k}.csv").write_text(f"a,b\n{k},x\n")
    df = read_layer(spark, str(tmp_path), "same", "a string", fmt="csv")
    assert "Union" not in plan_of(df) and df.count() == 3


def test_packed_layers(spark, tmp_path):
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(b"n,m\n1,x\n2,y\n"))
    (tmp_path / "y.CSV.bz2").write_bytes(bz2.compress(b"n\n5\n"))
    spark.range(4).write.option("header", "true").option("compression", "gzip").csv(str(tmp_path / "folder"))
    assert {tuple(r) for r in list_layers(spark, str(tmp_path)).collect()} == {("z", "csv"), ("y", "csv"), ("folder", "csv")}
    assert import_layers(spark, str(tmp_path)) == 3
    assert rows(spark.table("z"), "fid", "n", "m") == [(1, "1", "x"), (2, "2", "y")]
    assert rows(spark.table("y"), "fid", "n") == [(1, "5")]
    assert sorted(r["id"] for r in spark.table("folder").collect()) == ["0", "1", "2", "3"]
    assert rows(read_layer(spark, str(tmp_path), "z", "fid bigint, m string", fmt="csv"), "fid", "m") == [(1, "x"), (2, "y")]


def test_paths_with_special_characters(spark, tmp_path):
    source = tmp_path / "da ta+%41"
    df = spark.range(6).select((F.col("id") * 2).alias("v"), F.element_at(F.array(F.lit("a b"), F.lit("x:y"), F.lit("50%+é")), (F.col("id") % 3 + 1).cast("int")).alias("p"))
    df.write.partitionBy("p").parquet(str(source / "my layer.parquet"))
    (source / "te xt.csv").write_text("n\n1\n2\n")
    assert import_layers(spark, str(source)) == 2
    found = spark.table("my_layer").collect()
    assert sorted(r["fid"] for r in found) == list(range(6)) and {r["p"] for r in found} == {"a b", "x:y", "50%+é"}
    assert rows(spark.table("te_xt"), "fid", "n") == [(1, "1"), (2, "2")]


def test_rows_of_unknown_files_are_an_error(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "l"))
    df = spark.read.parquet(str(tmp_path / "l"))
    none = spark.createDataFrame([], "_file string, _rows bigint, _first bigint, _offset bigint")
    for offsets in (none, running_offsets(spark.createDataFrame([("file:/other", 9, 0)], "_file string, _rows bigint, _first bigint"), ["_file"])):
        with pytest.raises(PySparkException, match="changed while"):
            file_fids(df, offsets=offsets).collect()


def test_offsets_are_prefix_sums(spark):
    draw = random.Random(2)
    counts = [(f"f{i:04d}", draw.randint(0, 9), 0) for i in range(500)]
    df = spark.createDataFrame(draw.sample(counts, len(counts)), "_file string, _rows bigint, _first bigint").repartition(7)
    at, expected = 10, {}
    for name, n, _ in counts:
        expected[name], at = at, at + n
    assert {r["_file"]: r["_offset"] for r in running_offsets(df, ["_file"], 10).collect()} == expected


@pytest.mark.parametrize("bound", [64 << 20, 1])
def test_ids_with_and_without_a_broadcast(spark, monkeypatch, tmp_path, bound):
    monkeypatch.setattr(fids, "OFFSET_BYTES", bound)
    spark.range(0, 1000, 1, 8).write.parquet(str(tmp_path / "l.parquet"))
    layer = read_layer(spark, str(tmp_path), "l", "fid bigint, id bigint")
    assert ("BroadcastHashJoin" in plan_of(layer)) == (bound > 1)
    assert rows(layer, "fid", "id") == [(i, i) for i in range(1000)]
    assert rows(lookup_fids(spark.read.parquet(str(tmp_path / "l.parquet")), [0, 999, 5, 5, 2000]), "fid", "id") == [(0, 0), (5, 5), (999, 999)]
    assert lookup_fids(spark.read.parquet(str(tmp_path / "l.parquet")), []).count() == 0


def test_lookup_reads_only_the_files_of_its_ids(spark, tmp_path):
    spark.range(0, 1000, 1, 10).write.parquet(str(tmp_path / "l.parquet"))
    found = lookup_fids(spark.read.parquet(str(tmp_path / "l.parquet")), [5])
    found.collect()
    assert "number of files read: 1\n" in found._jdf.queryExecution().executedPlan().toString() or found.rdd.getNumPartitions() <= 1
    assert "case when" not in plan_of(found).lower()


def test_a_field_called_fid_is_ordinary(spark, tmp_path):
    (tmp_path / "t.csv").write_text("fid,n\n7,x\n7,y\n")
    found = layer_catalog(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [(r["column_name"], r["data_type"], r["column_option"]) for r in found] == [
        ("fid", "bigint", None), ("fid_1", "varchar", "fid"), ("n", "varchar", None)]
    import_layers(spark, str(tmp_path))
    table = spark.table("t")
    assert table.dtypes == [("fid", "bigint"), ("fid_1", "string"), ("n", "string")]
    assert rows(table, "fid", "fid_1", "n") == [(1, "7", "x"), (2, "7", "y")]
    declared = read_layer(spark, str(tmp_path), "t", "fid bigint, other string", fmt="csv", column_names={"other": "fid"})
    assert rows(declared, "fid", "other") == [(1, "7"), (2, "7")]
    named = read_layer(spark, str(tmp_path), "t", "fid bigint", fmt="csv", fid_column="fid")
    assert rows(named, "fid") == [(7,), (7,)]


WIDER = [
    ("int", "int", "int"), ("smallint", "bigint", "bigint"), ("int", "double", "double"), ("bigint", "float", "double"),
    ("float", "double", "double"), ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("timestamp", "timestamp_ntz", "string"), ("int", "string", "string"), ("boolean", "int", "string"), ("varchar(3)", "string", "string"),
    ("decimal(5,2)", "decimal(6,1)", "decimal(7,2)"), ("decimal(5,2)", "int", "decimal(21,2)"), ("decimal(38,30)", "decimal(38,0)", "string"),
    ("decimal(5,2)", "double", "double"), ("date", "int", "string"), ("binary", "string", None), ("array<int>", "array<bigint>", None),
]


@pytest.mark.parametrize("a, b, wanted", WIDER)
def test_types_widen(a, b, wanted):
    types = [T.StructType.fromDDL(f"x {t}")[0].dataType if t else None for t in (a, b, wanted)]
    assert wider(types[0], types[1]) == wider(types[1], types[0]) == types[2]
    schemas = [T.StructType([T.StructField("x", t)]) for t in types[:2]]
    if wanted is None:
        with pytest.raises(LayerError, match="disagree"):
            merged_schema(schemas, "l")
    else:
        assert merged_schema(schemas, "l")[0].dataType == types[2]


def test_files_of_different_types(spark, tmp_path):
    path = str(tmp_path / "w.parquet")
    spark.sql("select cast(1 as int) as n, date '2020-01-02' as d, 1 as t").coalesce(1).write.parquet(path)
    spark.sql("select 5000000000 as n, timestamp_ntz '2021-01-01 01:00:00' as d, 'x' as t, true as late").coalesce(1).write.mode("append").parquet(path)
    spark.sql("select 2.5D as n").coalesce(1).write.mode("append").parquet(path)
    expected = {(1.0, "2020-01-02 00:00:00", "1", None), (5e9, "2021-01-01 01:00:00", "x", True), (2.5, None, None, None)}
    import_layers(spark, str(tmp_path))
    table = spark.table("w")
    assert table.dtypes == [("fid", "bigint"), ("n", "double"), ("d", "timestamp_ntz"), ("t", "string"), ("late", "boolean")]
    assert {tuple(r) for r in table.selectExpr("n", "cast(d as string)", "t", "late").collect()} == expected
    assert sorted(r["fid"] for r in table.collect()) == [0, 1, 2]
    widened = read_layer(spark, str(tmp_path), "w", "fid bigint, n double, d timestamp_ntz, t string, late boolean", widened=True)
    assert {tuple(r) for r in widened.selectExpr("n", "cast(d as string)", "t", "late").collect()} == expected
    assert sorted(r["fid"] for r in widened.collect()) == [0, 1, 2]
    found = layer_catalog(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [r["data_type"] for r in found] == ["bigint", "double precision", "timestamp", "varchar", "boolean"]


def test_partition_columns_are_typed_like_in_a_plain_scan(spark, tmp_path):
    values = "select id as v, id - 2 as i, id * 3000000000 as l, id / 4 as f, date_add(date '2020-02-27', cast(id as int)) as d, concat('k', id) as t, " \
             "if(id = 1, null, id) as n, if(id = 1, null, concat('2020-01-01 0', id, ':00:00')) as s from range(4)"  # fmt: skip
    spark.sql(values).write.partitionBy("i", "l", "f", "d", "t", "n", "s").parquet(str(tmp_path / "p.parquet"))
    import_layers(spark, str(tmp_path))
    plain = spark.read.parquet(str(tmp_path / "p.parquet"))
    assert spark.table("p").drop("fid").dtypes == plain.dtypes
    assert sorted(map(str, spark.table("p").drop("fid").collect())) == sorted(map(str, plain.collect()))
