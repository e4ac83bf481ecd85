"""Layers as external tables with statistics, and Bloom filters of stored layers."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from geolayers import LayerError, encode_points, import_layers, read_layer, write_layer


def scanned(df):
    """Rows that the scan of a filter gives out: those of the row groups that it reads."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_statistics_choose_the_side_that_is_broadcast(spark, conf, tmp_path):
    """Both layers are beyond the bound as a whole; of the larger one a hundredth is left."""
    wide = F.repeat(F.md5(F.col("fid").cast("string")), 4)
    spark.range(60_000).select(F.col("id").alias("fid"), (F.col("id") % 1000).alias("kind"), wide.alias("t")).write.parquet(str(tmp_path / "big.parquet"))
    spark.range(9_000).select(F.col("id").alias("fid"), (F.col("id") * 3).alias("big"), wide.alias("u")).write.parquet(str(tmp_path / "small.parquet"))
    conf("spark.sql.autoBroadcastJoinThreshold", "300000")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.cbo.enabled", "true")

    def joined():
        few = spark.table("big").filter("kind < 10")
        return few.join(spark.table("small").drop("fid"), F.col("fid") == F.col("big"))

    import_layers(spark, str(tmp_path))
    assert "BroadcastHashJoin" not in plan_of(joined())
    assert import_layers(spark, str(tmp_path), database="planned") == 2
    assert "BroadcastHashJoin" in plan_of(joined()) and "BuildLeft" in plan_of(joined())
    assert joined().count() == sum(1 for k in range(9_000) if k * 3 % 1000 < 10)
    # Without statistics of the columns the filter is taken to keep all rows.
    import_layers(spark, str(tmp_path), database="planned", analysed=[])
    assert "BroadcastHashJoin" not in plan_of(joined())


def test_views_over_tables_are_those_over_files(spark, tmp_path):
    """Partition columns, odd names, geometries, ids by place; mixed and CSV layers stay views."""
    odd = spark.range(50).select(F.col("id").alias("A b"), F.array("id").alias("S"), (F.col("id") % 3).alias("p"))
    odd.write.partitionBy("p").parquet(str(tmp_path / "it's odd.parquet"))
    shapes = encode_points(spark.range(5).select(F.col("id").alias("fid"), F.col("id").cast("double").alias("x")), "x", "x", srid=4326)
    shapes.write.parquet(str(tmp_path / "shapes.parquet"))
    spark.range(0).write.parquet(str(tmp_path / "none.parquet"))
    spark.sql("select 1 as n").write.parquet(str(tmp_path / "mixed.parquet"))
    spark.sql("select 2.5D as n").write.mode("append").parquet(str(tmp_path / "mixed.parquet"))
    (tmp_path / "c.csv").write_text("a\n1\n")
    names = ["it_s_odd", "shapes", "none", "mixed", "c"]
    assert import_layers(spark, str(tmp_path)) == 5
    plain = {n: (spark.table(n).schema, sorted(map(str, spark.table(n).collect()))) for n in names}
    for _ in range(2):  # a second import replaces the tables
        assert import_layers(spark, str(tmp_path), database="odd_one") == 5
    assert {n: (spark.table(n).schema, sorted(map(str, spark.table(n).collect()))) for n in names} == plain
    assert {t.name for t in spark.catalog.listTables("odd_one") if not t.isTemporary} == {"it_s_odd", "shapes", "none"}
    assert spark.table("odd_one.it_s_odd").columns == ["A b", "S", "p"]
    # The catalog takes letters, digits and underscores as names of tables.
    assert import_layers(spark, str(tmp_path), database="odd_two", launder_table_names=False) == 5
    assert {t.name for t in spark.catalog.listTables("odd_two") if not t.isTemporary} == {"shapes", "none"}


def test_bloom_filters_of_a_stored_layer(spark, conf, tmp_path):
    """Ids spread over all files: extremes leave out no row group, Bloom filters nearly all."""
    conf("spark.sql.files.openCostInBytes", "1")
    spots = spark.range(40_000).select((F.col("id") * 7919 % 40_009 * 10).alias("fid"), (F.col("id") % 200).cast("double").alias("x"))
    layer = encode_points(spots, "x", "x")
    write_layer(layer, str(tmp_path / "plain.parquet"), 8)
    write_layer(layer, str(tmp_path / "asked.parquet"), 8, lookups=["fid"])
    plain, asked = (read_layer(spark, str(tmp_path), name) for name in ("plain", "asked"))
    known = layer.orderBy("fid").limit(20_000).orderBy(F.desc("fid")).first()["fid"]
    per_file = 40_000 / 8
    wanted = F.col("fid") == known
    assert scanned(plain.filter(wanted)) >= 7 * per_file * 0.5
    assert scanned(asked.filter(wanted)) <= 3 * per_file
    assert asked.filter(wanted).collect() == plain.filter(wanted).collect() != []
    # The share of row groups that absent ids pass, over 8 files and 25 ids.
    passed = sum(scanned(asked.filter(F.col("fid") == known + 3 + 10 * k)) > 0 for k in range(25))
    assert passed <= 25 * 8 * 0.01 + 4
    assert sorted(asked.collect()) == sorted(plain.collect())
    with pytest.raises(LayerError, match="nowhere"):
        write_layer(layer, str(tmp_path / "not.parquet"), lookups=["nowhere"])
