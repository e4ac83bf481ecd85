"""Change logs, layers stored by ranges and in buckets."""

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan_of
from geolayers import LayerError, encode_points, insert
from geolayers.operators.dml import apply_log
from geolayers.sources.stored import delete_stored, insert_stored, read_ranges, store_bucketed, update_stored, write_ranges


def layer(spark, n=40):
    return spark.range(n).select(F.col("id").alias("fid"), F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 7).cast("int").alias("size"))


def plain_log(base, log):
    """One operation after the other; log rows (op, seq, fid, name)."""
    last = max([f for f in base] + [r[2] for r in log if r[2] is not None], default=-1)
    state = dict(base)
    for op, _, fid, name in sorted(log, key=lambda r: r[1]):
        if fid is None:
            last += 1
            state[last] = (name, None)
        elif op == "insert":
            state[fid] = (name, None)
        elif op == "delete":
            state.pop(fid, None)
        elif fid in state:
            state[fid] = (name, state[fid][1])
    return state


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("seed", range(3))
def test_log_against_one_change_after_the_other(spark, conf, threshold, seed):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    draw = random.Random(seed)
    base = {r["fid"]: (r["name"], r["size"]) for r in layer(spark).collect()}
    log = []
    for seq in draw.sample(range(1000), 150):
        op = draw.choice(["insert", "update", "update", "delete"])
        fid = None if op == "insert" and draw.random() < 0.2 else 3 if draw.random() < 0.3 else draw.randint(0, 60)  # 3 is hot
        log.append((op, seq, fid, draw.choice([None, f"x{seq}"])))
    frame = spark.createDataFrame(log, "op string, seq bigint, fid bigint, name string").repartition(5)
    found = {r["fid"]: (r["name"], r["size"]) for r in apply_log(layer(spark), frame).collect()}
    assert found == plain_log(base, log)


def test_logs_that_cannot_be_done(spark):
    for rows, message in (
        ([("update", 1, 1, "a"), ("delete", 1, 1, "b")], "twice"), ([("merge", 1, 1, "a")], "cannot be done"),
        ([("delete", 1, None, "a")], "cannot be done"), ([("insert", None, 1, "a")], "cannot be done"), ([(None, 1, 1, "a")], "cannot be done"),
    ):
        with pytest.raises(LayerError, match=message):
            apply_log(layer(spark), spark.createDataFrame(rows, "op string, seq bigint, fid bigint, name string"))
    empty = spark.createDataFrame([], "op string, seq bigint, fid bigint, name string")
    assert sorted(apply_log(layer(spark), empty).collect()) == sorted(layer(spark).collect())
    with pytest.raises(LayerError, match="no columns"):
        apply_log(layer(spark), empty.withColumn("other", F.lit(1)))


def test_log_moves_geometries_and_their_boxes(spark):
    points = encode_points(spark.createDataFrame([(1, 0.0, 0.0)], "fid bigint, x double, y double"), "x", "y").drop("x", "y")
    moved = encode_points(spark.createDataFrame([("update", 1, 1, 5.0, 6.0)], "op string, seq int, fid bigint, x double, y double"), "x", "y")
    row = apply_log(points, moved.drop("x", "y", "geom_bbox")).first()
    assert (row["geom_bbox"]["xmin"], row["geom_bbox"]["ymax"]) == (5.0, 6.0)


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(spark, path):
    return {r["fid"]: (r["name"], r["size"]) for r in read_ranges(spark, path).collect()}


@pytest.mark.parametrize("ids", [10, 16])
def test_changes_rewrite_only_the_ranges_they_touch(spark, tmp_path, ids):
    path = str(tmp_path / "stored")
    write_ranges(layer(spark), path, ids=ids)
    before, expected = files_of(path), {r["fid"]: (r["name"], r["size"]) for r in layer(spark).collect()}
    assert rows(spark, path) == expected
    update_stored(spark, path, spark.createDataFrame([(3, "three"), (35, None)], "fid bigint, name string"))
    expected |= {3: ("three", expected[3][1]), 35: (None, expected[35][1])}
    assert rows(spark, path) == expected
    touched = {3 // ids, 35 // ids}
    same = {f: t for f, t in before.items() if int(f.split(f"fid_range_{ids}=")[1].split("/")[0]) not in touched}
    assert same and same.items() <= files_of(path).items() and len(files_of(path).items() & before.items()) == len(same)
    # A refused change leaves all files as they were.
    held = files_of(path)
    with pytest.raises(LayerError, match="lacks"):
        update_stored(spark, path, spark.createDataFrame([(5, "x"), (999, "y")], "fid bigint, name string"))
    assert files_of(path) == held
    # All rows of a range and a part of another; ids that are not there are no error.
    gone = [*range(ids, 2 * ids), 0, 999]
    delete_stored(spark, path, spark.createDataFrame([(i,) for i in [*gone, None]], "fid bigint"))
    expected = {k: v for k, v in expected.items() if k not in gone}
    assert rows(spark, path) == expected and not os.path.exists(f"{path}/fid_range_{ids}=1")
    held = files_of(path)
    added = insert(read_ranges(spark, path), spark.createDataFrame([("new", 1), ("newer", 2)], "name string, size int"))[1]
    insert_stored(spark, path, added)
    assert held.items() <= files_of(path).items()
    assert rows(spark, path) == expected | {max(expected) + 1 + i: v for i, v in enumerate([("new", 1), ("newer", 2)])}


def test_ranges_need_ids(spark, tmp_path):
    with pytest.raises(PySparkException, match="without a fid"):
        write_ranges(layer(spark).withColumn("fid", F.lit(None).cast("bigint")), str(tmp_path / "none"))
    layer(spark).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(LayerError, match="not stored by ranges"):
        update_stored(spark, str(tmp_path / "plain"), layer(spark))
    negative = str(tmp_path / "negative")
    write_ranges(spark.createDataFrame([(-1, "a", 1), (-11, "b", 1), (0, "c", 1)], "fid bigint, name string, size int"), negative, ids=10)
    delete_stored(spark, negative, spark.createDataFrame([(-1,)], "fid bigint"))
    assert set(rows(spark, negative)) == {-11, 0}


def test_bucketed_layers_join_without_a_shuffle(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = store_bucketed(layer(spark, 500), buckets=4)
    right = store_bucketed(spark.range(1000).select((F.col("id") % 300).alias("fid"), F.col("id").alias("v")), buckets=4)
    joined = left.join(right, "fid").groupBy("fid").agg(F.sum("v").alias("v"))
    joined.collect()
    assert "Exchange" not in plan_of(joined)
    plain = layer(spark, 500).join(spark.range(1000).select((F.col("id") % 300).alias("fid"), F.col("id").alias("v")), "fid")
    assert sorted(joined.collect()) == sorted(plain.groupBy("fid").agg(F.sum("v").alias("v")).collect())


def test_uneven_layers_are_not_bucketed(spark, conf):
    """A third of the rows on one key: buckets could not be split."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    hot = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("fid"))
    stored = store_bucketed(hot, buckets=64)
    assert stored.count() == 3000 and "Exchange" in plan_of(stored.join(layer(spark), "fid"))
