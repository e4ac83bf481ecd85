"""The bounding-box join against a nested loop: sizes, skew, both strategies."""

import math
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from geolayers import LayerError, bbox_join, make_box
from geolayers.functions.boxes import bbox_meets
from geolayers.operators import spatial
from geolayers.operators.spatial import encode_boxes, quadtree_cover
from geolayers.sources.layers import write_layer

SIDES = "a double, b double, c double, d double"


def frame(spark, boxes, key, geom):
    rows = [(i, *b) for i, b in enumerate(boxes)]
    df = spark.createDataFrame(rows, f"{key} bigint, {SIDES}")
    return df.select(key, make_box(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias(f"{geom}_bbox"))


def brute(left, right):
    return sorted(
        (i, j)
        for i, a in enumerate(left)
        for j, b in enumerate(right)
        if None not in a and None not in b
        and a[0] <= b[2] and a[2] >= b[0] and a[1] <= b[3] and a[3] >= b[1]
    )


def joined(spark, left, right, **options):
    df = bbox_join(frame(spark, left, "l", "one"), frame(spark, right, "r", "two"), "one", "two", **options)
    return sorted((r["l"], r["r"]) for r in df.collect())


def random_boxes(rng, n):
    out = []
    for _ in range(n):
        size = 10 ** rng.uniform(-4, 2)
        thin = size * 10 ** rng.uniform(-3, 0)
        w, h = (size, thin) if rng.random() < 0.5 else (thin, size)
        if rng.random() < 0.3:
            w = h = 0.0
        x, y = rng.uniform(-100, 100), rng.uniform(-100, 100)
        out.append((x, y, x + w, y + h))
    out += [(-1e4, -1e4, 1e4, 1e4), (None, 0.0, 1.0, 1.0), (5.0, 5.0, 5.0, 5.0)]
    return out


@pytest.fixture(params=["broadcast", "hash", "sort"])
def strategy(request, conf, monkeypatch):
    if request.param != "broadcast":
        conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    if request.param == "sort":
        monkeypatch.setattr(spatial, "HASH_BYTES", 0)
    return request.param


@pytest.mark.parametrize("cell", [1e-6, 0.5, 1000.0])
def test_all_sizes(spark, strategy, cell):
    rng = random.Random(7)
    left, right = random_boxes(rng, 400), random_boxes(rng, 300)
    assert joined(spark, left, right, cell=cell) == brute(left, right)


def test_touching_edges(spark, strategy):
    left = [(0.0, 0.0, 1.0, 1.0), (-1.0, -1.0, 0.0, 0.0)]
    right = [(1.0, 1.0, 2.0, 2.0), (0.0, 0.0, 0.0, 0.0), (1.0 + 1e-12, 0.0, 2.0, 1.0)]
    assert joined(spark, left, right) == brute(left, right)


number = st.integers(-40, 40).map(lambda n: n / 4)
box = st.tuples(number, number, st.integers(0, 60), st.integers(0, 60)).map(lambda b: (b[0], b[1], b[0] + b[2] / 4, b[1] + b[3] / 4))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(box, min_size=1, max_size=40), st.lists(box, min_size=1, max_size=40), st.sampled_from([1e-6, 0.25, 3.0]))
def test_small_boxes(spark, left, right, cell):  # strategies are covered above
    assert joined(spark, left, right, cell=cell) == brute(left, right)


def test_hot_place_is_split(spark, conf, monkeypatch):
    """A third of both sides in one spot: split over tasks, no pair lost or doubled."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "100")
    rng = random.Random(3)
    spot = (10.0, 10.0, 10.0, 10.0)
    left = [spot] * 150 + random_boxes(rng, 300)
    right = [(9.5, 9.5, 10.5, 10.5)] * 100 + random_boxes(rng, 200)
    found = []
    original = spatial._hot_cells
    monkeypatch.setattr(spatial, "_hot_cells", lambda *a: found.append(original(*a)) or found[-1])
    assert joined(spark, left, right) == brute(left, right)
    assert {side for side, _, parts in found[0] if parts > 2} == {"l", "r"}


def test_no_cross_join(spark, conf, monkeypatch):
    rng = random.Random(5)
    left, right = frame(spark, random_boxes(rng, 50), "l", "one"), frame(spark, random_boxes(rng, 50), "r", "two")
    assert "BroadcastHashJoin" in plan_of(bbox_join(left, right, "one", "two"))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for limit, strategy in ((spatial.HASH_BYTES, "ShuffledHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(spatial, "HASH_BYTES", limit)
        plan = plan_of(bbox_join(left, right, "one", "two"))
        assert strategy in plan
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_copies_without_id_are_kept(spark, conf):
    """Equal rows without a fid: every copy pairs, however cells are split."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "100")
    left = frame(spark, [(1.0, 1.0, 1.0, 1.0)] * 60, "l", "one").withColumn("l", F.lit(0))
    right = frame(spark, [(0.0, 0.0, 2.0, 2.0)] * 50 + [(5.0, 5.0, 6.0, 6.0)] * 50, "r", "two")
    assert bbox_join(left, right, "one", "two").count() == 3000


def test_wide_rows_are_not_broadcast(spark):
    rows = [(i, float(i), "x" * 40000) for i in range(300)]
    left = spark.createDataFrame(rows, "l bigint, x double, text string")
    left = left.select("l", "text", make_box(F.col("x"), F.col("x"), F.col("x"), F.col("x")).alias("one_bbox"))
    right = frame(spark, [(float(i), float(i), i + 0.5, i + 0.5) for i in range(3000)], "r", "two")
    df = bbox_join(left, right, "one", "two")
    assert "text" not in plan_of(df).split("BroadcastExchange")[-1] if "BroadcastExchange" in plan_of(df) else True
    assert df.count() == 300


def test_extent_of_one_side_prunes_the_other(spark, tmp_path):
    world = [(float(i), 0.0, i + 0.5, 1.0) for i in range(200)]
    frame(spark, world, "l", "one").write.parquet(str(tmp_path / "world"))
    left = spark.read.parquet(str(tmp_path / "world"))
    right = frame(spark, [(150.25, 0.0, 153.0, 1.0)], "r", "two")
    df = bbox_join(left, right, "one", "two")
    assert "LessThanOrEqual(one_bbox.xmin,153.0)" in plan_of(df) and "GreaterThanOrEqual(one_bbox.xmax,150.25)" in plan_of(df)
    assert sorted(r["l"] for r in df.collect()) == [150, 151, 152, 153]
    far = frame(spark, [(900.0, 0.0, 901.0, 1.0)], "r", "two")
    assert bbox_join(left, far, "one", "two").count() == 0


def test_empty_side_and_clash(spark):
    left = frame(spark, [(0.0, 0.0, 1.0, 1.0)], "l", "one")
    right = frame(spark, [(0.0, 0.0, 1.0, 1.0)], "r", "two")
    assert bbox_join(left, right.limit(0), "one", "two").count() == 0
    with pytest.raises(LayerError):
        bbox_join(left, left, "one", "one")


# --- sides that are narrowed first ------------------------------------------------


def shapes_of(spark, rows, name):
    df = spark.createDataFrame(rows, f"{name} bigint, x0 double, y0 double, x1 double, y1 double")
    return df.select(name, make_box(*(F.col(c) for c in ("x0", "y0", "x1", "y1"))).alias(f"g{name}_bbox"))


def plain_join(left, right):
    return sorted((a[0], b[0]) for a in left for b in right if a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4])


HUGE = [
    (1, -math.inf, -math.inf, math.inf, math.inf), (2, -1e300, -1e300, 1e300, 1e300), (3, 0.0, 0.0, 1.0, 1.0), (4, 1e300, 1e300, math.inf, 1e301),
    (5, -1e308, 0.5, -1e307, 0.5), (6, 5e15, 5e15, 5e15, 5e15), (7, 0.5, -math.inf, 0.5, math.inf), (8, -1e12, 2.0, 1e12, 3.0),
]


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_boxes_without_bounds(spark, conf, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    draw = random.Random(1)
    others = [(10 + i, x, y, x + 1, y + 1) for i in range(30) for x, y in [(draw.uniform(-2, 2) * 10 ** draw.choice([0, 9, 16, 200, 308]), draw.uniform(-3, 3))]]
    for left, right in ((HUGE, HUGE), (HUGE, others), (others, HUGE), (others, others)):
        found = bbox_join(shapes_of(spark, left, "p"), shapes_of(spark, right, "q"), "gp", "gq").select("p", "q").collect()
        assert sorted(map(tuple, found)) == plain_join(left, right)


def test_computed_boxes_are_read_from_files(spark):
    """Boxes of expressions are computed once and dealt evenly, from however few partitions they come."""
    x, y = (F.col("id") * 7919 % 3600 / 10 - 180), (F.col("id") * 104729 % 1800 / 10 - 90)
    sides = []
    for rows, fid, geom, side in ((12_000, "p", "gp", 0.5), (300, "q", "gq", 4.0)):
        df = spark.range(0, rows, 1, 1).select(F.col("id").alias(fid), x.alias("x"), y.alias("y"))
        sides.append(encode_boxes(df, "x", "y", F.col("x") + side, F.col("y") + side, geom).select(fid, f"{geom}_bbox"))
    left, right = sides
    joined = bbox_join(left, right, "gp", "gq", cover_rows=0).select("p", "q")
    files = [re.search("/(boxes-[^/]*)/", f) for f in joined.inputFiles()]
    assert all(files) and len({f[1] for f in files}) == 2 and len(files) >= 8
    meets = bbox_meets(F.col("gp_bbox"), F.col("gq_bbox"))
    found, plain = joined.collect(), left.join(right, meets).select("p", "q").collect()
    assert sorted(found) == sorted(plain) and len(plain) > 300


def test_cover_holds_all_cells():
    draw = random.Random(2)
    for _ in range(50):
        cells = {}
        for _ in range(draw.randint(1, 40)):
            x, y = draw.randint(0, 63), draw.randint(0, 63)
            cells[x, y] = [x - draw.random(), y - draw.random(), x + draw.random() * 3, y + 1.0]
        parts = draw.randint(1, 20)
        cover = quadtree_cover(cells, 6, parts)
        assert 1 <= len(cover) <= max(parts, 1)
        assert all(any(c[0] <= b[0] and c[1] <= b[1] and b[2] <= c[2] and b[3] <= c[3] for c in cover) for b in cells.values())
    corners = {(0, 0): [0.0, 0.0, 1.0, 1.0], (63, 63): [63.0, 63.0, 64.0, 64.0]}
    assert sorted(quadtree_cover(corners, 6, 4)) == sorted(corners.values())
    assert quadtree_cover({}, 6, 4) == []


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_stored_layer_is_read_near_the_other_side_only(spark, conf, tmp_path, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    # Row groups of some hundred rows: 40,000 boxes are few for a file.
    conf("spark.sql.parquet.columnarReaderBatchSize", "512")
    grid = spark.range(0, 40000).select(F.col("id").alias("p"), (F.col("id") % 200).cast("double").alias("x"), F.floor(F.col("id") / 200).cast("double").alias("y"))
    layer = encode_boxes(grid, "x", "y", F.col("x") + 0.5, F.col("y") + 0.5, "gp").drop("x", "y", "gp")
    write_layer(encode_boxes(grid, "x", "y", F.col("x") + 0.5, F.col("y") + 0.5, "gp").drop("x", "y"), str(tmp_path / "grid.parquet"), partitions=32)
    stored = spark.read.parquet(str(tmp_path / "grid.parquet")).select("p", "gp_bbox")
    corners = [(i, x + i % 7, y + i % 5, x + i % 7 + 0.2, y + i % 5 + 0.2) for i in range(60) for x, y in [((1.0, 190.0)[i % 2], (1.0, 190.0)[i % 2])]]
    right = shapes_of(spark, corners, "q")
    joined = bbox_join(stored, right, "gp", "gq", cover_rows=0).select("p", "q")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, bbox_join(layer, right, "gp", "gq").select("p", "q").collect()))
    assert joined.count() > 50
    plan = plan_of(joined)
    assert "PushedFilters: [Or(" in plan or "Or(And" in plan
    read = stored.filter(" or ".join(f"(gp_bbox.xmin <= {c[2]} and gp_bbox.xmax >= {c[0]} and gp_bbox.ymin <= {c[3]} and gp_bbox.ymax >= {c[1]})"
                                     for c in ([1, 1, 8, 6], [190, 190, 197, 195])))
    files = read.select(F.col("_metadata.file_path")).distinct().count()
    assert files <= 8 < spark.read.parquet(str(tmp_path / "grid.parquet")).select(F.col("_metadata.file_path")).distinct().count()
    # Row groups beyond the cover are not read.
    scanned = scanned_rows(joined)
    assert 0 < scanned < 40000 / 4


def scanned_rows(df):
    """Rows that the scan of the stored layer gave in the last run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif hasattr(node, "plan") and node.nodeName().endswith("QueryStage"):
            walk(node.plan())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(text)
    return sum(found)


def test_sides_are_measured_once_where_nothing_is_narrowed(spark):
    left = shapes_of(spark, [(i, float(i), 0.0, i + 1.5, 1.0) for i in range(50)], "p")
    right = left.withColumnsRenamed({"p": "q", "gp_bbox": "gq_bbox"})
    spark.sparkContext.setJobGroup("self", "")
    joined = bbox_join(left, right, "gp", "gq")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("self")) <= 2  # one measure; adaptive stages count
    assert joined.count() == 50 + 2 * 49
