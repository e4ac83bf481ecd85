"""Queries: geometry, bounding-box filters and joins."""

from pyspark.sql import functions as F

from geolayers.functions.boxes import bbox_meets, make_box
from geolayers.functions.wkb import box_wkb, envelope, geometry_kind, line_wkb, point_wkb, strip_ewkb, to_wkt
from geolayers.operators.spatial import bbox_filter, bbox_join, common_kind, encode_boxes, encode_points, intersects_box
from geolayers.plans.layers import (
    BOXES,
    PARCELS,
    POINTS,
    boxes,
    parcels,
    points,
)
from geolayers.model import geometry_metadata
from geolayers.plans.registry import query
from geolayers.session import shared_path
from geolayers.sources.layers import read_layer, write_layer

BOX = (-40.0, -30.0, 25.5, 40.0)
IN_BOX = "x <= 25.5 and x >= -40 and y <= 40 and y >= -30"


@query("bbox_filter", f"with {POINTS} select fid, name, x, y from points where {IN_BOX}")
def box_filter(spark, source):
    return bbox_filter(points(spark, source), BOX).select("fid", "name", "x", "y")


@query("bbox_filter_flipped", f"with {POINTS} select fid, x, y from points where {IN_BOX}")
def box_filter_flipped(spark, source):
    layer = points(spark, source)
    return layer.filter(bbox_meets(make_box(*BOX), F.col("geom_bbox"))).select("fid", "x", "y")


@query("bbox_const", f"with {POINTS} select fid, case when fid % 7 = 0 then null else x end as x from points")
def box_const(spark, source):
    layer = nulled_points(spark, source)
    return layer.filter(bbox_meets(make_box(*BOX), BOX)).select("fid", F.col("geom_bbox.xmin").alias("x"))


@query("bbox_and_attr", f"with {POINTS} select fid, name, acctbal, x, y from points where {IN_BOX} and acctbal < 5000")
def box_and_attr(spark, source):
    layer = points(spark, source).filter((F.col("acctbal") < 5000))
    return bbox_filter(layer, BOX).select("fid", "name", "acctbal", "x", "y")


@query("bbox_or_attr", f"with {POINTS} select fid, acctbal, x from points where ({IN_BOX}) or not (acctbal < 9000)")
def box_or_attr(spark, source):
    layer = points(spark, source)
    return layer.filter(bbox_meets(F.col("geom_bbox"), BOX) | ~(F.col("acctbal") < 9000)).select("fid", "acctbal", "x")


@query(
    "bbox_columns",
    f"with {PARCELS} select pid from parcels where pxmin <= 5 and pxmax >= pymin and pymin <= pxmax and pymax >= pxmin "
    "and pxmin <= pymax",
)
def box_columns(spark, source):
    """A geometry against another column of its own row, and against a constant."""
    side = F.col("parcel_bbox")
    mirrored = make_box(side["ymin"], side["xmin"], side["ymax"], side["xmax"])
    layer = parcels(spark, source).withColumn("mirror_bbox", mirrored)
    return layer.filter(bbox_meets(side, F.col("mirror_bbox")) & (side["xmin"] <= 5)).select("pid")


def nulled_points(spark, source):
    layer = points(spark, source)
    x = F.when(F.col("fid") % 7 != 0, F.col("x"))
    return layer.withColumn("geom_bbox", make_box(x, F.col("y"), x, F.col("y")))


@query("bbox_null", f"with {POINTS} select fid, x, y from points where {IN_BOX} and fid % 7 <> 0")
def box_null(spark, source):
    return bbox_filter(nulled_points(spark, source), BOX).select("fid", "x", "y")


@query(
    "envelope",
    f"with {PARCELS} select pid, least(pxmin, pxmax) as xmin, pymin as ymin, pxmax as xmax, pymax as ymax from parcels",
)
def box_of_geometry(spark, source):
    layer = parcels(spark, source)
    wkb = box_wkb(F.col("parcel_bbox"))
    return layer.select("pid", envelope(wkb).alias("e")).select("pid", "e.*")


@query("wkb_roundtrip", f"with {POINTS} select fid, x, y, 21 as octets from points")
def wkb_roundtrip(spark, source):
    layer = encode_points(points(spark, source).drop("geom_bbox"), "x", "y")
    back = layer.select("fid", "geom", envelope(F.col("geom")).alias("e"))
    return back.select("fid", F.col("e.xmin").alias("x"), F.col("e.ymin").alias("y"), F.length("geom").alias("octets"))


@query(
    "geom_kind",
    "select 'Point' as kind, count(*) as n from customer union all select 'Polygon', count(*) from supplier "
    "union all select 'LineString', count(*) from part",
)
def kinds(spark, source):
    point = points(spark, source).select(point_wkb(F.col("x"), F.col("y")).alias("geom"))
    square = boxes(spark, source).select(box_wkb(F.col("shape_bbox")).alias("geom"))
    side = F.col("parcel_bbox")
    ends = [F.array(side[f"{axis}min"], side[f"{axis}max"]) for axis in "xy"]
    line = parcels(spark, source).select(line_wkb(*ends).alias("geom"))
    mixed = point.unionByName(square).unionByName(line)
    return mixed.groupBy(geometry_kind(F.col("geom")).alias("kind")).agg(F.count("*").alias("n"))


@query("geom_kind_layer", "select 'Point' as kind from customer having count(*) > 0")
def layer_kind(spark, source):
    return common_kind(encode_points(points(spark, source).drop("geom_bbox"), "x", "y"))


@query(
    "ewkb_strip",
    f"with {POINTS} select fid, x, y, 25 as stored, 21 as stripped from points",
)
def ewkb_strip(spark, source):
    plain = point_wkb(F.col("x"), F.col("y"))
    # EWKB point header with flag and SRID 4326.
    ewkb = F.concat(F.unhex(F.lit("0101000020E6100000")), F.substring(plain, 6, 16))
    layer = points(spark, source).select("fid", ewkb.alias("geom"))
    stripped = layer.select("fid", "geom", strip_ewkb(F.col("geom")).alias("plain"))
    read = stripped.select(
        "fid",
        F.length("geom").alias("stored"),
        F.length("plain").alias("stripped"),
        envelope(F.col("plain")).alias("e"),
    )
    return read.select("fid", F.col("e.xmin").alias("x"), F.col("e.ymin").alias("y"), "stored", "stripped")


@query(
    "geom_wkt",
    "select c_custkey as fid, concat('POINT(', c_custkey * 3 - 1000, ' ', -c_custkey, ')') as wkt from customer",
)
def geom_wkt(spark, source):
    layer = read_layer(spark, source, "customer")
    key = F.col("c_custkey")
    return layer.select(key.alias("fid"), to_wkt(point_wkb(key * 3 - 1000, -key)).alias("wkt"))


@query(
    "geom_wkt_box",
    "with k as (select s_suppkey as bid, s_suppkey * 2 as a, s_suppkey * 2 + 5 as b from supplier) select bid, "
    "concat('POLYGON((', a, ' ', a, ',', a, ' ', b, ',', b, ' ', b, ',', b, ' ', a, ',', a, ' ', a, '))') as wkt from k",
)
def geom_wkt_box(spark, source):
    low = F.col("s_suppkey") * 2
    box = make_box(low, low, low + 5, low + 5)
    return read_layer(spark, source, "supplier").select(F.col("s_suppkey").alias("bid"), to_wkt(box_wkb(box)).alias("wkt"))


# A falling diagonal from (px, py + h) to (px + w, py) against the fixed box:
# it misses only when the whole box lies on one side of the line.
DIAGONAL = """
  with {parcels},
  d as (select *, pxmax - pxmin as w, pymax - pymin as h from parcels),
  t as (select *,
    (-40 - pxmin) * h + (-30 - pymin) * w - w * h as low,
    (25.5 - pxmin) * h + (40 - pymin) * w - w * h as high
    from d)
  select pid from t
  where pxmin <= 25.5 and pxmax >= -40 and pymin <= 40 and pymax >= -30 and low <= 0 and high >= 0
""".format(parcels=PARCELS)


@query("intersects_box", DIAGONAL)
def intersects(spark, source):
    side = F.col("parcel_bbox")
    line = line_wkb(F.array(side["xmin"], side["xmax"]), F.array(side["ymax"], side["ymin"]))
    layer = parcels(spark, source).withColumn("parcel", line)
    return intersects_box(layer, BOX, "parcel").select("pid")


@query(
    "bbox_join",
    f"with {POINTS}, {BOXES} select fid, bid from points, boxes "
    "where x <= xmax and x >= xmin and y <= ymax and y >= ymin",
)
def box_join(spark, source):
    places = points(spark, source).select("fid", "geom_bbox")
    return bbox_join(places, boxes(spark, source), "geom", "shape").select("fid", "bid")


@query(
    "bbox_join_boxes",
    f"with {PARCELS}, {BOXES} select pid, bid, bname from parcels, boxes "
    "where pxmin <= xmax and pxmax >= xmin and pymin <= ymax and pymax >= ymin",
)
def box_join_boxes(spark, source):
    named = boxes(spark, source)
    joined = bbox_join(parcels(spark, source), named.drop("bname"), "parcel", "shape").select("pid", "bid")
    return joined.join(named.select("bid", "bname"), "bid").select("pid", "bid", "bname")


@query(
    "bbox_self_join",
    f"with {PARCELS} select a.pid as pid, b.pid as other from parcels a, parcels b "
    "where a.pid < b.pid and a.pxmin <= b.pxmax and a.pxmax >= b.pxmin and a.pymin <= b.pymax and a.pymax >= b.pymin",
)
def box_self_join(spark, source):
    left = parcels(spark, source)
    right = left.withColumnsRenamed({"pid": "other", "parcel_bbox": "plot_bbox"})
    return bbox_join(left, right, "parcel", "plot").filter("pid < other").select("pid", "other")


CORNER_X = "(case when s_suppkey % 2 = 0 then -175 else 150 end) + cast((s_suppkey * 7919) % 1500 as double) / 100"
CORNER_Y = "(case when s_suppkey % 2 = 0 then -85 else 60 end) + cast((s_suppkey * 104729) % 1500 as double) / 100"


@query(
    "bbox_join_clustered",
    f"with {PARCELS}, c as (select s_suppkey as bid, {CORNER_X} as x, {CORNER_Y} as y from supplier) "
    "select pid, bid from parcels, c where pxmin <= x + 0.5 and pxmax >= x and pymin <= y + 0.5 and pymax >= y",
)
def box_join_clustered(spark, source):
    """Boxes in two corners against a stored layer: of its files only those near the corners are read."""
    root = shared_path(spark, "layers")
    write_layer(parcels(spark, source).select("pid", box_wkb(F.col("parcel_bbox")).alias("parcel", metadata=geometry_metadata(4326, "Polygon")), "parcel_bbox"), f"{root}/parcels.parquet")
    x, y = F.expr(CORNER_X), F.expr(CORNER_Y)
    corners = read_layer(spark, source, "supplier").select(F.col("s_suppkey").alias("bid"), make_box(x, y, x + 0.5, y + 0.5).alias("shape_bbox"))
    stored = read_layer(spark, root, "parcels").select("pid", "parcel_bbox")
    return bbox_join(stored, corners, "parcel", "shape", cover_rows=0).select("pid", "bid")


@query("layer_store", f"with {PARCELS} select pid, pxmin as xmin, pymax as ymax, 93 as octets from parcels "
       "where pxmin <= 25.5 and pxmax >= -40 and pymin <= 40 and pymax >= -30")
def layer_store(spark, source):
    """Write a layer along its grid walk, then scan the stored file with a box."""
    side = F.col("parcel_bbox")
    sides = parcels(spark, source).select("pid", *[side[f].alias(f) for f in ("xmin", "ymin", "xmax", "ymax")])
    root = shared_path(spark, "layers")
    layer = encode_boxes(sides, "xmin", "ymin", "xmax", "ymax", srid=4326).drop("xmin", "ymin", "xmax", "ymax")
    write_layer(layer, f"{root}/parcels.parquet")
    stored = read_layer(spark, root, "parcels")
    found = bbox_filter(stored, BOX)
    return found.select(
        "pid", F.col("geom_bbox.xmin").alias("xmin"), F.col("geom_bbox.ymax").alias("ymax"), F.length("geom").alias("octets")
    )
