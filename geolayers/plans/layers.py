"""Layers that Spark derives from the given tables, with the same rule in SQL."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from geolayers.functions.boxes import make_box
from geolayers.model import box_name
from geolayers.sources.layers import read_layer

# Coordinates from keys; both engines compute the same doubles.
POINT_X = "cast((c_custkey * 7919) % 36000 as double) / 100 - 180"
POINT_Y = "cast((c_custkey * 104729) % 18000 as double) / 100 - 90"
BOX_X = "cast((s_suppkey * 104729) % 35000 as double) / 100 - 180"
BOX_Y = "cast((s_suppkey * 7919) % 17000 as double) / 100 - 90"
PARCEL_X = "cast((p_partkey * 15485863) % 35000 as double) / 100 - 180"
PARCEL_Y = "cast((p_partkey * 32452843) % 17000 as double) / 100 - 90"
PARCEL_WIDTH = "cast((p_partkey * 31) % 997 as double) / 100"
PARCEL_HEIGHT = "cast((p_partkey * 17) % 89 as double) / 100"
BOX_SIDE = 3

POINTS = f"""points as (
  select c_custkey as fid, c_name as name, c_nationkey as nation, c_acctbal as acctbal,
         c_mktsegment as segment, {POINT_X} as x, {POINT_Y} as y
  from customer)"""
BOXES = f"""boxes as (
  select s_suppkey as bid, s_name as bname, {BOX_X} as xmin, {BOX_Y} as ymin,
         {BOX_X} + {BOX_SIDE} as xmax, {BOX_Y} + {BOX_SIDE} as ymax
  from supplier)"""
PARCELS = f"""parcels as (
  select p_partkey as pid, {PARCEL_X} as pxmin, {PARCEL_Y} as pymin,
         {PARCEL_X} + {PARCEL_WIDTH} as pxmax, {PARCEL_Y} + {PARCEL_HEIGHT} as pymax
  from part)"""


def points(spark: SparkSession, source: str) -> DataFrame:
    """Customers as points: attributes, x, y and the covering box of ``geom``."""
    columns = "fid bigint, name string, nation int, acctbal double, segment string, c_custkey bigint"
    names = {"name": "c_name", "nation": "c_nationkey", "acctbal": "c_acctbal", "segment": "c_mktsegment"}
    df = read_layer(spark, source, "customer", columns, column_names=names, fid_column="c_custkey")
    df = df.withColumns({"x": F.expr(POINT_X), "y": F.expr(POINT_Y)}).drop("c_custkey")
    return df.withColumn(box_name("geom"), make_box(F.col("x"), F.col("y"), F.col("x"), F.col("y")))


def boxes(spark: SparkSession, source: str) -> DataFrame:
    """Suppliers as squares: bid, bname and the covering box of ``shape``."""
    df = read_layer(spark, source, "supplier")
    x, y = F.expr(BOX_X), F.expr(BOX_Y)
    return df.select(
        F.col("s_suppkey").alias("bid"),
        F.col("s_name").alias("bname"),
        make_box(x, y, x + BOX_SIDE, y + BOX_SIDE).alias(box_name("shape")),
    )


def parcels(spark: SparkSession, source: str) -> DataFrame:
    """Parts as rectangles of many sizes: pid and the covering box of ``parcel``."""
    df = read_layer(spark, source, "part")
    x, y = F.expr(PARCEL_X), F.expr(PARCEL_Y)
    box = make_box(x, y, x + F.expr(PARCEL_WIDTH), y + F.expr(PARCEL_HEIGHT))
    return df.select(F.col("p_partkey").alias("pid"), box.alias(box_name("parcel")))
