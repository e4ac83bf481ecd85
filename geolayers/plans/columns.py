"""Queries: scans and column matching."""

from pyspark.sql import functions as F

from geolayers.operators.columns import as_layer
from geolayers.operators.spatial import encode_points
from geolayers.plans.layers import points
from geolayers.plans.registry import query
from geolayers.sources.layers import read_layer, srid_of, stamp_srid


@query(
    "layer_scan",
    "select c_custkey as fid, c_name, c_nationkey, c_acctbal, c_mktsegment from customer",
)
def layer_scan(spark, source):
    columns = "fid bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return read_layer(spark, source, "customer", columns, fid_column="c_custkey")


@query("layer_rescan", "select * from nation where n_nationkey in (select n_nationkey from nation)")
def layer_rescan(spark, source):
    nation = read_layer(spark, source, "nation")
    return nation.join(nation.select("n_nationkey"), "n_nationkey", "left_semi")


@query("column_subset", "select o_orderpriority, o_totalprice from orders")
def column_subset(spark, source):
    return read_layer(spark, source, "orders", "o_orderpriority string, o_totalprice double")


@query(
    "column_map",
    "select o_orderkey as fid, o_totalprice as amount, o_orderstatus as state, o_orderdate as leaves from orders",
)
def column_map(spark, source):
    return read_layer(
        spark,
        source,
        "orders",
        "fid bigint, amount double, state string, leaves timestamp_ntz",
        column_names={"amount": "o_totalprice", "state": "o_orderstatus", "leaves": "o_orderdate"},
        fid_column="o_orderkey",
    )


@query(
    "column_match",
    'select o_orderkey as fid, o_totalprice as "O_TotalPrice", o_orderstatus as order_status, '
    "o_orderpriority as n1_priority from orders",
)
def column_match(spark, source):
    orders = read_layer(spark, source, "orders").withColumnsRenamed(
        {"o_orderkey": "fid", "o_orderstatus": "Order-Status", "o_orderpriority": "1 priority"}
    )
    return as_layer(orders, "fid bigint, O_TotalPrice double, order_status string, n1_priority string")


@query(
    "column_unmatched",
    "select s_name, cast(null as integer) as floors, cast(null as varchar) as note from supplier",
)
def column_unmatched(spark, source):
    return read_layer(spark, source, "supplier", "s_name string, floors int, note varchar(20)")


@query("srid_stamp", "select c_custkey as fid, 4326 as srid from customer")
def srid_stamp(spark, source):
    layer = encode_points(points(spark, source).drop("geom_bbox"), "x", "y")
    stamped = stamp_srid(layer, 4326)
    return stamped.select("fid", srid_of(stamped).alias("srid"))


@query(
    "filter_mapped",
    'select o_orderkey as fid, o_orderpriority as "rank" from orders where o_orderpriority = \'1-URGENT\'',
)
def filter_mapped(spark, source):
    mapped = read_layer(
        spark,
        source,
        "orders",
        "fid bigint, rank string",
        column_names={"rank": "O_ORDERPRIORITY"},
        fid_column="o_orderkey",
    )
    return mapped.filter(F.col("rank") == "1-URGENT")
