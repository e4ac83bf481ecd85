"""Queries: attribute predicates, all pushed to the scan where Parquet can."""

from pyspark.sql import functions as F

from geolayers.operators.spatial import encode_points
from geolayers.plans.layers import POINTS, points
from geolayers.plans.registry import query
from geolayers.session import shared_path
from geolayers.sources.layers import read_layer, write_layer

ORDER_COLUMNS = "fid bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
ORDERS = "select o_orderkey as fid, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders"


def orders(spark, source):
    return read_layer(spark, source, "orders", ORDER_COLUMNS, fid_column="o_orderkey")


@query("filter_eq", f"{ORDERS} where o_orderstatus = 'F'")
def filter_eq(spark, source):
    return orders(spark, source).filter(F.col("o_orderstatus") == "F")


@query("filter_ne", f"{ORDERS} where o_orderstatus <> 'F'")
def filter_ne(spark, source):
    return orders(spark, source).filter(F.col("o_orderstatus") != "F")


@query("filter_range", f"{ORDERS} where o_totalprice >= 1000.5 and o_totalprice < 90000 and o_orderkey > 10")
def filter_range(spark, source):
    price = F.col("o_totalprice")
    return orders(spark, source).filter((price >= 1000.5) & (price < 90000) & (F.col("fid") > 10))


@query("filter_like", f"{ORDERS} where o_orderpriority like '1-%' or o_orderpriority like '%low%'")
def filter_like(spark, source):
    rank = F.col("o_orderpriority")
    return orders(spark, source).filter(rank.like("1-%") | rank.like("%low%"))


@query("filter_ilike", f"{ORDERS} where o_orderpriority ilike '%urgent' or o_orderpriority ilike '5-l_w'")
def filter_ilike(spark, source):
    rank = F.col("o_orderpriority")
    return orders(spark, source).filter(rank.ilike("%urgent") | rank.ilike("5-l_w"))


@query(
    "filter_null",
    "with o as (select o_orderkey as fid, nullif(o_orderpriority, '5-LOW') as mark, o_orderstatus from orders) "
    "select * from o where mark is null union all select * from o where mark is not null and o_orderstatus = 'P'",
)
def filter_null(spark, source):
    marked = orders(spark, source).select(
        "fid", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("mark"), "o_orderstatus"
    )
    mark = F.col("mark")
    return marked.filter(mark.isNull() | (mark.isNotNull() & (F.col("o_orderstatus") == "P")))


@query(
    "filter_and_or",
    f"{ORDERS} where (o_orderstatus = 'F' and o_totalprice < 50000) or (o_orderpriority = '2-HIGH' "
    "and (o_totalprice > 100000 or o_orderdate < timestamp '1994-01-01'))",
)
def filter_and_or(spark, source):
    price, rank = F.col("o_totalprice"), F.col("o_orderpriority")
    early = F.col("o_orderdate") < F.expr("timestamp_ntz'1994-01-01'")
    return orders(spark, source).filter(
        ((F.col("o_orderstatus") == "F") & (price < 50000)) | ((rank == "2-HIGH") & ((price > 100000) | early))
    )


@query("filter_not", f"{ORDERS} where not (o_orderstatus = 'O' or o_totalprice > 20000)")
def filter_not(spark, source):
    return orders(spark, source).filter(~((F.col("o_orderstatus") == "O") | (F.col("o_totalprice") > 20000)))


@query(
    "filter_in",
    f"{ORDERS} where o_orderpriority in ('1-URGENT', '4-NOT SPECIFIED') "
    "and nullif(o_orderstatus, 'P') is distinct from 'O' and lower(o_orderstatus) <> 'x'",
)
def filter_in(spark, source):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return orders(spark, source).filter(
        F.col("o_orderpriority").isin("1-URGENT", "4-NOT SPECIFIED")
        & ~status.eqNullSafe("O")
        & (F.lower("o_orderstatus") != "x")
    )


@query(
    "filter_date",
    f"{ORDERS} where o_orderdate > timestamp '1995-03-15 00:00:00' and o_orderdate <= timestamp '1997-01-01 00:00:00'",
)
def filter_date(spark, source):
    day = F.col("o_orderdate")
    return orders(spark, source).filter(
        (day > F.expr("timestamp_ntz'1995-03-15 00:00:00'")) & (day <= F.expr("timestamp_ntz'1997-01-01 00:00:00'"))
    )


@query(
    "filter_quote",
    "select fid, label from (select o_orderkey as fid, concat(o_orderstatus, '''s \\ \"', o_orderpriority) as label "
    "from orders) where label = 'F''s \\ \"1-URGENT' and true",
)
def filter_quote(spark, source):
    labelled = orders(spark, source).select(
        "fid", F.concat("o_orderstatus", F.lit("'s \\ \""), "o_orderpriority").alias("label")
    )
    return labelled.filter((F.col("label") == "F's \\ \"1-URGENT") & F.lit(True))


@query("filter_fid", f"{ORDERS} where o_orderkey = 77 or o_orderkey >= 400")
def filter_fid(spark, source):
    return orders(spark, source).filter((F.col("fid") == 77) | (F.col("fid") >= 400))


@query("filter_fid_stored", f"with {POINTS} select fid, name, x, y from points where fid in (7, 77, 149, 1000000000000)")
def filter_fid_stored(spark, source):
    """Features by id from a layer that is stored by place: Bloom filters leave out row groups without the ids."""
    root = shared_path(spark, "lookups")
    layer = encode_points(points(spark, source).drop("geom_bbox"), "x", "y", srid=4326)
    write_layer(layer, f"{root}/points.parquet", lookups=["fid", "name"])
    found = read_layer(spark, root, "points").filter(F.col("fid").isin(7, 77, 149, 10**12))
    return found.select("fid", "name", "x", "y")
