"""Queries: Spark's own operators on layers."""

from pyspark.sql import functions as F

from geolayers.plans.registry import query
from geolayers.sources.layers import read_layer
from geolayers.sources.stored import store_bucketed


def customers(spark, source):
    columns = "fid bigint, c_name string, c_nationkey int, c_mktsegment string"
    return read_layer(spark, source, "customer", columns, fid_column="c_custkey")


@query(
    "join_fid",
    "select c_custkey as fid, c_name, o_orderkey from customer join orders on c_custkey = o_custkey",
)
def join_fid(spark, source):
    orders = read_layer(spark, source, "orders", "o_orderkey bigint, o_custkey bigint")
    local = orders.withColumnRenamed("o_custkey", "fid")
    return customers(spark, source).join(local, "fid").select("fid", "c_name", "o_orderkey")


@query(
    "join_fid_bucketed",
    "select c_custkey as fid, c_name, count(*) as orders, max(o_totalprice) as dearest "
    "from customer join orders on c_custkey = o_custkey group by 1, 2",
)
def join_fid_bucketed(spark, source):
    """Both layers stored in buckets of the id: joined and grouped without a shuffle."""
    orders = read_layer(spark, source, "orders", "o_custkey bigint, o_totalprice double")
    local = store_bucketed(orders.withColumnRenamed("o_custkey", "fid"))
    layer = store_bucketed(customers(spark, source))
    joined = layer.hint("merge").join(local, "fid").groupBy("fid", "c_name")
    return joined.agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("dearest"))


@query(
    "join_series",
    "select c_custkey as fid, c_name from generate_series(1, (select max(c_custkey) from customer)) g(g) "
    "join customer on c_custkey = g.g",
)
def join_series(spark, source):
    layer = customers(spark, source)
    last = layer.agg(F.max("fid").alias("last")).first()["last"]
    series = spark.range(1, last + 1).withColumnRenamed("id", "fid")
    return layer.join(series, "fid").select("fid", "c_name")


@query(
    "string_agg",
    "select o_custkey as fid, string_agg(mark, ',' order by mark) as marks from "
    "(select o_custkey, nullif(o_orderpriority, '5-LOW') as mark from orders) group by o_custkey",
)
def string_agg(spark, source):
    orders = read_layer(spark, source, "orders", "o_custkey bigint, o_orderpriority string").select(
        F.col("o_custkey").alias("fid"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("mark")
    )
    # Equal values are counted on the map side, so few rows of a busy group meet;
    # each is then written as often as it was there.
    values = orders.groupBy("fid", "mark").agg(F.count("*").cast("int").alias("n"))
    times = F.array_join(F.array_repeat("mark", F.col("n")), ",")
    values = values.filter("mark is not null").select("fid", "mark", times.alias("text"))
    found = values.groupBy("fid").agg(F.expr("listagg(text, ',') within group (order by mark)").alias("marks"))
    return orders.select("fid").distinct().join(found, "fid", "left")


@query("order_by", "select c_custkey as fid, c_name from customer order by c_name, c_custkey")
def order_by(spark, source):
    return customers(spark, source).select("fid", "c_name").orderBy("c_name", "fid")
