"""Queries: layer discovery, schema import, feature ids and counts."""

import uuid

from pyspark.sql import functions as F

from geolayers.plans.registry import query
from geolayers.session import shared_path
from geolayers.sources.catalog import import_layers, layer_catalog
from geolayers.sources.fids import assign_fid, lookup_fids
from geolayers.sources.layers import layer_count, read_layer

LAYERS = """('region'), ('nation'), ('customer'), ('supplier'), ('part'), ('orders'), ('lineitem'), ('events'),
    ('documents'), ('embeddings'), ('pages'), ('benchmark'), ('labels'), ('conversations')"""
COLUMNS = f"""
  with layers(layer) as (values {LAYERS}),
  fields as (
    select table_name as layer, ordinal_position + 1 as ordinal, column_name, case data_type
      when 'BIGINT' then 'bigint' when 'INTEGER' then 'integer' when 'VARCHAR' then 'varchar'
      when 'DOUBLE' then 'double precision' when 'TIMESTAMP' then 'timestamp'
      when 'FLOAT[]' then 'double precision[]' else data_type end as data_type
    from information_schema.columns where table_name in (select layer from layers)
    union all select layer, 1, 'fid', 'bigint' from layers)
  select layer, layer as table_name, cast(ordinal as integer) as ordinal, column_name, data_type,
    cast(null as varchar) as column_option from fields"""
SHOWN = ["layer", "table_name", "ordinal", "column_name", "data_type", "column_option"]


@query("layer_import", COLUMNS)
def layer_import(spark, source):
    return layer_catalog(spark, source).select(SHOWN)


@query("layer_import_limit", f"select * from ({COLUMNS}) where layer in ('customer', 'orders')")
def layer_import_limit(spark, source):
    return layer_catalog(spark, source, limit_to=["customer", "orders"]).select(SHOWN)


@query("layer_import_except", f"select * from ({COLUMNS}) where layer not in ('customer', 'orders')")
def layer_import_except(spark, source):
    return layer_catalog(spark, source, except_=["customer", "orders"]).select(SHOWN)


@query("layer_import_prefix", f"select * from ({COLUMNS}) where layer like 'p%'")
def layer_import_prefix(spark, source):
    return layer_catalog(spark, source, prefix="p", launder_table_names=False, launder_column_names=False).select(SHOWN)


@query(
    "fid_scan",
    "select count(*) as n, min(fid) as low, max(fid) as high, count(distinct fid) as fids "
    "from (select row_number() over () - 1 as fid from lineitem)",
)
def fid_scan(spark, source):
    return _facts(read_layer(spark, source, "lineitem", "fid bigint, l_orderkey bigint"))


@query(
    "fid_lookup",
    "select fid, l_orderkey, l_linenumber from "
    "(select row_number() over () - 1 as fid, l_orderkey, l_linenumber from lineitem) where fid in (0, 77, 4999)",
)
def fid_lookup(spark, source):
    found = lookup_fids(read_layer(spark, source, "lineitem"), [0, 77, 4999, -1, 1 << 40])
    return found.select("fid", "l_orderkey", "l_linenumber")


@query(
    "fid_assign",
    "select count(*) as n, min(fid) as low, max(fid) as high, count(distinct fid) as fids "
    "from (select row_number() over () + 99 as fid from orders)",
)
def fid_assign(spark, source):
    return _facts(assign_fid(read_layer(spark, source, "orders").repartition("o_orderkey"), 100))


@query(
    "fid_assign_ordered",
    "select row_number() over (order by o_totalprice, o_orderkey) as fid, o_orderkey from orders",
)
def fid_assign_ordered(spark, source):
    orders = read_layer(spark, source, "orders", "o_orderkey bigint, o_totalprice double")
    return assign_fid(orders, 1, ["o_totalprice", "o_orderkey"]).select("fid", "o_orderkey")


def _facts(layer):
    return layer.agg(
        F.count("*").alias("n"),
        F.min("fid").alias("low"),
        F.max("fid").alias("high"),
        F.countDistinct("fid").alias("fids"),
    )


@query("layer_count", "select count(*) as features from lineitem")
def count_layer(spark, source):
    return layer_count(spark, source, "lineitem")


@query(
    "csv_import",
    """with parts as (
      select c_custkey, c_custkey % 3 as part from customer
    )
    select row_number() over (order by part, c_custkey) as fid, cast(c_custkey as varchar) as key,
      case when part < 2 then c_name end as name, case when part > 0 then cast(c_nationkey as varchar) end as nation
    from customer join parts using (c_custkey)""",
)
def csv_import(spark, source):
    """Part files with swapped, late and missing columns, read through the view of an import."""
    layer = read_layer(spark, source, "customer", "c_custkey bigint, c_name string, c_nationkey int")
    layer = layer.select(F.col("c_custkey").alias("Key"), F.col("c_name").alias("Name"), F.col("c_nationkey").alias("Nation"))
    root = shared_path(spark, "csv")
    for part, columns in enumerate((["Key", "Name"], ["Nation", "Name", "Key"], ["Key", "Nation"])):
        rows = layer.filter(F.col("Key") % 3 == part).select(columns)
        ordered = rows.repartitionByRange("Key").sortWithinPartitions("Key")
        ordered.write.option("header", "true").option("compression", "gzip" if part == 1 else "none").csv(f"{root}/buyers/{part}")
    import_layers(spark, root)
    return spark.table("buyers").select("fid", "key", "name", "nation")


@query(
    "view_scan",
    """with o as (select row_number() over () - 1 as fid, * from orders), c as (select row_number() over () - 1 as fid, * from customer)
    select o.fid, o_orderkey, c.fid as customer, c_name from o join c on o_custkey = c_custkey where o_totalprice > 100000""",
)
def view_scan(spark, source):
    """Imported views with the ids of their rows."""
    import_layers(spark, source, limit_to=["orders", "customer"])
    orders, customers = spark.table("orders"), spark.table("customer").withColumnRenamed("fid", "customer")
    found = orders.filter("o_totalprice > 100000").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return found.select("fid", "o_orderkey", "customer", "c_name")


@query(
    "layer_widened",
    """select o_orderkey as key, case when o_orderkey % 3 = 0 then floor(o_totalprice) else o_totalprice end as price,
      case when o_orderkey % 3 = 0 then cast(cast(o_orderdate as date) as timestamp) else cast(o_orderdate as timestamp) end as day,
      case when o_orderkey % 3 = 2 then o_orderstatus else cast(o_custkey as varchar) end as mark,
      case when o_orderkey % 3 = 2 then o_orderpriority end as late
    from orders""",
)
def layer_widened(spark, source):
    """Part files of three schemas: whole and broken numbers, days and times, numbers and text, a late column."""
    orders = read_layer(spark, source, "orders")
    key, price, day = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate")
    path = f"{shared_path(spark, 'widened')}/orders.parquet"
    kinds = [
        [key.cast("int").alias("key"), F.floor(price).cast("bigint").alias("price"), day.cast("date").alias("day"), F.col("o_custkey").alias("mark")],
        [key.alias("key"), price.alias("price"), day.cast("timestamp_ntz").alias("day"), F.col("o_custkey").cast("int").alias("mark")],
        [key.alias("key"), price.alias("price"), day.cast("timestamp_ntz").alias("day"), F.col("o_orderstatus").alias("mark"), F.col("o_orderpriority").alias("late")],
    ]
    for part, columns in enumerate(kinds):
        orders.filter(key % 3 == part).select(columns).write.mode("append").parquet(path)
    return read_layer(spark, path.rpartition("/")[0], "orders", "key bigint, price double, day timestamp_ntz, mark string, late string", widened=True)


@query(
    "import_tables",
    """with o as (select row_number() over () - 1 as fid, * from orders)
    select o.fid, o_orderkey, l_linenumber, l_quantity from o join lineitem on l_orderkey = o_orderkey where o_orderkey <= 100""",
)
def import_tables(spark, source):
    """Views over external tables, whose statistics let the optimiser choose the side of a join that is broadcast."""
    database = f"layers_{uuid.uuid4().hex}"
    import_layers(spark, source, limit_to=["orders", "lineitem"], database=database, analysed=["o_orderkey", "l_orderkey"])
    orders, lines = spark.table("orders"), spark.table("lineitem").drop("fid")
    found = orders.filter("o_orderkey <= 100").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    return found.select("fid", "o_orderkey", "l_linenumber", "l_quantity")
