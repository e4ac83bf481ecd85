"""Queries: insert, update and delete."""

from pyspark.sql import functions as F

from geolayers.operators import dml
from geolayers.plans.registry import query
from geolayers.session import shared_path
from geolayers.sources.layers import read_layer
from geolayers.sources.stored import delete_stored, insert_stored, read_ranges, update_stored, write_ranges

CUSTOMERS = "select c_custkey as fid, c_name as name, c_nationkey as nation, c_acctbal as balance from customer"
NEW = "select s_name as name, s_nationkey as nation, s_acctbal as balance, s_suppkey from supplier"


def customers(spark, source):
    return read_layer(
        spark,
        source,
        "customer",
        "fid bigint, name string, nation int, balance double",
        column_names={"name": "c_name", "nation": "c_nationkey", "balance": "c_acctbal"},
        fid_column="c_custkey",
    )


def suppliers(spark, source):
    return read_layer(spark, source, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
        "s_suppkey",
    )


INSERTED = f"""select (select max(c_custkey) from customer) + row_number() over (order by s_suppkey) as fid,
  name, nation, cast(null as double) as balance from ({NEW})"""


@query("dml_insert", f"{CUSTOMERS} union all {INSERTED}")
def dml_insert(spark, source):
    new = suppliers(spark, source).drop("balance")
    return dml.insert(customers(spark, source), new, order_by=["s_suppkey"])[0]


@query("dml_insert_returning", INSERTED)
def dml_insert_returning(spark, source):
    new = suppliers(spark, source).drop("balance")
    return dml.insert(customers(spark, source), new, order_by=["s_suppkey"])[1]


@query(
    "dml_update",
    f"select c.fid, coalesce(o.name, c.name) as name, c.nation, case when o.fid is null then c.balance "
    f"else o.spent end as balance from ({CUSTOMERS}) c left join (select o_custkey as fid, "
    "'Buyer ' || count(*) as name, case when count(*) > 5 then null else cast(count(*) as double) end as spent "
    "from orders group by o_custkey) o on c.fid = o.fid",
)
def dml_update(spark, source):
    orders = read_layer(spark, source, "orders", "o_custkey bigint").groupBy("o_custkey").agg(F.count("*").alias("n"))
    changes = orders.select(
        F.col("o_custkey").alias("fid"),
        F.concat(F.lit("Buyer "), F.col("n").cast("string")).alias("name"),
        F.when(F.col("n") <= 5, F.col("n").cast("double")).alias("balance"),
    )
    return dml.update(customers(spark, source), changes)


@query(
    "dml_update_where",
    "select fid, case when balance < 0 then 'Debtor' else name end as name, nation, "
    f"case when balance < 0 then 0 else balance end as balance from ({CUSTOMERS})",
)
def dml_update_where(spark, source):
    values = {"name": F.lit("Debtor"), "balance": F.lit(0)}
    return dml.update_where(customers(spark, source), F.col("balance") < 0, values)


@query("dml_delete", f"select * from ({CUSTOMERS}) where fid not in (select o_custkey from orders where o_totalprice > 300000)")
def dml_delete(spark, source):
    orders = read_layer(spark, source, "orders", "o_custkey bigint, o_totalprice double")
    keys = orders.filter(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("fid"))
    return dml.delete(customers(spark, source), keys)


@query("dml_delete_where", f"select * from ({CUSTOMERS}) where not (nation = 3 or balance > 100)")
def dml_delete_where(spark, source):
    return dml.delete_where(customers(spark, source), (F.col("nation") == 3) | (F.col("balance") > 100))


@query("dml_delete_returning", f"select * from ({CUSTOMERS}) where fid in (select o_custkey from orders)")
def dml_delete_returning(spark, source):
    keys = read_layer(spark, source, "orders", "o_custkey bigint").select(F.col("o_custkey").alias("fid"))
    return dml.returning(customers(spark, source), keys)


LOG = """select o_custkey as fid, max(o_orderkey) as n,
  arg_max(o_orderstatus, o_orderkey) filter (o_orderstatus <> 'O') as base from orders group by o_custkey"""


@query(
    "dml_log",
    f"""select c.fid, case when n is null then c.name else 'Order ' || n end as name,
      case when base is null then c.nation end as nation, case when base is null then c.balance end as balance
    from ({CUSTOMERS}) c left join ({LOG}) l on c.fid = l.fid where base is null or base = 'P'
    union all select (select max(c_custkey) from customer) + row_number() over (order by o_orderkey),
      'Order ' || o_orderkey, null, null from orders where o_orderkey % 50 = 0""",
)
def dml_log(spark, source):
    """Orders as a log: an open one renames its customer, a finished one deletes it, a pending one inserts it anew; some add features."""
    orders = read_layer(spark, source, "orders", "o_custkey bigint, o_orderkey bigint, o_orderstatus string")
    op = F.when(F.col("o_orderstatus") == "F", "delete").when(F.col("o_orderstatus") == "P", "insert").otherwise("update")
    log = orders.select(F.col("o_custkey").alias("fid"), op.alias("op"), F.col("o_orderkey").alias("seq"))
    added = orders.filter("o_orderkey % 50 = 0").select(F.lit(None).cast("bigint").alias("fid"), F.lit("insert").alias("op"), F.col("o_orderkey").alias("seq"))
    log = log.unionByName(added).withColumn("name", F.concat(F.lit("Order "), F.col("seq").cast("string")))
    return dml.apply_log(customers(spark, source), log)


STORED_CHANGES = "select o_custkey as fid, 'Buyer ' || count(*) as name from orders where o_custkey % 1000 < 300 group by o_custkey"


@query(
    "dml_update_stored",
    f"select c.fid, coalesce(o.name, c.name) as name, c.nation, c.balance from ({CUSTOMERS}) c "
    f"left join ({STORED_CHANGES}) o on c.fid = o.fid",
)
def dml_update_stored(spark, source):
    """Changes in place: of each thousand ids only the first ranges are written again."""
    path = shared_path(spark, "ranges")
    write_ranges(customers(spark, source), path, ids=100)
    orders = read_layer(spark, source, "orders", "o_custkey bigint").filter("o_custkey % 1000 < 300")
    changes = orders.groupBy(F.col("o_custkey").alias("fid")).agg(F.concat(F.lit("Buyer "), F.count("*").cast("string")).alias("name"))
    update_stored(spark, path, changes)
    return read_ranges(spark, path)


@query(
    "dml_delete_stored",
    f"select * from ({CUSTOMERS}) where fid % 1000 not between 200 and 399 "
    f"union all select s_suppkey + 5000000, s_name, s_nationkey, s_acctbal from supplier",
)
def dml_delete_stored(spark, source):
    """Whole ranges go, and rows of new ids come as new files."""
    path = shared_path(spark, "ranges")
    layer = customers(spark, source)
    write_ranges(layer, path, ids=100)
    delete_stored(spark, path, layer.filter("fid % 1000 between 200 and 399"))
    new = suppliers(spark, source).withColumnRenamed("s_suppkey", "fid").withColumn("fid", F.col("fid") + 5000000)
    insert_stored(spark, path, new)
    return read_ranges(spark, path)
