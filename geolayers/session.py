"""What the package needs to know about the Spark session it runs in."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Sizes of fixed-width values in bytes, for measuring rows before a broadcast.
FIXED_WIDTH = 16

# Folders of intermediate tables by application.
_made: dict[str, list[str]] = {}


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder that the cluster names for checkpoints.

    Without one, intermediate tables go below the session's warehouse, unless that is a
    folder of one machine and the executors are others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir") + "/geolayers"
        if not spark.sparkContext.master.startswith("local") and (root.startswith("file:") or ":" not in root):
            raise RuntimeError("executors need a shared folder: set spark.checkpoint.dir")
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_staged(spark: SparkSession) -> int:
    """Remove all intermediate tables of this application; returns their number.

    DataFrames that still read them end with it, so this belongs behind the last action.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(paths)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which ends its lineage."""
    spark = df.sparkSession
    path = shared_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def has_fixed_width(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(has_fixed_width(f.dataType) for f in data_type)
    return not isinstance(
        data_type, (T.StringType, T.VarcharType, T.CharType, T.BinaryType, T.ArrayType, T.MapType, T.VariantType)
    )


def row_bytes(df: DataFrame):
    """Column with the approximate width of each row in memory."""
    parts = []
    for field in df.schema:
        name = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(name), F.lit(0)) + F.lit(FIXED_WIDTH))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.VariantType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)))
        elif isinstance(field.dataType, T.StructType):
            parts.append(F.lit(FIXED_WIDTH * max(1, len(field.dataType.fields))))
        else:
            parts.append(F.lit(FIXED_WIDTH))
    return sum(parts, F.lit(FIXED_WIDTH)).cast("bigint")


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own bound on a broadcast side, in bytes (-1 switches it off)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if text.endswith("b"):
        text = text[:-1]
    if text and text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def broadcast_if_small(df: DataFrame, rows: int, size: int) -> DataFrame:
    """Hint a broadcast when the measured ``size`` is within the session's bound."""
    limit = broadcast_limit(df.sparkSession)
    return F.broadcast(df) if size <= limit and rows <= limit // FIXED_WIDTH else df
