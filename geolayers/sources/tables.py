"""Layers as external tables of the session catalog, with statistics for the optimiser."""

import re

from pyspark.sql import SparkSession, types as T

from geolayers.sources.parts import Layer

# Types of which Spark keeps statistics by column.
COUNTED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.BinaryType)
# Fixed value: names of tables that the session catalog takes.
NAME = re.compile(r"[A-Za-z0-9_]+")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def can_be_table(layer: Layer, table: str) -> bool:
    """Is the layer one Parquet scan, all files of the same types, and ``table`` a name that the catalog takes?"""
    return layer.fmt == "parquet" and not layer.mixed() and NAME.fullmatch(table) is not None


def register_table(spark: SparkSession, layer: Layer, database: str, table: str, analysed: list[str] | None = None) -> str:
    """An external table over a layer's files; returns its quoted name. A table of that name is replaced, files stay.

    The table is counted, and of its columns named in ``analysed`` (None: all) extremes, NULLs, widths and
    different values are estimated, in one scan of these columns; with an empty list only its bytes are known.
    Columns of which Spark keeps no statistics are passed over.
    """
    name = f"{quoted(database)}.{quoted(table)}"
    parted = [f.name for f in layer.partitions]
    columns = ", ".join(f"{quoted(f.name)} {_ddl(f.dataType)}" for f in layer.schema)
    by = f" PARTITIONED BY ({', '.join(map(quoted, parted))})" if parted else ""
    root = layer.root.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{root}'")
    if parted:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    wanted = [f.name for f in layer.schema if isinstance(f.dataType, COUNTED) and (analysed is None or f.name in analysed)]
    if analysed == []:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    elif wanted:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(map(quoted, wanted))}")
    else:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    return name


def _ddl(kind: T.DataType) -> str:
    """A type as it is declared, with the names of its fields quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"{quoted(f.name)}: {_ddl(f.dataType)}" for f in kind) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_ddl(kind.keyType)}, {_ddl(kind.valueType)}>"
    return kind.simpleString()
