"""Column declarations and the table of permitted type conversions."""

from dataclasses import dataclass

from pyspark.sql import types as T


class LayerError(ValueError):
    """A layer, column or type that cannot be used as declared."""


@dataclass(frozen=True)
class Field:
    """One declared column; ``source`` names the layer's field if it differs."""

    name: str
    type: T.DataType
    source: str | None = None


def declare(columns, column_names=None) -> list[Field]:
    """Fields from a DDL string, a StructType or a list of fields."""
    if isinstance(columns, str):
        columns = T.StructType.fromDDL(columns)
    if isinstance(columns, T.StructType):
        columns = [
            Field(f.name, f.dataType, (f.metadata or {}).get("column_name")) for f in columns
        ]
    names = column_names or {}
    return [Field(f.name, f.type, names.get(f.name, f.source)) for f in columns]


# --- geometry columns -----------------------------------------------------------

GEOMETRY = "geometry"  # metadata key of a geometry column


def box_name(geometry: str) -> str:
    """Name of the covering box column of a geometry column."""
    return f"{geometry}_bbox"


def geometry_metadata(srid: int | None = None, kind: str = "Geometry") -> dict:
    return {GEOMETRY: {"kind": kind, "srid": srid or 0}}


def is_geometry(field: T.StructField) -> bool:
    return GEOMETRY in (field.metadata or {})


# --- source types ---------------------------------------------------------------


def source_type(data_type: T.DataType) -> str:
    """Layer type of a Spark type."""
    if isinstance(data_type, T.ArrayType):
        element = source_type(data_type.elementType)
        element = "Integer" if element == "Boolean" else element
        if element in ("Integer", "Integer64", "Real", "String"):
            return element + "List"
    for spark_types, name in (
        (T.BooleanType, "Boolean"),
        ((T.ByteType, T.ShortType, T.IntegerType), "Integer"),
        (T.LongType, "Integer64"),
        ((T.FloatType, T.DoubleType, T.DecimalType), "Real"),
        ((T.StringType, T.CharType, T.VarcharType), "String"),
        (T.VariantType, "JSON"),
        (T.BinaryType, "Binary"),
        (T.DateType, "Date"),
        (T.TimeType, "Time"),
        ((T.TimestampType, T.TimestampNTZType), "DateTime"),
    ):
        if isinstance(data_type, spark_types):
            return name
    raise LayerError(f"type {data_type.simpleString()} has no layer type")


def declared_name(data_type: T.DataType) -> str:
    """Type name without its parameters, as used in the tables below."""
    if isinstance(data_type, T.ArrayType):
        return f"array<{declared_name(data_type.elementType)}>"
    return data_type.simpleString().split("(")[0]


# Declared types that each layer type can be read as.
READABLE_AS = {
    "Integer": ["boolean", "int", "bigint", "decimal", "float", "double", "string", "varchar"],
    "Integer64": ["bigint", "decimal", "double", "string", "varchar"],
    "Real": ["decimal", "float", "double", "string", "varchar"],
    "String": ["string", "varchar", "char", "variant"],
    "Binary": ["binary"],
    "Date": ["date", "timestamp", "timestamp_ntz", "string", "varchar"],
    "Time": ["time", "string", "varchar"],
    "DateTime": ["timestamp", "timestamp_ntz", "string", "varchar"],
    "IntegerList": [
        "array<boolean>",
        "array<smallint>",
        "array<int>",
        "array<bigint>",
        "array<string>",
        "array<varchar>",
    ],
    "Integer64List": ["array<bigint>", "array<double>", "array<string>", "array<varchar>"],
    "RealList": ["array<float>", "array<double>", "array<string>", "array<varchar>"],
    "StringList": ["array<string>", "array<varchar>", "array<char>"],
}
READABLE_AS["Boolean"] = READABLE_AS["Integer"]
READABLE_AS["JSON"] = READABLE_AS["String"]

# Layer type that each Spark type is stored as.
STORED_AS = {
    "boolean": "Integer",
    "smallint": "Integer",
    "int": "Integer",
    "bigint": "Integer64",
    "decimal": "Real",
    "float": "Real",
    "double": "Real",
    "string": "String",
    "varchar": "String",
    "char": "String",
    "variant": "String",
    "binary": "Binary",
    "date": "Date",
    "time": "Time",
    "timestamp": "DateTime",
    "timestamp_ntz": "DateTime",
    "array<boolean>": "IntegerList",
    "array<smallint>": "IntegerList",
    "array<int>": "IntegerList",
    "array<bigint>": "Integer64List",
    "array<float>": "RealList",
    "array<double>": "RealList",
    "array<string>": "StringList",
    "array<varchar>": "StringList",
    "array<char>": "StringList",
}

# Name that an imported column's type is given.
IMPORTED_AS = {
    "Boolean": "boolean",
    "Integer": "integer",
    "Integer64": "bigint",
    "Real": "double precision",
    "String": "varchar",
    "JSON": "jsonb",
    "Binary": "bytea",
    "Date": "date",
    "Time": "time",
    "DateTime": "timestamp",
    "IntegerList": "integer[]",
    "Integer64List": "bigint[]",
    "RealList": "double precision[]",
    "StringList": "varchar[]",
}


def check_readable(source: T.DataType, declared: T.DataType, column: str, table: str) -> None:
    kind = source_type(source)
    if declared_name(declared) not in READABLE_AS[kind]:
        raise LayerError(
            f'"{table}"."{column}": a {kind} field cannot be read as {declared.simpleString()}'
        )


def check_storable(data_type: T.DataType, stored: str, column: str, table: str) -> None:
    found = STORED_AS.get(declared_name(data_type))
    if found is None or found != stored:
        raise LayerError(
            f'"{table}"."{column}": {data_type.simpleString()} cannot be stored as {stored}'
        )
