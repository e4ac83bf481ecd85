"""Attribute values between a layer's types and the declared types."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from geolayers.model import (
    LayerError,
    STORED_AS,
    check_readable,
    check_storable,
    declared_name,
    is_geometry,
    source_type,
)

# What a NULL list element reads as, if asked for.
LIST_DEFAULTS = {"IntegerList": 0, "Integer64List": 0, "RealList": 0.0, "StringList": ""}


def _bounded(text: Column, data_type: T.DataType) -> Column:
    """Length rule of varchar(n) and char(n): longer text is an error, char pads."""
    n = data_type.length
    fits = F.length(F.rtrim(text)) <= n
    fixed = isinstance(data_type, T.CharType)
    kept = F.rpad(text, n, " ") if fixed else F.substring(text, 1, n)
    return F.when(text.isNull() | fits, kept).otherwise(
        F.raise_error(F.concat(F.lit(f"value too long for {data_type.simpleString()}: "), text))
    )


def _as_text(value: Column, kind: str) -> Column:
    if kind == "Real":
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        value = value.cast("double")
        return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
    if kind == "DateTime":
        stamp = value.cast("timestamp_ntz").cast("string")
        return F.regexp_replace(stamp, " ", "T")
    if kind == "JSON":
        return F.to_json(value)
    if kind == "Boolean":
        return value.cast("int").cast("string")
    if kind == "Time":
        return F.time_trunc(F.lit("SECOND"), value).cast("string")
    return value.cast("string")


def _as_boolean(value: Column, kind: str) -> Column:
    if kind == "Boolean":
        return value
    return F.when(value.isNull() | value.isin(0, 1), value == 1).otherwise(
        F.raise_error(F.concat(F.lit("invalid boolean: "), value.cast("string")))
    )


def coerce_read(
    value: Column,
    source: T.DataType,
    declared: T.DataType,
    column: str = "?",
    table: str = "?",
    null_elements: bool = True,
) -> Column:
    """Value of a layer field as its declared type.

    Empty text is NULL for every declared type but text.  With
    ``null_elements=False`` the NULL elements of a list read as 0, '' or false.
    """
    check_readable(source, declared, column, table)
    kind, target = source_type(source), declared_name(declared)
    if kind.endswith("List"):
        if not null_elements:
            default = F.lit(LIST_DEFAULTS[kind]).cast(source.elementType.simpleString())
            value = F.transform(value, lambda x: F.coalesce(x, default))
        element = declared.elementType
        if isinstance(element, (T.VarcharType, T.CharType)):
            return F.transform(value, lambda x: _bounded(x.cast("string"), element))
        return value.cast(declared)
    if target in ("string", "varchar", "char"):
        text = _as_text(value, kind)
        return text if target == "string" else _bounded(text, declared)
    if target == "boolean":
        return _as_boolean(value, kind)
    if kind == "String":
        return F.parse_json(F.nullif(value, F.lit("")))
    if kind == "Time":
        return F.time_trunc(F.lit("SECOND"), value).cast(declared)
    return value.cast(declared)


def parse_text(value: Column, declared: T.DataType) -> Column:
    """Text of a source without types; empty text is NULL for all but text."""
    if isinstance(declared, (T.StringType, T.VarcharType, T.CharType)):
        return value if isinstance(declared, T.StringType) else _bounded(value, declared)
    present = F.nullif(value, F.lit(""))
    if isinstance(declared, T.VariantType):
        return F.parse_json(present)
    return present.cast(declared)


def rounded_second(stamp: Column) -> Column:
    """Timestamp rounded to the second as a whole, so 59.6 s carries over.

    The zone-free type is kept throughout: date_trunc() would pass through the
    session's zone and move times that a clock change skips.
    """
    moved = stamp.cast("timestamp_ntz") + F.expr("INTERVAL 500 MILLISECONDS")
    fraction = F.extract(F.lit("SECOND"), moved) % 1
    return moved - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


def time_text(stamp: Column) -> Column:
    """Time of day in whole seconds, from the text of the timestamp."""
    clock = F.substring_index(rounded_second(stamp).cast("string"), " ", -1)
    return F.substring(clock, 1, 8)


def coerce_write(value: Column, data_type: T.DataType, column: str = "?", table: str = "?", stored=None) -> Column:
    """Value as the layer stores it; ``stored`` asks for a certain layer type."""
    target = declared_name(data_type)
    if target not in STORED_AS:
        raise LayerError(f'column "{column}" of layer "{table}" has unsupported type {data_type.simpleString()}')
    stored = stored or STORED_AS[target]
    check_storable(data_type, stored, column, table)
    if stored.endswith("List"):
        element = {"Integer": "int", "Integer64": "bigint", "Real": "double", "String": "string"}
        kept = F.filter(value, lambda x: x.isNotNull())
        return kept.cast(f"array<{element[stored[:-4]]}>")
    if target == "variant":
        return F.to_json(value)
    if stored == "DateTime":
        return rounded_second(value)
    if stored == "Time":
        # Rounded like other times, but the last half second of a day stays in it.
        moved = F.time_trunc(F.lit("SECOND"), value + F.expr("INTERVAL 500 MILLISECONDS"))
        return F.when(value >= F.expr("TIME '23:59:59.5'"), F.expr("TIME '23:59:59'")).otherwise(moved)
    simple = {"Integer": "int", "Integer64": "bigint", "Real": "double", "String": "string"}
    return value.cast(simple[stored]) if stored in simple else value


def write_columns(df: DataFrame, table: str = "?") -> DataFrame:
    """All attribute columns of ``df`` as the layer stores them."""
    out = []
    for field in df.schema:
        name = F.col(f"`{field.name}`")
        if is_geometry(field) or isinstance(field.dataType, T.StructType):
            out.append(name)
        else:
            out.append(coerce_write(name, field.dataType, field.name, table).alias(field.name))
    return df.select(out)
