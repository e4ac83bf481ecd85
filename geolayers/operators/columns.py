"""Matching of declared columns to the fields of a layer."""

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F, types as T

from geolayers.functions.names import launder_name
from geolayers.functions.values import coerce_read
from geolayers.model import Field, LayerError, box_name, declare, is_geometry

FID = "fid"


def is_fid(field: Field) -> bool:
    """A column named fid, in any case, of type int or bigint is the feature id."""
    return field.name.lower() == FID and isinstance(field.type, (T.IntegerType, T.LongType))


WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def fid_of(schema: T.StructType, fid_column: str | None = None) -> str | None:
    """Name of the layer's own id column, if it has one.

    It is the named one, else a column fid of whole numbers; a column fid of another
    type, as every CSV column is, is an ordinary field.
    """
    wanted = (fid_column or FID).lower()
    for field in schema:
        if field.name.lower() == wanted and (fid_column or isinstance(field.dataType, WHOLE_NUMBERS)):
            return field.name
    if fid_column:
        raise LayerError(f'layer has no column "{fid_column}" to serve as feature id')
    return None


def _field_index(schema: T.StructType, hidden: set[str]) -> dict[str, T.StructField]:
    """Lower-case raw and laundered names of the layer's fields; raw names win."""
    index: dict[str, T.StructField] = {}
    fields = [f for f in schema if f.name not in hidden]
    for name_of in (lambda f: f.name.lower(), lambda f: launder_name(f.name)):
        for field in fields:
            index.setdefault(name_of(field), field)
    clash = [n for n, k in Counter(f.name.lower() for f in fields).items() if k > 1]
    if clash:
        raise LayerError(f"fields {clash} are there more than once, in different case")
    return index


def match_columns(
    schema: T.StructType,
    declared: list[Field],
    table: str,
    fid: Column | None = None,
    fid_column: str | None = None,
    null_elements: bool = True,
) -> list[Column]:
    """One select expression per declared column, plus the box of each geometry.

    ``fid`` is the feature id of the layer.  Geometry columns bind by position,
    other columns by name; what matches nothing reads NULL.
    """
    geometries = [f for f in schema if is_geometry(f)]
    hidden = {f.name for f in geometries} | {box_name(f.name) for f in geometries}
    if fid_column is None and fid_of(schema) == FID:
        hidden.add(FID)
    index = _field_index(schema, hidden)
    waiting = list(geometries)
    out: list[Column] = []
    fids = 0
    for field in declared:
        if is_fid(field):
            fids += 1
            if fids > 1:
                raise LayerError(f'layer "{table}" declares more than one fid column')
            out.append((fid if fid is not None else F.lit(None)).cast(field.type).alias(field.name))
        elif waiting and isinstance(field.type, T.BinaryType):
            geometry = waiting.pop(0)
            out.append(F.col(f"`{geometry.name}`").alias(field.name, metadata=geometry.metadata))
            if box_name(geometry.name) in schema.names:
                out.append(F.col(f"`{box_name(geometry.name)}`").alias(box_name(field.name)))
        else:
            found = index.get((field.source or field.name).lower())
            if found is None:
                value = F.lit(None).cast(plain_type(field.type))
            else:
                value = coerce_read(
                    F.col(f"`{found.name}`"), found.dataType, field.type, field.name, table, null_elements
                )
            out.append(value.alias(field.name))
    return out


def as_layer(
    df: DataFrame, columns, column_names: dict[str, str] | None = None, table: str = "?", null_elements: bool = True
) -> DataFrame:
    """Any DataFrame with the declared columns, matched as for a layer."""
    own = fid_of(df.schema)
    fid = F.col(f"`{own}`") if own else None
    declared = declare(columns, column_names)
    return df.select(match_columns(df.schema, declared, table, fid, null_elements=null_elements))


def plain_type(data_type: T.DataType) -> T.DataType:
    """Type of a column of NULLs; text of any declared width is a string."""
    if isinstance(data_type, (T.VarcharType, T.CharType)):
        return T.StringType()
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(plain_type(data_type.elementType))
    return data_type
