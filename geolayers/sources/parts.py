"""Layers of many files: what each file holds, and one scan for the files that agree."""

import csv
import io
import json
import sys
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from geolayers.functions.text import charset
from geolayers.model import LayerError, is_geometry
from geolayers.session import staged
from geolayers.sources.files import inner_path, list_files, literal_path, open_file, open_text

# Spark reads an unquoted empty field as NULL; both kinds of empty field are ''
# in a layer, see read_layer().
CSV_OPTIONS = {"header": "true", "emptyValue": "", "nullValue": "\u0001"}
PART = "layer string, fmt string, root string, uri string, files array<string>, schema string, rows bigint"
LAYER = ["layer", "fmt", "root"]


# --- one file -----------------------------------------------------------------


def nullable(kind: T.DataType) -> T.DataType:
    """The type as a reader gives it: any element, value or field may be NULL."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True, f.metadata) for f in kind])
    return kind


def _parquet_part(path: str) -> tuple[T.StructType, int]:
    import pyarrow.parquet as pq

    with open_file(path) as handle:
        footer = pq.read_metadata(handle)
    arrow = footer.schema.to_arrow_schema()
    stored = (arrow.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    if stored:
        return nullable(T.StructType.fromJson(json.loads(stored))), footer.num_rows
    from pyspark.sql.pandas.types import from_arrow_schema

    return nullable(from_arrow_schema(arrow, prefer_timestamp_ntz=True)), footer.num_rows


def _csv_part(path: str, encoding: str, options: dict) -> T.StructType:
    """Names of a CSV header, read to its end under the reader's own options."""
    csv.field_size_limit(sys.maxsize)
    sep, quote = (options.get(k) for k in ("sep", "quote"))
    with open_text(path) as handle:
        text = io.TextIOWrapper(handle, "utf-8-sig" if encoding.upper() in ("UTF-8", "UTF8") else encoding, newline="")
        rows = csv.reader(text, delimiter=sep or options.get("delimiter") or ",", quotechar=quote or '"')
        names = next((row for row in rows if row), [])
    whole = str(options.get("multiline", "")).lower() == "true"
    if any("\n" in n for n in names) and not whole:
        raise LayerError(f"{path}: a column name goes over a line break; read it with multiLine=true")
    twice = sorted({n for n in names if [m.lower() for m in names].count(n.lower()) > 1}) if len({n.lower() for n in names}) < len(names) else []
    if twice:
        raise LayerError(f"{path}: columns {twice} are there more than once")
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_parts(files: DataFrame, encoding: str | None = None, options: dict | None = None) -> DataFrame:
    """``files`` (layer, fmt, root, uri, files) with each row's fields as JSON and, of Parquet, its rows; stored.

    Every footer and header is read, each by one row of a parallel job, so what only
    some files of a layer have is found.
    """
    from geolayers.sources.shapefile import layer_schema

    # A fixed number of partitions: adaptive execution would join so few bytes
    # into one task, but each row costs a file access.
    tasks = files.sparkSession.sparkContext.defaultParallelism
    options = {k.lower(): v for k, v in (options or {}).items()}
    encoding = charset(encoding or "UTF-8")

    def part(fmt, paths):
        if fmt == "shapefile":
            return layer_schema({p.rpartition(".")[2].lower(): p for p in paths}), None
        return _parquet_part(paths[0]) if fmt == "parquet" else (_csv_part(paths[0], encoding, options), None)

    def read(batches):
        for batch in batches:
            found = [part(fmt, paths) for fmt, paths in zip(batch["fmt"], batch["files"])]
            read = pd.DataFrame({"schema": [s.json() for s, _ in found], "rows": [n for _, n in found]}, dtype=object)
            yield pd.concat([batch.reset_index(drop=True), read], axis=1)

    opened = files.select(*LAYER, "uri", "files").repartition(tasks, F.element_at("files", 1))
    return staged(opened.mapInPandas(read, PART), "parts")


# --- files that differ --------------------------------------------------------

WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
TEXTS = (T.StringType, T.VarcharType, T.CharType)
SCALARS = (*WHOLE_NUMBERS, *FLOATS, *TIMES, *TEXTS, T.DecimalType, T.BooleanType, T.TimeType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds the values of both; None if there is none.

    Whole numbers widen to longer ones, then to double; a date to the timestamp it
    meets; all else that has one value to text.
    """
    if a == b:
        return a
    if not (isinstance(a, SCALARS) and isinstance(b, SCALARS)):
        return None
    if isinstance(a, WHOLE_NUMBERS) and isinstance(b, WHOLE_NUMBERS):
        return max(a, b, key=lambda t: WHOLE_NUMBERS.index(type(t)))
    numbers = (*WHOLE_NUMBERS, *FLOATS, T.DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, FLOATS) or isinstance(b, FLOATS):
            return T.DoubleType()
        # Of whole numbers the longest has 19 digits.
        places = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (19, 0) for t in (a, b)]
        whole, scale = (max(p[k] for p in places) for k in (0, 1))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if isinstance(a, TIMES) and isinstance(b, TIMES):
        others = {type(t) for t in (a, b)} - {T.DateType}
        return others.pop()() if len(others) == 1 else T.StringType()
    return T.StringType()


def merged_schema(schemas: list[T.StructType], layer: str) -> T.StructType:
    """One schema of a layer's files: fields in order of appearance, each as wide as its files need."""
    merged: dict[str, T.StructField] = {}
    for field in (f for schema in schemas for f in schema):
        known = merged.setdefault(field.name.lower(), field)
        if known.dataType == field.dataType:
            continue
        both = None if is_geometry(known) or is_geometry(field) else wider(known.dataType, field.dataType)
        if both is None:
            raise LayerError(f'layer "{layer}": files disagree on the type of "{field.name}"')
        # What is known of one file's values, such as their width, need not hold for the wider type.
        merged[field.name.lower()] = T.StructField(known.name, both)
    return T.StructType(list(merged.values()))


# How Spark writes values in the names of folders.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
KINDS = [
    ("int", r"^[+-]?\d+$", "int"),
    ("bigint", r"^[+-]?\d+$", "bigint"),
    ("double", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$", "double"),
    ("date", r"^\d{4}-\d\d-\d\d$", "date"),
    ("timestamp", r"^\d{4}-\d\d-\d\d( \d\d:\d\d:\d\d(\.\d+)?)?$", "timestamp"),
]


def partition_fields(parts: DataFrame) -> dict[tuple, list[T.StructField]]:
    """Of each layer, the columns that its folders' names hold, in their order, typed like Spark does.

    Values are looked at in the tasks; a column's name and type are all that comes to the driver.
    """
    path = F.element_at("files", 1)
    steps = F.split(F.substring(path, F.length("root") + 1, F.length(path)), "/")
    steps = F.filter(F.slice(steps, 1, F.size(steps) - 1), lambda s: F.contains(s, F.lit("=")))
    decoded = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    each = parts.filter("fmt <> 'shapefile'").select(*LAYER, F.posexplode(steps).alias("at", "step"))
    name, value = F.substring_index("step", "=", 1), F.regexp_replace("step", "^[^=]*=", "")
    each = each.select(*LAYER, "at", decoded(name).alias("name"), F.nullif(decoded(value), F.lit(NO_VALUE)).alias("value")).distinct()
    value = F.col("value")
    fits = [
        F.bool_and(F.when(value.isNotNull(), value.rlike(pattern) & value.try_cast(kind).isNotNull())).alias(key) for key, pattern, kind in KINDS
    ]
    found = each.groupBy(*LAYER, "name").agg(F.min("at").alias("at"), *fits)
    out: dict[tuple, list] = {}
    for row in found.orderBy("at", "name").collect():
        kind = next((kind for key, _, kind in KINDS if row[key]), "string")
        out.setdefault(tuple(row[c] for c in LAYER), []).append(T.StructField(row["name"], T.StructType.fromDDL(f"x {kind}")[0].dataType))
    return out


class Layer:
    """One layer of a source: its files' different schemas, first to last, and the merged one."""

    def __init__(self, name: str, fmt: str, root: str, schemas: list[str], partitions: list[T.StructField], files: list[str] | None):
        self.name, self.fmt, self.root, self.files = name, fmt, root, files
        self.parts = {text: T.StructType.fromJson(json.loads(text)) for text in schemas}
        self.partitions = partitions
        whole = merged_schema(list(self.parts.values()), name)
        known = {f.name.lower() for f in whole}
        self.schema = T.StructType([*whole, *(f for f in partitions if f.name.lower() not in known)])

    def scan_key(self, text: str) -> tuple:
        """Files with the same key are read by one scan: CSV by header, Parquet by the types of its fields."""
        part = self.parts[text]
        if self.fmt == "csv":
            return tuple(part.names)
        types = {f.name.lower(): f.dataType for f in self.schema}
        return tuple(sorted((f.name.lower(), f.dataType.json()) for f in part if types[f.name.lower()] != f.dataType))

    def mixed(self) -> bool:
        return self.fmt != "shapefile" and len({self.scan_key(text) for text in self.parts}) > 1


def layers_of(parts: DataFrame) -> list[Layer]:
    """The layers of stored ``parts``, in order of name; their different schemas come to the driver, their paths do not."""
    first = F.min(F.element_at("files", 1)).alias("first")
    shape_files = F.min(F.when(F.col("fmt") == "shapefile", F.col("files"))).alias("files")
    found = parts.groupBy(*LAYER, "schema").agg(first, shape_files).orderBy("layer", "fmt", "root", "first").collect()
    partitions = partition_fields(parts)
    grouped: dict[tuple, list] = {}
    for row in found:
        grouped.setdefault(tuple(row[c] for c in LAYER), []).append(row)
    return [Layer(*key, [r["schema"] for r in rows], partitions.get(key, []), rows[0]["files"]) for key, rows in grouped.items()]


def mixed_paths(parts: DataFrame, layers: list[Layer]) -> dict[tuple, dict[str, list[str]]]:
    """Of layers whose files need several scans, the paths by schema: a reader takes them as a list."""
    mixed = [layer for layer in layers if layer.mixed()]
    out: dict[tuple, dict[str, list[str]]] = {}
    if mixed:
        roots = parts.filter(F.col("root").isin([layer.root for layer in mixed]))
        for row in roots.select(*LAYER, "schema", F.element_at("files", 1).alias("path")).orderBy("path").collect():
            out.setdefault(tuple(row[c] for c in LAYER), {}).setdefault(row["schema"], []).append(row["path"])
    return out


def scans(spark: SparkSession, layer: Layer, paths: dict[str, list[str]] | None, options: dict) -> list[DataFrame]:
    """The scans of a Parquet or CSV layer: one if its files agree, else one for each kind of file.

    A scan has the columns of its files, in the layer's types, and the partition columns.
    """
    if not layer.mixed():
        return [_scan(spark, layer, layer.schema, [layer.root], options)]
    groups: dict[tuple, list[str]] = {}
    for text in layer.parts:
        groups.setdefault(layer.scan_key(text), []).append(text)
    out = []
    for texts in groups.values():
        fields = merged_schema([layer.parts[t] for t in texts], layer.name)
        known = {f.name.lower() for f in fields}
        whole = T.StructType([*fields, *(f for f in layer.partitions if f.name.lower() not in known)])
        if len(fields):  # a CSV file without a header has no rows
            found = sorted(p for t in texts for p in paths[t])
            out.append(_scan(spark, layer, whole, found, {**options, "basePath": layer.root}))
    return out


def _scan(spark, layer: Layer, schema: T.StructType, paths: list[str], options: dict) -> DataFrame:
    """One scan; the schema is known, so no job runs for it."""
    reader = spark.read.format(layer.fmt).options(**options).schema(schema)
    return reader.load([literal_path(p) for p in paths])


def in_layer_types(df: DataFrame, layer: Layer) -> list:
    """The columns of a scan as the layer has them; a CSV field that is not there is ''."""
    types = {f.name.lower(): f for f in layer.schema}
    partitions = {f.name.lower() for f in layer.partitions}
    out = []
    for field in df.schema:
        column, wanted = F.col(f"`{field.name}`"), types[field.name.lower()]
        if layer.fmt == "csv" and field.name.lower() not in partitions:
            column = F.coalesce(column, F.lit(""))
        if wanted.dataType != field.dataType:
            column = column.cast(wanted.dataType)
        out.append(column.alias(wanted.name, metadata=wanted.metadata or {}))
    return out


def united(frames: list[DataFrame], layer: Layer, extra: list[str]) -> DataFrame:
    """Rows of several scans under the layer's columns; what a file lacks is NULL."""
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    fields = [F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata or {}) for f in layer.schema]
    return df.select(*fields, *extra)


def folder_layer(spark: SparkSession, path: str, fmt: str, encoding: str | None, options: dict) -> tuple[Layer, list[DataFrame]]:
    """A folder of part files as a layer, and its scans."""
    files = list_files(spark, path, "*").filter("length > 0")
    files = files.select(F.lit(path).alias("layer"), F.lit(fmt).alias("fmt"), _root(files, path), "uri", F.array("path").alias("files"))
    parts = read_parts(files, encoding, options)
    layers = layers_of(parts)
    if not layers:
        return Layer(path, fmt, path, [], [], None), []
    return layers[0], scans(spark, layers[0], mixed_paths(parts, layers).get((path, fmt, layers[0].root)), options)


def _root(files: DataFrame, path: str):
    """The folder as its files' paths spell it."""
    inner = inner_path(F.col("path"), path)
    return F.substring("path", F.lit(1), F.length("path") - F.length(inner) - 1).alias("root")
