"""Discovery: the layers of a source, their columns, and bulk import as views."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from geolayers.functions.names import launder, launder_name
from geolayers.functions.text import charset
from geolayers.model import IMPORTED_AS, LayerError, box_name, is_geometry, source_type
from geolayers.operators.columns import fid_of
from geolayers.sources.fids import csv_fids, csv_marked, csv_offsets, layer_offsets, marked_fids, parquet_marked
from geolayers.sources.files import COMPRESSED, inner_path, list_files
from geolayers.sources.parts import CSV_OPTIONS, LAYER, Layer, in_layer_types, layers_of, mixed_paths, read_parts, scans, united
from geolayers.sources.shapefile import read_shape_files
from geolayers.sources.tables import can_be_table, register_table

COLUMN_SCHEMA = "layer string, fmt string, path string, ordinal int, source_name string, data_type string"
SHAPE_PARTS = ["shp", "shx", "dbf", "prj", "qpj", "cpg"]
ENDING = rf"(?i)\.(parquet|csv(?=\.({'|'.join(COMPRESSED)})$)|csv(?=$)|{'|'.join(SHAPE_PARTS)})(\.[a-z0-9]+)?$"
PLACE = "_fid"


def layer_files(spark: SparkSession, source: str) -> DataFrame:
    """(layer, fmt, root, uri, files): the files of every layer, one to a row; a shapefile's files are one row.

    A layer is a file ``name.parquet|csv`` in the folder, a folder of Parquet or CSV
    part files (at any depth, for partition columns), or a shapefile in the folder:
    its geometry file, its attribute table or both. Extensions count in any case; CSV files
    may be packed (``.csv.gz``, ``.csv.bz2``). ``root`` is the file or folder that Spark reads.
    """
    files = list_files(spark, source, "*.*")
    inner = inner_path(F.col("path"), source)
    head = F.substring_index(inner, "/", 1)
    nested = inner.contains("/")
    extension = F.lower(F.regexp_extract("path", ENDING, 1))
    fmt = F.when(extension.isin(SHAPE_PARTS), "shapefile").otherwise(extension)
    found = files.select(
        F.regexp_replace(head, ENDING, "").alias("layer"),
        fmt.alias("fmt"),
        F.when(nested, F.concat(F.substring("path", F.lit(1), F.length("path") - F.length(inner)), head)).otherwise(F.col("path")).alias("root"),
        "path",
        "uri",
        nested.alias("nested"),
        extension.alias("extension"),
    )
    each = found.filter(F.col("fmt").isin("parquet", "csv")).select(*LAYER, "uri", F.array("path").alias("files"))
    # A shapefile has a handful of files.
    shapes = found.filter((F.col("fmt") == "shapefile") & ~F.col("nested")).groupBy("layer", "fmt")
    shapes = shapes.agg(F.min("root").alias("root"), F.array_sort(F.collect_list("path")).alias("files"), F.collect_set("extension").alias("extensions"))
    shaped = F.array_contains("extensions", "shp") | F.array_contains("extensions", "dbf")
    return each.unionByName(shapes.filter(shaped).select(*LAYER, F.lit(None).cast("string").alias("uri"), "files"))


def list_layers(spark: SparkSession, source: str) -> DataFrame:
    """(layer, fmt) of every layer of a source, without opening a file."""
    return layer_files(spark, source).select("layer", "fmt").distinct()


def columns_of(schema: T.StructType):
    """(source name, imported type) of a layer's columns: fid, geometries, fields.

    The id comes first: the layer's own whole-number ``fid``, else its rows' places. Boxes
    that only cover a geometry are not columns of the layer.
    """
    geometries = [f for f in schema if is_geometry(f)]
    hidden = {box_name(f.name) for f in geometries} | {f.name for f in geometries}
    out = [("fid", "bigint")]
    for i, field in enumerate(geometries):
        facts = field.metadata["geometry"]
        generic = "geom" if len(geometries) == 1 else f"geom{i}"
        srid = f",{facts['srid']}" if facts.get("srid") else ""
        out.append((field.name or generic, f"Geometry({facts['kind']}{srid})"))
    own = fid_of(schema)
    for field in schema:
        if field.name not in hidden and field.name != own:
            out.append((field.name, imported_type(field)))
    return out


def imported_type(field: T.StructField) -> str:
    width = (field.metadata or {}).get("width")
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        width = field.dataType.length
    name = IMPORTED_AS[source_type(field.dataType)]
    # Fixed value: widest text for which a width is declared, exclusive.
    return f"{name}({width})" if name == "varchar" and width and width < 10 * 1024 * 1024 else name


def layer_columns(
    files: DataFrame,
    launder_table_names: bool = True,
    launder_column_names: bool = True,
    encoding: str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Columns of the layers in ``files``: one row per layer and column.

    ``table_name`` and ``column_name`` are the laundered names; ``column_option``
    keeps the source name where laundering changed more than its case. An ordinary field that would
    be called fid beside the id becomes fid_1.
    """
    rows = [
        (layer.name, layer.fmt, layer.root, ordinal, name, kind)
        for layer in layers_of(read_parts(files, encoding, options))
        for ordinal, (name, kind) in enumerate(columns_of(layer.schema), 1)
    ]
    found = files.sparkSession.createDataFrame(rows, COLUMN_SCHEMA)
    raw, laundered = F.col("source_name"), launder(F.col("source_name"))
    name = laundered if launder_column_names else raw
    second = (F.col("ordinal") > 1) & (F.lower(name) == "fid")
    changed = (F.lower(laundered) != F.lower(raw)) | second
    return found.select(
        "layer",
        "fmt",
        "path",
        _table_name(launder_table_names).alias("table_name"),
        "ordinal",
        F.when(second, F.concat(name, F.lit("_1"))).otherwise(name).alias("column_name"),
        "data_type",
        F.when(changed if launder_column_names else second, raw).alias("column_option"),
        "source_name",
    )


def column_names(schema: T.StructType, launder_column_names: bool = True) -> list[tuple[str, str]]:
    """(source name, column name) of an imported layer, the id first."""
    rename = launder_name if launder_column_names else str
    named = [(name, rename(name)) for name, _ in columns_of(schema)]
    return named[:1] + [(name, f"{new}_1" if new.lower() == "fid" else new) for name, new in named[1:]]


def _table_name(launder_table_names: bool):
    return launder(F.col("layer")) if launder_table_names else F.col("layer")


def _chosen(spark, source, prefix=None, limit_to=None, except_=None, launder_table_names=True) -> DataFrame:
    """The files of the chosen layers, before any of them is opened."""
    if limit_to is not None and except_ is not None:
        raise LayerError("limit_to and except_ exclude each other")
    files = layer_files(spark, source)
    table = _table_name(launder_table_names)
    if prefix is not None:
        files = files.filter(F.col("layer").startswith(prefix))
    if limit_to is not None:
        files = files.filter(table.isin(list(limit_to)))
    if except_ is not None:
        files = files.filter(~table.isin(list(except_)))
    return files


def layer_catalog(
    spark: SparkSession,
    source: str,
    prefix: str | None = None,
    limit_to: list[str] | None = None,
    except_: list[str] | None = None,
    launder_table_names: bool = True,
    launder_column_names: bool = True,
    encoding: str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """The columns of all layers that an import would take.

    ``prefix`` is compared with the layer's own name, case-sensitively;
    ``limit_to`` and ``except_`` with the name of the table it becomes.  Layers
    are chosen before any of their files is opened. ``options`` are those of the CSV
    reader (``sep``, ``quote``, ``multiLine``).
    """
    files = _chosen(spark, source, prefix, limit_to, except_, launder_table_names)
    return layer_columns(files, launder_table_names, launder_column_names, encoding, options)


def _check_clashes(names: dict[str, list[str]], what: str) -> None:
    """Laundering may make two names equal; such a table cannot be imported."""
    for laundered, same in names.items():
        if len(same) > 1:
            raise LayerError(f'{what}: {same} have the same laundered name "{laundered}"')


def _read(spark: SparkSession, layers: list[Layer], parts: DataFrame, encoding: str | None, options: dict, stored: dict[int, str]) -> list[DataFrame]:
    """All columns of each layer, with the id of its rows as ``PLACE`` if it has none of its own; ``stored`` names layers' tables."""
    paths = mixed_paths(parts, layers)
    rows: list[DataFrame] = []
    bare: dict[str, list[int]] = {"csv": [], "parquet": []}
    for k, layer in enumerate(layers):
        if layer.fmt == "shapefile":
            rows.append(read_shape_files(spark, {p.rpartition(".")[2].lower(): p for p in layer.files}, layer.schema, encoding))
            continue
        found = [spark.table(stored[k])] if k in stored else scans(spark, layer, paths.get((layer.name, layer.fmt, layer.root)), options if layer.fmt == "csv" else {})
        if not found:
            rows.append(spark.createDataFrame([], T.StructType([T.StructField(PLACE, T.LongType()), *layer.schema])))
            continue
        mark, places = (csv_marked, ["_file", "_at", "_row"]) if layer.fmt == "csv" else (parquet_marked, ["_file", "_row"])
        if fid_of(layer.schema) is None:
            bare[layer.fmt].append(k)
        else:
            mark, places = (lambda df: df), []
        rows.append(united([mark(df).select(*in_layer_types(df, layer), *places) for df in found], layer, places))
    if bare["csv"]:
        offsets, sizes = csv_offsets([rows[k] for k in bare["csv"]])
        for at, k in enumerate(bare["csv"]):
            rows[k] = csv_fids(rows[k], offsets.filter(F.col("_layer") == at), PLACE, sizes.get(at, 0))
    if bare["parquet"]:
        roots = [layers[k].root for k in bare["parquet"]]
        # The footers hold the rows of each file.
        counts = parts.filter(F.col("root").isin(roots)).select(
            F.col("root").alias("_layer"), F.col("uri").alias("_file"), F.col("rows").alias("_rows"), F.lit(0).cast("bigint").alias("_first")
        )
        offsets, sizes = layer_offsets(counts, ["_file"], 0)
        for k, root in zip(bare["parquet"], roots):
            rows[k] = marked_fids(rows[k], offsets=offsets.filter(F.col("_layer") == root), name=PLACE, size=sizes.get(root, 0))
    return rows


def import_layers(
    spark: SparkSession,
    source: str,
    prefix: str | None = None,
    limit_to: list[str] | None = None,
    except_: list[str] | None = None,
    launder_table_names: bool = True,
    launder_column_names: bool = True,
    encoding: str | None = None,
    options: dict | None = None,
    database: str | None = None,
    analysed: list[str] | None = None,
) -> int:
    """Register a temporary view for each chosen layer; returns their number.

    The arguments are those of ``layer_catalog``. Files are listed and opened in a
    fixed number of jobs; each view reads with the schema found there, CSV files by their
    headers and Parquet files by their types, and nothing of the data is stored.

    With ``database``, each Parquet layer whose files agree, and whose name is of letters, digits and underscores, also becomes an external table there, under the
    name of its view and with the columns as its files call them, and its view reads that table. The table has statistics of its
    columns (``analysed`` names some, an empty list none), so that with ``spark.sql.cbo.enabled`` joins of the views are planned
    by their estimated rows. Other layers are views only.
    """
    files = _chosen(spark, source, prefix, limit_to, except_, launder_table_names)
    parts = read_parts(files, encoding, options)
    layers = layers_of(parts)
    tables: dict[str, list[str]] = {}
    for layer in layers:
        tables.setdefault(launder_name(layer.name) if launder_table_names else layer.name, []).append(f"{layer.name} ({layer.fmt})")
        columns: dict[str, list[str]] = {}
        for name, new in column_names(layer.schema, launder_column_names):
            columns.setdefault(new, []).append(name)
        _check_clashes(columns, f'columns of layer "{layer.name}"')
    _check_clashes(tables, "layers")
    read = {**CSV_OPTIONS, **({"encoding": charset(encoding)} if encoding else {}), **(options or {})}
    stored = {}
    if database is not None:
        for k, (table, layer) in enumerate(zip(tables, layers)):
            if can_be_table(layer, table):
                stored[k] = register_table(spark, layer, database, table, analysed)
    for table, layer, df in zip(tables, layers, _read(spark, layers, parts, encoding, read, stored)):
        renamed = []
        own = fid_of(df.schema)
        for k, (name, new) in enumerate(column_names(layer.schema, launder_column_names)):
            column = F.col(f"`{name}`") if k else F.col(f"`{own or PLACE}`").cast("bigint")
            field = layer.schema[name] if name in layer.schema.names else T.StructField(name, T.LongType())
            renamed.append(column.alias(new, metadata=field.metadata or {}))
            if is_geometry(field) and box_name(name) in layer.schema.names:
                renamed.append(F.col(f"`{box_name(name)}`").alias(box_name(new)))
        df.select(renamed).createOrReplaceTempView(f"`{table}`")
    return len(layers)
