"""Layers as DataFrames: Parquet, CSV and database tables in, Parquet out."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from geolayers.functions.text import charset
from geolayers.functions.values import parse_text, write_columns
from geolayers.functions.wkb import envelope
from geolayers.model import LayerError, box_name, declare, geometry_metadata, is_geometry
from geolayers.operators.columns import FID, fid_of, is_fid, match_columns, plain_type
from geolayers.operators.spatial import geometry_column
from geolayers.session import staged
from geolayers.sources.fids import csv_fids, csv_marked, file_fids, marked_fids, parquet_marked
from geolayers.sources.files import COMPRESSED, is_folder, literal_path
from geolayers.sources.parts import CSV_OPTIONS, folder_layer, in_layer_types, united

# The computed id of a row, whatever the layer's own columns are called.
PLACE = "_fid"
# Cells per axis of the grid that orders a written layer.
GRID_BITS = 16
# Shares of the box centres between which that grid lies.
OUTER = (0.001, 0.999)


def _load(spark: SparkSession, fmt: str, source: str, layer: str, options: dict) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        return reader.option("url", source).option("dbtable", layer).load()
    for path in _places(source, layer, fmt):
        try:
            return reader.load(literal_path(path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise LayerError(f'unable to find layer "{layer}" in "{source}"')


def _places(source: str, layer: str, fmt: str) -> list[str]:
    """Where a layer may be; its name is literal."""
    packed = [f"{source}/{layer}.{fmt}.{end}" for end in COMPRESSED] if fmt == "csv" else []
    return [f"{source}/{layer}.{fmt}", f"{source}/{layer}", *packed]


def _folder(spark: SparkSession, fmt: str, source: str, layer: str) -> str | None:
    """The folder of a layer of part files, None if it is a file or is not there."""
    found = next(((path, there) for path in _places(source, layer, fmt) if (there := is_folder(spark, path)) is not None), None)
    return found[0] if found and found[1] else None


def jdbc_options(fid_column: str, lower: int, upper: int, partitions: int) -> dict:
    """Reader options that split a table scan by ranges of its id column."""
    return {
        "partitionColumn": fid_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_layer(
    spark: SparkSession,
    source: str,
    layer: str,
    columns=None,
    fmt: str = "parquet",
    column_names: dict[str, str] | None = None,
    fid_column: str | None = None,
    srid: int | None = None,
    encoding: str | None = None,
    null_elements: bool = True,
    geometry: list[str] | None = None,
    widened: bool = False,
    **options,
) -> DataFrame:
    """One layer of a source as a DataFrame.

    ``columns`` declares the wanted columns (DDL string, StructType or fields),
    ``column_names`` maps declared names to other source names.  The feature id
    is ``fid_column``, else the layer's own whole-number ``fid``, else the place of the row
    in the file: from 0 in Parquet, from 1 in CSV.  ``geometry`` names binary
    columns of WKB or EWKB, such as a database returns.  ``srid`` is stamped on
    every geometry column without reprojection.

    The part files of a CSV folder are matched by their headers: files with the same
    header are one scan, and a column that a file lacks is NULL in its rows. ``widened`` does
    the same for Parquet files whose types differ, each column as wide as its files need.
    """
    marked = None
    folder = None
    if fmt == "csv":
        options = {**CSV_OPTIONS, **({"encoding": charset(encoding)} if encoding else {}), **options}
        header = str({k.lower(): v for k, v in options.items()}["header"]).lower() == "true"
        folder = _folder(spark, fmt, source, layer) if header else None
    elif fmt == "parquet" and widened:
        folder = _folder(spark, fmt, source, layer)
    if folder is not None:
        whole, scans = folder_layer(spark, folder, fmt, encoding, options)
        if not scans:
            raise LayerError(f'layer "{layer}" in "{source}" has no files')
        mark, places = (csv_marked, ["_file", "_at", "_row"]) if fmt == "csv" else (parquet_marked, ["_file", "_row"])
        marked = united([mark(scan).select(*in_layer_types(scan, whole), *places) for scan in scans], whole, places)
        df = marked.drop(*places)
    else:
        df = _load(spark, fmt, source, layer, options)
        if fmt == "csv":
            marked = csv_marked(df)
            names = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns]
            marked = marked.select(*names, "_file", "_at", "_row")
            df = df.select(names)
    for name in geometry or []:
        df = geometry_column(df, name)
        marked = geometry_column(marked, name) if marked is not None else None
    if srid is not None:
        df = stamp_srid(df, srid)
        marked = stamp_srid(marked, srid) if marked is not None else None
    own_fid = fid_of(df.schema, fid_column)
    if columns is None:
        return df if own_fid == FID or own_fid is None else df.withColumnRenamed(own_fid, FID)
    declared = declare(columns, column_names)
    schema = df.schema
    fid = F.col(f"`{own_fid}`") if own_fid else None
    if fid is None and any(is_fid(f) for f in declared):
        fid = F.col(PLACE)
        if fmt == "csv":
            df = csv_fids(marked, name=PLACE)
        elif fmt == "parquet":
            df = file_fids(df, name=PLACE) if marked is None else marked_fids(marked, name=PLACE)
        else:
            raise LayerError(f'layer "{layer}" needs fid_column for format {fmt}')
    return df.select(match_columns(schema, declared, layer, fid, fid_column, null_elements))


def typed_csv(df: DataFrame, columns) -> DataFrame:
    """Text columns of a CSV layer as other types; empty text is NULL for them."""
    return df.select(
        [parse_text(F.col(f"`{f.name}`"), f.type).cast(plain_type(f.type)).alias(f.name) for f in declare(columns)]
    )


def stamp_srid(df: DataFrame, srid: int) -> DataFrame:
    """Declare the reference system of every geometry column."""
    for field in df.schema:
        if is_geometry(field):
            kind = field.metadata["geometry"].get("kind", "Geometry")
            df = df.withMetadata(field.name, geometry_metadata(srid, kind))
    return df


def srid_of(df: DataFrame, geom: str = "geom"):
    """Reference system of a geometry column, as a column; 0 if undeclared."""
    return F.lit(df.schema[geom].metadata["geometry"]["srid"]).cast("int")


def _spread(bits):
    """Every bit of a 16-bit number moved to the even places of a longer one."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return bits


def grid_order(box, extent):
    """Place of a box's centre on a Z-shaped walk over the extent; edge cells hold what lies outside."""

    def cell(low, high, start, end):
        width = (end - start) or 1.0
        last = (1 << GRID_BITS) - 1
        place = F.floor(((low + high) / 2 - F.lit(start)) / F.lit(width) * last).cast("bigint")
        return _spread(F.least(F.greatest(place, F.lit(0)), F.lit(last)))

    xmin, ymin, xmax, ymax = extent
    along_x = cell(box["xmin"], box["xmax"], xmin, xmax)
    along_y = cell(box["ymin"], box["ymax"], ymin, ymax)
    return along_x.bitwiseOR(F.shiftleft(along_y, 1))


def write_layer(
    df: DataFrame, path: str, partitions: int | None = None, lookups: list[str] | None = None, false_positives: float = 0.01
) -> None:
    """Store a layer as Parquet.

    Each geometry gets its covering box.  Rows are range-partitioned along a
    grid walk over the first geometry's boxes, so that files and row groups
    cover small areas and a box filter skips most of them.  The fid completes
    the range key: many features in one place still spread over partitions.
    The grid covers all but the outermost thousandth of the box centres on each
    side, so stray features do not coarsen it. A box that has to be computed from the geometry is stored once for that.

    ``lookups`` names columns that are asked for by value, such as the fid: rows are ordered by place, so every
    file's extremes of them span nearly all values. Each row group gets a Bloom filter of them, no larger than
    its different values need for that share of ``false_positives``; a comparison with up to
    ``spark.sql.parquet.pushdown.inFilterThreshold`` values then reads only row groups that may hold one.
    """
    missing = [name for name in lookups or [] if name not in df.columns]
    if missing:
        raise LayerError(f"no columns {missing} for lookups")
    geometries = [f for f in df.schema if is_geometry(f)]
    computed = False
    for field in geometries:
        if box_name(field.name) not in df.columns:
            df = df.withColumn(box_name(field.name), envelope(F.col(f"`{field.name}`")))
            computed = True
    df = write_columns(df, path)
    if computed:
        df = staged(df, "layer")
    if geometries:
        box = F.col(f"`{box_name(geometries[0].name)}`")
        centres = [(box[f"{axis}min"] + box[f"{axis}max"]) / 2 for axis in "xy"]
        shares = F.array(*map(F.lit, OUTER))
        across = df.agg(*[F.percentile_approx(c, shares, 10000) for c in centres]).first()
        if across[0]:
            extent = (across[0][0], across[1][0], across[0][1], across[1][1])
            keys = [grid_order(box, extent).alias("_walk")]
            keys += [F.col(FID)] if FID in df.columns else [F.xxhash64(*[c for c in df.columns])]
            df = df.repartitionByRange(*([partitions] if partitions else []), *keys)
            df = df.sortWithinPartitions(*keys)
    writer = df.write
    for name in lookups or []:
        for option, value in (("enabled", "true"), ("adaptive.enabled", "true"), ("fpp", str(false_positives))):
            writer = writer.option(f"parquet.bloom.filter.{option}#{name}", value)
    if lookups:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)


def layer_count(spark: SparkSession, source: str, layer: str) -> DataFrame:
    """Row count of a Parquet layer from the file footers alone."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = _load(session, "parquet", source, layer, {})
    return df.agg(F.count("*").alias("features"))
