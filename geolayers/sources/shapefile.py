"""Folders of shapefiles, read by ranges of records on the executors.

The index file gives the number of records; each task takes one range, reads
its slice of the index, geometry and attribute files, and yields Arrow batches.
"""

import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from geolayers.functions.boxes import BOX_TYPE
from geolayers.functions.text import charset
from geolayers.functions.wkb import (
    LINESTRING,
    MULTILINESTRING,
    MULTIPOINT,
    MULTIPOLYGON,
    POINT,
    POLYGON,
    _inside,
    write_geometry,
)
from geolayers.model import LayerError, box_name, geometry_metadata
from geolayers.session import staged
from geolayers.sources.files import file_size, inner_path, list_files, read_range, read_whole
from geolayers.sources.layers import write_layer

RECORDS_PER_TASK = 100_000
RECORDS_PER_BATCH = 5_000
BYTES_PER_BATCH = 16 << 20  # of the geometry file, unless one record is longer

# Shape types of the format and the kind each is read as.
SHAPE_KINDS = {
    1: "Point",
    3: "LineString",
    5: "Polygon",
    8: "MultiPoint",
    11: "PointZ",
    13: "LineStringZ",
    15: "PolygonZ",
    18: "MultiPointZ",
    21: "PointM",
    23: "LineStringM",
    25: "PolygonM",
    28: "MultiPointM",
}
NO_DATA = -1e38  # measures below this count as absent


# --- headers ------------------------------------------------------------------


def srid_of_wkt(text: str) -> int | None:
    """EPSG code of the outermost authority in a reference-system text."""
    found = re.findall(r'AUTH(?:ORITY)?\s*\[\s*"EPSG"\s*,\s*"?(\d+)"?\s*\]', text, re.IGNORECASE)
    return int(found[-1]) if found and int(found[-1]) > 0 else None


def _text(parts: dict[str, str], extension: str) -> str:
    """The whole of a text file that a layer may lack."""
    return read_whole(parts[extension]).decode("utf-8", "replace") if extension in parts else ""


def text_encoding(parts: dict[str, str], declared: str | None) -> str:
    """The layer's own UTF-8 stands; then the declaration, the ``.cpg`` text, ISO-8859-1."""
    own = _text(parts, "cpg").strip()
    name = charset(own) if own else ""
    if name.upper() in ("UTF-8", "UTF8"):
        return name
    return charset(declared) if declared else name or "ISO-8859-1"


def shape_records(parts: dict[str, str]) -> int:
    """Number of records: the attribute table's, else that of the index."""
    if "dbf" in parts:
        return dbf_fields(parts)[0]
    if "shx" not in parts:
        raise LayerError(f"{parts['shp']} has no index file and no attribute table")
    return (file_size(parts["shx"]) - 100) // 8


def dbf_fields(parts: dict[str, str]):
    """-> (records, header size, record size, [(name, type, width, decimals)])."""
    if "dbf" not in parts:
        return shape_records(parts), 0, 0, []
    records, header, size = struct.unpack_from("<IHH", read_range(parts["dbf"], 0, 32), 4)
    block = read_range(parts["dbf"], 32, header - 32)
    fields = []
    for at in range(0, len(block) - 31, 32):
        if block[at] == 0x0D:
            break
        name = block[at : at + 11].split(b"\0")[0].decode("iso-8859-1")
        fields.append((name, chr(block[at + 11]), block[at + 16], block[at + 17]))
    if file_size(parts["dbf"]) < header + records * size:
        raise LayerError(f"{parts['dbf']} is shorter than its {records} records")
    return records, header, size, fields


def _field_type(kind: str, width: int, decimals: int) -> T.DataType:
    if kind == "D":
        return T.DateType()
    if kind == "L":
        return T.BooleanType()
    if kind == "F" or kind == "N" and (decimals or width >= 19):
        return T.DoubleType()
    if kind == "N":
        return T.IntegerType() if width < 10 else T.LongType()
    return T.StringType()


def layer_schema(parts: dict[str, str]) -> T.StructType:
    """Fields of a layer: fid, geometry with its box, attributes.

    ``parts`` are the layer's files by lower-case extension. An attribute table
    without a geometry file is a layer without geometry, and the reverse.
    """
    shape = struct.unpack_from("<i", read_range(parts["shp"], 0, 100), 32)[0] if "shp" in parts else 0
    fields = [T.StructField("fid", T.LongType())]
    if shape:
        if shape not in SHAPE_KINDS:
            raise LayerError(f"shapes of type {shape} are not known")
        srid = srid_of_wkt(_text(parts, "qpj")) or srid_of_wkt(_text(parts, "prj"))
        fields.append(T.StructField("geom", T.BinaryType(), True, geometry_metadata(srid, SHAPE_KINDS[shape])))
        fields.append(T.StructField(box_name("geom"), BOX_TYPE))
    for name, kind, width, decimals in dbf_fields(parts)[3]:
        data_type = _field_type(kind, width, decimals)
        width_of_text = {"width": width} if isinstance(data_type, T.StringType) else {}
        fields.append(T.StructField(name, data_type, True, width_of_text))
    return T.StructType(fields)


# --- one record ---------------------------------------------------------------


def _parts(record: bytes, n_parts: int, n_points: int, coords: np.ndarray):
    starts = list(struct.unpack_from(f"<{n_parts}i", record, 44)) + [n_points]
    return [coords[a:b] for a, b in zip(starts, starts[1:])]


def _signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def _polygons(rings):
    """Outer rings run clockwise; each hole joins the smallest outer ring around it."""
    outer = [[r] for r in rings if _signed_area(r) <= 0] or [[r] for r in rings]
    holes = [r for r in rings if _signed_area(r) > 0] if len(outer) < len(rings) else []
    for hole in holes:
        x, y = hole[0, :2]
        around = [p for p in outer if len(outer) == 1 or _inside(x, y, [p[0][:, :2]])]
        home = min(around, key=lambda p: abs(_signed_area(p[0])), default=None)
        if home is None:
            outer.append([hole])
        else:
            home.append(hole)
    return outer


def shape_wkb(record: bytes):
    """-> (WKB, box) of a record's content; (None, None) for a null shape."""
    (shape,) = struct.unpack_from("<i", record)
    if shape == 0:
        return None, None
    family, has_z, extra = shape % 10, 10 < shape < 20, shape > 10
    if family == 1:
        values = list(struct.unpack_from(f"<{2 + has_z}d", record, 4))
        at = 4 + 8 * len(values)
        has_m = extra and len(record) >= at + 8
        if has_m:
            (measure,) = struct.unpack_from("<d", record, at)
            has_m = shape == 21 or measure > NO_DATA
            values += [measure] * has_m
        return write_geometry(POINT, values, has_z, has_m), (values[0], values[1], values[0], values[1])
    box = struct.unpack_from("<4d", record, 4)
    n_parts, n_points = (0, *struct.unpack_from("<i", record, 36)) if family == 8 else struct.unpack_from("<2i", record, 36)
    at = 40 if family == 8 else 44 + 4 * n_parts
    coords = np.frombuffer(record, "<f8", 2 * n_points, at).reshape(n_points, 2)
    at += 16 * n_points
    has_m = False
    if has_z:
        coords = np.column_stack([coords, np.frombuffer(record, "<f8", n_points, at + 16)])
        at += 16 + 8 * n_points
    if extra and len(record) >= at + 16 + 8 * n_points:
        measures = np.frombuffer(record, "<f8", n_points, at + 16)
        has_m = shape > 20 or bool((measures > NO_DATA).any())
        if has_m:
            coords = np.column_stack([coords, measures])
    if not n_points:
        return None, None
    flags = (has_z, has_m)
    if family == 8:
        body = [(POINT, *flags, c) for c in coords]
        return write_geometry(MULTIPOINT, body, *flags), box
    parts = _parts(record, n_parts, n_points, coords)
    if family == 3:
        if n_parts == 1:
            return write_geometry(LINESTRING, parts[0], *flags), box
        return write_geometry(MULTILINESTRING, [(LINESTRING, *flags, p) for p in parts], *flags), box
    polygons = _polygons(parts)
    if len(polygons) == 1:
        return write_geometry(POLYGON, polygons[0], *flags), box
    return write_geometry(MULTIPOLYGON, [(POLYGON, *flags, p) for p in polygons], *flags), box


# --- attribute columns ----------------------------------------------------------


def _column(raw: np.ndarray, kind: str, data_type: T.DataType, encoding: str) -> pa.Array:
    """One fixed-width text column of a record range as an Arrow array."""
    if isinstance(data_type, T.StringType):
        text = [v.decode(encoding).rstrip(" \0") for v in raw.tolist()]
        return pa.array([v or None for v in text], pa.string())
    text = [v.decode("ascii", "replace").strip(" \0") for v in raw.tolist()]
    if kind == "L":
        values = {"Y": True, "y": True, "T": True, "t": True, "N": False, "n": False, "F": False, "f": False}
        return pa.array([values.get(v) for v in text], pa.bool_())
    if kind == "D":
        days = [f"{v[:4]}-{v[4:6]}-{v[6:8]}" if len(v) == 8 and v != "00000000" else None for v in text]
        return pa.array(days, pa.string()).cast(pa.date32())
    cast = float if isinstance(data_type, T.DoubleType) else int
    present = [None if not v or v.startswith("*") else cast(v) for v in text]
    arrow = {T.DoubleType: pa.float64(), T.IntegerType: pa.int32(), T.LongType: pa.int64()}
    return pa.array(present, arrow[type(data_type)])


def _shapes(parts: dict[str, str], first: int, count: int, live: np.ndarray):
    """(WKB, box) of the live records of a range; nearby records are read together."""
    index = np.frombuffer(read_range(parts["shx"], 100 + 8 * first, 8 * count), ">i4").reshape(-1, 2)
    start, length = index[:, 0].astype("i8") * 2 + 8, index[:, 1].astype("i8") * 2
    out: list = [None] * len(live)
    order = np.argsort(start[live], kind="stable")
    at = 0
    while at < len(order):
        base = int(start[live[order[at]]])
        ends = np.maximum.accumulate((start + length)[live[order[at:]]])
        together = max(1, int(np.searchsorted(ends, base + BYTES_PER_BATCH, side="right")))
        block = read_range(parts["shp"], base, int(ends[together - 1]) - base)
        for k in order[at : at + together]:
            begin = int(start[live[k]]) - base
            out[k] = shape_wkb(block[begin : begin + int(length[live[k]])])
        at += together
    return out


def _read_records(parts: dict[str, str], table, first: int, count: int, schema: T.StructType, encoding: str):
    """Arrow batch of the records first .. first + count - 1; deleted ones skipped."""
    _, header, size, fields = table
    live = np.arange(count)
    if "dbf" in parts:
        layout = np.dtype([("_deleted", "S1")] + [(f"f{i}", f"V{f[2]}") for i, f in enumerate(fields)])
        rows = np.frombuffer(read_range(parts["dbf"], header + first * size, count * size), np.uint8)
        rows = rows.reshape(-1, size)[:, : layout.itemsize].copy().view(layout)[:, 0]
        live = np.flatnonzero(rows["_deleted"] != b"*")
    columns = {"fid": pa.array(first + live, pa.int64())}
    if "geom" in schema.names:
        shapes = _shapes(parts, first, count, live)
        columns["geom"] = pa.array([wkb for wkb, _ in shapes], pa.binary())
        columns[box_name("geom")] = pa.array(
            [None if box is None else dict(zip(BOX_TYPE.names, box)) for _, box in shapes],
            pa.struct([(n, pa.float64()) for n in BOX_TYPE.names]),
        )
    for i, (name, kind, _, _) in enumerate(fields):
        raw = rows[f"f{i}"][live]
        columns[name] = _column(raw, kind, schema[name].dataType, encoding)
    return pa.RecordBatch.from_arrays([columns[n] for n in schema.names], schema.names)


# --- Spark side -----------------------------------------------------------------


def shape_parts(spark: SparkSession, folder: str) -> dict[str, dict[str, str]]:
    """Files by lower-case extension of every shapefile at the top of a folder.

    One listing for all; layers whose names differ in case only, or files that
    differ so in their extension, are an error.
    """
    files = list_files(spark, folder, "*.*")
    top = files.filter(~inner_path(F.col("path"), folder).contains("/")).select("path")
    found: dict[str, dict[str, str]] = {}
    for path in sorted(r["path"] for r in top.collect()):
        stem, _, extension = path.rpartition("/")[2].rpartition(".")
        if extension.lower() in ("shp", "shx", "dbf", "prj", "qpj", "cpg"):
            parts = found.setdefault(stem, {})
            if extension.lower() in parts:
                raise LayerError(f'"{stem}" has two .{extension.lower()} files in "{folder}"')
            parts[extension.lower()] = path
    return {stem: parts for stem, parts in found.items() if "shp" in parts or "dbf" in parts}


def read_shape_files(
    spark: SparkSession,
    parts: dict[str, str],
    schema: T.StructType,
    encoding: str | None = None,
    records_per_task: int = RECORDS_PER_TASK,
) -> DataFrame:
    """One shapefile of known files and schema; only its headers are read here."""
    text, table = text_encoding(parts, encoding), dbf_fields(parts)
    records = table[0]
    tasks = max(1, -(-records // records_per_task))

    def read(batches):
        for batch in batches:
            for number in batch.column(0).to_pylist():
                stop = min(records, (number + 1) * records_per_task)
                for first in range(number * records_per_task, stop, RECORDS_PER_BATCH):
                    yield _read_records(parts, table, first, min(RECORDS_PER_BATCH, stop - first), schema, text)

    df = spark.range(0, tasks, 1, tasks).mapInArrow(read, schema)
    for field in schema:
        if field.metadata:
            df = df.withMetadata(field.name, field.metadata)
    return df


def read_shapefile(
    spark: SparkSession,
    folder: str,
    layer: str,
    encoding: str | None = None,
    records_per_task: int = RECORDS_PER_TASK,
) -> DataFrame:
    """One shapefile of a folder as a layer; the feature id is the record number from 0.

    A layer whose ``.cpg`` file says UTF-8 is read so; else the encoding is the
    argument, the ``.cpg`` file or ISO-8859-1. Files count in any case of their
    extension, and only those at the top of the folder.
    """
    parts = shape_parts(spark, folder).get(layer)
    if parts is None:
        raise LayerError(f'unable to find layer "{layer}" in "{folder}"')
    return read_shape_files(spark, parts, layer_schema(parts), encoding, records_per_task)


def ingest_shapefiles(spark: SparkSession, folder: str, out: str, encoding: str | None = None) -> list[str]:
    """Store every shapefile of a folder as a Parquet layer; returns their names.

    Files are listed once. Ordering a layer takes several passes, so its records are
    decoded once into the shared folder first.
    """
    found = shape_parts(spark, folder)
    for layer in sorted(found):
        parts = found[layer]
        decoded = staged(read_shape_files(spark, parts, layer_schema(parts), encoding), "shapes")
        write_layer(decoded, f"{out}/{layer}.parquet")
    return sorted(found)
