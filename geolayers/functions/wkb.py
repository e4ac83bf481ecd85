"""Geometry stored as WKB bytes.

Header facts (kind, SRID) are plain column expressions.  Coordinates need
Arrow functions: points of a batch are handled as one numpy block, other kinds
by a short reader per value.
"""

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from geolayers.functions.boxes import BOX_TYPE

# Kind names in the order of their WKB codes 0..12.
KINDS = [
    "Geometry",
    "Point",
    "LineString",
    "Polygon",
    "MultiPoint",
    "MultiLineString",
    "MultiPolygon",
    "GeometryCollection",
    "CircularString",
    "CompoundCurve",
    "CurvePolygon",
    "MultiCurve",
    "MultiSurface",
]
# Bits of the EWKB type word.
EWKB_Z, EWKB_M, EWKB_SRID = 0x80000000, 0x40000000, 0x20000000

POINT, LINESTRING, POLYGON = 1, 2, 3
MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, COLLECTION = 4, 5, 6, 7
CIRCULARSTRING, COMPOUNDCURVE, CURVEPOLYGON = 8, 9, 10
ARC_STEPS_PER_QUADRANT = 32


# --- header, as column expressions -------------------------------------------


def _little_endian(wkb: Column) -> Column:
    return F.hex(F.substring(wkb, 1, 1)) == "01"


KIND_NAMES = [name + mark for mark in ("", "Z", "M", "ZM") for name in KINDS]


def geometry_kind(wkb: Column) -> Column:
    """Kind name with suffix Z / M, e.g. ``MultiPolygonZ``; an error if unknown.

    The name's place follows from the type word: its code, and Z and M by the
    thousands or by flags.
    """
    header = F.hex(F.substring(wkb, 1, 5))
    swapped = F.concat(*[F.substring(header, at, 2) for at in (9, 7, 5, 3)])
    word = F.conv(F.when(header.startswith("01"), swapped).otherwise(F.substring(header, 3, 8)), 16, 10).cast("bigint")

    def name(word: Column) -> Column:
        base = word.bitwiseAND(F.lit(0x1FFFFFFF))
        code, dims = base % 1000, F.floor(base / 1000).cast("int")
        has_z = ((word.bitwiseAND(F.lit(EWKB_Z)) != 0) | dims.isin(1, 3)).cast("int")
        has_m = ((word.bitwiseAND(F.lit(EWKB_M)) != 0) | dims.isin(2, 3)).cast("int")
        place = ((has_z + 2 * has_m) * len(KINDS) + code + 1).cast("int")
        unknown = F.raise_error(F.concat(F.lit("no geometry has the type number "), word.cast("string")))
        known = (code < len(KINDS)) & (dims <= 3)
        return F.when(known, F.element_at(F.array(*map(F.lit, KIND_NAMES)), place)).otherwise(unknown)

    # The array of one holds the word, so that it is taken apart once.
    return F.when(wkb.isNotNull(), F.transform(F.array(word), name)[0])


def strip_ewkb(wkb: Column) -> Column:
    """Drop the SRID word and its flag; plain WKB passes unchanged."""
    little = _little_endian(wkb)
    flags = F.conv(F.hex(F.substring(wkb, F.when(little, 5).otherwise(2), F.lit(1))), 16, 10).cast("int")
    cleared = F.unhex(F.lpad(F.hex(flags.bitwiseAND(F.lit(0xDF)).cast("bigint")), 2, "0"))
    rest = F.substring(wkb, F.lit(10), F.length(wkb))
    plain = F.when(
        little, F.concat(F.substring(wkb, 1, 4), cleared, rest)
    ).otherwise(F.concat(F.substring(wkb, 1, 1), cleared, F.substring(wkb, 3, 3), rest))
    return F.when(flags.bitwiseAND(F.lit(0x20)) != 0, plain).otherwise(wkb)


# --- reading one value --------------------------------------------------------


def read_geometry(data: bytes, pos: int = 0):
    """-> ((kind, has_z, has_m, body), end position).

    ``body`` is a coordinate array for points and strings, a list of arrays for
    polygons, a list of geometries for every other kind.  Ring closure is not
    checked, so unclosed rings are accepted.
    """
    order = "<" if data[pos] == 1 else ">"
    (word,) = struct.unpack_from(order + "I", data, pos + 1)
    pos += 9 if word & EWKB_SRID else 5
    dims, code = divmod(word & 0x1FFFFFFF, 1000)
    has_z = bool(word & EWKB_Z) or dims in (1, 3)
    has_m = bool(word & EWKB_M) or dims in (2, 3)
    width = 2 + has_z + has_m

    def count(pos):
        return struct.unpack_from(order + "I", data, pos)[0], pos + 4

    def coords(n, pos):
        block = np.frombuffer(data, order + "f8", n * width, pos).reshape(n, width)
        return block, pos + 8 * n * width

    if code == POINT:
        body, pos = coords(1, pos)
        if np.isnan(body[0, :2]).all():
            body = body[:0]
    elif code in (LINESTRING, CIRCULARSTRING):
        n, pos = count(pos)
        body, pos = coords(n, pos)
    elif code == POLYGON:
        rings, pos = count(pos)
        body = []
        for _ in range(rings):
            n, pos = count(pos)
            ring, pos = coords(n, pos)
            body.append(ring)
    elif code < len(KINDS) and code > 0:
        parts, pos = count(pos)
        body = []
        for _ in range(parts):
            part, pos = read_geometry(data, pos)
            body.append(part)
    else:
        raise ValueError(f"no geometry has the type number {code}")
    return (code, has_z, has_m, body), pos


def _arcs(points: np.ndarray) -> np.ndarray:
    """Vertices along three-point arcs, with the axis extremes of each arc."""
    points = points[:, :2]
    out = [points[:1]]
    for start, mid, end in zip(points[:-2:2], points[1:-1:2], points[2::2]):
        if np.array_equal(start, end):
            centre = (start + mid) / 2
        else:
            a, b = mid - start, end - start
            cross = 2 * (a[0] * b[1] - a[1] * b[0])
            if cross == 0:
                out.append(np.array([mid, end]))
                continue
            aa, bb = a @ a, b @ b
            centre = start + np.array([b[1] * aa - a[1] * bb, a[0] * bb - b[0] * aa]) / cross
        radius = np.hypot(*(start - centre))
        angle = [np.arctan2(*(p - centre)[::-1]) for p in (start, mid, end)]
        turn = 2 * np.pi
        to_mid, to_end = (angle[1] - angle[0]) % turn, (angle[2] - angle[0]) % turn or turn
        sign = 1.0
        if to_mid > to_end:
            sign, to_end = -1.0, turn - to_end
        step = np.pi / 2 / ARC_STEPS_PER_QUADRANT
        low, high = sorted((angle[0], angle[0] + sign * to_end))
        grid = np.arange(np.ceil(low / step), np.floor(high / step) + 1) * step
        grid = grid[:: int(sign)]
        ring = centre + radius * np.column_stack([np.cos(grid), np.sin(grid)])
        out.append(np.vstack([ring, end[None]]))
    return np.vstack(out)


def _leaves(geometry):
    """Yield (is_area, [coordinate arrays]) for each simple part, arcs as vertices."""
    code, _, _, body = geometry
    if code in (POINT, LINESTRING):
        yield False, [body[:, :2]]
    elif code == CIRCULARSTRING:
        yield False, [_arcs(body)]
    elif code == POLYGON:
        yield True, [ring[:, :2] for ring in body]
    elif code == COMPOUNDCURVE:
        yield False, [np.vstack([c for part in body for _, cs in _leaves(part) for c in cs])] if body else []
    elif code == CURVEPOLYGON:
        yield True, [c for part in body for _, cs in _leaves(part) for c in cs]
    else:
        for part in body:
            yield from _leaves(part)


# --- whole Arrow batches ------------------------------------------------------


def _octets(values: pa.Array):
    """-> (byte buffer, start of each value, size of each value; 0 for NULL)."""
    width = np.dtype(np.int64 if pa.types.is_large_binary(values.type) else np.int32)
    offsets = np.frombuffer(values.buffers()[1], width, len(values) + 1, values.offset * width.itemsize)
    buffer = values.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.empty(0, np.uint8)
    size = np.where(values.is_null().to_numpy(False), 0, np.diff(offsets))
    return data, offsets[:-1], size


def _plain_points(values: pa.Array):
    """-> (rows holding 2-D little-endian points, their coordinates)."""
    data, start, size = _octets(values)
    rows = np.flatnonzero(size == 21)
    header = data[start[rows, None] + np.arange(5)] if len(rows) else np.empty((0, 5), np.uint8)
    rows = rows[(header == (1, 1, 0, 0, 0)).all(axis=1)]
    if not len(rows):
        return rows, np.empty((0, 2))
    block = data[start[rows, None] + np.arange(5, 21)]
    return rows, np.ascontiguousarray(block).view("<f8")


def _plain_chains(values: pa.Array):
    """(rows, coordinates by row, is it a ring) of 2-D little-endian line strings and
    polygons of one ring, a block for each kind and length."""
    data, start, size = _octets(values)
    for is_area, head, least in ((False, (1, 2, 0, 0, 0), 9), (True, (1, 3, 0, 0, 0, 1, 0, 0, 0), 13)):
        rows = np.flatnonzero((size > least) & ((size - least) % 16 == 0))
        header = data[start[rows, None] + np.arange(least)] if len(rows) else np.empty((0, least), np.uint8)
        n = np.ascontiguousarray(header[:, -4:]).view("<u4")[:, 0]
        fits = (header[:, : len(head)] == head).all(axis=1) & (n == (size[rows] - least) // 16)
        rows = rows[fits]
        for octets in np.unique(size[rows]):
            same = rows[size[rows] == octets]
            block = data[start[same, None] + np.arange(least, octets)]
            yield same, np.ascontiguousarray(block).view("<f8").reshape(len(same), -1, 2), is_area


def _others(values: pa.Array, *done: np.ndarray):
    """Rows that are neither NULL nor in one of ``done``."""
    left = ~values.is_null().to_numpy(False)
    for rows in done:
        left[rows] = False
    return np.flatnonzero(left)


@F.arrow_udf(BOX_TYPE)
def _envelope(values: pa.Array) -> pa.Array:
    sides = np.full((len(values), 4), np.nan)
    rows, xy = _plain_points(values)
    sides[rows] = np.hstack([xy, xy])
    done = [rows]
    for rows, coords, _ in _plain_chains(values):
        sides[rows] = np.hstack([coords.min(axis=1), coords.max(axis=1)])
        done.append(rows)
    for i in _others(values, *done):
        geometry, _ = read_geometry(values[int(i)].as_py())
        parts = [c for _, cs in _leaves(geometry) for c in cs if len(c)]
        if parts:
            xy = np.vstack(parts)
            sides[i] = (*xy.min(axis=0), *xy.max(axis=0))
    empty = np.isnan(sides).any(axis=1)
    return pa.StructArray.from_arrays(
        [pa.array(side) for side in sides.T], [f.name for f in BOX_TYPE.fields], mask=pa.array(empty)
    )


def envelope(wkb: Column) -> Column:
    """Box of each geometry; NULL for NULL and for empty geometries."""
    return _envelope(wkb)


def _number(value: float) -> str:
    return f"{value:.15g}"


def _text(geometry, tagged=True) -> str:
    code, has_z, has_m, body = geometry
    mark = " Z" * has_z + (" M" if has_m and not has_z else "M" * has_m)
    tag = KINDS[code].upper() + mark if tagged else ""
    gap = " " if mark and tagged else ""

    def points(coords):
        return "(" + ",".join(" ".join(map(_number, c)) for c in coords) + ")"

    if not len(body):
        return (tag + " EMPTY").strip()
    if code in (POINT, LINESTRING, CIRCULARSTRING):
        return tag + gap + points(body)
    if code == POLYGON:
        return tag + gap + "(" + ",".join(map(points, body)) + ")"
    uniform = code in (MULTIPOINT, MULTILINESTRING, MULTIPOLYGON)
    untagged = () if code == COLLECTION else (LINESTRING, POLYGON)
    inner = [_text(p, tagged=not uniform and p[0] not in untagged) for p in body]
    return tag + gap + "(" + ",".join(inner) + ")"


@F.arrow_udf(T.StringType())
def _to_wkt(values: pa.Array) -> pa.Array:
    out = [None] * len(values)
    rows, xy = _plain_points(values)
    for i, (x, y) in zip(rows, xy):
        empty = np.isnan(x) and np.isnan(y)
        out[i] = "POINT EMPTY" if empty else f"POINT({_number(x)} {_number(y)})"
    for i in _others(values, rows):
        out[i] = _text(read_geometry(values[int(i)].as_py())[0])
    return pa.array(out, pa.string())


def to_wkt(wkb: Column) -> Column:
    """Geometry as text, 15 significant digits."""
    return _to_wkt(wkb)


# --- writing ------------------------------------------------------------------


def _fixed_width(rows: np.ndarray, missing: np.ndarray) -> pa.Array:
    """Binary array of equally long values; rows marked missing become NULL."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    valid = pa.array(~missing).buffers()[1]
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [valid, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())]
    )


def _with_header(header: bytes, coords: np.ndarray, missing: np.ndarray) -> pa.Array:
    rows = np.empty((len(coords), len(header) + 8 * coords.shape[1]), np.uint8)
    rows[:, : len(header)] = np.frombuffer(header, np.uint8)
    rows[:, len(header) :] = np.ascontiguousarray(coords, "<f8").view(np.uint8)
    return _fixed_width(rows, missing)


def _doubles(*columns: pa.Array):
    block = np.column_stack([c.to_numpy(zero_copy_only=False).astype("f8") for c in columns])
    missing = np.column_stack([c.is_null().to_numpy(zero_copy_only=False) for c in columns]).any(axis=1)
    return block, missing


@F.arrow_udf(T.BinaryType())
def _point_wkb(x: pa.Array, y: pa.Array) -> pa.Array:
    coords, missing = _doubles(x, y)
    return _with_header(struct.pack("<BI", 1, POINT), coords, missing)


def point_wkb(x: Column, y: Column) -> Column:
    """Little-endian point WKB; NULL when a coordinate is NULL."""
    return _point_wkb(x.cast("double"), y.cast("double"))


@F.arrow_udf(T.BinaryType())
def _box_wkb(xmin: pa.Array, ymin: pa.Array, xmax: pa.Array, ymax: pa.Array) -> pa.Array:
    coords, missing = _doubles(xmin, ymin, xmax, ymax)
    ring = coords[:, [0, 1, 0, 3, 2, 3, 2, 1, 0, 1]]
    return _with_header(struct.pack("<BIII", 1, POLYGON, 1, 5), ring, missing)


def box_wkb(box: Column) -> Column:
    """Rectangle polygon of a box struct."""
    return _box_wkb(*[box[f.name] for f in BOX_TYPE.fields])


@F.arrow_udf(T.BinaryType())
def _line_wkb(xs: pa.Array, ys: pa.Array) -> pa.Array:
    out = np.full(len(xs), None, object)
    starts, counts, values = zip(*map(_lists, (xs, ys)))
    present = (counts[0] >= 0) & (counts[1] >= 0)
    if (counts[0] != counts[1])[present].any():
        raise ValueError("a line's lists of x and y differ in length")
    counts = np.where(present, counts[0], -1)
    for n in np.unique(counts[counts >= 0]):
        rows = np.flatnonzero(counts == n)
        x, y = (v[s[rows, None] + np.arange(n)] for v, s in zip(values, starts))
        coords = np.stack([x, y], axis=2).reshape(len(rows), 2 * n)
        header = struct.pack("<BII", 1, LINESTRING, n)
        out[rows] = _with_header(header, coords, np.zeros(len(rows), bool)).to_pylist()
    return pa.array(out, pa.binary())


def _lists(values: pa.Array):
    """-> (start of each list, its length or -1 for NULL, all elements)."""
    offsets = values.offsets.to_numpy()
    counts = np.where(values.is_null().to_numpy(False), -1, np.diff(offsets))
    return offsets[:-1], counts, values.values.to_numpy(False)


def line_wkb(xs: Column, ys: Column) -> Column:
    """Line string through the points of two equally long arrays."""
    return _line_wkb(xs.cast("array<double>"), ys.cast("array<double>"))


def write_geometry(code: int, body, has_z: bool = False, has_m: bool = False) -> bytes:
    """Little-endian ISO WKB from the ``body`` shape that ``read_geometry`` returns."""
    head = struct.pack("<BI", 1, code + 1000 * has_z + 2000 * has_m)

    def counted(coords):
        return struct.pack("<I", len(coords)) + np.ascontiguousarray(coords, "<f8").tobytes()

    if code == POINT:
        return head + np.ascontiguousarray(body, "<f8").tobytes()
    if code in (LINESTRING, CIRCULARSTRING):
        return head + counted(body)
    if code == POLYGON:
        return head + struct.pack("<I", len(body)) + b"".join(map(counted, body))
    return head + struct.pack("<I", len(body)) + b"".join(write_geometry(c, b, z, m) for c, z, m, b in body)


# --- exact test against a box -------------------------------------------------


def _segments_meet(coords: np.ndarray, box) -> bool:
    """Does any segment of a vertex chain share a point with the closed box?"""
    low, high = np.array(box[:2]), np.array(box[2:])
    if len(coords) == 1:
        return bool(((coords >= low) & (coords <= high)).all())
    start, step = coords[:-1], np.diff(coords, axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        enter, leave = (low - start) / step, (high - start) / step
    flat = step == 0
    outside = flat & ((start < low) | (start > high))
    near = np.where(flat, 0.0, np.minimum(enter, leave)).max(axis=1)
    far = np.where(flat, 1.0, np.maximum(enter, leave)).min(axis=1)
    return bool(((np.maximum(near, 0) <= np.minimum(far, 1)) & ~outside.any(axis=1)).any())


def _inside(x: float, y: float, rings) -> bool:
    """Even-odd rule over all rings, so holes count as outside."""
    crossings = 0
    for ring in rings:
        a, b = ring, np.roll(ring, -1, axis=0)
        spans = (a[:, 1] > y) != (b[:, 1] > y)
        a, b = a[spans], b[spans]
        at = a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
        crossings += int((at > x).sum())
    return crossings % 2 == 1


def _chains_meet(coords: np.ndarray, is_area: bool, box) -> np.ndarray:
    """For each chain of a block: does it, or the area in it, share a point with the box?"""
    low, high = np.array(box[:2]), np.array(box[2:])
    if coords.shape[1] == 1:
        return ((coords >= low) & (coords <= high)).all(axis=(1, 2))
    if is_area:
        coords = np.concatenate([coords, coords[:, :1]], axis=1)
    start, step = coords[:, :-1], np.diff(coords, axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        enter, leave = (low - start) / step, (high - start) / step
        flat = step == 0
        outside = flat & ((start < low) | (start > high))
        near = np.where(flat, 0.0, np.minimum(enter, leave)).max(axis=2)
        far = np.where(flat, 1.0, np.maximum(enter, leave)).min(axis=2)
        hit = ((np.maximum(near, 0) <= np.minimum(far, 1)) & ~outside.any(axis=2)).any(axis=1)
        if is_area:
            x, y = low
            a, b = start, coords[:, 1:]
            spans = (a[..., 1] > y) != (b[..., 1] > y)
            at = a[..., 0] + (y - a[..., 1]) * (b[..., 0] - a[..., 0]) / (b[..., 1] - a[..., 1])
            hit |= (spans & (at > x)).sum(axis=1) % 2 == 1
    return hit


def _geometry_meets(geometry, box) -> bool:
    for is_area, arrays in _leaves(geometry):
        arrays = [c for c in arrays if len(c)]
        closed = [np.vstack([c, c[:1]]) for c in arrays] if is_area else arrays
        if any(_segments_meet(c, box) for c in closed):
            return True
        if is_area and arrays and _inside(box[0], box[1], arrays):
            return True
    return False


def geometry_meets_box(wkb: Column, box) -> Column:
    """Exact test of any geometry kind against four numbers; NULL stays NULL."""
    box = tuple(float(v) for v in box)

    @F.arrow_udf(T.BooleanType())
    def meets(values: pa.Array) -> pa.Array:
        out = [None] * len(values)
        rows, xy = _plain_points(values)
        hit = (xy >= box[:2]).all(axis=1) & (xy <= box[2:]).all(axis=1)
        for i, h in zip(rows.tolist(), hit.tolist()):
            out[i] = h
        done = [rows]
        for rows, coords, is_area in _plain_chains(values):
            for i, h in zip(rows.tolist(), _chains_meet(coords, is_area, box).tolist()):
                out[i] = h
            done.append(rows)
        for i in _others(values, *done):
            out[i] = _geometry_meets(read_geometry(values[int(i)].as_py())[0], box)
        return pa.array(out, pa.bool_())

    return meets(wkb)
