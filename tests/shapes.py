"""Writes small shapefiles for the tests."""

import struct


def point(x, y):
    return struct.pack("<i2d", 1, x, y)


def null():
    return struct.pack("<i", 0)


def point_z(x, y, z, m=None):
    return struct.pack("<i3d", 11, x, y, z) + (b"" if m is None else struct.pack("<d", m))


def parts(shape, rings):
    points = [p for ring in rings for p in ring]
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    starts, at = [], 0
    for ring in rings:
        starts.append(at)
        at += len(ring)
    head = struct.pack("<i4d2i", shape, min(xs), min(ys), max(xs), max(ys), len(rings), len(points))
    return head + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p[:2]) for p in points)


def multipoint(points):
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    head = struct.pack("<i4di", 8, min(xs), min(ys), max(xs), max(ys), len(points))
    return head + b"".join(struct.pack("<2d", *p) for p in points)


def write(folder, name, shape, records, fields, rows, deleted=(), prj=None, cpg=None, encoding="latin-1"):
    """``fields``: (name, type, width, decimals); values are padded text."""
    header = lambda size: (
        struct.pack(">i20xi", 9994, size // 2) + struct.pack("<2i", 1000, shape) + struct.pack("<8d", *[0.0] * 8)
    )
    body, index, at = b"", b"", 50
    for number, content in enumerate(records, 1):
        words = len(content) // 2
        body += struct.pack(">2i", number, words) + content
        index += struct.pack(">2i", at, words)
        at += 4 + words
    folder.mkdir(parents=True, exist_ok=True)
    if shape is not None:
        (folder / f"{name}.shp").write_bytes(header(100 + len(body)) + body)
        (folder / f"{name}.shx").write_bytes(header(100 + len(index)) + index)
    size = 1 + sum(f[2] for f in fields)
    dbf = struct.pack("<B3xIHH20x", 3, len(rows), 32 + 32 * len(fields) + 1, size)
    for field, kind, width, decimals in fields:
        dbf += field.encode(encoding).ljust(11, b"\0") + kind.encode() + b"\0" * 4 + bytes([width, decimals]) + b"\0" * 14
    dbf += b"\r"
    for number, row in enumerate(rows):
        dbf += b"*" if number in deleted else b" "
        for value, (_, kind, width, _) in zip(row, fields):
            raw = ("" if value is None else str(value)).encode(encoding)
            dbf += raw.rjust(width) if kind in "NF" else raw.ljust(width)
    (folder / f"{name}.dbf").write_bytes(dbf + b"\x1a")
    if prj:
        (folder / f"{name}.prj").write_text(prj)
    if cpg:
        (folder / f"{name}.cpg").write_text(cpg)
