"""Files of a source: listing by Spark, ranged reads inside tasks."""

import re

from pyspark.sql import DataFrame, SparkSession, functions as F


# Endings of compressed text files and the names of their formats.
COMPRESSED = {"gz": "gzip", "bz2": "bz2"}


def list_files(spark: SparkSession, source: str, pattern: str) -> DataFrame:
    """(path, length, uri) of the matching files at any depth; contents stay unread.

    ``uri`` is the path as ``_metadata.file_path`` spells it in a scan, with percent signs for special characters.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(source)
        .select("path", "length", F.col("_metadata.file_path").alias("uri"))
    )


def is_folder(spark: SparkSession, path: str) -> bool | None:
    """Is there a folder at ``path``? None if there is nothing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getFileStatus(place).isDirectory() if files.exists(place) else None


def open_file(path: str):
    """Random-access handle on a path as Spark spells it, on any shared store."""
    from pyarrow import fs

    for spelled, plain in (("file:///", "/"), ("file:/", "/")):
        if path.startswith(spelled):
            return fs.LocalFileSystem().open_input_file(plain + path[len(spelled) :])
    if path.startswith("/"):
        return fs.LocalFileSystem().open_input_file(path)
    for alias in ("s3a://", "s3n://"):
        if path.startswith(alias):
            path = "s3://" + path[len(alias) :]
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def open_text(path: str):
    """A stream of a file's bytes; gzip and bzip2 files are unpacked as Spark does, by their names."""
    packed = next((kind for end, kind in COMPRESSED.items() if path.lower().endswith(f".{end}")), None)
    handle = open_file(path)
    if packed is None:
        return handle
    import pyarrow as pa

    return pa.CompressedInputStream(handle, packed)


def literal_path(path: str) -> str:
    """A path in which characters that mean something in a pattern stand for themselves."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def read_range(path: str, start: int, size: int) -> bytes:
    """``size`` bytes from ``start``; a file that ends before is an error."""
    with open_file(path) as handle:
        found = handle.read_at(size, start)
    if len(found) != size:
        raise OSError(f"{path} ends {size - len(found)} bytes before the end of a range that its headers promise")
    return found


def read_whole(path: str) -> bytes:
    with open_file(path) as handle:
        return handle.read()


def file_size(path: str) -> int:
    with open_file(path) as handle:
        return handle.size()


def inner_path(path, source: str):
    """Columns: the path of a file below ``source``, however Spark spells scheme and host."""
    folder = "/" + re.sub(r"^[a-z0-9]+:/*", "", source).strip("/") + "/"
    plain = F.concat(F.lit("/"), F.regexp_replace(path, r"^[a-z0-9]+:/*", ""))
    return F.substring(plain, F.instr(plain, folder) + len(folder), F.length(plain))
