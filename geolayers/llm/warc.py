"""WARC archives of pages: written by tasks, indexed in one order, read back by place.

Each record is a gzip member of its own, so it can be read by offset and length. A payload
that another record holds is not stored again: a revisit record names the one that does.
"""

import base64
import calendar
import hashlib
import re
import time
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from geolayers.llm.batches import small_batches
from geolayers.llm.captures import RUN, merge_runs, order_key, url_key
from geolayers.llm.token_files import _place
from geolayers.session import broadcast_if_small, row_bytes, staged

ARCHIVE_BYTES = 128 << 20
RUN_CAPTURES = 1 << 16
READ_BYTES = 4 << 20
# Payloads that make up a thousandth of all rows are a thousand at most.
HEAVY = 1000
LAST_SECOND = 253_402_300_799  # of the year 9999
PAGE = "urn:x-page:"
# Fixed values of the format.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "page_id bigint, url string, stamp bigint, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint, payload binary"
)


def _date(stamp: int | None) -> str:
    return time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(min(max(stamp or 0, 0), LAST_SECOND)))


def _uri(url: str) -> str:
    """The URL on one header line: blanks and control characters in their percent form."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = (VERSION, b"\r\n", head.encode("utf-8", "surrogatepass"), b"\r\n", block, b"\r\n\r\n")
    return b"".join([*map(packer.compress, whole), packer.flush()])


def capture_record(page_id, url, stamp, size: int, digest: str, refers, payload: bytes | None) -> bytes:
    """A response with its payload, or a revisit of ``refers`` (id, URL, time) with the HTTP head alone."""
    base32 = base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Date", _date(stamp))]
    fields.append(("WARC-Record-ID", f"<{PAGE}{'' if page_id is None else page_id}>"))
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{base32}"))
    if refers:
        first, first_url, first_stamp = refers
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<{PAGE}{first}>"), ("WARC-Refers-To-Date", _date(first_stamp))]
        if first_url is not None:
            fields.append(("WARC-Refers-To-Target-URI", _uri(first_url)))
    fields.append(("Content-Type", "application/http; msgtype=response"))
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _record(fields, head if refers else head + payload)


def _headers(data: bytes, at: int) -> tuple[bytes, dict[str, str], int]:
    """First line, fields by lower-case name, and where the block behind them begins."""
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise OSError("a record's head has no end")
    first, *lines = data[at:end].split(b"\r\n")
    pairs = (line.decode("utf-8", "surrogatepass").partition(":") for line in lines)
    return first, {name.strip(" \t").lower(): value.strip(" \t") for name, _, value in pairs}, end + 4


def parsed(data: bytes) -> tuple | None:
    """The columns of ``RECORD`` of an uncompressed record; None if it is no capture of a page.

    A payload that does not have its digest or length is an error.
    """
    first, fields, at = _headers(data, 0)
    block = data[at : at + int(fields["content-length"])]
    if not first.startswith(b"WARC/") or data[at + len(block) :] != b"\r\n\r\n":
        raise OSError("an archive holds what is no record")
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    number = lambda name: int(x) if (x := fields[name].strip("<>").removeprefix(PAGE)) else None
    _, http, start = _headers(block, 0)
    size, digest = int(http["content-length"]), base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    payload = block[start:] if kind == "response" else None
    if payload is not None and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise OSError("a payload is not the one that its record names")
    stamp = calendar.timegm(time.strptime(fields["warc-date"], "%Y-%m-%dT%H:%M:%SZ"))
    refers = number("warc-refers-to") if kind == "revisit" else None
    return number("warc-record-id"), fields.get("warc-target-uri"), stamp, size, digest, kind, refers, payload


def _with_leaders(rows: DataFrame, least_bytes: int) -> DataFrame:
    """Rows with ``first`` (id, stamp, url): of rows of the same long payload, the one with the largest id.

    The few payloads that make up a large share of all rows are broadcast; the others are
    broadcast by their measured size, else joined by a shuffle in which every row without
    a partner has a key of its own.
    """
    same = ["digest", "mark", "size"]
    groups = rows.filter(F.col("size") >= least_bytes).groupBy(*same)
    first = F.max(F.struct("id", "stamp", "url")).alias("first")
    groups = staged(groups.agg(first, F.count("*").alias("n")).filter("n > 1 and first.id is not null"), "leaders")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = F.col("n") * HEAVY >= max(total, 1)
    often, others = groups.filter(heavy).drop("n"), groups.filter(~heavy).drop("n")
    size = others.agg(F.count("*"), F.coalesce(F.sum(row_bytes(others)), F.lit(0))).first()
    if size[0]:
        others = others.withColumnRenamed("first", "other").withColumnsRenamed({c: f"_{c}" for c in same})
        small = broadcast_if_small(others, *size)
    rows = rows.join(F.broadcast(often), same, "left")
    if not size[0]:
        return rows
    alone = F.col("first").isNotNull() | (F.col("size") < least_bytes)
    rows = rows.withColumn("probe", F.when(alone, F.concat(F.lit("-"), F.xxhash64("id", "url").cast("string"))).otherwise(F.col("digest")))
    on = (F.col("probe") == F.col("_digest")) & (F.col("mark") == F.col("_mark")) & (F.col("size") == F.col("_size"))
    rows = rows.join(small, on, "left").withColumn("first", F.coalesce("first", "other"))
    return rows.drop("other", "probe", *(f"_{c}" for c in same))


def write_archives(
    pages: DataFrame,
    path: str,
    stamp: Column | None = None,
    least_bytes: int = 1000,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Write a record per row to gzipped archives below ``path``; returns the index of the captures.

    ``path`` must be shared by all machines. ``stamp`` gives the second (since 1970) of each capture; null or none is 0, and
    dates are kept within the years 1970 to 9999. The payload is the html in UTF-8; a null one is empty. Of rows with
    the same payload of ``least_bytes`` or more, the one with the largest id is stored, the others revisit it; rows that share
    that id are stored each, and rows without an id revisit as well if any row of the payload has one. A null URL has no target header, blanks in it get their
    percent form. Long pages are written whole. An empty table gives no archive. Other columns are not read.

    Payloads are compared by SHA-1, a second hash and length. Only the files of task attempts that Spark commits
    enter the index. The index is that of ``merge_runs``.
    """
    spark = pages.sparkSession
    small_batches(spark)
    payload = F.coalesce(F.col(html_column).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.lit(0) if stamp is None else stamp, F.lit(0)).cast("bigint").alias("stamp"),
        payload.alias("payload"),
    )
    rows = rows.withColumns({"digest": F.sha1("payload"), "mark": F.xxhash64("payload"), "size": F.octet_length("payload").cast("bigint")})
    rows = _with_leaders(rows, least_bytes)
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first.id"))
    rows = rows.select(
        "id", "url", "stamp", "size", "digest", url_key(F.col("url")).alias("urlkey"),
        F.when(again, F.col("first.id")).alias("first_id"),
        F.when(again, F.col("first.url")).alias("first_url"),
        F.when(again, F.col("first.stamp")).alias("first_stamp"),
        F.when(~again, F.col("payload")).alias("payload"),
    )

    def run(captures, name):
        captures.sort(key=lambda c: order_key(*c[:5]))
        columns = [[f"{name}/{captures[0][4]}"] * len(captures), range(len(captures)), *zip(*captures)]
        types = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in RUN.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    def write(batches):
        files, root = _place(path)
        files.create_dir(root, recursive=True)
        out = name = None
        place, captures = 0, []
        try:
            for batch in batches:
                for k in range(batch.num_rows):
                    page_id, url, stamp, size, digest, urlkey, first, first_url, first_stamp, body = (c[k].as_py() for c in batch.columns)
                    if out is None:
                        name, place = f"{TaskContext.get().partitionId():07d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                        info = [("WARC-Type", "warcinfo"), ("WARC-Date", _date(int(time.time()))), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("Content-Type", "application/warc-fields")]
                        out.write(head := _record(info, b"format: WARC File Format 1.1\r\n"))
                        place += len(head)
                    refers = (first, first_url, first_stamp) if first is not None else None
                    out.write(made := capture_record(page_id, url, stamp, size, digest, refers, body))
                    captures.append((urlkey, stamp, page_id, name, place, len(made), "revisit" if refers else "response"))
                    place += len(made)
                    if len(captures) >= RUN_CAPTURES or place >= ARCHIVE_BYTES:
                        yield run(captures, name)
                        captures = []
                    if place >= ARCHIVE_BYTES:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        if captures:
            yield run(captures, name)

    return merge_runs(staged(rows.mapInArrow(write, RUN), "runs"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)


def read_captures(index: DataFrame, path: str) -> DataFrame:
    """The records of the captures in ``index``, by file, offset and length, with ``urlkey`` and ``capture``.

    The captures of an archive are read by one task in the order of their places, so an archive
    is read once from front to back, whichever of its captures are wanted.
    """
    wanted = index.select("file", "offset", "length", "urlkey", "capture")
    files = wanted.agg(F.count_distinct("file")).first()[0]
    wanted = wanted.repartition(max(1, files), "file").sortWithinPartitions("file", "offset")

    def read(batches):
        system, root = _place(path)
        name = source = None
        for batch in batches:
            places = batch.to_pylist()
            at = 0
            while at < len(places):
                # Neighbours in a file are fetched at once, up to a bound or one record.
                first, end = places[at], at + 1
                while (
                    end < len(places)
                    and places[end]["file"] == first["file"]
                    and places[end]["offset"] + places[end]["length"] - first["offset"] <= READ_BYTES
                ):
                    end += 1
                if first["file"] != name:
                    if source is not None:
                        source.close()
                    name, source = first["file"], system.open_input_file(f"{root}/{first['file']}")
                last = places[end - 1]
                data = source.read_at(last["offset"] + last["length"] - first["offset"], first["offset"])
                rows = []
                for p in places[at:end]:
                    begin = p["offset"] - first["offset"]
                    rows.append(parsed(zlib.decompress(data[begin : begin + p["length"]], 31)))
                found = _batch(rows)
                for c, kind in (("urlkey", pa.string()), ("capture", pa.int64())):
                    found = found.append_column(c, pa.array([p[c] for p in places[at:end]], kind))
                yield found
                at = end

    return wanted.mapInArrow(read, RECORD + ", urlkey string, capture bigint")


def read_archives(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All captures of whole archives, read from front to back without an index, one task for each archive."""
    names = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = _place(path)
                with system.open_input_stream(place, compression=None) as source:
                    left, member, data = b"", zlib.decompressobj(31), []
                    while left or (left := source.read(READ_BYTES)):
                        data.append(member.decompress(left))
                        left = member.unused_data
                        if member.eof:
                            found = parsed(b"".join(data))
                            member, data = zlib.decompressobj(31), []
                            if found:
                                yield _batch([found])
                    if data:
                        raise OSError(f"{path} ends within a record")

    return names.mapInArrow(read, RECORD)
