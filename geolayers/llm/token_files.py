"""Flat files of token ids with 64-bit document offsets, written and read by Spark tasks.

A folder holds shards ``NAME.bin`` (unsigned 16-bit ids when the vocabulary
allows it, else 32-bit, little-endian, nothing between documents), ``NAME.off``
(64-bit offsets of the documents in the shard, one more than documents),
``NAME.doc`` (64-bit document ids, then one byte each: is the id not null), and
the Parquet table ``shards``: for each shard its counts and its base, which is the
prefix sum of the token counts before it. Global offset = base + shard offset.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from geolayers.llm.batches import small_batches
from geolayers.llm.word_ids import encoder, sliced

SHARD = "name string, first_id bigint, first_hash bigint, docs bigint, tokens bigint, width int"
READ_BYTES = 8 << 20


def _place(path: str):
    """File system and path; a path without scheme is a folder all machines see."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return pafs.LocalFileSystem(), path


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Encode every whole text and write the ids in ascending order of the id.

    ``path`` must be shared by all machines. Rows with a null id come first; equal
    ids are ordered by their texts' hash; a null text is empty and gives the end id
    alone. Other columns are not read. Each task attempt writes files of its own
    name; only those of attempts that Spark commits enter the table ``shards``, so
    lost executors and repeated attempts leave no trace in what is read. An empty
    table gives no shard.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(text_column).cast("string").alias("text"),
        F.xxhash64(text_column).alias("hash"),
    )
    # The hash in the key keeps rows that share an id from meeting in one task.
    ordered = rows.repartitionByRange("id", "hash").sortWithinPartitions("id", "hash")

    def write(batches):
        files, root = _place(path)
        files.create_dir(root, recursive=True)
        name = f"{TaskContext.get().partitionId():07d}-{uuid.uuid4().hex}"
        encode = encoder(tokenizer, end_id)
        dtype = "<u2" if max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        first, tokens, ids, known, offsets, out = None, 0, [], [], [np.zeros(1, "<i8")], None
        try:
            for batch in batches:
                for part in sliced(batch):
                    if out is None:
                        out = files.open_output_stream(f"{root}/{name}.bin")
                        first = part.column(0)[0].as_py(), part.column(2)[0].as_py()
                    flat, sizes = encode.encode(part.column(1))
                    out.write(flat.astype(dtype).tobytes())
                    offsets.append(tokens + np.cumsum(sizes).astype("<i8"))
                    tokens += len(flat)
                    ids.append(part.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                    known.append(part.column(0).is_valid().to_numpy(zero_copy_only=False).astype("u1"))
        finally:
            if out is not None:
                out.close()
        if out is None:
            return
        with files.open_output_stream(f"{root}/{name}.off") as side:
            side.write(np.concatenate(offsets).tobytes())
        with files.open_output_stream(f"{root}/{name}.doc") as side:
            side.write(np.concatenate(ids).tobytes() + np.concatenate(known).tobytes())
        docs_here = sum(map(len, ids))
        row = [[name], [first[0]], [first[1]], [docs_here], [tokens], [int(dtype[-1])]]
        types = [pa.string(), *[pa.int64()] * 4, pa.int32()]
        names = ["name", "first_id", "first_hash", "docs", "tokens", "width"]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)

    ordered.mapInArrow(write, SHARD).write.parquet(f"{path}/written")
    shards = spark.read.schema(SHARD).parquet(f"{path}/written")
    # One row per shard, never per document.
    before = Window.orderBy("first_id", "first_hash", "name").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")
    shards.select("*", base).write.parquet(f"{path}/shards")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens and ids (32-bit little-endian).

    Shards are memory-mapped where the folder is mounted and read by ranges
    elsewhere; a task holds a few megabytes of a shard at a time.
    """
    shards = spark.read.schema(SHARD + ", base bigint").parquet(f"{path}/shards")
    places = shards.select("name", "docs", "tokens", "width", "base")

    def read(batches):
        files, root = _place(path)
        local = isinstance(files, pafs.LocalFileSystem)
        for batch in batches:
            for shard in batch.to_pylist():
                at, docs = f"{root}/{shard['name']}", shard["docs"]
                with files.open_input_file(f"{at}.off") as side:
                    off = np.frombuffer(side.read(), "<i8")
                with files.open_input_file(f"{at}.doc") as side:
                    raw = side.read()
                if len(off) != docs + 1 or off[-1] != shard["tokens"] or len(raw) != 9 * docs:
                    raise OSError(f"shard {shard['name']} is not complete")
                ids, known = np.frombuffer(raw, "<i8", docs), np.frombuffer(raw, "u1", docs, 8 * docs)
                dtype = np.dtype(f"<u{shard['width']}")
                ranged = None if local else files.open_input_file(f"{at}.bin")
                mapped = np.memmap(f"{at}.bin", dtype, "r") if local else None
                group = off[1:] * 4 // READ_BYTES
                cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), docs]
                for a, b in zip(cuts, cuts[1:]):
                    lo, hi = int(off[a]), int(off[b])
                    if local:
                        flat = mapped[lo:hi]
                    else:
                        flat = np.frombuffer(ranged.read_at((hi - lo) * dtype.itemsize, lo * dtype.itemsize), dtype)
                    if len(flat) != hi - lo:
                        raise OSError(f"shard {shard['name']} is not complete")
                    bounds = ((off[a : b + 1] - lo) * 4).astype("<i4")
                    data = pa.Array.from_buffers(
                        pa.binary(), b - a, [None, pa.py_buffer(bounds), pa.py_buffer(flat.astype("<u4"))]
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[a:b], pa.int64(), mask=known[a:b] == 0),
                            pa.array(shard["base"] + off[a:b], pa.int64()),
                            pa.array(np.diff(off[a : b + 1]), pa.int64()),
                            data,
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    # Shards are of about one size; each goes to a task of its own.
    spread = places.repartition(max(1, places.count()))
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
