"""Packing by power-of-two decomposition: no sequence holds two documents."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from geolayers.llm.batches import small_batches
from geolayers.llm.word_ids import encoder, sliced

PIECE = "doc_id bigint, start bigint, length bigint, bucket int, doc_tokens bigint, offset bigint, ids binary"


def decomposed(sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and length of each piece: as many of ``longest`` as fit, then the bits of the rest."""
    bits = longest.bit_length() - 1
    powers = 1 << np.arange(bits - 1, -1, -1)
    counts = np.concatenate([(sizes // longest)[:, None], (sizes[:, None] & powers) > 0], axis=1)
    lengths = np.tile(np.concatenate([[longest], powers]), len(sizes))
    rows = np.repeat(np.arange(len(sizes)), bits + 1)
    return np.repeat(rows, counts.ravel()), np.repeat(lengths, counts.ravel())


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    longest: int = 4096,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Cut every document into pieces of power-of-two lengths, each a sequence of its own.

    A document of n tokens (with its end id) gives n // ``longest`` pieces of
    ``longest`` and one piece per binary digit of the rest, so no sequence is padded
    and ``bucket`` (the length's exponent) holds sequences of one length, ready to be
    batched or written with ``partitionBy("bucket")``. One row per piece:
    ``sequence_id`` is unique and follows the order of the input within a task;
    ``ids`` are 32-bit little-endian. A null text is empty (one piece: the end id);
    repeated rows give their own pieces; an empty table gives none; no column
    besides id and text is read. There is no shuffle, and a task holds some
    megabytes of text.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    small_batches(docs.sparkSession)

    def cut(batches):
        encode = encoder(tokenizer, end_id)
        for batch in batches:
            for part in sliced(batch):
                flat, sizes = encode.encode(part.column(1))
                rows, lengths = decomposed(sizes, longest)
                ends = np.cumsum(lengths)
                begin = (np.cumsum(sizes) - sizes)[rows]
                bounds = np.concatenate([[0], ends * 4]).astype("<i4")
                ids = pa.Array.from_buffers(
                    pa.binary(), len(rows), [None, pa.py_buffer(bounds), pa.py_buffer(flat.astype("<u4"))]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)),
                        pa.array(ends - lengths - begin, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(np.log2(lengths).astype(np.int32)),
                        pa.array(sizes[rows], pa.int64()),
                        pa.array(np.zeros(len(rows), np.int64)),
                        ids,
                    ],
                    names=["doc_id", "start", "length", "bucket", "doc_tokens", "offset", "ids"],
                )

    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECE).withColumn("sequence_id", F.monotonically_increasing_id())
