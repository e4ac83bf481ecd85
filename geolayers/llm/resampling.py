"""Importance resampling towards a target: documents drawn by hashed feature weights.

Features are runs of words, hashed into buckets. A bucket's gain is the logarithm of its
smoothed share in the target over that in the corpus; a document's weight is the mean gain of
its features, looked up in an array. Weights with Gumbel noise, seeded by the document's id, give
a draw without replacement by taking the highest scores, which a distributed radix sort ranks.
"""

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from geolayers.llm.batches import small_batches
from geolayers.llm.bilinear_lm import coded
from geolayers.llm.radix import radix_placed
from geolayers.llm.word_ids import sliced
from geolayers.session import staged

BUCKETS_AT_MOST = 1 << 16


def _letters() -> np.ndarray:
    """Bytes of words, A-Z lower-cased; all others become a space. Bytes of letters beyond ASCII belong to words."""
    table = np.full(256, 32, np.uint8)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[first : last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


LETTERS = _letters()


def worded(texts: pa.Array) -> pa.Array:
    """The texts with spaces for all that is no part of a word; null is empty."""
    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(bounds - bounds[0]), pa.py_buffer(LETTERS[raw])])


def hashed(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, text by text; features and words of each text."""
    words, index, counts = coded(worded(texts))
    text_of = np.repeat(np.arange(len(counts)), counts)
    number = lambda found: np.fromiter((zlib.crc32(w) % buckets for w in found), np.int64, len(found))
    found, owner = [number(words)[index] if len(words) else index], [text_of]
    if longest > 1:
        row = runs = pa.array(words, pa.binary()).take(pa.array(index))
        for size in range(2, longest + 1):
            runs = pc.binary_join_element_wise(runs[: max(0, len(row) - size + 1)], row[size - 1 :], b" ")
            whole = np.flatnonzero(text_of[: len(runs)] == text_of[size - 1 :])
            distinct = runs.take(pa.array(whole)).dictionary_encode()
            found.append(number(distinct.dictionary.to_pylist())[distinct.indices.to_numpy()])
            owner.append(text_of[whole])
        order = np.argsort(np.concatenate(owner), kind="stable")
        found = [np.concatenate(found)[order]]
    sizes = sum(np.bincount(o, minlength=len(counts)) for o in owner)
    return found[0], sizes, counts


def _features(rows: DataFrame, kind: str, longest: int, buckets: int) -> DataFrame:
    """Of rows (id, text): id, n_features, n_words and the buckets as 16-bit numbers."""

    def read(batches):
        for batch in batches:
            for part in sliced(batch):
                found, sizes, words = hashed(part.column(1), longest, buckets)
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32) * 2
                data = pa.py_buffer(found.astype("<u2"))
                flat = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), data])
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(words, pa.int64()), flat]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "n_words", "buckets"])

    return rows.mapInArrow(read, f"doc_id {kind}, n_features bigint, n_words bigint, buckets binary")


def _numbers(column: pa.Array) -> np.ndarray:
    """The bucket numbers of an Arrow column, row by row."""
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, "<u2")[bounds[0] // 2 : bounds[-1] // 2] if data else np.zeros(0, "<u2")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Features of all rows in each bucket; every task adds up its own rows first."""

    def add(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0)), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (at, total[at])], names=["bucket", "n"])

    found = features.select("buckets").mapInArrow(add, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():  # one row for each bucket, a fixed number
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of each bucket's add-one share in the target over that in the corpus."""
    all_s, all_t, buckets = int(corpus.sum()), int(target.sum()), len(corpus)
    pairs = zip(corpus.tolist(), target.tolist())
    shares = (((t + 1) * (all_s + buckets)) / ((s + 1) * (all_t + buckets)) for s, t in pairs)
    return np.array([math.floor(1000 * math.log(x)) for x in shares], np.int64)


def _weighed(features: DataFrame, kind: str, gains: np.ndarray) -> DataFrame:
    """doc_id, n_features, n_words and the floored mean gain."""

    def weigh(batches):
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            total = np.concatenate([[0], np.cumsum(gains[_numbers(batch.column(3))])])
            ends = np.cumsum(sizes)
            weight = (total[ends] - total[ends - sizes]) // np.maximum(sizes, 1)
            columns = [*batch.columns[:3], pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "n_words", "weight"])

    return features.mapInArrow(weigh, f"doc_id {kind}, n_features bigint, n_words bigint, weight bigint")


def gumbel(id_column, seed: int):
    """Thousandths of a Gumbel draw that the seed and the id decide, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """doc_id, n_features, n_words, weight, score and rank of every document.

    Words are runs of digits, a-z (A-Z lower-cased) and letters beyond ASCII; features are all
    runs of 1 to ``longest`` words. Of the N documents with ``least_words`` words or more,
    floor(``percent`` * N / 100) are drawn: those with the highest scores, ties to the smaller id
    (an integer; null is the smallest). ``rank`` counts them from 1 and is null for all others. A null or empty text has no features
    and weight 0; a very long one is hashed whole, a slice of the batch at a time. Repeated rows count, are weighed
    and take places each. An empty target leaves the corpus's own frequencies to decide; an empty corpus gives
    no rows. Only the id and the text are read, so other columns cannot clash.

    Each text is hashed once; its bucket numbers (two bytes a feature) are stored and read
    again by the counting and the weighing. Counts of the ``buckets`` (65,536 at most) come to the driver, gains go to the tasks.
    """
    if not 0 < buckets <= BUCKETS_AT_MOST:
        raise ValueError(f"buckets must be 1 to {BUCKETS_AT_MOST}")
    small_batches(docs.sparkSession)
    text = F.col(text_column).cast("string").alias("text")
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text)
    features = staged(_features(rows, "bigint", longest, buckets), "features")
    aim = target.select(F.lit(None).cast("bigint").alias("doc_id"), F.col(target_column).cast("string").alias("text"))
    gains = bucket_gains(
        bucket_counts(features, buckets), bucket_counts(_features(aim, "bigint", longest, buckets), buckets)
    )
    weighed = _weighed(features, "bigint", gains)
    scored = staged(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "weights")
    able = scored.filter(F.col("n_words") >= least_words)
    placed = radix_placed(able.withColumn("down", -F.col("score")), ["down", "doc_id"]).drop("down")
    drawn = able.count() * percent // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank")
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return placed.select(*scored.columns, rank).unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs``, with their own columns; ids must be unique."""
    drawn = resample(docs, target, id_column=id_column, **options).filter("rank is not null")
    drawn = drawn.select(F.col("doc_id").alias("_drawn"))
    return docs.join(drawn, F.col(id_column).eqNullSafe(F.col("_drawn")), "left_semi")
