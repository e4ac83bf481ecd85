"""Quality rules of documents, and of the hosts that publish them."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from geolayers.llm.batches import small_batches
from geolayers.session import broadcast_if_small, row_bytes, staged

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
CONTINUED = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
LEAST_WORDS, MOST_REPEATED = 50, 50  # words, and per cent of them in repeated windows


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    numbers = _Numbers()
    n = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    _, pair = np.unique(n[:-1] * len(numbers) + n[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * len(numbers) + n[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def text_features(text: bytes | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, SPACE + CONTINUED)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in FEATURES]))
def measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([text_features(t) for t in batch], columns=FEATURES, dtype="int64")


def beta_prior(hosts: int, docs: int, squares: float, failed: int, ratio: float) -> tuple[float, float]:
    """Beta prior of the hosts' failure rates by weighted moments.

    ``squares``: sum of docs^2; ``ratio``: sum of failed^2 / docs. The spread
    beyond what binomial draws give is the prior's; without any, the prior is as
    strong as a million documents.
    """
    mean = failed / docs
    if mean in (0.0, 1.0):
        return mean * 1e6 + 1e-6, (1 - mean) * 1e6 + 1e-6
    spread = (ratio - docs * mean * mean) / (mean * (1 - mean))
    room = docs - squares / docs - (hosts - 1)
    share = (spread - (hosts - 1)) / room if room > 0 else 0.0
    strength = 1 / min(max(share, 1e-6), 1 - 1e-6) - 1
    return mean * strength, (1 - mean) * strength


def judge_documents(
    docs: DataFrame, host_column: str = "source", text_column: str = "text", most_failed: float = 0.5
) -> DataFrame:
    """Rows as ``row`` with their ``measures``, ``base_failed``, ``host_failed`` and ``kept``.

    A document fails by itself with under 50 words or more than half of its words in
    repeated windows. A host fails if its rate of such documents, shrunk by the
    beta prior of all hosts, is over ``most_failed``; then none of its documents is
    kept. Null and empty texts have no words and fail. Documents with a null host
    are judged alone and stay out of the prior. Repeated rows count each. ``row`` holds every
    input column untouched, so no name can clash. An empty table gives no rows.

    Texts are measured once and stored in the session's shared folder; hosts are
    counted with partial sums, so a host with a third of the rows is no hot group.
    Only failed hosts are joined back: broadcast if measured to be small, else by a
    sort-merge join whose hot partitions Spark splits.
    """
    small_batches(docs.sparkSession)
    fields = {name.lower(): name for name in docs.columns}
    text, host = (F.col(f"`{fields[c.lower()]}`") for c in (text_column, host_column))
    measures = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        host.cast("string").alias("host"),
        measured(text.cast("binary")).alias("measures"),
    )
    n_words, repeated = F.col("measures.n_words"), F.col("measures.n_repeat_words")
    failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n_words)
    rows = staged(measures.withColumn("base_failed", failed), "quality")
    hosts = rows.filter("host is not null").groupBy("host")
    hosts = hosts.agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("bigint")).alias("f"))
    sums = hosts.agg(F.count("*"), F.sum("n"), F.sum(F.col("n").cast("double") ** 2), F.sum("f"), F.sum(F.expr("f * f / n")))
    sums = sums.first()
    alpha, beta = beta_prior(*sums) if sums[0] else (1.0, 1.0)
    bad = hosts.filter((F.col("f") + alpha) / (F.col("n") + alpha + beta) > most_failed).select("host")
    size = bad.agg(F.count("*"), F.coalesce(F.sum(row_bytes(bad)), F.lit(0))).first()
    bad = broadcast_if_small(bad.withColumn("host_failed", F.lit(True)), *size)
    host_failed = F.coalesce("host_failed", F.lit(False))
    return rows.join(bad, "host", "left").select(
        "row", "measures", "base_failed", host_failed.alias("host_failed"), (~F.col("base_failed") & ~host_failed).alias("kept")
    )


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    return judge_documents(docs, **options).filter("kept").select("row.*")
