"""Language of a text: the one whose dictionary compresses it best."""

from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from geolayers.llm.batches import small_batches

LEVEL = 6
BLOCK = 2048  # bytes; every block meets the dictionary, so long texts keep their margin
LEARN = 4.0  # different texts looked at for each slice that is wanted
MOST_LANGUAGES = 200


def fold(column):
    """Which of the four folds a document is in: the checksum of its id as text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 4


def learn_dictionaries(
    labelled: DataFrame, text_column: str = "text", lang_column: str = "lang", slices: int = 128, slice_chars: int = 1024
) -> dict[str, bytes]:
    """Raw dictionary of each language: ``slices`` slices of ``slice_chars`` characters.

    The sample is bounded by these parameters whatever the input's size. Texts are
    chosen by the smallest hash, each different text once, after a filter on the hash
    leaves a few times as many as wanted and one at least, however often texts are
    repeated; so no group grows with the input and no language is left out. Rows with a null
    text or language are not learned from. The most frequent language
    comes first. More than ``MOST_LANGUAGES`` languages raise.
    """
    rows = labelled.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"))
    rows = rows.filter("lang is not null and text is not null and text <> ''")
    key = F.xxhash64("text")
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    texts = rows.groupBy("lang", key.alias("key")).agg(F.count("*").alias("n"))
    counts = texts.groupBy("lang").agg(F.sum("n").alias("count"), F.count("*").alias("texts"), F.min(draw).alias("least"))
    counts = counts.limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return {}
    share = rows.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, LEARN * slices / r["texts"]), r["least"]) for r in counts],
        "lang string, share double, least bigint",
    )
    begin = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - slice_chars, F.lit(1))) + 1
    near = rows.join(F.broadcast(share), "lang").select("lang", "text", "share", "least", key.alias("key"))
    near = near.filter((draw < F.col("share") * (1 << 30)) | (draw == F.col("least")))
    near = near.select("lang", "key", F.substring("text", begin.cast("int"), F.lit(slice_chars)).alias("slice"))
    near = near.groupBy("lang", "key").agg(F.min("slice").alias("slice"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "slice"))
    parts = near.withColumn("rank", rank).filter(F.col("rank") <= slices).orderBy("lang", "rank").collect()
    found: dict[str, list[str]] = {}
    for r in parts:
        found.setdefault(r["lang"], []).append(r["slice"].lower())
    ordered = sorted(counts, key=lambda r: (-r["count"], r["lang"]))
    return {r["lang"]: "\n".join(found[r["lang"]]).encode() for r in ordered if r["lang"] in found}


def sizes_of(text: str, compressors: list) -> list[int]:
    """Compressed bytes of the whole text under each dictionary, block by block."""
    raw = text.lower().encode()
    blocks = [raw[at : at + BLOCK] for at in range(0, len(raw), BLOCK)]
    return [sum(len(c.compress(b)) for b in blocks) for c in compressors]


def predict_languages(
    docs: DataFrame, dictionaries: dict[str, bytes], text_column: str = "text", least_margin: float = 0.005
) -> DataFrame:
    """Rows as ``row`` with ``lang_pred``, ``score`` and ``accepted``.

    ``score`` is the margin: how much smaller the best language's size is than the
    second's, as a share of the second's (1 if only one was learned). ``accepted``
    is false under ``least_margin``. Texts that are null or hold no letter are
    ``und`` with score 0 and not accepted, as is every text if nothing was learned.
    Equal sizes go to the language first in ``dictionaries``. Repeated rows are predicted
    each; ``row`` holds the input columns untouched, so no name can clash.
    """
    small_batches(docs.sparkSession)
    languages = list(dictionaries)
    shared = docs.sparkSession.sparkContext.broadcast(list(dictionaries.values()))

    @pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressors = []
        for raw in shared.value:
            dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False))
        for batch in texts:
            out = []
            for text in batch:
                if text is None or not compressors:
                    out.append(("und", 0.0))
                    continue
                sizes = sizes_of(text, compressors)
                best = min(sizes)
                second = sorted(sizes)[1] if len(sizes) > 1 else None
                out.append((languages[sizes.index(best)], 1.0 if second is None else (second - best) / second))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    name = next(c for c in docs.columns if c.lower() == text_column.lower())
    text = F.col(f"`{name}`").cast("string")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    found = docs.select(row, predict(F.when(text.rlike(r"\p{L}"), text)).alias("found"))
    accepted = (F.col("found.lang_pred") != "und") & (F.col("found.score") >= least_margin)
    return found.select("row", "found.*", accepted.alias("accepted"))


def kept_languages(docs: DataFrame, dictionaries: dict[str, bytes], **options) -> DataFrame:
    """The rows of ``docs`` whose language is clear, with their own columns."""
    return predict_languages(docs, dictionaries, **options).filter("accepted").select("row.*")
