"""Near-duplicate classes by DartMinHash signatures of weighted word shingles."""

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from geolayers.llm.batches import small_batches
from geolayers.llm.word_ids import sliced
from geolayers.session import broadcast_if_small, row_bytes, staged

WORDS = 5  # words of a shingle
ROWS, BANDS = 4, 32  # a pair of similarity 0.8 meets in no band once in 20 million
DARTS = ROWS * BANDS
FINE = 1024  # darts of the signatures by which crowded bands are compared
BLOCK = 2048  # members of a crowded band that meet in one comparison
# A key with a SHARE-th of the rows or more is broadcast; there are SHARE of them at most (32 times as many bands).
SHARE = 100
DEVIATIONS = 5  # of an estimate: pairs that look less similar by more are not compared exactly
BASE = np.uint64(0x9E3779B97F4A7C15)
LOW44 = np.uint64((1 << 44) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' shingles in a row (44 bits), and their count per text.

    Words are runs without ASCII white space, ASCII lower-cased. A text of one to four
    words is one shingle; one without words has none.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    index = coded.indices.to_numpy()
    if b"" in words:
        filled = index != words.index(b"")
        ends = np.cumsum(counts)
        before = np.concatenate([[0], np.cumsum(filled)])
        index, counts = index[filled], before[ends] - before[ends - counts]
    word = np.concatenate([hashes[index], np.zeros(WORDS, np.uint64)])
    place = np.arange(len(index)) - np.repeat(np.cumsum(counts) - counts, counts)
    left = np.repeat(counts, counts) - place  # words from here to the text's end
    with np.errstate(over="ignore"):
        found = np.zeros(len(index), np.uint64)
        for k in range(WORDS):
            found = found * BASE + np.where(left > k, word[k : k + len(index)], np.uint64(0))
        found = mixed(found) & LOW44
    whole = (left >= WORDS) | (place == 0)
    return found[whole], np.where(counts > 0, np.maximum(counts - WORDS + 1, 1), 0)


def cells(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit cells of weight: the text's number, and a hash of shingle and occurrence.

    A shingle found n times weighs n: its cells are [0, 1), [1, 2) and so on.
    """
    key = np.sort((np.repeat(np.arange(len(counts)).astype(np.uint64), counts) << np.uint64(44)) | found)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    again = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
    with np.errstate(over="ignore"):
        return (key >> np.uint64(44)).astype(np.int64), mixed((key & LOW44) + again.astype(np.uint64) * BASE)


def throw(owner: np.ndarray, cell: np.ndarray, weight: np.ndarray, darts: int = DARTS) -> np.ndarray:
    """The earliest dart of each text and coordinate, as a matrix of dart hashes.

    Into each cell darts fall one after the other, at times that depend on the cell
    alone; a text looks at the darts of its cells up to a time by which enough have
    fallen into all of its weight. Each dart has one coordinate. Two texts share a
    coordinate's earliest dart with the probability of their weighted Jaccard similarity.
    """
    texts = len(weight)
    dart = np.zeros((texts, darts), np.uint64)
    sure = math.log(darts) + 6  # darts per coordinate; texts with a gap look further
    open_ = weight > 0
    until = np.where(open_, sure * darts / np.maximum(weight, 1), 0.0)
    while open_.any():
        time = np.full(texts * darts, np.inf)
        mine = open_[owner]
        who, where = owner[mine], cell[mine]
        at = np.zeros(len(who))
        number = 0
        while len(who):
            with np.errstate(over="ignore"):
                draw = mixed(where + np.uint64(2 * number) * BASE)
                at = at - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53))
                on = at < until[who]
                who, where, at = who[on], where[on], at[on]
                own = mixed(where + np.uint64(2 * number + 1) * BASE)
            number += 1
            slot = who * darts + (own % np.uint64(darts)).astype(np.int64)
            before = time[slot]
            np.minimum.at(time, slot, at)
            best = (at < before) & (time[slot] == at)
            dart.reshape(-1)[slot[best]] = own[best]
        gap = np.isinf(time.reshape(texts, darts)).any(axis=1) & open_
        dart[gap] = 0
        open_ = gap
        until = np.where(gap, 2 * until, 0.0)
    return dart


@arrow_udf(T.ArrayType(T.LongType()))
def band_keys(texts: pa.Array) -> pa.Array:
    """Keys of the text's bands; none for a text without words."""
    keys, sizes = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for part in sliced(pa.RecordBatch.from_arrays([texts], names=["text"]), text_at=0):
        found, counts = shingles(part.column(0))
        matrix = throw(*cells(found, counts), counts)
        with np.errstate(over="ignore"):
            key = np.zeros((len(counts), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for k in range(ROWS):
                key = mixed(key * BASE + matrix[:, k::ROWS])
        keys.append(key[counts > 0].astype(np.int64).ravel())
        sizes.append(np.where(counts > 0, BANDS, 0))
    bounds = np.cumsum(np.concatenate(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(keys)))


@arrow_udf(T.BinaryType())
def fine_signature(texts: pa.Array) -> pa.Array:
    """Eight bits of each of ``FINE`` darts."""
    found = [np.zeros((0, FINE), np.uint8)]
    for part in sliced(pa.RecordBatch.from_arrays([texts], names=["text"]), text_at=0):
        hashes, counts = shingles(part.column(0))
        found.append((throw(*cells(hashes, counts), counts, FINE) >> np.uint64(40)).astype(np.uint8))
    ends = (np.arange(len(texts) + 1) * FINE).astype("<i4")
    return pa.Array.from_buffers(
        pa.binary(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(found).tobytes())]
    )


def weighted_jaccard(a: tuple, b: tuple) -> float:
    """Sum of the smaller over sum of the larger counts; a and b: sorted hashes and counts."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][left], b[1][right]).sum()
    return shared / (a[1].sum() + b[1].sum() - shared)


@arrow_udf(T.DoubleType())
def similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    """Weighted Jaccard similarity of the texts' shingles."""

    @lru_cache(64)
    def counted(text):
        return np.unique(shingles(pa.array([text]))[0], return_counts=True)

    return pa.array([weighted_jaccard(counted(x), counted(y)) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of all nodes of ``edges`` (a, b).

    Every round each node takes the smallest component among its neighbours and
    itself, then the component of that component; each round is stored.
    """
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("next"))
        upper = labels.select(F.col("node").alias("next"), F.col("component").alias("upper"))
        step = step.join(upper, "next").select("node", F.least("next", "upper").alias("new"), "component")
        step = staged(step, "labels")
        moved = step.filter("new < component").limit(1).count()
        labels = step.select("node", F.col("new").alias("component"))
        if not moved:
            return labels


def _often(found: DataFrame, count: str, total: int):
    """Is a key one of those that make up a ``SHARE``-th of ``total`` rows? There are ``SHARE`` at most."""
    return F.col(count) * SHARE >= F.lit(max(total, 1))


def _joined(rows: DataFrame, found: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join with a table of one row per key that counts the key's rows among ``total``.

    The few keys of many rows are broadcast; the others, none of which is much of a task, meet by shuffle.
    """
    often = _often(found, count, total)
    hot, cold = F.broadcast(found.filter(often)), found.filter(~often)
    spread = rows.join(F.broadcast(found.filter(often).select(*keys)), keys, "left_anti").join(cold, keys)
    return rows.join(hot, keys).unionByName(spread)


def _left_by_text(rows: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """Left join of rows (h1, h2) with a table of one row per text that counts its ``docs`` among ``total``.

    Frequent texts are broadcast. The others are broadcast by their measured size or meet by a shuffle, in which
    rows that have met already get a key of their own. Adaptive execution is not asked again: it weighs packed
    bytes, of which a table in memory takes several times as much.
    """
    often = _often(found, "docs", total)
    named = [c for c in found.columns if c not in ("h1", "h2")]
    cold = found.filter(~often).select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), *(F.col(c).alias(f"_{c}") for c in named))
    size = cold.agg(F.count("*"), F.coalesce(F.sum(row_bytes(cold)), F.lit(0))).first()
    rows = rows.join(F.broadcast(found.filter(often).withColumn("_met", F.lit(True))), ["h1", "h2"], "left")
    if size[0]:
        met = F.col("_met").isNotNull()
        # No text has two different hashes by chance: a row that has met gets the first one twice, salted by its id.
        probe = F.when(met, F.xxhash64(F.lit("met"), "own_id")).otherwise(F.col("h1"))
        on = (probe == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & ~met
        small = broadcast_if_small(cold, *size)
        rows = rows.join(small if small is not cold else cold.hint("merge"), on, "left")
        rows = rows.withColumns({c: F.coalesce(c, f"_{c}") for c in named}).drop("_h1", "_h2", *(f"_{c}" for c in named))
    return rows.drop("_met")


def _texts(wanted: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """node and text of the wanted nodes, stored."""
    wanted = wanted.distinct().join(nodes.select("node", "h1", "h2", F.col("doc_id").alias("first_id")), "node")
    # The id belongs to the key, so of many copies of a text one row alone goes to the text's task; equal
    # rows with an equal id are equal in all that counts.
    same = (texts["h1"] == wanted["h1"]) & (texts["h2"] == wanted["h2"]) & texts["doc_id"].eqNullSafe(wanted["first_id"])
    found = texts.join(wanted, same).select("node", "text").dropDuplicates(["node"])
    return staged(found, "texts")


def _linked(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity is at least ``least``, stored."""
    pairs = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    pairs = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    scored = pairs.select("a", "b", similarity("text_a", "text_b").alias("similarity"))
    return staged(scored.filter(F.col("similarity") >= least).select("a", "b"), "links")


def _close(groups: DataFrame, least: float) -> DataFrame:
    """Pairs of nodes in different components whose darts agree often enough, within blocks.

    Two nodes may meet in many bands; their pair is given by the first of them alone.
    """

    rough = least - DEVIATIONS * math.sqrt(least * (1 - least) / FINE)

    def compare(batches):
        # Rows of one (key, i, j) lie together: the task's rows are sorted by it.
        held, key = [], None

        def pairs():
            left = [r for r in held if r[2]]
            right = [r for r in held if not r[2]] or left
            a, b = (np.stack([np.frombuffer(r[5], np.uint8) for r in side]) for side in (left, right))
            na, nb = (np.array([r[3] for r in side]) for side in (left, right))
            ca, cb = (np.array([r[4] for r in side]) for side in (left, right))
            ka, kb = (np.array([r[6] for r in side]) for side in (left, right))
            band = held[0][1]
            for at in range(len(a)):
                agree = (a[at] == b).mean(axis=1)
                hit = np.flatnonzero((agree >= rough) & (cb != ca[at]))
                first = (kb[hit] == ka[at]).argmax(axis=1)
                hit = hit[ka[at][first] == band]
                if len(hit):
                    yield np.minimum(na[at], nb[hit]), np.maximum(na[at], nb[hit])

        def out():
            found = list(pairs()) if any(r[2] for r in held) else []
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                if row[0] != key:
                    yield from out()
                    held, key = [], row[0]
                held.append(row)
        yield from out()

    return groups.mapInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """Classes of texts linked by a similarity of at least ``least`` (0.8 or more).

    Returns two stored tables. ``rows``: one per document with doc_id, the text's two hashes
    h1 and h2. ``nodes``: one per different text with h1, h2, its smallest ``doc_id``
    and number of ``docs``, and ``class_id``, ``class_docs``: the smallest id and the number of
    documents of its class, ``first``: is it the class's first text.

    Equal texts are one node from the start. Nodes are banded; a band with several
    nodes links all to its leader, the node with the most neighbours in all its bands,
    if the exact similarity allows. Then only bands that still hold several
    components are looked at again: their nodes are compared with each other by
    their darts, a block at a time, and close ones exactly. So a large group of near
    copies costs a row per member and band, and no candidate is left out.

    A null text or one without words is alone in a class with its equals. Null ids
    count in ``class_docs`` and give no ``class_id``. Other columns are not read.
    """
    if least < 0.8:
        raise ValueError("bands are made for similarities of 0.8 and more")
    small_batches(docs.sparkSession)
    text = F.col(text_column).cast("string")
    hashes = F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")
    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text.alias("text"), *hashes)
    rows = staged(plain.select("doc_id", "h1", "h2", band_keys("text").alias("bands")), "signatures")
    nodes = rows.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("docs"), F.any_value("bands").alias("bands")
    )
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    bands = nodes.select("node", F.explode("bands").alias("key"))
    crowded = bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    crowded, different = staged(crowded, "crowded"), nodes.count()
    near = staged(_joined(bands, crowded, ["key"], "n", different), "bands")
    score = near.groupBy("node").agg(F.sum("n").alias("score"))
    leaders = near.join(score, "node").groupBy("key").agg(F.max(F.struct("score", "node"))["node"].alias("leader"))
    leaders = staged(leaders.join(crowded, "key"), "leaders")
    stars = _joined(near.drop("n"), leaders, ["key"], "n", different).filter("node <> leader")
    stars = stars.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    stars = staged(stars, "pairs")
    ends = stars.select(F.col("a").alias("node")).union(stars.select(F.col("b").alias("node")))
    texts = _texts(ends, nodes, plain)
    links = _linked(stars, texts, least)
    found = components(links)

    # What is still apart within a band.
    held = near.join(found, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    apart = held.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    held = staged(held.join(apart.select("key"), "key", "left_semi"), "apart")
    # Every node of a crowded band is an end of a star, so its text is stored already.
    again = staged(texts.join(held.select("node").distinct(), "node", "left_semi"), "texts")
    signed = again.select("node", fine_signature("text").alias("darts")).join(nodes.select("node", "bands"), "node")
    held = held.join(staged(signed, "signatures"), "node")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node", "key"), blocks).cast("int")
    held = held.withColumn("blocks", blocks).withColumn("block", block)
    # Block i meets every block j > i, and itself.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = held.select("*", other.alias("j"))
    group = F.struct("key", F.least("block", "j").alias("i"), F.greatest("block", "j").alias("j"))
    met = met.select(
        F.xxhash64(group).alias("group"), "key", (F.col("block") <= F.col("j")).alias("left"), "node", "component", "darts", "bands"
    )
    met = met.repartition("group").sortWithinPartitions("group")
    pairs = staged(_close(met, least), "pairs")
    links = links.union(_linked(pairs, again, least))
    found = components(links)

    named = nodes.drop("bands").join(found, "node", "left")
    named = staged(named.withColumn("component", F.coalesce("component", "node")), "members")
    classes = named.groupBy("component").agg(
        F.min("doc_id").alias("class_id"), F.sum("docs").alias("class_docs"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node"))["node"].alias("lead")
    )
    named = named.join(classes, "component").select(
        "h1", "h2", "doc_id", "docs", "class_id", "class_docs", (F.col("node") == F.col("lead")).alias("first")
    )
    return rows.select("doc_id", "h1", "h2"), staged(named, "classes")


def duplicate_classes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id and class_docs of every document."""
    rows, nodes = near_duplicates(docs, **options)
    found = _joined(rows, nodes.drop("doc_id"), ["h1", "h2"], "docs", rows.count())
    return found.select("doc_id", "class_id", "class_docs")


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One document of each class, with all its columns: the one with the smallest id.

    Only texts that several documents share, or that are not their class's first, are
    joined to the documents. Rows that repeat with id and text are one document.
    """
    rows, nodes = near_duplicates(docs, id_column, text_column, **options)
    listed = nodes.filter("docs > 1 or not first").select("h1", "h2", F.col("doc_id").alias("first_id"), "first", "docs")
    total = rows.count()
    stays = F.col("first").isNull() | (F.col("first") & F.col("own_id").eqNullSafe(F.col("first_id")))
    text = F.col(f"`{text_column}`").cast("string")
    held = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(f"`{id_column}`").cast("bigint").alias("own_id"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
    )
    kept = _left_by_text(held, listed, total).filter(stays)
    light = _left_by_text(rows.withColumnRenamed("doc_id", "own_id"), listed, total).filter(stays)
    twice = staged(light.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2"), "repeated")
    if twice.isEmpty():
        return kept.select("row.*")
    single = kept.join(twice, ["h1", "h2"], "left_anti").select("row")
    repeated = kept.join(twice, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]).select("row")
    return single.union(repeated).select("row.*")
