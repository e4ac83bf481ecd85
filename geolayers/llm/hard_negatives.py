"""Hard negatives: rows of other labels that score a little below an anchor's positives.

All rows are candidates. They are stored in blocks along a Hilbert curve, and each block
has a zone map: the least and greatest value of every dimension, and of the label. What an anchor can score
with the rows of a block lies between two bounds by interval arithmetic; a block is read if some anchor's
window of scores meets them, and only the anchors that need a block are multiplied with it.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from geolayers.llm.hilbert import hilbert_keys
from geolayers.llm.topk import exact_type
from geolayers.session import staged

BLOCK_ROWS = 256
GROUP_ROWS = 512
ZONES = 256
BITS = 2
# Quartiles of a normal distribution: where a dimension's levels part, in standard deviations.
QUARTILE = 0.6745
# Groups of anchors whose best rows a task holds at once.
HELD = 64
LOWEST = np.iinfo(np.int64).min
GREATEST = np.iinfo(np.int64).max
BLOCK = (
    "block bigint, dim int, n int, label_min bigint, label_max bigint, low binary, high binary,"
    " ids binary, labels binary, asked binary, kind string, vectors binary"
)
GROUP = "group bigint, dim int, size int, slots int, aids binary, alabels binary, akind string, avectors binary, lows binary, highs binary"


def _matrix(batch: pa.RecordBatch, name: str = "v") -> tuple[np.ndarray, np.ndarray]:
    """Where each list of a batch begins, and all their numbers in a row."""
    lists = batch.column(name)
    return lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.int64)


def _by_dimension(batch: pa.RecordBatch):
    """(dim, rows of that dimension, their matrix) of a batch."""
    bounds, flat = _matrix(batch)
    dims = np.diff(bounds)
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        yield int(dim), rows, flat[(bounds[rows][:, None] + np.arange(dim)[None, :]).ravel()].reshape(len(rows), dim)


def _record(values: list, schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[k]) for v, (_, k) in zip(values, fields)], names=[n for n, _ in fields])


def _kind(low: np.ndarray, high: np.ndarray) -> str:
    """The narrowest type that holds numbers from ``low`` to ``high``."""
    wide = max((abs(int(x)) for x in (low.min(), high.max())), default=0) if low.size else 0
    return "<i2" if wide < 1 << 15 else "<i4" if wide < 1 << 31 else "<i8"


def _spread(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each vector length its dimensions by falling variance, their means and standard deviations."""

    def add(batches):
        held = {}
        for batch in batches:
            for dim, _, matrix in _by_dimension(batch):
                part = np.stack([np.full(dim, len(matrix)), matrix.sum(axis=0), (matrix.astype(float) ** 2).sum(axis=0)])
                held[dim] = held.get(dim, 0) + part
        for dim, (n, total, squares) in held.items():
            columns = [np.full(dim, dim), np.arange(dim), n, total, squares]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(float)) for c in columns], names=["dim", "at", "n", "s", "q"])

    kind = "dim double, at double, n double, s double, q double"
    sums = rows.select("v").mapInArrow(add, kind).groupBy("dim", "at").agg(F.sum("n"), F.sum("s"), F.sum("q"))
    out: dict[int, np.ndarray] = {}
    for dim, at, n, s, q in sums.collect():  # one row for each dimension of each vector length
        out.setdefault(int(dim), np.zeros((2, int(dim))))[:, int(at)] = s / n, max(0.0, q / n - (s / n) ** 2) ** 0.5
    return {dim: (np.argsort(-found[1], kind="stable"), *found) for dim, found in out.items()}


def _curve(rows: DataFrame) -> DataFrame:
    """Rows with their length and their place on the Hilbert curve, the widest dimensions first."""
    spread = _spread(rows)
    columns = rows.columns

    def place(batches):
        for batch in batches:
            for dim, at, matrix in _by_dimension(batch):
                order, mean, deviation = spread.get(dim, (np.zeros(0, np.int64), *np.zeros((2, dim))))
                z = (matrix - mean) / np.where(deviation > 0, deviation, 1)
                levels = np.searchsorted([-QUARTILE, 0.0, QUARTILE], z[:, order].ravel()).reshape(z.shape)
                keys = hilbert_keys(levels, BITS) if dim else np.zeros((len(at), 0), np.uint8)
                part = batch.take(pa.array(at))
                part = part.append_column("dim", pa.array(np.full(len(at), dim), pa.int32()))
                yield part.append_column("place", pa.array([k.tobytes() for k in keys], pa.binary()))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(place, f"{kinds}, dim int, place binary").select(*columns, "dim", "place")


def candidate_blocks(rows: DataFrame) -> DataFrame:
    """Rows (id, label, asked, v) as stored blocks of ``BLOCK``, ordered by label and along the curve.

    The id ends the sorting key, so many equal vectors still spread over tasks and blocks.
    """
    order = ["dim", "label", "place", "id"]
    sorted_rows = _curve(rows).repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches):
        first, number, held, count = TaskContext.get().partitionId() << 32, 0, [], 0

        def emit():
            ids, labels, asked, matrix = (np.concatenate(x) for x in zip(*held))
            low, high = (f(axis=0) if matrix.shape[1] else np.zeros(0, np.int64) for f in (matrix.min, matrix.max))
            kind = _kind(low, high)
            sides = [x.astype("<i8").tobytes() for x in (low, high, ids, labels)]
            values = [first + number, matrix.shape[1], len(ids), int(labels.min()), int(labels.max()), *sides]
            return _record([*values, asked.astype("u1").tobytes(), kind, matrix.astype(kind).tobytes()], BLOCK)

        for batch in batches:
            for dim, at, matrix in _by_dimension(batch):
                part = batch.take(pa.array(at))
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "label"))
                asked = part.column("asked").to_numpy(zero_copy_only=False).astype(bool)
                if held and held[0][3].shape[1] != dim:
                    yield emit()
                    held, count, number = [], 0, number + 1
                k = 0
                while k < len(ids):
                    end = min(len(ids), k + BLOCK_ROWS - count)
                    held.append((ids[k:end], labels[k:end], asked[k:end], matrix[k:end]))
                    count, k = count + end - k, end
                    if count == BLOCK_ROWS:
                        yield emit()
                        held, count, number = [], 0, number + 1
        if held:
            yield emit()

    return staged(sorted_rows.mapInArrow(pack, BLOCK), "blocks")


class Block:
    """A block's columns as arrays; the vectors are decoded when asked for."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        cell = lambda name: batch.column(name)[at]
        self.block, self.dim, self.n = (cell(c).as_py() for c in ("block", "dim", "n"))
        self.kind, self.raw = cell("kind").as_py(), cell("vectors").as_buffer()
        self.ids, self.labels, self.low, self.high = (np.frombuffer(cell(c).as_buffer(), "<i8") for c in ("ids", "labels", "low", "high"))
        self.label_min, self.label_max = cell("label_min").as_py(), cell("label_max").as_py()

    def vectors(self) -> np.ndarray:
        return np.frombuffer(self.raw, self.kind).reshape(self.n, self.dim).astype(np.int64)


class Group:
    """Anchors with their windows: slot s of anchor a takes scores from lows[a, s] to highs[a, s]."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        cell = lambda name: batch.column(name)[at]
        self.dim, self.n, slots = (cell(c).as_py() for c in ("dim", "size", "slots"))
        read = lambda name: np.frombuffer(cell(name).as_buffer(), "<i8")
        self.ids, self.labels = read("aids"), read("alabels")
        self.vectors = np.frombuffer(cell("avectors").as_buffer(), cell("akind").as_py()).reshape(self.n, self.dim).astype(np.int64)
        self.lows, self.highs = (read(c).reshape(self.n, slots) for c in ("lows", "highs"))
        self.above, self.below = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each anchor can have in each zone (rows of ``low`` and ``high``)."""
        dtype = exact_type(self.vectors, np.concatenate([low, high]))
        above, below, low, high = (x.astype(dtype) for x in (self.above, self.below, low, high))
        least, most = above @ low.T + below @ high.T, above @ high.T + below @ low.T
        return least.astype(np.int64), most.astype(np.int64)

    def label_fits(self, least: np.ndarray, most: np.ndarray, same: bool) -> np.ndarray:
        """Can a zone with these labels hold rows of the anchor's label, or of another one?"""
        own = self.labels[:, None]
        return (least <= own) & (own <= most) if same else (least != own) | (most != own)


def needs(least, most, fits, lows, highs) -> np.ndarray:
    """Anchors (rows) by zones (columns): does one of the anchor's windows meet the zone's bounds?"""
    meets = np.zeros(fits.shape, bool)
    for low, high in zip(lows.T, highs.T):
        meets |= (low <= high)[:, None] & (most >= low[:, None]) & (least <= high[:, None])
    return meets & fits


class Best:
    """The best ``keep`` rows of each window so far, higher scores and smaller ids first."""

    def __init__(self, group: Group, keep: int):
        self.group, self.keep = group, keep
        self.scores = np.full((*group.lows.shape, keep), LOWEST)
        self.ids = np.full((*group.lows.shape, keep), GREATEST)

    def look(self, block: Block, same: bool) -> int:
        """Take in a block; returns the number of anchors that had to be multiplied with it."""
        g = self.group
        # A window that is full wants no row below its worst; an equal score may have a smaller id.
        lows = np.maximum(g.lows, self.scores[:, :, -1])
        fits = g.label_fits(np.array([block.label_min]), np.array([block.label_max]), same)
        least, most = g.bounds(block.low[None, :], block.high[None, :])
        rows = np.flatnonzero(needs(least, most, fits, lows, g.highs)[:, 0])
        if not len(rows):
            return 0
        vectors = block.vectors()
        dtype = exact_type(g.vectors[rows], vectors)
        scores = (g.vectors[rows].astype(dtype) @ vectors.astype(dtype).T).astype(np.int64)
        allowed = (block.labels[None, :] == g.labels[rows][:, None]) == same
        allowed &= block.ids[None, :] != g.ids[rows][:, None]
        for slot in range(g.lows.shape[1]):
            inside = allowed & (scores >= lows[rows, slot][:, None]) & (scores <= g.highs[rows, slot][:, None])
            some = np.flatnonzero(inside.any(axis=1))
            if not len(some):
                continue
            at = rows[some]
            own = np.where(inside[some], scores[some], LOWEST)
            ids = np.where(inside[some], block.ids[None, :], GREATEST)
            own, ids = np.concatenate([self.scores[at, slot], own], axis=1), np.concatenate([self.ids[at, slot], ids], axis=1)
            # Places are compared by falling score: ~ turns the order without overflow.
            order = np.lexsort((ids, ~own), axis=-1)[:, : self.keep]
            self.scores[at, slot] = np.take_along_axis(own, order, axis=1)
            self.ids[at, slot] = np.take_along_axis(ids, order, axis=1)
        return len(rows)

    def rows(self) -> pa.RecordBatch:
        anchor, slot, place = np.nonzero(self.scores != LOWEST)
        columns = self.group.ids[anchor], slot, self.ids[anchor, slot, place], self.scores[anchor, slot, place]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "slot", "id", "score"])


def _groups(anchors: DataFrame, slots: int) -> DataFrame:
    """Anchors (id, dim, label, vector, lows, highs) as stored matrices of ``GROUP_ROWS`` rows or fewer."""
    count = anchors.count()
    dealt = anchors.repartition(max(1, -(-count // GROUP_ROWS)))

    def pack(batches):
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                part = held.setdefault(row["dim"], [])
                part.append(row)
                if len(part) == GROUP_ROWS:
                    yield group(number, held.pop(row["dim"]))
                    number += 1
        for part in held.values():
            yield group(number, part)
            number += 1

    def group(number, rows):
        lows, highs = np.ones((len(rows), slots), "<i8"), np.zeros((len(rows), slots), "<i8")  # none: from 1 to 0
        for k, row in enumerate(rows):
            lows[k, : len(row["lows"])], highs[k, : len(row["highs"])] = row["lows"], row["highs"]
        ids, labels = (np.array([row[c] for row in rows], "<i8").tobytes() for c in ("id", "label"))
        vectors = np.frombuffer(b"".join(row["vector"] for row in rows), "<i8")
        kind = _kind(vectors, vectors)
        sides = [vectors.astype(kind).tobytes(), lows.tobytes(), highs.tobytes()]
        return _record([number, rows[0]["dim"], len(rows), slots, ids, labels, kind, *sides], GROUP)

    return staged(dealt.mapInArrow(pack, GROUP), "anchors")


def _meet(groups: DataFrame, others: DataFrame, key: str, rows: int) -> DataFrame:
    """Every group with every row of ``others`` of its dimension: rows are dealt to lanes, groups go to each lane.

    The copies of the groups are shuffled and never broadcast: the driver would hold those of all lanes, though their
    files look small. There are no more copies than rows, unless each core needs them to get its lanes.
    """
    spark = groups.sparkSession
    wide = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    even = max(2 * spark.sparkContext.defaultParallelism, rows // max(1, groups.count()))
    lanes = max(1, min(rows, wide, even))
    lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane")
    dealt = others.withColumn("lane", F.pmod(F.xxhash64(key), F.lit(lanes)).cast("int"))
    return groups.select("*", lane).hint("merge").join(dealt, ["lane", "dim"])


def wanted_blocks(blocks: DataFrame, groups: DataFrame, same: bool) -> DataFrame:
    """block: those whose zone map says that some anchor's window can be met. The vectors stay unread."""
    zone = ["label_min", "label_max", "low", "high"]
    chunk = "dim int, chunk bigint, blocks binary, least binary, most binary, low binary, high binary"

    def pack(batches):
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def emit(dim, rows):
            flat = [np.array([r[c] for r in rows], "<i8").tobytes() for c in ("block", "label_min", "label_max")]
            return _record([dim, number, *flat, *(b"".join(r[c] for r in rows) for c in ("low", "high"))], chunk)

        for batch in batches:
            for row in batch.to_pylist():
                part = held.setdefault(row["dim"], [])
                part.append(row)
                if len(part) == ZONES:
                    yield emit(row["dim"], held.pop(row["dim"]))
                    number += 1
        for dim, part in held.items():
            yield emit(dim, part)
            number += 1

    chunks = staged(blocks.select("block", "dim", *zone).mapInArrow(pack, chunk), "zones")

    def choose(batches):
        found = set()
        for batch in batches:
            for at in range(batch.num_rows):
                group = Group(batch, at)
                read = lambda name: np.frombuffer(batch.column(name)[at].as_buffer(), "<i8")  # noqa: B023, E731
                ids = read("blocks")
                bounds = group.bounds(*(read(c).reshape(len(ids), group.dim) for c in ("low", "high")))
                fits = group.label_fits(read("least"), read("most"), same)
                found.update(ids[needs(*bounds, fits, group.lows, group.highs).any(axis=0)].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["block"])

    return _meet(groups, chunks, "chunk", chunks.count()).mapInArrow(choose, "block bigint").distinct()


def search(blocks: DataFrame, groups: DataFrame, same: bool, keep: int) -> DataFrame:
    """anchor, slot, id, score, rank: the first ``keep`` rows in each window of each anchor."""
    wanted = staged(wanted_blocks(blocks, groups, same), "wanted")
    read = blocks.drop("asked").join(wanted, "block", "left_semi")

    def look(batches):
        held: dict[int, Best] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                group = batch.column("group")[at].as_py()
                if group not in held:
                    if len(held) == HELD:
                        yield held.pop(next(iter(held))).rows()
                    held[group] = Best(Group(batch, at), keep)
                held[group].look(Block(batch, at), same)
        for best in held.values():
            yield best.rows()

    met = _meet(groups, read, "block", wanted.count())
    found = met.mapInArrow(look, "anchor bigint, slot bigint, id bigint, score bigint")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _anchors(blocks: DataFrame, positives: int) -> DataFrame:
    """id, dim, label, vector and the first window of each anchor, which its home block bounds from below."""
    schema = "id bigint, dim int, label bigint, vector binary, low bigint"

    def find(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                at = np.flatnonzero(np.frombuffer(batch.column("asked")[k].as_buffer(), "u1"))
                if not len(at):
                    continue
                block = Block(batch, k)
                vectors = block.vectors()
                dtype = exact_type(vectors, vectors)
                scores = (vectors[at].astype(dtype) @ vectors.astype(dtype).T).astype(np.int64)
                other = (block.labels[at][:, None] == block.labels[None, :]) & (block.ids[at][:, None] != block.ids[None, :])
                scores = np.where(other, scores, LOWEST)
                low = np.partition(scores, block.n - positives, axis=1)[:, block.n - positives] if block.n >= positives else np.full(len(at), LOWEST)
                columns = [block.ids[at].tolist(), [block.dim] * len(at), block.labels[at].tolist(), [v.astype("<i8").tobytes() for v in vectors[at]], low.tolist()]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["id", "dim", "label", "vector", "low"])

    found = blocks.mapInArrow(find, schema)
    one = found.groupBy("id").agg(F.max(F.struct("label", "vector", "dim", "low")).alias("a"))
    return staged(one.select("id", "a.dim", "a.label", "a.vector", "a.low"), "asked")


def mine_hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 5,
    from_percent: int = 80,
    to_percent: int = 100,
    scale: float = 256.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components become floor(``scale`` * x); a score is the inner product with the anchor, and higher scores come first, ties by
    smaller id. An anchor's positives are its first ``positives`` rows of the same label with another id. For each, the first
    ``negatives`` rows of another label and id are given whose score is ``from_percent`` to ``to_percent`` per cent of the positive's, ranked
    from 1; a positive without such rows gives none. ``is_anchor`` is a condition on the column ``id``; ``label`` (a whole
    number) is computed from the row, by default its column ``label``.

    Rows with a null id, label or vector, or with a component that is null, NaN or infinite take no part. Vectors of
    different lengths never meet; those of any length are taken whole. Repeated rows are candidates each; an id that repeats is asked once, with its greatest label
    and vector. An empty table gives no rows; other columns are not read. Scores beyond 64 bits are an error.

    Results are exact: blocks are left out only if their bounds show that none of their rows is wanted.
    """
    id_, value = F.col(id_column).cast("bigint"), F.col(vector_column).cast("array<double>")
    sound = value.isNotNull() & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label") if label is None else label
    rows = embeddings.select(
        id_.alias("id"),
        label.cast("bigint").alias("label"),
        F.when(sound, F.transform(value, lambda x: F.floor(F.lit(scale) * x).cast("bigint"))).alias("v"),
    ).filter("id is not null and label is not null and v is not null")
    blocks = candidate_blocks(rows.select("id", "label", F.coalesce(is_anchor, F.lit(False)).alias("asked"), "v"))
    anchors = _anchors(blocks, positives)
    first = anchors.select("*", F.array("low").alias("lows"), F.array(F.lit(GREATEST)).alias("highs")).drop("low")
    near = search(blocks, _groups(first, 1), True, positives)
    near = staged(near.select("anchor", F.col("id").alias("positive_id"), "rank", F.col("score").alias("positive_score")), "positives")
    # Of whole hundreds and the rest, so that no product overflows.
    whole, part = F.expr("positive_score div 100"), F.expr("positive_score % 100")
    low = whole * from_percent + F.ceil(part * from_percent / F.lit(100.0)).cast("bigint")
    high = whole * to_percent + F.floor(part * to_percent / F.lit(100.0)).cast("bigint")
    windows = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("w"))
    asked = anchors.join(windows, anchors["id"] == windows["anchor"])
    asked = asked.select("id", "dim", "label", "vector", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    found = search(blocks, _groups(staged(asked, "windows"), positives), False, negatives)
    found = found.select("anchor", (F.col("slot") + 1).alias("_slot"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    near = near.withColumnRenamed("rank", "_slot")
    return found.join(near, ["anchor", "_slot"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
