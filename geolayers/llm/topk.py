"""Exact top-k by inner product: sorted lists read in order, with score bounds."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from geolayers.llm.batches import one_thread
from geolayers.session import staged

BLOCK_ROWS = 8192
QUERY_ROWS = 1024
# How far all lists are read before the bounds are taken, as shares of their length.
DEPTHS = (0.05, 0.1, 0.2, 0.4, 0.6, 0.8, 0.9, 1.0)
# Queries whose bounds tell whether a look at all queries settles most of them.
PROBES = 16
# Queries whose bounds are held at once, so that they fit a core's cache.
LOOK_ROWS = 256
# Blocks of candidates that a lane has at most, and blocks of queries that it meets at most.
LANE_BLOCKS = 16
SET_BLOCKS = 128
# Bounds of a block up to so many bytes are kept for its next queries.
KEPT_BYTES = 8 << 20
LOWEST = np.iinfo(np.int64).min
GREATEST = np.iinfo(np.int64).max
BLOCK = "dim int, block bigint, n int, kind string, ids binary, vectors binary"


def exact_type(queries: np.ndarray, vectors: np.ndarray):
    """The narrowest type in which every sum of products of the two is exact."""
    largest = [int(max(abs(int(m.max())), abs(int(m.min())))) if m.size else 0 for m in (queries, vectors)]
    bound = largest[0] * largest[1] * max(1, vectors.shape[1])
    if bound >= 1 << 63:
        raise OverflowError("scores beyond 64 bits")
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


class SortedLists:
    """For each component, the vectors in descending and in ascending order.

    Reading is sequential: ``read(depth)`` takes the first entries of every list, down to its
    frontier (the last value read); what is unread lies between the frontier and the list's far
    end. A query reads a component's descending list if its own value is positive,
    else the ascending one; in both its products get smaller along the list.
    """

    def __init__(self, vectors: np.ndarray, dtype):
        self.plain = vectors.astype(dtype)
        self.sorted = np.sort(self.plain, axis=0)
        self.kept: dict[int, np.ndarray] = {}
        self.read(0)

    def read(self, depth: int):
        n = len(self.plain)
        self.depth = depth
        self.frontier = self.sorted[n - max(1, depth)], self.sorted[max(1, depth) - 1]

    @property
    def best(self) -> np.ndarray:
        """Best value that each entry can still have: first the descending lists, where what is unread is not above the frontier."""
        found = self.kept.get(self.depth)
        if found is None:
            high, low = self.frontier
            found = np.concatenate([np.maximum(self.plain, high), np.minimum(self.plain, low)], axis=1)
            if found.nbytes <= KEPT_BYTES:
                self.kept[self.depth] = found
        return found

    @property
    def worst(self) -> np.ndarray:
        """Worst value that each entry can still have: what is unread may lie at the list's far end."""
        high, low = self.frontier
        down = np.where(self.plain >= high, self.plain, self.sorted[0])
        return np.concatenate([down, np.where(self.plain <= low, self.plain, self.sorted[-1])], axis=1)


class Block:
    """Ids and vectors of candidates; their lists are sorted once for each type of scores."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.sorted: dict = {}

    def lists(self, dtype) -> SortedLists:
        if dtype not in self.sorted:
            self.sorted[dtype] = SortedLists(self.vectors, dtype)
        return self.sorted[dtype]


class Asked:
    """Queries with their ``k`` best rows so far, higher scores and smaller ids first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.signed = np.concatenate([np.maximum(vectors, 0), np.minimum(vectors, 0)], axis=1)
        self.scores = np.full((len(ids), k), LOWEST)
        self.found = np.full((len(ids), k), GREATEST)
        # The first round whose bounds are asked for: the one before that which settled most in the last block.
        self.round = 0

    def take(self, rows: np.ndarray, scores: np.ndarray, found: np.ndarray):
        """Take in more of some queries' rows (matrices with a line for each of ``rows``)."""
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        found = np.concatenate([self.found[rows], found], axis=1)
        # ~ turns the order of the scores without overflow.
        order = np.lexsort((found, ~scores), axis=-1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, order, axis=1)
        self.found[rows] = np.take_along_axis(found, order, axis=1)

    def take_list(self, rows: np.ndarray, scores: np.ndarray, found: np.ndarray):
        """Take in rows in any order, each with the number of its query."""
        order = np.lexsort((found, ~scores, rows))
        rows = rows[order]
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        line = np.cumsum(np.diff(rows, prepend=-1) > 0) - 1
        place = np.arange(len(rows)) - first[line]
        best = place < self.k
        more = np.full((len(first), self.k), LOWEST), np.full((len(first), self.k), GREATEST)
        for matrix, values in zip(more, (scores, found)):
            matrix[line[best], place[best]] = values[order[best]]
        self.take(rows[first], *more)

    def rows(self) -> list[np.ndarray]:
        """(query, rank from 0, id, score) of all rows found."""
        query, rank = np.nonzero(self.scores != LOWEST)
        return [self.ids[query], rank, self.found[query, rank], self.scores[query, rank]]


def _true_places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a mask's few true cells. Its rows are whole words of eight."""
    words = mask.view(np.uint64)
    row, word = np.divmod(np.flatnonzero(words), words.shape[1])
    at, byte = np.nonzero(mask.reshape(-1, 8)[row * words.shape[1] + word])
    return row[at], word[at] * 8 + byte


def _look(asked: Asked, rows: np.ndarray, block: Block, lists: SortedLists, signed: np.ndarray):
    """For some of ``rows`` after others: where they begin, which candidates may be among their best by the bounds at this depth, their best scores."""
    n, k = len(block.ids), asked.k
    whole = lists.depth == n
    sides = (lists.plain if whole else lists.best).T
    out = np.empty((min(LOOK_ROWS, len(rows)), n), signed.dtype)
    mask = np.zeros((len(out), -(-n // 8) * 8), bool)
    worst = None if whole or (asked.scores[rows, -1] != LOWEST).all() else lists.worst.T
    for first in range(0, len(rows), LOOK_ROWS):
        part = rows[first : first + LOOK_ROWS]
        upper = np.matmul(asked.vectors[part].astype(signed.dtype) if whole else signed[part], sides, out=out[: len(part)])
        # Outsiders: even their best score is below k scores known, or below k lower bounds.
        kth = asked.scores[part, -1].copy()
        blank = np.flatnonzero(kth == LOWEST)
        if len(blank) and n > k:
            lower = upper[blank] if whole else signed[part[blank]] @ worst
            lower[asked.ids[part[blank]][:, None] == block.ids[None, :]] = LOWEST
            kth[blank] = np.partition(lower, n - k, axis=1)[:, n - k].astype(np.int64)
        inside = mask[: len(part)]
        np.greater_equal(upper, kth.astype(signed.dtype)[:, None], out=inside[:, :n])
        yield first, inside, upper


def read_lists(asked: Asked, block: Block, depths: list | None = None):
    """Take a block's vectors into its queries' best.

    All lists are read in growing rounds. A query is settled in the first round in which few vectors can still be
    among its best, by what it has found in other blocks or by the lower bounds; only their scores are resolved. A round in which
    fewer than half of some open queries, evenly spread, come near that is read on without bounds for the others, which a later round settles;
    so is one well before the round that settled most of them in the last block.
    ``depths`` receives the share of the lists at which each query was settled.
    """
    dtype = exact_type(asked.vectors, block.vectors)
    lists, signed = block.lists(dtype), asked.signed.astype(dtype)
    n = len(block.ids)
    few = max(4 * asked.k, n // 64)
    open_ = np.arange(len(asked.ids))
    many, asked.round = asked.round, 0
    for number, share in enumerate(DEPTHS):
        depth = n if share == 1 else int(n * share)
        whole = depth == n
        if number < many - 1 and not whole:
            continue
        lists.read(depth)
        if not whole and len(open_) > PROBES:
            probes = open_[:: len(open_) // PROBES]
            near = sum((inside.sum(axis=1) <= few).sum() for _, inside, _ in _look(asked, probes, block, lists, signed))
            if 2 * near < len(probes):
                continue
        left = []
        for first, inside, upper in _look(asked, open_, block, lists, signed):
            part = open_[first : first + len(inside)]
            at, candidate = _true_places(inside)
            settled = whole | (np.bincount(at, minlength=len(part)) <= few)
            left.append(part[~settled])
            if depths is not None:
                depths.extend([share] * int(settled.sum()))
            other = settled[at] & (block.ids[candidate] != asked.ids[part[at]])
            at, candidate = at[other], candidate[other]
            if whole:
                score = upper[at, candidate].astype(np.int64)
            else:
                # The rest of these vectors' entries resolves their scores.
                score = np.einsum("ij,ij->i", lists.plain[candidate], asked.vectors[part].astype(dtype)[at]).astype(np.int64)
            query, ids = part[at], block.ids[candidate]
            least, last = asked.scores[query, -1], asked.found[query, -1]
            wanted = (score > least) | (score == least) & (ids < last)
            if wanted.any():
                asked.take_list(query[wanted], score[wanted], ids[wanted])
        left = np.concatenate(left)
        if 2 * (len(open_) - len(left)) >= len(asked.ids):
            asked.round = number
        open_ = left
        if not len(open_):
            break


def block_top(query_ids, queries, ids, vectors, k: int, depths: list | None = None):
    """(query, id, score) of each query's k best vectors of a block, ties to the smaller id."""
    asked = Asked(query_ids, queries, k)
    read_lists(asked, Block(ids, vectors), depths)
    query, _, found, score = asked.rows()
    return [query, found, score]


def _whole(batches, scale: float):
    """id and floor(scale * x) of each component, of vectors with nothing missing or infinite."""
    for batch in batches:
        lists = batch.column(1)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])  # a missing component is NaN here
        sound = odd[bounds[1:]] == odd[bounds[:-1]]
        with np.errstate(over="ignore", invalid="ignore"):
            numbers = np.floor(scale * flat)
            whole = numbers.astype(np.int64)
        # As in Spark, what is beyond 64 bits becomes the last number.
        whole[numbers >= 2.0**63], whole[numbers < -(2.0**63)] = GREATEST, LOWEST
        v = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(whole))
        part = pa.RecordBatch.from_arrays([batch.column(0), v], names=["id", "v"])
        yield part if sound.all() else part.take(pa.array(np.flatnonzero(sound)))


def _pack(batches, size: int):
    """Vectors of one dimension as matrices of at most ``size`` rows, formed within tasks."""
    held: dict[int, list] = {}
    number = TaskContext.get().partitionId() << 32

    def emit(dim, parts):
        ids, matrix = (np.concatenate(x) for x in zip(*parts))
        wide = max(abs(int(matrix.max())), abs(int(matrix.min()))) if matrix.size else 0
        kind = "<i2" if wide < 1 << 15 else "<i4" if wide < 1 << 31 else "<i8"
        values = [dim, number, len(ids), kind, ids.tobytes(), matrix.astype(kind).tobytes()]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in BLOCK.split(", ")])

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
        lists = batch.column(1)
        bounds = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<i8")
        dims = np.diff(bounds)
        for dim in np.unique(dims):
            rows_of = np.flatnonzero(dims == dim)
            matrix = flat[(bounds[rows_of][:, None] + np.arange(dim)[None, :]).ravel()].reshape(-1, dim)
            at = 0
            while at < len(rows_of):
                parts = held.setdefault(int(dim), [])
                end = at + size - sum(len(p[0]) for p in parts)
                parts.append((ids[rows_of[at:end]], matrix[at:end]))
                at = end
                if at <= len(rows_of):
                    yield emit(int(dim), held.pop(int(dim)))
                    number += 1
    for dim, parts in held.items():
        yield emit(dim, parts)
        number += 1


def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with their place among all; the places take a few bytes for each block of many rows."""
    places = blocks.select("block").withColumn("place", F.row_number().over(Window.orderBy("block")) - 1)
    return blocks.join(F.broadcast(places), "block")


def quantised(embeddings: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and vector of rows that have both, the vector as numbers of a type that Arrow hands on."""
    v = F.col(vector_column)
    if embeddings.select(v).schema[0].dataType.simpleString() not in ("array<float>", "array<double>"):
        v = v.cast("array<double>")
    return embeddings.select(F.col(id_column).cast("bigint").alias("id"), v.alias("v")).filter("id is not null and v is not null")


def top_k(
    embeddings: DataFrame,
    is_query,
    k: int = 20,
    scale: float = 64.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` highest inner products.

    ``is_query`` is a condition on the column ``id``. Candidates are all rows with
    another id and the same dimension; equal scores go to the smaller id. Rows with
    a null id, a null vector or components that are null, NaN or infinite take no
    part. Repeated candidate rows count each; a query's id that repeats is asked once (with its
    greatest vector). An empty table gives no rows; other columns are not read.

    Candidates and queries are packed into blocks, and every block of queries meets
    every block of candidates: blocks of candidates are dealt to lanes, and the smaller queries go to each
    lane (candidates are repeated only for each set of ``SET_BLOCKS`` blocks of queries). Within a pair of blocks the lists are read in
    rounds. A query's k best scores of a lane so far bound what it wants of the lane's next block; its k best rows of each lane are ranked together.
    """
    spark = embeddings.sparkSession
    rows = quantised(embeddings, id_column, vector_column)
    asked = rows.filter(is_query).mapInArrow(lambda batches: _whole(batches, scale), "id bigint, v array<bigint>")
    asked = asked.groupBy("id").agg(F.max("v").alias("v")).repartition(spark.sparkContext.defaultParallelism // 4 + 1)
    large, small = BLOCK_ROWS, QUERY_ROWS
    blocks = staged(rows.mapInArrow(lambda batches: _pack(_whole(batches, scale), large), BLOCK), "vectors")
    queries = staged(asked.mapInArrow(lambda batches: _pack(batches, small), BLOCK), "queries")
    n = blocks.count()
    sets = max(1, -(-queries.count() // SET_BLOCKS))
    lanes = max(1, min(n, max(-(-2 * spark.sparkContext.defaultParallelism // sets), -(-n // LANE_BLOCKS))))
    place, copies = F.col("place"), lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = _numbered(blocks).select("*", F.lit(1).alias("role"), (place % lanes).alias("lane"), copies(sets).alias("set"))
    repeated = _numbered(queries).select("*", F.lit(0).alias("role"), (place % sets).alias("set"), copies(lanes).alias("lane"))
    cell = (F.col("set") * lanes + F.col("lane")).alias("cell")
    columns = [c.split()[0] for c in BLOCK.split(", ")]
    both = repeated.select(cell, "role", *columns).unionByName(candidates.select(cell, "role", *columns))
    # A lane's queries come before its candidates.
    dealt = both.repartitionByRange(lanes * sets, "cell").sortWithinPartitions("cell", "role", "dim", "block")

    def vectors(batch, at):
        cell = lambda name: batch.column(name)[at]
        matrix = np.frombuffer(cell("vectors").as_buffer(), cell("kind").as_py()).astype(np.int64)
        return np.frombuffer(cell("ids").as_buffer(), "<i8"), matrix.reshape(cell("n").as_py(), cell("dim").as_py())

    def search(batches):
        one_thread()
        cell, held = None, {}

        def found():
            for asked in held.values():
                for block, best in asked:
                    values = [block, best.ids, best.scores, best.found]
                    values = [values[0], *(x.astype("<i8").tobytes() for x in values[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [pa.int64(), *[pa.binary()] * 3])], names=["block", "ids", "scores", "found"])

        for batch in batches:
            for at in range(batch.num_rows):
                now, role, dim, block = (batch.column(c)[at].as_py() for c in ("cell", "role", "dim", "block"))
                if now != cell:
                    yield from found()
                    cell, held = now, {}
                if role == 0:
                    held.setdefault(dim, []).append((block, Asked(*vectors(batch, at), k)))
                elif dim in held:
                    candidates = Block(*vectors(batch, at))
                    for _, asked in held[dim]:
                        read_lists(asked, candidates)
        yield from found()

    def rank(batches):
        block, best = None, None

        def ranked():
            columns = [[], [], [], []] if best is None else best.rows()
            query, place, found, score = (np.asarray(c, np.int64) for c in columns)
            arrays = [pa.array(query), pa.array((place + 1).astype(np.int32)), pa.array(found), pa.array(score)]
            return pa.RecordBatch.from_arrays(arrays, names=["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for at in range(batch.num_rows):
                now = batch.column("block")[at].as_py()
                ids, scores, found = (np.frombuffer(batch.column(c)[at].as_buffer(), "<i8") for c in ("ids", "scores", "found"))
                if now != block:
                    yield ranked()
                    block, best = now, Asked(ids, np.zeros((len(ids), 0), np.int64), k)
                best.take(np.arange(len(ids)), scores.reshape(len(ids), k), found.reshape(len(ids), k))
        yield ranked()

    found = dealt.mapInArrow(search, "block bigint, ids binary, scores binary, found binary")
    together = found.repartition("block").sortWithinPartitions("block")
    return together.mapInArrow(rank, "query_id bigint, rank int, vec_id bigint, score bigint")
