"""Sampled segmentations over a SentencePiece vocabulary, and their decoding.

The vocabulary's scores are ranks, so a piece of rank r weighs (r + 1) ** -alpha
(Zipf's law). A text with a space in front is the lattice's path; spaces stand for
the vocabulary's own space mark. No piece goes on into a space from something else,
and none holds a line break, so the lattice falls apart at those places: its parts
are filtered forward once per different part, and all parts of a batch are sampled
backward together.
"""

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from geolayers.llm.batches import give_back, kept_by_worker, small_batches
from geolayers.llm.word_ids import sliced

MARK = "▁"
PARTS = re.compile(r" *[^ \n]+|\n| +")
BYTE_WEIGHT = 1e-9  # of a character's bytes, used only where it is no piece itself
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each counter (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Pieces with spaces for marks, as a trie, their bytes, and the ids of single bytes.

    A trie step is a search for ``node * alphabet + letter`` among ``keys``.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.ids, self.rank, self.byte_ids = {}, {}, np.full(256, -1, np.int32)
        raw = [b""] * n
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                raw[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace(MARK, " ")
                if re.search("[^ ] |\n", text):
                    raise ValueError("pieces that go on into a space are not supported")
                self.ids[text], self.rank[text] = i, -model.get_score(i)
                raw[i] = text.encode()
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary has no byte pieces, so texts could be lost")
        self.size = np.array([len(r) for r in raw])
        self.start = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        letters = sorted({c for t in self.ids for c in t})
        self.letter = np.full(0x110000, -1, np.int16)
        self.letter[[ord(c) for c in letters]] = np.arange(len(letters))
        self.alphabet = len(letters)
        beginnings = sorted({t[:k] for t in self.ids for k in range(len(t) + 1)})
        node = {t: i for i, t in enumerate(beginnings)}  # '' is node 0
        keys = [(node[t[:-1]] * self.alphabet + int(self.letter[ord(t[-1])]), node[t]) for t in beginnings[1:]]
        self.keys, self.next = np.array(sorted(keys)).T
        self.piece = np.array([self.ids.get(t, -1) for t in beginnings], np.int32)


class Sampler:
    """Lattices of parts as flat arrays; those of the first ``keep`` parts are kept.

    Part p has nodes ``node[p] .. node[p + 1] - 1`` (its characters' ends). The edges
    into node n are ``edge[n] .. edge[n + 1] - 1``. An edge knows the share of the
    node's edges up to itself, its piece (or minus one minus the character that goes
    by bytes) and how many nodes it goes back.
    """

    def __init__(self, path: str, alpha: float, keep: int = 120_000):
        self.vocabulary, self.keep = Vocabulary(path), keep
        self.weight = np.full(len(self.vocabulary.size), -np.inf)
        for text, rank in self.vocabulary.rank.items():
            self.weight[self.vocabulary.ids[text]] = -alpha * np.log(rank + 1)
        self.parts: dict[str, int] = {}
        self.node = np.zeros(1, np.int64)
        self.edge = np.zeros(1, np.int64)
        self.upto, self.back = np.zeros(0), np.zeros(0, np.int32)
        self.piece = np.zeros(0, np.int32)

    def lattice(self, parts: list[str]):
        """Edges of all parts: start and end (characters before them), piece, log weight."""
        v = self.vocabulary
        code = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        letter = v.letter[code].astype(np.int64)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        stop = np.repeat(np.cumsum(lengths), lengths)
        start = np.arange(len(code))
        single = np.zeros(len(code), bool)
        at, state = start, np.zeros(len(code), np.int64)
        found = []
        while len(at):
            known = letter[at]
            key = state * v.alphabet + known
            place = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
            going = (known >= 0) & (v.keys[place] == key)
            start, at, state = start[going], at[going] + 1, v.next[place[going]]
            piece = v.piece[state]
            is_piece = piece >= 0
            found.append((start[is_piece], at[is_piece], piece[is_piece]))
            if len(found) == 1:
                single[start[is_piece]] = True
            going = at < stop[start]
            start, at, state = start[going], at[going], state[going]
        alone = np.flatnonzero(~single)
        found.append((alone, alone + 1, -1 - code[alone].astype(np.int32)))
        start, end, piece = (np.concatenate(x) for x in zip(*found))
        weight = np.where(piece >= 0, self.weight[piece], np.log(BYTE_WEIGHT))
        return lengths, start, end, piece, weight

    def learn(self, new: list[str]):
        """Forward filtering of all new parts together, one place in the part after the other."""
        lengths, start, end, piece, weight = self.lattice(new)
        first = np.cumsum(lengths) - lengths
        place = start - np.repeat(first, lengths)[start]
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(lengths.max() + 1))
        # Log of the weight of all ways to the end of each character.
        total = np.full(int(lengths.sum()), -np.inf)
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            edges = order[lo:hi]
            before = total[start[edges] - 1] if k else 0.0
            ends = end[edges] - 1  # different for all edges that start at one place
            total[ends] = np.logaddexp(total[ends], before + weight[edges])
        order = np.argsort(end, kind="stable")
        start, end, piece, weight = start[order], end[order] - 1, piece[order], weight[order]
        head = start == np.repeat(first, lengths)[start]
        share = np.exp(np.where(head, 0.0, total[start - 1]) + weight - total[end])
        share = np.cumsum(share)
        last = np.append(np.flatnonzero(np.diff(end)), len(end) - 1)
        base = np.concatenate([[0.0], share[last[:-1]]])
        share = np.minimum(share - np.repeat(base, np.diff(np.concatenate([[-1], last]))), 1.0)
        share[last] = 1.0
        self.parts.update(zip(new, range(len(self.parts), len(self.parts) + len(new))))
        self.node = np.concatenate([self.node, self.node[-1] + np.cumsum(lengths)])
        self.edge = np.concatenate([self.edge, self.edge[-1] + last + 1])
        self.upto = np.concatenate([self.upto, share])
        self.back = np.concatenate([self.back, (end + 1 - start).astype(np.int32)])
        self.piece = np.concatenate([self.piece, piece])

    def forget(self, new: list[str]):
        over = len(self.parts) - self.keep
        if over > 0:
            for part in new[-over:]:
                del self.parts[part]
            self.node = self.node[: self.keep + 1].copy()
            self.edge = self.edge[: self.node[-1] + 1].copy()
            edges = self.edge[-1]
            self.upto, self.back, self.piece = (a[:edges].copy() for a in (self.upto, self.back, self.piece))
        give_back()

    def sample(self, texts: list[str | None], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and their counts."""
        split = [PARTS.findall(" " + t) if t else [] for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        flat = list(chain.from_iterable(split))
        new = sorted(set(flat).difference(self.parts))
        if new:
            self.learn(new)
        number = np.fromiter(map(self.parts.__getitem__, flat), np.int64, len(flat))
        # A draw's counter: the row's key, the part's place in the text, the step in the part.
        place = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
        with np.errstate(over="ignore"):
            seed = mixed(np.repeat(mixed(keys.view(np.uint64)), counts) + place.astype(np.uint64) * GOLDEN)
        open_ = np.arange(len(number))
        first, at = self.node[number], self.node[number + 1] - 1
        owners, taken = [], []
        while len(open_):
            with np.errstate(over="ignore"):
                u = (mixed(seed[open_] + np.uint64(len(owners))) >> np.uint64(34)).astype(np.float64) / (1 << 30)
            edge = self.edge[at]
            on = np.flatnonzero(u >= self.upto[edge])
            while len(on):  # a node's last share is 1
                edge[on] += 1
                on = on[u[on] >= self.upto[edge[on]]]
            owners.append(open_)
            taken.append(self.piece[edge])
            at = at - self.back[edge]
            going = at >= first
            open_, at, first = open_[going], at[going], first[going]
        self.forget(new)
        if not owners:
            return np.zeros(0, np.int32), counts
        # Steps went backward: a part's later draws stand in front of its earlier ones.
        steps = np.bincount(np.concatenate(owners), minlength=len(number))
        ends = np.cumsum(steps)
        piece = np.empty(ends[-1], np.int32)
        for k, (who, what) in enumerate(zip(owners, taken)):
            piece[ends[who] - 1 - k] = what
        size = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        if (piece < 0).any():
            runs = [self.vocabulary.byte_ids[list(chr(-p - 1).encode())] for p in piece[piece < 0].tolist()]
            width = np.ones(len(piece), np.int64)
            width[piece < 0] = [len(r) for r in runs]
            size = np.concatenate([[0], np.cumsum(width)])[size]
            spread = np.repeat(piece, width)
            spread[spread < 0] = np.concatenate(runs)
            piece = spread
        return piece, np.diff(size)


def decoded(vocabulary: Vocabulary, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Texts of piece ids in a row; ``sizes`` are the counts per text."""
    lengths = vocabulary.size[ids]
    ends = np.cumsum(lengths)
    source = np.repeat(vocabulary.start[ids] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    raw = vocabulary.raw[source]
    bounds = np.concatenate([[0], np.concatenate([[0], ends])[np.cumsum(sizes)]])
    # The space put in front of each text that is not empty is taken off.
    filled = sizes > 0
    raw = np.delete(raw, bounds[:-1][filled])
    bounds[1:] -= np.cumsum(filled)
    return pa.Array.from_buffers(
        pa.large_string(), len(sizes), [None, pa.py_buffer(bounds.astype("<i8")), pa.py_buffer(raw.tobytes())]
    ).cast(pa.string())


def _sampler(path: str, alpha: float) -> Sampler:
    return kept_by_worker("sampler", (path, alpha), lambda: Sampler(path, alpha))


def _field(df: DataFrame, name: str):
    return F.col(f"`{next(c for c in df.columns if c.lower() == name.lower())}`")


def _with(df: DataFrame, column, name: str) -> DataFrame:
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return df.select(row.alias("row"), column.alias(name))


def encode_sampled(
    docs: DataFrame, model: str, seed: int = 0, alpha: float = 1.0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Rows as ``row`` with ``ids`` (32-bit little-endian) of one sampled segmentation.

    A segmentation is drawn with probability proportional to the product of its
    pieces' weights (larger ``alpha``: fewer, more frequent pieces). The draws depend
    on ``seed``, the row's key and the place in the text alone, so any run, on any
    partitions, gives the same; equal keys with equal texts do too. A null text
    gives null, an empty one no ids, a null key is a key like others. Characters
    without a piece, among them the vocabulary's own space mark, become byte pieces.
    ``row`` holds the input columns untouched, so no name can clash.
    """
    small_batches(docs.sparkSession)

    @arrow_udf(T.BinaryType())
    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sampler = _sampler(model, alpha)
        for keys, texts in batches:
            found, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for part in sliced(pa.RecordBatch.from_arrays([keys, texts], names=["key", "text"])):
                key = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids, size = sampler.sample(part.column(1).to_pylist(), key)
                found.append(ids)
                sizes.append(size)
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes)) * 4]).astype("<i4")
            valid = np.packbits(texts.is_valid().to_numpy(zero_copy_only=False), bitorder="little").tobytes()
            data = np.concatenate(found).astype("<u4")
            yield pa.Array.from_buffers(
                pa.binary(), len(texts), [pa.py_buffer(valid), pa.py_buffer(bounds), pa.py_buffer(data)]
            )

    key = F.xxhash64(_field(docs, id_column).cast("string"), F.lit(seed))
    return _with(docs, encode(key, _field(docs, text_column).cast("string")), "ids")


def decode_pieces(encoded: DataFrame, model: str, ids_column: str = "ids") -> DataFrame:
    """Rows as ``row`` with the ``text`` of their piece ids; null ids give null, none give ''.

    Gives back every text that ``encode_sampled`` was given, character by character.
    """
    small_batches(encoded.sparkSession)

    @arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = kept_by_worker("vocabulary", model, lambda: Vocabulary(model))
        for raw in batches:
            lists = pc.fill_null(raw, b"")
            sizes = pc.binary_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            ids = np.frombuffer(b"".join(lists.to_pylist()), "<u4")
            yield pc.if_else(raw.is_valid(), decoded(vocabulary, ids, sizes), None)

    return _with(encoded, decode(_field(encoded, ids_column)), "text")
