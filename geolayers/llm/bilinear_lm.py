"""Log-bilinear language model, trained with noise-contrastive estimation.

Tokens are white-space words and an end. The words that make up most of the training
tokens have vectors of their own, as targets and as contexts: how many they are
follows the counts. The most frequent ones, the end and the classes are told apart
first, then the words of a class; a class holds words that end alike, and about as
many as there are classes, so both sums are short. Each class has one symbol for all
its rarer words, which share its probability by their add-half training counts. So all
tokens' probabilities sum to one, one unseen word in each class included.
"""

import uuid
from bisect import bisect_right
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from geolayers.llm.batches import kept_by_worker, one_thread, small_batches
from geolayers.llm.word_ids import sliced
from geolayers.session import staged

END = b"\n"  # no word holds white space, so this stands for the end of a text
CONTEXT = 2
FLUSH = 300_000  # different words that a task holds before it hands their counts on
PARTS = 16  # parts of a model that are averaged apart, at least
LEARNED = 50  # tokens a symbol from which a model learns, where there are more than a model for each core
SLICE_BYTES = 1 << 22  # texts whose words are numbered at once
OFTEN = 2048  # symbols whose pairs' normalisers are kept
BLOCK = 8  # targets of a class in one small product
CELLS = 96_000  # scores of a product that is normalised at once, so that they stay in a core's cache


class Symbols:
    """Numbers: 0 before the text, 1 its end, the first words, the classes, then each class's symbols.

    The words behind the ``head`` first ones are put in the order of their letters
    read backwards and cut into ``classes`` parts of the same size, which take in all other
    words as well. The first symbol of a class is for those without a symbol of their own.
    """

    def __init__(self, words: pa.Array, head: int | None = None, classes: int | None = None):
        self.words = words  # compact; what is sent to the workers
        words = words.to_pylist()
        root = round(len(words) ** 0.5)
        self.head = min(len(words), max(16, root) if head is None else head)
        tail = sorted(w[::-1] for w in words[self.head :])
        del words[self.head :]
        classes = max(1, min(len(tail), root if classes is None else classes))
        cuts = [len(tail) * g // classes for g in range(classes + 1)]
        self.least = [tail[at] for at in cuts[1:-1]]  # of every class but the first, read backwards
        self.top = 2 + self.head + classes
        self.bounds = self.top + np.array(cuts, np.int64) + np.arange(classes + 1)
        self.size = int(self.bounds[-1])
        self.rest = self.bounds[:-1].tolist()
        self.number = {w: i + 2 for i, w in enumerate(words)} | {END: 1}
        for g, (first, last) in enumerate(zip(cuts, cuts[1:])):
            self.number.update((w[::-1], self.rest[g] + 1 + i) for i, w in enumerate(tail[first:last]))
        self.listed = pa.array([*self.number], pa.binary())
        self.numbers = np.fromiter([*self.number.values(), 0], np.int32, len(self.number) + 1)

    def of(self, word: bytes) -> int:
        return self.number.get(word) or self.rest[bisect_right(self.least, word[::-1])]

    def of_all(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.number.get, words, repeat(0)), np.int32, len(words))
        rare = np.flatnonzero(found == 0)
        found[rare] = self.of_rare([words[k] for k in rare.tolist()])
        return found

    def of_rare(self, words: list[bytes]) -> np.ndarray:
        """The symbols of words without one of their own."""
        rest, least = self.rest, self.least
        return np.array([rest[bisect_right(least, w[::-1])] for w in words], np.int32)

    def of_tokens(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Each word's symbol; where those without a symbol of their own are, which they are, and the number of each among them."""
        place = pc.fill_null(pc.index_in(words, self.listed), -1).to_numpy()
        found = self.numbers.take(place, mode="wrap")
        rare = np.flatnonzero(place < 0)
        names = words.take(pa.array(rare)).dictionary_encode()
        index, names = names.indices.to_numpy(), names.dictionary.to_pylist()
        found[rare] = self.of_rare(names).take(index)
        return found, rare, names, index


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All texts' words in a row (ASCII lower-cased), and words per text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    words = split.flatten().cast(pa.binary())
    filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    if not filled.all():  # white space at the ends of a text
        ends = np.cumsum(counts)
        before = np.concatenate([[0], np.cumsum(filled)])
        words, counts = words.filter(pa.array(filled)), before[ends] - before[ends - counts]
    return words, counts


def coded(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different words (ASCII lower-cased), each word's number among them, words per text."""
    low = pc.ascii_lower(pc.fill_null(texts, ""))
    split = pc.ascii_split_whitespace(low)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    found = split.flatten().dictionary_encode()
    words = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    index = found.indices.to_numpy()
    if b"" in words:  # white space at the ends of a text
        filled = index != words.index(b"")
        ends = np.cumsum(counts)
        before = np.concatenate([[0], np.cumsum(filled)])
        index, counts = index[filled], before[ends] - before[ends - counts]
    return words, index, counts


def sequences(values: np.ndarray, counts: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """Values of all texts in a row, each text closed by ``end``; where each text starts."""
    ends = np.cumsum(counts + 1)
    out = np.full(ends[-1] if len(ends) else 0, end, values.dtype)
    out[np.arange(len(values)) + np.repeat(np.arange(len(counts)), counts)] = values
    return out, ends - counts - 1


def contexts(target: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two symbols before each target; 0 stands before the text."""
    near, far = np.zeros_like(target), np.zeros_like(target)
    near[1:], far[2:] = target[:-1], target[:-2]
    near[starts] = far[starts] = 0
    second = starts + 1
    far[second[second < len(target)]] = 0
    return near, far


def powers() -> tuple[np.ufunc, np.float32]:
    """The faster of numpy's exponentials of 32-bit floats here, and what a natural logarithm is multiplied by for it.

    Those to the base of two have vector instructions only on processors with AVX-512; the others on all with AVX2.
    """
    found = np.show_config(mode="dicts").get("SIMD Extensions", {}).get("found", [])
    return (np.exp2, np.float32(np.log2(np.e))) if {"AVX512_SKX", "X86_V4"} & set(found) else (np.exp, np.float32(1))


def ordered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of whole numbers from zero on in ascending order, the first of equal ones first, and these numbers.

    Number and place are sorted as one number where they fit one, which is faster than to sort places.
    """
    bits = len(values).bit_length()
    if int(values.max(initial=0)).bit_length() + bits > 63:
        order = np.argsort(values, kind="stable")
        return order, values.take(order)
    keys = values.astype(np.int64) << bits
    keys |= np.arange(len(values))
    keys.sort()
    return keys & ((1 << bits) - 1), keys >> bits


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different whole numbers, ascending; each value's place among them; the order of all values; where each number starts in it."""
    order, values = ordered(values)
    starts = np.flatnonzero(np.diff(values, prepend=-1))
    place = np.empty(len(values), np.int64)
    place[order] = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(values)))
    return values.take(starts), place, order, starts


def added(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows from each start on; two columns at once, as the parts of a complex number."""
    if values.shape[1] % 2:
        return np.add.reduceat(values, starts, axis=0)
    return np.add.reduceat(values.view(np.complex64), starts, axis=0).view(np.float32)


class BilinearModel:
    """Scores of a next symbol: (c1 * R[near] + c2 * R[far]) . Q[symbol] + b[symbol].

    The symbols from ``bounds[0]`` on lie in classes: class g holds ``bounds[g]`` to
    ``bounds[g + 1]``, and those before ``bounds[0]`` end with a symbol for each class.
    """

    NAMES = ("R", "Q", "b", "c")

    def __init__(self, size: int, width: int, counts: np.ndarray, seed: int = 0, bounds: np.ndarray | None = None):
        draw = np.random.default_rng(seed)
        self.R = draw.normal(0, 0.1, (size, width)).astype(np.float32)
        self.Q = draw.normal(0, 0.1, (size, width)).astype(np.float32)
        self.c = np.ones((CONTEXT, width), np.float32)
        self.bounds, self.parent = parents(size, bounds)
        self.top = int(self.bounds[0])
        self.noise = np.bincount(self.parent, counts, self.top) + 1.0
        self.noise[0] = 0  # nothing is before a text but the text's beginning
        self.noise /= self.noise.sum()
        self.cumulated = np.cumsum(self.noise)
        # Within a class, a symbol's share of the class's counts.
        self.within = np.concatenate([[0.0], np.cumsum(counts[self.top :] + 1.0)])
        whole = np.diff(self.within[self.bounds - self.top])
        share = np.diff(self.within) / np.repeat(whole, np.diff(self.bounds))
        with np.errstate(divide="ignore"):
            self.b = np.maximum(np.log(np.concatenate([self.noise, share])), -60).astype(np.float32)
        self.prior = self.b.copy()
        self.sums = {name: np.full_like(getattr(self, name), 1e-6) for name in self.NAMES}
        self.draw = draw
        self.power, self.unit = powers()

    def logistic(self, x: np.ndarray) -> np.ndarray:
        """1 / (1 + exp(-y)), in place, where ``x`` is y times minus the unit."""
        with np.errstate(over="ignore"):  # one over infinity is the right zero
            self.power(x, out=x)
        x += 1
        return np.reciprocal(x, out=x)

    def step(self, name: str, rows, gradient: np.ndarray, rate: float, old: np.ndarray | None = None) -> np.ndarray:
        """AdaGrad ascent of some rows, each given once, with their ``old`` values; all rows if ``rows`` is None. The new values."""
        part, sums = getattr(self, name), self.sums[name]
        found = gradient * gradient
        found += sums[: len(gradient)] if rows is None else sums.take(rows, axis=0)
        change = rate * gradient
        if rows is None:
            sums[: len(gradient)] = found
            part[: len(gradient)] += np.divide(change, np.sqrt(found, out=found), out=change)
            return part
        sums[rows] = found
        np.divide(change, np.sqrt(found, out=found), out=change)
        change += old
        part[rows] = change
        return change

    def train(self, target, near, far, noise_words: int = 64, rate: float = 0.05):
        """One step of noise-contrastive estimation; the noise is shared by the batch."""
        n = len(target)
        k = noise_words
        order, target = ordered(target)  # so the targets of a class lie together
        upper = self.parent.take(target)
        other = np.searchsorted(self.cumulated, self.draw.random(k)).clip(1, self.top - 1)
        # Each context's row is fetched once: the tables are larger than a core's cache.
        rows, place, by_row, row_starts = distinct(np.concatenate([near.take(order), far.take(order)]))
        context = self.R.take(rows, axis=0)
        sides = context.take(place, axis=0)
        near_v, far_v = sides[:n], sides[n:]
        hidden = near_v * self.c[0]
        hidden += far_v * self.c[1]
        # Each target against k noise words: odds are model over k times noise.
        shift = self.prior[: self.top] - self.b[: self.top] + np.float32(np.log(k))
        target_q, noise_q = self.Q.take(upper, axis=0), self.Q.take(other, axis=0)
        g_target = self.logistic((np.einsum("ij,ij->i", hidden, target_q) - shift.take(upper)) * self.unit)
        against = hidden @ (noise_q * -self.unit).T
        against += shift.take(other) * self.unit
        against = self.logistic(against)
        g_hidden = np.multiply(target_q, g_target[:, None], out=target_q)
        g_hidden -= against @ noise_q
        starts = np.flatnonzero(np.diff(upper, prepend=-1))  # no class's symbol is a target, so these ascend as well
        g_q = np.zeros((self.top, hidden.shape[1]), np.float32)
        g_q[upper.take(starts)] = added(hidden * g_target[:, None], starts)
        np.subtract.at(g_q, other, against.T @ hidden)
        ones = np.ones(n, np.float32)
        g_b = np.bincount(upper, g_target, self.top) - np.bincount(other, ones @ against, self.top)
        g_b = g_b.astype(np.float32)
        first = int(np.searchsorted(target, self.top))
        if first < n:
            g_hidden[first:] += self.train_classes(target[first:], hidden[first:], n, rate)
        g_c = np.stack([ones @ np.multiply(g_hidden, side, out=side) for side in (near_v, far_v)])
        for part, weights in zip((near_v, far_v), self.c):
            np.multiply(g_hidden, weights, out=part)
        g_r = added(sides.take(by_row, axis=0), row_starts)
        for name, at, gradient, old in zip(self.NAMES, (rows, None, None, None), (g_r, g_q, g_b, g_c), (context, None, None, None)):
            self.step(name, at, np.divide(gradient, np.float32(n), out=gradient), rate, old)

    def train_classes(self, target, hidden, n: int, rate: float, noise_words: int = 8) -> np.ndarray:
        """The same within classes: ascending targets against noise of their own class; the gradient of ``hidden``.

        The targets of a class are cut into blocks, the last one filled up, so all classes are multiplied at once.
        """
        k, width = noise_words, hidden.shape[1]
        inner = self.parent.take(target) - (self.top - len(self.bounds) + 1)
        starts = np.flatnonzero(np.diff(inner, prepend=-1))
        sizes = np.diff(starts, append=len(target))
        lo, hi = self.bounds[inner[starts]], self.bounds[inner[starts] + 1]
        least, most = self.within[lo - self.top][:, None], self.within[hi - self.top][:, None]
        drawn = least + (most - least) * np.sort(self.draw.random((len(starts), k)), axis=1)
        other = np.searchsorted(self.within, drawn, side="right") - 1 + self.top
        other = other.clip(lo[:, None], hi[:, None] - 1)
        blocks = -(-sizes // BLOCK)
        first = np.cumsum(blocks) - blocks
        place = np.arange(len(target)) + np.repeat(first * BLOCK - starts, sizes)
        blocked = np.zeros((int(blocks.sum()) * BLOCK, width), np.float32)
        blocked[place] = hidden
        blocked = blocked.reshape(-1, BLOCK, width)
        # Each symbol's row is fetched once, as above.
        m = len(target)
        rows, at, by_row, row_starts = distinct(np.concatenate([target, other.ravel()]))
        old_q, old_b = self.Q.take(rows, axis=0), self.b.take(rows)
        shift = self.prior.take(rows) - old_b + np.float32(np.log(k))
        scores = np.einsum("ij,ij->i", hidden, old_q.take(at[:m], axis=0)) - shift.take(at[:m])
        g_target = self.logistic(scores * self.unit)
        drawn_at = at[m:].reshape(other.shape)
        noise_q = np.repeat(old_q.take(drawn_at, axis=0), blocks, axis=0)
        against = blocked @ (noise_q * -self.unit).transpose(0, 2, 1)
        against += np.repeat(shift.take(drawn_at) * self.unit, blocks, axis=0)[:, None, :]
        against = self.logistic(against)
        filled = np.zeros(len(blocked) * BLOCK, np.float32)
        filled[place] = 1
        against *= filled.reshape(-1, BLOCK, 1)
        g_q = added((against.transpose(0, 2, 1) @ blocked).reshape(len(blocked), -1), first)
        g_b = added(against.sum(axis=1), first)
        values = np.zeros((m + other.size, width + 2), np.float32)
        np.multiply(hidden, g_target[:, None], out=values[:m, :width])
        values[:m, width] = g_target
        np.negative(g_q.reshape(-1, width), out=values[m:, :width])
        np.negative(g_b.ravel(), out=values[m:, width])
        found = added(values.take(by_row, axis=0), row_starts)
        found /= np.float32(n)
        g_hidden = self.step("Q", rows, found[:, :width], rate, old_q).take(at[:m], axis=0)
        self.step("b", rows, found[:, width], rate, old_b)
        g_hidden *= g_target[:, None]
        g_hidden -= (against @ noise_q).reshape(-1, width).take(place, axis=0)
        return g_hidden

    def parts(self) -> dict[str, np.ndarray]:
        return {name: getattr(self, name) for name in self.NAMES}

    def packed(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in self.NAMES]).astype("<f4")


def unpacked(flat: np.ndarray, size: int, width: int) -> dict[str, np.ndarray]:
    """The parts of a model that was packed."""
    shapes = (size, width), (size, width), (size,), (CONTEXT, width)
    cuts = np.cumsum([np.prod(shape) for shape in shapes])[:-1]
    return {name: part.reshape(shape) for name, part, shape in zip(BilinearModel.NAMES, np.split(flat, cuts), shapes)}


def parents(size: int, bounds: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the classes (without classes, the end of the symbols), and the class's symbol of each symbol in one, else its own."""
    bounds = np.array([size]) if bounds is None else bounds
    top = int(bounds[0])
    classes = np.arange(top - len(bounds) + 1, top)
    return bounds, np.concatenate([np.arange(top), np.repeat(classes, np.diff(bounds))])


class Sums:
    """Logarithms of the sums of some symbols' exponentials after hidden vectors, and scores of these symbols."""

    FAR = 80.0  # exp() of 32-bit floats holds on both sides of it

    def __init__(self, Q: np.ndarray, b: np.ndarray):
        self.power, self.unit = powers()
        self.weights = np.ascontiguousarray((Q * self.unit).T)
        self.b = b
        self.rows = max(1, CELLS // len(b))  # hidden vectors in one product
        self.reach = float(np.sqrt((Q * Q).sum(axis=1).max()))
        self.least, self.most = float(b.min()), float(b.max())
        with np.errstate(over="ignore"):
            self.scale = np.exp(b)

    def near(self, length: float) -> bool:
        """Whether no exponential is too large, and the largest of each row not too small, after vectors no longer than that."""
        reach = self.reach * length
        return reach < self.FAR and self.most + reach < self.FAR and self.most - reach > -self.FAR

    def of(self, hidden: np.ndarray, near: bool, at: np.ndarray | None = None, own: np.ndarray | None = None):
        """Of each hidden vector the logarithm, and the scores of the symbols ``own`` after the vectors ``at``."""
        scores = hidden @ self.weights
        picked = None if own is None else scores[at, own] / self.unit + self.b.take(own)
        if near:
            return np.log(self.power(scores, out=scores) @ self.scale), picked
        scores += self.b * self.unit
        most = scores.max(axis=1)
        scores -= most[:, None]
        return most / self.unit + np.log(self.power(scores, out=scores).sum(axis=1)), picked


class Scorer:
    """Normalised log10 probabilities; the normaliser of each context is computed once a call.

    Those of all pairs of the symbols given as ``often`` are computed once: an exponential of a sum of two
    vectors' scores is a product, so they are a product of two matrices. A pair with one of them needs the exponentials
    of its other symbol only, once for all such pairs.
    """

    def __init__(self, parts: dict[str, np.ndarray], bounds: np.ndarray | None = None, often: np.ndarray | None = None):
        self.R, self.Q, self.b, self.c = (parts[name] for name in BilinearModel.NAMES)
        self.size = len(self.b)
        self.bounds, self.parent = parents(self.size, bounds)
        self.top = int(self.bounds[0])
        # The beginning is never a next symbol.
        self.upper = Sums(self.Q[1 : self.top], self.b[1 : self.top])
        self.classes = [Sums(self.Q[lo:hi], self.b[lo:hi]) for lo, hi in zip(self.bounds, self.bounds[1:])]
        self.place = self.pairs = None
        if often is not None and len(often):
            near, far = (self.R.take(often, axis=0) * c for c in self.c)
            self.bounded = self.upper.near(sum(self.length(self.R * c) for c in self.c))
            if self.upper.near(self.length(near) + self.length(far)):
                self.factors = tuple(self.upper.power(side @ self.upper.weights) for side in (near, far))
                near, far = self.factors
                near *= self.upper.scale
                self.pairs = np.log(near @ far.T)
                far *= self.upper.scale
                self.place = np.full(self.size, -1, np.int32)
                self.place[often] = np.arange(len(often))

    @staticmethod
    def length(vectors: np.ndarray) -> float:
        return float(np.sqrt(np.einsum("ij,ij->i", vectors, vectors).max(initial=0)))

    def beside(self, often: np.ndarray, other: np.ndarray, side: int) -> np.ndarray:
        """Logarithms of the upper sums after pairs of an ``often`` symbol, by its place, and any ``other``, ascending, on that side."""
        out = np.empty(len(other), np.float32)
        for first in range(0, len(other), self.upper.rows):
            s = slice(first, first + self.upper.rows)
            new = np.diff(other[s], prepend=-1) != 0
            mine = self.upper.power((self.R.take(other[s][new], axis=0) * self.c[side]) @ self.upper.weights)
            mine = mine.take(np.cumsum(new) - 1, axis=0)
            out[s] = np.vecdot(mine, self.factors[1 - side].take(often[s], axis=0))
        return np.log(out, out=out)

    def log10(self, target, near, far) -> np.ndarray:
        found, at, *_ = distinct(near.astype(np.int64) * self.size + far)
        near, far = np.divmod(found, self.size)
        hidden = self.R.take(near, axis=0) * self.c[0]
        hidden += self.R.take(far, axis=0) * self.c[1]
        length = self.length(hidden)
        norm = np.empty(len(found), np.float32)
        left = np.arange(len(found))
        if self.pairs is not None:
            row, column = self.place.take(near), self.place.take(far)
            kept = (row >= 0) & (column >= 0)
            norm[kept] = self.pairs[row[kept], column[kept]]
            if self.bounded:
                some = np.flatnonzero((row < 0) & (column >= 0))
                norm[some] = self.beside(column.take(some), near.take(some), 0)
                some = np.flatnonzero((row >= 0) & (column < 0))
                order, other = ordered(far.take(some))
                some = some.take(order)
                norm[some] = self.beside(row.take(some), other, 1)
                kept = (row >= 0) | (column >= 0)
            left = np.flatnonzero(~kept)
        safe = self.upper.near(length)
        for first in range(0, len(left), self.upper.rows):
            some = left[first : first + self.upper.rows]
            norm[some] = self.upper.of(hidden.take(some, axis=0), safe)[0]
        out = np.empty(len(target))
        for first in range(0, len(target), 1 << 15):
            s = slice(first, first + (1 << 15))
            upper = self.parent.take(target[s])
            own = np.einsum("ij,ij->i", hidden.take(at[s], axis=0), self.Q.take(upper, axis=0))
            out[s] = own + self.b.take(upper) - norm.take(at[s])
        below = np.flatnonzero(target >= self.top)
        if not len(below):
            return out / np.log(10)
        # A class's normaliser after a context is computed once as well.
        target, at = target.take(below), at.take(below)
        classes = self.parent.take(target) - (self.top - len(self.classes))
        pairs, _, order, starts = distinct(classes.astype(np.int64) * len(found) + at)
        below, target = below.take(order), target.take(order)
        classes, contexts = np.divmod(pairs, len(found))
        starts = np.append(starts, len(target))
        cuts = np.searchsorted(classes, np.arange(len(self.classes) + 1)).tolist()
        for sums, lo, first, last in zip(self.classes, self.bounds.tolist(), cuts, cuts[1:]):
            safe = sums.near(length)
            for begin in range(first, last, sums.rows):
                end = min(begin + sums.rows, last)
                s = slice(starts[begin], starts[end])
                row = np.repeat(np.arange(end - begin), np.diff(starts[begin : end + 1]))
                norms, own = sums.of(hidden.take(contexts[begin:end], axis=0), safe, row, target[s] - lo)
                out[below[s]] += own - norms.take(row)
        return out / np.log(10)


def _slices(batches) -> Iterator[pa.Array]:
    for batch in batches:
        for part in sliced(batch, SLICE_BYTES, text_at=0):
            yield part.column(0)


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary) and its count over all texts, ends included.

    Tasks add up their own words and hand them on ``FLUSH`` at a time.
    """

    def merged(held):
        return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"]).combine_chunks()

    def count(batches):
        held, ends = [], 0
        for part in _slices(batches):
            ends += len(part)
            found = pc.value_counts(pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(part, ""))).flatten())
            words = found.field("values").cast(pa.binary())
            held.append(pa.table({"word": words, "n": found.field("counts")}).filter(pc.greater(pc.binary_length(words), 0)))
            if sum(t.num_rows for t in held) > 2 * FLUSH:
                held = [merged(held)]
                if held[0].num_rows > FLUSH:
                    yield from held.pop().to_batches()
        if ends:
            end = pa.table({"word": pa.array([END], pa.binary()), "n": pa.array([ends], pa.int64())})
            yield from merged([*held, end]).to_batches()

    parts = texts.mapInArrow(count, "word binary, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int, coverage: float) -> tuple[pa.Table, int]:
    """The most frequent words (word, n), the end left out, and how many of them make up ``coverage`` of all tokens.

    Given are all words whose count is in high enough a range: as long as they are
    ``most`` at most, and all that the coverage needs. Ranges are eighths of powers of
    two. Words seen once are not needed by the coverage: they stand for the unseen ones. How many words
    a share of the tokens needs is a trait of the languages, not of the number of texts.
    """
    counts = counts.filter(F.col("word") != F.lit(bytearray(END)))
    scale = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(scale.alias("range")).agg(F.count("*").alias("words"), F.sum("n").alias("n"))
    sizes = sizes.orderBy(F.desc("range")).collect()
    goal = coverage * sum(r["n"] for r in sizes)
    words = tokens = needed = 0
    least = None
    for r in sizes:
        wanted = tokens < goal and r["range"] > 0
        if not wanted and words + r["words"] > most:
            break
        words, tokens, least = words + r["words"], tokens + r["n"], r["range"]
        needed = words if wanted else needed
    rows = counts.filter(scale >= least if least is not None else F.lit(False)).toArrow()
    return rows.sort_by([("n", "descending"), ("word", "ascending")]).combine_chunks(), needed


def rest_totals(counts: DataFrame, symbols: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """Of each class's words without a symbol: their training tokens, and their add-half total."""
    name = uuid.uuid4().hex
    shared = counts.sparkSession.sparkContext.broadcast((symbols.words, symbols.head, len(symbols.rest)))

    def add(batches):
        symbols = kept_by_worker("symbols", name, lambda: Symbols(*shared.value))
        place = {number: g for g, number in enumerate(symbols.rest)}
        n, words = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        for batch in batches:
            numbers = symbols.of_all(batch.column(0).to_pylist()).tolist()
            at = np.fromiter(map(place.get, numbers, repeat(-1)), np.int64, batch.num_rows)
            np.add.at(n, at[at >= 0], batch.column(1).to_numpy()[at >= 0])
            np.add.at(words, at[at >= 0], 1)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (at, n[at], words[at])], names=["class", "n", "words"])

    found = counts.mapInArrow(add, "class bigint, n bigint, words bigint")
    tokens, totals = np.zeros(len(symbols.rest)), np.full(len(symbols.rest), 0.5)
    for r in found.groupBy("class").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect():
        tokens[r["class"]] = r["n"]
        totals[r["class"]] += r["n"] + 0.5 * r["words"]
    return tokens, totals


def train_model(texts: DataFrame, symbols: Symbols, counts: np.ndarray, width: int, batch_tokens: int) -> dict[str, np.ndarray]:
    """Every task trains on all its texts from one beginning; the mean of their models is kept.

    Each task has a whole model to hand on. So there are as many tasks as the cluster has cores, or one for so many
    tokens that the models are small beside the texts, but not one for each partition. A task's weight is its number of
    tokens. The models are cut into parts, and a part of all models is averaged at one place.
    """
    spark = texts.sparkSession
    name = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast((symbols.words, symbols.head, len(symbols.rest), counts))
    tasks = max(1, spark.sparkContext.defaultParallelism, int(counts.sum()) // (LEARNED * symbols.size))
    cuts = max(PARTS, tasks)

    def train(batches):
        *made, counts = shared.value
        one_thread()
        symbols = kept_by_worker("symbols", name, lambda: Symbols(*made))
        model = None
        seen = 0
        for part in _slices(batches):
            model = model or BilinearModel(symbols.size, width, counts, bounds=symbols.bounds)
            words, sizes = tokens_of(part)
            target, starts = sequences(symbols.of_tokens(words)[0], sizes, np.int32(1))
            near, far = contexts(target, starts)
            seen += len(target)
            for at in range(0, len(target), batch_tokens):
                s = slice(at, at + batch_tokens)
                model.train(target[s], near[s], far[s])
        if seen:
            for k, flat in enumerate(np.array_split(model.packed(), cuts)):
                yield pa.RecordBatch.from_pydict({"part": [k], "n": [seen], "mean": [flat.tobytes()]}, pa_kind)

    def average(table):
        n, total = 0, 0.0
        for seen, flat in zip(table["n"].to_pylist(), table["mean"].to_pylist()):
            n, total = n + seen, total + np.frombuffer(flat, "<f4") * float(seen)
        flat = (total / n).astype("<f4").tobytes()
        return pa.Table.from_pydict({"part": table["part"][:1], "n": [n], "mean": [flat]}, pa_kind)

    kind = "part int, n bigint, mean binary"
    pa_kind = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("mean", pa.binary())])
    models = texts.coalesce(tasks).mapInArrow(train, kind)
    means = {r["part"]: r["mean"] for r in models.groupBy("part").applyInArrow(average, kind).toLocalIterator()}
    if not means:
        return BilinearModel(symbols.size, width, counts, bounds=symbols.bounds).parts()
    mean = np.concatenate([np.frombuffer(means[k], "<f4") for k in range(cuts)])
    return unpacked(mean, symbols.size, width)


def score_documents(
    docs: DataFrame,
    held_out,
    id_column: str = "doc_id",
    text_column: str = "text",
    model_words: int | None = None,
    classes: int | None = None,
    width: int = 16,
    batch_tokens: int = 4096,
    shared_words: int = 150_000,
    coverage: float = 0.9,
) -> DataFrame:
    """Base and model score of every whole text, learned from those not ``held_out``.

    ``held_out`` is a condition on ``docs``. Columns: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score (add-half word frequencies) and score (the
    model), both log10. A null or empty text is its end alone. Repeated rows are
    learned from and scored each. Without training texts every word is unseen. An
    empty table gives no rows; other columns are not read.

    Counts and training cover all training texts. The words seen most often, up to
    ``coverage`` of the training tokens, have vectors of their own, and the number of
    classes is the root of theirs; ``model_words`` and ``classes`` set other numbers. At least
    these words and up to ``shared_words`` are broadcast with their counts; the counts of all
    rarer words are joined to the documents' rare words by a shuffle, where no word is frequent.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.col(text_column).cast("string").alias("text")
    learned = docs.filter(~held_out).select(text)
    counts = staged(word_counts(learned), "words")
    total, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    known, needed = frequent(counts, shared_words, coverage)
    ends = counts.filter(F.col("word") == F.lit(bytearray(END))).first()
    own = min(needed if model_words is None else model_words, known.num_rows)
    words, known_n = known["word"].combine_chunks(), known["n"].to_numpy()
    symbols = Symbols(words[:own], classes=classes)
    rest_tokens, totals = rest_totals(counts, symbols)
    tokens = np.zeros(symbols.size)
    tokens[symbols.rest] = rest_tokens
    tokens[[symbols.number[w] for w in words[:own].to_pylist()]] = known_n[:own]
    tokens[1] = ends["n"] if ends else 0
    parts = train_model(learned, symbols, tokens, width, batch_tokens)
    name = uuid.uuid4().hex
    made = symbols.words, symbols.head, len(symbols.rest)
    others = words[own:], known_n[own:]
    shared = spark.sparkContext.broadcast((name, made, tokens, totals, parts, others))

    def score(batches):
        name, made, tokens, totals, model, others = shared.value
        one_thread()
        symbols = kept_by_worker("symbols", name, lambda: Symbols(*made))
        scorer = kept_by_worker("scorer", name, lambda: Scorer(model, symbols.bounds, np.argsort(-tokens)[:OFTEN]))
        others = kept_by_worker("others", name, lambda: dict(zip(others[0].to_pylist(), others[1].tolist())))
        log_total = np.zeros(symbols.size)
        log_total[symbols.rest] = np.log10(totals)
        log_tokens, is_learned = np.log10(tokens + 0.5), (tokens > 0).astype(np.float64)
        end = int(tokens[1])
        for batch in batches:
            for part in sliced(batch, SLICE_BYTES, text_at=2):
                words, sizes = tokens_of(part.column(2))
                number, rare, names, index = symbols.of_tokens(words)
                n = np.fromiter(map(others.get, names, repeat(-1)), np.int64, len(names)).take(index)
                log_n, is_known = log_tokens.take(number), is_learned.take(number)
                log_n[rare] = np.where(n < 0, 0.0, np.log10(n.clip(0) + 0.5))
                is_known[rare] = n > 0
                share = log_n.take(rare) - log_total.take(number.take(rare))
                target, starts = sequences(number, sizes, np.int32(1))
                own = scorer.log10(target, *contexts(target, starts))
                row_of = np.repeat(np.arange(len(sizes)), sizes)
                base, is_known = (np.bincount(row_of, of_word, len(sizes)) for of_word in (log_n, is_known))
                share = np.bincount(row_of.take(rare), share, len(sizes))
                rare = rare[n < 0]
                bounds = np.searchsorted(row_of[rare], np.arange(len(sizes) + 1)).astype(np.int32)
                rare_words = words.take(pa.array(rare))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(sizes + 1, pa.int64()),
                        pa.array(is_known.astype(np.int64) + (end > 0), pa.int64()),
                        pa.array(base + np.log10(end + 0.5)),
                        pa.array(np.add.reduceat(own, starts) + share),
                        pa.ListArray.from_arrays(pa.array(bounds), rare_words),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"],
                )

    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), held_out.alias("held_out"), text)
    kind = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, rare array<binary>"
    scored = staged(rows.mapInArrow(score, kind).withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = scored.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_log"), F.count("n").alias("rare_known")
    )
    rare_log, rare_known = F.coalesce("rare_log", F.lit(0.0)), F.coalesce("rare_known", F.lit(0))
    whole = float(np.log10(total + 0.5 * (vocabulary + 1)))
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + rare_known).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + rare_log - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("score") + rare_log).alias("score"),
    )
