"""Token ids of whole texts, with the ids of frequent words kept per Python worker."""

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from geolayers.llm.batches import give_back, kept_by_worker

# The tokenizer drops ASCII white space and never joins what stands on its two
# sides, so a text's ids are its words' ids in a row. ASCII case is folded by the
# tokenizer as well, but behind NFC, which joins some capitals with a mark behind them
# and not the small letters: a text with such a mark keeps its case. A text that holds a
# special token is encoded as a whole.
SPECIAL = "oftext|>"
JOINED = "[\u0300-\u036f]"
# A run of Latin letters is one unit to the tokenizer, and so is a mark behind it:
# the merges alone then give the ids. All other words go through its whole chain.
PLAIN = re.compile(r"([a-zÀ-ÖØ-öø-įı-ž]+)([.,;:!?]?)")
MARKS = ".,;:!?"
SLICE_BYTES = 1 << 20
CALL = 4_000

class _Words(dict):
    """Number of each word; new words are numbered and listed."""

    def __init__(self):
        self.new = []

    def __missing__(self, word):
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordEncoder:
    """Encodes texts with a tokenizer file; keeps at most ``keep`` words' ids."""

    def __init__(self, path: str, end_id: int, keep: int = 150_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task; Spark spreads the work
        self.tokenizer = Tokenizer.from_file(path)
        self.end_id, self.keep = end_id, keep
        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {c: bytes_of(chr(c).lower())[0][0] for c in range(0xC0, 0x17F) if c != 0x130}
        self.marks = {m: [t.id for t in self.tokenizer.model.tokenize(m)] for m in MARKS} | {"": []}
        self.words = _Words()
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self):
        merges, plain = self.tokenizer.model.tokenize, PLAIN.fullmatch
        found, other = [], []
        for raw in self.words.new:
            word = raw.decode()
            parts = plain(word)
            if parts:
                letters, mark = parts.groups()
                if not letters.isascii():
                    letters = letters.translate(self.letters)
                ids = [t.id for t in merges(letters)]
                found.append(ids + self.marks[mark] if mark else ids)
            else:
                other.append(len(found))
                found.append(word)
        for at in range(0, len(other), CALL):
            places = other[at : at + CALL]
            done = self.tokenizer.encode_batch_fast([found[k] for k in places], add_special_tokens=False)
            for k, encoding in zip(places, done):
                found[k] = encoding.ids
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32, lengths.sum())])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])

    def _forget(self):
        over = len(self.words) - self.keep
        if over > 0:
            for word in self.words.new[-over:]:
                del self.words[word]
            self.starts = self.starts[: self.keep + 1].copy()
            self.ids = self.ids[: self.starts[-1]].copy()
        self.words.new = []
        give_back()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each text closed by the end id, and their counts."""
        texts = pc.fill_null(texts, "")
        low = pc.ascii_lower(texts)
        special = pc.match_substring(low, SPECIAL)
        whole = {
            k: self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids
            for k in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist()
        }
        low = pc.if_else(pc.match_substring_regex(texts, JOINED), texts, low)
        if whole:
            low = pc.if_else(special, "", low)
        split = pc.ascii_split_whitespace(low)  # with empty strings at the ends, which have no ids
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        number = np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))
        if self.words.new:
            self._learn()
        number = number[coded.indices.to_numpy()]
        size = np.diff(self.starts)[number]
        before = np.zeros(len(number) + 1, np.int64)
        np.cumsum(size, out=before[1:])
        last = np.cumsum(counts)
        first = before[last - counts]
        sizes = before[last] - first
        for k, found in whole.items():
            sizes[k] = len(found)
        sizes += 1
        ends = np.cumsum(sizes)
        out = np.full(ends[-1] if len(ends) else 0, self.end_id, np.uint32)
        # The t-th id of the words in a row goes behind earlier whole texts and end ids.
        t = np.arange(before[-1])
        found = self.ids[t + np.repeat(self.starts[number] - before[:-1], size)]
        out[t + np.repeat(ends - sizes - first, before[last] - first)] = found
        for k, found in whole.items():
            out[ends[k] - sizes[k] : ends[k] - 1] = found
        self._forget()
        return out, sizes


def encoder(path: str, end_id: int) -> WordEncoder:
    """The worker's own encoder, made once."""
    return kept_by_worker("encoder", (path, end_id), lambda: WordEncoder(path, end_id))


def sliced(batch, bytes_at_most: int = SLICE_BYTES, text_at: int = 1):
    """Slices of an Arrow batch whose texts are about ``bytes_at_most`` long together."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // bytes_at_most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for first, last in zip(cuts, cuts[1:]):
        yield batch.slice(first, last - first)
