"""Language model, near duplicates, top-k, sampled pieces and page text."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from llm_texts import ODD, documents, none, odd, prose, shared  # noqa: F401
from geolayers.llm import bilinear_lm, dart_minhash, topk
from geolayers.llm.bilinear_lm import END, BilinearModel, Scorer, Symbols, coded, frequent, score_documents
from geolayers.llm.dart_minhash import duplicate_classes, near_duplicates, without_near_copies
from geolayers.llm.html_text import extract_text, page_text
from geolayers.llm.pieces import Sampler, decode_pieces, encode_sampled
from geolayers.llm.queries import QUERIES
from geolayers.llm.topk import block_top, top_k
from geolayers.session import staged

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# --- language model


def words_of(text):
    return (text or "").encode().lower().split() + [END]


def check_base(rows, texts, held):
    counts = Counter(w for i, t in texts.items() if not held(i) for w in words_of(t))
    total, whole = sum(counts.values()), math.log10(sum(counts.values()) + 0.5 * (len(counts) + 1))
    assert len(rows) == len(texts)
    for r in rows:
        own = words_of(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in counts for w in own), total)
        assert r["base_score"] == pytest.approx(sum(math.log10(counts[w] + 0.5) - whole for w in own))
        assert r["held_out"] == held(r["doc_id"]) and r["score"] < 0


def test_base_scores_of_odd_texts(odd, none):
    rows = score_documents(odd, F.col("doc_id") % 2 == 1, shared_words=10, model_words=5).collect()
    check_base(rows, dict(enumerate(ODD)), lambda i: i % 2 == 1)
    nothing = score_documents(odd, F.lit(True)).collect()
    assert all(abs(r["base_score"]) < 1e-6 and r["train_tokens"] == 0 for r in nothing)
    assert score_documents(none, F.lit(False)).count() == 0


def test_model_beats_word_frequencies_on_held_out_texts(spark):
    rows = QUERIES["op5_bilinear_lm"](spark, "/root/testdata/sf0.1").filter("held_out").collect()
    n = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] for r in rows) / n > sum(r["base_score"] for r in rows) / n + 0.05


def test_base_of_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    check_base(QUERIES["op5_bilinear_lm"](spark, "/root/testdata/sf0.001").collect(), dict(docs), held)


def test_probabilities_sum_to_one():
    model = BilinearModel(30, 8, np.arange(30.0))
    draw = np.random.default_rng(0)
    model.train(draw.integers(1, 30, 500), draw.integers(0, 30, 500), draw.integers(0, 30, 500))
    scorer = Scorer(model.parts())
    total = sum(10 ** scorer.log10(np.array([t]), np.array([3]), np.array([4]))[0] for t in range(1, 30))
    assert total == pytest.approx(1, abs=1e-4)


def test_vocabulary_follows_the_counts(spark):
    counts = [(f"w{i}".encode(), 8 if i < 4000 else 3) for i in range(6000)] + [(f"once{i}".encode(), 1) for i in range(3000)]
    df = spark.createDataFrame(counts, "word binary, n bigint")
    known, needed = frequent(df, 10, 0.9)
    assert needed == known.num_rows == 6000 and min(known["n"].to_pylist()) == 3
    assert frequent(df, 10, 0.5)[1] == 4000
    whole = frequent(df, 20_000, 0.5)[0]
    order = sorted(counts, key=lambda r: (-r[1], r[0]))
    assert list(zip(whole["word"].to_pylist(), whole["n"].to_pylist())) == order
    known = known["word"].combine_chunks()
    symbols = Symbols(known)
    known = known.to_pylist()
    assert len({symbols.of(w) for w in known}) == 6000 and all(symbols.of(w) not in symbols.rest for w in known)
    assert symbols.of(b"unseen") in symbols.rest and len(symbols.rest) == 77
    assert max(np.diff(symbols.bounds)) <= 6000 / 77 + 2


def test_probabilities_within_classes_sum_to_one():
    symbols = Symbols(pa.array([f"w{i}".encode() for i in range(60)]), head=10)
    model = BilinearModel(symbols.size, 8, np.arange(float(symbols.size)), bounds=symbols.bounds)
    draw = np.random.default_rng(0)
    targets = np.setdiff1d(np.arange(1, symbols.size), np.arange(12, symbols.top))
    untrained = model.Q.copy()
    for _ in range(5):
        model.train(draw.choice(targets, 500), draw.choice(targets, 500), draw.choice(targets, 500))
    assert (model.Q[targets] != untrained[targets]).any(axis=1).all()
    near, far = np.full(len(targets), 3), np.full(len(targets), symbols.top + 1)
    found = Scorer(model.parts(), symbols.bounds).log10(targets, near, far)
    assert (10**found).sum() == pytest.approx(1, abs=1e-4)


def test_pairs_of_frequent_symbols():
    """Normalisers looked up in the table of pairs are those computed one by one, also where exponentials overflow."""
    symbols = Symbols(pa.array([f"w{i}".encode() for i in range(300)]), head=10)
    model = BilinearModel(symbols.size, 8, np.arange(float(symbols.size)), bounds=symbols.bounds)
    draw = np.random.default_rng(0)
    targets = np.setdiff1d(np.arange(1, symbols.size), np.arange(12, symbols.top))
    target, near, far = (draw.choice(targets, 4000) for _ in range(3))
    often = draw.choice(targets, 100, replace=False)
    for times in (1, 1000):
        parts = model.parts() | {"R": model.R * times}
        scorer = Scorer(parts, symbols.bounds, often)
        assert (scorer.pairs is not None) == (times == 1)
        found = scorer.log10(target, near, far)
        assert found == pytest.approx(Scorer(parts, symbols.bounds).log10(target, near, far), abs=1e-4)
        scores = lambda at, h: h @ parts["Q"][at].T.astype(float) + parts["b"][at]
        for k in range(0, 4000, 97):
            h = (parts["R"][near[k]] * model.c[0] + parts["R"][far[k]] * model.c[1]).astype(float)
            upper = model.parent[target[k]]
            plain = scores(np.array([upper]), h)[0] - np.logaddexp.reduce(scores(np.arange(1, symbols.top), h))
            if upper != target[k]:
                own = np.flatnonzero(model.parent == upper)
                own = own[own >= symbols.top]
                plain += scores(target[k : k + 1], h)[0] - np.logaddexp.reduce(scores(own, h))
            assert found[k] == pytest.approx(plain / np.log(10), rel=1e-4, abs=1e-4)


def test_normalisers_are_computed_once(monkeypatch):
    """Repeated targets and contexts cost no exponentials of their own, nor do pairs with a frequent symbol cost a whole row."""
    symbols = Symbols(pa.array([f"w{i}".encode() for i in range(300)]), head=10)
    model = BilinearModel(symbols.size, 8, np.arange(float(symbols.size)), bounds=symbols.bounds)
    draw = np.random.default_rng(0)
    targets = np.setdiff1d(np.arange(1, symbols.size), np.arange(12, symbols.top))
    target, near, far = (draw.choice(targets, 200) for _ in range(3))
    plain = Scorer(model.parts(), symbols.bounds).log10(target, near, far)
    rows, of = [], bilinear_lm.Sums.of
    monkeypatch.setattr(bilinear_lm.Sums, "of", lambda self, hidden, *more: rows.append(len(hidden)) or of(self, hidden, *more))
    often = targets[:100]
    times = draw.permutation(np.repeat(np.arange(200), 20))
    found = Scorer(model.parts(), symbols.bounds, often).log10(target[times], near[times], far[times])
    assert found == pytest.approx(plain[times], abs=1e-4)
    rare = {(a, b) for a, b in zip(near.tolist(), far.tolist()) if a not in often and b not in often}
    below = {(a, b, model.parent[t]) for t, a, b in zip(target.tolist(), near.tolist(), far.tolist()) if t >= symbols.top}
    assert sum(rows) == len(rare) + len(below)


def test_orders_of_whole_numbers():
    draw = np.random.default_rng(0)
    for most in (1, 5, 10**6, 2**62):  # the last ones leave no room for a place beside them
        values = draw.integers(0, most, 3000)
        order, found = bilinear_lm.ordered(values)
        assert order.tolist() == np.argsort(values, kind="stable").tolist() and (found == values[order]).all()
        numbers, place, order, starts = bilinear_lm.distinct(values)
        assert (numbers[place] == values).all() and numbers.tolist() == sorted(set(values.tolist()))
        assert (values[order[starts]] == numbers).all()
    assert [len(x) for x in bilinear_lm.distinct(np.zeros(0, np.int64))] == [0, 0, 0, 0]


def test_symbols_of_tokens():
    symbols = Symbols(pa.array([b"a", b"b", "é".encode(), b"cab", b"dab"]), head=2, classes=2)
    words, sizes = bilinear_lm.tokens_of(pa.array([" A x\x0bcab ", None, "", "x \x85y\n", "É b"]))
    assert words.to_pylist() == [b"a", b"x", b"cab", b"x", b"\xc2\x85y", "É".encode(), b"b"] and sizes.tolist() == [3, 0, 0, 2, 2]
    found, rare, names, index = symbols.of_tokens(words)
    assert found.tolist() == [symbols.of(w) for w in words.to_pylist()]
    assert rare.tolist() == [1, 3, 4, 5] and [names[k] for k in index] == [b"x", b"x", b"\xc2\x85y", "É".encode()]
    assert [len(x) for x in symbols.of_tokens(words.slice(0, 0))] == [0, 0, 0, 0]


def test_stored_bytes_do_not_follow_partitions(spark, monkeypatch):
    """A partition does not leave a model of its own."""
    texts = [prose(i, 60, [f"w{i * 40 + k}x" for k in range(60)]) for i in range(64)]
    files = []

    def noted(df, purpose):
        out = staged(df, purpose)
        files.extend(f.removeprefix("file:") for f in out.inputFiles())
        return out

    monkeypatch.setattr(bilinear_lm, "staged", noted)
    stored = {}
    for partitions in (2, 64):
        files.clear()
        rows = score_documents(documents(spark, texts).repartition(partitions), F.col("doc_id") % 5 == 1).collect()
        check_base(rows, dict(enumerate(texts)), lambda i: i % 5 == 1)
        stored[partitions] = sum(map(os.path.getsize, files))
    assert 0 < stored[64] < 2 * stored[2] + 300_000


def test_words_of_a_batch():
    words, index, counts = coded(pa.array([" A b\x0ba ", None, "", "\x85x é"]))
    assert [words[i] for i in index] == [b"a", b"b", b"a", b"\xc2\x85x", "é".encode()] and counts.tolist() == [3, 0, 0, 2]


# --- near duplicates


def bag(text):
    w = (text or "").encode().lower().split()
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def brute_classes(texts):
    bags = [bag(t) for t in texts]
    home = list(range(len(texts)))

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            same = texts[i] == texts[j]
            if not same and bags[i] and bags[j]:
                shared_ = sum((bags[i] & bags[j]).values())
                same = shared_ / (sum(bags[i].values()) + sum(bags[j].values()) - shared_) >= 0.8
            if same:
                a, b = find(i), find(j)
                home[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def copies():
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for k in range(12):
        base = draw.choices(vocabulary, k=draw.choice([6, 40, 150, 400]))
        for _ in range(draw.choice([1, 2, 5, 25])):
            copy = list(base)
            for _ in range(draw.randint(0, 1 + len(base) // 60)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
        texts.append(" ".join(base).upper().replace(" ", "\n", 3))
    passage = draw.choices(vocabulary, k=60)
    texts += [" ".join(passage + draw.choices(vocabulary, k=40)) for _ in range(30)]
    texts += ["one two three", "one  two three", "a a a a a a a a a", "a a a a a a a", texts[0], texts[0]]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [2048, 4])
def test_classes_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(dart_minhash, "BLOCK", block)
    texts = copies()
    want = brute_classes(texts)
    docs = documents(spark, texts)
    rows = {r["doc_id"]: r for r in duplicate_classes(docs).collect()}
    assert [rows[i]["class_id"] for i in range(len(texts))] == want
    assert all(rows[i]["class_docs"] == want.count(want[i]) for i in rows)
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def test_odd_texts_and_ids(spark, odd, none):
    rows = {r["doc_id"]: r["class_id"] for r in duplicate_classes(odd).collect()}
    assert rows == {i: 6 if i == 7 else i for i in range(len(ODD))}
    again = documents(spark, ["same text here", "same text here", "same text here", None, None, "x y"], ids=[3, 3, None, None, 7, 1])
    assert sorted(r["class_docs"] for r in duplicate_classes(again).collect()) == [1, 2, 2, 3, 3, 3]
    assert sorted(str(r["doc_id"]) for r in without_near_copies(again).collect()) == ["1", "3", "7"]
    assert duplicate_classes(none).count() == 0 and without_near_copies(none).count() == 0
    with pytest.raises(ValueError):
        near_duplicates(odd, least=0.5)


def test_darts_agree_as_often_as_texts_are_alike():
    draw = random.Random(2)
    a = draw.choices("abcdefghij", k=400)
    b = a[:300] + draw.choices("klmnop", k=100)
    texts = [" ".join(a), " ".join(b)]
    found, counts = dart_minhash.shingles(pa.array(texts))
    darts = dart_minhash.throw(*dart_minhash.cells(found, counts), counts, 4096)
    x, y = map(bag, texts)
    shared_ = sum((x & y).values())
    exact = shared_ / (sum(x.values()) + sum(y.values()) - shared_)
    assert (darts[0] == darts[1]).mean() == pytest.approx(exact, abs=0.04)


# --- top-k


def brute_top(ids, vectors, k=20):
    out = set()
    for i, v in zip(ids, vectors):
        if i % 20 == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in zip(ids, vectors) if j != i)[:k]
            out |= {(i, n, j, -s) for n, (s, j) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("n,high", [(300, 1), (50, 1e5), (12, 3e8)])
def test_top_k_with_ties(spark, monkeypatch, n, high):
    draw = random.Random(1)
    vectors = [[draw.randint(-2, 2) * high / 64 for _ in range(6)] for _ in range(n)]
    odd_rows = [(n, None), (n + 20, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (n + 1, [float("nan")] * 6), (n + 2, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in [*enumerate(vectors), *odd_rows]], "vec_id bigint, embedding array<double>, rank string")
    monkeypatch.setattr("geolayers.llm.topk.BLOCK_ROWS", 64)
    monkeypatch.setattr("geolayers.llm.topk.QUERY_ROWS", 4)
    rows = top_k(df.repartition(3), F.col("id") % 20 == 0).collect()
    whole = [[math.floor(64 * x) for x in v] for v in vectors]
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows} == brute_top(range(n), whole)
    assert top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_mixed_dimensions_and_repeats(spark):
    rows = [(0, [1.0]), (20, [1.0, 2.0]), (1, [3.0]), (1, [3.0]), (2, [1.0, 1.0]), (0, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = sorted(tuple(r) for r in top_k(df, F.col("id") % 20 == 0).collect())
    assert found == [(0, 1, 1, 64 * 192), (0, 2, 1, 64 * 192), (20, 1, 2, 64 * 64 * 3)]


@pytest.mark.parametrize("widths, latest", [([60, *[1] * 15], 0.2), ([20] * 16, 1.0)])
def test_bounds_settle_queries_before_the_lists_end(widths, latest):
    """With one dominant component outsiders fall out early; the result is that of all scores in any case."""
    draw = np.random.default_rng(4)
    vectors = np.stack([draw.integers(-w, w + 1, 3000) for w in widths], axis=1)
    vectors[2000:2100] = vectors[:100]
    ids, depths = np.arange(3000), []
    found = block_top(ids[:40], vectors[:40], ids, vectors, 5, depths)
    scores = vectors[:40] @ vectors.T
    for q in range(40):
        order = [i for i in np.lexsort((ids, -scores[q])) if i != q][:5]
        assert found[1][found[0] == q].tolist() == order
        assert found[2][found[0] == q].tolist() == scores[q][order].tolist()
    assert len(depths) == 40 and sum(d <= latest for d in depths) >= 20


def test_what_other_blocks_gave_settles_queries_before_the_lists_end():
    """Of evenly drawn vectors most queries need 0.8 of the lists, once a first block has given them k scores, and more before."""
    draw = np.random.default_rng(5)
    vectors = np.floor(draw.normal(size=(4 * 4096, 64)) * 8).astype(np.int64)
    ids = draw.permutation(len(vectors))
    asked = topk.Asked(ids[:300], vectors[:300], 20)
    for first in range(0, len(vectors), 4096):
        depths = []
        topk.read_lists(asked, topk.Block(ids[first : first + 4096], vectors[first : first + 4096]), depths)
        assert len(depths) == 300 and (sum(d <= 0.8 for d in depths) >= 200) == (first > 0)
    scores = vectors[:300] @ vectors.T
    for q in range(300):
        order = [i for i in np.lexsort((ids, -scores[q])) if i != q][:20]
        assert asked.found[q].tolist() == ids[order].tolist() and asked.scores[q].tolist() == scores[q][order].tolist()


@pytest.mark.parametrize("lane, queries", [(2, 2), (1, 1), (16, 128)])
def test_top_k_over_lanes_and_sets_of_queries(spark, monkeypatch, lane, queries):
    for name, value in {"BLOCK_ROWS": 16, "QUERY_ROWS": 2, "LANE_BLOCKS": lane, "SET_BLOCKS": queries}.items():
        monkeypatch.setattr(topk, name, value)
    draw = random.Random(2)
    parts = [(range(200), 6, 2), (range(200, 260), 3, 2), (range(400, 441), 2, 1e17)]
    rows = [(i, [draw.randint(-2, 2) / 64 * high for _ in range(dim)]) for ids, dim, high in parts for i in ids]
    rows += [(7, rows[7][1]), (500, [1.0, None]), (501, [float("inf")] * 6), (502, None), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    if lane == 1:  # beyond 64 bits: an error, as it was
        with pytest.raises(Exception, match="scores beyond 64 bits"):
            top_k(df, F.col("id") % 20 == 0).collect()
    df = df.filter("vec_id < 400 or vec_id >= 500")
    found = {tuple(r) for r in top_k(df, F.col("id") % 20 == 0).collect()}
    sound = [[(i, [math.floor(64 * x) for x in v]) for i, v in rows if i in ids] for ids, _, _ in parts[:2]]
    assert found == set().union(*(brute_top(*zip(*part)) for part in sound))


def test_numbers_are_those_of_spark(spark):
    """floor(scale * x) is computed in Arrow as Spark does it, to the last number of 64 bits."""
    draw = random.Random(3)
    odd = [0.0, -0.0, 1e308, -1e308, 2.0**57, -(2.0**57), 1.44e17, 1 / 3, -1 / 3, 5e-324, 144115188075855864.0]
    rows = [(i, [draw.choice(odd) * draw.choice([1, -1, 0.999]) for _ in range(i % 5)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    plain = df.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x).cast("bigint")))
    whole = topk.quantised(df, "vec_id", "embedding").mapInArrow(lambda b: topk._whole(b, 64.0), "id bigint, v array<bigint>")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, plain.collect()))


# --- pieces


def test_pieces_come_back_as_the_text(spark, odd, none):
    draw = random.Random(1)
    texts = ["".join(draw.choices(list("abc  \n\n\t▁é漢😀ﬁ́xthe "), k=draw.randint(0, 30))) for _ in range(400)] + ODD + [" " * 900, "x" * 3000]
    docs = documents(spark, texts)
    rows = decode_pieces(encode_sampled(docs, MODEL), MODEL).collect()
    assert len(rows) == len(texts) and all(r["text"] == r["row"]["row"]["text"] for r in rows)
    other = {r["row"]["doc_id"]: bytes(r["ids"] or b"") for r in encode_sampled(docs.repartition(5), MODEL).collect()}
    assert other == {r["row"]["row"]["doc_id"]: bytes(r["row"]["ids"] or b"") for r in rows}
    changed = {r["row"]["doc_id"]: bytes(r["ids"] or b"") for r in encode_sampled(docs, MODEL, seed=1).collect()}
    assert changed != other
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert model.decode(np.frombuffer(other[5], "<u4").tolist()) == texts[5]
    assert encode_sampled(none, MODEL).count() == 0


def test_query_is_lossless(spark):
    rows = QUERIES["op8_sampled_pieces"](spark, "/root/testdata/sf0.001")
    assert rows.filter("lossless").count() == rows.count() == 200


def test_samples_follow_the_lattice():
    sampler = Sampler(MODEL, 1.0)
    ids, weight = sampler.vocabulary.ids, sampler.weight

    def ways(text):
        if not text:
            yield (), 0.0
        for k in range(1, len(text) + 1):
            if text[:k] in ids:
                for rest, w in ways(text[k:]):
                    yield (ids[text[:k]], *rest), w + weight[ids[text[:k]]]

    n = 20_000
    found, sizes = sampler.sample(["there"] * n, np.arange(n))
    got = Counter(tuple(p.tolist()) for p in np.split(found, np.cumsum(sizes)[:-1]))
    exact = {way: math.exp(w) for way, w in ways(" there")}
    whole = sum(exact.values())
    assert set(got) <= set(exact)
    assert max(abs(got[way] / n - w / whole) for way, w in exact.items()) < 0.015


# --- pages

PAGES = {
    "": "",
    "plain  text\n here": "plain text here",
    "<title>no</title><p>a<p>b <b>c</b>d": "a\n\nb cd",
    "<div>a<div>b</div>c</div>": "a\nb\nc",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>f": "- a\n- b\n  3. c\n  4. d\n- e\n\nf",
    "<table><tr><th>Name<th>n<tr><td>long one<td>1<tr><td>x<td>22</table>": "Name      n\nlong one  1\nx         22",
    "<table><tr><td rowspan=2>r<td>x<tr><td>y<tr><td colspan=2>wide</table>": "r  x\n   y\nwide",
    "<table><td>a<table><td>b<td>c</table><td>d</table>": "a     d\n\nb  c",
    "x<span hidden>no</span><p style='display: none'>no</p><i style='visibility:hidden'>no<b style='visibility:visible'>yes</b></i>": "xyes",
    "<script>if (a < b) '</p>'</script><style>p{}</style>ok<!-- no --><noscript>no</noscript>": "ok",
    f"<table><tr><td>{'w' * 70}<td>z<tr><td>a<td>b</table>": f"{'w' * 70}  z\na{' ' * 71}b",
    f"<table><tr><td>{'w' * 201}<td>z<br>y<tr><td>a<td>b</table>": f"{'w' * 201}\n   z\n   y\na  b",
    "<table><tr><td colspan=2>twelve chars<td>z<tr><td>a<td>b<td>c</table>": "twelve chars  z\na      b      c",
    "<table><tr><td colspan=1000>x<td>y<tr><td>long<td>z</table>": "x        y\nlong  z",
    "<frameset><noframes>no</noframes></frameset>yes": "yes",
    "<pre> a\n   b</pre>": " a\n   b",
    "<div><svg/>hello</div>": "hello",
    "<p>a<svg><title>no</title><defs><text>no</text></defs><style>no</style><g/>no<text>one <tspan>t</tspan>wo</text><text x=1>three</text></svg>b": "a one two three b",
    "<svg><desc/><text/><foreignObject><div/>in</foreignObject><path d=''/></svg>out": "in\nout",
    "<svg><text display=none>no</text><text visibility=hidden>no</text><g><p>after</svg>x": "afterx",
    "<math><mspace/><mi>x</mi></math><svg/>y<b/>z": "xyz",
    "<dl><dt>t<dd>d1<dd>d2</dl><details><summary>s</summary>no</details>": "t\n    d1\n    d2\n\ns",
    "a &amp; &lt;b&gt; &eacute; &#x41; <![foo[ x ]]> </p> </b>": "a & <b> é A",
    "<p>unclosed <a href='x": "unclosed",
}


@pytest.mark.parametrize("html", PAGES)
def test_page(html):
    assert page_text(html) == PAGES[html]


def test_columns_of_generated_tables():
    """Every cell of a column begins at the same place, with two blanks before it at least, and is whole."""
    draw = random.Random(11)
    for _ in range(300):
        places, html, cells = {}, [], 0
        for _ in range(draw.randint(1, 5)):
            column, row = 0, []
            while column < 6 and draw.random() < 0.9:
                span = draw.choice([1, 1, 1, 2, 3])
                name = f"c{cells}" + "x" * draw.choice([0, 1, 5, 30, 90, 250])
                cells += 1
                row.append(f"<td colspan={span}>{name}<br>{name}")
                places[name] = column
                column += span
            html.append("<tr>" + "".join(row))
        lines = page_text("<table>" + "".join(html) + "</table>").split("\n")
        at = {}
        for line in lines:
            for found in re.finditer(r"\S+", line):
                at.setdefault(places[found[0]], set()).add(found.start())
                assert found.start() == 0 or line[max(0, found.start() - 2) : found.start()] == "  "
        assert all(len(starts) == 1 for starts in at.values())
        assert sorted(" ".join(lines).split()) == sorted([*places] * 2)


def test_deep_and_long_pages():
    assert page_text("<table><tr>" + "<td>x" * 50_000 + "</table>") == "  ".join("x" * 50_000)
    assert page_text("<table>" + "<tr><td colspan=1000>x<td>y" * 1000 + "</table>") == "\n".join(["x  y"] * 1000)
    assert page_text("<div>" * 30_000 + "x") == "x"
    assert page_text("<table><td>" * 2000 + "x") == "x"
    assert page_text("<p>a</p>" * 20_000).count("a") == 20_000


def test_all_words_of_generated_trees():
    draw = random.Random(8)
    for _ in range(200):
        words = []

        def node(depth):
            tag = draw.choice("div p span ul section b table".split())
            inner = []
            for _ in range(draw.randint(0, 3)):
                if depth < 4 and draw.random() < 0.6:
                    inner.append(node(depth + 1))
                else:
                    words.append(f"w{len(words)}")
                    inner.append(f" {words[-1]} ")
            body = "".join(inner)
            if tag == "ul":
                return f"<ul><li>{body}</ul>"
            return f"<table><tr><td>{body}</table>" if tag == "table" else f"<{tag}>{body}</{tag}>"

        html = node(0)
        assert page_text(html).replace("-", " ").split() == words


def test_pages_as_rows(spark):
    df = spark.createDataFrame([(1, "<p>a", "x"), (2, None, "y"), (2, "", "z"), (None, "<p>a", "x")], "page_id bigint, html string, text string")
    assert sorted(map(str, (tuple(r) for r in extract_text(df).collect()))) == sorted(
        map(str, [(1, "a"), (2, None), (2, ""), (None, "a")]))
    assert extract_text(df.limit(0)).count() == 0
    assert QUERIES["op1_html_text"](spark, "/root/testdata/sf0.001").filter("text is null").count() == 0
