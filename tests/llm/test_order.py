"""Captures and archives, hard negatives, resampling: against plain versions."""

import gzip
import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geolayers.llm import captures, dart_minhash, hard_negatives, radix, warc
from geolayers.llm.captures import LoserTree, merge_runs, url_key
from geolayers.llm.hard_negatives import Group, candidate_blocks, mine_hard_negatives, needs
from geolayers.llm.hilbert import hilbert_keys
from geolayers.llm.radix import counting_sort, radix_placed
from geolayers.llm.resampling import resample, resampled
from geolayers.llm.warc import read_archives, read_captures, write_archives
from geolayers.session import staged
from conftest import plan_of
from llm_texts import ODD, documents, none, odd, prose, shared  # noqa: F401


def test_loser_tree_against_a_heap():
    draw = random.Random(1)
    for k in [0, 1, 2, 3, 5, 8, 33]:
        runs = [sorted(draw.randint(0, 20) for _ in range(draw.randint(0, 12))) for _ in range(k)]
        assert [key for _, key in LoserTree(runs)] == list(heapq.merge(*runs))
        # Equal keys come out in the order of the runs.
        assert [r for r, _ in LoserTree(runs)] == [r for _, r in heapq.merge(*([(key, i) for key in run] for i, run in enumerate(runs)))]


def test_url_keys(spark):
    urls = {"http://A.Example.COM/Path?q#x": "com,example,a)/Path?q", "no scheme/x#y": ")no scheme/x", None: ")", "": ")",
            "x://h": "h)", "x://h?a/b": "h)?a/b", "x://#f": ")", "a://b://c": "b:)//c"}
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", url_key(F.col("url")).alias("k")).collect()
    assert {r["url"]: r["k"] for r in rows} == urls


PAGES = "page_id bigint, url string, html string, id bigint, file string, payload binary, capture string"


def pages(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "f", None, "c") for r in rows], PAGES)
    return df.repartition(parts, "page_id") if rows else df


def plain_records(rows, least=1000):
    last = {}
    for page_id, _, html in rows:
        if page_id is not None:
            last[html or ""] = max(page_id, last.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        copies = sum((h or "") == (html or "") for _, _, h in rows)
        leader = last.get(html or "")
        again = len(body) >= least and copies > 1 and leader is not None and page_id != leader
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", leader if again else None))
    return Counter(out)


HOT = "<p>" + "same " * 300
ROWS = [
    (1, "http://a.com/x", HOT), (2, "http://a.com/x", HOT), (2, "http://a.com/x", HOT), (None, "http://a.com/x", HOT),
    (3, None, None), (4, "", ""), (5, "http://b.org/a b\r\nX: y", "é" * 600), (6, "http://b.org/", "é" * 600),
    (7, "http://c.net/", "x" * 999), (8, "http://c.net/", "x" * 999), (9, "http://c.net/long", prose(3, 400_000)),
    (10, "漢://字/\u2028\x85", "WARC/1.1\r\n\r\n"), (-5, "http://a.com/x", "neg"), (None, "n", "z" * 2000), (None, "n", "z" * 2000),
]


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_archives_against_a_plain_version(spark, conf, tmp_path, monkeypatch, limit):
    """Small and large lists of copies, several runs and archives in a task."""
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    monkeypatch.setattr(warc, "HEAVY", 1)
    rows = ROWS + [(100 + i, f"http://h{i % 7}.com/{i % 5}", f"{i // 3} " * 400) for i in range(200)]
    path = str(tmp_path / "archives")
    index = write_archives(pages(spark, rows), path, F.col("page_id") + 5)
    found = read_captures(index, path).collect()
    key = lambda r: (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
    assert Counter(map(key, found)) == plain_records(rows)
    payloads = Counter((p, (h or "").encode()) for p, _, h in rows)
    assert all(payloads[r["page_id"], bytes(r["payload"])] for r in found if r["record_type"] == "response")
    by_id = {r["page_id"]: r for r in found}
    assert by_id[5]["url"] == "http://b.org/a%20b%0D%0AX:%20y" and by_id[3]["url"] is None and by_id[9]["stamp"] == 14
    assert by_id[10]["url"] == "漢://字/\u2028\x85" and by_id[-5]["stamp"] == 0
    # Histories count each URL's captures in order of time, and the index is in one order.
    history = sorted((r["stamp"], r["page_id"]) for r in found if r["urlkey"] == "com,h1)/1")
    assert [r["page_id"] for r in sorted(found, key=lambda r: r["capture"]) if r["urlkey"] == "com,h1)/1"] == [p for _, p in history]
    rows = index.orderBy("part", "at").select(*captures.KEY).collect()
    keys = [captures.order_key(*r) for r in rows]
    assert keys == sorted(keys)
    # Any reader of the format sees the same records without the index.
    archives = [str(p) for p in (tmp_path / "archives").iterdir() if p.name.endswith(".warc.gz")]
    assert Counter(map(key, read_archives(spark, archives).collect())) == Counter(map(key, found))
    text = b"".join(gzip.open(p).read() for p in archives)
    assert text.count(b"WARC-Type: warcinfo") == len(archives) and b"WARC-Refers-To: <urn:x-page:2>" in text


def test_small_runs_ranges_and_archives(spark, tmp_path, monkeypatch):
    """A URL with most captures goes over several ranges; its history counts on."""
    rows = [("r%d" % (i % 9), i // 9, "hot)" if i % 4 else f"k{i % 11})", i // 9, i, "f", i, 1, "response") for i in range(3000)]
    runs = {}
    for r in rows:
        runs.setdefault(r[0], []).append(r)
    rows = [(*r[:1], n, *r[2:]) for run in runs.values() for n, r in enumerate(sorted(run, key=lambda r: captures.order_key(*r[2:7])))]
    merged = merge_runs(staged(spark.createDataFrame(rows, captures.RUN), "runs")).orderBy("part", "at").collect()
    assert [r["id"] for r in merged] == [r[4] for r in sorted(rows, key=lambda r: captures.order_key(*r[2:7]))]
    seen = Counter()
    for r in merged:
        seen[r["urlkey"]] += 1
        assert r["capture"] == seen[r["urlkey"]]
    assert len({r["part"] for r in merged if r["urlkey"] == "hot)"}) > 1
    assert merge_runs(staged(spark.createDataFrame([], captures.RUN), "runs")).count() == 0


def test_no_pages_and_torn_archives(spark, tmp_path):
    path = str(tmp_path / "none")
    assert read_captures(write_archives(pages(spark, []), path), path).count() == 0
    path = str(tmp_path / "torn")
    index = staged(write_archives(pages(spark, [(1, "u", "text" * 500)], 1), path), "index")
    archive = next(p for p in (tmp_path / "torn").iterdir() if p.name.endswith(".warc.gz"))
    whole = archive.read_bytes()
    archive.write_bytes(whole[:-8])
    with pytest.raises(Exception):
        read_captures(index, path).collect()
    with pytest.raises(Exception):
        read_archives(spark, [str(archive)]).collect()
    payload = warc.capture_record(1, "u", 0, 4, hashlib.sha1(b"text").hexdigest(), None, b"texd")
    with pytest.raises(OSError):
        warc.parsed(zlib.decompress(payload, 31))


@pytest.mark.parametrize("dims, bits", [(1, 3), (2, 1), (2, 4), (3, 3), (5, 2)])
def test_hilbert_neighbours(dims, bits):
    """Along the curve, each cell is met once and a step changes one dimension by one."""
    cells = np.indices([1 << bits] * dims).reshape(dims, -1).T
    order = np.argsort([k.tobytes() for k in hilbert_keys(cells, bits)], kind="stable")
    assert len({k.tobytes() for k in hilbert_keys(cells, bits)}) == len(cells)
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


VECTORS = "vec_id bigint, embedding array<float>, label int, id string, block int, n int, score string"


def vectors(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], VECTORS)
    return df.repartition(parts, "vec_id") if rows else df


def plain_negatives(rows, step, scale=256.0, positives=5, negatives=5):
    sound = [
        (i, y, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v, y in rows
        if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)
    ]
    asked = {}
    for i, y, v in sound:
        if i % step == 0:
            asked[i] = max(asked.get(i, (y, v)), (y, v), key=lambda a: (a[0], np.array(a[1], "<i8").tobytes()))
    out = []
    for a, (y, v) in asked.items():
        scored = [(-sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in sound if i != a and len(w) == len(v)]
        near = sorted((s, i) for s, i, z in scored if z == y)[:positives]
        for s, i in near:
            fit = sorted((t, j) for t, j, z in scored if z != y and 80 * -s <= 100 * -t <= 100 * -s)
            out += [(a, i, rank, j, -s, -t) for rank, (t, j) in enumerate(fit[:negatives], 1)]
    return Counter(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def found_negatives(df, step=4):
    return Counter(tuple(r) for r in mine_hard_negatives(df, F.col("id") % step == 0).select(COLUMNS).collect())


@pytest.mark.parametrize("block, group, zones, held", [(256, 512, 256, 64), (7, 5, 3, 1)])
def test_hard_negatives_against_a_plain_version(spark, monkeypatch, block, group, zones, held):
    for name, value in {"BLOCK_ROWS": block, "GROUP_ROWS": group, "ZONES": zones, "HELD": held}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=6).round(1).tolist(), int(draw.integers(0, 3))) for i in range(160)]
    rows += [(200 + i, [0.5] * 6, i % 2) for i in range(40)]  # copies: ties go to smaller ids
    rows += [(i, draw.normal(size=3).tolist(), i % 2) for i in range(300, 330)]  # another length
    rows += [(340, None, 1), (344, [1.0] * 6, None), (348, [1.0, None] * 3, 1), (352, [float("nan")] * 6, 1), (None, [1.0] * 6, 1)]
    rows += [(356, [float("inf")] * 6, 1), (360, [], 1), (364, [], 0), (4, [2.0] * 6, 2), (4, [2.0] * 6, 2), (400, [100.0] * 6, 9)]
    assert found_negatives(vectors(spark, rows)) == plain_negatives(rows, 4)
    assert found_negatives(vectors(spark, [])) == Counter()


def test_zone_maps_leave_blocks_out(spark, monkeypatch):
    """With vectors in clusters most blocks are not read, and what is found stays the same."""
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 16)
    read = spark.sparkContext.accumulator(0)
    wanted = hard_negatives.wanted_blocks

    def counted(blocks, groups, same):
        found = staged(wanted(blocks, groups, same), "found")
        read.add(found.count())
        read.total = blocks.count()
        return found

    monkeypatch.setattr(hard_negatives, "wanted_blocks", counted)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(40, 8)) * 4
    rows = [(i, (centres[i % 40] + draw.normal(size=8) * 0.05).tolist(), i // 40 % 2) for i in range(1600)]
    step = 160
    found = Counter(tuple(r) for r in mine_hard_negatives(vectors(spark, rows), F.col("id") % step == 0).collect())
    assert found == plain_negatives(rows, step) and sum(found.values()) > 100
    assert read.value < 0.3 * 2 * read.total


def test_copies_of_anchors_are_never_broadcast(spark, conf, monkeypatch):
    """Their files look small, but the driver would hold the copies of all lanes."""
    conf("spark.sql.autoBroadcastJoinThreshold", "1g")
    met, plans = hard_negatives._meet, []

    def seen(*args):
        plans.append(plan_of(found := met(*args)))
        return found

    monkeypatch.setattr(hard_negatives, "_meet", seen)
    rows = [(i, [0.1 * i, 2e5 if i == 3 else 1.0], i % 2) for i in range(40)]  # 2e5: wider than two bytes
    assert found_negatives(vectors(spark, rows)) == plain_negatives(rows, 4)
    assert len(plans) == 4 and all("SortMergeJoin" in p and "Broadcast" not in p.split("SortMergeJoin")[0] for p in plans)


def test_bounds_hold_all_scores(spark):
    draw = np.random.default_rng(5)
    matrix = draw.integers(-50, 50, (40, 9))
    rows = [(i, v.tolist(), i % 3, i % 2 == 0) for i, v in enumerate(matrix)]
    blocks = candidate_blocks(spark.createDataFrame(rows, "id bigint, v array<bigint>, label bigint, asked boolean"))
    for batch in blocks.drop("asked").toArrow().to_batches():
        for at in range(batch.num_rows):
            block = hard_negatives.Block(batch, at)
            group = object.__new__(Group)
            group.vectors, group.above, group.below = matrix, np.maximum(matrix, 0), np.minimum(matrix, 0)
            least, most = group.bounds(block.low[None, :], block.high[None, :])
            scores = matrix @ block.vectors().T
            assert (least <= scores).all() and (scores <= most).all()
    assert needs(np.array([[3]]), np.array([[5]]), np.array([[True]]), np.array([[6]]), np.array([[9]])).sum() == 0


def test_radix_places_against_sorting(spark, conf):
    draw = random.Random(7)
    extremes = [(1 << 63) - 1, -(1 << 63), 0, None, 5, 5, -1]
    rows = [(draw.choice(extremes), draw.randint(-3000, 3000), i) for i in range(2000)] + [(7, None, -1)]
    df = staged(spark.createDataFrame(rows, "a bigint, b bigint, c bigint").repartition(5), "rows")
    order = lambda r: ((r["a"] is not None, r["a"] or 0), (r["b"] is not None, r["b"] or 0), r["c"])
    found = sorted(radix_placed(df, ["a", "b", "c"]).collect(), key=lambda r: r["place"])
    assert [r["place"] for r in found] == list(range(len(rows)))
    assert [(r["a"], r["b"], r["c"]) for r in found] == [(r["a"], r["b"], r["c"]) for r in sorted(found, key=order)]
    # One value in all rows, one row, no row.
    one = staged(spark.range(50).select(F.lit(3).cast("bigint").alias("a")), "rows")
    assert {r["place"] for r in radix_placed(one, ["a"]).collect()} == set(range(50))
    assert radix_placed(one.limit(0), ["a"]).count() == 0
    values = np.array([3, 1, 3, 3, 1], np.uint16)
    assert counting_sort(values).tolist() == [0, 0, 1, 2, 1]


def test_radix_blocks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(radix, "BLOCK_BITS", 6)
    df = staged(spark.range(5000).select((F.col("id") * 7919 % 5000).alias("a")), "rows")
    assert all(r["a"] == r["place"] for r in radix_placed(df, ["a"]).collect())


def plain_resample(docs, target, percent=10, least=20, longest=1, buckets=10_000, seed=2024):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(low))
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        n, found = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    rank = [(*r[:4], k + 1 if k < len(able) * percent // 100 else None) for k, r in enumerate(able)]
    return Counter(rank + [(*r[:4], None) for r in rows if r[4] < least])


@pytest.mark.parametrize("longest, percent", [(1, 10), (3, 50)])
def test_resampling_against_a_plain_version(spark, longest, percent):
    texts = ODD + [prose(i, 5 + i) for i in range(60)] + ["Ünï CODÉ-x1\x00b\x7f漢字 " * 9] * 3
    ids = [None, *range(1, len(texts) - 1), 1]
    target = ["alpha beta", None, "", prose(9, 50)]
    bench = spark.createDataFrame([(t, "z") for t in target], "text string, rank string")
    found = resample(documents(spark, texts, ids=ids).repartition(4), bench, percent=percent, longest=longest)
    rows = Counter(tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect())
    assert rows == plain_resample(list(zip(ids, texts)), target, percent, longest=longest)


def test_resampling_of_nothing(spark, odd, none):
    bench = spark.createDataFrame([], "text string")
    assert resample(none, bench).count() == 0
    assert {r["weight"] for r in resample(odd, bench).collect()} >= {0}
    drawn = resampled(odd, bench, percent=60)
    assert drawn.columns == odd.columns and drawn.count() == 2
    with pytest.raises(ValueError):
        resample(odd, bench, buckets=1 << 17)


# --- copies that make up a large share of all rows


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_frequent_keys_are_joined_like_all_others(spark, conf, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    draw = random.Random(8)
    keys = [1] * 3000 + [2] * 900 + [draw.randint(10, 2500) for _ in range(3000)]
    rows = spark.createDataFrame([(i, k, -k) for i, k in enumerate(keys)], "own_id bigint, h1 bigint, h2 bigint").repartition(5)
    counts = Counter(keys)
    listed = [(k, -k, k * 10, k % 2 == 0, n) for k, n in counts.items() if n > 1]
    found = spark.createDataFrame(listed, "h1 bigint, h2 bigint, first_id bigint, first boolean, docs bigint")
    left = dart_minhash._left_by_text(rows, found, len(keys)).select("own_id", "h1", "h2", "first_id", "first").collect()
    plain = rows.join(found, ["h1", "h2"], "left").select("own_id", "h1", "h2", "first_id", "first").collect()
    assert sorted(map(str, left)) == sorted(map(str, plain))
    inner = dart_minhash._joined(rows, found, ["h1", "h2"], "docs", len(keys))
    assert sorted(map(str, inner.select("own_id", "first_id").collect())) == sorted(map(str, rows.join(found, ["h1", "h2"]).select("own_id", "first_id").collect()))
    assert found.filter(dart_minhash._often(found, "docs", len(keys))).count() <= dart_minhash.SHARE


def test_a_text_with_most_of_all_copies(spark, conf):
    """Its copies stay where they are: no task of a shuffle gets them."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    hot, other = prose(1, 40), [prose(i, 40) for i in range(2, 60)]
    texts = [hot] * 5000 + other + [hot + " end"] * 3
    docs = documents(spark, texts).select("doc_id", "text").repartition(4)
    classes = {r["doc_id"]: (r["class_id"], r["class_docs"]) for r in dart_minhash.duplicate_classes(docs).collect()}
    assert len(classes) == len(texts) and all(classes[i] == (0, 5003) for i in [*range(5000), *range(5058, 5061)])
    assert all(classes[5000 + i] == (5000 + i, 1) for i in range(58))
    kept = dart_minhash.without_near_copies(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, *range(5000, 5058)]
