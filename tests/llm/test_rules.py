"""Host rules, URL rules, languages and the SQL of the queries that have it."""

import random

import pytest
import zstandard

import check
from llm_texts import ODD, documents, none, odd, prose, shared  # noqa: F401
from geolayers.llm.host_rules import beta_prior, judge_documents, kept_documents, repeated_words, text_features
from geolayers.llm.language_id import BLOCK, LEVEL, kept_languages, learn_dictionaries, predict_languages
from geolayers.llm.queries import ORACLES, QUERIES, URL_RULES
from geolayers.llm.url_trie import UrlTrie, judge_urls, rule

SOURCE = "/root/testdata/sf0.001"


class Entry:
    queries = staticmethod(lambda: QUERIES)
    oracle_sql = staticmethod(lambda: ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    result, _ = check.compare(spark, name, SOURCE, Entry, check.connect(SOURCE))
    assert result.startswith("ok"), result


def test_features():
    assert text_features(None) == text_features(b"") == (0, 0, 0, 0, 0)
    assert text_features("é ##\n\n \nx\nx".encode()) == (4, 5, 2, 1, 0)
    words = "a b c x a b c y z".split()
    assert repeated_words([w.encode() for w in words]) == 6
    draw = random.Random(1)
    for _ in range(200):
        words = [draw.choice("abc").encode() for _ in range(draw.randint(0, 30))]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        assert repeated_words(words) == len(covered)


def test_hosts_are_shrunk_and_joined_back(spark):
    good, bad = [prose(i, 80) for i in range(90)], ["too short"] * 60
    texts = good[:60] + bad[:58] + good[60:62] + ["too short"] + good[62:]
    sources = ["good"] * 60 + ["bad"] * 60 + ["single"] + [None] * 28
    rows = judge_documents(documents(spark, texts, sources=sources)).collect()
    kept = {s: sum(r["kept"] for r in rows if r["row"]["source"] == s) for s in ("good", "bad", "single", None)}
    assert kept == {"good": 60, "bad": 0, "single": 0, None: 28}
    assert all(r["host_failed"] == (r["row"]["source"] == "bad") for r in rows if r["row"]["source"] != "single")
    alpha, beta = beta_prior(3, 30, 300.0, 15, 7.5)
    assert alpha == pytest.approx(beta)
    assert beta_prior(2, 10, 50.0, 0, 0.0)[0] < 1e-5


def test_odd_documents_and_names(odd, none):
    rows = judge_documents(odd).collect()
    assert {r["row"]["doc_id"] for r in rows if not r["base_failed"]} == {6, 7}  # 5 repeats its windows
    assert kept_documents(odd).columns == odd.columns and kept_documents(odd).count() <= 2
    assert kept_documents(none).count() == 0


def test_rules_on_urls(spark):
    urls = ["http://www.Example.com/en/1?x#y", "https://example.com/en/", "http://a.b.example.com/en/x", "http://example.com/en", "http://x.com",
            "http://x.com/", "ftp://q.net/es/1", "http://q.net/fr/", "http://net/es/x", "http://annet/es/x", "no scheme", None, "", "http://", "a://b://c/d",
            "http://www.example.com?q=/en/", "http://www.example.com/en/1"]
    rows = [(i, u, "x", "y") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    out = {r["page_id"]: r for r in judge_urls(df, URL_RULES).collect()}
    assert [out[i]["rule"] for i in range(len(urls))] == [
        "www.example.com/en/", "example.com/en/", "example.com/en/", "com/", None, "com/", "net/es/", "net/fr/", "net/es/", None, None, None, None,
        None, None, None, "www.example.com/en/"]
    assert [out[i]["verdict"] == "block" for i in (1, 2, 6, 7, 8)] == [True] * 5
    assert out[0]["host"] == "www.example.com" and out[0]["path"] == "/en/1" and (out[11]["host"], out[11]["path"]) == ("", "")
    assert (out[14]["host"], out[14]["path"]) == ("b:", "//c/d")
    assert judge_urls(df.limit(0), URL_RULES).count() == 0
    with pytest.raises(ValueError):
        judge_urls(df, URL_RULES, most_rules=2)


def test_trie_against_a_scan_of_all_rules():
    draw = random.Random(5)
    host = lambda: ".".join(draw.choices("ab", k=draw.randint(1, 3)))
    path = lambda: "".join(draw.choices(["/", "x", "y", "xy"], k=draw.randint(0, 4)))
    rules = [rule(draw.choice(["allow", "block"]), host() + draw.choice(["", "/" + path()])) for _ in range(120)]
    trie = UrlTrie(rules)
    for _ in range(3000):
        h, p = host(), "/" + path()
        fits = [r for r in rules if ("." + h).endswith("." + r.host) and p.startswith(r.path)]
        best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict), default=None)
        assert trie.find(h, p) == (best and (best.host + best.path, best.verdict))


LANGS = {"aa": "lorem ipsum dolor sit amet consectetur adipiscing elit".split(), "bb": "quick brown foxes jumped over those lazy dogs".split()}


def test_languages(spark, odd, none):
    texts = [prose(i, 60, LANGS[lang]) for i in range(40) for lang in LANGS]
    langs = ["aa", "bb"] * 40
    learned = documents(spark, texts, langs)
    dictionaries = learn_dictionaries(learned, slices=8, slice_chars=200)
    assert sorted(dictionaries) == ["aa", "bb"] and all(len(d) <= 8 * 201 for d in dictionaries.values())
    assert dictionaries == learn_dictionaries(learned.repartition(7), slices=8, slice_chars=200)
    rows = predict_languages(learned, dictionaries).collect()
    assert all(r["lang_pred"] == r["row"]["lang"] and 0 < r["score"] <= 1 for r in rows)
    text = texts[0]
    raw = text.lower().encode()

    def size(lang):
        d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False)
        return sum(len(c.compress(raw[k : k + BLOCK])) for k in range(0, len(raw), BLOCK))

    a, b = size("aa"), size("bb")
    assert rows[0]["score"] == pytest.approx((b - a) / b)
    found = {r["row"]["doc_id"]: r for r in predict_languages(odd, dictionaries).collect()}
    assert len(found) == len(ODD) and [found[i]["lang_pred"] for i in range(3)] == ["und"] * 3 and not found[0]["accepted"]
    assert found[4]["lang_pred"] in LANGS
    assert kept_languages(odd, dictionaries).columns == odd.columns
    assert predict_languages(none, dictionaries).count() == 0
    assert learn_dictionaries(none) == {}
    assert {r["lang_pred"] for r in predict_languages(odd, {}).collect()} == {"und"}


def test_languages_of_few_texts_copied_often_are_learned(spark):
    texts = {f"l{i}": prose(i, 40) for i in range(8)}
    rows = [(lang, text) for lang, text in texts.items() for _ in range(2000)] + [("many", prose(i, 40)) for i in range(100, 2000)]
    learned = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    found = learn_dictionaries(learned)
    assert sorted(found) == sorted([*texts, "many"])
    assert all(found[lang] == text.encode() for lang, text in texts.items()) and found["many"].count(b"\n") == 127


def test_held_out_accuracy(spark):
    rows = QUERIES["op9_language_id"](spark, "/root/testdata/sf0.01").filter("held_out").collect()
    langs = dict(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect())
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in rows) > 0.97 * len(rows)
