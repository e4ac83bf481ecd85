"""The pipeline against a plain version of each stage on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_texts import documents, none, odd, prose, shared  # noqa: F401
from test_models import brute_classes
from geolayers.llm.host_rules import text_features

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(spark):
    german = "der die das und nicht ist ein eine mit auf für sich dem den von zu".split()
    texts, langs = [], []
    for i in range(40):
        texts.append(prose(i, 120) if i % 2 else prose(i, 120, german))
        langs.append("en" if i % 2 else "de")
    texts += [texts[1], texts[2] + " more", "short", None, "", "a b c " * 60, "12 34 " * 20]
    langs += ["en", "de", "en", None, "fr", "en", "en"]
    return documents(spark, texts, langs), texts


def test_stages(spark):
    docs, texts = corpus(spark)
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "near-dedup", "packing"]
    good = stages["quality rules"](spark, docs, "")
    assert good.columns == docs.columns
    want = set()
    for i, t in enumerate(texts):
        n, _, _, _, repeated = text_features(t.encode() if t else None)
        if n >= 50 and 2 * repeated <= n:
            want.add(i)
    assert {r["doc_id"] for r in good.collect()} == want
    clear = stages["language ID"](spark, good, "")
    assert clear.columns == docs.columns and {r["doc_id"] for r in clear.collect()} == want
    single = stages["near-dedup"](spark, clear, "")
    ids = sorted(want)
    classes = brute_classes([texts[i] for i in ids])
    assert {r["doc_id"] for r in single.collect()} == {ids[c] for c in classes}
    packed = stages["packing"](spark, single, "")
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {ids[c] for c in classes}


def test_run(spark, tmp_path):
    docs, _ = corpus(spark)
    docs.select(COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.filter(F.length("ids") != 4 * F.col("length")).count() == 0 and out.count() > 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_odd_and_empty_tables(spark, odd, none, stage):
    assert stage(spark, odd, "").columns == odd.columns
    assert stage(spark, none, "").count() == 0
