import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
# Clashing names of the operators' own columns.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, kept boolean, ids binary, score string, text_a int"


def prose(seed, n, words=WORDS):
    draw = random.Random(seed)
    return " ".join(draw.choices(words, k=n))


def documents(spark, texts, langs=None, sources=None, ids=None):
    rows = []
    for i, text in enumerate(texts):
        doc_id = i if ids is None else ids[i]
        lang = langs[i] if langs else "en"
        source = sources[i] if sources else f"s{i % 3}"
        rows.append((doc_id, text, lang, source, len(text or ""), "r", True, None, "x", 1))
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", "   \n\t ", "word", "Ünïcödé 漢字 😀 ▁ <|endoftext|> é", prose(1, 20_000), prose(2, 300), prose(2, 300), "a " * 200]


@pytest.fixture
def odd(spark):
    """Null, empty, blank, short, odd, very long, repeated and repeating texts."""
    return documents(spark, ODD)


@pytest.fixture
def none(spark):
    return documents(spark, [])


@pytest.fixture(autouse=True)
def shared(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
