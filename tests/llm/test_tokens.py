"""Token files and packing against the tokenizer on whole texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_texts import ODD, documents, none, odd, prose, shared  # noqa: F401
from geolayers.llm.packing import decomposed, pack_documents
from geolayers.llm.queries import QUERIES
from geolayers.llm.token_files import read_token_files, write_token_files
from geolayers.llm.word_ids import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def expected(text):
    return np.array(PLAIN.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def test_words_alone_give_the_ids_of_the_text():
    draw = random.Random(3)
    letters = list("abzZéÉßÄñçÇİıŉſŁĲ.,;:!?'st12 \t\n\x0b\x1c\x85 k-–|<>ς漢가ㄱfiﬁ") + ["<|endoftext|>", "<|ENDOFTEXT|>", "don't", "ǅ", "ä"]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(4000)] + ODD
    marks = [chr(c) for c in range(0x300, 0x370)]
    texts += [letter + mark for letter in "AHJTWYhjtwy" for mark in marks]
    texts += ["The W\u030a H\u0323\u0331ouse <|endoftext|> J\u030c.", "PLAIN W\u030aORDS, T\u0344."]
    for keep in (10, 100_000):
        encoder = WordEncoder(PATH, 2, keep)
        for _ in range(2):
            flat, sizes = encoder.encode(pa.array(texts))
            assert [p.tolist() for p in np.split(flat, np.cumsum(sizes)[:-1])] == [expected(t).tolist() for t in texts]
            assert len(encoder.words) <= max(keep, 0) + 0 or keep > 10


def test_token_files(spark, odd, none, tmp_path):
    write_token_files(odd.repartition(3), str(tmp_path / "t"), PATH, 2)
    rows = read_token_files(spark, str(tmp_path / "t")).orderBy("doc_id").collect()
    start = 0
    for i, (row, text) in enumerate(zip(rows, ODD, strict=True)):
        ids = expected(text)
        assert (row["doc_id"], row["start"], row["n_tokens"], bytes(row["ids"])) == (i, start, len(ids), ids.tobytes())
        start += len(ids)
    write_token_files(none, str(tmp_path / "n"), PATH, 2)
    assert read_token_files(spark, str(tmp_path / "n")).count() == 0


def test_null_and_repeated_ids(spark, tmp_path):
    docs = documents(spark, ["b", "a", "c", "c"], ids=[None, 5, 5, 5])
    write_token_files(docs, str(tmp_path / "t"), PATH, 2)
    rows = read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 5, 5, 5]
    assert [r["start"] for r in rows] == [0, 2, 4, 6]


def test_a_shard_cut_short_is_an_error(spark, odd, tmp_path):
    write_token_files(odd, str(tmp_path / "t"), PATH, 2)
    shard = max((tmp_path / "t").glob("*.bin"), key=lambda p: p.stat().st_size)
    shard.write_bytes(shard.read_bytes()[:-2])
    with pytest.raises(Exception, match="not complete"):
        read_token_files(spark, str(tmp_path / "t")).collect()


def test_decomposition():
    rows, lengths = decomposed(np.array([1, 4096, 4097, 13, 9000]), 4096)
    assert [lengths[rows == i].tolist() for i in range(5)] == [[1], [4096], [4096, 1], [8, 4, 1], [4096, 4096, 512, 256, 32, 8]]
    with pytest.raises(ValueError):
        pack_documents(None, PATH, 2, longest=1000)


def check_pieces(rows, texts):
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for i, text in enumerate(texts):
        ids, at = expected(text), 0
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] == 2 ** r["bucket"] <= 4096 and r["offset"] == 0
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_packing(odd, none):
    pieces = pack_documents(odd, PATH, 2).withColumn("ids_crc32", F.crc32("ids"))
    check_pieces(pieces.collect(), ODD)
    assert pack_documents(none, PATH, 2).count() == 0


def test_queries(spark, tmp_path):
    texts = [prose(i, 40 + 7 * i) for i in range(60)]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    check_pieces(QUERIES["op7_packing"](spark, str(tmp_path)).collect(), texts)
    rows, start = QUERIES["op2_token_files"](spark, str(tmp_path)).orderBy("doc_id").collect(), 0
    for row, text in zip(rows, texts, strict=True):
        ids = expected(text)
        assert row[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
