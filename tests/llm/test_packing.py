from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from abx.llm.bpe import ByteBpe
from abx.llm.packing import pack, piece_lengths

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


ODD = [
    "", " ", "a", " a  b\n\nc ", "it's\tI'll  don't", "x y  z", "é à ü ñ", "你好 世界 !?",
    "<|endoftext|> end", "a\x1cb \x1fc", "12 345  6,7", "🙂 🙂🙂", "á b́", "\n\n\n", "w" * 5000, "a " * 3000,
    "don't, we'll 's'tis '", "a,b.c;d! e?f", "x1y2 3z", "\nA\n B\n\nC", "é,ü.ñ'll×÷ ×a", "end\n", "(a) [b] \"c\"",
]


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_plain_encoding(plain, text):
    assert ByteBpe(PATH, plain_special=False).ids(text).tolist() == plain(text)


def test_ids_of_documents_equal_plain_encoding(spark, plain):
    enc = ByteBpe(PATH, plain_special=False)
    for (t,) in spark.read.parquet(DOCS).select("text").collect():
        assert enc.ids(t).tolist() == plain(t)


def test_piece_lengths():
    for n in [1, 2, 3, 1023, 1024, 1025, 5000]:
        got = piece_lengths(n)
        assert sum(got) == n and got == sorted(got, reverse=True)
        assert all(x & (x - 1) == 0 and x <= 1024 for x in got)
        assert len([x for x in got if x < 1024]) == bin(n % 1024).count("1")


def test_round_trip(spark, plain):
    docs = spark.read.parquet(DOCS)
    got = pack(docs, PATH).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    by: dict = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert len(r.ids) == r.length == 1 << r.bucket and r.offset == 0
        assert zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert len({r.sequence_id for r in got}) == len(got)
    assert by.keys() == texts.keys()
    for d, rows in by.items():
        rows.sort(key=lambda r: r.start)
        ids = [i for r in rows for i in r.ids]
        assert ids == plain(texts[d]) + [0]
        assert all(r.doc_tokens == len(ids) for r in rows)
        assert [r.start for r in rows] == list(np.cumsum([0] + [r.length for r in rows])[:-1])


def test_edge_rows(spark):
    rows = [(1, None, 5, "x"), (None, "a b", 6, "y"), (2, "", 7, None), (2, "", 7, None), (3, "a " * 20000, 1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length long, bucket string")
    got = pack(df, PATH).collect()
    assert sorted(r.length for r in got if r.doc_id in (1, 2)) == [1, 1, 1]
    assert sum(r.length for r in got if r.doc_id is None) == 3
    total = {r.doc_tokens for r in got if r.doc_id == 3}
    assert len(total) == 1 and sum(r.length for r in got if r.doc_id == 3) == total.pop()
    assert pack(df.filter(F.lit(False)), PATH).count() == 0
    with pytest.raises(ValueError):
        pack(df, PATH, max_len=1000)


def test_added_token_in_a_text_is_one_id(spark, plain):
    text = "a <|endoftext|> b<|endoftext|>"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ids = [i for r in sorted(pack(df, PATH).collect(), key=lambda r: r.start) for i in r.ids]
    assert ids == plain(text) + [0] and ids.count(50256) == 2
