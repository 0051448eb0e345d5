"""Alignment of two tokenizers against a plain per-token run."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from abx.llm import align as AL
from abx.llm.bpe import ByteBpe, token_bytes
from abx.llm.queries import tokenizer_path

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    "The quick brown fox, it's 12345 jumping!",
    "",
    None,
    " leading  and   many spaces \n\n\ttabs\r\n",
    "Größe, naïve café — 東京 العربية 🙂🙂 ́",
    "<|endoftext|> and <s> </s> <unk> <0x41> as text",
    "a",
    "▁ lower block",
    "nul \x00 byte and ﻿ mark, ﬁ ligature, １２",
    "The quick brown fox, it's 12345 jumping!",
    "x" * 3000 + " " * 1200 + "word " * 900,
]


def _plain(texts):
    """Tokens by the libraries' own calls; groups and links by loops."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    a_bytes = token_bytes(A)

    def b_bytes(i):
        piece = sp.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()

    docs, total = [], Counter()
    for text in texts:
        a, b = [], []
        if text:
            a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            want = (" " + text).encode()
            if b"".join(a_bytes[i] for i in a) != want or b"".join(map(b_bytes, b)) != want:
                a, b = [], []
        ranges, cuts = [], []
        for ids, size in ((a, lambda i: len(a_bytes[i])), (b, lambda i: len(b_bytes(i)))):
            at, out = 0, []
            for i in ids:
                out.append((i, at, at + size(i)))
                at += size(i)
            ranges.append(out)
            cuts.append({end for _, _, end in out})
        links = [
            (x, y) for x, xs, xe in ranges[0] for y, ys, ye in _near(ranges[1], xs, xe) if max(xs, ys) < min(xe, ye)
        ]
        total.update(links)
        groups, start = [], 0
        ia = ib = 0
        for cut in sorted(cuts[0] & cuts[1]):
            ga, gb = [], []
            while ia < len(a) and ranges[0][ia][2] <= cut:
                ga.append(ranges[0][ia][0])
                ia += 1
            while ib < len(b) and ranges[1][ib][2] <= cut:
                gb.append(ranges[1][ib][0])
                ib += 1
            groups.append((ga, gb))
        docs.append((a, b, groups, links))
    top = Counter()
    for (_, y), n in total.items():
        top[y] = max(top[y], n)
    out = []
    for a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (len(a), len(b), len(groups), len(links), sum(total[p] == top[p[1]] for p in links), sum(total[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if a else "")
        )
    return out


def _near(ranges, start, end):
    lo = 0
    for r in ranges[lo:]:
        if r[1] >= end:
            break
        if r[2] > start:
            yield r


COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("max_pairs", [AL.MAX_PAIRS, 7])
def test_against_loops(spark, max_pairs):
    texts = [t if t is None or len(t) < 3000 else t[2800:3300] for t in TEXTS]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    got = AL.align(df, A, B, max_pairs=max_pairs).orderBy("doc_id").select(*COLS).collect()
    assert [tuple(r) for r in got] == _plain(texts)


def test_given_documents_against_loops(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r.text or "") < 1200]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for max_pairs in (AL.MAX_PAIRS, 50):
        got = {r.doc_id: tuple(r)[1:] for r in AL.align(df, A, B, max_pairs=max_pairs).select("doc_id", *COLS).collect()}
        assert got == {r.doc_id: w for r, w in zip(rows, _plain([r.text for r in rows]), strict=True)}


def test_repeated_pairs_over_partitions(spark):
    rows = [(i, f"word{i % 7} other{i % 5} thing") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = sorted(map(tuple, AL.align(df, A, B).collect()))
    assert whole == sorted((i, *p) for (i, _), p in zip(rows, _plain([t for _, t in rows]), strict=True))


def test_merged_sums():
    keys, sums = AL._merge([np.array([5, 7]), np.array([7, 9])], [np.array([1, 2]), np.array([3, 4])])
    assert keys.tolist() == [5, 7, 9] and sums.tolist() == [1, 5, 4]


def test_defined_cases(spark):
    df = spark.createDataFrame([(None, "some text"), (1, None), (1, "")], "doc_id bigint, text string")
    for c in ("key", "id", "a", "b", "pair", "n", "times", "groups"):
        df = df.selectExpr("*", f"'x' AS {c}")
    got = {(r.doc_id, r.n_a, r.groups_sha256 == "", r.groups) for r in AL.align(df, A, B, with_groups=True).collect()}
    assert {(i, n > 0, empty) for i, n, empty, _ in got} == {(None, True, False), (1, False, True)}
    assert AL.align(df.limit(0), A, B).collect() == []


def test_fast_ids_equal_the_library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    fast = ByteBpe(A, plain_special=True)
    assert fast.fast is not None
    points = [c for c in range(0x32000) if not 0xD800 <= c < 0xE000]  # all planes with letters
    texts = ["".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2 .{chr(c)}. " for c in points[i : i + 512]) for i in range(0, len(points), 512)]
    texts += [t for t in TEXTS if t]
    want = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert [fast.ids(t).tolist() for t in texts] == want


def test_added_tokens_as_the_library_takes_them():
    from tokenizers import Tokenizer

    tok, fast = Tokenizer.from_file(A), ByteBpe(A, plain_special=False)
    for t in ("<|endoftext|>", "a <|endoftext|>b<|endoftext|>", "<|endoftext|", " <|endoftext|> " * 3):
        assert fast.ids(t).tolist() == tok.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 400_000, " " * 400_000, "\n" * 400_000 + "x", "1" * 200_000, "ab " * 100_000, "é" * 100_000, "?" * 100_000])
def test_very_long_runs(text):
    fast = ByteBpe(A, plain_special=True)
    sizes = np.array([len(x) for x in token_bytes(A)])
    assert sizes[fast.ids(text)].sum() == len(text.encode())
