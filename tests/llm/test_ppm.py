from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.llm import ppm as M

DOCS = "/root/testdata/sf0.001/documents.parquet"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


class Plain:
    """The model byte by byte, with dictionaries and explicit exclusion sets."""

    def __init__(self, texts, order, nodes):
        self.order = order
        self.total = defaultdict(Counter)
        n = 0
        for t in texts:
            data = [255] * order + list(t.translate(LOW).encode()) + [255]
            for i in range(order, len(data)):
                n += 1
                for j in range(order + 1):
                    self.total[tuple(data[i - j : i])][data[i]] += 1
        least = max(1, -(-n // nodes))
        self.kept = {c: {s: k for s, k in f.items() if k >= least} for c, f in self.total.items()}

    def log10(self, context, symbol):
        out, excluded = 0.0, set()
        for j in range(self.order, -1, -1):
            c = tuple(context[len(context) - j :])
            own = self.kept.get(c)
            if not own:
                continue
            dropped = sum(self.total[c].values()) - sum(own.values())
            left = {s: k for s, k in own.items() if s not in excluded}
            escapes = 0.5 * len(left) + dropped
            whole = sum(left.values()) + dropped
            if symbol in left:
                return out + math.log10((left[symbol] - 0.5) / whole)
            if whole:
                out += math.log10(escapes / whole)
            excluded |= own.keys()
        return out - math.log10(256 - len(excluded))

    def score(self, text):
        data = [255] * self.order + list((text or "").translate(LOW).encode()) + [255]
        return sum(self.log10(data[i - self.order : i], data[i]) for i in range(self.order, len(data)))


@pytest.mark.parametrize("nodes", [1 << 20, 400])
@pytest.mark.parametrize("order", [0, 2, 5])
def test_scores_against_plain_model(spark, order, nodes):
    rows = spark.read.parquet(DOCS).select("doc_id", "text").limit(40).collect()
    rows = [(r.doc_id, r.text[:600]) for r in rows] + [(None, None), (900, ""), (901, "ZZ \x00 qq ü 🙂"), (901, "ZZ \x00 qq ü 🙂")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    train = [t or "" for d, t in rows if not held(d)]
    plain = Plain(train, order, nodes)
    got = M.score(df, order=order, nodes=nodes).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for d, t in rows:
        assert by[d].score == pytest.approx(plain.score(t), abs=1e-6)


def test_predictions_sum_to_one():
    texts = [b"abracadabra abc", b"abba", b"the cat and the hat"]
    keys, _ = M.grams(texts, 3)
    for least in (1, 2):
        nodes, contexts = [], []
        for j in range(4):
            k, n = np.unique(keys & M._mask(j + 1), return_counts=True)
            nodes.append((k[n >= least], n[n >= least]))
            contexts.append(np.unique((keys & M._mask(j + 1)) >> np.uint64(8), return_counts=True))
        trie = M.build_trie(3, nodes, contexts)
        for context in (b"abr", b"\xff\xff\xff", b"zzz", b"xab", b" th"):
            base = np.uint64(int.from_bytes(context, "big") << 8)
            p = 10 ** M.score_keys(trie, base | np.arange(256, dtype=np.uint64))
            assert p.sum() == pytest.approx(1)


@pytest.mark.parametrize("words", [1 << 18, 30])
def test_base_score_against_brute_force(spark, words):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(DOCS).select("doc_id", "text").collect()]
    rows += [(None, None), (5001, ""), (5002, "x" * 300 + " y"), (5002, "x" * 300 + " y")]
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [""]
    train = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = train.total(), len(train)
    got = M.score(spark.createDataFrame(rows, "doc_id long, text string"), order=1, words=words).collect()
    by = {r.doc_id: r for r in got}
    for d, t in rows:
        ts = tokens(t)
        want = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ts)
        r = by[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(d), len(ts), sum(train[w] > 0 for w in ts), n)
        assert r.base_score == pytest.approx(want)


def test_model_beats_words_on_held_out_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    r = M.score(df).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.avg("bits_per_byte")).first()
    assert r[0] > r[1] and r[2] < 2.5


def test_edge_rows(spark):
    df = spark.createDataFrame([(2, "a " * 50_000, "x", 1), (3, None, "y", 2)], "doc_id long, text string, word string, n long")
    assert {r.doc_id: r.n_tokens for r in M.score(df).collect()} == {2: 50_001, 3: 1}
    assert M.score(df.filter(F.lit(False))).count() == 0
    only = next(i for i in range(100) if held(i))
    alone = M.score(spark.createDataFrame([(only, "ab")], "doc_id long, text string")).first()
    assert alone.train_tokens == 0 and alone.n_known == 0 and alone.score == pytest.approx(-3 * math.log10(256))


@pytest.mark.parametrize("shared", [M.SHARED, 3000, 0])
def test_rare_grams_of_a_large_corpus_are_kept(spark, shared):
    # Over 2^21 positions of training, with a passage that occurs once: a rising cut forgot it.
    ids = [i for i in range(99) if not held(i)][:6]
    out = next(i for i in range(99) if held(i))
    rare = "Quagmire \x00\x00\x00\x00\x00\x00\x00 zephyr, once."
    rows = [(i, "the cat sat on the mat. " * 30_000) for i in ids[:5]] + [(ids[5], rare), (None, rare[:9]), (out, rare + " The mat~ \U0001f642"), (out, "zephyr zephyr")]
    keys, _ = M.grams([(t or "").encode() for d, t in rows if not held(d)], M.ORDER)
    nodes, contexts = [], []
    for j in range(M.ORDER + 1):
        nodes.append(np.unique(keys & M._mask(j + 1), return_counts=True))
        contexts.append(np.unique((keys & M._mask(j + 1)) >> np.uint64(8), return_counts=True))
    want = M.score_texts(M.build_trie(M.ORDER, nodes, contexts), [t.encode() for _, t in rows])
    assert len(keys) > M.SHARED
    got = M.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shared=shared).collect()
    assert sorted(r.score for r in got) == pytest.approx(sorted(want))


@pytest.mark.parametrize("shared", [500, 0])
def test_joined_grams_score_like_shared_ones(spark, shared):
    df = spark.read.parquet(DOCS).select("doc_id", "text")
    df = df.unionByName(df.limit(30)).unionByName(spark.createDataFrame([(None, None), (None, "ab"), (7, "")], df.schema))
    got, want = (sorted((r.doc_id or -1, r.n_tokens, round(r.score, 6)) for r in M.score(df, shared=x).collect()) for x in (shared, M.SHARED))
    assert got == want
