from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.llm import knn_quality as Q

D = "/root/testdata/sf0.01"


def test_vote_against_plain_sort():
    rng = np.random.default_rng(0)
    known = rng.normal(size=(200, 8)).astype(np.float32)
    known /= np.linalg.norm(known, axis=1, keepdims=True)
    x = np.concatenate([known[:20] + 0.1, np.zeros((1, 8))]).astype(np.float32)
    labels = rng.integers(0, 2, 200).astype(float)
    got = Q.vote(x, known, labels, 5)
    for i in range(20):
        s = known @ x[i]
        near = np.argsort(-s)[:5]
        w = np.maximum(s[near], 0)
        assert got[i] == pytest.approx((w * labels[near]).sum() / w.sum(), rel=1e-5)
    assert got[20] == labels.mean()
    assert Q.vote(x, known[:0], labels[:0]).tolist() == [0.5] * 21


def dense(texts):
    """Term weights by plain counting."""
    out = np.zeros((len(texts), Q.TERMS))
    out[:, : Q.FORMS] = Q.forms(texts)
    for row, t in zip(out, texts, strict=True):
        words = [p for w in t.lower().split() for p in ([w] if len(w) <= 24 else [w[i : i + 6] for i in range(0, len(w) - 5, 3)])]
        for slot, n in Counter(zlib.crc32(w) % Q.WORD_SLOTS for w in words).items():
            row[Q.FORMS + slot] = min(round(float(np.log1p(1000 * n / len(words)) * 16)), 255)
    return out / 16


def test_sums_cover_all_rows(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").filter("doc_id IS NOT NULL")
    features = Q._features(docs, "doc_id", "text").repartition(5).cache()
    x = dense([(r.text or "").encode() for r in docs.select("text").collect()])
    got = Q._summed(features, lambda x: np.stack([(x > 0).sum(0), x.sum(0)], axis=1), 2)
    assert got[:, 0].tolist() == (x > 0).sum(0).tolist()
    assert got[:, 1] == pytest.approx(x.sum(0), rel=1e-4, abs=1e-4)


def test_randomized_space_is_close_to_the_exact_one(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    features = Q._features(docs, "doc_id", "text").cache()
    x = dense([(r.text or "").encode() for r in docs.collect()])
    idf = np.log((len(x) + 1) / ((x > 0).sum(0) + 1)) + 1
    weighed = x * idf
    _, exact, _ = np.linalg.svd(weighed, full_matrices=False)
    space = Q.latent_space(features, len(x))
    held = np.linalg.norm(weighed @ (space / idf[:, None].astype(np.float32))) ** 2
    assert held > 0.98 * (exact[: Q.RANK] ** 2).sum()


def test_scores_against_brute_force(spark):
    """Every step on whole arrays: weights, the same iterations, all cosines sorted."""
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").orderBy("doc_id").collect()
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    x = dense([(r.text or "").encode() for r in docs])
    idf = np.log((len(x) + 1) / ((x > 0).sum(0) + 1)) + 1
    c = (x * idf).T @ (x * idf)
    basis = Q.start(Q.SKETCH)
    for _ in range(Q.PASSES - 1):
        basis = np.linalg.qr(c @ basis)[0]
    inner = basis.T @ c @ basis
    y = (x * idf) @ basis @ np.linalg.eigh(inner)[1][:, ::-1][:, : Q.RANK]
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    held = [zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in docs]
    known = [i for i, r in enumerate(docs) if not held[i] and quality.get(r.doc_id) in (0, 1)]
    marks = np.asarray([quality[docs[i].doc_id] for i in known], float)
    got = {r.doc_id: r for r in Q.classify(spark.createDataFrame(docs).repartition(4), spark.read.parquet(f"{d}/labels.parquet")).collect()}
    for i, r in enumerate(docs):
        s = y[known] @ y[i]
        near = np.argsort(-s, kind="stable")[: Q.K]
        w = np.maximum(s[near], 0)
        # Copies of a labelled text at the last place may change places.
        edge = np.isclose(s, s[near[-1]], atol=1e-5)
        if edge.sum() == 1:
            assert got[r.doc_id].score == pytest.approx((w * marks[near]).sum() / w.sum(), abs=1e-3)
    assert len(got) == len(docs)


def test_labels_by_vocabulary_alone(spark):
    """Words of all kinds have the same lengths, letters and layout; only which words occur tells the label."""
    rng = np.random.default_rng(3)
    words = list(dict.fromkeys("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(1300)))
    common, good, bad = words[:600], words[600:900], words[900:1200]
    rows, marks = [], []
    for i in range(1500):
        label = int(rng.integers(0, 2))
        n = int(rng.integers(60, 200))
        text = [str(rng.choice((good if label else bad) if rng.random() < 0.3 else common)) for _ in range(n)]
        rows.append((i, " ".join(text)))
        marks.append((i, label))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int")
    held = [r for r in Q.classify(docs, labels).join(labels, "doc_id").collect() if r.held_out]
    one, zero = (np.asarray([r.score for r in held if r.quality == q]) for q in (1, 0))
    assert ((one[:, None] > zero[None]) + 0.5 * (one[:, None] == zero[None])).mean() > 0.9


def test_words_without_spaces_have_pieces():
    a, b = "今天天气很好我们去公园散步".encode(), "机器学习模型需要大量数据训练".encode()
    assert [len(x) for x in Q._parts(a)[:2]] == [6, 6] and Q._parts(b"Ab cD") == [b"ab", b"cd"]
    wa, wb, wc = Q.word_weights([a, b, a])
    assert wa == wc != wb and Q.word_weights([b""]) == [b""]


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")
    got = Q.classify(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    auc = np.mean([[1.0 if g > b else 0.5 if g == b else 0.0 for b in bad] for g in good])
    assert auc > 0.95 and np.mean([r.predicted == r.quality for r in held]) > 0.93


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = Q.id_mod(F.col("doc_id"), 3) == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda r: r.doc_id
    assert sorted(Q.classify(docs, labels).collect(), key=key) == sorted(Q.classify(docs, turned).collect(), key=key)


def test_edge_rows(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (2, ""), (3, "word " * 60_000), (4, "é 🙂 #%"), (5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("label", F.lit(0))
    labels = spark.createDataFrame([(3, 1), (3, 1), (4, 0), (5, None), (None, 1), (77, 1)], "doc_id long, quality int")
    got = Q.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert {r.score for r in Q.classify(docs, labels.filter(F.lit(False))).collect()} == {0.5}
    assert Q.classify(docs.filter(F.lit(False)), labels).count() == 0
