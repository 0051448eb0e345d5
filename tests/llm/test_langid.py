from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.llm import langid as L

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.read.parquet(f"{D}/documents.parquet"))


def test_fit_against_plain_counts(spark, model):
    rows = spark.read.parquet(f"{D}/documents.parquet").select("lang", "text").collect()
    assert model.languages == ["de", "en", "es", "fr", "und"]
    total = defaultdict(lambda: np.zeros(L.SIZE))
    for r in rows:
        total[r.lang] += L.trigrams([r.text.encode()])[0]
    for i, x in enumerate(model.languages[:-1]):
        want = np.log((total[x] + 0.5) / (total[x].sum() + 0.5 * L.SIZE))
        assert model.logp[i] == pytest.approx(want)
    assert np.exp(model.logp).sum(1) == pytest.approx(np.ones(5))


def softmax(x):
    e = np.exp(x - x.max())
    return e / e.sum()


def brute(rows, model):
    """Evidence row by row: (id, url, html) to posterior arrays."""
    n = len(model.languages)
    ll, said, lv = {}, {}, {}
    for i, url, page in rows:
        ll[i] = model.log_likelihoods([L.visible_text((page or "").encode())])[0]
        m = re.search(r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?\s*([A-Za-z]+)", page or "")
        said[i] = m.group(1).lower() if m and m.group(1).lower() in model.languages[:-1] else ""
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
        host = None if url is None else m.group(1).lower() if m else ""
        cut = lambda h, k: None if h is None else ".".join(h.split(".")[-k:])
        lv[i] = (0, (0, cut(host, 1)), (0, cut(host, 1), cut(host, 2)), (0, cut(host, 1), cut(host, 2), host))
    text = {i: softmax(x) for i, x in ll.items()}
    sums, seen = defaultdict(lambda: np.zeros(n)), np.zeros((n, n))
    for i in text:
        for k in lv[i]:
            sums[k] += text[i]
        if said[i]:
            seen[model.languages.index(said[i])] += text[i]
    share = np.full((n, n), 0.2 / (n - 2))
    np.fill_diagonal(share, 0.8)
    share[:, -1] = 1 / (n - 1)
    p = (seen + L.SMOOTH_DECLARED * share) / (seen[:-1].sum(0) + L.SMOOTH_DECLARED)
    out = {}
    for i in text:
        prior = np.asarray([0.99 / (n - 1)] * (n - 1) + [0.01])
        for k in lv[i]:
            c = np.maximum(sums[k] - text[i], 0)
            prior = (c + L.SMOOTH_LEVEL * prior) / (c.sum() + L.SMOOTH_LEVEL)
        logs = ll[i] + np.log(prior) + (np.log(p[model.languages.index(said[i])]) if said[i] else 0)
        out[i] = softmax(logs)
    return out


def test_pages_against_brute_force(spark, model):
    rows = [tuple(r) for r in spark.read.parquet(f"{D}/pages.parquet").select("page_id", "url", "html").limit(120).collect()]
    rows += [(9001, None, None), (9002, "", ""), (9003, "http://u@A.B.example.com:80/x", "<html LANG=de-AT><p>zzz &amp; qq"), (9004, "nonsense", "<script>no</script>")]
    want = brute(rows, model)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lang", F.lit("x")).repartition(3)
    got = L.identify_pages(df, model).collect()
    assert len(got) == len(rows)
    for r in got:
        p = want[r.page_id]
        best = model.languages[int(p.argmax())]
        assert r.posterior == pytest.approx(p.max(), rel=1e-6)
        assert r.lang == (None if best == "und" or p.max() < 0.5 else best)


def test_accuracy_on_pages(spark, model):
    """Pages of this data name their language in the address path, which the operator does not read."""
    pages = spark.read.parquet(f"{D}/pages.parquet")
    truth = pages.select("page_id", F.regexp_extract("url", "//[^/]+/([a-z]{2})/", 1).alias("truth"))
    r = L.identify_pages(pages, model).join(truth, "page_id").agg(F.avg((F.col("lang") == F.col("truth")).cast("double")), F.avg((F.col("text_lang") == F.col("truth")).cast("double"))).first()
    assert r[0] > 0.97 and r[1] > 0.95


def test_clean_documents_stay_and_noise_goes(spark, model):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    noise = docs.limit(20).select(
        (F.col("doc_id") + 10**6).alias("doc_id"),
        F.expr("concat_ws(' ', transform(sequence(1, 60), i -> substr(sha2(cast(doc_id * 100 + i as string), 256), 1, 20)))").alias("text"),
        F.lit(None).cast("string").alias("lang"), F.lit("noise").alias("source"), "n_chars",
    )
    kept = L.keep_known(docs.unionByName(noise), model)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sum(i < 10**6 for i in ids) == docs.count() and sum(i >= 10**6 for i in ids) == 0


def test_edge_rows(spark, model):
    rows = [(1, None, None, None), (2, "", "en", "a"), (2, "", "en", "a"), (3, "the of and " * 40_000, "xx", None), (None, "der die und", "DE ", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("host", F.lit(1))
    assert L.keep_known(df, model).count() >= 4
    assert L.keep_known(df.filter(F.lit(False)), model).count() == 0
    nothing = L.fit(df.filter(F.lit(False)))
    assert nothing.languages == ["und"] and L.keep_known(df, nothing).count() == 0
    assert L.identify(df, model, F.col("text")).count() == len(rows)
    assert L.identify_pages(spark.createDataFrame([], "page_id long, url string, html string"), model).count() == 0


def test_rare_and_many_languages_stay(spark, monkeypatch):
    """A hot language and 70 rare ones, each with under 1/64 of the rows; tasks hold few languages at once."""
    monkeypatch.setattr(L, "HELD", 9)
    rng = np.random.default_rng(3)
    rows = []
    for n in range(71):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(25)]
        for _ in range(400 if n == 0 else 4):
            rows.append((len(rows), " ".join(rng.choice(words, 40)), f"l{n:02d}", f"s{n % 3}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    model = L.fit(df)
    assert model.languages == [*(f"l{n:02d}" for n in range(71)), "und"]
    total = sum(L.trigrams([t.encode()])[0] for _, t, x, _ in rows if x == "l05")
    assert model.logp[5] == pytest.approx(np.log((total + 0.5) / (total.sum() + 0.5 * L.SIZE)))
    assert L.keep_known(df, model).count() == len(rows)
    got = L.identify(df, model, F.col("text"), F.col("lang"), [("host", F.col("source"))])
    assert got.filter(F.col("lang") == F.col("__llm_lang")).count() == len(rows)
