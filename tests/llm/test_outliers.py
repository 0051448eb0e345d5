from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.llm import outliers as O

DOCS = "/root/testdata/sf0.001/documents.parquet"


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_against_brute_force(spark):
    docs = spark.read.parquet(DOCS)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = O.judge(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[c] for c in BASE) == brute_counts(texts[r.doc_id])
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


@pytest.mark.parametrize("text", ["", "a", "a a a a", "a b c a b c", "a b\n\n a b\na b\n", "é é é\té é é", "<a> #b| %", "x\x0by\x0cz\rx y z", "w " * 4000, "\n" * 500])
def test_counts_of_odd_texts(text):
    got = O.text_counts([b"other words here", text.encode(), b"x y z x y z"])
    assert tuple(got[c][1] for c in BASE) == brute_counts(text)


def plain_mcd(x, floors, share=O.H_SHARE):
    """The same start and steps on one array, with exact order instead of bins."""
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    m, cov = q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2 + np.square(floors))
    h = int(np.ceil(share * len(x)))
    for _ in range(50):
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
        near = x[np.argsort(d)[:h]]
        m, cov = near.mean(0), np.cov(near.T, bias=True) + np.diag(np.square(floors))
    return m, cov


def test_estimate_resists_outliers(spark):
    rng = np.random.default_rng(4)
    parts = O.vector()
    floors = [f for _, f in parts.values()]
    p = len(parts)
    x = rng.normal(0, 1.5, (2000, p)) @ rng.normal(0, 0.5, (p, p)) + 3
    x[:400] += 40
    df = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>")
    level = F.struct(F.lit(2).alias("depth"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"))
    row = O.estimates(df.select(level.alias("level"), "x")).first()
    m, cov = plain_mcd(x, floors)
    inv = np.asarray(row.w).reshape(p, p)
    d_got = np.einsum("ij,jk,ik->i", x - np.asarray(row.m), inv, x - np.asarray(row.m))
    d_want = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
    assert np.corrcoef(np.log(d_got), np.log(d_want))[0, 1] > 0.999
    assert d_got[:400].min() > 5 * d_got[400:].max()


def test_junk_goes_and_clean_stays(spark):
    d = "/root/testdata/sf0.01"
    judged = O.judge(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    rate = {r.quality: r for r in judged.filter("n_words >= 50").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("k")).collect()}
    assert rate[1].k > 0.99 and rate[0].k < 0.2


def test_edge_rows(spark):
    rng = random.Random(1)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(n))
    rows = [(i, text(rng.randint(60, 300)), "en", f"s{i % 3}", 7.0) for i in range(300)]
    rows += [(None, None, None, None, 1.0), (900, "", "xx", None, 1.0), (900, "", "xx", None, 1.0), (901, "### " * 300 + text(200), "en", "s0", 1.0), (902, text(200_000), None, "s9", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, level double")
    got = O.judge(df).collect()
    assert len(got) == len(rows)
    assert all(not r.kept for r in got if r.doc_id in (None, 900, 901))
    assert sum(r.kept for r in got if r.doc_id is not None and r.doc_id < 300) >= 297
    assert O.judge(df.filter(F.lit(False))).count() == 0
    alone = O.judge(df.filter("doc_id < 5")).collect()
    assert len(alone) == 5 and all(r.kept and r.distance2 is not None for r in alone)


def plain(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(n))


def test_small_tables_and_groups_are_judged(spark):
    """Groups of 5 rows and a table of 40 have estimates of their own: junk goes, long and short clean texts stay."""
    rng = random.Random(2)
    rows = [(i, plain(rng, rng.choice([60, 150, 400, 3000])), "en" if i % 2 else "de", f"s{i // 10}") for i in range(40)]
    junk = [(100 + i, " ".join("".join(rng.choices("#*$%&|<>", k=6)) for _ in range(200)) + "\n" + plain(rng, 60), "en", f"s{i}") for i in range(2)]
    got = {r.doc_id: r for r in O.judge(spark.createDataFrame(rows + junk, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[i].base_failed for i in got)
    assert all(got[i].kept for i in range(40)) and not any(got[100 + i].kept for i in range(2))


def test_drawing_against_plain_arrays(spark):
    """Distances of judged rows equal those under estimates drawn level by level."""
    floors = [f for _, f in O.vector().values()]
    p = len(floors)
    rng = np.random.default_rng(5)
    n = {("en", "a"): 500, ("en", "b"): 7, (None, None): 30}
    rows = [(lang, source, (rng.normal(0, 1, p) + (source == "b")).tolist()) for (lang, source), k in n.items() for _ in range(k)]
    fitted = O.estimates(O._members(spark.createDataFrame(rows, "lang string, source string, x array<double>"))).cache()
    got = {(r.lang, r.source): r for r in O.shrunk(fitted).collect()}
    usual = O.chi2_quantile(0.5, p)
    level = {tuple(r.level): (r.n, np.asarray(r.m), np.linalg.inv(np.reshape(r.w, (p, p))) * max(r.middle / usual, 1)) for r in fitted.collect()}
    assert {k: v[0] for k, v in level.items() if k[0] == 2} == {(2, *k): v for k, v in n.items()} and level[(0, None, None)][0] == 537

    def mixed(own, wider):
        """``own`` and PRIOR_ROWS rows of ``wider`` as one heap: mean, and mean square less its square."""
        (k, m, c), (wm, wc) = own, wider
        total = k + O.PRIOR_ROWS
        mean = (k * m + O.PRIOR_ROWS * wm) / total
        square = (k * (c + np.outer(m, m)) + O.PRIOR_ROWS * (wc + np.outer(wm, wm))) / total
        return mean, square - np.outer(mean, mean)

    top = mixed(level[(0, None, None)], (level[(0, None, None)][1], np.diag(np.square(O.PRIOR_SPREAD * np.asarray(floors)))))
    assert set(got) == set(n)
    for (lang, source), r in got.items():
        m, c = mixed(level[(2, lang, source)], mixed(level[(1, lang, None)], top))
        assert np.asarray(r.m) == pytest.approx(m) and np.linalg.inv(np.reshape(r.w, (p, p))) == pytest.approx(c, abs=1e-9)


def test_verdicts_do_not_jump_with_size(spark):
    """The same odd text in groups of growing size: its distance moves by steps, with no size at which the rule changes."""
    rng = random.Random(3)
    odd = "#$ " * 40 + plain(rng, 100)
    rows = [(i, plain(rng, rng.randint(60, 300)), "en", f"s{n}") for n in (150, 199, 200, 250) for i in range(n)]
    rows += [(1000 + n, odd, "en", f"s{n}") for n in (150, 199, 200, 250)]
    got = {r.doc_id: r for r in O.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).filter("doc_id >= 1000").collect()}
    d = [got[1000 + n].distance2 for n in (150, 199, 200, 250)]
    assert max(d) < 1.5 * min(d) and len({r.kept for r in got.values()}) == 1
