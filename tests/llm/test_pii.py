from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from abx.llm import pii as P

DOCS = "/root/testdata/sf0.01/documents.parquet"
REGEX = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_base(text):
    out = []
    for kind, r in REGEX.items():
        for m in re.finditer(r, text or ""):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


ODD = [
    "a@b.c_d@e.f .@x.y a@b.c.@d.e a@b a@b. x@y.z@w.v a..b@c-d.e-f.g.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.1.1 1.2.3 9.9.9.9 000000000256.1.1.1 1..2.3.4.5",
    "4111 1111 1111 1111 4111-1111-1111-1111x 4111111111111112 1--23 4 4 11111111111111",
    "+1 (555) 123-4567 +12 +1 ( ( ( +1555123456789012345 ++49 30 123456) +1.2",
    "é@ü.ñ ü.x@y.zé 🙂a@b.cc🙂 +33 1 23 45 67 89é\n10.0.0.1\n\n4000 0000 0000 0002",
    "1" * 6000 + " " + "1 " * 4000 + "a" * 6000 + "+" * 500 + "-" * 3000,
    "a@b.c " * 700 + "9.8.7.6," * 300,
    "", " ", "@", "+", "no data here",
]


def as_string(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_base_spans_against_brute_force(spark):
    texts = ODD + [None] + [r.text for r in spark.read.parquet(DOCS).select("text").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in P.report(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = brute_base(t)
        n = Counter(k for k, _, _ in want)
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(n[k] for k in REGEX)
        assert got[i].base_sha256 == hashlib.sha256(as_string(want).encode()).hexdigest()
        assert got[i].spans.startswith(as_string(want))


def terms_of(text):
    out = []
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        punct = r"!-/:-@\[-`{-~"
        core = re.sub(f"^[{punct}]+", "", m.group())
        s = m.end() - len(core)
        core = re.sub(f"[{punct}]+$", "", core)
        if core:
            out.append((core.translate(str.maketrans(P.lower_ascii.__globals__["UPPER"], P.lower_ascii.__globals__["LOWER"])), s, s + len(core)))
    return out


def brute_disclosed(texts, reach, support):
    n = len(texts)
    n_term, n_entity, n_both = Counter(), Counter(), Counter()
    where, where_both = defaultdict(set), defaultdict(set)
    for t in texts:
        n_term.update({w for w, _, _ in terms_of(t or "")})
        seen, both = set(), set()
        for k, s, e in brute_base(t):
            v = t[s:e].lower()
            c = (k, re.sub("[^0-9]", "", v) if k in ("card", "phone") else v)
            seen.add(c)
            both |= {(c, w) for w, ws, we in terms_of(t) if (we <= s and ws >= s - reach) or (ws >= e and we <= e + reach)}
        n_entity.update(seen)
        n_both.update(both)
        for c in seen:
            where[c].add(t)
        for x in both:
            where_both[x].add(t)
    out = {}
    for (c, w), both in n_both.items():
        if len(where[c]) >= support and len(where_both[c, w]) >= support and n_entity[c] < n:
            out[c, w] = math.log(both * n / (n_entity[c] * n_term[w])) / math.log(n / n_entity[c])
    return {k: v for k, v in out.items() if v >= P.GENERALISE_AT}


def corpus():
    filler = [f"plain words number {i} about nothing in particular and more of it" for i in range(60)]
    told = [f"The manager Zebulon, writes from kiosk{i % 2} to boss@corp.example every day {i}" for i in range(6)]
    told += [f"Call Zebulon at +1 555 123 4567 after {i} or ask the manager" for i in range(4)]
    once = ["unique Quagmire person a@once.example", "unique Quagmire person a@once.example", None, ""]
    return filler + told + once + ["manager of plain words", "x " * 400 + "Zebulon boss@corp.example"]


def test_disclosing_terms_against_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {((P.KINDS[r.kind], r.entity), r.term): r.disclosed for r in P.disclosing_terms(df, P._texts(df, "text")).collect()}
    want = brute_disclosed(texts, P.REACH, P.MIN_SUPPORT)
    assert got == pytest.approx(want) and want
    assert any(w == "zebulon" for _, w in want) and not any(w == "quagmire" for _, w in want)


def test_spans_and_sanitised_text(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    spans = {r.doc_id: r.spans for r in P.report(df).collect()}
    clean = P.sanitise(df)
    assert clean.columns == df.columns
    disclosed = brute_disclosed(texts, P.REACH, P.MIN_SUPPORT)
    for r in clean.collect():
        t = texts[r.doc_id]
        base = brute_base(t)
        held = {(k, re.sub("[^0-9]", "", t[s:e]) if k in ("card", "phone") else t[s:e].lower()) for k, s, e in base}
        share = defaultdict(float)
        for (c, w), v in disclosed.items():
            if c in held:
                share[w] = max(share[w], v)
        found = [(w, s, e) for w, s, e in terms_of(t or "") if w in share and not any(a < e and s < b for _, a, b in base)]
        added = [("removed" if share[w] >= P.REMOVE_AT else "generalised", s, e) for w, s, e in found]
        assert spans[r.doc_id] == as_string(base + added)
        if not base:
            assert r.text == t
        else:
            assert not brute_base(r.text) and not {w for w, _, _ in found} & {w for w, _, _ in terms_of(r.text)}
    assert any("removed" in s for s in spans.values())
    assert any("generalised" in s for s in spans.values())


def test_entities_of_one_text_share_what_discloses_their_pool(spark):
    """Each entity stands in one text; the term beside them tells their domain, network or number block."""
    told = [f"Write to Acmecorp, clerk person{i}@acme.example in office {i}" for i in range(4)]
    told += [f"node {i} of Zentrix at 10.77.{i}.9 is up" for i in range(4)]
    told += [f"dial Kelborough +44 7700 9001{i}2 now {i}" for i in range(4)]
    once = ["ask Quagmire of nowhere x@once.example"]
    texts = [f"plain words to ask at node of office {i}, write or dial now" for i in range(60)] + told + once
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    clean = {r.doc_id: r.text for r in P.sanitise(df).collect()}
    for i, t in enumerate(texts):
        if t in told:
            assert not {"acmecorp", "zentrix", "kelborough"} & {w for w, _, _ in terms_of(clean[i])}
            assert clean[i].count("[...]") >= 1
    assert clean[len(texts) - 1] == "ask Quagmire of nowhere [EMAIL]"


def test_overlaps_become_one(spark):
    t = "see 4111 1111 1111 1111@mail.example, +4111 1111 1111 1111 end"
    df = spark.createDataFrame([(1, t)], "doc_id long, text string")
    assert P.sanitise(df).first().text == "see [CARD], +[CARD] end"


def test_edge_rows(spark):
    rows = [(None, "a@b.cd", 1), (1, None, 2), (2, "a@b.cd", 3), (2, "a@b.cd", 3), (3, "w " * 50_000 + "a@b.cd", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, terms long")
    got = P.report(df).collect()
    assert len(got) == 5 and sum(r.n_email for r in got) == 4
    assert P.sanitise(df).count() == 5 and P.sanitise(df).columns == df.columns
    empty = df.filter(F.lit(False))
    assert P.report(empty).count() == 0 and P.sanitise(empty).count() == 0


def test_main_path_is_native(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for out in (P.report(df), P.sanitise(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
