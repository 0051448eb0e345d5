from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from abx.llm.components import components
from abx.llm.simhash import block_masks, bucket_links, keep_one, links, near_duplicates

DOCS = "/root/testdata/sf0.001/documents.parquet"


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, prints, distance=4):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    groups: dict = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min(groups[find(i)]) for i in range(len(ids))]


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(DOCS)
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    want = brute_components([r.doc_id for r in rows], prints)
    got = {r.doc_id: r for r in near_duplicates(docs).collect()}
    assert len(got) == len(rows)
    for r, p, c in zip(rows, prints, want, strict=True):
        assert (got[r.doc_id].fingerprint, got[r.doc_id].component_id) == (f"{p:016x}", c)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


def roots_of(pairs, nodes):
    at = {n: n for n in nodes}
    for a, b in pairs:
        ra, rb = a, b
        while at[ra] != ra:
            ra = at[ra]
        while at[rb] != rb:
            rb = at[rb]
        at[max(ra, rb)] = min(ra, rb)
    out = {}
    for n in nodes:
        r = n
        while at[r] != r:
            r = at[r]
        out[n] = r
    return out


@pytest.mark.parametrize("max_bucket", [8192, 8])
def test_dense_and_sparse_links(spark, max_bucket):
    """Both ways of a bucket (compared in a task, joined on variants) give the exact components."""
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(150)}
    for center in list(values)[:3]:
        for _ in range(60):
            values.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = [(r.a, r.b) for r in links(df, 4, max_bucket).collect()]
    u = {v: v % (1 << 64) for v in signed}
    want = roots_of([(a, b) for i, a in enumerate(signed) for b in signed[:i] if (u[a] ^ u[b]).bit_count() <= 4], signed)
    assert roots_of(got, signed) == want
    if max_bucket > len(signed):  # compared in tasks: one link a member and block choice at most
        assert len(got) <= len(signed) * len(block_masks(len(signed)))


def test_large_bucket_in_one_task():
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 1 << 13, 3000).astype(np.uint64))
    a, b = bucket_links(np.zeros(len(fp), np.int64), fp, 4)
    assert len(a) == len(fp) - 1 and set(b.tolist()) == {int(fp[0])}


def test_block_masks_cover_every_close_pair():
    rng = random.Random(5)
    for n in (10, 10**6, 10**9):
        masks = block_masks(n)
        for _ in range(300):
            x = rng.getrandbits(64)
            y = x ^ sum(1 << b for b in rng.sample(range(64), 4))
            assert any(x & m == y & m for m in masks)


def test_components_of_a_long_path(spark):
    n = 60
    df = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}
    assert components(df.filter(F.lit(False))).count() == 0


def test_edge_rows(spark):
    rows = [(5, None, 1), (9, "", 2), (None, "a b c d e", 3), (7, "a b c d e", 4), (7, "a b c d e", 4), (2, "word " * 30000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    zero = "0" * 16
    assert by[(5, zero)] == by[(9, zero)] == 5
    assert {c for (d, f), c in by.items() if d in (None, 7)} == {7}
    kept = keep_one(df).collect()
    assert sorted((r.doc_id, r.fp) for r in kept) == [(2, 5), (5, 1), (7, 4)]
    empty = df.filter(F.lit(False))
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0
    with pytest.raises(ValueError):
        links(df, 3)
