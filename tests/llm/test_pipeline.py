from __future__ import annotations

import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as P  # noqa: E402

from test_mixing import brute_targets  # noqa: E402
from test_pii import brute_base  # noqa: E402
from test_simhash import brute_components, brute_print  # noqa: E402

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's documents, written and read as the driver does; three planted rows among them."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    extra = [
        (900_001, " ".join(f"{i * 7919:x}{i:b}" for i in range(200)), None, "junk", 1),
        (900_002, first.text, first.lang, first.source, first.n_chars),
        (900_003, None, "en", "src1", 0),
    ]
    now = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    root = tmp_path_factory.mktemp("stages")
    out = [now]
    for name, stage in P.STAGES:
        stage(spark, now, D).write.parquet(f"{root}/{name}")
        now = spark.read.parquet(f"{root}/{name}")
        out.append(now)
    return out


def test_stages_keep_columns(stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "pii", "source_mixing", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_language_stage(stages):
    before, after = ({r.doc_id for r in s.collect()} for s in stages[:2])
    assert before - after == {900_001}


def test_near_duplicate_stage(stages):
    rows = stages[1].collect()
    want = set(brute_components([r.doc_id for r in rows], [brute_print(r.text) for r in rows]))
    assert {r.doc_id for r in stages[2].collect()} == want and stages[2].count() == len(want) and 900_002 not in want


def test_pii_stage(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    for r in stages[3].collect():
        if not brute_base(before[r.doc_id]):
            assert r.text == before[r.doc_id]
        else:
            assert not brute_base(r.text) and "[" in r.text and r.n_chars == len(r.text)
    assert stages[3].count() == len(before)


def test_mixing_stage(stages):
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in stages[3].collect():
        n = len((r.text or "").split())
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    for r in stages[4].collect():
        taken[r.source] += len(r.text.split())
    for s, goal in brute_targets(sizes).items():
        assert abs(taken[s] - goal) <= largest[s]


def test_packing_stage(stages):
    copies = Counter(r.doc_id for r in stages[4].collect())
    got = stages[5].collect()
    assert Counter(r.doc_id for r in got if r.start == 0) == copies
    total = Counter()
    for r in got:
        assert zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        total[r.doc_id] += r.length
    for r in got:
        assert total[r.doc_id] == r.doc_tokens * copies[r.doc_id]


def test_run_equals_stages(spark):
    """run() gives what the stages give one by one; reruns agree."""
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    a = sorted(map(tuple, P.run(spark, D).select(*cols).collect()))
    now = spark.read.parquet(f"{D}/documents.parquet")
    for _, stage in P.STAGES:
        now = stage(spark, now, D)
    assert a == sorted(map(tuple, now.select(*cols).collect()))


def test_empty_documents(spark):
    now = spark.read.parquet(f"{D}/documents.parquet").filter(F.lit(False))
    for _, stage in P.STAGES:
        now = stage(spark, now, D)
    assert now.count() == 0


