"""Merkle manifest against a plain recursive build, and what tampering does to it."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from abx.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row: dict, n_chars=...) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"] if n_chars is ... else n_chars, row["text"]]
    texts = [None if v is None else str(v) for v in values]
    return _h(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def _build(leaves: list[str], fanout: int):
    """Root, and per leaf its list of (digests left, digests right)."""
    paths = [[] for _ in leaves]
    level, under = list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        up, up_under = [], []
        for a in range(0, len(level), fanout):
            run = level[a : a + fanout]
            for j in range(len(run)):
                for i in under[a + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(_h(*run))
            up_under.append([i for u in under[a : a + fanout] for i in u])
        level, under = up, up_under
    return level[0], paths


def _brute(rows: list[dict], fanout: int):
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    subroots, proofs = [], []
    for lang in langs:
        part = sorted(by[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
        sub, paths = _build([_leaf(r) for r in part], fanout)
        subroots.append(sub)
        proofs.append((part, paths))
    root, tops = _build(subroots, fanout)
    out = []
    for (part, paths), sub, top in zip(proofs, subroots, tops, strict=True):
        for r, path in zip(part, paths, strict=True):
            path = path + top
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            d = _leaf(r, r["n_chars"] + 1) if hit and r["n_chars"] is not None else _leaf(r)
            for left, right in path:
                d = _h(left, d, right)
            out.append((r["doc_id"], _leaf(r), sub, root, _h(*[x for p in path for x in p]), d, d == root))
    return sorted(out, key=repr)


def _rows(n: int) -> list[dict]:
    langs = ["en", "de", None, "", "én", "zz"]
    rows = [
        {
            "doc_id": None if i % 41 == 40 else (i * 7919) % 100003,
            "text": [None, "", "text é" * (i % 5), "x"][i % 4],
            # One language holds most rows, one a single row.
            "lang": langs[0] if i % 3 else langs[min(i % 7, 4)],
            "source": None if i % 5 == 0 else f"s{i % 3}",
            "n_chars": None if i % 6 == 0 else i,
        }
        for i in range(n)
    ]
    rows += [dict(rows[3]), dict(rows[3]), dict(rows[3], text="other text, same id")]
    rows.append({"doc_id": 14, "text": "alone", "lang": "zz", "source": None, "n_chars": 5})
    return rows


def _df(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)


@pytest.mark.parametrize("n,fanout,levels", [(150, 2, 3), (37, 3, 2), (1, 2, 10), (64, 2, 10)])
def test_against_plain_build(spark, n, fanout, levels):
    rows = _rows(n) if n > 3 else [{"doc_id": 14, "text": "", "lang": None, "source": None, "n_chars": None}]
    got = merkle.report(_df(spark, rows).repartition(5), fanout, levels).collect()
    assert sorted([tuple(r) for r in got], key=repr) == _brute(rows, fanout)


def test_tampering_is_found_and_only_that(spark):
    rows = [{"doc_id": i, "text": str(i), "lang": "a", "source": "s", "n_chars": 1 if i % 2 else None} for i in range(60)]
    got = {r.doc_id: r.verified for r in merkle.report(_df(spark, rows), block_levels=2).collect()}
    assert {i for i, ok in got.items() if not ok} == {
        i for i in range(60) if i % 2 and zlib.crc32(str(i).encode()) % 7 == 0
    }


def test_empty_table_and_clashing_columns(spark):
    rows = _rows(20)
    df = _df(spark, rows)
    want = _brute(rows, 2)
    for extra in ("grp", "pos", "n", "digest", "path", "block", "node", "top", "left", "right", "tie", "at", "root", "s0"):
        df = df.selectExpr("*", f"'x' AS {extra}")
    assert sorted([tuple(r) for r in merkle.report(df).collect()], key=repr) == want
    assert merkle.report(df.limit(0)).collect() == []


def test_fanout_must_branch(spark):
    with pytest.raises(ValueError, match="fanout"):
        merkle.manifest(_df(spark, _rows(5)), fanout=1)


def test_given_documents_do_not_depend_on_blocks(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = sorted(tuple(r) for r in merkle.report(df).collect())
    assert one == sorted(tuple(r) for r in merkle.report(df.repartition(7), block_levels=3).collect())
    assert len(one) == df.count()
