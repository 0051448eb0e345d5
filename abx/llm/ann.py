"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are turned by fast Hadamard pseudo-rotations (three rounds of random signs and transform);
a unit vector's hash is the signed axis nearest to it, and its bucket in a table one such hash or two
concatenated. To search for the largest inner product, vectors are parted into ranges of norms, scaled
by the largest norm of their range and lifted onto the unit sphere by one more component. A query looks
into the ``probes`` buckets of each table and range whose axes are nearest to it; what it meets there is
ranked by exact inner products in double precision on the original vectors. A query that meets fewer
vectors than it asks for is compared with all.

How many hashes a bucket has, and how many tables and probes there are, is measured: PILOT queries, the
first in a hash order, are compared with all vectors in blocks, and of all settings under which the pilot
meets TARGET of its nearest vectors the one with the least work is taken. Vectors that lie close
together need few probes; nearly independent ones have no near buckets, and need most of them. The work
counts vectors in a bucket (more hashes make smaller buckets) and PROBE_COST for each probe, so larger
tables come to use two hashes.

Equal vectors are one class: it is hashed and compared once and stands for its smallest ids, as no
search can need more. Buckets meet queries in blocks of at most about BLOCK rows on either side, so
neither a hot bucket nor many queries in one bucket make a large group, and a block hands on no more
than the best of each query. No candidate that a query meets is left out.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no
part; rows of different lengths meet as if padded with zeros; a null id takes no part; repeated rows
count as one; ties go to the smaller id; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abx.llm.common import bounded_broadcast, materialize

NEAREST = 20
TABLES = 8
HASHES = 2
AXES = 64
SEED = 7
BLOCK = 4096
# Norms of a range differ by at most this factor.
RANGE = 2**0.25
# Queries that measure the settings, the share of their nearest vectors to be met, and the work of a probe in vectors.
PILOT = 100
TARGET = 0.95
PROBE_COST = 50
# Buckets up to this count are told to every task (20 MB); beyond, they are joined by shuffling.
BROADCAST_BLOCKS = 1 << 20
# More candidates than asked for are kept while scores still come from blocked products.
SPARE = 4


def _rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Pseudo-rotation of the rows of x: for each row of signs, flip and apply the Hadamard transform."""
    n, d = x.shape
    for s in signs:
        x, h = x * s, 1
        while h < d:
            pairs = x.reshape(n, -1, 2, h)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, d)
            h *= 2
        x = x / np.sqrt(d)
    return x


class CrossPolytope:
    """The hash functions of all tables for vectors of up to ``dim`` components; a bucket is named by ``hashes`` of them."""

    def __init__(self, dim: int, tables: int = TABLES, axes: int = AXES, hashes: int = 1, seed: int = SEED):
        self.dim, self.tables, self.hashes = dim, tables, hashes
        self.width = 1 << max(1, int(dim).bit_length())  # room for the lift
        self.axes = min(axes, self.width)
        self.signed = 2 * self.axes
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, hashes, 3, self.width))

    def _turned(self, x: np.ndarray, lift: np.ndarray, table: int) -> list[np.ndarray]:
        wide = np.zeros((len(x), self.width))
        wide[:, : self.dim] = x
        wide[:, self.dim] = lift
        return [_rotate(wide, signs)[:, : self.axes] for signs in self.signs[table]]

    def buckets(self, x: np.ndarray, norms: np.ndarray, table: int) -> np.ndarray:
        """The bucket of each vector, scaled by the norm beside it: for each hash twice the axis, plus one if its sign is
        negative, as digits to the base ``signed``."""
        x = x / norms[:, None]
        out = np.zeros(len(x), np.int64)
        for y in self._turned(x, np.sqrt(np.maximum(0.0, 1 - np.square(x).sum(1))), table):
            axis = np.abs(y).argmax(1)
            out = out * self.signed + 2 * axis + (y[np.arange(len(y)), axis] < 0)
        return out

    def probes(self, x: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The ``probes`` buckets of each query, those first whose signed axes have the largest sum of components."""
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        names, sums = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for y in self._turned(x, np.zeros(len(x)), table):
            signed = np.stack([y, -y], 2).reshape(len(y), -1)
            # A bucket among the first ``probes`` has each of its digits among the first ``probes`` too.
            top = np.argsort(-signed, axis=1, kind="stable")[:, : min(probes, self.signed)]
            names = (names[:, :, None] * self.signed + top[:, None, :]).reshape(len(x), -1)
            sums = (sums[:, :, None] + np.take_along_axis(signed, top, 1)[:, None, :]).reshape(len(x), -1)
            best = np.argsort(-sums, axis=1, kind="stable")[:, :probes]
            names, sums = np.take_along_axis(names, best, 1), np.take_along_axis(sums, best, 1)
        return names


def settings(
    queries: np.ndarray, near: np.ndarray, tops: np.ndarray, of: np.ndarray, n: int, axes: int = AXES, target: float = TARGET
) -> tuple[int, int, int]:
    """(hashes, tables, probes) of least work under which ``target`` of the pairs meet: ``near[i]`` is one of the nearest
    vectors of ``queries[of[i]]``, in a range of largest norm ``tops[i]``; ``n`` is the number of vectors."""
    best = None
    for hashes in range(1, HASHES + 1):
        h = CrossPolytope(queries.shape[1], TABLES, axes, hashes)
        every = h.signed**hashes
        met = np.full(len(near), every)
        for t in range(TABLES):
            bucket = h.buckets(near, tops, t)
            place = np.empty(len(near), np.int64)
            for q, probed in enumerate(h.probes(queries, t, every)):
                rank = np.empty(every, np.int64)
                rank[probed] = np.arange(every)
                place[of == q] = rank[bucket[of == q]]
            met = np.minimum(met, place)
            probes = int(np.sort(met)[int(np.ceil(target * len(met))) - 1]) + 1
            work = (t + 1) * probes * (n / every + PROBE_COST)
            if best is None or work < best[0]:
                best = (work, hashes, t + 1, probes)
    return best[1:]


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _usable(v: Column) -> Column:
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(broken, F.lit(True)) & F.exists(v, lambda x: x != 0)


def _hashed(rows: DataFrame, hashes: CrossPolytope, probes: int | None) -> DataFrame:
    """(t, bucket, cid, v): each vector in its bucket of every table, or in its probed ones; the former
    need the largest norm of their range as ``top`` and keep their ``range``."""
    ranged = ", range int" * (probes is None)
    step = BLOCK if probes is None else PILOT  # a probing query looks at all its buckets at once

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at : at + step]
                x = _matrix(part.v, hashes.dim)
                for t in range(hashes.tables):
                    b = hashes.buckets(x, part.top.to_numpy(), t)[:, None] if probes is None else hashes.probes(x, t, probes)
                    i = np.repeat(np.arange(len(part)), b.shape[1])
                    out = {"t": np.int32(t), "bucket": b.ravel(), "cid": part.cid.to_numpy()[i], "v": part.v.to_numpy()[i]}
                    yield pd.DataFrame(out | ({"range": part.range.to_numpy()[i]} if probes is None else {}))

    return rows.mapInPandas(run, f"t int, bucket bigint, cid bigint, v {rows.schema['v'].dataType.simpleString()}{ranged}")


def _whole(rows: DataFrame) -> DataFrame:
    """(t, bucket, cid, v): all rows in one bucket of a table of its own."""
    return rows.select(F.lit(-1).alias("t"), F.lit(0).cast("bigint").alias("bucket"), F.col("cid").alias("cid"), F.col("v").alias("v"))


def _meet(cand: DataFrame, query: DataFrame, dim: int, k: int) -> DataFrame:
    """(qid, cid, score): the k best candidates of each query in its buckets; ``cand`` has the range too."""
    # Blocks a bucket on either side; the table has a row for each range and bucket that hold vectors.
    parts = lambda side, name, *keys: side.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    c_parts = parts(cand, "c_parts", "t", "range", "bucket")
    blocks = bounded_broadcast(materialize(c_parts.join(parts(query, "q_parts", "t", "bucket"), ["t", "bucket"])), BROADCAST_BLOCKS)
    own = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cand = cand.join(blocks, ["t", "range", "bucket"]).withColumn("c", own("c_parts")).withColumn("q", all_of("q_parts"))
    query = query.join(blocks, ["t", "bucket"]).withColumn("q", own("q_parts")).withColumn("c", all_of("c_parts"))
    keys = ["t", "range", "bucket", "c", "q"]
    met = cand.select(*keys, "cid", "v").groupBy(*keys).cogroup(query.select(*keys, "cid", "v").groupBy(*keys))
    found = met.applyInPandas(_best(dim, k), "qid bigint, cid bigint, score double")
    found = found.groupBy("qid", "cid").agg(F.max("score").alias("score"))
    by_class = W.partitionBy("qid").orderBy(F.col("score").desc(), "cid")
    return found.withColumn("n", F.row_number().over(by_class)).filter(F.col("n") <= k).drop("n")


def _best(dim: int, k: int):
    """A block of candidates and queries to the k best candidates of each query."""

    def run(cand: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        if not len(cand) or not len(query):
            return pd.DataFrame({"qid": np.zeros(0, np.int64), "cid": np.zeros(0, np.int64), "score": np.zeros(0)})
        c, q = _matrix(cand.v, dim), _matrix(query.v, dim)
        m = min(k + SPARE, len(c))
        rows, cols = [], []
        for at in range(0, len(q), 512):
            s = q[at : at + 512] @ c.T
            best = np.argpartition(-s, m - 1, axis=1)[:, :m] if m < len(c) else np.tile(np.arange(len(c)), (len(s), 1))
            rows.append(np.repeat(np.arange(at, at + len(s)), m))
            cols.append(best.ravel())
        row, col = np.concatenate(rows), np.concatenate(cols)
        # One pair's score is the same wherever the pair is met.
        score = np.einsum("ij,ij->i", q[row], c[col])
        cid = cand.cid.to_numpy()[col]
        order = np.lexsort((cid, -score, row))
        place = np.arange(len(order)) % m
        kept = order[place < k]
        return pd.DataFrame({"qid": query.cid.to_numpy()[row[kept]], "cid": cid[kept], "score": score[kept]})

    return run


def _measured(ranged: DataFrame, asking: DataFrame, dim: int, k: int, n: int, axes: int) -> tuple[int, int, int]:
    """Settings by the PILOT queries: what reaches the driver is PILOT * (k + 1) vectors, whatever the table's size."""
    pilot = materialize(asking.orderBy(F.xxhash64("cid"), "cid").limit(PILOT))
    exact = _meet(_whole(ranged).withColumn("range", F.lit(0)), _whole(pilot), dim, k + 1).filter("qid <> cid")
    near = materialize(exact).join(ranged, "cid").select("qid", "v", "top").toPandas()
    asked = pilot.toPandas()
    if not len(near):
        return 1, 1, 1
    place = {c: i for i, c in enumerate(asked.cid)}
    of = near.qid.map(place).to_numpy()
    return settings(_matrix(asked.v, dim), _matrix(near.v, dim), near.top.to_numpy(), of, n, axes)


def search(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    is_query: Column | None = None,
    k: int = NEAREST,
    tables: int | None = None,
    probes: int | None = None,
    hashes: int = 1,
    axes: int = AXES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k nearest other rows found, by largest inner product. With
    ``tables`` and ``probes`` given, these and ``hashes`` are used as they are; else all three are measured."""
    asked = is_query if is_query is not None else F.lit(True)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = materialize(rows.filter(F.col("id").isNotNull() & _usable(F.col("v"))))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    dim, norm = rows.agg(F.max(F.size("v")), F.max(F.sqrt(norm2))).first()
    if dim is None:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # A class needs its k + 1 smallest ids; the limit on the rank works before the shuffle.
    first = F.row_number().over(W.partitionBy("v").orderBy("id"))
    members = rows.select("id", "v").withColumn("n", first).filter(F.col("n") <= k + 1).dropDuplicates(["v", "id"])
    classes = rows.groupBy("v").agg(F.min("id").alias("cid"), F.max("asked").alias("asked"))
    members = materialize(members.join(classes.select("v", "cid"), "v").select("cid", "id"))
    classes = materialize(classes)
    wanted = materialize(rows.filter("asked").select("id", "v").distinct().join(classes.select("v", "cid"), "v").select(F.col("id").alias("query_id"), F.col("cid").alias("qid")))

    nth = F.floor(F.log(F.lit(norm) / F.sqrt(norm2)) / float(np.log(RANGE))).cast("int")
    ranged = classes.select("cid", "v", nth.alias("range"))
    ranged = ranged.withColumn("top", F.lit(norm) * F.pow(F.lit(RANGE), -F.col("range")))
    asking = classes.filter("asked").select("cid", "v")
    n_classes = classes.count()
    if tables is None or probes is None:
        hashes, tables, probes = _measured(ranged, asking, dim, k, n_classes, axes)
    functions = CrossPolytope(dim, tables, axes, hashes)
    cand, query = _hashed(ranged, functions, None), _hashed(asking, functions, probes)
    found = materialize(_meet(cand, query, dim, k + 1))
    # A class may stand for one id alone, so a query needs k + 1 classes, or all there are.
    enough = found.groupBy(F.col("qid").alias("cid")).count().filter(F.col("count") >= min(k + 1, n_classes))
    short = materialize(asking.join(enough, "cid", "left_anti"))
    if not short.isEmpty():
        rest = _meet(_whole(classes).withColumn("range", F.lit(0)), _whole(short), dim, k + 1)
        found = found.join(short.select(F.col("cid").alias("qid")), "qid", "left_anti").unionByName(rest)
    by_id = W.partitionBy("qid").orderBy(F.col("score").desc(), "id")
    near = found.join(members, "cid").withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1).select("qid", "id", "score")
    pairs = wanted.join(near, "qid").filter("query_id <> id")
    by_query = W.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = pairs.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
