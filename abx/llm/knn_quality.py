"""Quality classification by nearest-neighbour voting in a latent semantic space.

1. One pass turns every whole text into term weights: damped shares of its words, A-Z lower-cased and
   hashed to WORD_SLOTS terms (kept as slots and one byte each), and as further terms those of
   hashed character-class trigrams and of a few text statistics (one byte each).
2. Document frequencies over all rows are summed in Spark. The largest eigenvectors of the term
   co-products, after inverse-document-frequency weighting, span the latent space (latent semantic
   analysis). They come from a randomized decomposition: each of PASSES passes over all rows sums the
   products of the co-products with SKETCH directions, so no task holds a terms-by-terms table.
3. At most LABELLED labelled rows, those with the smallest hash of their id, are sent to every task
   with their latent vectors: the only bounded sample. Every row's cosines with all of them are
   computed in blocks, and its K nearest vote with their similarity.

A word of over LONG_WORD bytes (scripts without spaces) counts as its pieces of PIECE bytes at every
third byte.

Rows whose id falls into the held-out share are not learned from. Score inputs are texts alone.

Defined results: null and empty texts, and all rows if there is nothing to learn from, get the share
of label 1 among what was learned (0.5 if nothing); null ids are never labelled; repeated rows and
copies score alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.llm.common import LOWER_BYTES, id_mod, materialize, slices
from abx.llm.outliers import text_counts

HELD_OUT_MOD, HELD_OUT_REST = 3, 1
LABELLED = 8192
K = 25
RANK = 32
# Directions summed at once: the rank and some more, so that the randomized decomposition is close.
SKETCH = RANK + 16
PASSES = 4
WORD_SLOTS = 4096
LONG_WORD, PIECE = 24, 6
HASHED = 384
STATISTICS = ("n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_lines", "same_as_last", "short_words")
FORMS = HASHED + len(STATISTICS)
TERMS = FORMS + WORD_SLOTS
# Weights are stored in steps of 1 / STEP, up to 255 of them.
STEP = 16.0
SALTS = 256
# Rows made dense at once, and terms a row of partial sums.
DENSE_ROWS = 256
BLOCK = 64


def _classes() -> np.ndarray:
    """Class of each byte: letters of any script, capitals, digits, each white space, each ASCII sign."""
    out = np.full(256, 1, np.int64)
    out[ord("A") : ord("Z") + 1] = 2
    out[ord("0") : ord("9") + 1] = 3
    signs = [b for b in range(128) if not chr(b).isalnum()]
    out[signs] = 4 + np.arange(len(signs)) % 120
    return out


_CLASS = _classes()


def forms(texts: list[bytes]) -> np.ndarray:
    """(texts, FORMS) bytes: damped shares of class trigrams and statistics."""
    n = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    data = _CLASS[np.frombuffer(b"".join(texts), np.uint8)]
    doc = np.repeat(np.arange(n), sizes)
    out = np.zeros((n, FORMS), np.float64)
    if len(data) > 2:
        inside = doc[2:] == doc[:-2]
        code = (data[:-2] * 128 + data[1:-1]) * 128 + data[2:]
        term = (code[inside] * 2654435761 >> 7) % HASHED
        out[:, :HASHED] = np.bincount(doc[2:][inside] * HASHED + term, minlength=n * HASHED).reshape(n, HASHED)
        out[:, :HASHED] *= 1000.0 / np.maximum(sizes, 1)[:, None]
    counts = text_counts(texts)
    words = [t.split() for t in texts]
    counts["same_as_last"] = np.asarray([sum(map(bytes.__eq__, w, w[1:])) for w in words])
    counts["short_words"] = np.asarray([sum(len(x) < 2 for x in w) for w in words])
    many = np.maximum(counts["n_words"], 1)
    for i, name in enumerate(STATISTICS):
        out[:, HASHED + i] = 1000.0 * counts[name] / many
    return np.minimum(np.rint(np.log1p(out) * STEP), 255).astype(np.uint8)


def _parts(text: bytes) -> list[bytes]:
    """Words of a text, the long ones as their pieces."""
    words = text.translate(LOWER_BYTES).split()
    if max(map(len, words), default=0) <= LONG_WORD:
        return words
    out = []
    for w in words:
        out.extend([w] if len(w) <= LONG_WORD else [w[i : i + PIECE] for i in range(0, len(w) - PIECE + 1, 3)])
    return out


def word_weights(texts: list[bytes]) -> list[bytes]:
    """Each text's hashed words: k slots as little-endian 16-bit numbers, ascending, then their k damped shares as bytes."""
    out = []
    for t in texts:
        words = _parts(t)
        slot, n = np.unique(np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % WORD_SLOTS, return_counts=True)
        share = np.minimum(np.rint(np.log1p(1000.0 / max(len(words), 1) * n) * STEP), 255)
        out.append(slot.astype("<u2").tobytes() + share.astype(np.uint8).tobytes())
    return out


def _features(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, held_out, f, w): every row's ``forms`` and ``word_weights``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            f = pa.array([r.tobytes() for r in forms(texts)], pa.binary())
            w = pa.array(word_weights(texts), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), f, w], names=["id", "held_out", "f", "w"])

    held = (id_mod(F.col(id_col), HELD_OUT_MOD) == HELD_OUT_REST).alias("held_out")
    rows = df.select(F.col(id_col).alias("id"), held, F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, held_out boolean, f binary, w binary")


def _unpack(f: list[bytes], w: list[bytes]) -> np.ndarray:
    """(rows, TERMS) term weights: forms first, then words."""
    n = len(f)
    out = np.zeros((n, TERMS), np.float32)
    out[:, :FORMS] = np.frombuffer(b"".join(f), np.uint8).reshape(n, FORMS)
    k = np.fromiter((len(x) // 3 for x in w), np.int64, n)
    slot = np.frombuffer(b"".join(x[: 2 * j] for x, j in zip(w, k.tolist(), strict=True)), "<u2")
    share = np.frombuffer(b"".join(x[2 * j :] for x, j in zip(w, k.tolist(), strict=True)), np.uint8)
    out[np.repeat(np.arange(n), k), FORMS + slot.astype(np.int64)] = share
    return out / np.float32(STEP)


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, DENSE_ROWS):
            part = batch.slice(at, DENSE_ROWS)
            yield part, _unpack(part.column("f").to_pylist(), part.column("w").to_pylist())


def _summed(features: DataFrame, of, width: int) -> np.ndarray:
    """(TERMS, width): ``of(x)`` added up over blocks x of all rows, in tasks and then by blocks of terms."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TERMS, width))
        for _, x in _dense(batches):
            total += of(x)
        if total.any():
            salt = TaskContext.get().partitionId() % SALTS  # the same if the task is run again
            v = [total[i : i + BLOCK].tobytes() for i in range(0, TERMS, BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v))), pa.array(np.full(len(v), salt)), pa.array(v, pa.binary())], names=["i", "salt", "v"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v) for v in pdf.v], axis=0)
        return pd.DataFrame({"i": pdf.i[:1], "salt": pdf.salt[:1], "v": [total.tobytes()]})

    schema = "i bigint, salt bigint, v binary"
    summed = features.select("f", "w").mapInArrow(partial, schema).groupBy("i", "salt").applyInPandas(add, schema)
    summed = summed.withColumn("salt", F.lit(0).cast("bigint")).groupBy("i").applyInPandas(add, schema)
    out = np.zeros((TERMS, width))
    for r in summed.select("i", "v").collect():  # one row a block of terms
        out[r.i * BLOCK : (r.i + 1) * BLOCK] = np.frombuffer(r.v).reshape(-1, width)
    return out


def _idf(frequency: np.ndarray, n_rows: int) -> np.ndarray:
    return np.log((n_rows + 1) / (frequency + 1)) + 1


def start(width: int) -> np.ndarray:
    """Random directions that are the same in every run."""
    return np.linalg.qr(np.random.default_rng(7).normal(size=(TERMS, width)))[0]


def latent_space(features: DataFrame, n_rows: int, rank: int = RANK) -> np.ndarray:
    """(TERMS, rank) projection from term weights to latent vectors."""
    width = rank + SKETCH - RANK
    idf = _idf(_summed(features, lambda x: (x > 0).sum(0)[:, None], 1)[:, 0], n_rows)
    basis = start(width)
    for step in range(PASSES):
        weighed = (idf[:, None] * basis).astype(np.float32)
        image = idf[:, None] * _summed(features, lambda x, g=weighed: x.T @ (x @ g), width)
        if step < PASSES - 1:
            basis = np.linalg.qr(image)[0]
    inner = basis.T @ image
    vectors = basis @ np.linalg.eigh((inner + inner.T) / 2)[1][:, ::-1][:, :rank]
    return (idf[:, None] * vectors).astype(np.float32)


def project(f: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Unit latent vectors; zero where a text has no terms."""
    y = f @ space
    norm = np.linalg.norm(y, axis=1, keepdims=True)
    return np.divide(y, norm, out=np.zeros_like(y), where=norm > 0)


def vote(x: np.ndarray, known: np.ndarray, labels: np.ndarray, k: int = K) -> np.ndarray:
    """Share of label 1 among the k nearest labelled vectors, each weighted by its cosine; ties go to the
    earlier one. Rows without a similar one get the share among all."""
    out = np.full(len(x), labels.mean() if len(labels) else 0.5)
    if not len(labels):
        return out
    k = min(k, len(labels))
    for at in range(0, len(x), 1024):
        s = x[at : at + 1024] @ known.T
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(s, near, 1), 0).astype(float)
        total = w.sum(1)
        some = total > 0
        out[at : at + 1024][some] = (w * labels[near]).sum(1)[some] / total[some]
    return np.clip(out, 0.0, 1.0)


def classify(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    labelled: int = LABELLED,
    k: int = K,
    rank: int = RANK,
) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1, higher: label 1 likelier), predicted (score >= 0.5)."""
    features = materialize(_features(df, id_col, text_col))
    space = latent_space(features, features.count(), rank)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("label IN (0, 1)").distinct()
    train = features.filter(~F.col("held_out")).join(known, "id")
    # At most ``labelled`` rows reach the driver. Rows with larger hashes leave in their tasks, so
    # that the tasks together send little more than those that are kept, as latent vectors.
    n = train.count()
    least = -(1 << 63)
    limit = least + int((1 << 64) * min(1.0, (1.5 * labelled + 1000) / max(n, 1)))
    hashed = train.withColumn("h", F.xxhash64("id")).filter(F.col("h") <= F.lit(min(limit, -least - 1))).select("id", "h", "label", "f", "w")
    space_of = df.sparkSession.sparkContext.broadcast(space)

    def latent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _dense(batches):
            y = pa.array([r.tobytes() for r in project(x, space_of.value)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("h"), part.column("label"), y], names=["id", "h", "label", "y"])

    kind = df.schema[id_col].dataType.simpleString()
    projected = hashed.mapInArrow(latent, f"id {kind}, h bigint, label int, y binary")
    sample = projected.orderBy("h", "id", "label", "y").limit(labelled).select("label", "y").collect()
    vectors = np.frombuffer(b"".join(r.y for r in sample), np.float32).reshape(-1, rank)
    shared = df.sparkSession.sparkContext.broadcast((vectors, np.asarray([r.label for r in sample], float)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, marks = shared.value
        for part, x in _dense(batches):
            score = vote(project(x, space_of.value), vectors, marks, k)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), pa.array(score)], names=["id", "held_out", "score"])

    out = features.mapInArrow(run, f"id {kind}, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
