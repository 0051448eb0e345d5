"""SimHash near-duplicates by pigeonhole blocks.

1. Every document gets a 64-bit fingerprint of its word shingles (one pass, no shuffle).
2. Fingerprints are split into k blocks. Two that differ in at most D bits agree on some k - D of
   them, so distinct fingerprints meet in one bucket for each choice of k - D blocks, and the pairs
   that meet are verified by Hamming distance. k grows with the logarithm of their count, so that a
   bucket of evenly spread fingerprints stays small; the result is the same for every k.
3. A bucket gives at most one link per member (to the smallest member it is connected with), never
   all its pairs. A bucket over MAX_BUCKET members is not compared in one task: its fingerprints
   are joined on their variants with up to D / 2 free bits flipped. Two share a variant exactly if
   they differ in at most D bits, so no link is lost, and the work is in proportion to the members.
4. Components of the links; equal fingerprints are linked by grouping.

Defined results: null and empty texts have fingerprint zero and are linked like any other; a null id
keeps its row and never names a component with other ids; repeated rows share a component; an empty
table gives an empty result; other columns are ignored (``keep_one`` returns them unchanged).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abx.llm.common import LOWER_BYTES, materialize, slices
from abx.llm.components import components

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
BITS = 64
# Mean members of a bucket of evenly spread fingerprints, at most.
BUCKET_LOAD = 64
# Larger buckets are joined on bit variants instead of being compared in one task.
MAX_BUCKET = 8192
# Up to this size all members of a batch's buckets are compared in one vector operation a distance.
VECTOR_BUCKET = 512
CHUNK_ROWS = 1 << 18


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    import xxhash

    words = text.translate(LOWER_BYTES).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)]


def majority_bits(hashes: list[list[int]]) -> np.ndarray:
    """One unsigned 64-bit fingerprint a list: a bit is set if it is in over half the hashes."""
    counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        flat = np.fromiter((h for hs in hashes for h in hs), np.uint64, int(counts.sum()))
        bits = np.unpackbits(flat.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * ones > counts[full, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, row_hash, fp): a hash of id and text names the row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            fp = majority_bits([shingle_hashes(t, shingle) for t in texts]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row_hash"), pa.array(fp)], names=["id", "row_hash", "fp"])

    text = F.col(text_col).cast("string")
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("row_hash"), text.alias("text"))
    return rows.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, row_hash bigint, fp bigint")


def block_masks(n: int, distance: int = MAX_DISTANCE) -> list[int]:
    """Masks of all choices of k - distance blocks, with the smallest k whose keys spread n values."""
    k = distance + 1
    while True:
        edges = [BITS * i // k for i in range(k + 1)]
        masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
        chosen = [sum(c) for c in combinations(masks, k - distance)]
        if BUCKET_LOAD << min(m.bit_count() for m in chosen) >= n or k == BITS // 2:
            return chosen
        k += 1


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _least_connected(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest position connected with each of n positions by the pairs (i, j)."""
    label = np.arange(n)
    while True:
        old = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(label, old):
            return label


def _connect(values: np.ndarray, distance: int) -> np.ndarray:
    """The same for one bucket, a breadth-first walk that compares each member with those not yet reached."""
    label = np.arange(len(values))
    left = label.copy()
    while len(left):
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(values[left] ^ values[queue.pop()]) <= distance
            queue.extend(left[near])
            label[left[near]] = root
            left = left[~near]
    return label


def bucket_links(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest connected member) of whole buckets; rows are sorted by key and fp."""
    n = len(fp)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([first, [n]]))
    end = np.repeat(first + sizes, sizes)
    active = np.flatnonzero((np.repeat(sizes, sizes) <= VECTOR_BUCKET) & (np.arange(n) + 1 < end))
    found, step = [], 1
    while len(active):
        found.append((near := active[np.bitwise_count(fp[active] ^ fp[active + step]) <= distance], near + step))
        step += 1
        active = active[active + step < end[active]]
    i, j = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))
    label = _least_connected(i, j, n)
    for a, size in zip(first[sizes > VECTOR_BUCKET], sizes[sizes > VECTOR_BUCKET], strict=True):
        label[a : a + size] = a + _connect(fp[a : a + size], distance)
    linked = np.flatnonzero(label != np.arange(n))
    return fp[linked], fp[label[linked]]


def _compare_buckets(distance: int, max_bucket: int):
    """Sorted rows (t, key, fp) in; links (a, b) out, and the rows (t, a) of buckets over max_bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(a, b, t) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(t, pa.int32())], names=["a", "b", "t"])

        def members(t, fp) -> pa.RecordBatch:
            return batch(fp.view(np.int64), np.zeros(len(fp), np.int64), t)

        def whole(t, key, fp):
            """Links of whole buckets, and members of those that are too large."""
            run_of = np.cumsum(np.concatenate([[True], (t[1:] != t[:-1]) | (key[1:] != key[:-1])]))
            big = np.bincount(run_of)[run_of] > max_bucket
            if big.any():
                yield members(t[big], fp[big])
            if not big.all():
                a, b = bucket_links(run_of[~big], fp[~big], distance)
                if len(a):
                    yield batch(a.view(np.int64), b.view(np.int64), np.full(len(a), -1, np.int32))

        held: list[tuple[np.ndarray, ...]] = []
        rows, flooded = 0, None

        def drain(last: bool):
            nonlocal held, rows, flooded
            if not rows:
                return
            t, key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            open_from = 0
            if flooded is not None:  # the rest of a bucket whose first rows have gone
                same = (t == flooded[0]) & (key == flooded[1])
                open_from = len(t) if same.all() else int(np.argmin(same))
                if open_from:
                    yield members(t[:open_from], fp[:open_from])
                if open_from < len(t) or last:
                    flooded = None
            cut = len(t)
            if not last and open_from < cut:
                tail = (t == t[-1]) & (key == key[-1])
                tail[:open_from] = False
                cut = int(np.argmax(tail))
                if len(t) - cut > max_bucket:
                    yield members(t[cut:], fp[cut:])
                    flooded = (t[-1], key[-1])
                    held, rows = [], 0
                else:
                    held, rows = [(t[cut:], key[cut:], fp[cut:])], len(t) - cut
            else:
                held, rows = [], 0
            if cut > open_from:
                yield from whole(t[open_from:cut], key[open_from:cut], fp[open_from:cut])

        for b in batches:
            if b.num_rows:
                held.append((b.column("t").to_numpy(), b.column("key").to_numpy(), b.column("fp").to_numpy().view(np.uint64)))
                rows += b.num_rows
                if rows >= CHUNK_ROWS:
                    yield from drain(False)
        yield from drain(True)

    return run


def _variant_links(members: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """Links of large buckets: members (t, a) that share a variant with up to distance / 2 bits flipped
    outside the bucket's own blocks are tied to the smallest of those that share it."""
    flips = []
    for mask in masks:
        free = [1 << b for b in range(BITS) if not mask >> b & 1]
        flips.append([_signed(sum(c)) for r in range(distance // 2 + 1) for c in combinations(free, r)])
    spark = members.sparkSession
    table = spark.createDataFrame([(t, f) for t, f in enumerate(flips)], "t int, flips array<bigint>")  # one row a mask
    spread = members.join(F.broadcast(table), "t").select("t", "a", F.explode("flips").alias("flip"))
    w = W.partitionBy("t", "variant")
    tied = spread.select("t", "a", F.col("a").bitwiseXOR(F.col("flip")).alias("variant")).select("a", F.min("a").over(w).alias("b"))
    return tied.filter("a <> b").distinct()


def links(values: DataFrame, distance: int = MAX_DISTANCE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at most ``distance`` bits apart."""
    if distance < 2 or distance % 2:
        raise ValueError("distance must be even and at least 2")
    masks = block_masks(values.count(), distance)
    keyed = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)]))
    rows = values.select("fp", keyed.alias("k")).select("k.t", "k.key", "fp")
    sorted_rows = rows.repartition("t", "key").sortWithinPartitions("t", "key", "fp")
    found = materialize(sorted_rows.mapInArrow(_compare_buckets(distance, max_bucket), "a bigint, b bigint, t int"))
    members = found.filter("t >= 0").select("t", "a").distinct()
    return found.filter("t < 0").select("a", "b").union(_variant_links(members, masks, distance))


def _components(prints: DataFrame, distance: int, max_bucket: int) -> DataFrame:
    """(fp, component_id) of every fingerprint in the checkpointed ``prints`` (id, row_hash, fp)."""
    values = materialize(prints.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = materialize(components(links(values, distance, max_bucket)))
    rooted = values.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id", "root")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = MAX_DISTANCE,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    prints = materialize(fingerprints(df, id_col, text_col, shingle))
    named = _components(prints, distance, max_bucket)
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = MAX_DISTANCE,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """Rows of ``df``, one of each component: the one with the smallest id (nulls last), then row hash."""
    prints = materialize(fingerprints(df, id_col, text_col, shingle))
    named = _components(prints, distance, max_bucket)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row_hash")
    # Rows of one fingerprint are reduced first, so a hot group meets as one row a task.
    first = prints.groupBy("fp").agg(F.min(order).alias("first"))
    chosen = first.join(named, "fp").groupBy("root").agg(F.min("first").alias("first"))
    copies = prints.groupBy("id", "row_hash").agg(F.count("*").alias("copies"))
    keys = chosen.select(F.col("first.id").alias("__llm_id"), F.col("first.row_hash").alias("__llm_hash"))
    same = (F.col("__llm_id").eqNullSafe(F.col("id"))) & (F.col("__llm_hash") == F.col("row_hash"))
    keys = materialize(keys.join(copies, same).select("__llm_id", "__llm_hash", F.col("copies").alias("__llm_copies")))
    rows = df.withColumn("__llm_row", F.xxhash64(F.col(id_col), F.col(text_col).cast("string")))
    kept = rows.join(keys, F.col("__llm_row") == F.col("__llm_hash")).filter(F.col(id_col).eqNullSafe(F.col("__llm_id")))
    once = kept.filter("__llm_copies = 1")
    repeated = kept.filter("__llm_copies > 1").dropDuplicates(["__llm_row"])
    return once.unionByName(repeated).select(*[F.col(f"`{c}`") for c in df.columns])
