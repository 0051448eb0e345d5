"""Two versions of a table compared by digest trees, so that only buckets that differ are read row by row.

Rows fall in buckets by a hash of their key; a bucket's digest is a count and two sums of row hashes, so neither the order
of rows nor their partitioning matters, and repeats don't cancel out. Digests are combined in every task and can be stored
beside a version. Comparing goes from the root down: equal nodes end the search below them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = (0, 8, 16)  # bits of the bucket number by level: root, branches, leaves
DIGEST = ("n_rows", "digest_a", "digest_b")
# Leaf numbers that differ are at most 2 ** BITS[-1] = 65,536 rows of 8 bytes: safe to broadcast at any table size.
_WIDE = "decimal(38,0)"


def _hash(seed: int, cols: Sequence[str]) -> Column:
    """Nulls are flagged: by itself the hash passes over them, and would take (a, null) for (null, a)."""
    flagged = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *flagged)


def _leaf(key: Sequence[str]) -> Column:
    return F.pmod(_hash(0, key), F.lit(1 << BITS[-1])).cast("long")


def _digest(cols: Sequence[str], when: Column | None = None) -> list[Column]:
    pick = (lambda c: F.when(when, c)) if when is not None else (lambda c: c)
    zero = F.lit(0).cast(_WIDE)
    return [
        F.count(pick(F.lit(1))),
        F.coalesce(F.sum(pick(_hash(1, cols).cast("decimal(20,0)"))).cast(_WIDE), zero),
        F.coalesce(F.sum(pick(_hash(2, cols).cast("decimal(20,0)"))).cast(_WIDE), zero),
    ]


def digest_tree(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``level``, ``node``, ``n_rows``, ``digest_a``, ``digest_b`` of every node that holds a row: at most 65,536 leaves, 256
    branches and the root. An empty table has no node."""
    cols = sorted(df.columns)
    leaves = df.groupBy(_leaf(key).alias("_leaf")).agg(*[c.alias(n) for c, n in zip(_digest(cols), DIGEST, strict=True)])
    levels = F.array(*[
        F.struct(F.lit(i).alias("level"), F.shiftright(F.col("_leaf"), BITS[-1] - b).alias("node")) for i, b in enumerate(BITS)
    ])
    nodes = leaves.select(F.inline(levels), *DIGEST)
    return nodes.groupBy("level", "node").agg(*[F.sum(c).cast(_WIDE if c != "n_rows" else "long").alias(c) for c in DIGEST])


def differing_leaves(old_tree: DataFrame, new_tree: DataFrame) -> DataFrame:
    """``leaf``: numbers of leaf buckets whose digests differ, found from the root down."""
    both = old_tree.select("level", "node", F.lit(-1).alias("_side"), *DIGEST).unionByName(
        new_tree.select("level", "node", F.lit(1).alias("_side"), *DIGEST)
    )
    signed = [F.sum(F.when(F.col("_side") > 0, F.col(c)).otherwise(-F.col(c))) for c in DIGEST]
    differ = reduce(lambda a, b: a | b, [s != 0 for s in signed])
    nodes = both.groupBy("level", "node").agg(differ.alias("_differ")).filter("_differ").drop("_differ")
    found = nodes.filter("level = 0").select(F.col("node").alias("leaf"))
    for level in range(1, len(BITS)):
        up = BITS[level] - BITS[level - 1]
        children = nodes.filter(F.col("level") == level).select(F.col("node").alias("_child"))
        found = children.join(found, F.shiftright(F.col("_child"), up) == F.col("leaf"), "left_semi").select(
            F.col("_child").alias("leaf")
        )
    return found


def version_diff(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    old_tree: DataFrame | None = None,
    new_tree: DataFrame | None = None,
) -> DataFrame:
    """Keys that were ``added``, ``removed`` or ``changed`` (``change``) from ``old`` to ``new``, with their rows before and
    after (``old_rows``, ``new_rows``). Trees that were stored are given; else they are made here. A key may repeat: it
    has changed if its rows, taken as a bag, have. Null keys are keys like any other. Equal versions move no row."""
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError(f"columns differ: {sorted(old.columns)} and {sorted(new.columns)}")
    cols = sorted(old.columns)
    old_tree = digest_tree(old, key) if old_tree is None else old_tree
    new_tree = digest_tree(new, key) if new_tree is None else new_tree
    leaves = F.broadcast(differing_leaves(old_tree, new_tree).withColumnRenamed("leaf", "__leaf"))
    kept = [
        df.select(*cols, F.lit(side).alias("__new")).join(leaves, _leaf(key) == F.col("__leaf"), "left_semi")
        for df, side in ((old, False), (new, True))
    ]
    was, is_now = ~F.col("__new"), F.col("__new")
    names = [f"__{t}{i}" for t in ("o", "n") for i in range(3)]
    rows = kept[0].unionByName(kept[1]).groupBy(*key).agg(
        *[c.alias(n) for c, n in zip([*_digest(cols, was), *_digest(cols, is_now)], names, strict=True)]
    )
    same = (F.col("__o0") == F.col("__n0")) & (F.col("__o1") == F.col("__n1")) & (F.col("__o2") == F.col("__n2"))
    change = F.when(F.col("__o0") == 0, "added").when(F.col("__n0") == 0, "removed").otherwise("changed")
    return rows.filter(~same).select(*key, change.alias("change"), F.col("__o0").alias("old_rows"), F.col("__n0").alias("new_rows"))
