"""Merkle manifest of a table: one tree per group of rows, and a tree over the groups' roots.

A row's leaf is the digest of its values. Per group the leaves stand in order of their id, and every
``fanout`` consecutive nodes (the last run may be shorter, even a single node) become the digest of
their digests, until one node, the subroot, remains. The subroots in order of their group build the
root alike. Digests are lowercase hex SHA-256 and enter the next one as that text.

Siblings come from windows: nodes of a level stand on the rows of their first leaves, ``fanout**level``
rows apart, so lag and lead columns with fixed offsets, masked by a node's slot in its run and by the
run's length, bring the siblings, and first-child rows hash the parent. Windows run over blocks of
``fanout**BLOCK_LEVELS`` leaves, so a group of any size is many small partitions; the blocks' top nodes are
the leaves of the next round. Positions come from a range sort, with each partition's count added up.

Defined results: null values are leaves' ``-``; a null id stands first and is never tampered with; rows
repeated in every column are leaves of their own, equal ids stand in order of their leaves; an empty
text is ``0:``; a null group is a group of its own before all others; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abx.llm.common import bounded_broadcast, id_mod, materialize

FANOUT = 2
# Leaves of a window partition: fanout ** BLOCK_LEVELS.
BLOCK_LEVELS = 10
# Positions of at most this many runs (a range partition's part of a group) are broadcast.
MAX_RUNS = 100_000
TAMPER_MOD = 7
PATH = "array<struct<left:string,right:string>>"
VALUES = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts joined."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(values: dict[str, Column]) -> Column:
    return digest(*[field(v) for v in values.values()])


def fold(path: Column, start: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda acc, s: digest(s["left"], acc, s["right"]))


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows (with ``grp``) with their place ``pos`` in the group, from 0, and the group's size ``n``.

    Rows are range-partitioned by group and order, the row's place in the input last, so that neither a
    large group nor many equal rows end in one task.
    """
    keys = ["grp", *order, "tie"]
    at = F.monotonically_increasing_id()
    ranged = rows.withColumn("tie", at).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    ranged = materialize(ranged.withColumn("at", at).withColumn("part", F.shiftright("at", 33)))
    runs = ranged.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "grp",
        "part",
        (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("size").over(group).alias("n"),
    )
    runs = bounded_broadcast(materialize(runs), MAX_RUNS)
    return ranged.join(runs, ["grp", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _nodes_at(level: int, fanout: int) -> Column:
    """Nodes of the group at this level."""
    step = fanout**level
    return F.floor((F.col("n") + F.lit(step - 1)) / F.lit(step))


def climb(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Nodes (grp, pos, n, digest, ...) with their block, their ``path`` up to the block's top, and the ``top`` digest
    on the block's first row (null on others)."""
    span = fanout**levels
    nodes = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(span))).withColumn("node", F.col("digest"))
    run = Window.partitionBy("grp", "block").orderBy("pos")
    for level in range(levels):
        step = fanout**level
        count = _nodes_at(level, fanout)
        index = F.floor(F.col("pos") / F.lit(step))
        slot = F.pmod(index, F.lit(fanout))
        lags = [
            F.when(slot >= j, F.lag("node", j * step).over(run)).otherwise(F.lit("")) for j in range(fanout - 1, 0, -1)
        ]
        leads = [
            F.when((slot + j < fanout) & (index + j < count), F.lead("node", j * step).over(run)).otherwise(F.lit(""))
            for j in range(1, fanout)
        ]
        nodes = nodes.withColumns({"left": F.concat(*lags), "right": F.concat(*leads)})
        is_node = F.pmod(F.col("pos"), F.lit(step)) == 0
        first_child = F.pmod(F.col("pos"), F.lit(step * fanout)) == 0
        siblings = F.struct(F.when(count > 1, F.col("left")).alias("left"), F.col("right"))
        parent = F.when(count > 1, digest(F.col("node"), F.col("right"))).otherwise(F.col("node"))
        nodes = nodes.withColumns({f"s{level}": F.when(is_node, siblings), "node": F.when(first_child, parent)})
    # A leaf's sibling at a level stands on its ancestor's row, the last node row at or before its own.
    upto = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = [F.last(f"s{level}", ignorenulls=True).over(upto) for level in range(levels)]
    nodes = nodes.withColumns({f"s{level}": p for level, p in enumerate(path)})
    steps = F.array(*[F.col(f"s{level}") for level in range(levels)]).cast(PATH)
    out = nodes.withColumn("path", F.filter(steps, lambda s: s["left"].isNotNull())).withColumnRenamed("node", "top")
    return out.drop("left", "right", *[f"s{level}" for level in range(levels)])


def tree(nodes: DataFrame, fanout: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of ``climb`` from placed nodes up to one node a group: the climbed rounds, and (grp, digest) of the tops."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    rounds = []
    while True:
        height = 0  # of the largest group, so that no windows are planned above it
        while fanout**height < most and height < levels:
            height += 1
        rounds.append(climb(nodes, fanout, height))
        nodes = materialize(
            rounds[-1].filter(F.col("top").isNotNull()).select(
                "grp", F.col("block").alias("pos"), _nodes_at(height, fanout).alias("n"), F.col("top").alias("digest")
            )
        )
        most = -(-most // fanout**height)
        if most <= 1:
            return rounds, nodes.select("grp", "digest")


def manifest(
    df: DataFrame,
    id_col: str = "doc_id",
    value_cols: tuple[str, ...] = VALUES,
    group_col: str = "lang",
    fanout: int = FANOUT,
    block_levels: int = BLOCK_LEVELS,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``df``: id, ``leaf``, ``path`` (per level the digests left and right of the own one, from the
    leaf to the root), ``subroot``, ``root``, and the columns of ``carry``, which are computed on ``df``."""
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    group = F.col(group_col).cast("string")
    carry = carry or {}
    leaves = df.select(
        # A null group sorts before every other.
        F.coalesce(F.concat(F.lit("g"), group), F.lit("")).alias("grp"),
        F.col(id_col).alias("id"),
        leaf({c: F.col(c) for c in value_cols}).alias("digest"),
        *[c.alias(f"c{i}") for i, c in enumerate(carry.values())],
    )
    rounds, subroots = tree(positions(leaves, ["id", "digest"]), fanout, block_levels)
    # The groups are the leaves of one more tree, whose only group is the table.
    whole = positions(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), ["name"])
    over, root = tree(whole, fanout, block_levels)
    upper = root.select(
        "grp", F.lit(0).cast("bigint").alias("block"), F.col("digest").alias("root"), F.array().cast(PATH).alias("up")
    )

    def descend(climbed: DataFrame, upper: DataFrame) -> DataFrame:
        """Nodes with their path up to the root; equal paths above a block come from its top node."""
        return climbed.join(upper, ["grp", "block"]).withColumn("path", F.concat("path", "up")).drop("up", "block")

    def as_upper(nodes: DataFrame, *keep: str) -> DataFrame:
        return nodes.select("grp", F.col("pos").alias("block"), F.col("path").alias("up"), *keep)

    for climbed in reversed(over[1:]):
        upper = as_upper(descend(climbed, upper), "root")
    upper = descend(over[0], upper).select(
        F.col("name").alias("grp"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("path").alias("up"),
        "root",
        F.col("digest").alias("subroot"),
    )
    for climbed in reversed(rounds[1:]):
        upper = as_upper(descend(climbed, upper), "root", "subroot")
    out = descend(rounds[0], upper)
    return out.select(
        F.col("id").alias(id_col),
        F.col("digest").alias("leaf"),
        "path",
        "subroot",
        "root",
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(carry)],
    )


def report(df: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Proof of every document, and whether it still leads to the root after some documents were tampered with."""
    tampered = F.coalesce(id_mod(F.col("doc_id"), TAMPER_MOD) == 0, F.lit(False)) & F.col("doc_id").isNotNull()
    changed = {c: F.col(c) for c in VALUES} | {"n_chars": F.col("n_chars") + F.lit(1)}
    seen = F.when(tampered, leaf(changed))
    m = manifest(df, fanout=fanout, block_levels=block_levels, carry={"seen": seen})
    m = m.withColumn("folded_root", fold(F.col("path"), F.coalesce("seen", "leaf")))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return m.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof.cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR)))::VARCHAR || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# CRC-32 by its reflected polynomial; trees level by level.
ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
  FROM range(256) r(i)),
leaves AS (
  SELECT doc_id, coalesce('g' || lang, '') AS grp, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                                           lambda ch: ord(ch)::BIGINT)),
                                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {TAMPER_MOD} = 0
              THEN {_leaf_sql("(n_chars + 1)")} END AS seen
  FROM documents, crc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY grp) AS n FROM leaves),
up AS (
  SELECT grp, 0 AS lvl, pos AS idx, n, leaf AS d FROM placed
  UNION ALL
  SELECT grp, any_value(lvl) + 1, idx // 2, any_value((n + 1) // 2), sha256(string_agg(d, '' ORDER BY idx))
  FROM up WHERE n > 1 GROUP BY grp, idx // 2),
sub AS (
  SELECT grp, d AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
over_up AS (
  SELECT 0 AS lvl, pos AS idx, n, subroot AS d FROM sub
  UNION ALL
  SELECT any_value(lvl) + 1, idx // 2, any_value((n + 1) // 2), sha256(string_agg(d, '' ORDER BY idx))
  FROM over_up WHERE n > 1 GROUP BY idx // 2),
steps AS (
  SELECT p.grp, p.pos, u.lvl, CASE WHEN s.idx < u.idx THEN s.d ELSE '' END AS l, CASE WHEN s.idx > u.idx THEN s.d ELSE '' END AS r
  FROM placed p JOIN up u ON u.grp = p.grp AND u.idx = p.pos >> u.lvl AND u.n > 1
  LEFT JOIN up s ON s.grp = u.grp AND s.lvl = u.lvl AND s.idx = xor(u.idx, 1::BIGINT)
  UNION ALL
  SELECT p.grp, p.pos, 1000 + u.lvl, CASE WHEN s.idx < u.idx THEN s.d ELSE '' END, CASE WHEN s.idx > u.idx THEN s.d ELSE '' END
  FROM placed p JOIN sub b ON b.grp = p.grp JOIN over_up u ON u.idx = b.pos >> u.lvl AND u.n > 1
  LEFT JOIN over_up s ON s.lvl = u.lvl AND s.idx = xor(u.idx, 1::BIGINT)),
paths AS (
  SELECT grp, pos, list(struct_pack(l := l, r := r) ORDER BY lvl) AS path FROM steps GROUP BY grp, pos),
folded AS (
  SELECT p.grp, p.pos, 0::BIGINT AS k, coalesce(p.seen, p.leaf) AS d, coalesce(q.path, []) AS path
  FROM placed p LEFT JOIN paths q ON q.grp = p.grp AND q.pos = p.pos
  UNION ALL
  SELECT grp, pos, k + 1, sha256(path[k + 1].l || d || path[k + 1].r), path FROM folded WHERE k < len(path))
SELECT p.doc_id, p.leaf, b.subroot, o.d AS root,
       sha256(array_to_string(list_transform(f.path, lambda s: s.l || s.r), '')) AS proof_sha256,
       f.d AS folded_root, f.d = o.d AS verified
FROM placed p JOIN sub b ON b.grp = p.grp JOIN folded f ON f.grp = p.grp AND f.pos = p.pos AND f.k = len(f.path)
JOIN over_up o ON o.n = 1
"""
