"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code-point order (null last) get the weights in turn and share ``share`` of all
words; a target stops at ``max_copies`` times its source's words and the excess goes to the others
by weight until none is above.

Copies: inside a source a document is worth its length class c (the bit length of its word count),
and its expected copies are min(max_copies, k * c), with the k that makes the expected words of the
source meet its target. The whole part is certain. The fraction p is an inclusion probability:
documents are ranked by the odds of a uniform number (from a hash of id and size, so reruns agree)
divided by the odds of p, and taken in that order until the source's remaining words are reached;
the last one is taken if that comes nearer. Only its rank (one row a source) goes back to the rows.

Ranks are summed in bins before any are sorted, coarse ones first and then fine ones of the bin in
which a source's words run out, so that a source with a third of all rows is never sorted in one
task: only the fine bin that decides is. Tables by source,
or by source and class, are aggregates; the one over all sources is as long as the list of sources.

Defined results: a null text has size 0 and is taken as 0 words; null sources form one source; rows
equal in id and size share their rank and are taken or left together; an empty table gives an
empty result; other columns are ignored (``resample`` returns them unchanged).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abx.llm.common import WORD, bounded_broadcast, materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
SEED = "mix-1"
RANK_BINS = (1 << 8, 1 << 16)
# Plans up to this count of (source, class) rows are sent to every task; longer ones are joined by shuffling.
BROADCAST_PLANS = 100_000


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _class(size: Column) -> Column:
    """Bit length of the size; 1 for the empty text."""
    return F.length(F.bin(size))


def _uniform(id_text: Column, size: Column, seed: str) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(seed), id_text, size.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def _sized(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """``df`` with __llm_ columns: source, id_text, size, class and the uniform number."""
    out = df.withColumn("__llm_size", _size(F.col(text_col).cast("string")))
    out = out.withColumn("__llm_source", F.col(source_col).cast("string"))
    out = out.withColumn("__llm_id_text", F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    out = out.withColumn("__llm_class", _class(F.col("__llm_size")))
    return out.withColumn("__llm_u", _uniform(F.col("__llm_id_text"), F.col("__llm_size"), seed))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) a source."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights)) + 1)
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
    # The level at which capped shares sum up to all words is the largest of those that any prefix of
    # sources, in the order in which they reach their caps, would give to the rest.
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(F.lit(0))
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    s = s.withColumn("all", F.sum("source_size").over(every) * F.lit(share))
    s = s.withColumn("level", (F.col("all") - capped) / rest).withColumn("level", F.max("level").over(every))
    return s.select("source", "source_size", F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target"))


def _expected(classes: DataFrame, goals: DataFrame, max_copies: int) -> DataFrame:
    """(source, class) with source_size, target, whole copies, fraction p and the words left for fractions."""
    same = F.col("source").eqNullSafe(F.col("goal_source"))
    c = classes.join(goals.withColumnRenamed("source", "goal_source"), same).drop("goal_source")
    top = W.partitionBy("source").orderBy(F.col("class").desc())
    full = F.coalesce(F.sum(F.col("words")).over(top.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) * max_copies
    rest = F.sum(F.col("words") * F.col("class")).over(top.rowsBetween(0, W.unboundedFollowing))
    c = c.withColumn("k", F.when(rest > 0, (F.col("target") - full) / rest))
    one = W.partitionBy("source")
    c = c.withColumn("k", F.coalesce(F.max("k").over(one), F.lit(0.0)))
    copies = F.least(F.lit(float(max_copies)), F.greatest(F.col("k") * F.col("class"), F.lit(0.0)))
    c = c.withColumn("copies", copies).withColumn("whole", F.floor(F.col("copies") + 1e-9).cast("bigint"))
    c = c.withColumn("p", F.greatest(F.col("copies") - F.col("whole"), F.lit(0.0)))
    left = F.col("target") - F.sum(F.col("whole") * F.col("words")).over(one)
    return c.select("source", "class", "source_size", "target", "whole", "p", left.alias("left"))


def _rank(u: Column, p: Column) -> Column:
    """Odds of the uniform number over odds of inclusion, mapped from (0, inf) to (0, 1); null if p is 0."""
    q = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 0, q / (1 + q))


def plan(df: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple, share: float, max_copies: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """The sized rows (checkpointed, without texts) and the plan: one row a (source, class) with
    source_size, target, whole, p and the last rank taken (last_rank, last_size, last_id)."""
    sized = _sized(df, id_col, text_col, source_col, seed)
    names = ["source", "id_text", "size", "class", "u"]
    rows = materialize(sized.select(F.col(id_col).alias("id"), *[F.col(f"__llm_{n}").alias(n) for n in names]))
    classes = rows.groupBy("source", "class").agg(F.sum("size").alias("words"))
    sizes = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    expected = materialize(_expected(classes, targets(sizes, weights, share, max_copies), max_copies))
    ranked = _with_plan(rows, expected, ["source", "class"]).filter("p > 0 AND size > 0").withColumn("rank", _rank(F.col("u"), F.col("p")))
    inside = ranked.select("source", "id_text", "size", "rank", "left", F.lit(0).cast("bigint").alias("before"))
    for width in RANK_BINS:  # coarse bins of all ranks, then fine bins of the coarse one that decides
        inside = inside.withColumn("bin", F.floor(F.col("rank") * width))
        edge = materialize(_edge(inside))
        on = F.col("source").eqNullSafe(F.col("edge_source")) & (F.col("bin") == F.col("edge_bin"))
        inside = inside.drop("before").join(bounded_broadcast(edge, BROADCAST_PLANS), on)
        inside = inside.select("source", "id_text", "size", "rank", "left", "before")
    run = W.partitionBy("source").orderBy("rank", "size", "id_text").rowsBetween(W.unboundedPreceding, -1)
    inside = inside.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0)))
    taken = inside.filter(F.col("before") + F.col("size") / 2 <= F.col("left"))
    last = taken.groupBy("source").agg(F.max(F.struct("rank", "size", "id_text")).alias("last"))
    # A bin whose first row is one too many ends the source with the bins before it.
    stop = edge.join(last.withColumnRenamed("source", "last_source"), F.col("edge_source").eqNullSafe(F.col("last_source")), "left")
    stop = stop.select(
        "edge_source",
        F.coalesce("last.rank", F.col("edge_bin") / RANK_BINS[-1]).alias("last_rank"),
        F.coalesce("last.size", F.lit(-1)).alias("last_size"),
        F.coalesce("last.id_text", F.lit("")).alias("last_id"),
    )
    out = expected.join(stop, F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source", "left")
    return rows, materialize(out)


def _edge(ranked: DataFrame) -> DataFrame:
    """(edge_source, edge_bin, before): the bin in which a source's words run out (the last if they never
    do), and the words taken before it."""
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("left").alias("left"), F.first("before").alias("start"))
    w = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.col("start") + F.coalesce(F.sum("words").over(w), F.lit(0)))
    last = F.max_by(F.struct("bin", "before"), "bin").alias("edge")
    edge = bins.filter(F.col("before") <= F.col("left")).groupBy("source").agg(last)
    return edge.select(F.col("source").alias("edge_source"), F.col("edge.bin").alias("edge_bin"), "edge.before")


def _with_plan(rows: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the plan of their (source, class); ``keys`` are the rows' names of the two."""
    p = bounded_broadcast(plan, BROADCAST_PLANS).withColumnRenamed("source", "__llm_plan_source").withColumnRenamed("class", "__llm_plan_class")
    on = F.col(keys[0]).eqNullSafe(F.col("__llm_plan_source")) & (F.col(keys[1]) == F.col("__llm_plan_class"))
    return rows.join(p, on).drop("__llm_plan_source", "__llm_plan_class")


def _copies(whole: Column, p: Column, u: Column, size: Column, id_text: Column, last: str = "") -> Column:
    rank = F.struct(_rank(u, p), size, id_text)
    limit = F.struct(F.col(f"{last}last_rank"), F.col(f"{last}last_size"), F.col(f"{last}last_id"))
    chosen = (p > 0) & F.col(f"{last}last_rank").isNotNull() & (rank <= limit)
    return whole + F.when(chosen, F.lit(1)).otherwise(F.lit(0))


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken (words, repeats counted), copies."""
    rows, planned = plan(df, id_col, text_col, source_col, weights, share, max_copies, seed)
    out = _with_plan(rows, planned, ["source", "class"])
    copies = _copies(F.col("whole"), F.col("p"), F.col("u"), F.col("size"), F.col("id_text"))
    out = out.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("bigint"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def resample(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: rows of ``df``, each as often as it is taken."""
    _, planned = plan(df, id_col, text_col, source_col, weights, share, max_copies, seed)
    planned = planned.select("source", "class", *[F.col(c).alias(f"__llm_{c}") for c in ("whole", "p", "last_rank", "last_size", "last_id")])
    out = _with_plan(_sized(df, id_col, text_col, source_col, seed), planned, ["__llm_source", "__llm_class"])
    copies = _copies(F.col("__llm_whole"), F.col("__llm_p"), F.col("__llm_u"), F.col("__llm_size"), F.col("__llm_id_text"), "__llm_")
    out = out.filter("__llm_size > 0").withColumn("__llm_copies", copies.cast("int")).filter("__llm_copies > 0")
    out = out.withColumn("__llm_copy", F.explode(F.sequence(F.lit(1), F.col("__llm_copies"))))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), '') AS id_text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
r AS (
  SELECT *, length(bin(size)) AS class,
         (CAST('0x' || substr(md5('mix-1:' || id_text || ':' || size), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM sized),
classes AS (SELECT source, class, sum(size)::BIGINT AS words FROM r GROUP BY ALL),
weighted AS (
  SELECT source, sum(words)::BIGINT AS source_size, 2.0::DOUBLE * sum(words)::DOUBLE AS cap,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3) + 1] AS weight
  FROM classes GROUP BY source),
levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
goals AS (SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM levels),
steps AS (
  SELECT c.source, c.class, c.words, g.source_size, g.target,
         CASE WHEN sum(c.words * c.class) OVER (PARTITION BY c.source ORDER BY c.class DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) > 0
              THEN (g.target - 2 * coalesce(sum(c.words) OVER (PARTITION BY c.source ORDER BY c.class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                   / (sum(c.words * c.class) OVER (PARTITION BY c.source ORDER BY c.class DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE END AS k
  FROM classes c JOIN goals g ON c.source IS NOT DISTINCT FROM g.source),
copies AS (
  SELECT source, class, words, source_size, target,
         least(2.0::DOUBLE, greatest(coalesce(max(k) OVER (PARTITION BY source), 0.0::DOUBLE) * class, 0.0::DOUBLE)) AS copies
  FROM steps),
expected AS (
  SELECT *, floor(copies + 1e-9::DOUBLE)::BIGINT AS whole, greatest(copies - floor(copies + 1e-9::DOUBLE), 0) AS p,
         target - (sum(floor(copies + 1e-9::DOUBLE)::BIGINT * words) OVER (PARTITION BY source))::DOUBLE AS words_left
  FROM copies),
planned AS (
  SELECT r.*, e.source_size, e.target, e.whole, e.p, e.words_left,
         CASE WHEN e.p > 0 AND r.size > 0 THEN ((u / (1 - u)) / (e.p / (1 - e.p))) END AS q
  FROM r JOIN expected e ON r.source IS NOT DISTINCT FROM e.source AND r.class = e.class),
ranked AS (
  SELECT *, coalesce(sum(CASE WHEN q IS NOT NULL THEN size END) OVER (
              PARTITION BY source ORDER BY q / (1 + q) ASC NULLS LAST, size, id_text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM planned)
SELECT doc_id, size, source_size, target,
       (size * (CASE WHEN size > 0 THEN whole ELSE 0 END + CASE WHEN q IS NOT NULL AND before + size / 2.0::DOUBLE <= words_left THEN 1 ELSE 0 END))::BIGINT AS taken,
       (CASE WHEN size > 0 THEN whole ELSE 0 END + CASE WHEN q IS NOT NULL AND before + size / 2.0::DOUBLE <= words_left THEN 1 ELSE 0 END)::BIGINT AS copies
FROM ranked
"""
