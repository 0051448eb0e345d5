"""Identity stitching: units that share an identifier (a device, an account) are one person.

Every identifier ties its units to the smallest of them, and the ties are contracted round by round: each unit joins the
neighbour, or itself, that comes first in a new pseudo-random order of the round, so the ties left shrink by a constant
share a round whatever the shape, chains included. Minima are combined in every task, and all
joins on a unit or a group, which may be hot, are spread. The person's id is the smallest unit id of the component, so it
does not depend on rounds, partitions or order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.functions.skew import ROWS_PER_TASK, spread_join
from abx.session import cut_lineage

# Every round leaves at most three quarters of the nodes in expectation: far more rounds than any table needs.
MAX_ROUNDS = 200


def shared_identifiers(links: DataFrame, max_units: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Links (unit_id, identifier) without those of identifiers that more than ``max_units`` units share (a kiosk, a test
    account): they tie no one together."""
    links = cut_lineage(links.select("unit_id", "identifier").distinct())
    counts = links.groupBy("identifier").agg(F.count(F.lit(1)).alias("_units"))
    return spread_join(links, counts, "identifier", rows_per_task=rows_per_task).filter(F.col("_units") <= max_units).drop("_units")


def components(ties: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(node, root) of the nodes of the undirected ties (a, b); ``root`` is the component's smallest node."""
    edges = cut_lineage(
        ties.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        if len(rounds) >= MAX_ROUNDS:
            raise RuntimeError(f"ties were not contracted in {MAX_ROUNDS} rounds")
        # A new order a round: the hash of the node with the round's number.
        turn = F.lit(len(rounds))
        both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e")).select("e.*")
        first = both.groupBy("node").agg(F.min(F.struct(F.xxhash64("other", turn).alias("h"), F.col("other").alias("rep"))).alias("best"))
        own = F.struct(F.xxhash64("node", turn).alias("h"), F.col("node").alias("rep"))
        reps = cut_lineage(first.select("node", F.least(F.col("best"), own)["rep"].alias("rep")))
        rounds.append(reps)
        for end in ("a", "b"):
            to = reps.select(F.col("node").alias(end), F.col("rep").alias("_rep"))
            edges = spread_join(edges, to, end, rows_per_task=rows_per_task).drop(end).withColumnRenamed("_rep", end)
            if end == "a":
                edges = cut_lineage(edges)
        edges = cut_lineage(
            edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root"))
    # From the last round back: where a representative itself went on to.
    label = rounds[-1]
    for reps in reversed(rounds[:-1]):
        to = label.select(F.col("node").alias("rep"), F.col("rep").alias("_further"))
        label = spread_join(reps, to, "rep", "left", rows_per_task)
        label = cut_lineage(label.select("node", F.coalesce("_further", "rep").alias("rep")))
    smallest = label.groupBy("rep").agg(F.min("node").alias("root"))
    return spread_join(label, smallest, "rep", rows_per_task=rows_per_task).select("node", "root")


def stitched_ids(
    units: DataFrame, links: DataFrame, max_units: int | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """One row a unit of ``units`` or ``links``: unit_id, ``person_id`` (the smallest unit id it is tied to, itself included)
    and ``n_units`` of the person. Null units and identifiers tie nothing; ``max_units`` as in ``shared_identifiers``."""
    links = links.filter("unit_id IS NOT NULL AND identifier IS NOT NULL").select("unit_id", "identifier").distinct()
    every = units.select("unit_id").unionByName(links.select("unit_id")).filter("unit_id IS NOT NULL").distinct()
    links = shared_identifiers(links, max_units, rows_per_task) if max_units is not None else links
    links = cut_lineage(links)
    hubs = links.groupBy("identifier").agg(F.min("unit_id").alias("a"))
    ties = spread_join(links, hubs, "identifier", rows_per_task=rows_per_task).select("a", F.col("unit_id").alias("b"))
    found = components(ties, rows_per_task).withColumnRenamed("node", "unit_id")
    ids = cut_lineage(every.join(found, "unit_id", "left").select("unit_id", F.coalesce("root", "unit_id").alias("person_id")))
    sizes = ids.groupBy("person_id").agg(F.count(F.lit(1)).alias("n_units"))
    return spread_join(ids, sizes, "person_id", rows_per_task=rows_per_task).select("unit_id", "person_id", "n_units")


def stitched_assignments(canonical: DataFrame, ids: DataFrame) -> DataFrame:
    """Canonical assignments restated by person: the earliest of the person's units in the experiment, how many units and
    variants the person came with, and whether those variants conflict."""
    a = canonical.join(ids.select("unit_id", "person_id"), "unit_id", "left")
    a = a.withColumn("person_id", F.coalesce("person_id", "unit_id"))
    by_person = a.groupBy("experiment_id", "person_id").agg(
        F.min(
            F.struct(
                F.col("assigned_at").isNull().alias("_no_time"), F.col("assigned_at"), F.col("variant_id"), F.col("unit_id")
            )
        ).alias("first"),
        F.count(F.lit(1)).alias("n_units"),
        F.count_distinct("variant_id").alias("n_variants"),
    )
    return by_person.select(
        "experiment_id",
        "person_id",
        "first.unit_id",
        "first.variant_id",
        "first.assigned_at",
        "n_units",
        "n_variants",
        (F.col("n_variants") > 1).alias("is_conflicted"),
    )
