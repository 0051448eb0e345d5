"""Typed profile of an attribute bag: every path of a JSON column with the types that stand there and how often."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.session import cut_lineage

_KINDS = {
    "BIGINT": "integer",
    "DOUBLE": "number",
    "FLOAT": "number",
    "STRING": "string",
    "BOOLEAN": "boolean",
    "VOID": "null",
}


def _kind(v: Column) -> Column:
    """The type's name; decimals without a fraction are integers that a bigint can't hold."""
    name = F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)
    whole = F.schema_of_variant(v).rlike(r"^DECIMAL\(\d+,0\)")
    out = F.when(name == "OBJECT", "object").when(name == "ARRAY", "array")
    out = out.when(name == "DECIMAL", F.when(whole, "integer").otherwise("number"))
    for spark_name, kind in _KINDS.items():
        out = out.when(name == spark_name, kind)
    return out.otherwise(F.lower(name))


def attribute_profile(df: DataFrame, bag: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group of ``by``, path and type: ``n_values``, and for numbers ``min_number`` and ``max_number``.

    Paths start at ``$``; ``.name`` steps into an object, ``[*]`` into any element of an array. The bag itself is path
    ``$``; a text that is no JSON counts there as ``invalid``, a null bag as ``missing``. A number without a fraction is an
    ``integer``, however it is written. Each level is summed in every task; objects and arrays below the first level are
    written, and nothing else, before they are opened for the next. Flat bags are read twice and nothing is written."""
    text = F.col(bag)
    keys = [f"_by{i}" for i in range(len(by))]
    parsed = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], text.alias("_text"))
    level = parsed.select(*keys, F.lit("$").alias("path"), F.try_parse_json("_text").alias("_v"), F.col("_text").isNull().alias("_none"))
    kind = F.when(F.col("_none"), "missing").when(F.col("_v").isNull(), "invalid").otherwise(_kind(F.col("_v")))
    level = level.select(*keys, "path", kind.alias("value_type"), "_v")
    spark, counts, depth = df.sparkSession, None, 0
    while True:
        number = F.when(F.col("value_type").isin("integer", "number"), F.try_variant_get("_v", "$", "double"))
        summed = level.groupBy(*keys, "path", "value_type").agg(
            F.count(F.lit(1)).alias("n_values"), F.min(number).alias("min_number"), F.max(number).alias("max_number")
        )
        # The sums are small and are looked at twice: for the answer, and for whether to go on.
        summed = cut_lineage(summed)
        counts = summed if counts is None else counts.unionByName(summed)
        holds = F.col("value_type").isin("object", "array")
        if summed.filter(holds).isEmpty():
            break
        inside = level.filter(holds)
        if depth:
            inside = cut_lineage(inside)
        opened = inside.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()).toDF("_pos", "_key", "_inner"))
        step = F.when(F.col("value_type") == "array", F.lit("[*]")).otherwise(F.concat(F.lit("."), F.col("_key")))
        level = opened.select(*keys, F.concat("path", step).alias("path"), F.col("_inner").alias("_v")).select(
            *keys, "path", _kind(F.col("_v")).alias("value_type"), "_v"
        )
        depth += 1
    return counts.select(
        *[F.col(k).alias(b) for b, k in zip(by, keys, strict=True)], "path", "value_type", "n_values", "min_number", "max_number"
    )
