"""Readers and writers.

- ``read_table``       one Parquet table of a data folder (columnar scan; pruning/pushdown by Catalyst)
- ``read_day``         one ``dt=YYYY-MM-DD`` folder of a partitioned table
- ``read_seed_csv``    CSV seed with a declared schema (no inference)
- ``write_day``        idempotent overwrite of one day (also by an empty result), or of the days present
- ``materialize``      table or temp view
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, base: str, name: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_day(spark: SparkSession, base: str, table: str, dt: str, schema: StructType | None = None) -> DataFrame:
    """One day of a ``partitionBy("dt")`` table: only its own folder is listed and opened. A day that has no
    folder, or no file in it, is an empty table with the columns of the others."""
    path = f"{base.rstrip('/')}/{table}"
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.option("basePath", path).parquet(f"{path}/dt={dt}")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", path).parquet(path).where(F.col("dt") == F.lit(dt))


def read_days(spark: SparkSession, base: str, table: str, first: str | None, last: str | None) -> DataFrame:
    """The days from ``first`` to ``last`` (both included; open if None); other folders are pruned."""
    path = f"{base.rstrip('/')}/{table}"
    df = spark.read.option("basePath", path).parquet(path)
    if first is not None:
        df = df.where(F.col("dt") >= F.lit(first))
    return df.where(F.col("dt") <= F.lit(last)) if last is not None else df


def read_seed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def write_day(
    df: DataFrame,
    base: str,
    table: str,
    partition_cols: Iterable[str] = ("dt",),
    max_records_per_file: int = 5_000_000,
    dt: str | None = None,
) -> None:
    """Overwrite the folder of day ``dt``, also if ``df`` is empty; without ``dt``, only the partitions
    present in ``df`` (dynamic partition overwrite). Both are idempotent.

    No repartition by the partition column: a run usually covers one day, and hashing by ``dt``
    would send the whole day to one task. Every upstream task writes its own file into the day's
    folder instead (AQE has already coalesced small tasks), and ``maxRecordsPerFile`` bounds file
    size. The partition column lives in the path only, so reading back cannot clash with it.
    """
    path = f"{base.rstrip('/')}/{table}"
    writer = df.drop("dt") if dt is not None else df
    out = writer.write.mode("overwrite").option("maxRecordsPerFile", int(max_records_per_file))
    if dt is not None:
        out.parquet(f"{path}/dt={dt}")
    else:
        out.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path)


def materialize(df: DataFrame, name: str, as_table: bool = False) -> DataFrame:
    if as_table:
        df.write.mode("overwrite").saveAsTable(name)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
