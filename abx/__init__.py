"""abx: controlled-experiment analytics as pure DataFrame -> DataFrame functions on Spark.

Layout
------
- ``abx.config``      frozen run parameters (windows, grace, names)
- ``abx.session``     SparkSession defaults and the checkpoint folder rule
- ``abx.sources``     Parquet/CSV readers, day-partition writer, the testdata lens
- ``abx.functions``   Column-level building blocks (time, statistics, status label)
- ``abx.operators``   dataset-level transforms (staging, dedupe, validation, outcomes, ...)
- ``abx.plans``       composed experiment DAG and the query registry
- ``abx.streaming``   incremental (micro-batch) runner for the daily quality job
"""

from abx.config import ExperimentConfig

__all__ = ["ExperimentConfig"]
