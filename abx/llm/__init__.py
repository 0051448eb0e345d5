"""Operators of a training-data pipeline, each a Spark job over whole tables.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it is present.
"""
