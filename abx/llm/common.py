"""Helpers shared by the operators of this package.

Operators read only the columns they name, so extra columns of any name pass by untouched, and
columns that live next to user columns start with ``__llm_``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.session import cut_lineage

# Words are runs of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())

# Text handled at once inside a task; bounds the arrays a task holds next to its Arrow batch.
SLICE_BYTES = 2 << 20


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def id_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(m))


def binary_texts(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b or b"" for b in col.cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Return freed memory to the system: workers live on after a task, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batches with at most SLICE_BYTES of text (one longer text goes alone)."""
    batch = texts = ends = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = binary_texts(batch.column(text))
        ends = np.cumsum([len(t) for t in texts])
        a = 0
        while a < len(texts):
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield batch.slice(a, b - a), texts[a:b]
            a = b
    del batch, texts, ends
    give_back()



def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark a checkpointed table for broadcast only if its counted size is small; else Spark shuffles it."""
    return F.broadcast(df) if df.count() <= max_rows else df


def materialize(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder (survives lost executors)."""
    return cut_lineage(df)
