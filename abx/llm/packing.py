"""Packing by power-of-two decomposition.

A document of n ids is cut into floor(n / max_len) pieces of ``max_len`` followed by one piece for
each set bit of the rest, longest first. Every piece is a sequence of its own: no sequence crosses
documents, none is padded, and a training batch takes sequences of one bucket (equal lengths).

Pieces of a document need nothing from other documents, so the operator is one pass without a
shuffle; ``write_buckets`` lays the sequences out by length.

Ids are those of the tokenizer's plain ``encode(text, add_special_tokens=False)``: an added token that stands
in a text is its one id.

Defined results: a null or empty text is the end id alone (one piece of length 1); a null id passes
through; repeated rows are packed once each; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.llm.bpe import byte_bpe
from abx.llm.common import slices

MAX_LEN = 1024
END_ID = 0


def piece_lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Power-of-two lengths whose sum is n, longest first; none exceeds ``max_len``."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << b for b in range(max_len.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_len: int = MAX_LEN,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket and,
    unless ``with_ids`` is off, the token ids themselves."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    end = np.asarray([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(tokenizer_path, plain_special=False)
        for batch, texts in slices(batches, "text"):
            rows, starts, lengths, crcs, totals, ids = [], [], [], [], [], []
            for row, text in enumerate(texts):
                data = encoder.ids(text.decode("utf-8", "replace")).astype("<u4").tobytes() + end
                total, start = len(data) // 4, 0
                for length in piece_lengths(total, max_len):
                    piece = data[4 * start : 4 * (start + length)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(length)
                    crcs.append(zlib.crc32(piece))
                    totals.append(total)
                    if with_ids:
                        ids.append(piece)
                    start += length
            cols = [batch.column("id").take(pa.array(rows, pa.int64()))]
            cols += [pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    cols = [
        F.col("id").alias(id_col),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    ]
    return out.select(*cols, *(["ids"] if with_ids else []))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write sequences with one folder per length, so that a reader draws batches of equal lengths."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)
