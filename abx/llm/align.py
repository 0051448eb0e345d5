"""Alignment of two tokenizers over the same texts, by interval coalescing.

Both tokenizers' tokens are byte ranges of the same bytes. All ranges of a slice of documents are sorted by
start at once, the running maximum of their ends is accumulated, and a group breaks where a start reaches that
maximum: there both tokenizers end a token. Overlapping pairs expand within the groups. How often two
ids overlap in the whole corpus ranks the pairs of each B id.

The first pass encodes every text and writes the ids (one row a document) beside the tasks' sums of pairs. Pairs are
counted by Spark. The second pass aligns the written ids again, now with the counts: tasks get at most
``MAX_PAIRS`` of them, those over that share of all links; links of rarer pairs are joined with their
counts, and as such a pair is rare, its links are no hot key.

Defined results: null and empty texts, and texts whose tokens do not spell a space and the text (a normalising
tokenizer), have no tokens, zeros and an empty digest; a null id passes through; repeated rows count and are
returned once each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.llm.bpe import byte_bpe, token_bytes
from abx.llm.common import give_back, materialize, slices
from abx.session import ensure_checkpoint_dir

# Pair counts that go to the tasks: no more pairs than this can hold 1 / MAX_PAIRS of all links each.
MAX_PAIRS = 1 << 20
# Distinct pairs of a task are summed in memory up to this many, then handed on.
PENDING_PAIRS = 1 << 21
SPACE = "▁"


class Pieces:
    """Ids of a sentencepiece model, and each id's bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self.model.is_control(i) or self.model.is_unknown(i):
            return b""
        return piece.replace(SPACE, " ").encode()

    def ids(self, text: str) -> np.ndarray:
        return np.asarray(self.model.encode(text, num_threads=1), np.uint32)


class Words:
    """Ids of a byte-level BPE file over a space and the text, and each id's bytes."""

    def __init__(self, path: str):
        self.encoder = byte_bpe(path, plain_special=True)
        self.bytes = token_bytes(path)

    def ids(self, text: str) -> np.ndarray:
        return self.encoder.ids(" " + text)

    def spell(self, text: str, ids: np.ndarray) -> bytes:
        """Bytes of the text's ids. Merges of bytes alone, without a normaliser, keep every byte."""
        if self.encoder.fast is not None:
            return b" " + text.encode()
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


_sides: dict[tuple[str, str], tuple[Words, Pieces]] = {}


def sides(a_path: str, b_path: str) -> tuple[Words, Pieces]:
    """Both tokenizers, once a process."""
    if (a_path, b_path) not in _sides:
        _sides[a_path, b_path] = Words(a_path), Pieces(b_path)
    return _sides[a_path, b_path]


def encode_pair(words: Words, pieces: Pieces, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids of both sides, or none where a side does not spell a space and the text."""
    none = np.zeros(0, np.uint32)
    if not data:
        return none, none
    text, whole = data.decode("utf-8", "replace"), b" " + data
    a, b = words.ids(text), pieces.ids(text)
    ok = words.spell(text, a) == whole and b"".join(map(pieces.bytes.__getitem__, b.tolist())) == whole
    return (a, b) if ok else (none, none)


@dataclass
class Alignment:
    """Tokens and links of a slice of documents; documents are numbered within it."""

    doc_of_group: np.ndarray
    # Tokens in output order: by group, A before B.
    ids: np.ndarray
    # 0: same side and group go on, 1: B side follows, 2: a new group follows, 3: the document ends.
    follows: np.ndarray
    # Per link the indexes of its tokens.
    link_a: np.ndarray
    link_b: np.ndarray


def coalesce(a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray, docs_a: np.ndarray) -> Alignment:
    """Groups and links of the tokens ``a`` and ``b`` of consecutive documents with ``len_*`` bytes each; ``docs_a``
    numbers the documents of the A tokens. Both sides of every document cover the same bytes."""
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    start_a, start_b = end_a - len_a, end_b - len_b
    side = np.repeat(np.array([0, 1], np.int8), [len(a), len(b)])
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.cumsum(breaks) - 1
    # The first token of a group is one of A, as A sorts first and all groups start on both sides.
    doc_of_group = docs_a[order[breaks]]
    group_of = np.empty(len(order), np.int64)
    group_of[order] = group
    of_a, of_b = group_of[: len(a)], group_of[len(a) :]
    upto_a, upto_b = (np.cumsum(np.bincount(g, minlength=len(doc_of_group))) for g in (of_a, of_b))
    # A token's place among all: after the other side's tokens of earlier groups, for B also of its own.
    place = np.concatenate([np.arange(len(a)) + np.append(0, upto_b)[of_a], np.arange(len(b)) + upto_a[of_b]])
    ids, follows = np.empty(len(order), np.int64), np.zeros(len(order), np.int8)
    ids[place] = np.concatenate([a, b])
    follows[upto_a + np.append(0, upto_b)[:-1] - 1] = 1
    last_in_doc = np.append(doc_of_group[1:] != doc_of_group[:-1], True)[: len(doc_of_group)]
    follows[upto_a + upto_b - 1] = np.where(last_in_doc, 3, 2)
    # A token of B overlaps the A tokens from the first that ends after its start to the last that starts before its end.
    first = np.searchsorted(end_a, start_b, side="right")
    count = np.searchsorted(start_a, end_b, side="left") - first
    link_b = np.repeat(np.arange(len(b)), count)
    link_a = np.arange(len(link_b)) + np.repeat(first - (np.cumsum(count) - count), count)
    return Alignment(doc_of_group, ids, follows, link_a, link_b)


class Slice:
    """Aligned documents of a slice, whose ids are given per document."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], size_a: np.ndarray, size_b: np.ndarray):
        self.n = len(a)
        self.n_a, self.n_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
        flat_a = np.concatenate([np.zeros(0, np.int64), *a]).astype(np.int64)
        flat_b = np.concatenate([np.zeros(0, np.int64), *b]).astype(np.int64)
        docs = np.arange(self.n)
        found = coalesce(flat_a, flat_b, size_a[flat_a], size_b[flat_b], np.repeat(docs, self.n_a))
        self.found = found
        self.n_groups = np.bincount(found.doc_of_group, minlength=self.n)
        self.link_doc = np.repeat(docs, self.n_b)[found.link_b]
        self.n_links = np.bincount(self.link_doc, minlength=self.n)
        # A pair's key; ids are below 2 ** 32.
        self.keys = flat_a[found.link_a] << 32 | flat_b[found.link_b]

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Exact sums of a value a link (links stand in order of documents)."""
        upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        ends = np.cumsum(self.n_links)
        return upto[ends] - upto[ends - self.n_links]

    def group_texts(self, texts: list[str]) -> list[str]:
        """Per document ``a1,a2|b1;a3|b2``; ``texts`` holds each id with each of the four marks behind it."""
        codes = (self.found.ids * 4 + self.found.follows).tolist()
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append("".join(map(texts.__getitem__, codes[at : at + n])))
            at += n
        return out


def _marked(n_ids: int) -> list[str]:
    return [f"{i}{mark}" for i in range(n_ids) for mark in (",", "|", ";", "")]


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    all_keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(all_keys), np.int64)
    np.add.at(sums, inverse, np.concatenate(counts))
    return all_keys, sums


def _sizes(side: Words | Pieces) -> np.ndarray:
    return np.array([len(x) for x in side.bytes], np.int64)


def _ids_column(ids: list[np.ndarray], kind: str) -> pa.Array:
    return pa.array([x.astype(kind).tobytes() for x in ids], pa.binary())


def _kind(side: Words | Pieces) -> str:
    """Little-endian storage type of an id."""
    return "<u2" if len(side.bytes) <= 1 << 16 else "<u4"


def encode(df: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """Written table: a row a document (key, id, a, b: ids in little-endian bytes), and rows (pair, n) with links
    counted per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pieces = sides(a_path, b_path)
        size_a, size_b, kind_a, kind_b = _sizes(words), _sizes(pieces), _kind(words), _kind(pieces)
        keys, counts = [], []
        id_type = None

        def pairs() -> Iterator[pa.RecordBatch]:
            found, sums = _merge(keys, counts)
            for at in range(0, len(found), 1 << 16):
                part, n = found[at : at + (1 << 16)], sums[at : at + (1 << 16)]
                none = [pa.nulls(len(part), t) for t in (pa.int64(), id_type, pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*none, pa.array(part), pa.array(n)], names=names)

        names = ["key", "id", "a", "b", "pair", "n"]
        for batch, texts in slices(batches, "text"):
            id_type = batch.column("id").type
            both = [encode_pair(words, pieces, t) for t in texts]
            a, b = [x for x, _ in both], [x for _, x in both]
            part = Slice(a, b, size_a, size_b)
            found, n = np.unique(part.keys, return_counts=True)
            keys.append(found)
            counts.append(n)
            if sum(map(len, keys)) > PENDING_PAIRS:
                merged = _merge(keys, counts)
                keys, counts = [merged[0]], [merged[1]]
                if len(merged[0]) > PENDING_PAIRS // 2:
                    yield from pairs()
                    keys, counts = [], []
            rows = [batch.column("key"), batch.column("id"), _ids_column(a, kind_a), _ids_column(b, kind_b)]
            none = [pa.nulls(len(texts), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([*rows, *none], names=names)
        if keys:
            yield from pairs()
        keys = counts = None
        give_back()

    id_type = df.schema[id_col].dataType.simpleString()
    docs = df.select(
        F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/align-{uuid.uuid4().hex}"
    out = docs.mapInArrow(run, f"key bigint, id {id_type}, a binary, b binary, pair bigint, n bigint")
    out.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def pair_counts(encoded: DataFrame) -> DataFrame:
    """Links of each pair of ids in the corpus: pair, n, b_id, best (the highest n of the B id)."""
    counts = encoded.filter("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("b_id", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    best = counts.groupBy("b_id").agg(F.max("n").alias("best"))
    return materialize(counts.join(best, "b_id"))


def align(
    df: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_pairs: int = MAX_PAIRS,
    with_groups: bool = False,
) -> DataFrame:
    """One row a document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and the groups' text itself
    if ``with_groups``."""
    encoded = encode(df, a_path, b_path, id_col, text_col)
    counts = pair_counts(encoded)
    stats = counts.agg(F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("links")).first()
    # At most max_pairs pairs pass: all of them, or those with more than that share of all links.
    least = 1 if stats.pairs <= max_pairs else -(-stats.links // max_pairs)
    frequent = counts.filter(F.col("n") >= least).select("pair", "n", "best").toArrow().sort_by("pair")
    known = df.sparkSession.sparkContext.broadcast([frequent.column(c).to_numpy() for c in ("pair", "n", "best")])
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    text_columns = ["groups_sha256"] + ["groups"] * with_groups
    names = ["key", "id", *columns, *text_columns, "pair", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pieces = sides(a_path, b_path)
        size_a, size_b, kind_a, kind_b = _sizes(words), _sizes(pieces), _kind(words), _kind(pieces)
        marked = _marked(max(len(size_a), len(size_b)))
        pair, n, best = known.value
        for batch in batches:
            a_all, b_all = (batch.column(c).to_pylist() for c in ("a", "b"))
            ends = np.cumsum([len(x) for x in a_all])
            at = 0
            while at < len(a_all):
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), side="right")))
                a = [np.frombuffer(x, kind_a) for x in a_all[at:upto]]
                b = [np.frombuffer(x, kind_b) for x in b_all[at:upto]]
                yield from rows(batch.slice(at, upto - at), Slice(a, b, size_a, size_b), marked, pair, n, best)
                at = upto
        give_back()

    def rows(batch, part: Slice, marked, pair, n, best) -> Iterator[pa.RecordBatch]:
        found, inverse = np.unique(part.keys, return_inverse=True)
        at = np.minimum(np.searchsorted(pair, found), max(len(pair) - 1, 0))
        is_known = pair[at] == found if len(pair) else np.zeros(len(found), bool)
        count = np.where(is_known, n[at], 0) if len(pair) else np.zeros(len(found), np.int64)
        is_best = is_known & (count == best[at]) if len(pair) else is_known
        texts = part.group_texts(marked)
        shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
        values = [part.n_a, part.n_b, part.n_groups, part.n_links, part.per_doc(is_best[inverse]), part.per_doc(count[inverse])]
        arrays = [batch.column("key"), batch.column("id"), *[pa.array(v, pa.int64()) for v in values], pa.array(shas, pa.string())]
        if with_groups:
            arrays.append(pa.array(texts, pa.string()))
        yield pa.RecordBatch.from_arrays([*arrays, *[pa.nulls(part.n, pa.int64())] * 2], names=names)
        rare = ~is_known[inverse]
        if rare.any():
            both = np.stack([part.link_doc[rare], part.keys[rare]])
            (doc, key), times = np.unique(both, axis=1, return_counts=True)
            none = [pa.nulls(len(doc), t) for t in [pa.int64()] * len(columns) + [pa.string()] * len(text_columns)]
            cols = [batch.column("key").take(pa.array(doc)), pa.nulls(len(doc), batch.column("id").type), *none]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(key), pa.array(times, pa.int64())], names=names)

    id_type = encoded.schema["id"].dataType.simpleString()
    schema = f"key bigint, id {id_type}, " + ", ".join(f"{c} bigint" for c in columns)
    schema += "".join(f", {c} string" for c in text_columns) + ", pair bigint, times bigint"
    docs = encoded.filter("key IS NOT NULL").select("key", "id", "a", "b").mapInArrow(run, schema)
    if least > 1:
        docs = _with_rare(materialize(docs), counts.filter(F.col("n") < least), columns, text_columns)
    return docs.select(F.col("id").alias(id_col), *columns, *text_columns)


def _with_rare(rows: DataFrame, counts: DataFrame, columns: list[str], text_columns: list[str]) -> DataFrame:
    """Add the links of rare pairs to their documents."""
    links = rows.filter("pair IS NOT NULL").select("key", "pair", "times")
    links = links.join(counts.select("pair", "n", "best"), "pair")
    added = links.select(
        "key",
        F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(F.lit(0)).alias("n_best"),
        (F.col("n") * F.col("times")).alias("count_sum"),
    )
    docs = rows.filter("pair IS NULL").select("key", "id", *columns, *text_columns)
    both = docs.unionByName(added, allowMissingColumns=True).groupBy("key")
    firsts = [F.first(c, ignorenulls=True).alias(c) for c in ("id", *columns[:4], *text_columns)]
    return both.agg(*firsts, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
