"""Language-model scoring by prediction by partial matching, pretrained on the corpus.

The trie holds byte contexts of up to ORDER bytes with the counts of the bytes that follow them in
the training texts (A-Z lower-cased; byte 255, which UTF-8 never uses, stands before and after each
text). A text's code length is the sum over its bytes of the prediction of the longest known
context; a byte not seen there costs an escape (method D: half a count of every follower goes to it),
after which the next shorter context predicts among the bytes not yet excluded.

Counting: every task counts the (ORDER + 1)-grams of its texts with a sort, Spark adds them up, and
shorter contexts are sums over their extensions. All counts stay, however rare: they are tables, and
no node of the trie has to fit anywhere. The SHARED most frequent longest nodes go to every task with
their predictions, where whole blocks of text are scored by array lookups. Positions that are not
among them are looked up by a join with all longest nodes; those whose gram no training text holds
walk down the shorter contexts, by joins again, once for each different gram. (A caller can ask for a
smaller model by ``nodes``: it drops nodes of under 1 / nodes of all positions, whose counts stay in
their context as escapes.) ``build_trie`` and ``score_texts`` are the same model in memory, for counts
that fit there.

Beside it stands a base score by smoothed word counts. Words that make up 1 / WORDS of all tokens or
more (at most WORDS of them, with WORDS times the mean word length of bytes in all) are sent to the
tasks; all rarer words are looked up by a join.

Defined results: null texts are empty (only their end is scored); a null id counts as the empty text
in the training split and passes through; repeated rows are scored alike and count as often as they
occur; without training texts all counts are 0 and every byte is equally likely; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abx.llm.common import LOWER_BYTES, id_mod, materialize, slices

ORDER = 5
SHARED = 1 << 21
WORDS = 1 << 18
HELD_OUT_MOD, HELD_OUT_REST = 7, 2
# Taken from the count of each follower and given to the escape.
DISCOUNT = 0.5
EDGE = 255
SYMBOLS = 256
# Partial counts that a task holds before it hands them on.
TASK_WORDS = 400_000
TASK_GRAMS = 2_000_000
_HASH = np.uint64(0x9E3779B97F4A7C15)
_EIGHT = np.uint64(8)


def _mask(n_bytes: int) -> np.uint64:
    return np.uint64((1 << 8 * n_bytes) - 1)


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, text numbers) of all positions of the texts and their ends: ``order`` bytes of context
    and the byte itself, as one integer."""
    pad = bytes([EDGE]) * order
    data = np.frombuffer(b"".join(pad + t.translate(LOWER_BYTES) + pad[:1] for t in texts) if order else b"".join(t.translate(LOWER_BYTES) + bytes([EDGE]) for t in texts), np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    key = np.zeros(len(data) - order, np.uint64)
    for i in range(order + 1):
        key <<= _EIGHT
        key |= data[i : len(data) - order + i]
    at = np.ones(len(key), bool)
    ends = np.cumsum(sizes + order)
    for step in range(order):  # windows that end in the next text's pad
        at[(ends[:-1] - order + step)[ends[:-1] - order + step < len(key)]] = False
    return key[at], np.repeat(np.arange(len(texts)), sizes)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def count(train: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, word, n): summed counts of (order + 1)-grams (word null) and of words (gram null; the
    empty word is a text's end) over all rows of ``train`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def emit(grams=None, words=None, n=()) -> pa.RecordBatch:
            size = len(n)
            g = pa.nulls(size, pa.int64()) if grams is None else pa.array(grams.view(np.int64))
            w = pa.nulls(size, pa.binary()) if words is None else pa.array(words, pa.binary())
            return pa.RecordBatch.from_arrays([g, w, pa.array(n, pa.int64())], names=["gram", "word", "n"])

        for _, texts in slices(batches, "text"):
            for t in texts:
                words.update(t.translate(LOWER_BYTES).split())
            words[b""] += len(texts)
            parts.append(np.unique(grams(texts, order)[0], return_counts=True))
            held += len(parts[-1][0])
            if held > TASK_GRAMS:
                parts = [_merge(parts)]
                held = len(parts[0][0])
                if held > TASK_GRAMS // 2:
                    yield emit(grams=parts[0][0], n=parts[0][1])
                    parts, held = [], 0
            if len(words) > TASK_WORDS:
                yield emit(words=list(words.keys()), n=list(words.values()))
                words.clear()
        if parts:
            k, n = _merge(parts)
            yield emit(grams=k, n=n)
        if words:
            yield emit(words=list(words.keys()), n=list(words.values()))

    partial = train.select("text").mapInArrow(run, "gram bigint, word binary, n bigint")
    return partial.groupBy("gram", "word").agg(F.sum("n").alias("n"))


@dataclass
class Trie:
    """Sorted arrays of one order each: nodes (context and byte) and contexts, with log10 values."""

    order: int
    node: list[np.ndarray]
    node_log_n: list[np.ndarray]  # log10 of the node's count
    node_first: list[np.ndarray]  # log10 probability if its context is the first one tried
    context: list[np.ndarray]
    escape_first: list[np.ndarray]  # escape from a context that is the first one tried
    parent: list[np.ndarray]  # row of the next shorter context
    rest: list[np.ndarray]  # log10 of what the parent's counts leave after excluding the followers here
    escape_next: list[np.ndarray]  # escape from the parent after that
    last: float  # a byte that no context knows, all contexts tried
    slots: np.ndarray  # open-addressing table of the longest nodes: key, or 0 if free
    slot_log: np.ndarray


def _log10(x: np.ndarray) -> np.ndarray:
    return np.log10(np.where(x > 0, x, 1.0))


def build_trie(order: int, nodes: list[tuple[np.ndarray, np.ndarray]], contexts: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
    """From (keys, counts) of kept nodes and (contexts, totals over all their followers), by order."""
    node, n, context, total = [], [], [], []
    for (k, c), (x, t) in zip(nodes, contexts, strict=True):
        by = np.argsort(k)
        node.append(k[by].astype(np.uint64))
        n.append(c[by].astype(float))
        own = np.unique(node[-1] >> _EIGHT)
        by = np.argsort(x)
        x, t = x[by].astype(np.uint64), t[by].astype(float)
        at = np.searchsorted(x, own)
        context.append(own)
        total.append(t[at])
    logs, first, esc_first, parent, rest, esc_next = [], [], [], [], [], []
    kept, different, free = [], [], []
    for j in range(order + 1):
        row = np.searchsorted(context[j], node[j] >> _EIGHT)
        kept.append(np.bincount(row, n[j], len(context[j])))
        different.append(np.bincount(row, minlength=len(context[j])).astype(float))
        logs.append(_log10(n[j] - DISCOUNT))
        first.append(np.log10((n[j] - DISCOUNT) / total[j][row]) if len(row) else np.zeros(0))
        free.append(total[j] - kept[j] + DISCOUNT * different[j])
        esc_first.append(np.log10(free[j] / total[j]) if len(row) else np.zeros(0))
        if j == 0 or not len(row):
            parent.append(np.zeros(len(context[j]), np.int64))
            rest.append(np.zeros(len(context[j])))
            esc_next.append(np.zeros(len(context[j])))
            continue
        up = np.searchsorted(context[j - 1], context[j] & _mask(j - 1))
        shorter = n[j - 1][np.searchsorted(node[j - 1], node[j] & _mask(j))]
        excluded = np.bincount(row, shorter, len(context[j]))
        left = total[j - 1][up] - excluded
        out = free[j - 1][up] - DISCOUNT * different[j]
        parent.append(up)
        rest.append(_log10(left))
        esc_next.append(np.where(left > 0, _log10(out) - _log10(left), 0.0))
    known = len(node[0])
    last = -np.log10(max(SYMBOLS - known, 1))
    slots, slot_log = slot_table(node[order], first[order])
    return Trie(order, node, logs, first, context, esc_first, parent, rest, esc_next, float(last), slots, slot_log)


def slot_table(keys: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open-addressing table of keys and their values; the key 0 stays out, as 0 marks a free slot."""
    size = 1 << max(4, (2 * len(keys) - 1).bit_length())
    slots, slot_log = np.zeros(size, np.uint64), np.zeros(size)
    todo = np.flatnonzero(keys)
    at = _slot(keys, size.bit_length() - 1)
    while len(todo):
        free = todo[slots[at[todo]] == 0]
        slots[at[free]] = keys[free]
        done = slots[at[todo]] == keys[todo]
        slot_log[at[todo[done]]] = logs[todo[done]]
        todo = todo[~done]
        at[todo] = (at[todo] + 1) & (size - 1)
    return slots, slot_log


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * _HASH) >> np.uint64(64 - bits)).astype(np.int64)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys, at


def _walk(trie: Trie, keys: np.ndarray) -> np.ndarray:
    """log10 probability of each key by the full walk from the longest context to the shortest."""
    out = np.zeros(len(keys))
    live = np.arange(len(keys))
    came = np.full(len(keys), -1)  # row of the longer context escaped from
    for j in range(trie.order, -1, -1):
        key = keys[live]
        has, ctx = _find(trie.context[j], (key & _mask(j + 1)) >> _EIGHT)
        hit, at = _find(trie.node[j], key & _mask(j + 1))
        here = came[live]
        first = here < 0
        from_longer = np.maximum(here, 0)
        up = j + 1 if j < trie.order else j
        later = len(trie.rest[up]) > 0 and j < trie.order
        gain = np.zeros(len(live))
        if len(trie.node[j]):
            gain = np.where(hit & first, trie.node_first[j][at], gain)
            gain = np.where(~hit & first & has, trie.escape_first[j][ctx], gain)
        if later:
            gain = np.where(hit & ~first, trie.node_log_n[j][at] - trie.rest[up][from_longer], gain)
            gain = np.where(~hit & ~first, trie.escape_next[up][from_longer], gain)
        out[live] += gain
        came[live] = np.where(has, ctx, here)
        live = live[~hit]
    out[live] += np.where(came[live] >= 0, trie.last, -np.log10(SYMBOLS))
    return out


def look_up(slots: np.ndarray, slot_log: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value of each key, 0 if it is not in the table; positions of the keys that are not)."""
    out = np.zeros(len(keys))
    todo = np.arange(len(keys))
    at = _slot(keys, len(slots).bit_length() - 1)
    missing = []
    while len(todo):
        found = slots[at]
        hit = (found == keys[todo]) & (found != 0)
        out[todo[hit]] = slot_log[at[hit]]
        missing.append(todo[found == 0])
        on = ~hit & (found != 0)
        todo, at = todo[on], (at[on] + 1) & (len(slots) - 1)
    return out, np.concatenate(missing) if missing else todo


def score_keys(trie: Trie, keys: np.ndarray) -> np.ndarray:
    """log10 probability of each key; most are found in the table of longest nodes."""
    out, rest = look_up(trie.slots, trie.slot_log, keys)
    if len(rest):
        different, back = np.unique(keys[rest], return_inverse=True)
        out[rest] = _walk(trie, different)[back]
    return out


def score_texts(trie: Trie, texts: list[bytes]) -> np.ndarray:
    keys, number = grams(texts, trie.order)
    return np.bincount(number, score_keys(trie, keys), len(texts))


def _tail(key: str, n_bytes: str) -> Column:
    return F.expr(f"{key} & (shiftleft(1L, 8 * ({n_bytes})) - 1)")


def _tails(grams: DataFrame, order: int) -> DataFrame:
    """Every row once for each order j, with its node k (j bytes of context and the byte) and its context x."""
    out = grams.withColumn("j", F.explode(F.array(*[F.lit(j) for j in range(order + 1)])))
    return out.withColumn("k", _tail("gram", "j + 1")).withColumn("x", F.shiftright("k", 8))


def longest_nodes(grams: DataFrame, least: int) -> DataFrame:
    """(gram, n, log): the longest nodes of counted grams (gram, n) and the log10 of their prediction."""
    total = F.sum("n").over(Window.partitionBy(F.shiftright("gram", 8)))
    return grams.withColumn("total", total).filter(F.col("n") >= least).select("gram", "n", F.log10((F.col("n") - DISCOUNT) / F.col("total")).alias("log"))


def most_frequent(nodes: DataFrame, size: int) -> DataFrame:
    """The nodes above a bound of the count that at most ``size`` nodes reach."""
    step = F.floor(F.log2("n") * 8)
    bound, held = None, 0
    for b, n in sorted(nodes.groupBy(step).count().collect(), reverse=True):  # counts are longs: at most 8 * 63 steps
        held += n
        if held > size:
            break
        bound = b
    return nodes.filter(F.lit(False) if bound is None else step >= bound)


def walk_down(unknown: DataFrame, grams: DataFrame, order: int, least: int) -> DataFrame:
    """(gram, log): log10 probability of each different gram that is no longest node, by the walk over the contexts that
    the counted ``grams`` (gram, n) know. Nodes and contexts of up to one byte, which all walks meet, are at most 65,792 and 257."""
    nodes = _tails(grams, order).groupBy("j", "k", "x").agg(F.sum("n").alias("n"))
    nodes = materialize(nodes)
    asked = _tails(unknown, order)
    kept = F.col("n") >= least
    followers = nodes.join(asked.select("j", "x").distinct(), ["j", "x"], "left_semi").withColumn("s", _tail("k", "j"))
    shorter = nodes.select((F.col("j") + 1).alias("j"), F.col("k").alias("s"), F.col("n").alias("shorter"))
    contexts = (
        followers.join(shorter, ["j", "s"], "left")
        .groupBy("j", "x")
        .agg(
            F.sum("n").alias("total"),
            F.sum(F.when(kept, F.col("n")).otherwise(0)).alias("kept"),
            F.count(F.when(kept, 1)).alias("different"),
            F.sum(F.when(kept, F.col("shorter"))).alias("excluded"),
        )
        .filter("different > 0")
    )
    contexts, hits = materialize(contexts), nodes.filter(kept).select("j", "k", "n")
    low, high = F.col("j") <= 1, F.col("j") > 1
    met = asked.filter(low).join(F.broadcast(contexts.filter(low)), ["j", "x"], "left").join(F.broadcast(hits.filter(low)), ["j", "k"], "left")
    if order > 1:
        met = met.unionByName(asked.filter(high).join(contexts.filter(high), ["j", "x"], "left").join(hits.filter(high), ["j", "k"], "left"))
    fields = F.struct("n", "total", "kept", "different", "excluded")
    met = met.groupBy("gram").agg(*[F.max(F.when(F.col("j") == j, fields)).alias(f"at{j}") for j in range(order + 1)])

    # Contexts are nested: what is known or hit at one length is so at every shorter one.
    steps = [F.when(F.col("at0.n").isNull(), F.when(F.col("at0.total").isNull(), -np.log10(SYMBOLS)).otherwise(-F.log10(F.greatest(SYMBOLS - F.col("at0.different"), F.lit(1)))))]
    for j in range(order + 1):
        n, total = F.col(f"at{j}.n"), F.col(f"at{j}.total")
        free = total - F.col(f"at{j}.kept") + DISCOUNT * F.col(f"at{j}.different")
        gain = F.when(n.isNotNull(), F.log10((n - DISCOUNT) / total)).when(total.isNotNull(), F.log10(free / total))
        if j < order:
            longer = f"at{j + 1}"
            left = total - F.col(f"{longer}.excluded")
            out = free - DISCOUNT * F.col(f"{longer}.different")
            later = F.when(n.isNotNull(), F.log10(n - DISCOUNT) - F.log10(left)).when((left > 0) & (out > 0), F.log10(out) - F.log10(left))
            gain = F.when(F.col(f"{longer}.total").isNotNull(), later).otherwise(gain)
            gain = F.when(F.col(f"{longer}.n").isNull(), gain)
        steps.append(gain)
    return met.select("gram", sum((F.coalesce(s, F.lit(0.0)) for s in steps), F.lit(0.0)).alias("log"))


def _missed(keys: np.ndarray, number: np.ndarray, n: int) -> pa.ListArray:
    """The different keys of each of ``n`` texts, and how often it holds them."""
    by = np.lexsort((keys, number))
    keys, number = keys[by], number[by]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (number[1:] != number[:-1])])) if len(keys) else by
    pairs = pa.StructArray.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(np.diff(np.append(first, len(keys))))], names=["gram", "k"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(number[first], np.arange(n + 1)), pa.int32()), pairs)


def score(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    nodes: int | None = None,
    words: int = WORDS,
    shared: int = SHARED,
) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)
    and bits_per_byte of the model. Learns from the rows that are not held out. ``shared`` and ``words`` say how much of the
    model is sent to the tasks, and don't change results; ``nodes`` asks for a smaller model."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"), (id_mod(F.col(id_col), HELD_OUT_MOD) == HELD_OUT_REST).alias("held_out"))
    counted = materialize(count(rows.filter(~F.col("held_out")), order))
    vocabulary = counted.filter("word IS NOT NULL").select("word", "n")
    n_train, n_words = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = vocabulary.filter(F.col("n") >= max(1, -(-n_train // words))).toArrow()
    grams_seen = counted.filter("gram IS NOT NULL").select("gram", "n")
    least = 1 if nodes is None else max(1, -(-(grams_seen.agg(F.sum("n")).first()[0] or 0) // nodes))
    longest = materialize(longest_nodes(grams_seen, least))
    sent = most_frequent(longest, shared).select("gram", "log").toArrow()
    table = slot_table(sent.column("gram").to_numpy().astype(np.uint64), sent.column("log").to_numpy())
    held = df.sparkSession.sparkContext.broadcast(
        (table, dict(zip(frequent.column("word").to_pylist(), frequent.column("n").to_pylist(), strict=True)))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (slots, slot_log), seen = held.value
        logs = {w: float(np.log10(n + 1)) for w, n in seen.items()}
        row = TaskContext.get().partitionId() << 40
        for batch, texts in slices(batches, "text"):
            keys, number = grams(texts, order)
            logs_of, missing = look_up(slots, slot_log, keys)
            model = np.bincount(number, logs_of, len(texts))
            missed = _missed(keys[missing], number[missing], len(texts))
            tokens, known, base, size, rest_word, rest_n, offsets = [], [], [], [], [], [], [0]
            for t in texts:
                counts = Counter(t.translate(LOWER_BYTES).split())
                counts[b""] = 1
                hits = counts.keys() & logs.keys()
                tokens.append(counts.total())
                known.append(sum(counts[w] for w in hits))
                base.append(sum(counts[w] * logs[w] for w in sorted(hits)))
                size.append(len(t) + 1)
                other = counts.keys() - hits
                rest_word.extend(other)
                rest_n.extend(counts[w] for w in other)
                offsets.append(len(rest_word))
            n = len(texts)
            pairs = pa.StructArray.from_arrays([pa.array(rest_word, pa.binary()), pa.array(rest_n, pa.int64())], names=["word", "k"])
            rest = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
            cols = [pa.array(np.arange(row, row + n)), batch.column("id"), batch.column("held_out")]
            cols += [pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(model), pa.array(size, pa.int64()), rest, missed]
            yield pa.RecordBatch.from_arrays(cols, names=["row", "id", "held_out", "n_tokens", "known", "base", "score", "size", "rest", "missed"])
            row += n

    schema = (
        f"row bigint, id {df.schema[id_col].dataType.simpleString()}, held_out boolean, n_tokens bigint, known bigint, base double, score double, size bigint, "
        "rest array<struct<word:binary,k:bigint>>, missed array<struct<gram:bigint,k:bigint>>"
    )
    scored = materialize(rows.mapInArrow(run, schema))
    rare = scored.select("row", F.explode("rest").alias("x")).select("row", "x.word", "x.k").join(vocabulary, "word")
    rare = rare.select("row", F.col("k").alias("rare_known"), (F.col("k") * F.log10(F.col("n") + 1)).alias("rare_base"), F.lit(0.0).alias("rare_score"))
    missed = scored.select("row", F.explode("missed").alias("x")).select("row", "x.gram", "x.k")
    unknown = materialize(missed.select("gram").distinct().join(longest, "gram", "left_anti"))
    logs = longest.select("gram", "log").unionByName(walk_down(unknown, grams_seen, order, least))
    found = missed.join(logs, "gram").select("row", F.lit(0).cast("bigint").alias("rare_known"), F.lit(0.0).alias("rare_base"), (F.col("k") * F.col("log")).alias("rare_score"))
    rare = rare.unionByName(found).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("rare_known", "rare_base", "rare_score")])
    out = scored.drop("rest", "missed").join(rare, "row", "left")
    out = out.withColumn("score", F.col("score") + F.coalesce("rare_score", F.lit(0.0)))
    norm = float(np.log10(n_train + n_words + 1))
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)
    return out.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        (-F.col("score") / F.lit(float(np.log10(2))) / F.col("size")).alias("bits_per_byte"),
    )
