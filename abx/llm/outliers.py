"""Quality rules by robust multivariate outliers.

Each text gives counts (``statistics``); a base rule fails short and repetitive texts; the rest of a
(language, source) group is described by a minimum-covariance-determinant estimate of a transformed
statistic vector, and rows with a large Mahalanobis distance are rejected.

The estimate is computed by Spark for all groups at once. A start from medians and quartile ranges
is followed by concentration steps: distances under the present estimate are grouped into narrow
logarithmic bins, the bins that hold the nearest H_SHARE of a group's rows are summed, and their
mean and covariance are the next estimate, kept while the determinant falls. A step is one aggregation by (group, bin), so a group
that holds a third of all rows is combined in every task before it moves. Steps end when no group's
determinant changes any more.

Every group has its own estimate, however small. It is drawn towards that of its language as if
PRIOR_ROWS rows of the language stood among its own, the language's likewise towards the whole
table's, and the table's towards PRIOR_SPREAD times the least deviations around its own center. So
verdicts change smoothly with a group's size, and a group of a few rows is judged by its language.
A group of which more than 1 - H_SHARE is junk is described by it, as in any such estimate.

Defined results: a null text has no words; null languages and sources are groups of their own;
repeated rows each get a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abx.llm.common import bounded_broadcast, materialize, slices

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SYMBOLS = b"#*$%&|<>"
H_SHARE = 0.75
# Weight of the wider estimate that an estimate is drawn to, in rows: some for each of eight dimensions.
PRIOR_ROWS = 40
PRIOR_SPREAD = 2.0
# Rejected beyond this quantile of the chi-square law of squared distances.
REJECT_QUANTILE = 1 - 1e-7
# Bins of squared distances: width of a step in log space, and the largest distance told apart.
BIN_WIDTH = 0.02
MAX_BIN = 2000
# A step that lowers no determinant's logarithm by more than this is the last.
TOLERANCE = 1e-4
# Groups up to this count are sent to every task; beyond, estimates are joined by shuffling.
BROADCAST_GROUPS = 20_000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits"]
_DROP = {
    "space": b" \t\n\r\x0b\x0c",
    "continued": bytes(range(0x80, 0xC0)),
    "symbol": SYMBOLS,
    "upper": bytes(range(65, 91)),
    "digit": bytes(range(48, 58)),
}


def repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """For each list, its words that lie in a three-word window found twice or more in it."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    names: dict[bytes, int] = {}
    n = int(sizes.sum())
    ids = np.fromiter((names.setdefault(w, len(names)) for ws in words for w in ws), np.int64, n)
    doc = np.repeat(np.arange(len(words)), sizes)
    out = np.zeros(len(words), np.int64)
    at = np.flatnonzero(doc[2:] == doc[:-2]) if n > 2 else np.zeros(0, np.int64)
    if not len(at):
        return out
    key, many = doc[at], max(len(names), 1)
    span = len(words)
    for part in (ids[at], ids[at + 1], ids[at + 2]):
        if span * many >= 1 << 62:  # renumber before the key would overflow
            key = np.unique(key, return_inverse=True)[1]
            span = len(at)
        key, span = key * many + part, span * many
    order = np.argsort(key, kind="stable")
    same = np.concatenate([[False], key[order][1:] == key[order][:-1], [False]])
    twice = at[order[same[1:] | same[:-1]]]
    hit = np.zeros(n, bool)
    for step in range(3):
        hit[twice + step] = True
    np.add.at(out, doc[hit], 1)
    return out


def text_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """COUNTS of each text."""
    words = [t.split() for t in texts]
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    many = lambda kind: [len(t) - len(t.translate(None, _DROP[kind])) for t in texts]
    size = np.asarray([len(t) for t in texts], np.int64)
    return {
        "n_words": np.asarray([len(w) for w in words], np.int64),
        "word_chars": size - np.asarray(many("continued"), np.int64) - np.asarray(many("space"), np.int64),
        "n_symbols": np.asarray(many("symbol"), np.int64),
        "n_dup_lines": np.asarray([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": repeated_words(words),
        "n_lines": np.asarray([len(x) for x in lines], np.int64),
        "n_upper": np.asarray(many("upper"), np.int64),
        "n_digits": np.asarray(many("digit"), np.int64),
    }


def statistics(df: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(id, lang, source) and COUNTS of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            counts = text_counts(texts)
            cols = [batch.column(c) for c in ("id", "lang", "source")] + [pa.array(counts[c]) for c in COUNTS]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "lang", "source", *COUNTS])

    rows = df.select(
        F.col(id_col).alias("id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    schema = f"id {df.schema[id_col].dataType.simpleString()}, lang string, source string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return rows.mapInArrow(run, schema)


def _share(part: str, whole: str) -> Column:
    return F.log1p(100 * F.col(part) / F.greatest(F.col(whole), F.lit(1)))


# The statistic vector and, for each part, the least standard deviation that it is given: most
# texts have none of some symbols, and a spread of zero would reject any that has one.
VECTOR: dict[str, tuple[Column, float]] = {}


def vector() -> dict[str, tuple[Column, float]]:
    if not VECTOR:
        VECTOR.update(
            {
                "length": (F.log1p(F.col("n_words")), 0.5),
                "word_length": (F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)), 0.1),
                "line_length": (F.log((F.col("n_words") + 1) / (F.col("n_lines") + 1)), 0.5),
                "symbols": (_share("n_symbols", "word_chars"), 0.35),
                "dup_lines": (_share("n_dup_lines", "n_lines"), 0.8),
                "repeats": (_share("n_repeat_words", "n_words"), 0.8),
                "upper": (_share("n_upper", "word_chars"), 0.35),
                "digits": (_share("n_digits", "word_chars"), 0.6),
            }
        )
    return VECTOR


def chi2_quantile(q: float, p: int) -> float:
    """Wilson-Hilferty approximation, good to a few parts in a thousand for p > 2."""
    z = NormalDist().inv_cdf(q)
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3


def _distance(p: int) -> Column:
    """Squared Mahalanobis distance of x under the row's center m and inverse covariance w (row-major)."""
    parts = [F.col("x")[i] - F.col("m")[i] for i in range(p)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(i, p):
            total = total + (1 if i == j else 2) * F.col("w")[i * p + j] * parts[i] * parts[j]
    return F.greatest(total, F.lit(0.0))


def _members(rows: DataFrame) -> DataFrame:
    """(level, x): every row in its group, its language and the whole table. Levels are structs
    (depth, lang, source): depth 2 is the group, 1 its language, 0 the whole table."""
    none = F.lit(None).cast("string")
    at = [(2, F.col("lang"), F.col("source")), (1, F.col("lang"), none), (0, none, none)]
    levels = [F.struct(F.lit(d).alias("depth"), lang.alias("lang"), source.alias("source")) for d, lang, source in at]
    return rows.select(F.explode(F.array(*levels)).alias("level"), "x")


def _near(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on the keys, which come from ``df``."""
    other = other.select(*[F.col(k).alias(f"__llm_{k}") for k in keys], *[c for c in other.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__llm_{k}")) for k in keys]
    return df.join(other, on, how).drop(*[f"__llm_{k}" for k in keys])


def _inverse(floors: list[float]):
    """Rows (level, bin, n, s, ss) of sums to estimates (level, bin, m, w, log_det)."""
    p = len(floors)
    upper = [(i, j) for i in range(p) for j in range(i, p)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for depth, lang, source, at, n, s, ss in zip(pdf.depth, pdf.lang, pdf.source, pdf.bin, pdf.n, pdf.s, pdf.ss, strict=True):
                m = np.asarray(s, float) / n
                cov = np.zeros((p, p))
                for (i, j), v in zip(upper, ss, strict=True):
                    cov[i, j] = cov[j, i] = v / n - m[i] * m[j]
                cov += np.diag(np.square(floors))
                out.append((depth, lang, source, at, m.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame(out, columns=["depth", "lang", "source", "bin", "new_m", "new_w", "new_log_det"])

    return run


def estimates(rows: DataFrame, h_share: float = H_SHARE) -> DataFrame:
    """(level, n, m, w, middle): rows, MCD center, inverse covariance and median squared distance of each level.

    ``rows`` has (level, x).
    """
    parts = vector()
    p, floors = len(parts), [f for _, f in parts.values()]
    level = ["depth", "lang", "source"]
    flat = rows.select("level.depth", "level.lang", "level.source", "x")
    quartiles = [F.percentile_approx(F.col("x")[i], [0.25, 0.5, 0.75], 2000).alias(f"q{i}") for i in range(p)]
    start = flat.groupBy(*level).agg(F.count("*").alias("rows"), *quartiles)
    scale = [(F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349 for i in range(p)]
    unit = [1 / (scale[i] * scale[i] + floors[i] ** 2) for i in range(p)]
    now = materialize(
        start.select(
            *level,
            "rows",
            F.array(*[F.col(f"q{i}")[1] for i in range(p)]).alias("m"),
            F.array(*[unit[i] if i == j else F.lit(0.0) for i in range(p) for j in range(p)]).alias("w"),
            F.lit(float("inf")).alias("log_det"),
        )
    )
    small = now.count() <= BROADCAST_GROUPS
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(p)]
    sums += [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"ss{i}_{j}") for i in range(p) for j in range(i, p)]
    names = [f"s{i}" for i in range(p)], [f"ss{i}_{j}" for i in range(p) for j in range(i, p)]
    bin_of = F.least(F.floor(F.log1p("d2") / BIN_WIDTH), F.lit(MAX_BIN)).alias("bin")
    w = W.partitionBy(*level)
    schema = "depth int, lang string, source string, bin bigint, new_m array<double>, new_w array<double>, new_log_det double"
    while True:
        scored = _near(flat, F.broadcast(now) if small else now, level).withColumn("d2", _distance(p))
        bins = scored.select(*level, "x", bin_of).groupBy(*level, "bin").agg(F.count("*").alias("n"), *sums)
        bins = bins.withColumn("before", F.coalesce(F.sum("n").over(w.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        bins = bins.withColumn("total", F.sum("n").over(w))
        inner = F.col("before") < F.lit(h_share) * F.col("total")
        agg = [F.sum(F.when(inner, F.col(c))).alias(c) for c in ["n", *names[0], *names[1]]]
        # The bin that holds the median gives the scale of distances.
        middle = F.max(F.when(F.col("before") < F.col("total") / 2, F.col("bin"))).alias("bin")
        summed = bins.groupBy(*level).agg(middle, *agg)
        packed = summed.select(*level, "bin", F.col("n").cast("double").alias("n"), F.array(*names[0]).alias("s"), F.array(*names[1]).alias("ss"))
        # A level moves on while its determinant falls; one that no longer does keeps its best estimate.
        better = F.col("new_log_det") < F.col("log_det") - TOLERANCE
        pick = [F.when(better, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in ("m", "w", "log_det")]
        stepped = materialize(_near(now, packed.mapInPandas(_inverse(floors), schema), level).select(*level, "rows", "bin", better.alias("better"), *pick))
        if stepped.filter("better").isEmpty():
            break
        now = stepped.drop("bin", "better")
    # These distances were measured under the estimates that have been kept.
    middle = F.expm1((F.col("bin") + 0.5) * BIN_WIDTH).alias("middle")
    return stepped.select(F.struct(*level).alias("level"), F.col("rows").alias("n"), "m", "w", middle)


def drawn(n: float, m: np.ndarray, c: np.ndarray, wider_m: np.ndarray, wider_c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Center and covariance of ``n`` rows as they are with PRIOR_ROWS rows of the wider estimate among them."""
    own = n / (n + PRIOR_ROWS)
    off = m - wider_m
    return own * m + (1 - own) * wider_m, own * c + (1 - own) * wider_c + own * (1 - own) * np.outer(off, off)


def _drawn(fitted: DataFrame, floors: list[float]) -> DataFrame:
    """(lang, source, n, m, c, w) of rows (lang, source, n, m, w, middle, wider_m, wider_c); without a wider
    estimate the rows' own center and PRIOR_SPREAD times the least deviations stand for it."""
    p, usual = len(floors), chi2_quantile(0.5, len(floors))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for lang, source, n, m, w, middle, wider_m, wider_c in zip(*[pdf[c] for c in names], strict=True):
                m = np.asarray(m, float)
                # The inner rows spread less than all; texts closer together than the least deviations stay as they are.
                c = np.linalg.inv(np.asarray(w, float).reshape(p, p)) * max(middle / usual, 1.0)
                if wider_m is None:
                    wider_m, wider_c = m, np.diag(np.square(PRIOR_SPREAD * np.asarray(floors)))
                m, c = drawn(n, m, c, np.asarray(wider_m, float), np.asarray(wider_c, float).reshape(p, p))
                out.append((lang, source, n, m.tolist(), c.ravel().tolist(), np.linalg.inv(c).ravel().tolist()))
            yield pd.DataFrame(out, columns=["lang", "source", "n", "m", "c", "w"])

    names = ["lang", "source", "n", "m", "w", "middle", "wider_m", "wider_c"]
    return fitted.select(*names).mapInPandas(run, "lang string, source string, n bigint, m array<double>, c array<double>, w array<double>")


def shrunk(fitted: DataFrame) -> DataFrame:
    """(lang, source, m, w) of every group, drawn towards its language's and the table's estimates."""
    floors = [f for _, f in vector().values()]
    none = F.lit(None).cast("array<double>")
    flat = fitted.select("level.depth", "level.lang", "level.source", "n", "m", "w", "middle")
    top = _drawn(flat.filter("depth = 0").withColumn("wider_m", none).withColumn("wider_c", none), floors).first()  # one row
    wide = [F.array(*[F.lit(v) for v in top[c]]) if top else none for c in ("m", "c")]
    langs = materialize(_drawn(flat.filter("depth = 1").withColumn("wider_m", wide[0]).withColumn("wider_c", wide[1]), floors))
    wider = langs.select("lang", F.col("m").alias("wider_m"), F.col("c").alias("wider_c"))
    groups = _near(flat.filter("depth = 2"), bounded_broadcast(wider, BROADCAST_GROUPS), ["lang"])
    return _drawn(groups, floors).select("lang", "source", "m", "w")


def judge(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    reject_quantile: float = REJECT_QUANTILE,
) -> DataFrame:
    """One row per input row: id, COUNTS, base_failed, distance2 (null if base_failed), kept."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    parts = vector()
    p = len(parts)
    counted = statistics(df, id_col, text_col, lang_col, source_col)
    counted = materialize(counted.withColumn("base_failed", base).withColumn("x", F.array(*[c for c, _ in parts.values()])))
    rows = counted.filter(~F.col("base_failed"))
    known = materialize(shrunk(estimates(materialize(_members(rows)))))
    judged = _near(counted, bounded_broadcast(known, BROADCAST_GROUPS), ["lang", "source"], "left")
    judged = judged.withColumn("distance2", F.when(~F.col("base_failed"), _distance(p)))
    limit = chi2_quantile(reject_quantile, p)
    kept = ~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= limit)
    return judged.select(F.col("id").alias(id_col), *COUNTS, "base_failed", "distance2", kept.alias("kept"))
