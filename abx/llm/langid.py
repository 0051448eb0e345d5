"""Language identification by Bayesian evidence fusion.

``fit`` sums hashed byte trigrams of labelled texts by language. ``identify`` then multiplies, for
every row and language (and for ``und``, text of no known language):

* the likelihood of the visible text, as if it had at most TEXT_EVIDENCE independent trigrams;
* the chance that a text of that language declares the markup language that it declares, from a
  table of text-only posteriors by declared language, added up over all rows;
* a prior of the row's address: posteriors added up by address suffix, domain and host (or any other
  levels, from coarse to fine), each level smoothed towards the one above it, without the row's own.

A row whose best language has a posterior under MIN_POSTERIOR, or is ``und``, is rejected.

Level tables are grouped sums, combined in every task before they move. They are sent to the tasks if
their counted size is small and joined by shuffling otherwise, where Spark splits a hot host.

Defined results: a null or empty text leaves the decision to the other evidence, and a row without
any of it is rejected only if the priors say so; a missing or unknown declaration is no evidence;
null levels form a group of their own; repeated rows are judged alike; an empty table gives an
empty result, and a model without labelled texts knows ``und`` alone; other columns are ignored
(``keep_known`` returns them unchanged).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.llm.common import LOWER_BYTES, bounded_broadcast, lower_ascii, materialize, slices

HASH_BITS = 12
SIZE = 1 << HASH_BITS
# A task sums the trigrams of this many languages at once, and hands them on before it takes others.
HELD = 256
# Sums over up to this many languages have a column each.
WIDE = 64
TEXT_EVIDENCE = 60.0
SMOOTH_TRIGRAM = 0.5
SMOOTH_LEVEL = 5.0
SMOOTH_DECLARED = 20.0
TRUST_DECLARED = 0.8
UNKNOWN = "und"
UNKNOWN_PRIOR = 0.01
MIN_POSTERIOR = 0.5
BROADCAST_ROWS = 50_000

_MARKUP = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)


def visible_text(markup: bytes) -> bytes:
    """Text of a page without scripts, styles, comments, tags and entities."""
    return html.unescape(_MARKUP.sub(" ", markup.decode("utf-8", "replace"))).encode("utf-8", "replace")


def trigrams(texts: list[bytes]) -> np.ndarray:
    """(texts, SIZE) counts of hashed byte trigrams, words edged by spaces and A-Z in lower case."""
    joined = [b" " + b" ".join(t.translate(LOWER_BYTES).split()) + b" " for t in texts]
    sizes = np.fromiter(map(len, joined), np.int64, len(joined))
    data = np.frombuffer(b"".join(joined), np.uint8).astype(np.int64)
    doc = np.repeat(np.arange(len(joined)), sizes)
    inside = doc[2:] == doc[:-2]
    code = (((data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * 2654435761) >> 11) & (SIZE - 1)
    return np.bincount(doc[2:][inside] * SIZE + code[inside], minlength=len(joined) * SIZE).reshape(-1, SIZE)


def _few(texts: list[bytes], rows: int = 256) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, len(texts), rows):
        yield at, trigrams(texts[at : at + rows])


@dataclass
class TextModel:
    """log probabilities of hashed trigrams, one row a language; the last row is ``und``."""

    languages: list[str]
    logp: np.ndarray

    def log_likelihoods(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)))
        for at, counts in _few(texts):
            n = np.maximum(counts.sum(1), 1)
            out[at : at + len(counts)] = counts @ self.logp.T * np.minimum(1.0, TEXT_EVIDENCE / n)[:, None]
        return out


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> TextModel:
    """Trigram model of all languages of the labelled rows, however rare, from all their texts."""
    lang = lower_ascii(F.trim(F.col(lang_col).cast("string")))
    rows = labelled.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang <> '' AND lang <> 'und'")
    names = sorted(r.lang for r in rows.select("lang").distinct().collect())
    place = {x: i for i, x in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros((HELD, SIZE), np.int64), {}

        def summed() -> pa.RecordBatch:
            row, code = np.nonzero(total[: len(held)])
            i = np.fromiter(held, np.int64, len(held))[row]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (i, code, total[row, code])], names=["i", "code", "n"])

        for batch, texts in slices(batches, "text"):
            at = [place[x] for x in batch.column("lang").to_pylist()]
            for first, counts in _few(texts, min(HELD, 256)):
                own = at[first : first + len(counts)]
                if len(held.keys() | set(own)) > HELD:
                    yield summed()
                    total[:], held = 0, {}
                for x in own:
                    held.setdefault(x, len(held))
                np.add.at(total, [held[x] for x in own], counts)
        yield summed()

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.zeros(SIZE, np.int64)
        v[pdf.code] = pdf.n
        return pd.DataFrame({"i": pdf.i[:1], "v": [v.tobytes()]})

    found = {}
    if names:
        summed = rows.mapInArrow(run, "i bigint, code bigint, n bigint").groupBy("i", "code").agg(F.sum("n").alias("n"))
        for r in summed.groupBy("i").applyInPandas(together, "i bigint, v binary").collect():  # one row a language
            found[names[r.i]] = np.frombuffer(r.v, np.int64)
    languages = sorted(found)  # those of blank texts alone have no model
    counts = np.asarray([found[x] for x in languages], float).reshape(-1, SIZE)
    logp = np.log((counts + SMOOTH_TRIGRAM) / (counts.sum(1, keepdims=True) + SMOOTH_TRIGRAM * SIZE))
    return TextModel([*languages, UNKNOWN], np.vstack([logp, np.full((1, SIZE), -np.log(SIZE))]))


def declared_language(markup: Column) -> Column:
    """Primary language of a page's ``html`` tag, lower case; empty if it has none."""
    return lower_ascii(F.regexp_extract(markup, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?\s*([A-Za-z]+)", 1))


def address_levels(url: Column) -> list[tuple[str, Column]]:
    """Address suffix, domain and host of a URL."""
    host = lower_ascii(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return [("suffix", F.substring_index(host, ".", -1)), ("domain", F.substring_index(host, ".", -2)), ("host", host)]


def _bound(value: Column, f) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def _softmax(logs: Column) -> Column:
    weights = _bound(F.array_max(logs), lambda top: F.transform(logs, lambda x: F.exp(x - top)))
    return _bound(weights, lambda all_: _bound(_total(all_), lambda total: F.transform(all_, lambda w: w / total)))


def _scored(df: DataFrame, model: TextModel, text: Column, declared: Column | None, levels: list[tuple[str, Column]], markup: bool, names: list[str]) -> DataFrame:
    """The columns ``names`` of ``df`` with __llm_ll (log likelihoods), __llm_text (text-only posterior), declaration and levels."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "__llm_in"):
            m = shared.value
            ll = m.log_likelihoods([visible_text(t) for t in texts] if markup else texts)
            offsets = pa.array(np.arange(len(ll) + 1, dtype=np.int32) * ll.shape[1])
            cols = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "__llm_in"]
            kept = [n for n in batch.schema.names if n != "__llm_in"]
            yield pa.RecordBatch.from_arrays([*cols, pa.ListArray.from_arrays(offsets, pa.array(ll.ravel()))], names=[*kept, "__llm_ll"])

    said = F.lit("") if declared is None else F.coalesce(declared, F.lit(""))
    known = F.array(*[F.lit(x) for x in model.languages])
    said_cols = [
        *[F.col(f"`{c}`") for c in names],
        F.when(F.array_contains(known, said) & (said != UNKNOWN), said).otherwise(F.lit("")).alias("__llm_said"),
        *[c.cast("string").alias(f"__llm_{n}") for n, c in levels],
    ]
    rows = df.select(*said_cols)
    wide = df.select(*said_cols, text.cast("string").alias("__llm_in"))
    schema = T.StructType([*rows.schema.fields, T.StructField("__llm_ll", T.ArrayType(T.DoubleType()))])
    return wide.mapInArrow(run, schema).withColumn("__llm_text", _softmax(F.col("__llm_ll")))


def _sums(df: DataFrame, keys: list[str], n: int, by: str, out: str) -> DataFrame:
    """Grouped sums of the array column ``by`` as the array ``out``."""
    if n > WIDE:
        one = df.select(*keys, F.posexplode(by).alias("i", "s")).groupBy(*keys, "i").agg(F.sum("s").alias("s"))
        every = one.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("every"))
        return every.select(*keys, F.transform("every", lambda x: x["s"]).alias(out))
    return df.groupBy(*keys).agg(*[F.sum(F.col(by)[i]).alias(f"s{i}") for i in range(n)]).select(*keys, F.array(*[f"s{i}" for i in range(n)]).alias(out))


def _declared_logs(scored: DataFrame, languages: list[str]) -> DataFrame:
    """(__llm_said_of, __llm_said_logs): log P(declaration | language) by declaration, from sums over all rows."""
    n = len(languages)
    seen = np.zeros((n, n))
    for r in _sums(scored.filter("__llm_said <> ''"), ["__llm_said"], n, "__llm_text", "v").collect():  # one row a language
        seen[languages.index(r["__llm_said"])] = r.v
    share = np.full((n, n), (1 - TRUST_DECLARED) / max(n - 2, 1))  # [declared, true]
    np.fill_diagonal(share, TRUST_DECLARED)
    share[:, -1] = 1 / max(n - 1, 1)
    p = (seen + SMOOTH_DECLARED * share) / (seen[:-1].sum(0) + SMOOTH_DECLARED)
    entries = [("", [0.0] * n), *zip(languages[:-1], np.log(p[:-1]).tolist(), strict=True)]
    return scored.sparkSession.createDataFrame(entries, "__llm_said_of string, __llm_said_logs array<double>")


def identify(
    df: DataFrame,
    model: TextModel,
    text: Column,
    declared: Column | None = None,
    levels: list[tuple[str, Column]] | None = None,
    markup: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``df`` (all if not given) with __llm_lang (null if rejected), __llm_posterior and __llm_text_lang (by the text alone)."""
    levels = levels or []
    n = len(model.languages)
    keep = df.columns if keep is None else keep
    scored = _scored(df, model, text, declared, levels, markup, keep)
    names = [f"__llm_{x}" for x, _ in levels]
    said = _declared_logs(scored, model.languages)
    base = [(1 - UNKNOWN_PRIOR) / max(n - 1, 1)] * (n - 1) + [UNKNOWN_PRIOR if n > 1 else 1.0]
    # The finest level's sums give those of all coarser ones.
    tables = scored.select(F.lit(0).alias("__llm_all"), *names, "__llm_text")
    keys = ["__llm_all", *names]
    fine = materialize(_sums(tables, keys, n, "__llm_text", "__llm_n"))
    chain = fine.withColumnRenamed("__llm_n", f"__llm_n{len(names)}")
    for depth in range(len(names)):
        own = _sums(fine, keys[: depth + 1], n, "__llm_n", f"__llm_n{depth}")
        own = own.select(*[F.col(k).alias(f"{k}_of") for k in keys[: depth + 1]], f"__llm_n{depth}")
        same = F.lit(True)
        for k in keys[: depth + 1]:
            same = same & F.col(k).eqNullSafe(F.col(f"{k}_of"))
        chain = chain.join(own, same).drop(*[f"{k}_of" for k in keys[: depth + 1]])
    chain = materialize(chain).drop("__llm_all")
    out = scored
    if names:
        chain = bounded_broadcast(chain.select(*[F.col(k).alias(f"{k}_of") for k in names], *[f"__llm_n{i}" for i in range(len(names) + 1)]), BROADCAST_ROWS)
        same = F.lit(True)
        for k in names:
            same = same & F.col(k).eqNullSafe(F.col(f"{k}_of"))
        out = out.join(chain, same)
    else:
        total = chain.first()
        out = out.withColumn("__llm_n0", F.array(*[F.lit(float(x)) for x in (total["__llm_n0"] if total else [0.0] * n)]))
    prior: Column = F.array(*[F.lit(float(b)) for b in base])
    for depth in range(len(names) + 1):
        left = f"__llm_left{depth}"
        out = out.withColumn(left, F.zip_with(f"__llm_n{depth}", "__llm_text", lambda a, b: F.greatest(a - b, F.lit(0.0))))
        out = out.withColumn(f"__llm_prior{depth}", _smoothed(left, prior))
        prior = F.col(f"__llm_prior{depth}")
    logs = F.zip_with("__llm_ll", prior, lambda a, p: a + F.log(p))
    out = out.join(F.broadcast(said), F.col("__llm_said") == F.col("__llm_said_of"))  # one row a language
    logs = F.zip_with(logs, "__llm_said_logs", lambda a, b: a + b)
    out = out.withColumn("__llm_post", _softmax(logs))
    languages = F.array(*[F.lit(x) for x in model.languages])
    best = F.element_at(languages, F.array_position("__llm_post", F.array_max("__llm_post")).cast("int"))
    out = out.withColumn("__llm_posterior", F.array_max("__llm_post"))
    out = out.withColumn("__llm_lang", F.when((best != UNKNOWN) & (F.col("__llm_posterior") >= MIN_POSTERIOR), best))
    out = out.withColumn("__llm_text_lang", F.element_at(languages, F.array_position("__llm_text", F.array_max("__llm_text")).cast("int")))
    return out.select(*[F.col(f"`{c}`") for c in keep], "__llm_lang", "__llm_posterior", "__llm_text_lang", "__llm_said")


def _smoothed(counts: str, above: Column) -> Column:
    return _bound(_total(F.col(counts)), lambda total: F.zip_with(counts, above, lambda c, p: (c + SMOOTH_LEVEL * p) / (total + SMOOTH_LEVEL)))


def identify_pages(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, lang (null if rejected), posterior, text_lang, declared (empty if none or unknown)."""
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    slim = slim.select("id", "url", declared_language(F.col("html")).alias("declared"), "html")
    out = identify(slim, model, F.col("html"), F.col("declared"), address_levels(F.col("url")), markup=True, keep=["id"])
    return out.select(
        F.col("id").alias(id_col), F.col("__llm_lang").alias("lang"), F.col("__llm_posterior").alias("posterior"), F.col("__llm_text_lang").alias("text_lang"), F.col("__llm_said").alias("declared")
    )


def keep_known(docs: DataFrame, model: TextModel, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows of ``docs`` that are not rejected; their language column is declared evidence, the source stands for the host."""
    declared = lower_ascii(F.trim(F.col(lang_col).cast("string")))
    out = identify(docs, model, F.col(text_col), declared, [("host", F.col(source_col))])
    return out.filter(F.col("__llm_lang").isNotNull()).select(*[F.col(f"`{c}`") for c in docs.columns])
