"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Protected entities are the e-mail addresses, IP addresses, payment cards and phone numbers that
fixed patterns find. A term (a word without its outer punctuation, lower case) near an entity may
reveal it: with counts of documents over the whole corpus, the entity's information is
IC(c) = -log p(c), and the share of it that the term t discloses is PMI(c; t) / IC(c), that is 1 if
t occurs only beside c and 0 if the two are independent. In every document that holds c, terms that
disclose ``generalise_at`` or more of it are replaced by their kind, and from ``remove_at`` by a
blank mark. A pair counts if it is found in ``min_support`` different texts at least; copies of one
text say nothing new about which words go together. Most entities stand in fewer texts than that, so
what entities share (mail domain, first half of an IP address, first six digits of a card or phone
number) is counted like an entity of its own: terms that disclose it are replaced wherever one of
its entities is found, be it in a single text.

All positions are code points. Positions of consecutive matches come from one anchored pattern of
gap and match, whose lengths add up, so the work is linear in the text. Entities of few texts whose
pool has few texts too leave before any word is looked at, and words meet entities of their own text
only, by position bucket.

Defined results: null texts have no spans and stay null when sanitised; repeated rows each get
their spans; a null id passes through; an empty table gives an empty result; other columns are
ignored (``sanitise`` returns them unchanged).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.llm.common import bounded_broadcast, lower_ascii, materialize

KINDS = ("email", "ip", "card", "phone")
REACH = 100
MIN_SUPPORT = 3
GENERALISE_AT = 0.8
REMOVE_AT = 0.95
# Term lists and hits up to this many rows are sent to every task; longer ones are joined by shuffling.
BROADCAST_ROWS = 100_000

_LOCAL = "[A-Za-z0-9._%+-]"
# A match, and what may not stand before it unless the last match ended there (a start inside such a
# run would fail or succeed just as the run's first character does).
_MATCH = {
    "email": (rf"{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", rf"(?<!{_LOCAL})"),
    "ip": (r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "(?<![0-9])"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"(?<![0-9])(?<![0-9][\x20-])"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", ""),
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_BLOCK = 256
_SPAN = "struct<kind:int,s:int,e:int,value:string>"


def _pattern(kind: str) -> str:
    match, guard = _MATCH[kind]
    return rf"\G(?:|(?s:.+?){guard})({match})"


def _hint(text: Column, kind: str) -> Column:
    """False only if the text cannot hold a match; cheaper than looking for one."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9](?:[\x20-]?[0-9]){12}")


def _scan(values: Column, join, zero: int) -> Column:
    """Running ``join`` over a short array."""
    start = F.struct(F.lit(zero).alias("t"), F.array().cast("array<int>").alias("o"))
    step = lambda s, v: F.struct(join(s["t"], v).alias("t"), F.concat(s["o"], F.array(join(s["t"], v))).alias("o"))
    return F.aggregate(values, start, step, lambda s: s["o"])


def _running(values: Column, join, zero: int = 0) -> Column:
    """Running ``join`` over an array, in blocks, so that long arrays are not copied at each step."""
    last = F.greatest(F.floor((F.size(values) - 1) / _BLOCK), F.lit(0)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))
    inner = F.transform(blocks, lambda x: _scan(x, join, zero))
    ends = F.transform(inner, lambda x: F.coalesce(F.try_element_at(x, F.lit(-1)), F.lit(zero)))
    before = F.slice(F.concat(F.array(F.lit(zero)), _scan(ends, join, zero)), F.lit(1), F.size(inner))
    return F.flatten(F.zip_with(inner, before, lambda x, b: F.transform(x, lambda v: join(b, v))))


def _add(a: Column, b: Column) -> Column:
    return a + b


def _luhn(digits: Column) -> Column:
    def term(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + term(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))


def _span_of(kind: int):
    return lambda v, end: F.struct(F.lit(kind).alias("kind"), (end - F.length(v)).alias("s"), end.alias("e"), v.alias("value"))


def _is_valid(kind: str):
    return lambda x: _valid(kind, x["value"])


def _of_kind(kind: int):
    return lambda x: x["kind"] == kind


def find_base(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with ``out``: the base spans of the text, by kind and then start (code points, end exclusive)."""
    cols = df.columns
    text = F.col(text_col).cast("string")
    for i, kind in enumerate(KINDS):
        hint, none = _hint(text, kind), F.array().cast("array<string>")
        p, m, e, s = (f"__llm_{x}{i}" for x in "pmes")
        df = df.withColumn(p, F.when(hint, F.regexp_extract_all(text, F.lit(_pattern(kind)), F.lit(0))).otherwise(none))
        df = df.withColumn(m, F.when(F.size(p) > 0, F.regexp_extract_all(text, F.lit(_pattern(kind)), F.lit(1))).otherwise(none))
        df = df.withColumn(e, F.when(F.size(p) > 0, _running(F.transform(p, F.length), _add)).otherwise(F.array().cast("array<int>")))
        df = df.withColumn(s, F.filter(F.zip_with(m, e, _span_of(i)), _is_valid(kind)).cast(f"array<{_SPAN}>"))
    return df.select(*[F.col(f"`{c}`") for c in cols], F.concat(*[f"__llm_s{i}" for i in range(len(KINDS))]).alias(out))


def _entity(span: Column) -> Column:
    """The span's entity in normal form: lower case, and digits alone for cards and phones."""
    value = lower_ascii(span["value"])
    return F.when(span["kind"] >= 2, F.regexp_replace(value, "[^0-9]", "")).otherwise(value)


def _pool(kind: Column, entity: Column) -> Column:
    """What the entity shares with others of its kind; never equal to an entity."""
    domain = F.concat(F.lit("@"), F.substring_index(entity, "@", -1))
    network = F.concat(F.substring_index(entity, ".", 2), F.lit("."))
    return F.when(kind == 0, domain).when(kind == 1, network).otherwise(F.substring(entity, 1, 6))


def _found(texts: DataFrame, pooled: bool) -> DataFrame:
    """(key, copies, kind, entity, s, e) of every base span, with ``pooled`` once more under its pool."""
    spans = texts.select("key", "copies", F.explode("base").alias("x"))
    found = spans.select("key", "copies", F.col("x.kind").alias("kind"), _entity(F.col("x")).alias("entity"), "x.s", "x.e")
    if not pooled:
        return found
    both = F.explode(F.array("entity", _pool(F.col("kind"), F.col("entity"))))
    return found.select("key", "copies", "kind", both.alias("entity"), "s", "e")


def _words(text: Column) -> Column:
    """Terms of a text with positions: array of (term, s, e)."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"), F.lit(0))
    ends = _running(F.transform(pieces, F.length), _add)

    def word(piece: Column, end: Column) -> Column:
        core = F.regexp_replace(piece, r"^[\x20\x09-\x0D]*+\p{Punct}*+", "")
        term = F.regexp_extract(core, r"^(?s)(.*[^\p{Punct}])", 1)
        start = end - F.length(core)
        return F.struct(lower_ascii(term).alias("term"), start.alias("s"), (start + F.length(term)).alias("e"))

    return F.filter(F.zip_with(pieces, ends, word), lambda w: w["term"] != "")


def _distinct_terms(text: Column) -> Column:
    """The same terms without positions, each once."""
    core = lambda w: F.regexp_extract(F.regexp_replace(w, r"^\p{Punct}*+", ""), r"^(?s)(.*[^\p{Punct}])", 1)
    words = F.array_distinct(F.regexp_extract_all(lower_ascii(text), F.lit(r"[^\x20\x09-\x0D]++"), F.lit(0)))
    return F.array_distinct(F.transform(words, core))


def _texts(df: DataFrame, text_col: str) -> DataFrame:
    """Different texts that hold an entity: (key, text, copies, base), checkpointed."""
    text = F.col(text_col).cast("string")
    held = find_base(df.select(text.alias("text")), "text", "base").filter(F.size("base") > 0)
    held = held.withColumn("key", F.sha2("text", 256))
    # Copies are counted by key before any text moves twice.
    return materialize(held.groupBy("key").agg(F.count("*").alias("copies"), F.first("text").alias("text"), F.first("base").alias("base")))


def disclosing_terms(
    df: DataFrame,
    texts: DataFrame,
    text_col: str = "text",
    reach: int = REACH,
    min_support: int = MIN_SUPPORT,
    generalise_at: float = GENERALISE_AT,
    pooled: bool = False,
) -> DataFrame:
    """(kind, entity, term, disclosed) for every pair at or over ``generalise_at``; counts cover all rows of ``df``.
    With ``pooled``, pools are listed among the entities."""
    found = _found(texts, pooled)
    per_text = found.select("kind", "entity", "key", "copies").distinct()
    known = per_text.groupBy("kind", "entity").agg(F.count("*").alias("support"), F.sum("copies").alias("n_entity"))
    known = materialize(known.filter(F.col("support") >= min_support).drop("support"))
    near = found.join(bounded_broadcast(known.select("kind", "entity"), BROADCAST_ROWS), ["kind", "entity"])
    # Words of one text meet the entities of that text within reach; both are bucketed by position.
    at = near.withColumn("bucket", F.explode(F.sequence(F.floor((F.col("s") - reach) / reach), F.floor((F.col("e") + reach) / reach))))
    words = texts.join(near.select("key").distinct(), "key", "left_semi").select("key", F.explode(_words(F.col("text"))).alias("w"))
    words = words.select("key", "w.term", F.col("w.s").alias("ws"), F.col("w.e").alias("we"), F.floor(F.col("w.s") / reach).alias("bucket"))
    beside = ((F.col("we") <= F.col("s")) & (F.col("ws") >= F.col("s") - reach)) | ((F.col("ws") >= F.col("e")) & (F.col("we") <= F.col("e") + reach))
    pairs = at.join(words, ["key", "bucket"]).filter(beside).select("kind", "entity", "term", "key", "copies").distinct()
    joint = pairs.groupBy("kind", "entity", "term").agg(F.count("*").alias("support"), F.sum("copies").alias("n_both"))
    joint = materialize(joint.filter(F.col("support") >= min_support).drop("support"))
    terms = materialize(joint.select("term").distinct())
    if terms.isEmpty():  # nothing to count
        return joint.select("kind", "entity", "term", F.lit(0.0).alias("disclosed"))
    every = df.select(F.explode(_distinct_terms(F.col(text_col).cast("string"))).alias("term"))
    n_term = every.join(bounded_broadcast(terms, BROADCAST_ROWS), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_term"))
    n = float(df.count())
    scored = joint.join(known, ["kind", "entity"]).join(n_term, "term").filter(F.col("n_entity") < n)
    pmi = F.log(F.col("n_both") * F.lit(n) / (F.col("n_entity") * F.col("n_term")))
    scored = scored.withColumn("disclosed", pmi / F.log(F.lit(n) / F.col("n_entity")))
    return scored.filter(F.col("disclosed") >= generalise_at).select("kind", "entity", "term", "disclosed")


def _hits(texts: DataFrame, disclosing: DataFrame, remove_at: float) -> DataFrame:
    """(__llm_hit, __llm_removed, __llm_listed): the disclosing terms of each text that holds their entity, by text key."""
    listed = disclosing.groupBy("kind", "entity").agg(F.collect_list(F.struct("term", (F.col("disclosed") >= remove_at).alias("removed"))).alias("terms"))
    held = _found(texts, True).select("key", "kind", "entity").distinct()
    grouped = held.join(listed, ["kind", "entity"]).groupBy(F.col("key").alias("__llm_hit")).agg(F.flatten(F.collect_list("terms")).alias("all"))
    gone = F.transform(F.filter("all", lambda t: t["removed"]), lambda t: t["term"])
    every = F.transform("all", lambda t: t["term"])
    return grouped.select("__llm_hit", F.array_distinct(gone).alias("__llm_removed"), F.array_distinct(every).alias("__llm_listed"))


def find_spans(
    df: DataFrame,
    text_col: str = "text",
    reach: int = REACH,
    min_support: int = MIN_SUPPORT,
    generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
) -> DataFrame:
    """``df`` with __llm_base (base spans) and __llm_terms (spans (s, e, removed) of disclosing terms, by start)."""
    texts = _texts(df, text_col)
    hits = materialize(_hits(texts, disclosing_terms(df, texts, text_col, reach, min_support, generalise_at, pooled=True), remove_at))
    text = F.col(text_col).cast("string")
    marked = find_base(df, text_col, "__llm_base")
    none = F.array().cast("array<struct<s:int,e:int,removed:boolean>>")
    clean = marked.filter(F.size("__llm_base") == 0).withColumn("__llm_terms", none)
    held = marked.filter(F.size("__llm_base") > 0).withColumn("__llm_key", F.sha2(text, 256))
    held = held.join(bounded_broadcast(hits, BROADCAST_ROWS), F.col("__llm_key") == F.col("__llm_hit"), "left")

    def apart(w: Column) -> Column:
        return ~F.exists("__llm_base", lambda b: (b["s"] < w["e"]) & (w["s"] < b["e"]))

    listed = F.filter(_words(text), lambda w: F.array_contains(F.col("__llm_listed"), w["term"]) & apart(w))
    spans = F.transform(listed, lambda w: F.struct(w["s"].alias("s"), w["e"].alias("e"), F.array_contains(F.col("__llm_removed"), w["term"]).alias("removed")))
    held = held.withColumn("__llm_terms", F.when(F.col("__llm_hit").isNotNull(), spans).otherwise(none))
    return clean.unionByName(held.drop("__llm_key", "__llm_hit", "__llm_removed", "__llm_listed"))


def _name(span: Column) -> Column:
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), span["kind"] + 1)
    return F.concat_ws(":", kind, span["s"].cast("string"), span["e"].cast("string"))


def _term_name(span: Column) -> Column:
    kind = F.when(span["removed"], F.lit("removed")).otherwise(F.lit("generalised"))
    return F.concat_ws(":", kind, span["s"].cast("string"), span["e"].cast("string"))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id, counts by kind, base_sha256 and spans (kind:start:end, base spans first)."""
    rows = find_spans(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", **options)
    counts = [F.size(F.filter("__llm_base", _of_kind(i))).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    base = F.transform("__llm_base", _name)
    every = F.concat(base, F.transform("__llm_terms", _term_name))
    return rows.select(
        F.col("id").alias(id_col), *counts, F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans")
    )


def sanitise(df: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """Rows of ``df`` with every span of the text replaced: base spans by their kind, generalised terms
    by what they are made of, removed terms by a blank mark. Overlapping spans become one, marked as the first."""
    rows = find_spans(df, text_col, **options)
    text = F.col(text_col).cast("string")
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    base = F.transform("__llm_base", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.element_at(tags, x["kind"] + 1).alias("tag")))

    def general(x: Column) -> Column:
        word = F.substring(text, x["s"] + 1, x["e"] - x["s"])
        shape = F.when(word.rlike("^[0-9]+$"), "[NUMBER]").when(word.rlike("[0-9]"), "[CODE]").otherwise("[WORD]")
        return F.when(x["removed"], F.lit("[...]")).otherwise(shape)

    terms = F.transform("__llm_terms", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), general(x).alias("tag")))
    rows = rows.withColumn("__llm_cut", F.array_sort(F.concat(base, terms)))
    ends = _running(F.transform("__llm_cut", lambda x: x["e"]), lambda a, b: F.greatest(a, b))
    rows = rows.withColumn("__llm_ends", F.when(F.size("__llm_cut") > 0, ends).otherwise(F.array().cast("array<int>")))
    before = F.slice(F.concat(F.array(F.lit(0)), "__llm_ends"), F.lit(1), F.size("__llm_cut"))

    def part(x: Column, done: Column) -> Column:
        return F.when(x["s"] >= done, F.concat(F.substring(text, done + 1, x["s"] - done), x["tag"])).otherwise(F.lit(""))

    rest = F.substring(text, F.element_at("__llm_ends", -1) + 1, F.length(text))
    new = F.concat(F.array_join(F.zip_with("__llm_cut", before, part), ""), rest)
    rows = rows.withColumn(text_col, F.when(F.size("__llm_cut") > 0, new).otherwise(text))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns])
