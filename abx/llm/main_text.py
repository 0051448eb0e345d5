"""Main text of web pages by their line-block distribution.

Markup is stripped to lines, one a block of text. What can't be article text has no weight: scripts, styles and
comments, elements for menus, headers, footers, sidebars and forms, and elements named so by
their class, id or role; of other lines the characters outside links count. The weights are summed over sliding windows of
``WINDOW`` lines. The text surges where a window's sum passes a threshold and dives where the windows
fall to nothing, and all lines with weight or neighbours inside are kept between the two, short ones too.
Where a page marks its article (``article``, ``main``), lines outside the weightiest one have no weight.

Defined results: a null or empty page, or one without text, gives an empty text; unclosed elements, quotes and
comments end with their parent or the page; character references are decoded once; a null id or url passes
through; repeated rows are returned once each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.llm.common import slices

# Lines of a window. The text surges at windows of SURGE characters, or of half the largest if that is less.
WINDOW = 3
SURGE = 80
NESTED_SHARE = 0.6

# HTML element names and common names of page parts.
SILENT = "script style noscript template svg math iframe object canvas audio video head title textarea select datalist".split()
BOILERPLATE = frozenset("nav footer aside form menu dialog button fieldset legend label".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Inline elements whose mark-up says nothing about page parts; they are not followed.
FORMATTING = frozenset("b i em strong u s small big font code tt sub sup mark abbr cite q kbd samp var time bdi bdo ins del".split())
# Words of a class, id or role that name a part other than the article.
OTHER_PARTS = frozenset(
    "ad ads adv advert advertisement advertising adsense adslot adbox banner sponsor sponsored sponsors promo promotion promoted"
    " cookie cookies consent gdpr popup modal overlay lightbox newsletter subscribe subscription signup login signin paywall"
    " sidebar sidebars widget widgets related recommended recommendation recommendations recirc outbrain taboola"
    " share sharing social comment comments commentlist discussion disqus respond reply replies"
    " nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager topbar toolbar masthead search searchform"
    " footer copyright complementary contentinfo dialog alert alertdialog skip".split()
)
# These name another part unless a word of ARTICLE_PARTS stands beside them.
WEAK_PARTS = frozenset("header side aside notice notices notification notifications disclaimer form meta tags teaser bottom".split())
ARTICLE_PARTS = frozenset("article post entry content story body text main".split())

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)"
    rf"|<(?P<silent>{'|'.join(SILENT)})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>(?:.*?(?:</(?P=silent)\s*>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    # Declarations, and tags with a quote or an end that never comes.
    r"|<[!?/a-zA-Z][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)


@dataclass
class Element:
    name: str
    # Why its lines have no weight: by its own name, by its attributes' words, or neither.
    by_name: bool = False
    by_words: bool = False
    is_main: bool = False
    has_main: bool = False
    parent: Element | None = None
    # Inline and another part itself, or inside such an element.
    other_inline: bool = False
    # Filled in once the page is read: is its text (or its headings) of another part; the innermost article around.
    other: bool = False
    other_headings: bool = False
    main: Element | None = None


@dataclass
class Line:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    inside: Element | None = None
    heading: bool = False
    text: str = ""

    def close(self) -> None:
        self.text = " ".join(html.unescape("".join(self.parts)).split())


def _judge(name: str, attrs: str, parent: Element | None) -> Element:
    el = Element(name, parent=parent)
    words = set()
    if attrs:
        for m in _NAMES.finditer(attrs):
            words.update(w.lower() for w in _WORDS.findall(m.group(1) or m.group(2) or m.group(3) or ""))
        el.by_name = bool(_HIDDEN.search(attrs)) and name not in ("html", "body")
    if name not in ("html", "body"):
        el.by_words = bool(words & OTHER_PARTS) or (bool(words & WEAK_PARTS) and not words & ARTICLE_PARTS)
    el.by_name = el.by_name or name in BOILERPLATE
    if name not in BLOCKS:
        el.other_inline = el.by_name or el.by_words or (parent is not None and parent.other_inline)
    el.is_main = not el.by_words and (name in ("article", "main") or "articlebody" in words or {"article", "body"} <= words)
    return el


def to_lines(page: str) -> tuple[list[Line], list[Element]]:
    """Blocks of text and elements, both in page order."""
    lines, elements = [], []
    line = Line()
    stack: list[Element] = []
    open_names: Counter[str] = Counter()
    link_depth = -1
    heading = 0

    def end_line() -> None:
        nonlocal line
        line.close()
        if line.text:
            lines.append(line)
        line = Line()

    def add(text: str) -> None:
        if not text:
            return
        if stack and stack[-1].other_inline:
            text = " "
        if not line.parts or line.inside is None:
            line.inside = stack[-1] if stack else None
        line.heading = line.heading or heading > 0
        line.parts.append(text)
        if link_depth >= 0:
            line.linked += len("".join(text.split()))

    def pop_to(at: int) -> None:
        nonlocal link_depth
        for el in stack[at:]:
            open_names[el.name] -= 1
        del stack[at:]
        if link_depth > len(stack):
            link_depth = -1

    at = 0
    for m in _MARKUP.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            add(html.escape(m["cdata"]))
            continue
        if m["silent"] or m["name"] is None:
            continue
        name = m["name"].lower()
        if name in BLOCKS:
            end_line()
        if name == "br":
            add(" ")
        if m["close"]:
            if name in HEADINGS:
                heading = max(0, heading - 1)
            if name == "a":
                link_depth = -1
            for i in range(len(stack) - 1, -1, -1) if open_names[name] else ():
                if stack[i].name == name:
                    pop_to(i)
                    break
                if name not in BLOCKS and stack[i].name in BLOCKS:
                    break
            continue
        if name in VOID or name in FORMATTING or m["attrs"].endswith("/") and name not in BLOCKS:
            continue
        if name == "a":
            link_depth = len(stack) if _HREF.search(m["attrs"]) else -1
            continue
        if name in BLOCKS:
            # A block ends an open paragraph, an item the item before it.
            while stack and (stack[-1].name == "p" or stack[-1].name not in BLOCKS or (name == "li" == stack[-1].name)):
                pop_to(len(stack) - 1)
        if name in BLOCKS:
            heading = int(name in HEADINGS)
        el = _judge(name, m["attrs"], stack[-1] if stack else None)
        if name == "header":
            # An article's own header holds its headline.
            el.by_name = True
        up = el.parent if el.is_main else None
        while up is not None and not up.has_main:
            up.has_main = True
            up = up.parent
        stack.append(el)
        elements.append(el)
        open_names[name] += 1
    add(page[at:])
    end_line()
    for el in elements:  # parents come first
        up = el.parent
        # A wrapper that is named after a part beside the article it holds is no such part itself.
        own = el.by_name or (el.by_words and not el.has_main)
        el.main = el if el.is_main else up.main if up else None
        el.other = own or (up is not None and up.other)
        # The headings in an article's own header are its headlines.
        own = own and not (el.name == "header" and el.main is not None)
        el.other_headings = own or (up is not None and up.other_headings)
    return lines, elements


def _other_part(line: Line) -> bool:
    """Does the line stand in an element that is not article text?"""
    el = line.inside
    return el is not None and (el.other_headings if line.heading else el.other)


def _main(line: Line) -> Element | None:
    return line.inside.main if line.inside else None


def _outer_main(main: Element) -> Element | None:
    return main.parent.main if main.parent else None


def weights(lines: list[Line], elements: list[Element]) -> tuple[list[int], list[bool]]:
    """Characters of each line that may be article text, white space and links left out; and whether the line stands
    in the page's article (or in none, where the page marks none)."""
    out = [0 if _other_part(x) else max(0, len(x.text) - x.text.count(" ") - x.linked) for x in lines]
    sums: dict[int, int] = Counter()
    for x, w in zip(lines, out, strict=True):
        sums[id(_main(x))] += w
    mains = [el for el in elements if el.is_main]
    for el in reversed(mains):
        if (outer := _outer_main(el)) is not None:
            sums[id(outer)] += sums[id(el)]
    best = max(mains, key=lambda el: sums[id(el)], default=None)
    if best is None or sums[id(best)] == 0:
        return out, [_main(x) is None for x in lines]
    # An article inside the weightiest element that holds most of it is the article.
    for el in mains:
        if el is not best and _outer_main(el) is best and sums[id(el)] >= NESTED_SHARE * sums[id(best)]:
            best = el
    held = {id(best)}
    for el in mains:
        if id(_outer_main(el)) in held:
            held.add(id(el))
    inside = [id(_main(x)) in held for x in lines]
    return [w if i else 0 for w, i in zip(out, inside, strict=True)], inside


def spans(weight: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """Ranges of lines between a surge and the next dive of the window sums."""
    n = len(weight)
    # Sums of the windows that start before the first line up to those that start at the last one.
    padded = [0] * (window - 1) + weight + [0] * (window - 1)
    sums = [sum(padded[:window])]
    for i in range(1, n + window - 1):
        sums.append(sums[-1] + padded[i + window - 1] - padded[i - 1])
    top = max(sums, default=0)
    if top == 0:
        return []
    least = min(surge, (top + 1) // 2)
    out, start, surged = [], None, False
    for i, total in enumerate(sums):
        if total == 0:
            if surged:
                out.append((start, i))
            start, surged = None, False
            continue
        start = i if start is None else start
        surged = surged or total >= least
    if surged:
        out.append((start, len(sums)))
    ranges = []
    for a, b in out:
        # Windows a..b cover lines from a - (window - 1); the edges without weight are not part of the text.
        lo, hi = max(0, a - window + 1), min(n, b)
        while lo < hi and weight[lo] == 0:
            lo += 1
        while hi > lo and weight[hi - 1] == 0:
            hi -= 1
        ranges.append((lo, hi))
    return ranges


def main_text(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    """The article's blocks, joined by newlines."""
    lines, elements = to_lines(page)
    weight, inside = weights(lines, elements)
    kept = []
    for lo, hi in spans(weight, window, surge):
        # Lines of links alone stay between others, lines of other parts do not.
        kept += [lines[i].text for i in range(lo, hi) if weight[i] > 0 or (inside[i] and not _other_part(lines[i]))]
    return "\n".join(kept)


def extract(
    df: DataFrame,
    html_col: str = "html",
    keep: tuple[str, ...] = ("page_id", "url"),
    window: int = WINDOW,
    surge: int = SURGE,
) -> DataFrame:
    """One row a page: the columns of ``keep``, its main ``text`` and ``n_chars``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pages in slices(batches, "html"):
            texts = [main_text(p.decode("utf-8", "replace"), window, surge) for p in pages]
            cols = [batch.column(f"k{i}") for i in range(len(keep))]
            cols += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*(f"k{i}" for i in range(len(keep))), "text", "n_chars"])

    kinds = [df.schema[c].dataType.simpleString() for c in keep]
    schema = "".join(f"k{i} {t}, " for i, t in enumerate(kinds)) + "text string, n_chars bigint"
    cols = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    out = df.select(*cols, F.col(html_col).cast("string").alias("html")).mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "text", "n_chars")


# The given pages hold one article of headings, paragraphs, line breaks and four kinds of references.
ORACLE = r"""
WITH blocks AS (
  SELECT page_id, url, unnest(string_split(regexp_replace(regexp_replace(
           regexp_extract(html, '<article>(.*)</article>', 1, 's'), '</?(h1|p)>', chr(1), 'g'), '<br>|</?b>', ' ', 'g'), chr(1))) AS b,
         generate_subscripts(string_split(regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'),
           '</?(h1|p)>', chr(1), 'g'), chr(1)), 1) AS i
  FROM pages),
clean AS (
  SELECT page_id, url, i, trim(regexp_replace(replace(replace(regexp_replace(b, '&amp;?', '&amp;', 'g'), '&quot;', '"'), '&amp;', '&'),
                                              '\s+', ' ', 'g')) AS b
  FROM blocks),
joined AS (
  SELECT page_id, url, coalesce(string_agg(b, chr(10) ORDER BY i) FILTER (WHERE b <> ''), '') AS text FROM clean GROUP BY ALL)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM joined
"""
