"""Main text of web pages as the maximum-scoring run of tokens.

A page is a row of tokens: tags, and words between them.  A word scores positive and a tag negative;
the article is the contiguous region with the greatest sum, found in one scan.  What inside the region
belongs to page furniture (menus, notices, adverts, forms, scripts, reader comments) hardly scores
and is left out of the text.

Weights come from labelled pages: a page with exactly one ``article`` element (or, without one, exactly
one ``main``) labels its own tokens, those inside as article.  The tokens of all labelled pages (not
of a sample) are counted by feature; a weight is the logarithm of the odds of being inside, with two
counts added on the expected side and one on the other.  A word's feature is the block element it
stands in, or FURNITURE; a tag's feature is its name, or FURNITURE.  The element that gives the label is
never a feature, so pages without it are scored alike.

Defined cases: a NULL or empty page has an empty text, and so has a page without words outside
furniture; of regions with equal scores the one that ends first counts, without a lead that scores
zero; elements left open end with the page, and a comment or script left open takes the rest of it;
without any labelled page the added counts alone weigh; repeated rows give repeated results; columns
other than page_id, url and html are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices

# Elements by their role in HTML
RAW = "script style title textarea noscript iframe noembed noframes xmp template svg math canvas object audio video"
VOID = "area base br col embed hr img input link meta param source track wbr"
INLINE = (
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr"
)
FURNITURE_TAGS = "head nav footer aside form button select option optgroup fieldset datalist dialog menu label legend"
BLOCKS = (
    "address article blockquote body br caption center col colgroup dd details div dl dt figcaption figure h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html li link main meta ol p pre section summary table tbody td tfoot th thead tr ul"
)
ENDED_BY_OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                     "th": ("td", "th"), "option": ("option",), "body": ("head",)}
HOLDS_BLOCKS = "ul ol dl table select div section article main aside nav blockquote figure form header footer body"
# Words in class, id or role that name page furniture, and such that name the article
FURNITURE_WORDS = (
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu menubar nav "
    "navbar navigation breadcrumb breadcrumbs sidebar sidebars complementary footer contentinfo masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay dialog share "
    "sharing social related recommended recommendations newsletter subscribe subscription signup login search "
    "searchbox widget widgets pagination pager skip"
)
COMMENT_WORDS = "comment comments commentlist discussion disqus respond replies reply"
CONTENT_WORDS = "article content main post entry story body text"
LAYOUT_WORDS = "has with no without"

FURNITURE, OTHER = "furniture", "other"
LARGEST_WEIGHT, LEAST_TAG_COST = 4.0, 0.05
# Furniture in the middle of an article must not outweigh the words around it.
FURNITURE_COST = 0.25
_SLICE_BYTES = 4 << 20


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


_void, _inline, _furniture_tags, _holds_blocks = _set(VOID), _set(INLINE), _set(FURNITURE_TAGS), _set(HOLDS_BLOCKS)
_furniture_words, _comment_words = _set(FURNITURE_WORDS), _set(COMMENT_WORDS)
_content_words, _layout_words = _set(CONTENT_WORDS), _set(LAYOUT_WORDS)
_features = _set(BLOCKS) | _inline | _furniture_tags | {FURNITURE}
_raw = _set(RAW)
_MARK = re.compile(
    r"<(?:(/?)([a-zA-Z][^\s/<>]*)([^<>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^<>\"']*+)*+)>|(!--)|[!?/][^>]*>)"
)
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in _raw}
_ended = {name: (*kinds, "p") for name, kinds in ENDED_BY_OWN_KIND.items()}
_NAMING = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LABEL = re.compile(r"<(article|main)(?=[\s/>])", re.IGNORECASE)


@lru_cache(maxsize=1024)
def _named_roles(rest: str) -> tuple[bool, bool, bool]:
    """(furniture, header, comments) by the class, id and role of a tag."""
    furniture = header = comments = content = False
    for token in " ".join("".join(found) for found in _NAMING.findall(rest)).split():
        words = {w.lower() for w in _WORD.findall(token)}
        comments |= bool(words & _comment_words)
        content |= bool(words) and words <= _content_words
        if not words & _layout_words:
            furniture |= bool(words & _furniture_words)
            header |= "header" in words
    return furniture and not content, header and not content, comments


class _Open:
    """An open element and what it makes of its words."""

    __slots__ = ("name", "feature", "furniture", "comments", "article")

    def __init__(self, name: str, rest: str, outer: _Open | None, label: str | None):
        named, header, comments = _named_roles(rest) if "=" in rest else (False, False, False)
        inside = outer is not None and outer.article
        top = name in ("html", "body")
        self.name = name
        self.feature = OTHER
        if name in _inline and outer is not None:
            self.feature = outer.feature
        elif name in _features:
            self.feature = name
        self.comments = (comments and not top) or (outer is not None and outer.comments)
        self.article = (inside or name == label) and not self.comments
        if name == label and not self.comments:
            self.furniture = False  # the only article ends furniture that was left open before it
            return
        # A header belongs to the article only inside it.
        header = not inside and (header or name in ("header", "hgroup"))
        own = not top and (named and name not in ("article", "main") or header or name in _furniture_tags)
        self.furniture = own or self.comments or (outer is not None and outer.furniture)


def label_element(page: str) -> str | None:
    """The element that labels the page, if it occurs exactly once."""
    found = Counter(name.lower() for name in _LABEL.findall(page))
    name = "article" if found["article"] else "main"
    return name if found[name] == 1 else None


def tokens_of(page: str, label: str | None) -> list[tuple[str, str, bool, str]]:
    """(kind, feature, inside the article, text) of words and tags in page order.

    ``kind`` is words, tag or break, the edge of a block.  Inline elements that name no furniture
    are never open, so left-open ones cannot pile up.
    """
    tokens: list[tuple[str, str, bool, str]] = []
    stack: list[_Open] = []
    still_open: Counter = Counter()

    def close(at: int) -> None:
        for element in stack[at:]:
            still_open[element.name] -= 1
        del stack[at:]

    def words(text: str) -> None:
        top = stack[-1] if stack else None
        if top is None:
            tokens.append(("words", OTHER, False, text))
        elif top.furniture:
            tokens.append(("words", FURNITURE, False, text))
        else:
            tokens.append(("words", top.feature, top.article, text))

    position = 0
    while (found := _MARK.search(page, position)) is not None:
        if found.start() > position:
            words(page[position : found.start()])
        position = found.end()
        end, name, rest, comment = found.groups()
        if comment:
            stop = page.find("-->", position - 2)
            position = len(page) if stop < 0 else stop + 3
        if not name:
            continue
        name = name.lower()
        inline = name in _inline
        outer = stack[-1] if stack else None
        if end:
            if still_open[name]:
                at = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name)
                outer = stack[at]
                close(at)
            elif not inline:
                continue
            furniture, article = (outer.furniture, outer.article) if outer else (False, False)
        elif name in _raw:
            raw_end = _RAW_ENDS[name].search(page, position)
            position = len(page) if raw_end is None else raw_end.end()
            continue
        elif inline and not rest:
            furniture, article = (outer.furniture, outer.article) if outer else (False, False)
        else:
            if not inline:
                ended = _ended[name] if name in _ended else ("p",)
                for at in range(len(stack) - 1, -1, -1):
                    if stack[at].name in ended:
                        close(at)
                        break
                    if stack[at].name in _holds_blocks:
                        break
                outer = stack[-1] if stack else None
            element = _Open(name, rest, outer, label)
            furniture, article = element.furniture, element.article
            plain = inline and furniture == (outer is not None and outer.furniture)
            if not (plain or name in _void or rest.endswith("/") and name not in _features):
                stack.append(element)
                still_open[name] += 1
        if name not in ("article", "main"):
            feature = FURNITURE if furniture else name if name in _features else OTHER
            tokens.append(("tag", feature, article and not furniture, ""))
        if not inline:
            tokens.append(("break", name, False, ""))
    if position < len(page):
        words(page[position:])
    return tokens


def weight_of(kind: str, feature: str, within: int = 0, outside: int = 0) -> float:
    """Positive for words and negative for tags as far as the counts do not say otherwise."""
    if feature == FURNITURE:
        odds = math.log((within + 1) / (outside + 2))
        return min(0.0 if kind == "words" else -LEAST_TAG_COST, max(-FURNITURE_COST, odds))
    if kind == "words":
        odds = math.log((within + 2) / (outside + 1))
        return min(LARGEST_WEIGHT, max(-FURNITURE_COST, odds))
    odds = math.log((within + 1) / (outside + 2))
    return min(-LEAST_TAG_COST, max(-LARGEST_WEIGHT, odds))


def learned_weights(pages: DataFrame) -> dict[tuple[str, str], float]:
    """Weight by (kind, feature) from all labelled pages; at most two rows per feature are fetched."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column("html"):
                page = page.as_py() or ""
                label = label_element(page)
                for kind, feature, inside, text in tokens_of(page, label) if label else ():
                    if kind != "break":
                        total[kind, feature, inside] += len(text.split()) if kind == "words" else 1
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.string()),
                pa.array([total[k] if k[2] else 0 for k in keys], pa.int64()),
                pa.array([0 if k[2] else total[k] for k in keys], pa.int64()),
            ],
            names=["kind", "feature", "within", "outside"],
        )

    counted = pages.select("html").mapInArrow(count, "kind string, feature string, within long, outside long")
    sums = counted.groupBy("kind", "feature").agg(F.sum("within").alias("within"), F.sum("outside").alias("outside"))
    return {(r.kind, r.feature): weight_of(r.kind, r.feature, r.within, r.outside) for r in sums.collect()}


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and stop of the contiguous region with the greatest positive sum; empty if there is none."""
    best, start, stop = 0.0, 0, 0
    running, since = 0.0, 0
    for i, score in enumerate(scores):
        if running <= 0:
            running, since = 0.0, i
        running += score
        if running > best:
            best, start, stop = running, since, i + 1
    return start, stop


def extract(page: str | None, weights: Mapping[tuple[str, str], float]) -> str:
    """The article of one page: its blocks in page order, joined by one space."""
    page = page or ""
    tokens = list(tokens_of(page, label_element(page)))
    scores = []
    for kind, feature, _, text in tokens:
        if kind == "break":
            scores.append(0.0)
            continue
        weight = weights.get((kind, feature))
        if weight is None:
            weight = weight_of(kind, feature)
        scores.append(weight * len(text.split()) if kind == "words" else weight)
    start, stop = best_region(scores)
    pieces = []
    for kind, feature, _, text in tokens[start:stop]:
        if kind == "break":
            pieces.append(" ")
        elif kind == "words" and feature != FURNITURE:
            pieces.append(html.unescape(text))
    return " ".join("".join(pieces).split())


def main_texts(pages: DataFrame, weights: Mapping[tuple[str, str], float] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, with given weights or with those of ``pages``."""
    weights = learned_weights(pages) if weights is None else dict(weights)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in byte_slices(batch.column("html"), _SLICE_BYTES):
                texts = [extract(page.as_py(), weights) for page in batch.column("html")[start:stop]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id")[start:stop],
                        batch.column("url")[start:stop],
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")


# The same in SQL, for tables whose pages mark the article as one element of plain paragraphs.
def oracle_sql() -> str:
    return r"""
WITH inner_html AS (
  SELECT page_id, url, coalesce(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '') AS h FROM pages),
plain AS (
  SELECT page_id, url, regexp_replace(regexp_replace(h, '</?(p|h1|br)>', ' ', 'g'), '</?b>', '', 'g') AS t FROM inner_html),
decoded AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t,
    '&quot;?', '"', 'g'), '&#x27;', '''', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') AS t FROM plain),
joined AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM decoded)
SELECT page_id, url, text, length(text) AS n_chars FROM joined"""
