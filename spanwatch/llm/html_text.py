"""The main text of web pages, by the maximum-scoring stretch of the page.

A page is a sequence of tags and words. Words score by where they stand (block, link, kind of
container), most of them above zero; tags score below zero. The weights are log odds counted on
labelled pages: pages that mark their article up as such tell which of their words and tags
belong to it. One linear scan finds the best contiguous stretch; the blocks in it that do not
stand in a menu, form, advert or comment are the text.
"""

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from spanwatch.llm.common import whole_row

# At most so many pages are learned from.
LABELLED_PAGES = 2_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^<>]*>|<\?[^<>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)"
    r"(?P<attributes>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL,
)
# Attributes one after another: a name is read whole, and a value is never looked into for one.
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'<>]+))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Elements as the language defines them.
SILENT = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math",
          "object", "video", "audio", "canvas", "select", "option", "datalist", "head"}
# Without an end tag these hold the rest of the page; of the others the tag alone is left out.
RAW = {"script", "style", "textarea", "title"}
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style",
           "template", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
         "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1",
         "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main",
         "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
         "th", "thead", "tr", "ul"}
ENDS_PARAGRAPH = BLOCK - {"html", "body"}
# Elements that hold other blocks. All else holds text, and a name such as "related-work" on it
# says what the text is about rather than what it is for.
HOLDER = BLOCK - {"address", "blockquote", "caption", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6",
                  "legend", "p", "pre", "summary"}
# An element of the key ends one of the value that is still open, up to the given ancestors.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
           "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

# Elements, roles and parts of class names or ids that say what is not the article: of a holder of
# blocks any part does, of a text all parts of the name. A text with other parts beside is judged
# by a weight for such texts, learned like those of all words.
OUTSIDE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "header", "fieldset"}
OUTSIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog",
                 "alert", "alertdialog", "form", "menu", "menubar", "toolbar"}
OUTSIDE_NAMES = {"ad", "ads", "adv", "adsense", "nav", "navbar", "skip", "search", "toc", "gdpr",
                 "login", "signup", "signin", "header", "topbar", "rss", "hidden", "byline"}
OUTSIDE_STARTS = ("advert", "sponsor", "promo", "comment", "cookie", "newsletter", "subscri",
                  "sidebar", "breadcrumb", "navig", "footer", "masthead", "share", "sharing",
                  "social", "related", "recommend", "popup", "modal", "banner", "widget",
                  "disqus", "menu", "consent", "paginat", "toolbar", "notice", "notif", "alert",
                  "disclaim", "copyright", "replies", "reply", "respond", "discussion", "teaser",
                  "outbrain", "taboola", "overlay")
NOT_ABOUT_ITSELF = {"has", "with", "no", "without", "is"}
ARTICLE_NAMES = {"articlebody", "articletext"}

# What is known before any page: (inside, outside) counts for words in a block.
PRIOR = {"p": (20, 2), "h1": (6, 2), "h2": (4, 2), "h3": (4, 2), "blockquote": (4, 1),
         "pre": (4, 1), "figcaption": (3, 2), "li": (6, 3), "td": (4, 3), "div": (6, 2),
         "body": (3, 2), "p/link": (5, 3), "blockquote/link": (4, 3)}
OTHER_PRIOR, LINK_PRIOR, OUTSIDE_PRIOR, NAMED_PRIOR = (3, 2), (2, 8), (1, 60), (3, 2)
WORD_RANGE, TAG_RANGE = (-2.0, 1.0), (-0.2, -0.02)
# What one menu, advert or form costs at most, so that the article may go on after it.
OUTSIDE_COST = -4.0


@dataclass
class Piece:
    """A tag, or the text between two tags, and where it stands."""

    kind: str  # "tag" or "text"
    name: str  # of the tag; of the feature of words
    text: str = ""
    block: int = 0
    outside: bool = False
    inside: bool = False  # in what the page marks up as its article


@dataclass
class _Element:
    tag: str
    outside: bool
    article: bool
    where: str = "body"  # the block that its text stands in
    named: bool = False  # a name on it that elsewhere would say that it is not the article


class _Open:
    """The open elements. Where the last of a tag or of the blocks stands is known, so that no tag
    costs a walk over those that a page leaves open."""

    def __init__(self):
        self.stack: list[_Element] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.links = self.closed = 0

    def top(self) -> _Element:
        return self.stack[-1] if self.stack else _Element("body", False, False)

    def last(self, tags) -> int:
        """The place of the last open element of some tags, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def push(self, element: _Element) -> None:
        place = len(self.stack)
        self.stack.append(element)
        self.places.setdefault(element.tag, []).append(place)
        self.links += element.tag == "a"
        if element.tag in BLOCK:
            self.blocks.append(place)

    def pop(self, upto: int) -> None:
        while len(self.stack) > upto:
            gone = self.stack.pop()
            self.places[gone.tag].pop()
            self.links -= gone.tag == "a"
            if gone.tag in BLOCK:
                self.blocks.pop()
                self.closed += 1


@dataclass
class Weights:
    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)


def _says_outside(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether names or roles say that an element is not the article, or is, or whether a name
    only leaves it open. Names and values are read whole, in any case of letters."""
    out = article = named = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            out |= value.lower() in OUTSIDE_ROLES
            article |= value.lower() in ("main", "article")
        elif name == "itemprop":
            article |= value.lower() in ARTICLE_NAMES
        elif name == "hidden":
            out = True
        elif name in ("class", "id"):
            for word in value.split():
                parts = [x.lower() for x in NAME_PART.findall(word)]
                if not parts or parts[0] in NOT_ABOUT_ITSELF:
                    continue
                words = [x for x in parts if not x.isdigit()]
                listed = [x in OUTSIDE_NAMES or x.startswith(OUTSIDE_STARTS) for x in words]
                if any(listed):
                    sure = tag in HOLDER or all(listed)
                    out, named = out or sure, named or not sure
    return out, article, named


def _silent_end(page: str, tag: str, at: int) -> int | None:
    """Where a silent element that opens before `at` ends, if it has an end tag."""
    end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
    return end.end() if end else None


def _head_end(page: str, at: int) -> int:
    """Where a head without an end tag ends: at the first thing that cannot stand in it."""
    match = TOKEN.search(page, at)
    while match:
        if page[at : match.start()].strip():
            return at
        tag = (match["tag"] or "").lower()
        if tag and (tag in ("html", "body") if match["close"] else tag not in IN_HEAD):
            return match.start()
        at = match.end()
        if tag in SILENT and not match["close"]:
            end = _silent_end(page, tag, at)
            if end is None and tag in RAW and not match["attributes"].rstrip().endswith("/"):
                return len(page)
            at = end or at
        match = TOKEN.search(page, at)
    return at


def pieces(page: str) -> list[Piece]:
    """The page as tags and texts. Elements that show nothing are left out with their content."""
    found: list[Piece] = []
    opened = _Open()
    begun, at = 0, 0
    # Silent elements with no end tag from here on, looked for once.
    endless: set[str] = set()

    def block() -> int:
        return begun + opened.closed

    def text(raw: str) -> None:
        if not raw:
            return
        top = opened.top()
        name = top.where + ("/link" if opened.links else "/named" if top.named else "")
        name = "outside" if top.outside else name
        found.append(Piece("text", name, raw, block(), top.outside, top.article and not top.outside))

    match = TOKEN.search(page)
    while match:
        text(page[at : match.start()])
        at = match.end()
        tag = (match["tag"] or "").lower()
        if tag and not match["close"] and tag in SILENT:
            end = None if tag in endless else _silent_end(page, tag, at)
            if end is not None:
                at = end
            else:
                endless.add(tag)
                if tag == "head":
                    at = _head_end(page, at)
                elif tag in RAW and not match["attributes"].rstrip().endswith("/"):
                    at = len(page)
        elif tag and match["close"]:
            place = opened.last((tag,))
            if place >= 0:
                top = opened.stack[place]
                opened.pop(place)
                found.append(Piece("tag", tag, "", block(), top.outside, top.article))
        elif tag:
            if tag in ENDS_PARAGRAPH and opened.blocks:
                place = opened.blocks[-1]
                if opened.stack[place].tag == "p":
                    opened.pop(place)
            if tag in IMPLIED:
                ended, limit = IMPLIED[tag]
                place = opened.last(ended)
                if place > opened.last(limit):
                    opened.pop(place)
            above = opened.top()
            out, marked, named = _says_outside(tag, match["attributes"] or "")
            article = tag in ("article", "main") or marked
            if tag in ("html", "body", "main"):
                out = named = False
            outside = out or (tag in OUTSIDE_TAGS and not (tag == "header" and above.article))
            element = _Element(
                tag,
                above.outside or outside,
                above.article or article,
                tag if tag in BLOCK else above.where,
                named or (tag not in BLOCK and above.named),
            )
            begun += tag in BLOCK
            found.append(Piece("tag", tag, "", block(), element.outside, element.article))
            if tag == "br":
                found.append(Piece("text", "", "\n", block(), element.outside))
            if tag not in VOID and not match["attributes"].endswith("/"):
                opened.push(element)
        match = TOKEN.search(page, at)
    text(page[at:])
    return found


def counts(page: str) -> Counter | None:
    """(kind, name, inside) of words and tags; None if the page does not mark up an article."""
    found = pieces(page)
    if not any(p.inside for p in found):
        return None
    total: Counter = Counter()
    for p in found:
        total[p.kind, p.name, p.inside] += len(p.text.split()) if p.kind == "text" else 1
    return total


def weights(total: Counter) -> Weights:
    """Log odds of belonging to an article, on top of what is known before any page."""
    names = {(k, n) for k, n, _ in total}
    result = Weights()
    for kind, name in names | {("text", n) for n in PRIOR} | {("text", "outside")}:
        inside, outside = total[kind, name, True], total[kind, name, False]
        if kind == "text":
            a, b = _prior(name)
            score = math.log((inside + a) / (outside + b))
            result.words[name] = min(max(score, WORD_RANGE[0]), WORD_RANGE[1])
        else:
            score = math.log((inside + 1) / (outside + 1)) - 0.2
            result.tags[name] = min(max(score, TAG_RANGE[0]), TAG_RANGE[1])
    return result


def _prior(name: str) -> tuple[int, int]:
    if name == "outside":
        return OUTSIDE_PRIOR
    if name.endswith("/named"):
        return NAMED_PRIOR
    return PRIOR.get(name) or (LINK_PRIOR if name.endswith("/link") else OTHER_PRIOR)


def scores(found: list[Piece], using: Weights) -> list[float]:
    """Of every piece. What stands outside together costs no more than `OUTSIDE_COST`."""
    result, run = [], 0.0
    for p in found:
        if p.kind == "tag":
            score = using.tags.get(p.name, TAG_RANGE[0])
        else:
            known = using.words.get(p.name)
            if known is None:
                a, b = _prior(p.name)
                known = math.log(a / b)
            score = len(p.text.split()) * known
        if p.outside:
            score = max(score, OUTSIDE_COST - run)
            run += score
        else:
            run = 0.0
        result.append(score)
    return result


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """[begin, end) of the highest positive sum, the first of equals; (0, 0) if there is none."""
    best, sum_now, begin, found = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if sum_now <= 0:
            sum_now, begin = 0.0, i
        sum_now += score
        if sum_now > best + 1e-12:
            best, found = sum_now, (begin, i + 1)
    return found


def main_text(page: str | None, using: Weights) -> str:
    """Blocks of the best stretch, one line each; empty if the page is null or has none."""
    if not page:
        return ""
    found = pieces(page)
    begin, end = best_stretch(scores(found, using))
    lines, last = [], None
    for p in found[begin:end]:
        if p.kind == "text" and not p.outside:
            if p.block != last:
                lines.append([])
                last = p.block
            lines[-1].append(p.text)
    blocks = (" ".join(html.unescape("".join(parts)).split()) for parts in lines)
    return "\n".join(b for b in blocks if b)


def fit(
    pages: DataFrame, page: str = "html", key: str = "page_id", most: int = LABELLED_PAGES
) -> Weights:
    """Counts words and tags on at most `most` pages that mark up their article, chosen by hash.

    Without such pages the weights are those known before any page.
    """
    marked = pages.filter(F.col(page).rlike(r"(?i)<(article|main)\b|articleBody")).select(
        F.col(key).alias("_key"), F.col(page).alias("_page")
    )
    chosen = (
        marked.select("_key")
        .distinct()
        .orderBy(F.xxhash64("_key", F.lit("html")), "_key")
        .limit(most)
        .withColumnRenamed("_key", "_chosen")
    )
    picked = (
        marked.join(F.broadcast(chosen), F.col("_key").eqNullSafe(F.col("_chosen")))
        .groupBy("_key")
        .agg(F.min("_page").alias("_page"))
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for body in batch["_page"]:
                total.update(counts(body) or {})
        rows = [(*k, n) for k, n in total.items()]
        yield pd.DataFrame(rows, columns=["kind", "name", "inside", "n"])

    summed = (
        picked.mapInPandas(count, "kind string, name string, inside boolean, n long")
        .groupBy("kind", "name", "inside")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    return weights(Counter({(r["kind"], r["name"], r["inside"]): r["n"] for r in summed}))


def extract(pages: DataFrame, using: Weights, page: str = "html") -> DataFrame:
    """`pages` with `text` and `n_chars` (its code points), both replaced if they exist.

    A null, empty or text-free page has an empty text. Whole pages are read, however long. White
    space, a line break element included, is one space within a block; blocks are lines.
    """

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [main_text(body, using) for body in batch]
            yield pd.DataFrame({"text": found, "n_chars": [len(t) for t in found]})

    read = F.pandas_udf(texts, "text string, n_chars long")
    found = pages.select(whole_row(pages, "text", "n_chars"), read(F.col(page)).alias("_found"))
    return found.select("_row.*", "_found.text", "_found.n_chars")
