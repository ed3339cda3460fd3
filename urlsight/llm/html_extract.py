"""Main-text extraction from HTML by the maximum-scoring subsequence of a page.

A page becomes a sequence of words and tags. Words score positive and tags
negative; a word's weight depends on the kind of container it stands in and on
whether it is link text, a tag's on its name and container. The weights are log
ratios learned from labelled pages: pages that mark their content with an
``article`` or ``main`` element, counted over the whole table. On a page without
such an element, a word's weight comes from the shape of its block (heading or
not, share of link text, length), learned from the same pages as if they weren't marked.
One linear scan finds the contiguous region with the largest sum; its blocks,
less those in menus, adverts and the like, are the text.

An ``article`` inside of a comment list, a sidebar or the like is part of that, and one
whose own class says that it is a comment or a teaser is no content.

Class names and ids are hints only. They count for nothing on ``html``, ``body``
and headings, and on a container with most of the page's scored words (inside of
``article`` or ``main``, a class like "ad" alone still tells). Hints
of several meanings (``AMBIGUOUS``), and any id of a section, only lower the weight of
the container's words; its text is left out if its links outweigh them.
"""
from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, with_columns_checked

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|(</?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>?|[^<]+|<""", re.S)
# Element names by their role in HTML.
UNSEEN = {"script", "style", "noscript", "template", "title", "textarea", "svg", "math", "iframe", "object", "canvas", "audio", "video"}
CONTENT = {"article", "main"}
BOILER = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "dialog": "notice",
          "button": "form", "select": "form", "fieldset": "form", "head": "head"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
          "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "input"}
CONTAINERS = {"div", "section", "ul", "ol", "dl", "table", "body", "html", "blockquote", "figure", "details", "center"}
LOOSE = {"p", "li", "dt", "dd", "h1", "h2", "h3", "h4", "h5", "h6"}  # their end tags may be left out
PROSE = LOOSE | INLINE
ROLES = {"navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header", "contentinfo": "footer", "complementary": "side",
         "search": "form", "form": "form", "alert": "notice", "alertdialog": "notice", "dialog": "notice"}
# Words in class names and ids that tell what a container is for.
HINTS = [
    ("advert", {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "adsense"}),
    ("comments", {"comment", "comments", "disqus", "replies", "respond", "discussion"}),
    ("menu", {"nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc"}),
    ("side", {"sidebar", "side", "aside", "related", "recommended", "widget", "widgets", "share", "sharing", "social", "tags"}),
    ("notice", {"cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "paywall", "alert"}),
    ("header", {"header", "masthead", "topbar"}),
    ("footer", {"footer", "copyright", "legal"}),
    ("form", {"form", "login", "signup", "search"}),
]
# Hints that name a part of the text as often as a part of the page.
AMBIGUOUS = {"advertising", "promotion", "banner", "comment", "replies", "respond", "discussion", "navigation", "menu", "toc", "side", "related",
             "recommended", "widget", "widgets", "share", "sharing", "social", "tags", "consent", "notice", "overlay", "subscribe", "alert",
             "header", "topbar", "copyright", "legal", "form", "login", "signup", "search"}
# First words of class names that make an article element a comment or a teaser, and beginnings of class names that file a page under something.
NOT_ARTICLES = [("comments", {"comment", "comments", "reply", "replies", "response"}), ("advert", {"ad", "ads", "advert", "sponsored", "promo"}),
                ("side", {"related", "teaser", "recommended", "sidebar"})]
TAXONOMY = ("tag-", "category-", "type-", "format-", "status-", "post-")
NO_HINTS = {"html", "body", "h1", "h2", "h3", "h4", "h5", "h6"}
ABOUT = {"has", "have", "no", "with", "without"}  # "has-sidebar" is not the sidebar
NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]*))?""", re.I)
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


def container_kind(name: str, attributes: str) -> tuple[str | None, str]:
    """What an element is for ("content", a kind of boilerplate, or None), and by what: "markup", a "whole" name, part of a "name" or an "ambiguous" one."""
    if name in CONTENT:
        names = [v.strip("\"'").lower() for k, v in NAMES.findall(attributes) if k.lower() in ("class", "id")]
        words = {w for v in names for one in v.split() if not one.startswith(TAXONOMY) for w in SPLIT.split(one)[:1]}
        kind = next((kind for kind, hints in NOT_ARTICLES if words & hints), None)
        return (kind, "name") if kind else ("content", "markup")
    if name in BOILER:
        return BOILER[name], "markup"
    if name in INLINE or name in ("html", "body") or not attributes.strip():
        return None, "markup"
    hinted = None, "markup"
    for key, value in NAMES.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return "hidden", "markup"
        if key == "role" and value.lower() in ROLES:
            return ROLES[value.lower()], "markup"
        if key in ("class", "id") and name not in NO_HINTS and hinted[1] != "whole":
            words = set()
            for one in value.split():
                for parts in ([w.lower() for w in SPLIT.split(one) if w], [w for w in SPLIT.split(one.lower()) if w]):
                    words |= {w for k, w in enumerate(parts) if not k or parts[k - 1] not in ABOUT}
            sure = set() if key == "id" and name == "section" else words - AMBIGUOUS
            ways = {"whole": sure & set(value.lower().split()), "name": sure, "ambiguous": words if name not in LOOSE else set()}
            for how, among in ways.items():
                kind = next((kind for kind, hints in HINTS if among & hints), None)
                if kind and (not hinted[0] or how == "whole" or hinted[1] == "ambiguous"):
                    hinted = kind, how
                    break
    return hinted


def events(page: str) -> list[tuple[str, str, str]]:
    """``(what, kind, value)``: "tag" with its name, "text" with its characters ("link": inside a link).

    ``kind`` is that of the innermost telling container: "content", a kind of
    boilerplate ("in-" and the kind inside of content), "soft" (under an
    ambiguous name) or "body".
    """
    named: dict[int, list] = {}
    found = list(_walk(page, None, named))
    if not named:
        return found
    total = named.pop(-1)[2]  # words
    kinds: dict[int, str | None] = {}
    for at, (kind, how, words, links, within) in named.items():
        if 2 * words > total and not (within and how == "whole"):
            kinds[at] = None  # the page itself, whatever its name
        elif how == "ambiguous" and words * SOFT * DEFAULTS["word"] + links * DEFAULTS["link"] > 0:
            kinds[at] = "soft"
        else:
            kinds[at] = "own" if how == "ambiguous" and kind == "header" else kind
    return list(_walk(page, kinds, None))


def _walk(page: str, settled: dict[int, str | None] | None, named: dict[int, list] | None) -> Iterator[tuple[str, str, str]]:
    """The events of a page. ``settled``: the kinds of named containers by their place.

    Without it names count for nothing, and ``named`` gets ``[kind, how, words, link words, inside of content]``
    of each named container (at -1: of the page), of text that isn't boilerplate by its markup.
    """
    stack: list[tuple[str, int]] = []
    kinds = ["body"]
    links, skip_to, end = 0, 0, len(page)
    seen = [0, 0]  # words, link words

    def leave(at: int) -> None:
        for _, place in stack[at:]:
            if place >= 0:
                entry = named[place]
                entry[2:4] = seen[0] - entry[2], seen[1] - entry[3]
        del stack[at:], kinds[at + 1:]

    for m in TOKEN.finditer(page):
        if m.start() < skip_to:
            continue
        opened, name = m.group(1), m.group(2)
        if name is None:
            token = m.group(0)
            if token[0] != "<" or token == "<":
                if named is not None and kinds[-1] in ("body", "content"):
                    seen[links] += len(entities.unescape(token).split())
                yield ("link" if links else "text"), kinds[-1], token
            continue
        name = name.lower()
        if opened == "<":
            if name in UNSEEN:
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, m.end())
                skip_to = close.end() if close else end
                yield "tag", kinds[-1], name
                continue
            if name not in INLINE and stack and stack[-1][0] in LOOSE:
                leave(len(stack) - 1)  # a paragraph ends where the next block begins
            kind, how = container_kind(name, m.group(3))
            place = -1
            if name == "header" and kinds[-1] == "content":
                kind = None  # an article's own heading
            if kind == "content" and kinds[-1] not in ("body", "soft", "content"):
                kind = None  # part of a comment list, a sidebar, ...
            if kind and how != "markup":
                if settled is None:
                    place = m.start()
                    named[place] = [kind, how, *seen, kinds[-1] == "content"]
                    kind = None
                else:
                    kind = settled.get(m.start())
                    if name in CONTENT and kind is None and kinds[-1] in ("body", "soft"):
                        kind = "content"  # most of the page, whatever its class
                    within = kinds[-1] == "content" or kinds[-1].startswith("in-")
                    if kind == "own":
                        kind = None if within else "header"
                    if kind == "soft" and kinds[-1] != "body":
                        kind = None
            if kind and kind != "content" and (kinds[-1] == "content" or kinds[-1].startswith("in-")):
                kind = f"in-{kind}"  # left out of the text, but no reason to end the region
            if kind or place >= 0 or name in CONTAINERS:
                stack.append((name, place))
                kinds.append(kind or kinds[-1])
            elif name == "a":
                links = 1
            yield "tag", kinds[-1], name
        else:
            yield "tag", kinds[-1], name
            if name == "a":
                links = 0
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == name:
                    leave(at)
                    break
    leave(0)
    if named:
        named[-1] = ["", "", *seen, False]


def blocks(page: str) -> list[tuple[str, str, int, int, list[str]]]:
    """``(text, kind, words, link words, tags before)`` in page order; the last may be empty text with the closing tags."""
    found, parts, tags = [], [], []
    links = words = 0
    kind = "body"

    def close() -> None:
        nonlocal parts, tags, links, words
        text = " ".join("".join(parts).split())
        if text:
            found.append((text, kind, words, links, tags))
            tags = []
        parts, links, words = [], 0, 0

    for what, now, value in events(page):
        if what == "tag":
            if value == "br":
                parts.append(" ")
            elif value not in INLINE:
                close()
            tags.append(f"{now} {value if value in KNOWN else 'other'}")
            continue
        if now != kind:
            close()
            kind = now
        plain = entities.unescape(value)
        n = len(plain.split())
        words += n
        links += n if what == "link" else 0
        parts.append(plain)
    close()
    found.append(("", "body", 0, 0, tags))
    return found


KNOWN = (INLINE | CONTAINERS | CONTENT | set(BOILER) | UNSEEN | {f"h{i}" for i in range(1, 7)}
         | {"p", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "pre", "hr", "meta", "link", "figcaption", "caption", "summary", "address"})
LIMIT = 4.0
HEADINGS = {f"h{i}" for i in range(1, 7)}
DEFAULTS = {"word": 1.0, "link": -1.0, "prose tag": -0.5, "tag": -2.0}
UNMARKED_TAG = -0.3  # of any tag on a page without article and main
SOFT = 0.5  # share of its weight that a word keeps under an ambiguous name
PLAIN = {"body", "soft"}


def shape(words: int, links: int, tags: list[str]) -> str:
    """What a block looks like without regard to its container."""
    heading = bool(tags) and tags[-1].split(" ")[1] in HEADINGS
    linked = sum(links > words * part for part in (0, 0.33, 0.66))
    length = sum(words >= n for n in (5, 12, 30))
    return f"shape {'heading' if heading else 'text'}-{linked}-{length}"


def is_labelled(found: list[tuple]) -> bool:
    return any(t in ("content article", "content main") for b in found for t in b[4])


def page_counts(page: str) -> Counter:
    """Words and tags inside and outside the labelled content; empty if the page isn't labelled."""
    count: Counter = Counter()
    found = blocks(page)
    if not is_labelled(found):
        return count
    for text, kind, words, links, tags in found:
        side = int(kind == "content")
        if text and kind in {"content"} | PLAIN:
            count[shape(words, links, tags), side] += words
        # on a labelled page, text outside of any telling container is not content
        count[f"word {'outside' if kind in PLAIN else kind}", side] += words - links
        count[f"link {'outside' if kind in PLAIN else kind}", side] += links
        for t in tags:
            count[f"tag {t}", int(t.startswith("content "))] += 1
    return +count


def learn(pages: DataFrame) -> dict[str, float]:
    """Weights of words and tags from all labelled pages: log ratios, tags never above -0.1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                total.update(page_counts(page.as_py() or ""))
        rows = [(f, side, n) for (f, side), n in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                                          pa.array([r[2] for r in rows], pa.int64())], ["feature", "side", "n"])

    bounded_batches(pages.sparkSession)
    counted = with_columns_checked(pages, "html").mapInArrow(run, "feature string, side int, n long")
    # at most (kinds x known names) rows
    rows = counted.groupBy("feature").agg(F.sum(F.when(F.col("side") == 1, F.col("n"))).alias("inside"),
                                          F.sum(F.when(F.col("side") == 0, F.col("n"))).alias("outside")).collect()
    sums = {what: [sum(getattr(r, side) or 0 for r in rows if r.feature.startswith(what)) + 1.0 for side in ("inside", "outside")]
            for what in ("word", "link", "tag", "shape")}
    weights = {}
    for r in rows:
        what = r.feature.split(" ")[0]
        if what == "shape":
            value = math.log(((r.inside or 0) + 0.5) / sums[what][0]) - math.log(((r.outside or 0) + 0.5) / sums[what][1])
            weights[r.feature] = max(-LIMIT, min(LIMIT, value))
        elif what == "tag":
            n_in, n_out = sums["tag"]
            value = math.log(((r.inside or 0) + 0.5) / n_in) - math.log(((r.outside or 0) + 0.5) / n_out)
            weights[r.feature] = max(-LIMIT, min(-0.1, value))
        else:
            value = math.log(((r.inside or 0) + 0.5) / ((r.outside or 0) + 0.5))
            weights[r.feature] = max(-LIMIT, min(LIMIT, value))
    return weights


def weigh(weights: dict[str, float], feature: str) -> float:
    """A learned weight, or what a feature that no labelled page shows gets. What is left out inside of content weighs nothing."""
    what, kind = feature.split(" ")[:2]
    if kind.startswith("in-"):
        return 0.0
    if feature in weights:
        return weights[feature]
    if what == "tag":
        return -0.1 if kind == "content" else DEFAULTS["prose tag" if feature.split(" ")[2] in PROSE else "tag"]
    soft = DEFAULTS[what] * (SOFT if what == "word" else 1)
    return {"content": 1.0, "body": DEFAULTS[what], "outside": DEFAULTS[what], "soft": soft}.get(kind, -1.0)


def weigh_shape(weights: dict[str, float], feature: str) -> float:
    """The weight of a word in a block of an unmarked page: learned, or by links and length."""
    if feature in weights:
        return weights[feature]
    kind, linked, length = feature.split(" ")[1].split("-")
    return (1.0 if kind == "heading" or length != "0" else 0.25) if linked == "0" else 0.5 - 0.5 * int(linked)


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text of a page: blocks of the best region, one a line (null or without content: empty)."""
    found = blocks(page or "")
    labelled = is_labelled(found)
    best, best_span, here, begin = 0.0, (0, 0), 0.0, 0
    for i, (text, kind, words, links, tags) in enumerate(found):
        for t in tags:
            here += weigh(weights, f"tag {t}") if labelled else 0.0 if t.startswith("in-") else UNMARKED_TAG
            if here <= 0:
                here, begin = 0.0, i
        if text:
            if labelled or kind not in PLAIN:
                place = "outside" if kind in PLAIN else kind
                here += (words - links) * weigh(weights, f"word {place}") + links * weigh(weights, f"link {place}")
            else:
                here += words * weigh_shape(weights, shape(words, links, tags)) * (SOFT if kind == "soft" else 1)
            if here <= 0:
                here, begin = 0.0, i + 1
            elif here > best:
                best, best_span = here, (begin, i + 1)
    kept = {"content"} if labelled else {"content"} | PLAIN
    return "\n".join(b[0] for b in found[best_span[0]:best_span[1]] if b[1] in kept and b[0])


def main_text(html: Column, weights: dict[str, float]) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(p, weights) for p in pages], dtype="object")

    return run(html)


def texts(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``pages`` with the main text of each page's whole ``html`` as column ``text`` (replacing one of that name).

    Null and empty pages have an empty text, repeated rows are extracted each,
    and an empty table stays empty. Without ``weights`` they are learned from
    ``pages``; if no page is labelled, fixed weights hold.
    """
    bounded_batches(pages.sparkSession)
    weights = learn(pages) if weights is None else weights
    return pages.withColumn("text", main_text(F.col("html"), weights))
