"""Main text of web pages by tag-path ratios (operator 8).

The text of a page hangs on leaves; each leaf has the path of tags (with
class and id) above it. Text length, punctuation and link text are summed per
path, so short paragraphs are judged with all that look like them. Both
ratios are smoothed over the leaves in page order, multiplied, and leaves
whose path stays under a share of the page's typical value are dropped.
"""

from __future__ import annotations

import html
import re
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import bounded_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RADIUS = 2  # leaves on each side that are smoothed over
SHARE = 0.1  # of the weighted mean of the fused ratio, under which a path is dropped
LINKED = 0.6  # share of link text from which a path is a menu

# Fixed values of HTML: elements by the way they are shown.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
_HIDDEN = frozenset("head script style textarea title iframe noembed noframes noscript template svg math object canvas audio video select option button form dialog nav footer aside menu datalist".split())
_INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("table td th ul ol dl div section article main body html blockquote".split())
# Names of classes, ids and roles of what stands around an article.
_AROUND = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adbox|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"nav\w*|menu\w*|breadcrumbs?|pagination|pager|sidebar\w*|side|aside|widget\w*|related|recommend\w*|teasers?|trending|popular|share|sharing|social\w*|"
    r"comments?|commentlist|respond|replies|reply|discussion|disqus|footer\w*|foot|header|masthead|topbar|toolbar|copyright|legal|disclaimer|search\w*|skip|hidden|toc)(?:$|[\s_-])",
    re.I,
)
_CONTENT = re.compile(r"(?:^|[\s_-])(?:article|content|post|story|main|entry|body|text)(?:$|[\s_-])", re.I)
_ROLE = re.compile(r"^(?:navigation|banner|contentinfo|complementary|search|form|menu|dialog|alert|note)$", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|$)", re.S)
_NAMES = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？]")


def _around(tag: str, attrs: str, inside: bool) -> tuple[bool, str]:
    """Whether an element is none of the article, and its name in the path."""
    if tag in _HIDDEN:
        return True, tag
    if tag == "header":
        return not inside, tag
    if not attrs.strip(" /"):
        return False, tag
    names = ""
    for m in _NAMES.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True, tag
        if key == "role":
            if _ROLE.match(value):
                return True, tag
        elif key in ("class", "id"):
            names += " " + re.sub(r"([a-z])([A-Z])", r"\1-\2", value)
    out = tag not in ("html", "body", "article", "main") and _AROUND.search(names) and not _CONTENT.search(names)
    return bool(out), tag + re.sub(r"\d+", "", ".".join(names.split()))


def leaves(page: str) -> list[tuple[str, str, int]]:
    """(path, text, characters in links) of each text block of a page, in page order, without what is never shown.

    Blocks are what stands between block elements; references are decoded and
    white space runs are one space.
    """
    found: list[tuple[str, str, int]] = []
    stack: list[tuple[str, str, bool]] = [("", "", False)]  # tag, path, dropped
    parts: list[tuple[str, bool]] = []
    path_of_block = ""
    links = 0

    def flush() -> None:
        nonlocal path_of_block
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                found.append((path_of_block, text, sum(len(t) for t, linked in parts if linked)))
            parts.clear()
        path_of_block = ""

    def add(raw: str) -> None:
        nonlocal path_of_block
        if raw and not stack[-1][2]:
            if not path_of_block and not raw.isspace():
                block = next((s for s in reversed(stack) if s[0] not in _INLINE), stack[0])
                path_of_block = block[1]
            parts.append((html.unescape(raw), links > 0))

    def pop(n: int) -> None:
        nonlocal links
        for tag, _, _ in stack[n:]:
            links -= tag == "a"
        del stack[n:]

    at, end, inside = 0, len(page), 0
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag not in _INLINE:
            flush()
        if m[1]:
            for n in range(len(stack) - 1, 0, -1):
                if stack[n][0] == tag:
                    pop(n)
                    break
                if tag in _INLINE and stack[n][0] not in _INLINE:
                    break
            continue
        if tag == "br":
            add(" ")
        if tag in _VOID or m[3].endswith("/") and tag in ("svg", "math"):
            continue
        if tag in _RAW:
            close = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in _CLOSES_P or tag in _SIBLING:
            ends = ("p",) if tag in _CLOSES_P else _SIBLING[tag]
            for n in range(len(stack) - 1, 0, -1):
                if stack[n][0] in ends:
                    pop(n)
                    break
                if stack[n][0] in _SCOPE:
                    break
        inside = sum(s[0] in ("article", "main") for s in stack)
        drop, name = _around(tag, m[3], bool(inside))
        stack.append((tag, f"{stack[-1][1]}/{name}" if tag not in _INLINE else stack[-1][1], stack[-1][2] or drop))
        links += tag == "a"
        if len(stack) > 400:  # deeper trees are not told apart
            pop(399)
    flush()
    return found


def main_text(page: str | None) -> str:
    """The article's blocks, joined by an empty line."""
    found = leaves(page) if page else []
    if not found:
        return ""
    paths = {p: i for i, p in enumerate(dict.fromkeys(f[0] for f in found))}
    at = np.array([paths[f[0]] for f in found])
    size = np.array([len(f[1]) for f in found], float)
    marks = np.array([len(_PUNCTUATION.findall(f[1])) for f in found], float)
    linked = np.array([f[2] for f in found], float)
    count = np.bincount(at)
    total = np.bincount(at, size)
    long = total / count
    stops = (np.bincount(at, marks) + 1) / count
    menu = np.bincount(at, linked) > LINKED * total
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / max(RADIUS, 1)) ** 2)

    def smooth(x: np.ndarray) -> np.ndarray:
        weights = np.convolve(np.ones(len(x)), kernel)[RADIUS : len(x) + RADIUS]
        return np.convolve(x, kernel)[RADIUS : len(x) + RADIUS] / weights

    fused = smooth(long[at]) * smooth(stops[at])
    # A path's value is that of its best leaf; typical is the mean over characters.
    value = np.zeros(len(paths))
    np.maximum.at(value, at, np.where(menu[at], 0.0, fused))
    typical = (value[at] * size).sum() / size.sum()
    good = (value >= SHARE * typical) & ~menu
    keep = good[at]
    if not keep.any():
        keep = ~menu[at] if (~menu).any() else np.ones(len(found), bool)
    return "\n\n".join(f[1] for f, k in zip(found, keep, strict=True) if k)


def extract_text(pages: DataFrame, keep: tuple[str, ...], markup: str) -> DataFrame:
    """``keep`` columns with ``text`` (main text, empty if none) and ``n_chars`` (its code points).

    A null or empty page gives the empty text; broken or cut markup is read
    as far as it goes; repeated rows give repeated results; an empty table
    gives an empty result; further columns are left out.
    """

    @F.pandas_udf("string")
    def text(found: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in found], dtype=object)

    bounded_batches()
    rows = pages.select(*keep, text(F.col(markup)).alias("text"))
    return rows.select(*keep, "text", F.length("text").cast("long").alias("n_chars"))
