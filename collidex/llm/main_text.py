"""Operator 9: main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. Lines of menus, headers,
footers, sidebars, notices, adverts, forms and comments weigh nothing, and so do
lines made of links; where a page has an article element, lines outside it weigh half.
Over the weights (text lengths) slides a window of ``width`` lines. Where its sum
rises from zero the text surges, where it falls back to zero it dives; the text
between the two is kept if the sum in between exceeds ``surge``. A shorter run is kept
within ``near`` lines of a kept one. Runs end where an article begins or ends. A page
that never gets there keeps all runs on that side of its articles where the highest is.

Words of class and id also name the layout of wrappers, and a form may hold a whole page.
They do not remove an element with a main element in it, with all of the page's articles or, for words of layout, with
most of the page's text; nor anything where nothing would be left.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm.common import table

# fixed values: element names of HTML, and words of class and id that name what is not main text
BLOCKS = set("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li link main menu meta "
             "nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
DROPPED = set("nav header footer aside menu button select fieldset dialog head title noscript template iframe object "
              "svg math canvas audio video datalist".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "noembed", "noframes", "xmp")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
KEPT = set("html body article main".split())
CLOSES_P = BLOCKS - {"br"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
NOT_MAIN = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
               "notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments reply replies "
               "disqus sidebar sidebars widget widgets related recommended recommendations share sharing social breadcrumb breadcrumbs menu "
               "menus nav navbar navigation footer header masthead pagination pager toolbar copyright legal disclaimer".split())
LAYOUT = set("form sidebar sidebars widget widgets menu menus nav navbar navigation footer header masthead toolbar banner breadcrumb breadcrumbs".split())
REPEATED = set("comment comments reply replies disqus related recommended recommendations".split())       # their elements often hold articles of their own
WRAPS = set("wrap wrapper container layout".split())
NEGATED = set("has with no without".split())
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())

_SPACE = re.compile(r"[\s​﻿]+")
_START = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile(r">|=\s*+[\"']")
_ATTR = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_RAW_END = {t: re.compile(rf"</{t}\s*+>", re.I) for t in RAW}
_ZEROS, _BEYOND = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])"), re.compile(r"&#(?:[xX][0-9a-fA-F]{7,}|[0-9]{8,});?")


class Tags:
    """The tags of a page, each byte passed a bounded number of times however malformed they are.

    A quote opens a value only behind ``=`` and if it is closed later; ``>`` within a value
    does not end the tag. Once a tag has come to the end of the page in that way, it and
    all later ones end at their first ``>``.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.quotes = True                                   # whether values are still respected
        self.closed = {q: page.rfind(q) for q in "\"'"}      # the last quote of each kind

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """(start, end, name or empty for comments and declarations, closing, attributes) of the next tag."""
        page = self.page
        while m := _START.search(page, at):
            if m[0] == "<!--":
                end = page.find("-->", m.end())
                return m.start(), end + 3 if end >= 0 else len(page), "", False, ""
            if m.end() > self.last:
                return None                                  # no tag can end any more
            if not m[2]:
                return m.start(), page.index(">", m.end()) + 1, "", False, ""
            end = self._end(m.end())
            return m.start(), end + 1, m[2].lower(), bool(m[1]), page[m.end():end]
        return None

    def _end(self, first: int) -> int:
        at = first
        while self.quotes:
            m = _STOP.search(self.page, at)
            if not m:
                self.quotes = False
            elif m[0] == ">":
                return m.start()
            else:
                quote = m[0][-1]
                at = self.page.index(quote, m.end()) + 1 if m.end() <= self.closed[quote] else m.end()
        return self.page.index(">", first)


def _decoded(text: str) -> str:
    """Character references decoded; those beyond all code points, of any length, become the replacement sign."""
    if "&#" in text:
        text = _BEYOND.sub("\ufffd", _ZEROS.sub(r"&#\1", text))
    return html.unescape(text)


def _off(name: str, attrs: str) -> bool:
    """Whether an element is no main text by its name, its role or because it is hidden."""
    if name in DROPPED:
        return True
    if name in KEPT or not attrs.strip():
        return False
    if re.search(r"\bhidden\b(?!\s*=\s*[\"']?until)", re.sub(r"=\s*(\"[^\"]*\"|'[^']*')", "", attrs)):
        return True
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "role" and value in ROLES or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _named(name: str, attrs: str) -> set[str]:
    """Words of class and id that name what is not main text, and those of ``WRAPS`` beside them; ``form`` for a form."""
    found = {"form"} if name == "form" else set()
    for m in _ATTR.finditer(attrs) if name not in KEPT else ():
        if m[1].lower() in ("class", "id"):
            for token in (m[2] or m[3] or m[4] or "").lower().split():
                words = [w for w in re.split(r"[^a-z]+", token) if w]
                if words and words[0] not in NEGATED and NOT_MAIN.intersection(words):
                    found.update((NOT_MAIN | WRAPS).intersection(words))
    return found


def lines_of(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters within links, not main text, inside an article) of each block, in page order."""
    out, text, stack, depth = [], [], [], Counter()
    tags = Tags(page)
    off, inside, link, linked, at, n = 0, 0, 0, 0, 0, len(page)
    named, open_, articles = [], [], 0          # elements named by class or id: words, main and article elements in them; the open ones

    def flush():
        nonlocal linked
        if text:
            t = _SPACE.sub(" ", _decoded("".join(text))).strip()
            if t:
                out.append((t, linked, off > 0, inside > 0, tuple(open_)))
            text.clear()
        linked = 0

    def pop():
        nonlocal off, inside
        name, flag, words = stack.pop()
        depth[name] -= 1
        off -= flag
        if words:
            open_.pop()
        inside -= name in ("article", "main")

    while at < n:
        tag = tags.next(at)
        piece = page[at:tag[0] if tag else n]
        if not tag and (cut := re.search(r"<[a-zA-Z/!][^<]*\Z", piece)):      # a tag cut off by the end of the page
            piece = piece[:cut.start()]
        if piece:
            text.append(piece)
            linked += len(piece) if link else 0
        if not tag:
            break
        _, at, name, closing, attrs = tag
        if not name:
            continue
        if name in BLOCKS or name in DROPPED:
            flush()
        if name == "a":
            link = not closing
            continue
        if closing:
            if depth[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else n
            continue
        if name in VOID or attrs.rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name in CLOSES_P and stack and any(x[0] == "p" for x in stack[-4:]):
            while stack[-1][0] != "p":
                pop()
            pop()
        if name in SIBLINGS and stack and stack[-1][0] in SIBLINGS[name]:
            pop()
        if name in BLOCKS or name in DROPPED:
            link = 0
        elif not attrs.strip():
            continue                                                         # plain inline markup
        flag = _off(name, attrs)
        words = set() if flag else _named(name, attrs)
        if (flag or words) and name not in BLOCKS:
            flush()
        stack.append((name, flag, words))
        depth[name] += 1
        off += flag
        if words:
            open_.append(len(named))
            named.append([words, 0, 0])
        if name in ("article", "main"):
            inside += 1
            if not off:
                articles += name == "article"
                for i in open_:
                    named[i][1 + (name == "article")] += 1
    flush()
    held = [0] * len(named)
    for t, _, away, _, within in out:
        for i in within if not away else ():
            held[i] += len(t)
    most = sum(len(t) for t, _, away, _, _ in out if not away) / 2
    bars = {i for i, (words, mains, own) in enumerate(named) if not (
        mains or articles and own == articles and (words & WRAPS or not words & REPEATED)
        or held[i] > most and words & (LAYOUT | WRAPS) and not ("form" in words and articles))}
    if all(away or bars.intersection(within) for _, _, away, _, within in out):
        bars = set()
    return [(t, links, away or not bars.isdisjoint(within), within_article) for t, links, away, within_article, within in out]


def _runs(weight: np.ndarray, width: int) -> list[tuple[float, int, int]]:
    """(highest window sum, first line, end) between each surge from zero and the next dive to zero."""
    n = len(weight)
    sums = np.convolve(np.append(weight, [0] * width), np.ones(width, int))[width - 1:][:n]
    runs, i = [], 0
    while i < n:
        if sums[i] == 0:
            i += 1
            continue
        j = i
        while j < n and sums[j] > 0:
            j += 1
        text = np.flatnonzero(weight[i:j]) + i
        runs.append((float(sums[i:j].max()), int(text[0]), int(text[-1]) + 1))
        i = j
    return runs


def extract(page: str | None, width: int = 3, surge: int = 86, near: int = 12) -> str:
    lines = lines_of(page or "")
    if not lines:
        return ""
    article = any(inside and not off for _, _, off, inside in lines)
    within = np.array([inside for *_, inside in lines])
    weight = np.array([0 if off or 2 * links > len(t) and not inside else len(t) if inside or not article else len(t) / 2
                       for t, links, off, inside in lines], float)
    kept, every = [], []
    for side in (True, False):
        runs = _runs(np.where(within == side, weight, 0), width)
        close = np.zeros(len(lines), bool)
        for _, i, j in (r for r in runs if r[0] > surge):
            close[max(0, i - near):j + near] = True
        kept += [r for r in runs if close[r[1]:r[2]].any()]
        every += runs
    if not kept and every:
        best = max(every, key=lambda r: (r[0], within[r[1]], -r[1]))
        kept = [r for r in every if within[r[1]] == within[best[1]]]
    own = {k for _, i, j in kept for k in range(i, j) if weight[k] and within[k] == within[i]}
    return " ".join(lines[k][0] for k in sorted(own))


def main_text(pages: DataFrame, width: int = 3, surge: int = 86) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``.

    A null or empty page, and one of markup alone, gives an empty text. Whole pages
    are read; unclosed and cut-off markup is accepted. Null ids and urls pass through,
    repeated rows each give a row, other columns are not read, an empty table gives an
    empty result.
    """

    @F.pandas_udf("string")
    def text(page: pd.Series) -> pd.Series:
        return pd.Series([extract(p, width, surge) for p in page], dtype=object)

    return pages.select("page_id", "url", text(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
