"""Main text of web pages by tag-path ratios.

A page's text leaves are grouped by their root-to-leaf tag path.  Per path,
text length and punctuation are averaged over its leaves; both series are
smoothed along the page (Gaussian), fused (product) and cut at a share of
their standard deviation, which selects the content paths.  The element that
holds most characters of the selected text is the article; selected text outside
it belongs to the page's text too, with the element that holds it.  All blocks of these
elements are kept but those inside menus, headers, footers, sidebars, notices, adverts, forms and
comments, told by tag or by class/id words.  A word that is a whole class or id marks its element, unless a
headline, article or main element stands in it; a word that is a part of one (``with-sidebar``) marks
it only where it holds less than half of the page's text.  The article or main element with most text
is always kept.

Cases: null or empty html gives an empty text; unclosed and stray tags are
repaired by closing what their tag implies; text behind the last ``>`` is text; a script or the like
that is never closed ends at the next closing tag; a page without text leaves gives
an empty text; ties go to the outer element; null and repeated ids and rows
are handled row by row; empty tables give empty results; other columns pass.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .keys import added
from .memory import lean

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>", re.S)
HINT = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Elements whose content is no markup.
RAW = {"script", "style", "title", "textarea", "noscript", "xmp", "iframe", "noembed", "noframes", "template", "svg"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "ruby", "rp", "rt", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img"}
ASIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset", "head"}
#: Words of class, id or role that mark what is no article.
ASIDE_WORDS = {"ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment",
               "comments", "cookie", "cookies", "consent", "disclaimer", "footer", "header", "login", "masthead", "menu",
               "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related",
               "reply", "replies", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored",
               "subscribe", "toolbar", "widget", "complementary", "contentinfo"}
#: What an opening tag closes, besides an open p for every block.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
ANY_END = re.compile(r"</[a-zA-Z]")
#: What no menu, notice or comment list holds, but a page's frame does.
CORE = {"h1", "article", "main"}
FENCE = {"table", "ul", "ol", "dl", "article", "section", "main", "div", "body"}
PUNCTUATION = re.compile(r"[.,;:!?…、。，¿¡]")
HOLDERS = ("article", "main", "section", "div", "td", "body", "html")
KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)
SHARE = 0.8                 # of the standard deviation: the threshold
MOST = 0.7                  # of the selected text: what the article must hold


class Leaf:
    """A block's text, the tags and the element numbers above it, and whether it stands aside."""

    __slots__ = ("path", "above", "text", "aside")

    def __init__(self, path, above, text, aside) -> None:
        self.path, self.above, self.text, self.aside = path, above, text, aside


def marked(rest: str) -> tuple[set[str], int]:
    """Words of an element's class, id and role, and how they mark it: 2 by a whole one, 1 by a part, 0 not at all."""
    words: set[str] = set()
    whole = False
    for hint in HINT.findall(rest):
        for token in "".join(hint).lower().split():
            whole = whole or token in ASIDE_WORDS
            words.update(re.split(r"[^a-z]+", token))
    return words - {""}, 2 if whole else 1 if words & ASIDE_WORDS else 0


def leaves(page: str) -> tuple[list[Leaf], list[str]]:
    """Text blocks in page order and the tag of each element number."""
    out: list[Leaf] = []
    tags: list[str] = []
    marks: dict[int, int] = {}                       # elements that words mark, and how
    core: set[int] = set()                           # elements around a headline, an article or a main element
    depth: Counter[str] = Counter()                  # open elements by tag
    endless: set[str] = set()                        # raw tags that no closing tag follows any more
    stack: list[tuple[str, str, int, bool]] = []     # tag, label in paths, number, aside
    inline: list[tuple[str, bool]] = []              # open inline elements and whether they stand aside
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append(Leaf(tuple(s[1] for s in stack), tuple(s[2] for s in stack), text,
                                bool(stack) and stack[-1][3]))

    def close(wanted: set[str], fence: set[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in wanted:
                depth.subtract(x[0] for x in stack[k:])
                del stack[k:]
                return
            if stack[k][0] in fence:
                return

    at, size, last = 0, len(page), page.rfind(">") + 1
    while at < size:
        m = TOKEN.search(page, at, last)             # no tag ends behind the last >
        end = m.start() if m else size
        if end > at and not any(aside for _, aside in inline):
            parts.append(entities.unescape(page[at:end]))
        if m is None:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<!--") and not (m[0].endswith("-->") and len(m[0]) > 6):
                break                                # a comment without an end
            continue
        if m[1] or m[4]:
            if tag in INLINE:
                for k in range(len(inline) - 1, -1, -1):
                    if inline[k][0] == tag:
                        del inline[k]
                        break
            else:
                flush()
                if depth[tag] > 0:
                    close({tag}, set())
                inline.clear()
            continue
        rest = m[3] or m[6] or ""
        if tag in RAW:
            if tag == "svg" and rest.rstrip().endswith("/"):
                continue
            over = None if tag in endless else RAW_END[tag].search(page, at)
            if over is None:
                endless.add(tag)
                over = ANY_END.search(page, at)
                at = over.start() if over else size
            else:
                at = over.end()
            continue
        words, mark = marked(rest) if rest else (set(), 0)
        if tag in INLINE:
            if tag in ("br", "wbr", "img"):
                parts.append("" if tag == "wbr" else " ")
            elif not rest.rstrip().endswith("/"):
                inline.append((tag, mark > 0))
            continue
        flush()
        if tag in VOID or rest.rstrip().endswith("/"):
            continue
        inline.clear()
        close({"p"}, FENCE)
        if tag in CLOSES:
            close(CLOSES[tag], {"table", "ul", "ol", "dl", "select"})
        aside = (bool(stack) and stack[-1][3]) or tag in ASIDE
        if not aside and not mark and tag in CORE:
            core.update(s[2] for s in stack)
        if mark and not aside and tag not in ("html", "body", "article", "main"):
            marks[len(tags)] = mark
        stack.append((tag, ".".join([tag, *sorted(words)]) if words else tag, len(tags), aside))
        depth[tag] += 1
        tags.append(tag)
    flush()
    if marks:
        held = Counter()
        for x in out:
            if not x.aside:
                held.update({e: len(x.text) for e in x.above if e in marks})
        total = sum(len(x.text) for x in out if not x.aside)
        for e, mark in marks.items():
            if mark == 2 and e not in core or mark == 1 and 2 * held[e] < total:
                for x in out:
                    x.aside = x.aside or e in x.above
    return out, tags


def content_paths(nodes: list[Leaf]) -> tuple[set[tuple], np.ndarray]:
    """The paths above the threshold, and the fused ratio of each leaf."""
    by = defaultdict(lambda: [0, 0, 0])
    for x in nodes:
        b = by[x.path]
        b[0] += len(x.text)
        b[1] += len(PUNCTUATION.findall(x.text))
        b[2] += 1
    ratios = np.array([[by[x.path][0] / by[x.path][2], (1 + by[x.path][1]) / by[x.path][2]] for x in nodes])
    weight = np.convolve(np.ones(len(nodes)), KERNEL)[2:-2]
    smooth = np.stack([np.convolve(ratios[:, i], KERNEL)[2:-2] / weight for i in range(2)], axis=1)
    fused = smooth[:, 0] * smooth[:, 1]
    limit = min(SHARE * fused.std(), fused.max())
    mean = defaultdict(list)
    for x, f in zip(nodes, fused):
        mean[x.path].append(f)
    return {p for p, f in mean.items() if np.mean(f) >= limit}, fused


def main_text(page: str) -> str:
    everything, tags = leaves(page)
    nodes = [x for x in everything if not x.aside]
    if not nodes:
        return ""
    paths, _ = content_paths(nodes)
    chosen = [x for x in nodes if x.path in paths] or nodes
    held = defaultdict(int)
    for x in chosen:
        for e in x.above:
            if tags[e] in HOLDERS:
                held[e] += len(x.text)
    total = sum(len(x.text) for x in chosen)
    most = [e for e, n in held.items() if n >= MOST * total]
    named = [e for e in most if tags[e] in ("article", "main")]
    root = max(named or most, default=None)             # numbers grow downwards: the innermost that holds enough
    spoken = defaultdict(int)                           # the article or main element with most text stays whatever its ratios
    for x in nodes:
        for e in x.above:
            if tags[e] in ("article", "main"):
                spoken[e] += len(x.text)
    longest = max(spoken.values(), default=0)
    roots, loose = {root, *[e for e, n in spoken.items() if n == longest]}, root is None or tags[root] in ("body", "html")
    for x in chosen:                                    # the rest of the selected text: its own innermost elements
        if loose or root not in x.above:
            roots.add(max((e for e in x.above if tags[e] in HOLDERS), default=None))
    roots = {e for e in roots if e is not None and tags[e] not in ("body", "html")}
    kept = [x.text for x in nodes if x.path in paths or not roots.isdisjoint(x.above)
            or loose and re.fullmatch(r"h[1-6].*", x.path[-1] if x.path else "")]
    return "\n".join(kept)


def with_main_text(pages: DataFrame, html_col: str = "html", out: str = "__main") -> DataFrame:
    """``pages`` and its main text; pages are handled one at a time inside each Arrow batch."""
    added(pages, out)
    schema = T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())])
    place = pages.columns.index(html_col)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py() or "") for v in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return pages.mapInArrow(lean(extract), schema)
