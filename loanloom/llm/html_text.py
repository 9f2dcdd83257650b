"""Main text of a page by composite text density.

Every element of the tree gets a density: characters per tag, scaled by how few of its
characters and tags are links.  The density sum of an element adds up the densities
of its children.  The element with the largest sum is content; the least density on the path from it up to
the body is the threshold.  Further text blocks at or above it are content too, and further containers if their sum
is a fair share of the largest; they give up their own subtree of largest sum.
A chosen subtree inside an article element grows to that element.

Elements that are no text of the page (scripts, styles) are taken out before.  Elements that stand beside it by their element
name or role, or are named an advert, notice, menu or comment, weigh less: their densities count a sixteenth.  Inside a
chosen subtree they are left out, unless those that only have such a name hold nearly all of it.

Work grows in proportion to the page: no part of it is read again, and elements nest 512 deep at most (deeper ones
become siblings, their text stays).
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from loanloom.llm.frames import map_arrow, quoted

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
             "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
             "table tbody td tfoot th thead tr ul".split())
CLOSES_PARAGRAPH = BLOCKS - set("br caption body html legend optgroup option summary tbody td tfoot th thead tr".split())
CLOSED_BY_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                  "option": {"option"}, "tbody": {"tr", "td", "th", "tbody", "thead"}, "tfoot": {"tr", "td", "th", "tbody", "thead"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"},
          "tbody": {"table"}, "tfoot": {"table"}}
#: Elements that are never main text; those that stand beside it, as do some roles; words in classes and ids that hint at it.
NEVER = set("script style noscript template head title iframe svg math canvas object audio video map select button datalist textarea".split())
BESIDE = set("nav header footer aside form menu dialog search".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
BESIDE_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
                   "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification popup promo promoted promotion "
                   "related replies respond share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget".split())
#: A class that begins so tells what its element contains, not what it is.
_MODIFIER = re.compile(r"(?:with|has|no|without|show|hide|is)[-_]")

#: A tag ends at the next ">"; only a quote right after "=" begins a value.  No part gives characters back.
_TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+>?"""
                    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'=/]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_WORDS = re.compile(r"[a-z]+")
#: What an element is told to be beside the text by: a name only, its element or role, or being no text at all.
NAMED, ELEMENT, NO_TEXT = 1, 2, 3
#: Elements beside the text count this much in density; with names only, they are kept where less than this share is left without them.
BESIDE_WEIGHT = 1 / 16
#: A further container is content if its density sum is this share of the largest; these elements are text blocks and need only the density.
SUM_SHARE = 0.1
TEXT_BLOCKS = set("blockquote dd dl dt figcaption h1 h2 h3 h4 h5 h6 hgroup li ol p pre table td th ul".split())
#: A subtree of largest sum begins at a block that can hold several of these.
CONTAINERS = BLOCKS - set("blockquote br caption dt figcaption h1 h2 h3 h4 h5 h6 hgroup hr legend option p pre summary".split())
MAX_DEPTH = 512


class Page:
    """Elements of a page in order, with their parents, and the text pieces between them."""

    def __init__(self, source: str):
        self.tags, self.parents, self.beside = ["html"], [-1], [0]
        self.open: dict[str, int] = {}                    # how many open elements have a name
        self.pieces: list[tuple[int, str | None]] = []    # (element, text), or (element, None) where a block begins or ends
        self._read(source)

    def _read(self, source: str) -> None:
        at, stack = 0, [0]
        while token := _TOKEN.search(source, at):
            if token.start() > at:
                self.pieces.append((stack[-1], source[at:token.start()]))
            at = token.end()
            closing, name, rest = token[1], token[2], token[3]
            if not name:
                continue
            name = name.lower()
            if name in BLOCKS:
                self.pieces.append((stack[-1], None))
            if closing:
                self._close(stack, name)
                continue
            if name in ("html", "body") and self.open.get(name):
                continue
            self._imply(stack, name)
            number = len(self.tags)
            self.tags.append(name)
            self.parents.append(stack[-1])
            self.beside.append(_hinted(name, rest))
            if name in VOID or rest.endswith("/") and name not in BLOCKS and name not in RAW:
                continue
            if name in RAW:
                end = _RAW_END[name].search(source, at)
                stop = source.find(">", end.end()) if end else -1
                self.pieces.append((number, source[at:end.start() if end else len(source)]))
                at = stop + 1 if stop >= 0 else len(source)
                continue
            if len(stack) < MAX_DEPTH:
                stack.append(number)
                self.open[name] = self.open.get(name, 0) + 1
        if at < len(source):
            self.pieces.append((stack[-1], source[at:]))

    def _cut(self, stack: list[int], at: int) -> None:
        for i in stack[at:]:
            self.open[self.tags[i]] -= 1
        del stack[at:]

    def _close(self, stack: list[int], name: str) -> None:
        if not self.open.get(name):
            return
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[i]]
            if tag == name:
                self._cut(stack, i)
                return
            # A stray inline end tag does not close the block it stands in, nor a block's the table cell around it.
            if (name not in BLOCKS and tag in BLOCKS) or (tag in ("td", "th") and name not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html")):
                return

    def _imply(self, stack: list[int], name: str) -> None:
        """Ends what a start tag ends: an open paragraph, a list item or cell before its like, the head."""
        if name == "body" or (name in BLOCKS and name != "html"):
            while len(stack) > 1 and self.tags[stack[-1]] == "head":
                self._cut(stack, len(stack) - 1)
        if name in CLOSES_PARAGRAPH:
            self._end_like(stack, {"p"}, BLOCKS - {"p"})
        if name in CLOSED_BY_LIKE:
            self._end_like(stack, CLOSED_BY_LIKE[name], SCOPES[name])

    def _end_like(self, stack: list[int], ends: set, scope: set) -> None:
        if not any(self.open.get(x) for x in ends):
            return
        cut = None
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[i]]
            if tag in ends:
                cut = i
            elif tag in scope:
                break
        if cut is not None:
            self._cut(stack, cut)


def _hinted(name: str, attributes: str) -> int:
    """``NO_TEXT``, ``ELEMENT`` or ``NAMED`` for an element that is no text or stands beside it, 0 otherwise."""
    if name in NEVER:
        return NO_TEXT
    level = ELEMENT if name in BESIDE else 0
    if attributes and name not in ("html", "body", "main", "article"):
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (values[0] or values[1] or values[2]).lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value.strip() in ROLES):
                level = max(level, ELEMENT)
            elif key in ("class", "id") and any(BESIDE_WORDS.intersection(_WORDS.findall(x)) for x in value.split() if not _MODIFIER.match(x)):
                level = max(level, NAMED)
    return level


def _densities(tags, parents, chars, gone, weight):
    """Characters, density and density sum of each element that is still in."""
    n = len(tags)
    c, t, lc, lt = chars[:], [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = tags[i] == "a" or linked[parents[i]]
    for i in range(n - 1, 0, -1):
        if gone[i]:
            continue
        p = parents[i]
        lc[i] = c[i] if linked[i] else lc[i]
        c[p] += c[i]
        lc[p] += lc[i]
        t[p] += t[i] + 1
        lt[p] += lt[i] + (tags[i] == "a")
    body_share = lc[0] / c[0] if c[0] else 0.0
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if gone[i] or not c[i]:
            continue
        base = math.log(c[i] / max(c[i] - lc[i], 1) * lc[i] + body_share * c[i] + math.e)
        ratio = c[i] / max(lc[i], 1) * max(t[i], 1) / max(lt[i], 1)
        density[i] = c[i] / max(t[i], 1) * math.log(max(ratio, 1.0)) / max(math.log(base), 1.0) if base > 1 else 0.0
        density[i] *= weight[i]
        if i:
            sums[parents[i]] += density[i]
    return c, density, sums


def main_text(source: str | None) -> str:
    """The main text of a page: white space in a block is one blank, blocks are joined by one blank; empty for none."""
    if not source:
        return ""
    page = Page(source)
    tags, parents = page.tags, page.parents
    n = len(tags)
    texts = [(e, html.unescape(x) if x is not None and "&" in x else x) for e, x in page.pieces]
    chars = [0] * n
    for e, x in texts:
        if x is not None:
            chars[e] += len("".join(x.split()))
    # What holds the article does not stand beside it.
    holds = [False] * n
    for i in range(n - 1, 0, -1):
        holds[i] = holds[i] or tags[i] in ("article", "main") and not page.beside[i]
        holds[parents[i]] = holds[parents[i]] or holds[i]
    level = [x if x == NO_TEXT or not holds[i] else 0 for i, x in enumerate(page.beside)]
    gone, weight = [False] * n, [1.0] * n
    for i in range(1, n):
        gone[i] = gone[parents[i]] or level[i] == NO_TEXT
        weight[i] = BESIDE_WEIGHT if level[i] else weight[parents[i]]
    chars = [0 if gone[i] else chars[i] for i in range(n)]
    c, density, sums = _densities(tags, parents, chars, gone, weight)
    body = next((i for i in range(n) if tags[i] == "body"), 0)
    if not c[0]:
        return ""
    if c[0] > c[body]:
        body = 0      # text outside the body element belongs to the page as well
    chosen = [False] * n
    for i in _chosen(tags, parents, density, sums, body, c):
        inside = [i]
        while parents[inside[-1]] >= 0:
            inside.append(parents[inside[-1]])
        articles = [j for j in inside if tags[j] in ("article", "main") and not level[j]]
        chosen[articles[-1] if articles else i] = True
    kept = [_kept(parents, chosen, gone, level, least) for least in (NAMED, ELEMENT, NO_TEXT)]
    left = [sum(x for x, k in zip(chars, keep) if k) for keep in kept]
    keep = kept[0] if left[0] and left[0] >= BESIDE_WEIGHT * left[1] else kept[1] if left[1] else kept[2]
    blocks, now = [], []
    for e, x in texts:
        if x is None:
            blocks.append("".join(now))
            now = []
        elif keep[e]:
            now.append(x)
    blocks.append("".join(now))
    return " ".join(filter(None, (" ".join(b.split()) for b in blocks)))


def _kept(parents, chosen, gone, level, least) -> list[bool]:
    """What lies in a chosen subtree and in no element inside it that stands beside the text by ``least`` or more."""
    keep = [False] * len(parents)
    keep[0] = chosen[0]
    for i in range(1, len(parents)):
        keep[i] = not gone[i] and (chosen[i] or keep[parents[i]] and level[i] < least)
    return keep


def _chosen(tags, parents, density, sums, body, c) -> list[int]:
    n = len(parents)
    sums = [x if tag in CONTAINERS else 0.0 for x, tag in zip(sums, tags)]
    top = list(range(n))        # container of the largest sum in each subtree; the first of equals
    for i in range(n - 1, body, -1):
        p = parents[i]
        if p >= 0 and (sums[top[i]], -top[i]) > (sums[top[p]], -top[p]):
            top[p] = top[i]
    best = top[body]
    if sums[best] <= 0:
        return [body]
    threshold, i = density[best], best
    while i != body and i >= 0:
        i = parents[i]
        threshold = min(threshold, density[i])
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        children[parents[i]].append(i)
    chosen, covered, pending = [], set(), [body]
    while pending:
        i = pending.pop()
        if not c[i] or density[i] < threshold or i in covered:
            continue
        own = top[i] if sums[top[i]] > 0 else i
        if own not in covered and (tags[i] in TEXT_BLOCKS or sums[own] >= SUM_SHARE * sums[best]):
            chosen.append(own)
            stack = [own]
            while stack:
                j = stack.pop()
                covered.add(j)
                stack += children[j]
        pending += children[i]
    return chosen


def extract(pages: DataFrame, html_column: str = "html", name: str = "text") -> DataFrame:
    """All rows of ``pages`` with the main text in place of the html, under ``name``.

    A null or empty page, and one without text, gives an empty text; repeated rows give equal texts; very long and broken pages are
    read whole, in time proportional to their length; other
    columns (but one called ``name``, which is replaced) pass through.
    """
    others = [c for c in pages.columns if c not in (html_column, name)]
    plain = pages.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(others)], quoted(html_column).alias("source"))

    def work(batches):
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("source")]
            arrays = [*batch.columns[:-1], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], "text"])

    kinds = [plain.schema[f"c{i}"].dataType.simpleString() for i in range(len(others))]
    schema = ", ".join([*(f"c{i} {k}" for i, k in enumerate(kinds)), "text string"])
    return map_arrow(plain, work, schema).toDF(*others, name)
