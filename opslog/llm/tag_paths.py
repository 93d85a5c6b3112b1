"""Main text of web pages by tag-path ratios.

A page becomes its blocks of text in page order, each with the path of block tags from the root.
Text length and punctuation marks are summed per path; a path's ratio is the text of one leaf times
its marks, damped by logarithms and by the share of text in links.  Ratios are smoothed along
the page with a kernel that weighs neighbours by how much of the path they share, fused with the
path's own ratio, and held against the page's mean and spread.  The smallest element
that holds all text on chosen paths is the article, never the text's own block; its short blocks (headings, lists)
come along unless they are mostly links, and so does a heading just before it.  Elements whose tag or role names them as menus, headers, footers or
sidebars never take part.  Forms, and those that class or id names so, or as notices, adverts or reader comments,
take no part unless (comments apart) they hold an article or most of the page's text with few links, or nothing else has any.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import strings

# Fixed values of HTML: elements without content, with raw text, and those that break a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
CLOSES = {  # an element that ends where another of the set begins
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
    "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]), "tfoot": frozenset(["tbody", "tr", "td", "th"]),
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "tfoot": {"table"}}
OUTSIDE = frozenset(
    "head title nav footer aside button select textarea option label input noscript template svg math iframe object canvas "
    "audio video map menu dialog".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form toolbar".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay comment comments reply replies disqus respond sidebar aside rail menu nav "
    "navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar share sharing social related recommended newsletter subscribe "
    "subscription signup login widget widgets pager pagination paging search form copyright disclaimer skip".split()
)
COMMENTS = frozenset("comment comments reply replies disqus respond".split())
HEADER = frozenset("header masthead banner".split())  # names of a heading's place where an article has one
MODIFIERS = frozenset("has no with without hide is not".split())
ARTICLE = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S | re.I,
)
NAMES = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
MARKS = re.compile(r"[.,;:!?…。，！？；：、]")


class Block:
    __slots__ = ("path", "elements", "text", "links", "outside", "doubtful")

    def __init__(self, path, elements, outside, doubtful=()):
        self.path, self.elements, self.outside, self.doubtful = path, elements, outside, doubtful
        self.text: list[str] = []
        self.links = 0


def _named_outside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in OUTSIDE or (tag == "header" and not in_article):
        return True
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return False
    for name, *values in NAMES.findall(attributes):
        value, name = "".join(values).lower(), name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in ROLES:
            return True
    return False


def _doubtful(tag: str, attributes: str, in_article: bool) -> int:
    """Whether an element's class, id or tag speaks against it: 0 no, 1 yes, 2 names comments."""
    if tag in ("html", "body", *ARTICLE, *HEADINGS):
        return 0
    out = int(tag in ("form", "fieldset"))
    for name, *values in NAMES.findall(attributes) if attributes else ():
        if name.lower() in ("class", "id"):
            for word in "".join(values).lower().split():
                parts = [x for x in re.split(r"[^a-z0-9]+", word) if x]
                hints = HINTS.intersection(parts) - (HEADER if in_article else frozenset())
                if hints and not MODIFIERS.intersection(parts[:1]):
                    out = max(out, 2 if hints & COMMENTS else 1)
    return out


def _settle(blocks: list[Block]) -> None:
    """Excludes the blocks of doubtful elements, but none that holds an article or most of the page's (in an article, of its) text and few links."""
    inside = [b for b in blocks if not b.outside]
    sizes = [len(" ".join("".join(b.text).split())) for b in inside]
    held: dict[int, list[int]] = {}
    kinds: dict[int, int] = {}
    around: dict[int, int] = {}  # the article that a doubtful element is in, or 0
    totals = {0: sum(sizes)}
    sure = False  # whether an article stands beside the doubtful elements
    for b, n in zip(inside, sizes):
        articles = [e for t, e in zip(b.path, b.elements) if t in ARTICLE]
        sure = sure or bool(articles and not b.doubtful)
        for e in articles:
            totals[e] = totals.get(e, 0) + n
        for e, kind in b.doubtful:
            kinds[e], around[e] = kind, max((x for x in articles if x < e), default=0)
            h = held.setdefault(e, [0, 0, 0])
            h[0] += n
            h[1] += min(b.links, n)
            h[2] += any(x > e for x in articles)
    out = {
        e for e, (n, links, articles) in held.items()
        if kinds[e] == 2 or not articles and (2 * n <= totals[around[e]] or 2 * links > n or sure and not around[e])
    }
    if any(not out.intersection(e for e, _ in b.doubtful) for b in inside):
        for b in inside:
            b.outside = any(e in out for e, _ in b.doubtful)


def blocks_of(page: str) -> list[Block]:
    """Blocks of text in page order, blank ones left out."""
    stack: list[tuple[str, int, bool, bool, bool, tuple]] = []  # tag, element number, outside, in an article, in a link, doubtful elements
    out: list[Block] = []
    now: Block | None = None
    count = at = 0

    def say(text: str) -> None:
        nonlocal now
        if not text:
            return
        if now is None:
            if text.isspace():
                return
            levels = [s for s in stack if s[0] in BLOCK]
            now = Block(tuple(s[0] for s in levels), tuple(s[1] for s in levels), bool(stack) and stack[-1][2], stack[-1][5] if stack else ())
            out.append(now)
        now.text.append(text)
        if stack and stack[-1][4]:
            now.links += len(text.strip())

    def close(to: int) -> None:
        nonlocal now
        for s in stack[to:]:
            if s[0] in BLOCK or s[2] != (to > 0 and stack[to - 1][2]) or s[5] != (stack[to - 1][5] if to else ()):
                now = None
        del stack[to:]

    for m in TOKEN.finditer(page):
        say(html.unescape(page[at : m.start()]))
        at = m.end()
        ending, tag, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not tag:
            continue
        tag = tag.lower()
        if ending:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
                if tag not in BLOCK and stack[k][0] in BLOCK:
                    break
            continue
        if tag == "br":
            say(" ")
        if tag in BLOCK:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or stack[k][0] in CLOSES.get(tag, ()):
                    close(k)
                elif stack[k][0] in SCOPE.get(tag, ()) or (stack[k][0] in BLOCK and tag not in SCOPE):
                    break
            now = None
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        outer = bool(stack) and stack[-1][2]
        in_article, in_link = stack[-1][3:5] if stack else (False, False)
        outside = outer or _named_outside(tag, attributes, in_article)
        count += 1
        doubtful = stack[-1][5] if stack else ()
        if not outside and (kind := _doubtful(tag, attributes, in_article)):
            doubtful = (*doubtful, (count, kind))
            now = None
        if outside != outer:
            now = None
        stack.append((tag, count, outside, in_article or tag in ARTICLE, in_link or tag == "a", doubtful))
    say(html.unescape(page[at:]))
    out = [b for b in out if "".join(b.text).strip()]
    _settle(out)
    return out


def _plain(block: Block) -> str:
    return " ".join("".join(block.text).split())


def main_text(page: str | None) -> str:
    """The article of a page, one line a block."""
    blocks = [b for b in blocks_of(page or "") if not b.outside]
    if not blocks:
        return ""
    texts = [_plain(b) for b in blocks]
    sums: dict[tuple, list[float]] = {}
    for b, t in zip(blocks, texts):
        s = sums.setdefault(b.path, [0, 0, 0, 0])
        for k, v in enumerate((len(t), len(MARKS.findall(t)), min(b.links, len(t)), 1)):
            s[k] += v
    ratio = {p: math.log1p(n / leaves) * math.log1p(marks / leaves) * (1 - links / max(1, n)) for p, (n, marks, links, leaves) in sums.items()}

    def alike(a: tuple, b: tuple) -> float:
        same = 0
        for x, y in zip(a, b):
            if x != y:
                break
            same += 1
        return same / max(len(a), len(b), 1)

    fused = []
    for i, b in enumerate(blocks):
        total = weight = 0.0
        for j in range(max(0, i - 2), min(len(blocks), i + 3)):
            w = math.exp(-((i - j) ** 2) / 2) * alike(b.path, blocks[j].path)
            total += w * ratio[blocks[j].path]
            weight += w
        fused.append((ratio[b.path] + total / (weight or 1)) / 2)
    mean = sum(fused) / len(fused)
    spread = math.sqrt(sum((f - mean) ** 2 for f in fused) / len(fused))
    limit = min(mean, max(spread, mean / 2))
    chosen = [i for i, f in enumerate(fused) if f >= limit and f > 0] or list(range(len(blocks)))
    held: dict[int, int] = {}
    count: dict[int, int] = {}
    named: set[int] = set()
    holders: set[int] = set()  # elements that hold chosen text in an element of their own
    for i in chosen:
        path = blocks[i].elements
        holders.update(path[:-1])
        for tag, e in zip(blocks[i].path, path):
            held[e] = held.get(e, 0) + len(texts[i])
            count[e] = count.get(e, 0) + 1
            if tag in ARTICLE:
                named.add(e)
    whole = sum(len(texts[i]) for i in chosen)
    in_named = [i for i in chosen if named.intersection(blocks[i].elements)]
    # Elements are numbered in page order: among those that hold all of some blocks, the last is the innermost.
    if in_named and 2 * sum(len(texts[i]) for i in in_named) >= whole:
        one = max((e for e in named if count[e] == len(in_named)), default=0)
        articles = {one} if one else named
        chosen = in_named
    else:
        named = set()
        articles = {max((e for e in holders if count[e] == len(chosen)), default=0)}
    top = {e for b in blocks for t, e in zip(b.path, b.elements) if t in ("html", "body")}
    if not named and (articles == {0} or articles & top):
        # Chosen text lies in several places: all of it stays, with the short blocks of the place that holds most.
        articles = {max((e for e in holders - top if 4 * held[e] >= 3 * whole), default=0)}
    picked = set(chosen)
    keep = set(picked)
    for i, b in enumerate(blocks):
        if articles.intersection(b.elements) and 2 * min(b.links, len(texts[i])) <= len(texts[i]):
            keep.add(i)
        elif not named and b.path and b.path[-1] in ("h1", "h2", "h3", "h4") and i + 1 in picked:
            keep.add(i)
    if not named and keep:
        # A heading, and a lead below it, may stand before the element.
        first = min(keep)
        for i in range(first - 1, max(-1, first - 4), -1):
            if 2 * min(blocks[i].links, len(texts[i])) > len(texts[i]):
                break
            if blocks[i].path and blocks[i].path[-1] in ("h1", "h2"):
                keep.update(range(i, first))
                break
    keep = sorted(keep)
    return "\n".join(texts[i] for i in keep if texts[i])


def _extract(batches):
    for batch in batches:
        texts = [main_text(page) for page in strings(batch, "html")]
        kept = [c for c in batch.schema.names if c != "html"]
        columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*kept, "text", "n_chars"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text (empty if there is none), n_chars.

    Null html is an empty page; text without any tag is one block.  Rows are independent: null or
    repeated ids keep their rows, further columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
