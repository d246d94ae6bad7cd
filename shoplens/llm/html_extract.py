"""Main text of web pages by tag-path ratios.

A page becomes blocks of text, each with its root-to-leaf tag path.  Per path the
text length and the punctuation are summed over all its blocks and divided by
their number; the two ratios are fused into one, smoothed over neighbouring blocks
and compared with a threshold taken from their spread.  Paths that pass mark
content nodes.  The deepest container that holds nearly all of the marked text is the
article: every block in it counts, long or short, but those inside boilerplate.  On
pages without an article element marked blocks outside it stay, with the blocks beside
them; a paragraph or any element of a single block is no container.

Boilerplate is what its markup says it is (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, comments): by element, by role, or by a
word of its class or id.  A class or id word only counts if the element is no wrapper:
one that holds most of the marked text, or the page's only article elements.

Defined results: null, empty or markup-free html are read as they stand (text
without any markup is one block); broken markup never fails: unclosed elements end
with their parent, an unclosed comment or script ends the page; repeated rows and
null ids stay; other columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

from shoplens.llm.common import by_batch
from shoplens.session import ship_by_value

#: Smoothing over so many blocks to each side, and its width.
REACH, SIGMA = 2, 1.0
#: Threshold on the smoothed ratios, in standard deviations.
SPREAD = 0.5
#: Part of the marked text that the article holds at least.
HELD = 0.8

# Elements, roles and class words.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed xmp template svg math object select".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "p": {"p"}}
SCOPES = frozenset("ul ol dl table td th div section article aside main body nav form".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog button head label".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
CLASS_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion menu navbar nav "
    "navigation breadcrumb breadcrumbs pagination pager sidebar aside rail footer masthead topbar toolbar cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments "
    "commentlist disqus reply replies respond related recommended share sharing social widget widgets copyright skip hidden".split())
WHOLE_NAMES = frozenset("header site-header page-header top-header global-header head top bottom".split())
ARTICLES = frozenset(["article", "main"])
#: Elements that hold a paragraph's text and never an article.
LEAVES = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup li ul ol dl dt dd pre blockquote address figcaption legend summary a abbr b bdi bdo big cite "
    "code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?(?P<odd>[a-zA-Z][^\s/>]*+)[^>]*+>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"\w")
_NAME_WORD = re.compile(r"[a-z]+")


def is_boilerplate(name: str, attrs: str) -> bool:
    """By element or role."""
    if name in BOILERPLATE:
        return True
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    for key, *values in _ATTRIBUTE.findall(attrs):
        value = "".join(values).lower()
        if key.lower() == "role" and value in ROLES or key.lower() == "aria-hidden" and value == "true":
            return True
    return False


def is_named_boilerplate(name: str, attrs: str) -> bool:
    """By a word of the class or id."""
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    for key, *values in _ATTRIBUTE.findall(attrs):
        if key.lower() in ("class", "id"):
            for one in "".join(values).lower().split():
                if one in WHOLE_NAMES or (not one.startswith(("no-", "has-", "with-", "without-"))
                                          and not CLASS_WORDS.isdisjoint(_NAME_WORD.findall(one))):
                    return True
    return False


class Block:
    """Text between two block borders, with the path and the elements it stands in."""
    __slots__ = ("parts", "path", "inside", "named", "linked", "own")

    def __init__(self):
        self.parts, self.path, self.inside, self.named, self.linked, self.own = [], None, (), (), 0, False

    def only_links(self) -> bool:
        """Links and what separates them."""
        return self.linked > 0 and not self.own

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def blocks(page: str, wrappers: set[tuple[int, str]] | None = None) -> list[Block]:
    """The blocks outside boilerplate, in page order.  ``inside``: (number, name) of the open elements;
    ``named``: those that are boilerplate by class or id.  Of these only ``wrappers`` are entered,
    without ``wrappers`` all, and each has its own blocks."""
    out, stack, number = [], [], 0  # stack: (name, number, boilerplate at or above, boilerplate by class or id)
    block = Block()

    def border() -> None:
        nonlocal block
        if block.path is not None:
            out.append(block)
            block = Block()

    def add(raw: str, decoded: bool = False) -> None:
        if stack and stack[-1][2] or not raw:
            return
        if wrappers is None and block.path is not None and block.named != tuple((x[1], x[0]) for x in stack if x[3]):
            border()
        if block.path is None:
            if raw.isspace():
                return
            block.path = "/".join(x[0] for x in stack)
            block.inside = tuple((x[1], x[0]) for x in stack)
            block.named = tuple((x[1], x[0]) for x in stack if x[3])
        text = raw if decoded else entities.unescape(raw)
        block.parts.append(text)
        if any(x[0] == "a" for x in stack):
            block.linked += len(text.strip())
        elif not block.own:
            block.own = _WORD.search(text) is not None

    def close(names: set[str] | frozenset[str], scope: frozenset[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in scope:
                return

    at = 0
    while (m := _TAG.search(page, at)) is not None:
        add(page[at:m.start()])
        at = m.end()
        if m["data"] is not None:
            add(m["data"], True)
        name = (m["name"] or m["odd"] or "").lower().rstrip("/")
        if not name:
            continue
        if name in BLOCKS:
            border()
        if m["end"] or m["odd"] and page[m.start() + 1] == "/":
            if any(x[0] == name for x in stack):
                close({name}, frozenset())
            continue
        if name in RAW:
            found = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = found.end() if found else len(page)
            continue
        if name in VOID:
            continue
        if name in BLOCKS and name not in ("li", "dt", "dd", "tr", "td", "th", "option"):
            close({"p"}, SCOPES)  # a block ends an open paragraph
        elif name in CLOSES:
            close({"p"}, SCOPES)
            close(CLOSES[name], SCOPES - CLOSES[name])
        number += 1
        named = is_named_boilerplate(name, m["attrs"] or "")
        bad = (bool(stack and stack[-1][2]) or is_boilerplate(name, m["attrs"] or "")
               or named and wrappers is not None and (number, name) not in wrappers)
        stack.append((name, number, bad, named))
    add(page[at:])
    border()
    return [b for b in out if b.text()]


def path_ratios(found: list[Block], texts: list[str]) -> list[float]:
    """The fused ratio of each block's path: text and punctuation a block, without linked text."""
    length, marks, count = defaultdict(float), defaultdict(float), defaultdict(int)
    for b, t in zip(found, texts):
        length[b.path] += max(len(t) - b.linked, 0)
        marks[b.path] += len(PUNCTUATION.findall(t)) if b.linked < len(t) else 0
        count[b.path] += 1
    return [math.log1p(length[b.path] / count[b.path]) * (1 + math.log1p(marks[b.path] / count[b.path])) for b in found]


def smoothed(values: list[float]) -> list[float]:
    out = []
    for i in range(len(values)):
        near = range(max(0, i - REACH), min(len(values), i + REACH + 1))
        weight = [math.exp(-((j - i) ** 2) / (2 * SIGMA**2)) for j in near]
        out.append(sum(w * values[j] for w, j in zip(weight, near)) / sum(weight))
    return out


def marks(found: list[Block], texts: list[str]) -> list[bool]:
    """Which blocks the ratios mark as content; all if they mark none."""
    ratio = path_ratios(found, texts)
    flat = smoothed(ratio)
    mean = sum(flat) / len(flat)
    spread = math.sqrt(sum((x - mean) ** 2 for x in flat) / len(flat))
    # a path is content if its own ratio is high or if it stands among content
    marked = [max(r, s) >= mean - SPREAD * spread and not b.only_links() for r, s, b in zip(ratio, flat, found)]
    return marked if any(marked) else [True] * len(found)


def wrapping(found: list[Block]) -> set[tuple[int, str]]:
    """The elements that are boilerplate by class or id, but hold the article."""
    if not any(b.named for b in found):
        return set()
    texts = [b.text() for b in found]

    def free(b: Block) -> bool:  # in an article element that is in no named element
        return any(e[1] in ARTICLES and (not b.named or e < b.named[0]) for e in b.inside)

    page = [free(b) for b in found]
    wrappers = set()
    if not any(page):
        page = [True] * len(found)
        wrappers = {e for b in found for e in b.named if any(x[1] in ARTICLES and x > e for x in b.inside)}
    total, held = 0, defaultdict(int)
    for b, t, ok, mine in zip(found, texts, marks(found, texts), page):
        if ok and mine:
            total += len(t)
            for e in b.named:
                held[e] += len(t)
    return wrappers | {e for e, n in held.items() if 2 * n > total}


def main_text(page: str | None) -> str:
    """The article's blocks, each with single spaces, joined by one space."""
    found = blocks(page, wrapping(blocks(page))) if page else []
    if not found:
        return ""
    texts = [b.text() for b in found]
    marked = marks(found, texts)
    total = sum(len(t) for t, ok in zip(texts, marked) if ok)
    held: dict[tuple[int, str], int] = defaultdict(int)
    for b, t, ok in zip(found, texts, marked):
        if ok:
            for element in b.inside:
                held[element] += len(t)
    size: dict[tuple[int, str], int] = defaultdict(int)
    for b in found:
        for element in b.inside:
            size[element] += 1
    # the deepest container with nearly all content (numbers grow with depth along a path), or the article around it
    fits = [e for e, n in held.items() if n >= HELD * total]
    outer = [e for e in fits if e[1] in ARTICLES]
    if outer:
        article = max(outer)
        keep = [article in b.inside for b in found]
    else:
        article = max((e for e in fits if size[e] > 1 and e[1] not in LEAVES), default=None)
        home = [max((e for e in b.inside if size[e] > 1 and e[1] not in LEAVES), default=None) for b in found]
        homes = {h for h, ok in zip(home, marked) if ok}
        whole = article is None or article[1] in ("html", "body")
        first, last = marked.index(True), len(marked) - 1 - marked[::-1].index(True)

        def stays(i: int) -> bool:
            if marked[i] or not whole and article in found[i].inside:
                return True
            if found[i].only_links():
                return False
            if whole and first <= i <= last:  # no element of its own: what stands between what passes
                return True
            # beside a marked block; right below the body only what is a paragraph or heading
            open_page = home[i] is None or home[i][1] in ("html", "body")
            return home[i] in homes and (not open_page or bool(found[i].inside) and found[i].inside[-1][1] in LEAVES)

        keep = [stays(i) for i in range(len(found))]
    return " ".join(t for t, ok in zip(texts, keep) if ok)


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p) for p in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])

    return by_batch(pages, ["page_id", "url", "html"], "page_id long, url string, text string, n_chars long", run)


ship_by_value(__name__)
