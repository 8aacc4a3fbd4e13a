"""Main-text extraction from web pages by tag-path ratios.

A page is read into text blocks, each with the path of the elements that hold
it, from the root to the block.  For every path of the page the text length,
the punctuation and the link text are added up over its blocks.  A path's
ratios are text length and punctuation for each block, smoothed over the
neighbouring paths in page order and fused into one score; link text scores
nothing.  A path is content if its score reaches a share of the best one.  The
share depends on where the path stands, since short paragraphs belong to the
article around them: it is least inside the container whose paths together
score most, higher in the rest of the article or main element around that
container, and highest elsewhere.  Blocks that are mostly links count for no
ratio and are not content, but for a linked paragraph of a path that has more
prose than links.  A heading of the container or of that article or main
element goes with the text under it.

Names lower scores.  The ratios of boilerplate elements (menus, footers,
asides, forms, adverts, comments …), by their name, their role or a token of
their class or id, count as nothing with all below them.  If such an element is
or holds an article or main element, or holds most of the page's text (all of
it, if that is a single block), its paths' scores are only lowered; adverts and
comments are spared so only where the page has no other text.  So are those of
an element whose boilerplate word stands beside a word for layout or content
(``has-sidebar``, ``comments-open``).  Where just one article or main element
has text, teaser cards aside, the ratios of all outside it count as nothing.

Paths are numbers (parent path and label), so memory grows with the number of
elements, however deep they are nested.

Defined results: a null or empty page gives the empty text; broken markup is
read as far as it goes (an unclosed comment or script reaches to the end);
repeated rows are extracted each; other columns are kept as asked for.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import unused
from tallyfold.session import ship_package

#: a path outside the main container needs this share of the best score
THRESHOLD = 0.6
#: a path in the article or main element around the container, and one inside
#: the container, need this share of the container's best score
AROUND, INSIDE = 0.25, 0.05
#: what a path's score is multiplied with for each element above it that bears a
#: boilerplate word beside one for layout, or is boilerplate but was spared
WORD_PENALTY, OUT_PENALTY = 0.5, 0.25
#: more such elements above lower no further, so that no score vanishes
MOST_PENALTIES = 20
#: weight of a path's direct neighbours when ratios are smoothed
SMOOTHING = 0.15

# fixed values of HTML: elements by how they are read
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr main menu nav ol p pre section table ul".split())
_SAME_CLOSES = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table tbody thead tfoot", "td": "tr",
                "th": "tr", "option": "select", "p": ""}
# what never holds article text
_NO_TEXT = frozenset("head button select textarea noscript iframe object svg template title".split())
# what hardly ever does, by element, role and words of class and id
_OUT_ELEMENTS = frozenset("nav footer aside form dialog menu".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side menu nav"
    " navbar navigation breadcrumb breadcrumbs footer header masthead comment comments respond reply replies disqus"
    " cookie cookies consent notice popup modal overlay newsletter subscribe signup login share sharing social"
    " related recommended widget toolbar pagination pager search form".split())
# words of adverts, notices and comments: never the article while there is other text
_NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments respond"
    " reply replies disqus cookie cookies consent newsletter related recommended".split())
# words that make a longer token tell of the layout or of the content as well
_LAYOUT_WORDS = frozenset(
    "article content main body story entry text has no with without open closed wrap wrapper container page"
    " layout".split())
_MAIN = frozenset(["article", "main"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)\b[^>]*>.*?(?:</\1[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*)(?:>|\Z)", re.S | re.I)
_MARKED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?¿¡…。，、！？；：]")


class _Element:
    """``path``: number of the element's tag path; ``out``: never holds text.

    ``soft`` is the nearest boilerplate element, itself included, and ``kept`` the
    number of them; ``strict``: in an advert, notice or comment; ``words`` counts the elements with a boilerplate word in a
    token that tells of layout or content too.  ``region`` and ``own`` are the
    outermost and the innermost article or main element around it.
    ``holds_main`` and ``rescued`` are of use in boilerplate elements only.
    """

    __slots__ = ("tag", "path", "parent", "out", "soft", "strict", "depth", "kept", "words", "region", "own",
                 "holds_main", "rescued")

    def __init__(self, tag: str, attributes: str, parent: "_Element | None", paths: "Paths"):
        self.tag, self.parent = tag, parent
        soft, strict, label = tag in _OUT_ELEMENTS, False, tag
        main, word = tag in _MAIN, False
        if "=" in attributes:
            for name, a, b, c in _MARKED.findall(attributes):
                value = html.unescape(a or b or c).lower()
                tokens = value.split()
                if name.lower() == "role":
                    soft = soft or not _OUT_ROLES.isdisjoint(tokens)
                    main = main or "main" in tokens
                elif tag not in ("html", "body"):
                    for token in tokens:
                        words = _PARTS.findall(token)
                        if _OUT_WORDS.isdisjoint(words):
                            continue
                        if len(words) > 1 and not _LAYOUT_WORDS.isdisjoint(words):
                            word = True
                        else:
                            soft = True
                            strict = strict or not _NEVER_WORDS.isdisjoint(words)
                    label += "." + ".".join(sorted(set(_PARTS.findall(value)))) if name.lower() == "class" else ""
        # a header inside the article holds its title; one outside belongs to the site
        soft = soft or tag == "header" and not (main or parent is not None and parent.region is not None)
        # paths are told apart by what is lowered
        label += "!" if soft else "~" if word else ""
        self.path = paths.number(parent.path if parent else -1, label)
        self.out = tag in _NO_TEXT or parent is not None and parent.out
        self.soft = self if soft else parent.soft if parent else None
        self.strict = strict or parent is not None and parent.strict
        self.depth = parent.depth + 1 if parent else 0
        self.kept = (parent.kept if parent else 0) + soft
        self.words = (parent.words if parent else 0) + (word and not soft)
        self.region, self.own = (parent.region, parent.own) if parent else (None, None)
        self.holds_main = self.rescued = False
        if main and not self.out:
            self.own = self
            self.region = self.region or self
            above = self.soft
            while above is not None and not above.holds_main:
                above.holds_main = True
                above = above.parent.soft


class Paths:
    """Tag paths of one page, each a number: its parent path's number and one label."""

    def __init__(self) -> None:
        self.parents: list[int] = []
        self._numbers: dict[tuple[int, str], int] = {}

    def number(self, parent: int, label: str) -> int:
        found = self._numbers.setdefault((parent, label), len(self.parents))
        if found == len(self.parents):
            self.parents.append(parent)
        return found

    def below(self, holder: int | None) -> list[bool]:
        """For each path whether it is the holder or below it; parents have smaller numbers."""
        inside: list[bool] = []
        for path, parent in enumerate(self.parents):
            inside.append(path == holder or parent >= 0 and inside[parent])
        return inside


class Block(NamedTuple):
    """A text block: holding element, text, characters in links."""

    element: _Element
    text: str
    linked: int

    @property
    def is_link(self) -> bool:
        return 2 * self.linked >= len(self.text)


def blocks(page: str) -> tuple[list[Block], Paths]:
    """The page's text blocks in order, and its paths."""
    paths = Paths()
    stack, found = [_Element("", "", None, paths)], []
    open_at: dict[str, list[int]] = defaultdict(list)  # depths of the open elements of each name
    pieces: list[str] = []
    linked, in_link, at = 0, False, 0

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            found.append(Block(stack[-1], text, min(linked, len(text))))
        pieces.clear()
        linked = 0

    def cut(depth: int) -> None:
        while len(stack) > depth:
            open_at[stack.pop().tag].pop()

    for token in _TOKEN.finditer(page):
        text = page[at:token.start()]
        if text:
            pieces.append(text)
            linked += len(text) if in_link else 0
        at = token.end()
        tag = (token[3] or "").lower()
        if not tag:
            continue
        if tag in _INLINE:
            if tag == "a":
                in_link = not token[2]
            continue
        close()
        in_link = False
        if token[2]:
            if open_at[tag]:
                cut(open_at[tag][-1])
        elif tag not in _VOID:
            if tag in _CLOSES_P and stack[-1].tag == "p":
                cut(len(stack) - 1)
            if tag == "p" and stack[-1].tag == "p":
                cut(len(stack) - 1)
            elif tag in _SAME_CLOSES and tag != "p" and open_at[tag]:
                walls = [open_at[wall][-1] for wall in _SAME_CLOSES[tag].split() if open_at[wall]]
                if open_at[tag][-1] > max(walls, default=0):
                    cut(open_at[tag][-1])
            if tag == "body" and open_at["head"]:
                cut(open_at["head"][0])
            open_at[tag].append(len(stack))
            stack.append(_Element(tag, token[4] or "", stack[-1], paths))
    if at < len(page):
        pieces.append(page[at:])
        linked += len(page) - at if in_link else 0
    close()
    return [block for block in found if not block.element.out], paths


def sole_region(found: list[Block]) -> _Element | None:
    """The one article or main element that has text of its own, if there is just one.

    Teaser cards (their heading is a link) don't count; elements less lowered go first.
    """
    cards = {e.own for e, _, _ in found if e.own is not None} & {
        b.element.own for b in found if b.element.tag in _HEADINGS and b.is_link}
    regions = {b.element.region: (b.element.strict, b.element.kept, b.element.words)
               for b in reversed(found) if b.element.own is not None and b.element.own not in cards
               and b.element.tag not in _HEADINGS and not b.is_link}
    least = min(regions.values(), default=None)
    sole = [region for region, lowered in regions.items() if lowered == least]
    return sole[0] if len(sole) == 1 else None


def silenced(found: list[Block]) -> list[bool]:
    """For each block whether its path's ratios count as nothing.

    So are blocks outside the sole article or main element, and those in a
    boilerplate element, unless that is or holds an article or main element or
    holds most of the page's text.  Adverts, notices and reader comments are
    spared only if the page has no other text.
    """
    sole = sole_region(found)
    outside = [sole is not None and block.element.region is not sole for block in found]
    if not any(block.element.soft for block in found):
        return outside
    mass: dict[_Element, float] = defaultdict(float)
    count: dict[_Element, int] = defaultdict(int)
    total, plain_total = 0.0, 0.0
    chain: set[_Element] = set()
    for block, away in zip(found, outside):
        weight = 0 if away or block.is_link else (len(block.text) - block.linked) * (
            1 + len(_PUNCTUATION.findall(block.text)))
        total += weight
        soft = block.element.soft
        if soft is None:
            plain_total += weight
            continue
        mass[soft] += weight
        count[soft] += weight > 0
        while soft is not None and soft not in chain:
            chain.add(soft)
            soft = soft.parent.soft
    order = sorted(chain, key=lambda e: e.depth)
    plain_total += sum(mass[soft] for soft in order if not soft.strict)
    for soft in reversed(order):
        if soft.parent.soft is not None:
            mass[soft.parent.soft] += mass[soft]
            count[soft.parent.soft] += count[soft]
    dropped: dict[_Element, bool] = {}
    for soft in order:
        most = 2 * mass[soft] > total and (count[soft] > 1 or mass[soft] == total)
        around = sole is not None and sole.soft is not None and soft.holds_main and soft.depth <= sole.depth
        soft.rescued = around or (soft.holds_main or most) and (not soft.strict or plain_total == 0)
        above = soft.parent.soft
        dropped[soft] = not soft.rescued or above is not None and dropped[above]
    return [away or block.element.soft is not None and dropped[block.element.soft]
            for block, away in zip(found, outside)]


def path_scores(found: list[Block], silent: list[bool]) -> dict[tuple[int, bool], float]:
    """Fused, smoothed ratio of every path (its number, silenced or not).

    Text and punctuation are added up over the path's blocks that are not mostly
    links.  A silenced path has ratios of zero; boilerplate words above lower them.
    """
    length, marks, nodes, lowered = {}, {}, {}, {}
    for block, quiet in zip(found, silent):
        element, text, linked = block
        path = (element.path, quiet)
        if path not in lowered:
            length[path] = marks[path] = nodes[path] = 0
            lowered[path] = 0.0 if quiet else (
                WORD_PENALTY ** min(element.words, MOST_PENALTIES) * OUT_PENALTY ** min(element.kept, MOST_PENALTIES))
        if not block.is_link:
            length[path] += len(text) - linked
            marks[path] += len(_PUNCTUATION.findall(text))
            nodes[path] += 1
    paths = list(length)  # in page order
    text_ratio = [length[p] / max(nodes[p], 1) * (lowered[p] > 0) for p in paths]
    mark_ratio = [marks[p] / max(nodes[p], 1) * (lowered[p] > 0) for p in paths]

    def smoothed(values: list[float]) -> list[float]:
        padded = [values[0], *values, values[-1]] if values else []
        return [(1 - 2 * SMOOTHING) * padded[i] + SMOOTHING * (padded[i - 1] + padded[i + 1])
                for i in range(1, len(values) + 1)]

    return {p: t * (1 + m) * (lowered[p] or 1.0)
            for p, t, m in zip(paths, smoothed(text_ratio), smoothed(mark_ratio))}


def content(found: list[Block], paths: Paths) -> list[bool]:
    """For each block whether it is content, by its path's score."""
    silent = silenced(found)
    scores = path_scores(found, silent)
    mass: dict[int, float] = defaultdict(float)
    elements: dict[tuple[int, bool], _Element] = {}
    prose: dict[tuple[int, bool], int] = defaultdict(int)  # blocks of prose less blocks of links
    best = 0.0
    for block, quiet in zip(found, silent):
        path = (block.element.path, quiet)
        elements.setdefault(path, block.element)
        prose[path] += -1 if block.is_link else 1
        if not quiet and not block.is_link:
            mass[paths.parents[path[0]]] += scores[path] * (len(block.text) - block.linked)
            best = max(best, scores[path])
    if best <= 0:
        return [False] * len(found)
    holder = max(mass, key=lambda p: mass[p])
    inside = [p for p in scores if paths.parents[p[0]] == holder and not p[1]]
    region = elements[inside[0]].region
    in_holder, in_region = paths.below(holder), paths.below(region.path if region else None)
    # an element below the container that is lowered further counts as elsewhere
    least = min((elements[p].words, elements[p].kept) for p in inside)
    top = max(scores[p] for p in inside)
    near = {p: not p[1] and (e.words, e.kept) <= least for p, e in elements.items()}
    close = {p: near[p] and (in_holder[p[0]] or in_region[p[0]]) for p in elements}
    chosen = {}
    for path, score in scores.items():
        if near[path] and in_holder[path[0]]:
            share = INSIDE * top
        elif close[path]:
            share = AROUND * top
        else:
            share = THRESHOLD * best
        chosen[path] = score >= share
    # backwards: has each heading's level text under it?
    taken, under = [], [False] * 7
    for block, quiet in zip(reversed(found), reversed(silent)):
        path, tag = (block.element.path, quiet), block.element.tag
        # a paragraph that is a link goes with the prose around it, a list of links goes
        good = chosen[path] and (not block.is_link or close[path] and prose[path] > 0)
        if tag in _HEADINGS and close[path]:
            level = int(tag[1])
            taken.append(under[level] or good and scores[path] >= THRESHOLD * best)
            # a heading ends the sections of its level and below
            under[level:] = [False] * (7 - level)
        else:
            taken.append(good)
            if good and close[path]:
                under = [True] * 7
    return taken[::-1]


def main_text(page: str | None) -> str:
    """The article's text: blocks of content paths, joined by one space."""
    found, paths = blocks(page or "")
    return " ".join(block.text for block, taken in zip(found, content(found, paths)) if taken)


def extract(pages: DataFrame, columns: list[str], html_col: str = "html") -> DataFrame:
    """``columns`` of pages and text; no shuffle."""
    ship_package(pages.sparkSession)
    kept = pages.select(*columns)
    names = kept.columns
    rows = pages.select(*columns, F.col(html_col).alias(unused("__html", names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(texts, pa.string())], [*names, "text"])

    schema = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes)
    return rows.mapInArrow(run, f"{schema}, text string")
