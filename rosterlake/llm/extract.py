"""Main text of web pages by line-block distribution.

Markup is stripped to one line for each block of text. The lengths of neighbouring lines are summed over a sliding window;
text starts where the sums surge and ends where they dive to nothing, and what lies between is kept. The windows run over the
whole page; only lines that an element itself calls something else (menus, footers, forms) have no length.

What else the markup says is evidence that the lengths decide on. An ``article`` or ``main`` element that holds the longest
stretch bounds the text and widens it to its own ends, since short last lines are part of an article; elsewhere such elements
are teasers and count for nothing. Class words that speak of comments or adverts take their lines out, but not where that would
leave no stretch at all: then the lines under the fewest such words are the page.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import small_batches

#: Lines in a window, the sum at which text surges, and the sum at or under which it dives.
WINDOW, SURGE, DIVE = 3, 86, 0
#: Share of a line that may be link text.
LINKED = 0.6
#: Lines of link text in a row that make a list of links, and the code points under which such lines are entries of a menu on
#: average: titles of what an article refers to are longer.
LISTED, ENTRY = 3, 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
_SPACE = re.compile(r"\s+")
#: Elements whose content is text of another kind, up to their end tag.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext template svg math noscript".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr br nobr".split())
#: Elements that are never the article.
_ASIDE = frozenset("nav footer aside form menu dialog button select option fieldset head object audio video canvas".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words of a class or id that say a part is not the article.
_NOT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert\w*|adsense|banners?|sponsor\w*|promo\w*|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|side|"
    r"footers?|foot|copyright|cookies?|consent|gdpr|notices?|notifications?|alerts?|popups?|modal|overlay|newsletter|subscri\w*|"
    r"signup|login|comments?|commentlist|disqus|respond|repl(?:y|ies)|discussion|share|sharing|social|related|recommend\w*|"
    r"trending|popular|widgets?|toolbar|pagination|pager|tags?|skip|hidden|search|masthead|header|topbar|disclaimer|legal)(?=$|[\s_-])", re.I)
#: Names that only speak of such a part: the head of an article, a page laid out beside a sidebar.
_ONLY_SAYS = re.compile(r"(?:article|post|entry|content|story|main|page)[_-]+(?:header|head|title|body|text|content)\b|"
                        r"\b(?:has|with|no|without|is|js)[_-]+\S+", re.I)
_YES = frozenset(("article", "main"))


@dataclass
class Line:
    """One block of text: its pieces, how much of it is link text, whether an element says that it is none of the article, how many
    class words around it say so, and the article it is in."""

    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    aside: bool = False
    doubts: int = 0
    article: int = 0

    def text(self) -> str:
        return _SPACE.sub(" ", "".join(self.pieces)).strip()


def _says(tag: str, attributes: str, in_article: bool) -> tuple[bool, int]:
    """Whether an element is none of the article by what it is, and whether a class word says so."""
    if tag in _ASIDE or tag == "header" and not in_article:
        return True, 0
    if tag in ("body", "html", *_YES) or not attributes:
        return False, 0
    doubt = 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "role" and value.lower() in _ROLES:
            return True, 0
        if name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return True, 0
        if name in ("class", "id") and _NOT.search(_ONLY_SAYS.sub(" ", value)):
            doubt = 1
    return bool(re.search(r"(?:^|\s)hidden(?:\s|$|/)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes))), doubt


def lines_of(page: str) -> list[Line]:
    """The page as lines, one a block, in page order."""
    out, line = [], Line()
    stack: list[tuple[str, bool, int, int]] = []  # open elements: tag, whether in an aside, doubts, number of the article
    aside, doubts, article, articles, links, at = False, 0, 0, 0, 0, 0

    def end_line() -> None:
        nonlocal line
        if line.pieces:
            out.append(line)
        line = Line(aside=aside, doubts=doubts, article=article)

    def add(text: str) -> None:
        nonlocal line
        if text:
            if not line.pieces:
                line.aside, line.doubts, line.article = aside, doubts, article
            text = html.unescape(text)
            line.pieces.append(text)
            if links:
                line.linked += len(_SPACE.sub(" ", text).strip())

    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        closing, tag, attributes = bool(found[1]), found[2].lower(), found[3]
        if tag == "br":
            add(" ")
            continue
        if not closing:
            if tag in _RAW:
                if not attributes.rstrip().endswith("/"):
                    end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                    at = end.end() if end else len(page)
                continue
            if tag not in _INLINE:
                end_line()
            if tag in _VOID:
                continue
            own, doubt = _says(tag, attributes, article > 0)
            if tag in _YES and not aside and not article:
                articles += 1
                stack.append((tag, aside or own, doubts + doubt, articles))
            elif tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
                around = stack[-2] if len(stack) > 1 else ("", False, 0, 0)
                stack[-1] = (tag, around[1] or own, around[2] + doubt, article)
            else:
                stack.append((tag, aside or own, doubts + doubt, article))
            if tag == "a":
                links += 1
        else:
            if tag not in _INLINE:
                end_line()
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == tag), None)
            if tag in _INLINE and depth is not None and any(t not in _INLINE for t, *_ in stack[depth + 1 :]):
                depth = None  # an inline end tag closes no block
            if depth is not None:
                links -= sum(t == "a" for t, *_ in stack[depth:])
                del stack[depth:]
        now = stack[-1][1:] if stack else (False, 0, 0)
        if now != (aside, doubts, article):
            aside, doubts, article = now
            if line.pieces:
                end_line()
            line.aside, line.doubts, line.article = now
    end_line()
    return out


def stretches(lengths: list[int], window: int = WINDOW, surge: int = SURGE, dive: int = DIVE) -> list[tuple[int, int]]:
    """Half-open ranges of lines between a surge of the windowed sums and the dive after it."""
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    out, start = [], None
    for i, value in enumerate(sums):
        if start is None and value >= surge and lengths[i]:
            start = i
        elif start is not None and value <= dive:
            out.append((start, i))
            start = None
    if start is not None:
        out.append((start, len(lengths)))
    return out


def _menus(linked: list[bool], texts: list[str]) -> set[int]:
    """Lines of link text that stand in a list of short ones."""
    out, at = set(), 0
    while at < len(linked):
        upto = at
        while upto < len(linked) and linked[upto]:
            upto += 1
        if upto - at >= LISTED and sum(map(len, texts[at:upto])) < ENTRY * (upto - at):
            out.update(range(at, upto))
        at = max(upto, at + 1)
    return out


def _widened(found: list[tuple[int, int]], lengths: list[int]) -> list[tuple[int, int]]:
    """Stretches that also hold the lines right before their surge: a short first paragraph makes none."""
    out, last = [], 0
    for start, end in found:
        while start > last and lengths[start - 1]:
            start -= 1
        out.append((start, end))
        last = end
    return out


def _kept(lines: list[Line], texts: list[str], doubts: int) -> list[int]:
    """The lines of the article, with lines under more than ``doubts`` class words taken out."""
    linked = [x.linked > LINKED * len(text) for x, text in zip(lines, texts)]
    menus = _menus(linked, texts)
    out = [x.aside or x.doubts > doubts for x in lines]
    # inside an article a line of link text belongs to it, unless it stands in a menu
    lengths = [0 if out[i] or linked[i] and (not x.article or i in menus) else len(texts[i]) for i, x in enumerate(lines)]
    found = stretches(lengths)
    if not found:
        return []

    def weight(places: range, of: bool | None = None) -> int:
        return sum(lengths[i] for i in places if of is None or bool(lines[i].article) is of)

    longest = max((range(*f) for f in found), key=weight)
    if 2 * weight(longest, True) <= weight(longest):
        plain = [0 if x.article else n for x, n in zip(lines, lengths)]  # the articles here are teasers
        return [i for f in _widened(stretches(plain), plain) for i in range(*f) if plain[i]]
    # every article that holds a stretch is kept whole, all but what is out and its menus
    held = {lines[i].article for f in found for i in range(*f) if lengths[i] and lines[i].article}
    return [i for i, x in enumerate(lines) if x.article in held and lengths[i]]


def main_text(page: str | None) -> str:
    """The article of a page: its blocks, white space inside a block as one space, joined by two line feeds."""
    every = [(x, x.text()) for x in lines_of(page or "")]
    lines, texts = [x for x, t in every if t], [t for _, t in every if t]
    kept: list[int] = []
    for doubts in sorted({0, *(x.doubts for x in lines)}):
        kept = kept or _kept(lines, texts, doubts)
    if not kept:
        # nothing surges on a page of a few words: its only text is the text
        least = min((x.doubts for x in lines if not x.aside), default=0)
        inside = any(x.article and not x.aside for x in lines)
        kept = [i for i, x in enumerate(lines) if not x.aside and x.doubts == least and (x.article or not inside) and (x.article or x.linked <= LINKED * len(texts[i]))]
    return "\n\n".join(texts[i] for i in kept)


def extract(pages: DataFrame, markup: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text in ``into``, empty if there is none. One narrow pass, no shuffle.

    Null and empty markup gives an empty text; cut-off markup is read as far as it goes, and markup of any length whole. Repeated
    rows each get theirs, an empty table gives an empty result. A column named like ``into`` is replaced, all others pass
    through."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def read(column: pd.Series) -> pd.Series:
        return column.map(main_text, na_action=None)

    return pages.withColumn(into, read(F.col(f"`{markup}`").cast("string")))
