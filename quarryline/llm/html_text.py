"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block of text. The line-block distribution is the sum of text lengths over sliding
windows of lines. It surges where text begins and dives to nothing where it ends; the text between surge and dive is
kept, and so are short stretches next to it in the same parent.

What a page says about its parts enters as weights of the lengths: characters inside an article or main element count more,
those of links nothing, those of an element whose class hints at something else (``sidebar-right``) less. Elements that name
themselves something else (``nav``, ``class="comments"``) count nothing, unless they hold most of the page's text and what is left
does not surge: then the name is overruled. Where the layout moves from one part of the page to another, and
where something counts nothing, lines are set apart by empty ones, so that no window reaches across.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import prepare

# Lines of a window, and empty lines that a removed element leaves: no window reaches across it.
WINDOW = 3
# Characters a window must hold for text to surge.
SURGE = 86
# How often a character inside an article or main element counts, and one of an element hinted at only divided by it.
ARTICLE = 4
# A name is overruled when its element holds this share of the page's text or more, and the rest an eighth of that at most or no surge.
MOST = 0.5
REST = 8
# Names judged one inside the other; where more of them hold most of the text, none is believed.
MOST_OVERRULED = 16

# Elements of the HTML standard by what they mean for text.
RAW = "script style textarea title noscript template svg math iframe object canvas xmp noembed noframes".split()
ASIDE = "nav header footer aside form button select dialog menu head audio video".split()
BLOCK = (
    "address article blockquote body br center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr"
    " html legend li main ol p pre section summary table tbody td tfoot th thead tr ul"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
# Words of class and id attributes, and roles, that mark what surrounds an article; as a part of a longer word, a hint.
MARKS = (
    "ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion sidebar side-bar menu"
    " navbar nav navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices"
    " disclaimer comment comments commentlist reply replies disqus respond share sharing social related newsletter"
    " subscribe subscription signup login popup modal overlay toolbar pagination pager widget search tags"
).split()
# First parts of class names that describe a layout instead, and marks that also hold on articles.
LAYOUT = "with has no without".split()
REMARKS = "comment comments reply replies".split()
ROLES = "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split()

_COMMENT_END = re.compile(r"--!?>")
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>\x00]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[a-z]+(?:-[a-z]+)*")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I) for name in RAW}
_MARKS, _ROLES, _RAW, _ASIDE, _BLOCK, _VOID = map(frozenset, (MARKS, ROLES, RAW, ASIDE, BLOCK, VOID))
_HOLDERS = frozenset("article main section div td th".split())
_LAYOUT, _REMARKS = frozenset(LAYOUT), frozenset(REMARKS)
# Opening one of these ends an open element of the same kind inside the same parent.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

# Elements that HTML itself sets aside are never overruled; a form may be wrapped around a whole page.
_FIRM = _ASIDE - {"form"}
FIRM, NAMED, HINTED = "firm", "named", "hinted"


def _marked(attributes: str, marks: frozenset = _MARKS) -> str | None:
    """Whether attributes name an element as something that is no article or not shown, or a part of a class hints at it."""
    hint = None
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return NAMED
        if name == "style":
            if "display:none" in value.replace(" ", ""):
                return NAMED
        elif name == "role":
            if value.strip() in _ROLES:
                return NAMED
        else:
            for word in value.split():
                if word in marks:
                    return NAMED
                for part in _WORD.findall(word.replace("_", "-")):
                    parts = part.split("-")
                    if part in marks or (parts[0] not in _LAYOUT and not marks.isdisjoint(parts)):
                        hint = HINTED
    return hint


def tag_ends(page: str):
    """Where the tag whose attributes begin at a place ends, after its ``>`` outside of quotes; -1 if nowhere.

    All quotes and ``>`` are looked at once, from the last to the first, so that broken markup takes no longer.
    """
    places, ends = [], []
    for stop in _STOP.finditer(page):
        places.append(stop.start())
    ends = [-1] * (len(places) + 1)
    following = {"'": len(places), '"': len(places)}
    for k in range(len(places) - 1, -1, -1):
        sign = page[places[k]]
        if sign == ">":
            ends[k] = places[k] + 1
        else:
            # On from the stop after the closing quote.
            close = following[sign]
            ends[k] = ends[close + 1] if close < len(places) else -1
            following[sign] = k
    return lambda at: ends[bisect_left(places, at)]


def tokens(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """Texts, and tags as name, whether they close, and attributes; raw elements as an opening tag alone."""
    at, begin, size, end_of = 0, 0, len(page), tag_ends(page)
    while True:
        at = page.find("<", at)
        if at < 0:
            break
        tag = None
        if page.startswith("<!--", at):
            if page.startswith((">", "->"), at + 4):
                end = page.index(">", at + 4) + 1
            else:
                close = _COMMENT_END.search(page, at + 4)
                end = close.end() if close else size
        elif found := _NAME.match(page, at + 1):
            end = end_of(found.end())
            if end < 0:
                # No tag: the sign is text.
                at += 1
                continue
            tag = found.group(2).lower(), bool(found.group(1)), page[found.end() : end - 1]
        elif page.startswith(("<!", "<?", "</"), at):
            end = page.find(">", at) + 1 or size
        else:
            at += 1
            continue
        if begin < at:
            yield page[begin:at], "", False, ""
        if tag is not None:
            yield "", *tag
            if tag[0] in _RAW and not tag[1]:
                close = _RAW_END[tag[0]].search(page, end)
                end = close.end() if close else size
        at = begin = end
    if begin < size:
        yield page[begin:], "", False, ""


@dataclass
class Line:
    """A block of text, the innermost elements around it by number (0 for none), and what the page says about it."""

    text: str
    linked: int  # characters inside links
    article: bool
    hinted: bool
    named: int  # that names itself something else
    own: int  # that lays out a page; the body is 0
    above: int  # the one around that
    after_gap: bool


@dataclass
class Page:
    """Lines in page order; by number, the named element around a named one, the last element inside one that holds lines, and
    the named elements that are never overruled."""

    lines: list[Line]
    around: dict[int, int]
    last: dict[int, int]
    firm: set[int]


class _Open:
    """Open elements, with how many there are of each name."""

    def __init__(self):
        self.stack: list[tuple[str, str | None, int]] = []
        self.count: dict[str, int] = {}

    def push(self, name: str, mark: str | None, number: int) -> None:
        self.stack.append((name, mark, number))
        self.count[name] = self.count.get(name, 0) + 1

    def pop(self) -> tuple[str, str | None, int]:
        top = self.stack.pop()
        self.count[top[0]] -= 1
        return top


def lines_of(page: str) -> Page:
    """Lines of text and the elements around them."""
    lines: list[Line] = []
    held: list[tuple[str, bool]] = []
    open_, links = _Open(), 0
    named: list[int] = [0]
    hinted = 0
    holders: list[int] = [0]
    around: dict[int, int] = {}
    inner: dict[int, int] = {}
    firm: set[int] = set()
    number, gap = 0, False

    def end_line() -> None:
        nonlocal gap
        if not held:
            return
        texts = [" ".join(html.unescape(text).split()) for text, _ in held]
        text = " ".join(html.unescape("".join(text for text, _ in held)).split())
        linked = sum(len(text) for text, (_, link) in zip(texts, held) if link)
        held.clear()
        if text:
            article = bool(open_.count.get("article") or open_.count.get("main"))
            lines.append(Line(text, min(linked, len(text)), article, hinted > 0, named[-1], holders[-1], holders[-2] if len(holders) > 1 else 0, gap))
            gap = False

    def left(mark: str | None, name: str) -> None:
        nonlocal hinted, gap, links
        if mark in (FIRM, NAMED):
            named.pop()
        elif mark == HINTED:
            hinted -= 1
        if mark:
            gap = True
        if name in _HOLDERS:
            inner[holders.pop()] = number
        if name == "a":
            links -= 1

    def close(name: str) -> None:
        while True:
            top, mark, _ = open_.pop()
            if mark:
                end_line()
            left(mark, top)
            if top == name:
                return

    for text, name, closing, attributes in tokens(page):
        if not name:
            held.append((text, links > 0))
            continue
        if name in _RAW and not closing:
            if name != "title":
                end_line()
                gap = True
            continue
        if closing:
            if name in _BLOCK or name in _ASIDE:
                end_line()
            if open_.count.get(name):
                close(name)
            continue
        mark = FIRM if name in _FIRM else NAMED if name in _ASIDE else None
        if mark is None and attributes and name not in ("html", "body", "main"):
            mark = _marked(attributes, _REMARKS if name == "article" else _MARKS)
        if name in _BLOCK or mark:
            end_line()
        if name in _VOID or (attributes.endswith("/") and mark):
            gap = gap or mark is not None
            continue
        if open_.stack and open_.stack[-1][0] in _CLOSES.get(name, ()):
            close(open_.stack[-1][0])
        number += 1
        if mark in (FIRM, NAMED):
            around[number] = named[-1]
            if mark == FIRM:
                firm.add(number)
            named.append(number)
        elif mark == HINTED:
            hinted += 1
        if mark:
            gap = True
        if name in _HOLDERS:
            holders.append(number)
        if name == "a":
            links += 1
        open_.push(name, mark, number)
    end_line()
    return Page(lines, around, inner | dict.fromkeys(holders, number), firm)


def _weight(line: Line, article: int) -> int:
    """Characters of a line as they count in the windows; a linked line counts nothing."""
    plain = len(line.text) - line.linked
    if 2 * line.linked > len(line.text):
        return plain if plain > 2 * SURGE else 0
    if line.article:
        plain = len(line.text) * article
    return -(-plain // article) if line.hinted else plain if line.article else len(line.text)


def apart(lines: list[Line], last: dict[int, int]) -> list[bool]:
    """Before which lines the layout moves to another part of the page.

    Parts are what different elements hold, unless one is inside the other or both are single lines side by side, as paragraphs are.
    """
    sizes: dict[int, int] = {}
    for line in lines:
        sizes[line.own] = sizes.get(line.own, 0) + 1
    cut = [False] * len(lines)
    for i in range(1, len(lines)):
        before, here = lines[i - 1], lines[i]
        nested = before.own <= here.own <= last[before.own] or here.own <= before.own <= last[here.own]
        if not nested:
            cut[i] = before.above != here.above or sizes[before.own] > 1 or sizes[here.own] > 1
    return cut


def distribution(lengths: list[int], window: int = WINDOW) -> list[int]:
    """Characters in the window of lines that starts at each line."""
    size, lengths = len(lengths), lengths + [0] * window
    total = sum(lengths[:window])
    sums = []
    for i in range(size):
        sums.append(total)
        total += lengths[i + window] - lengths[i]
    return sums


def spans(
    sums: list[int], lengths: list[int], surge: int = SURGE, parents: list[tuple[int, int]] | None = None
) -> list[tuple[int, int]]:
    """Stretches of lines from a surge to the dive after it.

    A stretch ends where the window is empty; it counts if any of its windows surges. Where none does, the stretch
    with the most text counts, so that short articles are not lost. With ``parents``, gaps next to a stretch that
    counts are bridged, see ``bridged``.
    """
    stretches, start, high, text = [], None, 0, 0
    for i, total in enumerate([*sums, 0]):
        if start is None and total and i < len(lengths) and lengths[i]:
            start, high, text = i, 0, 0
        if start is not None:
            high = max(high, total)
            if total == 0:
                stretches.append((start, i, high, text))
                start = None
            elif i < len(lengths):
                text += lengths[i]
    kept = [top >= surge for _, _, top, _ in stretches]
    if not any(kept) and stretches:
        kept[max(range(len(stretches)), key=lambda k: (stretches[k][3], -stretches[k][0]))] = True
    if parents is not None:
        kept = bridged(kept, [{p for p, n in zip(parents[a:b], lengths[a:b]) if n} for a, b, _, _ in stretches])
    return [(a, b) for (a, b, _, _), keep in zip(stretches, kept) if keep]


def bridged(kept: list[bool], held: list[set[tuple[int, int]]]) -> list[bool]:
    """Which stretches count when those next to one that counts join it.

    They join when the same element holds them, or elements next to each other in one element. Elements next to each
    other in the body join only between two stretches that count, as what surrounds an article is there as well.
    """
    own = [{p for p, _ in pairs} for pairs in held]
    near = [one | {above for _, above in pairs if above} for one, pairs in zip(own, held)]
    loose = [one | {above for _, above in pairs} for one, pairs in zip(own, held)]
    done = list(kept)
    for order in (range(1, len(kept)), range(len(kept) - 2, -1, -1)):
        for k in order:
            before = k - order.step
            done[k] = done[k] or (done[before] and not near[k].isdisjoint(near[before]))
    last = None
    for k in [k for k, keep in enumerate(done) if keep]:
        if last is not None and all(not loose[x].isdisjoint(loose[last] & loose[k]) for x in range(last + 1, k)):
            done[last + 1 : k] = [True] * (k - last - 1)
        last = k
    return done


def _kept(lines: list[Line], last: dict[int, int], window: int, surge: int, article: int) -> tuple[list[int], bool]:
    """Numbers of the lines between surge and dive, and whether the distribution surges anywhere."""
    numbers: list[int] = []
    lengths: list[int] = []
    parents: list[tuple[int, int]] = []
    cut = apart(lines, last)
    weights = [_weight(line, article) for line in lines]
    # What is hinted at counts only where it surges by itself, or where there is nothing else.
    if any(weight and not line.hinted for weight, line in zip(weights, lines)):
        own = distribution([weight if line.hinted else 0 for weight, line in zip(weights, lines)], window)
        reached = [any(own[max(0, i - window + 1) : i + 1][k] >= surge for k in range(min(window, i + 1))) for i in range(len(lines))]
        weights = [0 if line.hinted and not reached[i] else weight for i, (weight, line) in enumerate(zip(weights, lines))]

    def empty() -> None:
        numbers.extend([-1] * window)
        lengths.extend([0] * window)
        parents.extend([(0, 0)] * window)

    for i, line in enumerate(lines):
        if line.after_gap or cut[i]:
            empty()
        weight = weights[i]
        if not weight:
            # A line that counts nothing is a gap.
            empty()
            continue
        numbers.append(i)
        lengths.append(weight)
        # What is hinted at joins nothing: it stays by its own surge.
        parents.append((-i - 1, 0) if line.hinted else (line.own, line.above))
    sums = distribution(lengths, window)
    kept = spans(sums, lengths, surge, parents)
    return [numbers[k] for a, b in kept for k in range(a, b) if numbers[k] >= 0], any(total >= surge for total in sums)


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE, article: int = ARTICLE) -> str:
    """The article of a page, blocks joined by one space; empty without text."""
    if not page:
        return ""
    read = lines_of(page)
    overruled: set[int] = set()
    total = sum(len(line.text) for line in read.lines)
    while True:
        # The outermost name around each line that is not overruled.
        outermost = {0: 0}
        for number, outer in read.around.items():
            outermost[number] = outermost[outer] or (0 if number in overruled else number)
        shown: list[Line] = []
        within: dict[int, int] = {}
        gap = False
        for line in read.lines:
            if name := outermost[line.named]:
                within[name] = within.get(name, 0) + len(line.text) - line.linked
                gap = True
            else:
                # Where something that counts nothing stood, a gap stays.
                shown.append(replace(line, after_gap=True) if gap else line)
                gap = False
        kept, surges = _kept(shown, read.last, window, surge, article)
        largest = max(within, key=within.__getitem__, default=0)
        if not largest or largest in read.firm or within[largest] < MOST * total or any(shown[k].article for k in kept):
            break
        if surges and REST * sum(_weight(shown[k], article) for k in kept) > within[largest]:
            break
        overruled.add(largest)
        if len(overruled) == MOST_OVERRULED:
            # Names in names without end: all of them go.
            overruled.update(read.around.keys() - read.firm)
    return " ".join(_with_links(shown, kept))


def _with_links(lines: list[Line], kept: list[int]) -> list[str]:
    """Texts of the kept lines, and of linked lines between two of one element."""
    texts: list[str] = []
    for k, following in zip(kept, [*kept[1:], None]):
        texts.append(lines[k].text)
        if following is not None and lines[k].own == lines[following].own:
            between = lines[k + 1 : following]
            if all(line.own == lines[k].own and line.linked for line in between):
                texts += [line.text for line in between]
    return texts


def _extract(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in batches:
        texts = [main_text(page) for page in pages]
        yield pd.DataFrame({"text": texts, "n_chars": [len(text) for text in texts]})


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Main text of every page: ``key``, ``url``, ``text``, ``n_chars`` (code points), one row per input row.

    Null and empty pages, and pages without text outside what is left out, give an empty text. Keys and urls pass as
    they are, nulls and repeats too. Pages of any length are read whole, broken markup to its end. An empty
    table gives no rows; other columns are not looked at.
    """
    prepare(pages.sparkSession)
    main = F.pandas_udf(_extract, "text string, n_chars long")
    rows = pages.select(F.struct(key, url).alias("row"), main(F.col(page).cast("string")).alias("main"))
    return rows.select("row.*", "main.*")
