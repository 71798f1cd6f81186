"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines, one per block element; parts that are no article
text (menus, adverts, forms, scripts, comments and the like) leave one empty
line each.  Text lengths, without the text of links, are summed over sliding
windows of lines.  A text starts where the sums surge and ends where they dive
to nothing; the lines between are kept, with the lines that adjoin them and
short runs beside them.  This decides on every page: lines in an article or main
element only weigh more than lines outside, and links in an h1 weigh as text.

Defined results: a null or empty page has no text; unclosed and stray tags are
accepted; a page whose sums never surge keeps the run of its highest window;
repeated rows are kept; an empty table gives no rows.  Only the named columns
are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from satlake.llm.common import ship

#: Lines in a window, and the sum that counts as a surge.
WINDOW = 3
SURGE = 80
#: What a character inside <article> or <main> weighs, that of a link as well.
ARTICLE_WEIGHT = SURGE
#: Empty lines that part two runs.
GAP = [("", 0, False)] * WINDOW

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp")
#: Of these, what takes the rest of the page where its end is missing; the start of the others is passed over.
CODE = ("script", "style", "xmp")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary table"
    " tbody td tfoot th thead title tr ul".split()
)
LEFT_OUT = frozenset("head nav aside footer button select input dialog menu object canvas audio video map".split())
#: Left out like a part named so by its class: some servers wrap the whole page in one.
WRAPPERS = frozenset(("form", "fieldset"))
LEFT_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split()
)
LEFT_OUT_WORDS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored promo promoted banner sidebar"
    " menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices popup"
    " overlay modal newsletter subscribe subscription signup login comment comments commentlist disqus respond reply"
    " replies related recommended recommendations share sharing social toolbar pagination pager widget widgets skip"
    " outbrain taboola".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
HEADER_WORDS = frozenset("header topbar".split())

_MARKUP = re.compile(r"<(?:(?P<comment>!--)|(?P<declared>[!?])|(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*+))", re.IGNORECASE)
_STOP = re.compile(r"[>\"']")
_RAW_END = {name: re.compile(rf"</{name}\s*+>", re.IGNORECASE) for name in RAW}
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/$")
_ATTRIBUTE = re.compile(r"([a-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_WORDS = re.compile(r"[a-z0-9]+")


def _left_out(name: str, rest: str, in_article: bool) -> str:
    """Whether an element is none of the article's text: out, or by its class a part or comments, which may be undone."""
    if name in LEFT_OUT or (name == "header" and not in_article):
        return "out"
    found = "part" if name in WRAPPERS else ""
    if not rest.strip(" /") or name in ("html", "body", "main"):
        return found
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "")):
            return "out"
        if key == "role" and value in LEFT_OUT_ROLES:
            return "out"
        if key in ("class", "id"):
            words = set(_WORDS.findall(value))
            if name == "article":
                words &= COMMENT_WORDS
            if words & COMMENT_WORDS:
                found = "comments"
            elif words & LEFT_OUT_WORDS or (not in_article and words & HEADER_WORDS):
                found = found or "part"
    return found


class _Scanner:
    """Cuts a page into texts and tags, in time that grows with the page.

    Whatever a search for the end of a tag finds missing, it notes, so that no
    stretch of the page is searched again and again.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.last_end = page.rfind(">")
        self.barren = len(page) + 1  # no quote and no end of a tag from here on
        self.hopeless: set[int] = set()  # quotes after which no tag ends
        self.unended: set[str] = set()  # raw elements that end nowhere in the rest

    def tag_end(self, start: int) -> int:
        """Where the > outside quotes is that ends a tag, or -1."""
        met, at = [], start
        while at < self.barren:
            stop = _STOP.search(self.page, at)
            if stop is None:
                self.barren = min(self.barren, at)
                break
            found = stop.start()
            if self.page[found] == ">":
                return found
            if found in self.hopeless:
                break
            met.append(found)
            at = self.page.find(self.page[found], found + 1) + 1
            if not at:
                break
        self.hopeless.update(met)
        return -1

    def raw_end(self, name: str, start: int) -> int:
        """Where the text after a raw element goes on."""
        if name not in self.unended:
            found = _RAW_END[name].search(self.page, start)
            if found:
                return found.end()
            self.unended.add(name)
        return len(self.page) if name in CODE else start

    def __iter__(self) -> Iterator[tuple[str, str, str]]:
        """(what, name, text or attributes), what being text, open or close."""
        page, at = self.page, 0
        while at < len(page):
            start = page.find("<", at)
            if start < 0:
                yield "text", "", page[at:]
                return
            if start > at:
                yield "text", "", page[at:start]
            mark = _MARKUP.match(page, start)
            if mark and mark["comment"]:
                end = page.find("-->", mark.end())
                at = len(page) if end < 0 else end + 3
                continue
            if not mark or start > self.last_end:
                yield "text", "", "<"
                at = start + 1
                continue
            end = page.find(">", mark.end()) if mark["declared"] else self.tag_end(mark.end())
            if end < 0 or mark["declared"]:
                # A declaration, or a tag whose quotes do not match: passed over up to its first end.
                at = (page.find(">", mark.end()) if end < 0 else end) + 1
                continue
            name, rest = mark["name"].lower(), page[mark.end() : end]
            at = end + 1
            if mark["close"]:
                yield "close", name, rest
            elif name in RAW:
                if not _SELF_CLOSED.search(rest[-2:]):
                    at = self.raw_end(name, at)
            else:
                yield "open", name, rest


class _Part:
    """Lines of the page, or of an element that is left out for its name or class, with the parts inside."""

    def __init__(self, does: str = "", above: _Part | None = None) -> None:
        self.does, self.above = does, above
        self.items: list[_Part | tuple[str, int, bool]] = []
        self.weight = 0  # of all lines; once the page is read, those of parts inside as well
        self.articles = self.heads = 0  # <article>; <main> and <h1>; likewise

    def stays(self, page: _Part) -> str:
        """Whether the lines stay in the page: yes, lowered or no.

        A part stays if it holds a <main> or <h1>, or most of the text of a
        page that has no such mark elsewhere.  One that holds an <article>
        while the page has marks elsewhere weighs half and has to surge on its
        own.
        """
        marked = page.articles + page.heads > self.articles + self.heads
        if self.heads or (self.articles and not marked):
            return "yes"
        if self.articles and self.does == "part":
            return "lowered"
        most = not marked and 2 * self.weight > page.weight
        return "yes" if most and (self.does == "part" or page.weight - self.weight < SURGE) else "no"


class _Lines:
    """Lines of a page with their weight."""

    def __init__(self) -> None:
        self.page = self.part = _Part()
        self.parts: list[_Part] = []
        self.open: list[str] = []
        self.linked = 0

    def end(self, inside: bool) -> None:
        if self.open:
            text = " ".join(html.unescape("".join(self.open)).split())
            if text:
                own = max(0, len(text) - self.linked)
                self.part.items.append((text, len(text) if inside else own, inside))
                self.part.weight += own
            self.open, self.linked = [], 0

    def gap(self, inside: bool) -> None:
        self.end(inside)
        self.part.items.append(("", 0, inside))

    def enter(self, does: str, inside: bool) -> None:
        self.end(inside)
        part = _Part(does, self.part)
        self.part.items.append(part)
        self.parts.append(part)
        self.part = part

    def leave(self, inside: bool) -> None:
        self.end(inside)
        self.part = self.part.above

    def finished(self) -> Iterator[tuple[str, int, bool]]:
        """(text, weight, whether lowered), with one empty line for a part that stays left out."""
        for part in reversed(self.parts):  # a part comes after the one that it is in
            part.above.weight += part.weight
            part.above.articles += part.articles
            part.above.heads += part.heads
        # Open parts: what is left of their lines, whether lowered, and whether a gap follows.
        walk = [(iter(self.page.items), False, False)]
        while walk:
            items, lower, parted = walk[-1]
            item = next(items, None)
            if item is None:
                walk.pop()
                if parted:
                    yield from GAP
            elif isinstance(item, _Part):
                stays = item.stays(self.page)
                if stays == "no":
                    yield "", 0, lower
                else:
                    if stays == "lowered":
                        yield from GAP
                    walk.append((iter(item.items), lower or stays == "lowered", stays == "lowered"))
            else:
                text, weight, inside = item
                yield text, weight // 2 if lower else weight * ARTICLE_WEIGHT if inside else weight, lower


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, weight, whether lowered) per block; parts left out are empty lines."""
    out = _Lines()
    stack: list[tuple[str, str]] = []  # name, and what the element does: "", article, link, title, out, part or comments
    names: Counter[str] = Counter()  # of the open elements
    articles = links = titles = outs = 0

    def close(name: str) -> None:
        nonlocal articles, links, titles, outs
        closed = ""
        while closed != name:
            closed, does = stack.pop()
            names[closed] -= 1
            if does in ("part", "comments"):
                out.leave(articles > 0)
            articles -= does == "article"
            links -= does == "link"
            titles -= does == "title"
            outs -= does == "out"

    for what, name, rest in _Scanner(page):
        if what == "text":
            if not outs:
                out.open.append(rest)
                if links and not titles:
                    out.linked += len(rest.strip())
            continue
        inside = articles > 0
        if name in BLOCKS:
            out.end(inside)
        elif name == "br" or name == "wbr":
            out.open.append(" " if name == "br" else "")
        if what == "close":
            if names[name]:
                close(name)
            continue
        if name in VOID or rest.endswith("/"):
            continue
        does = ""
        if not outs:
            does = _left_out(name, rest, inside)
            if does == "out":
                out.gap(inside)
            elif does:
                out.enter(does, inside)
            elif name in ("article", "main"):
                does = "article"
                if name == "main":
                    out.part.heads += 1
                else:
                    out.part.articles += 1
            elif name == "h1":
                does = "title"
                out.part.heads += 1
            elif name == "a":
                does = "link"
        if name == "p" or name == "li":
            # These close themselves before another of their kind.
            if stack and stack[-1][0] == name and stack[-1][1] == "":
                stack.pop()
                names[name] -= 1
        stack.append((name, does))
        names[name] += 1
        articles += does == "article"
        links += does == "link"
        titles += does == "title"
        outs += does == "out"
    out.end(articles > 0)
    return list(out.finished())


def stretches(weights: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """[start, end) of the stretches of lines in which no window is empty, and their highest sum."""
    n = len(weights)
    sums, total = [0] * n, 0
    for i in range(n - 1, -1, -1):
        total += weights[i] - (weights[i + window] if i + window < n else 0)
        sums[i] = total
    found = []
    i = 0
    while i < n:
        if not weights[i]:
            i += 1
            continue
        j, peak = i, 0
        while j < n and sums[j]:
            peak = max(peak, sums[j])
            j += 1
        found.append((i, j, peak))
        i = j
    return found


def text_runs(weights: list[int], surge: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """[start, end) of the stretches that reach the surge, or else of the highest one."""
    found = stretches(weights, window)
    runs = [(i, j) for i, j, peak in found if peak >= surge]
    if not runs and found:
        runs.append(max(found, key=lambda run: (run[2], -run[0]))[:2])
    return runs


def main_text(page: str | None) -> str:
    """The article's lines, joined by one line feed."""
    lines = page_lines(page or "")
    found = stretches([weight for _, weight, _ in lines])
    surged = {(i, j) for i, j in text_runs([weight for _, weight, _ in lines], SURGE)}
    whether = [False, *((i, j) in surged for i, j, _ in found), False]
    # First and last + 1 of the lines that adjoin each other around a line.
    firsts, lasts = list(range(len(lines))), list(range(1, len(lines) + 1))
    for k in range(1, len(lines)):
        if lines[k][0] and lines[k - 1][0]:
            firsts[k] = firsts[k - 1]
    for k in range(len(lines) - 2, -1, -1):
        if lines[k][0] and lines[k + 1][0]:
            lasts[k] = lasts[k + 1]
    steps = [0] * (len(lines) + 1)
    for k, (a, b, _) in enumerate(found):
        if not whether[k + 1]:
            # A short run beside a surged one stays, but at the ends no single word.
            said = " ".join(text for text, _, lower in lines[a:b] if not lower).split()
            beside = whether[k] + whether[k + 2]
            if not beside or len(said) < 3 - beside:
                continue
        # What adjoins it, such as lines of links, stays up to the next part left out.
        steps[firsts[a]] += 1
        steps[max(b, lasts[b - 1])] -= 1
    return "\n".join(text for (text, _, _), keep in zip(lines, accumulate(steps)) if keep and text)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ship(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
