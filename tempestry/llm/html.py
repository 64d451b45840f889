"""Main text of web pages: a minimum cut labels blocks as content or boilerplate."""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from math import log

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tempestry.llm.common import parts_of, values

#: Elements whose text is never shown, whose text is no prose, that have no end tag, and that do not break a block (fixed values).
RAW = frozenset("script style textarea title noscript template iframe svg math xmp".split())
HIDDEN = RAW | frozenset("head select option button object audio video canvas datalist".split())
FOREIGN = frozenset(["svg", "math"])  # may end themselves, as in <svg/>
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var br wbr img".split()
)
#: Elements and words of class, id and role that speak for boilerplate or for content (fixed values).
BOILERPLATE = frozenset("nav footer aside header form menu dialog fieldset".split())
CONTENT = frozenset("article main".split())
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe signup login nav navbar navigation navi menu menus "
    "breadcrumb breadcrumbs sidebar sidebars aside footer header masthead topbar toolbar comment comments reply replies "
    "discussion disqus share sharing social related recommended recommendations widget copyright legal disclaimer "
    "pagination pager skip search form tags contentinfo complementary respond".split()
)
GOOD_WORDS = frozenset("article articlebody content main post story entry body text maincontent postcontent".split())
#: Elements that a new block element of the same group closes (fixed values).
ENDS = {
    "p": frozenset(["p"]),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
#: Elements that an unclosed inner element does not reach beyond.
SCOPES = frozenset("table ul ol dl div section article main aside nav footer header form body html td th".split())

#: Elements with a mark of their own, and characters that end a sentence (fixed values).
TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li td th div span blockquote pre dd dt figcaption".split())
SENTENCE_ENDS = tuple(".!?…\"'”»")
#: Elements inside each other that are told apart; deeper ones count as part of the last of these.
MOST_DEPTH = 200
#: Most log-odds of one mark.
MOST_ODDS = 2.0
#: Evidence of an element by its tag, by a whole word of class, id or role, and by a part of such a word; most for
#: boilerplate in all. Log-odds of a unit of evidence for content and for boilerplate.
BY_TAG, BY_WORD, BY_PART, MOST_BAD = 3.0, 2.0, 1.0, 3.0
GOOD_ODDS, BAD_ODDS = 1.6, 2.6
#: Log-odds of a block's place from which it labels the block for training: content, and boilerplate, which a part alone is not.
SURE_CONTENT, SURE_BOILERPLATE = 2.0, -5.0

#: A comment or declaration, or the beginning of a tag up to the end of its name.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)", re.DOTALL)
_STOP = re.compile(r"[>=]")
_VALUE = re.compile(r"\s*([\"'])")
_ATTRIBUTE = re.compile(r"""([^\s=/]+)(?:\s*=\s*("[^"]*"|'[^']*'|\S*))?""")
#: Attributes that are evidence (fixed values).
TELLING = frozenset("class id role hidden style aria-hidden itemprop".split())
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Block:
    """Text of one block element, with what its place in the page says."""

    path: tuple[int, ...]
    tag: str
    bad: float
    good: float
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


@dataclass
class _Element:
    tag: str
    number: int
    tags: float
    words: float
    good: float
    hidden: bool
    linked: bool


@dataclass
class _Evidence:
    """What an element says by its tag and by its words, and whether it is hidden."""

    tag: float
    bad: float
    good: float
    hidden: bool


def _evidence(tag: str, attributes: str) -> _Evidence:
    """The evidence of one element; of the tag, it is below zero for boilerplate.

    A word such as ``sidebar`` that is a whole class says more than the same
    word as a part of one (``has-sidebar``). Parts for both, as in
    ``content-sidebar-wrap``, count for both unless the last one names boilerplate.
    """
    out = _Evidence(BY_TAG * ((tag in CONTENT) - (tag in BOILERPLATE)), 0.0, 0.0, tag in HIDDEN)
    if tag == "form":
        # Some sites wrap a whole page in a form; it says as much as a word.
        out.tag, out.bad = 0.0, BY_WORD
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name not in TELLING:
                continue
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _UNSEEN.search(value):
                out.hidden = True
            elif name in ("class", "id", "role", "itemprop") and tag not in ("body", "html"):
                for word in value.split():
                    parts = [w.lower() for w in _WORDS.findall(word)]
                    whole = word.lower() in BAD_WORDS or len(parts) == 1 and parts[0] in BAD_WORDS
                    if whole or not BAD_WORDS.isdisjoint(parts):
                        out.bad = max(out.bad, BY_WORD if whole else BY_PART)
                    if not (whole or parts and parts[-1] in BAD_WORDS) and not GOOD_WORDS.isdisjoint([*parts, word.lower()]):
                        out.good = 1.5
    return out


def _inside(top: _Element, tag: str, own: _Evidence) -> tuple[float, float, float]:
    """Evidence of an element's place: boilerplate by tags, boilerplate by words, content.

    What is nearer outweighs what is farther: an article or main part halves
    the words around it and its own, a tag or whole word for boilerplate ends the content
    evidence around it, and a part of a word halves that. Boilerplate by tag
    stays, as an article in an aside is still aside.
    """
    tags, words, good = top.tags, top.words, top.good
    # A header inside an article heads that article, and not the site.
    if tag == "header" and good >= BY_TAG and tags == 0:
        return tags, words, good
    if own.tag > 0 and own.bad < BY_WORD:
        return tags, (words + own.bad) / 2, own.tag
    if own.tag < 0 or own.bad >= BY_WORD:
        good = 0.0
    elif own.bad:
        good /= 2
    return max(tags, -own.tag), max(words, own.bad), max(good, own.good)


def _tag_end(page: str, at: int) -> int:
    """The place of the ``>`` that ends a tag whose name ends at ``at``; -1 if the page ends before.

    Quotes open only behind ``=``. One that is never closed is a character as any other.
    """
    while found := _STOP.search(page, at):
        if found[0] == ">":
            return found.start()
        at = found.end()
        if quote := _VALUE.match(page, at):
            close = page.find(quote[1], quote.end())
            at = quote.end() if close < 0 else close + 1
    return -1


def blocks(page: str) -> list[Block]:
    """The shown text blocks of a page, in order, in time that grows with its length. Markup may be unclosed or cut off.

    Where the page ends inside a tag, this tag and all later ones end at the next ``>`` whatever quotes are open.
    """
    quoted, deeper = True, Counter()
    root = _Element("html", 0, 0.0, 0.0, 0.0, False, False)
    stack, out, block, count, at = [root], [], None, 0, 0

    def say(text: str) -> None:
        nonlocal block
        top = stack[-1]
        if top.hidden or not text:
            return
        text = unescape(text)
        if block is None:
            if not text.strip():
                return
            holder = next(e for e in reversed(stack) if e.tag not in INLINE)
            bad = min(MOST_BAD, top.tags + top.words)
            block = Block(tuple(e.number for e in stack if e.tag not in INLINE), holder.tag, bad, top.good)
            out.append(block)
        block.parts.append(text)
        if top.linked:
            block.linked += len(text.strip())

    while at < len(page):
        found = _TOKEN.search(page, at)
        end = -1
        if found and found[2]:
            end = _tag_end(page, found.end()) if quoted else -1
            if end < 0:
                quoted, end = False, page.find(">", found.end())
        if not found or found[2] and end < 0:
            rest = page[at:]
            # A tag cut off at the end of the page is no text.
            cut = re.search(r"</?[A-Za-z!][^<>]*$", rest)
            say(rest[: cut.start()] if cut else rest)
            break
        say(page[at : found.start()])
        if not found[2]:
            at = found.end()
            continue
        at = end + 1
        closing, tag, attributes = found[1], found[2].lower(), page[found.end() : end]
        if tag not in INLINE:
            block = None
        elif tag == "br" and block is not None:
            block.parts.append(" ")
        if closing:
            if deeper[tag]:
                deeper[tag] -= 1
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    deeper.clear()
                    break
                if tag in INLINE and stack[depth].tag not in INLINE or tag not in SCOPES and stack[depth].tag in SCOPES:
                    break
            continue
        ends = ENDS.get(tag) or (ENDS["p"] if tag not in INLINE else None)
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ends:
                    del stack[depth:]
                    break
                if stack[depth].tag in SCOPES:
                    break
        if tag in VOID or attributes.endswith("/") and (tag not in RAW or tag in FOREIGN):
            continue
        own = _evidence(tag, attributes)
        if tag in RAW:
            over = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = over.end() if over else len(page)
            continue
        if len(stack) > MOST_DEPTH:
            deeper[tag] += 1
            continue
        top = stack[-1]
        count += 1
        place = _inside(top, tag, own)
        stack.append(_Element(tag, count, *place, top.hidden or own.hidden, top.linked or tag == "a"))
    return [b for b in out if b.text()]


def marks(block: Block) -> tuple[str, ...]:
    """What a block's text and element say of it, whatever it lies in."""
    text = block.text()
    links = min(4, 4 * block.linked // max(1, len(text)))
    return (
        f"length:{min(9, int(log(1 + len(text) / 10) * 1.5))}",
        f"links:{links}",
        f"ends:{text[-1:] in SENTENCE_ENDS}",
        f"tag:{block.tag if block.tag in TAGS else 'other'}",
        f"sign:{'©' in text}",
    )


def place_odds(block: Block) -> float:
    """Log-odds of content by what a block lies in."""
    return GOOD_ODDS * block.good - BAD_ODDS * block.bad


def weak_label(block: Block) -> int | None:
    """1 for a block that lies in an article or the main part, 0 in what is surely boilerplate, else unknown."""
    odds = place_odds(block)
    return 1 if odds >= SURE_CONTENT else 0 if odds <= SURE_BOILERPLATE else None


def counted_marks(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``mark, content, boilerplate``: in how many weakly labelled blocks of all pages each mark is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            counts: Counter = Counter()
            for page in values(batch.column(0)):
                for block in blocks(page or ""):
                    if (label := weak_label(block)) is not None:
                        counts.update((mark, label) for mark in marks(block))
            names = sorted({mark for mark, _ in counts})
            columns = [pa.array(names, pa.string())] + [pa.array([counts[n, k] for n in names], pa.int64()) for k in (1, 0)]
            yield pa.RecordBatch.from_arrays(columns, ["mark", "content", "boilerplate"])

    found = pages.select(F.col(html_col).alias("html")).mapInArrow(run, "mark string, content long, boilerplate long")
    return found.groupBy("mark").agg(F.sum("content").alias("content"), F.sum("boilerplate").alias("boilerplate"))


def train(pages: DataFrame, html_col: str = "html") -> dict[str, float] | None:
    """Log-odds of each mark, from blocks whose place in the page labels them, of all pages.

    What is collected is a row per mark, some thirty. None if there is no labelled block of one of the two kinds.
    """
    rows = counted_marks(pages, html_col).collect()
    total = [sum(r[k] for r in rows if r.mark.startswith("ends:")) for k in ("content", "boilerplate")]
    if not all(total):
        return None
    ratio = lambda r: log((r.content + 1) / (total[0] + 2)) - log((r.boilerplate + 1) / (total[1] + 2))
    return {r.mark: max(-MOST_ODDS, min(MOST_ODDS, ratio(r))) for r in rows}


def costs(block: Block, odds: dict[str, float] | None = None) -> tuple[float, float]:
    """Costs of calling the block boilerplate and content.

    The log-odds of its marks, trained (``train``) or else a rough guess from
    length, links and sentence ends, and those of what it lies in, are added.
    Neither has the last word: marks, place or neighbours may each turn a block.
    """
    if odds is None:
        length = len(block.text())
        score = 0.6 * log(1 + length / 40) - 0.4 - 4.0 * min(1.0, block.linked / max(1, length))
        score += 0.8 * (block.text()[-1:] in SENTENCE_ENDS) - 2.0 * ("©" in block.text() and length < 300)
    else:
        score = sum(odds.get(mark, 0.0) for mark in marks(block))
    score += place_odds(block)
    return max(score, 0.0), max(-score, 0.0)


def proximity(a: Block, b: Block) -> float:
    """Weight of the edge between two blocks: 1 for one parent, less for a common ancestor farther up."""
    same = 0
    for x, y in zip(a.path, b.path):
        if x != y:
            break
        same += 1
    apart = len(a.path) + len(b.path) - 2 * same
    return 1.0 / (1 + max(0, apart - 2))


def edges(found: list[Block], adjacency: float = 0.35, family: float = 0.6) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in page order, and each block with the next one of its parent."""
    out, last = [], {}
    for i, block in enumerate(found):
        if i:
            out.append((i - 1, i, adjacency * proximity(found[i - 1], block)))
        parent = block.path[:-1]
        if parent in last:
            out.append((last[parent], i, family))
        last[parent] = i
    return out


def minimum_cut(terminal: list[tuple[float, float]], links: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side of a minimum cut.

    ``terminal`` has, for each node, its capacity from the source and to the
    sink; ``links`` join two nodes both ways. Maximum flow by shortest
    augmenting levels (Dinic), with an explicit stack.
    """
    n = len(terminal)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, there: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(there)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, (keep, drop) in enumerate(terminal):
        # What passes straight through a node needs no search.
        through = min(keep, drop)
        if keep > through:
            join(source, i, keep - through, 0.0)
        elif drop > through:
            join(i, sink, drop - through, 0.0)
    for a, b, weight in links:
        join(a, b, weight, weight)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        place = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while place[a] < len(heads[a]):
                e = heads[a][place[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                place[a] += 1
            if place[a] < len(heads[a]):
                path.append(heads[a][place[a]])
                a = to[path[-1]]
            elif path:
                level[a] = -1
                a = to[path.pop() ^ 1]
            else:
                break


def main_text(page: str | None, odds: dict[str, float] | None = None) -> str:
    """The content blocks of a page in order, one to a line."""
    found = blocks(page or "")
    keep = minimum_cut([costs(b, odds) for b in found], edges(found))
    return "\n".join(b.text() for b, kept in zip(found, keep) if kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, with a classifier trained on the same pages.

    The blocks of a page are labelled together: a classifier's costs are the
    capacities to the source (content) and the sink (boilerplate), and edges
    between neighbours and blocks of one parent make it dear to label them
    apart. The minimum cut is the cheapest labelling.

    Character references are decoded, white space in a block becomes one
    blank, and blocks are joined by line feeds. Null, empty and textless pages
    give an empty text. Rows stay as many as they are, repeated ones give
    equal texts; an empty table gives no rows; further columns are ignored.
    """
    odds = train(pages, html_col)

    def main_texts(batch: pd.Series) -> pd.Series:
        return batch.map(lambda page: main_text(page, odds))

    text = pandas_udf(main_texts, "string")(F.coalesce(F.col(html_col), F.lit("")))
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
