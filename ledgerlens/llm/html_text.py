"""The main text of a web page: the contiguous region of greatest score, where words count for it and tags against it.

A page is read as a sequence of tags and of the words between them. A word's weight depends on the block it stands in, a
tag's on its name. Weights are log odds of standing inside rather than outside the content, learned from labelled pages:
pages that mark their article themselves, a bounded sample of them. One linear scan finds the region. Elements that
are never content (scripts, styles, menus, forms, adverts, notices, reader comments and the like, by name, role or
class) are left out of it, and so is a page's header, footer or sidebar.

Text is what the region's blocks hold: references decoded, white space made one space, blocks joined by one space in page
order. A null or empty page, or one without words, gives an empty text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.labelled import sample

#: Elements by their part in a page.
RAW = "script style noscript template svg math iframe object textarea select title".split()
NEVER = frozenset("nav footer aside form button dialog menu header audio video canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CONTENT = frozenset("article main".split())
#: Elements whose end tag may be left out: what, when it opens, closes them, and what keeps that from reaching further out.
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre search section table ul".split()
)
CLOSED_BY = (
    {"p": BLOCKS | frozenset("li dt dd td th tr thead tbody tfoot caption".split()), "li": frozenset(["li"])}
    | {x: frozenset("dt dd".split()) for x in ("dt", "dd")}
    | {x: frozenset("option optgroup".split()) for x in ("option", "optgroup")}
    | {x: frozenset("td th tr thead tbody tfoot".split()) for x in ("td", "th")}
    | {"tr": frozenset("tr thead tbody tfoot".split())}
    | {x: frozenset("thead tbody tfoot".split()) for x in ("thead", "tbody", "tfoot", "caption", "colgroup")}
)
CLOSES = {by: [top for top, closers in CLOSED_BY.items() if by in closers] for by in frozenset().union(*CLOSED_BY.values())}
SCOPE = {"p": frozenset("table td th caption button object".split()), "li": frozenset("ul ol menu dir table".split()), "dt": frozenset(["dl", "table"]), "dd": frozenset(["dl", "table"])}
#: A head ends with its first element that is none of these.
HEAD = frozenset("base link meta title style script noscript template".split())
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer"
    " form login masthead menu menubar nav navbar navigation newsletter notice notification pagination popup promo promoted reaction"
    " reactions recommended related replies reply respond search share sharing sidebar sidenav signup skip social sponsor sponsored"
    " subscribe toolbar topbar widget".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())

DEPTH = 512  # open elements that are kept track of, as in browsers; what opens further in belongs to these
NAME = re.compile(r"[a-z][a-z0-9:-]*", re.I)
UNTIL = re.compile(r"[\"'>]")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
LABEL = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
PART = re.compile(r"[A-Za-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def boilerplate(name: str, rest: str) -> bool:
    """Whether an element is left out by its name, role, class or id."""
    if name in NEVER:
        return True
    for kind, value in LABEL.findall(rest):
        value = value.strip("\"'")
        if kind.lower() == "role":
            if value.lower() in ROLES:
                return True
        elif name not in ("body", "html", "article", "main"):
            for word in value.split():
                parts = [p.lower() for p in PART.findall(CAMEL.sub(" ", word))]
                # "post-with-sidebar" is a layout, "sidebar-left" a sidebar
                if parts and (parts[0] in BOILERPLATE or parts[-1] in BOILERPLATE and "with" not in parts and "has" not in parts):
                    return True
    return False


class Tags:
    """The tags of a page, each found by one look ahead; no part of a page is looked at more than a few times, however
    broken it is."""

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self.dead: set[int] = set()  # quotes that open where no tag ends after them

    def end(self, at: int) -> int:
        """The place of the ``>`` that ends the tag whose name or attributes go on at ``at``, or -1.

        A quoted value may hold ``>``. A quote that is never closed is an ordinary character, and if quotes would
        hide every ``>`` to the end of the page, the first one ends the tag.
        """
        page, seen, i = self.page, [], at
        while True:
            m = UNTIL.search(page, i) if i <= max(self.last.values()) else None
            if m is None or m.start() in self.dead:
                self.dead.update(seen)
                return page.find(">", at) if self.last[">"] >= at else -1
            if m.group() == ">":
                return m.start()
            seen.append(m.start())
            closed = page.find(m.group(), m.end()) if self.last[m.group()] >= m.end() else -1
            i = m.end() if closed < 0 else closed + 1

    def __iter__(self) -> Iterator[tuple[int, int, str, bool, str, bool]]:
        """(start, end, name, closing, attributes, raw) in order; comments and declarations have no name. The end of an element
        whose content is no markup is that of its content."""
        page, at = self.page, 0
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            if page.startswith("!--", at):
                stop = page.find("-->", at)
                at = len(page) if stop < 0 else stop + 3
                yield start, at, "", False, "", False
                continue
            closing = page.startswith("/", at)
            m = NAME.match(page, at + closing)
            if m is None:
                if page[at : at + 1] in ("!", "?", "/") and self.last[">"] > at:
                    at = page.find(">", at) + 1
                    yield start, at, "", False, "", False
                continue
            stop = self.end(m.end())
            if stop < 0:
                continue
            name, rest = m.group().lower(), page[m.end() : stop]
            at = stop + 1
            raw = name in RAW_END and not closing
            if raw and not rest.endswith("/"):
                over = RAW_END[name].search(page, at)
                at = over.end() if over else len(page)
            yield start, at, name, closing, rest, raw


def tokens(page: str) -> Iterator[tuple[str, str, str, bool, bool]]:
    """(kind, block, text, left out, inside content): kind is ``text`` or ``tag``; block is the block the text stands in, or
    the tag's name with ``/`` for a closing one."""
    stack: list[str] = []  # open elements
    open_: Counter = Counter()  # how many of each name

    def pop(name: str) -> None:
        """Closes up to the nearest element of that name."""
        nonlocal skipped, content
        while stack:
            top = stack.pop()
            skipped -= top.endswith("!")
            content -= top.rstrip("!") in CONTENT
            open_[top.rstrip("!")] -= 1
            if top.rstrip("!") == name:
                break

    def ended(by: str) -> None:
        """Closes what the start of an element closes without an end tag."""
        if "head!" in stack and by not in HEAD:
            pop("head")
        again = any(open_[top] for top in CLOSES.get(by, ()))
        while again:
            again = False
            for top in reversed(stack):
                top = top.rstrip("!")
                if by in CLOSED_BY.get(top, ()):
                    pop(top)
                    again = True
                    break
                # an element of its own kind of parent, or a block other than div and address, keeps the outer ones open
                if by in SCOPE and top in SCOPE[by] or by not in SCOPE and top == "table":
                    break
    block, skipped, content, at = "", 0, 0, 0
    for start, end, name, closing, rest, raw in Tags(page):
        if start > at:
            yield "text", block, page[at:start], skipped > 0, content > 0
        at = end
        if raw:
            yield "tag", name, "", True, content > 0
        elif not name:
            continue
        elif not closing:
            ended(name)
            yield "tag", name, "", skipped > 0, content > 0
            if name not in INLINE:
                block = name
            out = name == "head" or boilerplate(name, rest)
            if name not in VOID and not rest.endswith("/") and len(stack) < DEPTH:
                stack.append(name + "!" * out)
                open_[name] += 1
                skipped += out
                content += name in CONTENT
        else:
            if name in stack or name + "!" in stack:
                pop(name)
            yield "tag", "/" + name, "", skipped > 0, content > 0
            if name not in INLINE:
                block = "/" + name
    if at < len(page):
        yield "text", block, page[at:], skipped > 0, content > 0


#: What is assumed before any page was seen, as if from so many words or tags.
PRIOR = 5.0
DEFAULT = {"p": 1.0, "h1": 0.5, "h2": 0.5, "h3": 0.5, "blockquote": 1.0, "pre": 0.5, "br": 0.7, "li": 0.3, "footer": -2.0, "nav": -2.0, "header": -1.0, "aside": -2.0, "form": -2.0}


class Weights:
    """Log odds of standing inside the content, per block of words and per tag."""

    def __init__(self, words: dict[str, tuple[int, int]], tags: dict[str, tuple[int, int]]):
        def odds(inside: float, outside: float, default: float) -> float:
            seen = inside + outside
            return (math.log((inside + 1) / (outside + 1)) * seen + default * PRIOR) / (seen + PRIOR)

        self.words = {k: min(2.0, max(-2.0, odds(*n, DEFAULT.get(k, 0.3)))) for k, n in words.items()}
        self.tags = {k: -min(4.0, max(0.2, -odds(*n, -0.5))) for k, n in tags.items()}

    def word(self, block: str) -> float:
        return self.words.get(block, DEFAULT.get(block, 0.3))

    def tag(self, name: str) -> float:
        return self.tags.get(name, -0.5)


def learn(page: str) -> tuple[Counter, Counter]:
    """Words per (block, inside) and tags per (name, inside) of one labelled page, without what is never content."""
    words, tags = Counter(), Counter()
    for kind, block, text, out, inside in tokens(page):
        if out:
            continue
        if kind == "text":
            n = len(text.split())
            if n:
                words[block, inside] += n
        else:
            tags[block, inside] += 1
    return words, tags


def extract(page: str, weights: Weights) -> str:
    """The main text of a page."""
    parts = list(tokens(page))
    best = total = 0.0
    first = last = start = 0
    for i, (kind, block, text, out, _) in enumerate(parts):
        if kind == "text":
            n = len(text.split())
            # what is left out anyway neither ends a region nor makes one
            total += 0.0 if out and total > 0 else -2.0 * n if out else n * weights.word(block)
        elif not out:
            total += weights.tag(block)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, first, last = total, start, i + 1
    if last <= first:
        return ""
    # a region ends with its block: the rest of the last one may hang on inline tags
    while last < len(parts) and parts[last][0] == "text" and not parts[last][3] and parts[last][1] == parts[last - 1][1]:
        last += 1
    out = []
    for kind, block, text, skip, _ in parts[first:last]:
        if skip:
            out.append(" ")
        elif kind == "text":
            out.append(text)
        elif block.lstrip("/") not in INLINE:
            out.append("\n")
    return " ".join(html.unescape("".join(out)).split())


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most_pages: int = 2_000) -> Weights:
    """Weights from at most ``most_pages`` pages that mark their article, those whose ids hash least."""
    marked = pages.filter(F.lower(F.col(html_col)).rlike(r"<(article|main)\b")).select(F.col(id_col).alias("__id"))
    chosen = F.broadcast(sample(marked.distinct(), "__id", most_pages))  # at most most_pages ids
    rows = pages.join(chosen, F.col(id_col) == F.col("__id")).select(F.col(html_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for batch in batches:
            for page in batch.column(0).to_pylist():
                for all_, one in zip(found, learn(page)):
                    all_.update(one)
        flat = [(is_tag, k, inside, n) for is_tag, c in enumerate(found) for (k, inside), n in c.items()]
        if flat:
            yield pa.RecordBatch.from_pydict(dict(zip(("is_tag", "k", "inside", "n"), map(list, zip(*flat)))), pa.schema([("is_tag", pa.int32()), ("k", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]))

    counted = rows.mapInArrow(run, "is_tag int, k string, inside boolean, n long").groupBy("is_tag", "k")
    counted = counted.agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("n"))
    # names are free text: only frequent ones get a weight of their own
    tables: tuple[dict, dict] = ({}, {})
    for r in counted.orderBy(F.desc("n"), "is_tag", "k").limit(2_000).collect():
        tables[r["is_tag"]][r["k"]] = (r["inside"], r["n"] - r["inside"])
    return Weights(*tables)


def main_text(pages: DataFrame, weights: Weights, html_col: str = "html") -> DataFrame:
    """Every row with ``text``, its main text, in place of the page."""
    others = [c for c in pages.columns if c not in (html_col, "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p.as_py() or "", weights) for p in batch.column(batch.num_columns - 1)]
            keep = {n: batch.column(i) for i, n in enumerate(batch.schema.names[:-1])}
            yield pa.RecordBatch.from_pydict(keep | {"text": pa.array(texts, pa.string())})

    rows = pages.select(*others, F.col(html_col).cast("string").alias("__html"))
    return rows.mapInArrow(run, rows.drop("__html").withColumn("text", F.lit("")).schema)
