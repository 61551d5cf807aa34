"""Main text of web pages by tag-path ratios.

Every run of text has a path of tags from the root. Per path, the length of its text and its
punctuation are added up and divided by how often the path occurs; both ratios are smoothed along
the page, where neighbours with the same parent weigh more, and fused into one score. Text whose
score is a fair part of the page's typical score is content, on every page. What the page says of
its articles adds to the score: their text gains a part of the typical score, less the more of its
path is links; articles that are far smaller than the largest keep a small part of theirs.
Elements that by their meaning are not the article (menus, footers, adverts, forms, reader
comments, ...) never count, however long. An element that holds the page's article, or most of a
page that marks none, is no such element, whatever its name.

Defined results
* null counts as the empty page: no text, 0 characters;
* character references are decoded, white space within a block becomes one space, blocks are
  joined in page order by one line break;
* a tag, comment or script cut off at the end of the page is dropped, unclosed elements end there;
* pages without any content path give empty text; repeated rows each get the same result;
* url may be null; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import html
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import median

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.textops import prepare, tidy

# Element names by what they are.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template", "svg"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub",
    "sup", "time", "tt", "u", "var", "td", "th", "ruby", "rt", "rp",
}
NEVER_TEXT = {
    "button", "select", "head", "dialog", "object", "video", "audio", "canvas", "option",
}
NOT_CONTENT = {"nav", "footer", "aside", "form", "menu", "fieldset"}
ARTICLE = {"article", "main"}
HINTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "promo", "sponsor",
    "sponsored", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal",
    "newsletter", "subscribe", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs",
    "sidebar", "aside", "footer", "masthead", "comment", "comments", "respond", "reply", "replies",
    "disqus", "share", "sharing", "social", "related", "recommended", "widget", "widgets",
    "toolbar", "pagination", "pager", "login", "signup", "search", "skip",
}
HINTS_OUTSIDE = {"header", "topbar", "top"}
# Words that with a hint still name the whole element, as in comment-list or site-footer.
PLACES = {
    "site", "main", "area", "list", "box", "block", "bar", "links", "buttons", "posts",
    "primary", "secondary", "left", "right", "bottom", "global",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog",
    "menu", "menubar", "alertdialog",
}
# An opening tag of the key ends an open element of the values.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
HOLDERS = {"ul", "ol", "dl", "table", "select", "body", "html", "article", "main", "div", "section"}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^>]*+\Z",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
STOPS = re.compile(r"[.,;:!?。，；：！？…]")

# A menu within an article: so many blocks in a row that are links as a whole, with texts of fewer
# characters in the middle and without an end of a sentence.
MENU_BLOCKS, MENU_CHARS = 3, 30

# Neighbours that smoothing reaches, and their weights by distance.
REACH = 2
WEIGHTS = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / 1.0) ** 2)
# Content from this part of the page's typical score.
FAIR_PART = 0.2
# Text of articles gains this part of the typical score, and this much at least.
ARTICLE_PART, ARTICLE_LEAST = 0.8, 30.0
# An article with less than this part of the largest one's text is a teaser, whose score counts
# for so much. An element with more than this part of a page's unlinked text holds most of it.
TEASER_PART, TEASER_WEIGHT, MOST = 0.25, 0.1, 2 / 3


@dataclass
class Run:
    """A run of text: its block, path, the path's parent and that of its block, whether linked,
    the article it is in, and the elements around it that by their names are not the article."""

    block: int
    path: int
    parent: int
    block_path: int
    text: str
    linked: bool
    article: int
    heading: bool
    listed: int
    # Those of them that hold the whole article.
    outer: int


@dataclass
class _Element:
    name: str
    path: int
    block_path: int
    skipped: bool
    linked: bool
    article: int
    heading: bool
    listed: int
    outer: int


@dataclass
class _Reader:
    """Reads a page into runs of text with paths.

    Paths are numbers, each known by its parent's number and the step from it, and so are chains
    of listed elements: nesting however deep takes memory once per element.
    """

    runs: list[Run] = field(default_factory=list)
    block: int = 0
    articles: int = 0
    # For every chain of listed elements the one around it; 0 is none.
    chains: list[int] = field(default_factory=lambda: [0])
    paths: dict[tuple[int, str], int] = field(default_factory=dict)
    parents: list[int] = field(default_factory=lambda: [0])
    # Open elements by name.
    opened: Counter = field(default_factory=Counter)

    def path(self, parent: int, step: str) -> int:
        found = self.paths.get((parent, step))
        if found is None:
            found = self.paths[parent, step] = len(self.parents)
            self.parents.append(parent)
        return found

    def read(self, page: str) -> list[Run]:
        self.stack = [_Element("", 0, 0, False, False, 0, False, 0, 0)]
        place = 0
        while True:
            found = TAG.search(page, place)
            self.text(page[place : found.start() if found else len(page)])
            if not found:
                return self.runs
            place = found.end()
            name = found["name"] or found["name2"]
            if not name:
                continue
            name = name.lower()
            if found["end"] or found["end2"]:
                self.close(name)
            elif name in RAW:
                if name != "svg" or not (found["rest"] or "").endswith("/"):
                    end = re.compile(f"</{name}[^>]*>", re.IGNORECASE).search(page, place)
                    place = end.end() if end else len(page)
            elif name in VOID:
                if name == "hr":
                    self.block += 1
                else:
                    self.text(" ")
            else:
                self.open(name, found["rest"] or found["rest2"] or "")

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if raw and not top.skipped:
            self.runs.append(Run(
                self.block, top.path, self.parents[top.path], top.block_path, html.unescape(raw),
                top.linked, top.article, top.heading, top.listed, top.outer,
            ))

    def pop_to(self, index: int) -> None:
        gone = self.stack[index:]
        if any(e.name not in INLINE for e in gone):
            self.block += 1
        self.opened.subtract(e.name for e in gone)
        del self.stack[index:]

    def open(self, name: str, rest: str) -> None:
        if name not in INLINE:
            # A block ends an open paragraph.
            for i in range(len(self.stack) - 1, 0, -1) if self.opened["p"] > 0 else ():
                if self.stack[i].name == "p":
                    self.pop_to(i)
                    break
                if self.stack[i].name in HOLDERS or self.stack[i].name in ("li", "td", "th"):
                    break
            self.block += 1
        if name in ENDS and any(self.opened[other] > 0 for other in ENDS[name]):
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].name in ENDS[name]:
                    self.pop_to(i)
                    if name != "tr":
                        break
                elif self.stack[i].name in HOLDERS:
                    break
        if name in ("td", "th"):
            self.text(" ")
        top = self.stack[-1]
        values = {}
        for key, a, b, c, hidden in ATTRIBUTE.findall(rest) if rest else ():
            values.setdefault((key or hidden).lower(), a or b or c or hidden)
        words = {
            w.lower()
            for w in WORD.findall(f"{values.get('class', '')} {values.get('id', '')}")
        }
        article, outer = top.article, top.outer
        if name in ARTICLE and not article:
            self.articles += 1
            article, outer = self.articles, top.listed
        whole = name in ("body", "html", "article", "main")
        skipped = top.skipped or name in NEVER_TEXT or (
            not whole
            and (
                "hidden" in values
                or values.get("aria-hidden", "").lower() == "true"
                or "display:none" in values.get("style", "").replace(" ", "").lower()
            )
        )
        listed = top.listed
        if name in NOT_CONTENT or (
            not whole
            and (
                named(values, HINTS, name in HEADINGS)
                or values.get("role", "").lower() in ROLES
                or (not article and (name == "header" or named(values, HINTS_OUTSIDE, name in HEADINGS)))
            )
        ):
            self.chains.append(listed)
            listed = len(self.chains) - 1
        sign = "." + ".".join(sorted(words)) if words else ""
        heading = top.heading or (len(name) == 2 and name[0] == "h" and name[1] in "123456")
        path = self.path(top.path, f"{name}{sign}")
        self.opened[name] += 1
        self.stack.append(_Element(
            name, path, top.block_path if name in INLINE else path, skipped,
            top.linked or name == "a", article, heading, listed, outer,
        ))

    def close(self, name: str) -> None:
        if self.opened[name] <= 0:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].name == name:
                self.pop_to(i)
                return
            if name in INLINE and self.stack[i].name not in INLINE:
                return


def named(values: dict[str, str], hints: set[str], slug: bool) -> bool:
    """Whether a class or the id is a hint, or a hint with the place of the element.

    Other words within a name say what an element is beside or about (content-sidebar-wrap,
    related-work). The id of a heading is a slug of its text, and an id counts only as a whole.
    """
    for name in values.get("class", "").split():
        words = {word.lower() for word in WORD.findall(name)}
        if name.lower() in hints or (words & hints and words <= hints | PLACES):
            return True
    return not slug and values.get("id", "").lower() in hints


def scores(runs: list[Run]) -> np.ndarray:
    """The smoothed and fused path ratios of runs with text."""
    totals: dict[int, list[float]] = {}
    for run in runs:
        total = totals.setdefault(run.path, [0, 0, 0, 0])
        size = len(run.text)
        total[0] += size
        total[1] += len(STOPS.findall(run.text))
        total[2] += 1
        total[3] += size if run.linked else 0
    ratio = np.array([[totals[r.path][0] / totals[r.path][2],
                       totals[r.path][1] / totals[r.path][2]] for r in runs])
    plain = np.array([1 - totals[r.path][3] / max(totals[r.path][0], 1) for r in runs])
    smooth, weight = np.zeros_like(ratio), np.zeros((len(runs), 1))
    numbers = {path: i for i, path in enumerate(dict.fromkeys(r.parent for r in runs))}
    parents = np.array([numbers[r.parent] for r in runs])
    for distance, w in zip(range(-REACH, REACH + 1), WEIGHTS, strict=True):
        to = slice(max(0, -distance), len(runs) - max(0, distance))
        of = slice(max(0, distance), len(runs) - max(0, -distance))
        if to.stop <= to.start:
            continue
        each = w * np.where(parents[to] == parents[of], 1.0, 0.25)[:, None]
        smooth[to] += each * ratio[of]
        weight[to] += each
    smooth /= weight
    return np.sqrt(smooth[:, 0] * (1 + smooth[:, 1])) * (0.1 + 0.9 * plain)


def plain_part(runs: list[Run]) -> np.ndarray:
    """How much of each run's block path is not linked; headings count as not linked.

    So a paragraph that is a link counts like the paragraphs beside it. Where all blocks of a path
    are links, they are a menu if they come in a row as short texts that are no sentences; a
    single one, or a list of sources, is text.
    """
    totals: dict[int, list[int]] = {}
    blocks: dict[int, list[Run]] = {}
    for run in runs:
        total = totals.setdefault(run.block_path, [0, 0])
        total[0] += len(run.text)
        total[1] += 0 if run.linked and not run.heading else len(run.text)
        blocks.setdefault(run.block, []).append(run)
    whole = {
        block: all(totals[run.block_path][1] == 0 for run in held) for block, held in blocks.items()
    }
    menus: set[int] = set()
    for linked, row in itertools.groupby(blocks, key=whole.__getitem__):
        row = list(row)
        texts = ["".join(run.text for run in blocks[block]).strip() for block in row]
        if linked and len(row) >= MENU_BLOCKS and median(map(len, texts)) < MENU_CHARS:
            if not any(STOPS.search(text) for text in texts):
                menus.update(row)
    parts = [totals[run.block_path] for run in runs]
    return np.array([
        (0.0 if run.block in menus else 1.0) if whole[run.block] else part[1] / part[0]
        for run, part in zip(runs, parts, strict=True)
    ])


def _allowed(reader: _Reader) -> list[bool]:
    """For every chain of listed elements, whether text in it may count.

    It may if each of them holds the page's article, or most of a page without articles.
    """
    runs, chains = [run for run in reader.runs if run.text.strip()], reader.chains
    exempt: set[int] = set()
    articles: Counter = Counter()
    inside = [0] * len(chains)
    for run in runs:
        size = len(run.text.strip())
        if run.article:
            articles[run.article] += size
        if not run.linked:
            inside[run.listed] += size
    if articles:
        largest = max(articles, key=articles.__getitem__)
        held = {run.outer for run in runs if run.article == largest}
        if all(run.outer for run in runs if run.article):
            for chain in held:
                while chain:
                    exempt.add(chain)
                    chain = chains[chain]
    else:
        total = sum(inside)
        for chain in range(len(chains) - 1, 0, -1):  # a chain comes after the one around it
            if inside[chain] > MOST * total:
                exempt.add(chain)
            inside[chains[chain]] += inside[chain]
    allowed = [True] * len(chains)
    for chain in range(1, len(chains)):
        allowed[chain] = chain in exempt and allowed[chains[chain]]
    return allowed


def main_text(page: str) -> str:
    """The article of a page."""
    reader = _Reader()
    runs = reader.read(page)
    allowed = _allowed(reader)
    runs = [run for run in runs if allowed[run.listed]]
    kept = [run for run in runs if run.text.strip()]
    if not kept:
        return ""
    score = scores(kept)
    sizes = np.array([len(run.text) for run in kept], float)
    articles = np.array([run.article for run in kept])
    held = {a: sizes[articles == a].sum() for a in set(articles.tolist()) - {0}}
    least = TEASER_PART * max(held.values(), default=0)
    teaser = np.isin(articles, [a for a, size in held.items() if size < least])

    def typical() -> float:
        return float((score * sizes)[~teaser].sum() / sizes[~teaser].sum())

    score[teaser] *= TEASER_WEIGHT
    gain = max(ARTICLE_PART * typical(), ARTICLE_LEAST)
    score += np.where((articles > 0) & ~teaser, gain * plain_part(kept), 0)
    chosen = score >= FAIR_PART * typical()
    wanted = {run.block for run, good in zip(kept, chosen, strict=True) if good}
    out: dict[int, list[str]] = {}
    for run in runs:
        if run.block in wanted:
            out.setdefault(run.block, []).append(run.text)
    lines = (" ".join("".join(parts).split()) for parts in out.values())
    return "\n".join(line for line in lines if line)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) if page else "" for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(tidy(_extract), "page_id long, url string, text string, n_chars long")
