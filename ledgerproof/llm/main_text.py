"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page becomes a sequence of words, which score positive, and tags, which score negative; the contiguous run with the
largest sum, found in one linear scan, is where the article is. The weights are log odds learned from labelled pages: those
whose markup names the article (an ``article`` element). Counting over a bounded sample of them (``LABELLED``) is a Spark
aggregation by kind of word or tag. The run is then completed within the element that holds it, so that short closing
paragraphs and headlines, whose words weigh less than their tags, are not lost. Elements that are never article text
(menus, forms, comments and the like, by name or by class) score against a run and are left out of it.

Nulls: a null html is an empty page and has no text; url is passed on. Text outside any element, unclosed elements, cut
pages and pages without a labelled article are handled alike; a page without words has the empty text. Repeated rows are
pages of their own. Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.base import python_workers, table

NAME = "op3_main_text"
LABELLED = 500
SQL = None

# Element names by role, and words of class, id and role attributes.
RAW = ("script", "style", "textarea", "iframe", "title")
SKIPPED = {"noscript", "template", "svg", "object", "canvas", "select", "math"}  # elements whose content is no text of the page
HEAD = {"base", "link", "meta", "noscript", "template"}  # besides raw ones; anything else ends the head
NEVER = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "label"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "dd", "dt", "td", "th", "figcaption", "caption"}
BLOCKS = TEXT_BLOCKS | {"address", "article", "body", "center", "details", "div", "dl", "figure", "hgroup", "hr", "html", "main", "ol", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"} | NEVER
NEVER_WORDS = ("ad", "adbanner", "adbox", "adcontainer", "ads", "adsbygoogle", "adslot", "adunit", "adwrapper", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "disqus", "footer",
               "hidden", "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "promoted", "recommended", "related", "replies", "respond", "search", "share",
               "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "teaser", "toolbar", "widget")
HEADLESS = {"article", "main"}  # a header element inside these holds the headline

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|$)|<[!?][^>]*>|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)", re.I)  # as an attribute, looked for without quoted values
_HIDDEN_STYLE = re.compile(r"(?:^|\s)(?:style\s*=\s*(?:\"[^\"]*?|'[^']*?|[^\s\"'>]*?)display\s*:\s*none|aria-hidden\s*=\s*[\"']?true)", re.I)
_NEVER_WORDS = frozenset(NEVER_WORDS)
_ABOUT = re.compile(r"(?:has|have|no|not|with|without|hide|show)(?:[-_]|(?=[A-Z]))")  # a token that tells of another element
TALK = {"comment", "comments", "replies", "respond", "disqus"}  # long, and still not the article
WRAPPER = ["wrapper"] * 3  # what a wrapper named like a menu or sidebar costs a run that enters it
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
KNOWN_TAGS = BLOCKS | VOID | {"a", "b", "i", "em", "strong", "span", "u", "small", "sup", "sub", "code"}
DEFAULT = {"word": 1.0, "short": 0.6, "link": 0.1, "never": -1.0, "tag": -0.6}
SHORT_BLOCK = 8


class Block:
    """Text between two block tags: its words, linked words, place in the tree, and how many tags led to it."""

    __slots__ = ("parts", "links", "words", "path", "never", "tags", "name", "inside")

    def __init__(self, path: tuple, never: bool, name: str, inside: bool):
        self.parts, self.links, self.words, self.tags = [], 0, 0, []
        self.path, self.never, self.name, self.inside = path, never, name, inside


def _is_never(name: str, attrs: str, stack: list) -> bool:
    if name in NEVER:
        return not (name == "header" and any(s[0] in HEADLESS for s in stack))
    if name in ("html", "body", "main", "article"):
        return False
    if "-" in name and not _NEVER_WORDS.isdisjoint(name.split("-")):  # amp-ad and other elements of a site's own
        return True
    return bool(attrs) and (_is_hidden(attrs) or bool(_never_words(attrs)))


def _is_hidden(attrs: str) -> bool:
    return bool(_HIDDEN.search(_QUOTED.sub("''", attrs)) or _HIDDEN_STYLE.search(attrs))


def _never_words(attrs: str) -> set[str]:
    """Words of class, id and role tokens that name something else than text; has-sidebar and the like name no sidebar."""
    tokens = (t for groups in _NAMED.findall(attrs) for t in "".join(groups).split() if not _ABOUT.match(t))
    return {p.lower() for t in tokens for p in _PARTS.findall(t) if p.lower() in _NEVER_WORDS}


def _breaks_out(name: str, skip: list[str]) -> bool:
    """Whether an element cannot lie in the skipped ones, so that these were left unclosed."""
    if name in HEADLESS or name == "body":
        return True
    return skip[0] in ("svg", "math", "select") and name in BLOCKS and "foreignobject" not in skip


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order; tags between blocks are kept with the block that follows them.

    An element that is never text by its class alone stays, at a cost, if it holds the article or main element or most of the
    page's paragraph words, and no such element lies outside it.
    """
    found, named, holders = _blocks(page, frozenset())
    if not named:
        return found
    below, total = Counter(), 0
    for block in found:
        if block.name == "p" and not any(name in NEVER for name, _ in block.path):
            total += block.words
            for _, number in block.path:
                below[number] += block.words
    inside = Counter(number for path in holders for number in path)
    ends = {path[-1] for path in holders}
    kept = set()
    for number, (words, path) in named.items():
        outside = len(holders) - inside[number] - sum(n in ends for n in path)
        if not outside and not words & TALK and (inside[number] or 2 * below[number] > total):
            kept.add(number)
    return _blocks(page, frozenset(kept))[0] if kept else found


def _blocks(page: str, kept: frozenset[int]) -> tuple[list[Block], dict[int, tuple[set[str], tuple[int, ...]]], list[tuple[int, ...]]]:
    """Blocks, never words and ancestors of each element that is never text by its class, and the numbers from the root to each article or main."""
    named: dict[int, tuple[set[str], tuple[int, ...]]] = {}
    holders: list[tuple[int, ...]] = []
    stack: list[tuple[str, int, bool]] = []  # name, number of the element, never
    out, number, last, linked, articles = [], 0, 0, 0, 0
    block = Block((), False, "", False)
    skip: list[str] = []  # the skipped element and those open in it
    head = False

    def text(value: str) -> None:
        nonlocal head
        if skip or (head and value.isspace()):
            return
        head = False
        if value and not value.isspace():
            n = len(entities.unescape(value).split())
            block.words += n
            block.links += n if linked else 0
        block.parts.append(value)

    for m in _TOKEN.finditer(page):
        if m.start() > last:
            text(page[last:m.start()])
        last = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        closing = bool(m["close"])
        empty = name in VOID or m["attrs"].endswith("/")
        if skip:
            if closing and name in skip:
                del skip[len(skip) - 1 - skip[::-1].index(name):]
                continue
            if not (any(s[0] == name for s in stack) if closing else _breaks_out(name, skip)):
                if not closing and not empty:
                    skip.append(name)
                continue
            skip.clear()
        if name == "head":
            head = not closing
            continue
        if head and (closing or name in HEAD - SKIPPED):
            continue
        head = head and name in HEAD
        if name in SKIPPED:
            if not closing and not empty:
                skip.append(name)
            continue
        if name == "a":
            linked = 0 if closing else 1
        if name not in BLOCKS:
            block.tags.append(name)
            if name == "br":
                block.parts.append(" ")
            opened = any(s[0] == name for s in stack)  # only within an element that is never text
            if closing or empty:
                if empty or not opened:
                    continue
            elif _is_never(name, m["attrs"], stack):
                if stack and stack[-1][0] in TEXT_BLOCKS:  # the paragraph goes on after it
                    skip.append(name)
                    linked = 0
                    continue
            elif not opened:
                continue
        tags = [] if block.words else block.tags
        if block.words:
            out.append(block)
        tags.append(name)
        if closing:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                del stack[at:]
        elif name not in VOID:
            if name in TEXT_BLOCKS or name in BLOCKS:
                for i in range(len(stack) - 1, -1, -1):  # a paragraph ends where the next block begins, an item at the next item
                    if stack[i][0] == "p" or (stack[i][0] == name and name in ("li", "dd", "dt", "td", "th", "tr")):
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCKS and stack[i][0] != "p":
                        break
            number += 1
            never = _is_never(name, m["attrs"], stack)
            if never and name not in NEVER and not _is_hidden(m["attrs"]):
                named[number] = _never_words(m["attrs"]), tuple(x[1] for x in stack)
            if number in kept:
                never = False
                tags.extend(WRAPPER)
            stack.append((name, number, (bool(stack) and stack[-1][2]) or never))
            if name in HEADLESS:
                holders.append(tuple(x[1] for x in stack))
            linked = 0
        block = Block(tuple(s[:2] for s in stack), bool(stack) and stack[-1][2], stack[-1][0] if stack else "", any(s[0] == "article" for s in stack))
        block.tags = tags
    if last < len(page):
        tail = page[last:]
        cut = re.search(r"<[/!?A-Za-z][^>]*$", tail)  # a tag that the end of the page cut off
        text(tail[:cut.start()] if cut else tail)
    if block.words:
        out.append(block)
    return out, named, holders


def _kind(block: Block) -> str:
    if block.never:
        return "never"
    if 2 * block.links > block.words:
        return "link"
    return "short" if block.words < SHORT_BLOCK else "word"


def _tag(name: str) -> str:
    return "tag:" + (name if name in KNOWN_TAGS else "other")


def count_kinds(page: str) -> Counter:
    """(kind, inside the article) -> words or tags of a labelled page."""
    found: Counter = Counter()
    for block in blocks(page):
        found[_kind(block), block.inside] += block.words
        for name in block.tags:
            found[_tag(name), block.inside] += 1
    return found


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of lying inside; words stay positive and tags negative, elements that are never text negative."""
    inside, outside = (sum(n for (_, i), n in counts.items() if i == side) for side in (True, False))
    found = dict(DEFAULT)
    for kind in {k for k, _ in counts}:
        odds = math.log((counts.get((kind, True), 0) + 1) / (inside + 2)) - math.log((counts.get((kind, False), 0) + 1) / (outside + 2))
        if kind.startswith("tag:"):
            found[kind] = min(-0.1, max(-3.0, odds - 1.0))
        elif kind == "never":
            found[kind] = min(-0.5, max(-2.0, odds))
        else:
            found[kind] = min(1.0, max(0.1, odds))
    return found


def _best_run(found: list[Block], weights: dict[str, float]) -> tuple[int, int] | None:
    """First and last block of the maximum-scoring run of words and tags."""
    best, best_run, total, first = 0.0, None, 0.0, 0
    for i, block in enumerate(found):
        total += sum(weights.get(_tag(name), weights["tag"]) for name in block.tags)
        if total <= 0:
            total, first = 0.0, i
        total += weights[_kind(block)] * block.words
        if total > best:
            best, best_run = total, (first, i)
    return best_run


def article(page: str, weights: dict[str, float]) -> str:
    found = blocks(page)
    run = _best_run(found, weights)
    if run is None:
        return ""
    first, last = run
    while first < last and _kind(found[first]) in ("never", "link"):
        first += 1
    # The element that holds the run, and around the run the rest of its text; of a whole body only paragraphs, headlines and items.
    shared = 0
    a, b = found[first].path, found[last].path
    while shared < min(len(a), len(b)) and a[shared] == b[shared]:
        shared += 1
    if first == last and found[first].name in TEXT_BLOCKS:
        shared = max(0, len(a) - 1)
    home = a[:shared]
    broad = not home or home[-1][0] in ("html", "body")

    def belongs(block: Block) -> bool:
        return block.path[:len(home)] == home and (block.never or (_kind(block) != "link" and (not broad or block.name in TEXT_BLOCKS)))

    while first > 0 and belongs(found[first - 1]):
        first -= 1
    while last + 1 < len(found) and belongs(found[last + 1]):
        last += 1
    texts = (" ".join(entities.unescape("".join(b.parts)).split()) for b in found[first:last + 1] if not b.never)
    return "\n".join(t for t in texts if t)


def learn_weights(pages: DataFrame, labelled: int = LABELLED) -> dict[str, float]:
    """Weights from at most ``labelled`` pages with an article element, chosen by the hash of their id."""
    chosen = pages.where(F.lower("html").contains("<article")).select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(labelled)
    sample = pages.join(F.broadcast(chosen.distinct()), "page_id", "left_semi").select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                found.update(count_kinds(page or ""))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found]), pa.array([i for _, i in found]), pa.array(list(found.values()), pa.int64())], ["kind", "inside", "n"])

    counts = python_workers(sample).mapInArrow(count, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    return weights_from({(kind, inside): n for kind, inside, n in counts.collect()})


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Per input row: page_id, url, text, n_chars."""
    weights = learn_weights(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [article(page or "", weights) for page in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return python_workers(pages.select("page_id", "url", "html")).mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
