"""Main text of web pages by the maximum-scoring contiguous region.

A page is a sequence of tags and words.  A word scores the log-odds that words of its section
are content, positive in articles and negative in menus; a tag scores the log-odds of its
name, never above zero.  Both are counted on pages that label themselves: those whose
``article`` or ``main`` element marks the content.  One linear scan finds the contiguous region of
highest score.  Inside it, sections that score negative by themselves are left out, and so are
menus, forms, comments and the like within an article: those neither score nor end the region.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanile.llm.sample import bounded
from campanile.llm.ship import ship
from campanile.llm.words import batches

#: Labelled pages that the weights are counted on, at most; a documented bound.
MAX_LABELLED = 5_000
#: Added to the counts of every kind, and to those of kinds whose name tells what they are.
SMOOTHING, NAMED = 1.0, 20.0

# Element and attribute names of HTML.
RAW = "script style noscript iframe textarea title noembed noframes xmp"
#: Elements whose words aren't shown as text.  One that is never closed is taken as empty; controls then end at the next block.
HIDDEN = frozenset("template svg math object canvas audio video select button datalist".split())
CONTROLS = frozenset("select button datalist".split())
IN_HEAD = frozenset("base link meta template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset("article main".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset".split())
SECTIONS = CONTENT | BOILERPLATE | frozenset("body section li td figure blockquote".split())
HINTS = frozenset(
    "ad ads advert advertisement adverts aside banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer "
    "footer header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promotion related "
    "respond share sharing sidebar social sponsor sponsored subscribe toolbar widget alert login signup reply replies".split())
CONTENT_HINTS = frozenset("article content entry main post story body text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW.split()) + r")\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*+>?|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>?", re.S | re.I)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z]+")
_CLOSED = re.compile("</(" + "|".join(sorted(HIDDEN)) + r")\b", re.I)


def _section(name: str, rest: str, nested: bool = False) -> str | None:
    """The kind of section that an element opens, or None if it says nothing about its words.

    A part of a name as in ``comments-open`` or ``has-sidebar`` tells what the page has, not what a ``main`` or
    ``article`` is: the first is content whatever its names, the second unless a whole name is a hint.  ``nested``
    articles, in another one or under a hint, are often comments: there a part is enough.  ``post`` and the like outdo both.
    """
    hints, names = set(), set()
    for found in _NAMES.findall(rest):
        names.update("".join(found).lower().split())
        hints.update(_PART.findall("".join(found).lower()))
    if re.search(r"(?:^|\s)hidden(?:$|[\s=])|display\s*:\s*none", rest, re.I):
        return "hint:hidden"
    if name == "main" or (name == "article" and names & CONTENT_HINTS):
        return name
    if bad := (names if name == "article" and not nested else hints) & HINTS:
        return "hint:" + min(bad)
    if name in BOILERPLATE or name in CONTENT:
        return name
    if good := hints & CONTENT_HINTS:
        return "content:" + min(good)
    return name if name in SECTIONS else None


def _prior(kind: str) -> tuple[float, float]:
    """Counts inside and outside content that a kind of words starts with."""
    name = kind.removeprefix("word ")
    if name in CONTENT or name.startswith("content:"):
        return SMOOTHING + NAMED, SMOOTHING
    if name in BOILERPLATE or name.startswith("hint:"):
        return SMOOTHING, SMOOTHING + NAMED
    return (2 * SMOOTHING, SMOOTHING) if kind.startswith("word ") else (SMOOTHING, SMOOTHING)


def events(page: str):
    """The page in order: ``(kind, size, text, is_block, inside)``.

    Tags have size 1 and no text; runs of text have their number of words.  ``inside`` tells whether the page
    itself marks the place as content.
    """
    # Open elements: name, section kind in force, whether in a content element, whether hidden or in boilerplate inside it.
    open_: list[tuple[str, str, bool, bool]] = []
    # How many elements of each name are open, so that none is looked for in vain.
    number: Counter[str] = Counter()
    last_end = {found[1].lower(): found.start() for found in _CLOSED.finditer(page)}
    loose: list[int] = []  # places of controls that are never closed
    at = 0
    out = []

    def close(down_to: int) -> None:
        while loose and loose[-1] >= down_to:
            loose.pop()
        for name, *_ in open_[down_to:]:
            number[name] -= 1
        del open_[down_to:]

    def text(piece: str) -> None:
        if open_ and open_[-1][0] == "head" and piece.strip():
            close(len(open_) - 1)  # words end a head
        words = html.unescape(piece) if "&" in piece else piece
        _, kind, content, barred = open_[-1] if open_ else ("", "body", False, False)
        if barred:
            out.append(("barred", 0, None, False, False))
        else:
            out.append((f"word {kind}", len(words.split()), words, False, content))

    for found in _TOKEN.finditer(page):
        if found.start() > at:
            text(page[at:found.start()])
        at = found.end()
        name = found["name"]
        if not name:
            continue
        name = name.lower()
        if not found["end"] and open_ and open_[-1][0] == "head" and name not in IN_HEAD:
            close(len(open_) - 1)  # and so does an element that can't be in it
        if loose and not found["end"] and name in BLOCKS and name != "option":
            close(loose[0])
        known = name if name in BLOCKS or name in VOID else "inline"
        _, kind, content, barred = open_[-1] if open_ else ("", "body", False, False)
        if barred:
            out.append(("barred", 0, None, name in BLOCKS, False))
        else:
            out.append((f"{found['end']}{known}" + " in content" * content, 1, " " if name == "br" else None, name in BLOCKS, content))
        if found["end"]:
            if number[name]:
                close(next(i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name))
        elif name not in VOID and not found["rest"].rstrip().endswith("/") and (
                name not in HIDDEN or name in CONTROLS or last_end.get(name, -1) > at):
            if name in ("p", "li") and open_ and open_[-1][0] == name:
                close(len(open_) - 1)  # these end where the next one begins
                _, kind, content, barred = open_[-1] if open_ else ("", "body", False, False)
            own = _section(name, found["rest"], kind.startswith("hint:") or number["article"] > 0)
            bad = own is not None and (own in BOILERPLATE or own.startswith("hint:"))
            inner = own if own and (bad or own in CONTENT or own.startswith("content:") or not kind.startswith("hint:")) else kind
            if own and not bad and own not in CONTENT and (kind in BOILERPLATE or kind in CONTENT):
                inner = kind  # a list or section inside an article or menu is part of it
            open_.append((name, inner, content or own in CONTENT, barred or (content and bad) or name in HIDDEN or name == "head"))
            number[name] += 1
            if name in CONTROLS and last_end.get(name, -1) <= at:
                loose.append(len(open_) - 1)
    if at < len(page):
        text(page[at:])
    return out


def _count(blocks):
    for block in batches(blocks):
        total: dict[str, list[int]] = {}
        for page in block.column("html").to_pylist():
            found = events(page or "")
            if not any(inside for *_, inside in found):
                continue
            for kind, size, _, _, inside in found:
                total.setdefault(kind, [0, 0])[not inside] += size
        rows = list(total.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.string()), pa.array([v[0] for _, v in rows], pa.int64()),
             pa.array([v[1] for _, v in rows], pa.int64())], names=["kind", "inside", "outside"])


def fit(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> dict[str, float]:
    """Weight of each kind of word and tag, counted on ``pages(page_id, html)`` that mark their content.

    The kinds are element names and known hints, a fixed number.  Without such pages the weights are the priors'.
    """
    ship(pages.sparkSession)
    sample = bounded(pages.select("page_id", "html").filter("html IS NOT NULL"), max_labelled, "page_id")
    rows = sample.mapInArrow(_count, "kind string, inside bigint, outside bigint").groupBy("kind").agg(
        F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return {r.kind: _weight(r.kind, r.inside, r.outside) for r in rows}


def _weight(kind: str, inside: float = 0, outside: float = 0) -> float:
    more, less = _prior(kind)
    odds = math.log((inside + more) / (outside + less))
    return odds if kind.startswith("word ") else min(odds, 0.0) - 0.01


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The page's main text: blocks in order, joined by two line ends; empty if nothing scores."""
    found = events(page or "")
    best, best_from, best_to, total, start = 0.0, 0, 0, 0.0, 0
    scores = []
    for i, (kind, size, *_) in enumerate(found):
        weight = weights.get(kind)
        if weight is None:
            weight = weights[kind] = _weight(kind)
        scores.append(weight)
        total += weight * size
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_from, best_to = total, start, i + 1
    blocks, line = [], []
    for (kind, _, words, is_block, _), weight in zip(found[best_from:best_to], scores[best_from:best_to]):
        if is_block:
            blocks.append("".join(line))
            line = []
        elif words is not None and (weight > 0 or not kind.startswith("word ")):
            line.append(words)
    blocks.append("".join(line))
    return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def _extract(blocks, weights: dict[str, float]):
    weights = dict(weights)
    for block in batches(blocks):
        texts = [main_text(page, weights) for page in block.column("html").to_pylist()]
        rest = [c for c in block.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays([block.column(c) for c in rest] + [pa.array(texts, pa.string())], names=[*rest, "text"])


def extract(pages: DataFrame, weights: dict[str, float], *keep: str) -> DataFrame:
    """``keep`` columns of ``pages(html, ...)`` with ``text`` and ``n_chars``, its code points.

    Null or empty pages, and pages without a word that scores above zero, give an empty text.  Every row has
    its row in the result; an empty table gives an empty result.
    """
    ship(pages.sparkSession)
    frame = pages.select(*keep, F.col("html").cast("string").alias("html"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != "html"] + ["text string"])
    out = frame.mapInArrow(lambda b: _extract(b, weights), schema)
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
