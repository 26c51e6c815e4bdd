"""Main text of web pages by consensus over the pages of a host.

Each page's containers are scored by the text that stands in them, links and named
boilerplate left out, and named by their generalised tag-class path (digits removed).
The pages of a host vote on the paths in Spark; then every page is read again and the
text below its host's winning path is taken. A page without that path, and a page whose
host is unknown, falls back to its own best container.
"""

import html
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .shared import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: HTML's elements by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output picture q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes plaintext".split())
DROPPED = frozenset(
    "head nav footer aside form button select option datalist fieldset svg canvas object audio video map template dialog menu".split())
TEXT_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr figcaption caption address summary ul ol dl table tbody thead tfoot "
    "figure details".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Which open elements a start tag ends, up to one of the second set.
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre section summary table ul".split())
_SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
             "option": ({"option"}, {"select"})}
#: Words of class and id names that mark what is not the article.
BOILERPLATE = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertisements advertising sponsor sponsored promo promotion "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars rail footer header masthead topbar toolbar "
    "banner notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login "
    "search share sharing social comment comments disqus reply replies respond related recommended recommendations teaser "
    "widget widgets pagination pager copyright legal disclaimer skip tags toc form".split())
_ROLES = frozenset("navigation banner complementary contentinfo search dialog alertdialog alert menu menubar form".split())
_NEGATED = frozenset("no not has with without".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|"
    r"</?[a-zA-Z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


class Node:
    """An open or closed element: its generalised path, and whether its text is kept."""

    __slots__ = ("tag", "parent", "path", "kept", "inside")

    def __init__(self, tag: str, parent: "Node | None", name: str, kept: bool):
        self.tag, self.parent, self.kept = tag, parent, kept
        self.path = f"{parent.path}>{name}" if parent else name
        self.inside = tag == "article" or parent is not None and parent.inside


def _marks(names: str) -> bool:
    for name in names.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if any(w in BOILERPLATE and (i == 0 or words[i - 1] not in _NEGATED) for i, w in enumerate(words)):
            return True
    return False


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def _hidden(attributes: dict[str, str]) -> bool:
    style = attributes.get("style", "").replace(" ", "").lower()
    return ("hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
            or "display:none" in style or "visibility:hidden" in style)


def _opened(tag: str, text: str, parent: Node | None) -> Node:
    attributes = _attributes(text) if text and text != "/" else {}
    classes, own = attributes.get("class", ""), attributes.get("id", "")
    names = sorted({_DIGITS.sub("", c.lower()) for c in classes.split()} - {""})
    named = tag not in ("html", "body", "article", "main") and (_marks(classes) or _marks(own))
    drop = tag in DROPPED or named or _hidden(attributes) or attributes.get("role", "").lower() in _ROLES
    kept = (parent is None or parent.kept) and not drop
    if tag == "header":  # a page's header goes; an article's header is left with its headings
        kept = (parent is not None and parent.kept and parent.inside) and not _hidden(attributes)
    return Node(tag, parent, ".".join([_DIGITS.sub("#", tag) if tag not in HEADINGS else tag, *names]), kept)


def blocks_of(page: str) -> list[tuple[Node, str, float]]:
    """The page's blocks in order: the element they stand in, their text, and the share of it inside links."""
    root = Node("", None, "", True)
    stack, out, text, links = [root], [], [], 0
    link_from: int | None = None
    size = 0

    def flush() -> None:
        nonlocal text, links, size, link_from
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            node = stack[-1]
            if whole and node.kept and not (_in_header(node) and node.tag not in HEADINGS):
                linked = links + (size - link_from if link_from is not None else 0)
                out.append((node, whole, linked / max(size, 1)))
            text, links, size = [], 0, 0
            link_from = 0 if link_from is not None else None

    def close(tags: set | frozenset, stops: set | frozenset) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                flush()
                del stack[i:]
                return close(tags, stops)
            if stack[i].tag in stops:
                return

    at, end = 0, len(page)
    for match in iter(lambda: _TOKEN.search(page, at), None):
        start = match.start()
        if start > at:
            text.append(page[at:start])
            size += start - at
        at = match.end()
        tag = (match.group(2) or "").lower()
        if not tag:
            continue
        closing, rest = match.group(1), match.group(3)
        if not match.group(4):  # the page ends inside a tag
            break
        if tag in RAW and not closing:
            stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
            if tag == "textarea" or tag == "title":
                flush()
            continue
        if tag == "a":
            if closing and link_from is not None:
                links, link_from = links + size - link_from, None
            elif not closing:
                link_from = size if link_from is None else link_from
            continue
        if tag in INLINE:
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                text.append(" ")
                size += 1
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag in ("p", "li", *HEADINGS) and stack[i].tag in ("div", "article", "section", "td", "body"):
                    break  # a stray end tag ends nothing outside its container
        else:
            if tag in _CLOSES_P:
                close({"p"}, {"div", "article", "section", "main", "td", "th", "li", "blockquote", "table", "button"})
            if tag in _SIBLINGS:
                close(*_SIBLINGS[tag])
            if not rest.endswith("/"):
                stack.append(_opened(tag, rest, stack[-1]))
    else:
        if at < end:
            text.append(page[at:])
            size += end - at
    flush()
    return out


def _in_header(node: Node | None) -> bool:
    while node is not None:
        if node.tag == "header":
            return True
        node = node.parent
    return False


def _containers(node: Node) -> Iterator[Node]:
    """The element and those around it that can hold an article: text blocks and their lists are parts, not containers."""
    while node is not None and node.parent is not None:
        if node.tag not in TEXT_BLOCKS:
            yield node
        node = node.parent


def scores(blocks: list[tuple[Node, str, float]]) -> dict[str, float]:
    """Score of each container path of a page.

    A block gives its text outside links, half of it if it is short, to an enclosing article or else to its next
    container; every container further out gets four fifths of the one before, and containers within an article
    get the same four fifths, so that an article is not taken for one of its sections.
    """
    found: dict[str, float] = {}
    for node, text, linked in blocks:
        weight = len(text) * (1 - linked) * (1.0 if len(text) >= 40 else 0.5)
        shelves = list(_containers(node))
        first = next((i for i, c in enumerate(shelves) if c.tag == "article"), 0)
        seen = set()
        for i, container in enumerate(shelves):
            if container.path not in seen:
                seen.add(container.path)
                found[container.path] = found.get(container.path, 0.0) + weight * (0.8 ** (i - first) if i >= first else 0.8)
    return found


def text_below(blocks: list[tuple[Node, str, float]], path: str | None) -> str | None:
    """The blocks below a path, in page order; None where the page has no such block."""
    chosen = [text for node, text, _ in blocks if path is not None and any(c.path == path for c in _containers(node))]
    return "\n".join(chosen) if chosen else None


def main_text(page: str | None, path: str | None) -> str:
    """The text below the host's path, or below the page's own best container, or all that is left of the page."""
    blocks = blocks_of(page or "")
    found = text_below(blocks, path)
    if found is None and blocks:
        own = scores(blocks)
        found = text_below(blocks, min(own, key=lambda p: (-own[p], p))) if own else "\n".join(b[1] for b in blocks)
    return found or ""


def host_of(url: Column) -> Column:
    """The host in small letters; empty for NULL and for addresses without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1))


def winning_paths(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """host, path: the container path that the host's pages give most votes. A page has one vote, which it shares out by score.

    Votes are added up on the map side first, so a host with many pages costs no more than one with few; ties go to
    the path that sorts first. Pages without a host do not vote.
    """
    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            votes: dict[tuple[str, str], float] = {}
            for host, whole in zip(batch["host"], batch["page"], strict=True):
                own = scores(blocks_of(whole or ""))
                total = sum(own.values())
                for path, score in own.items():
                    votes[host, path] = votes.get((host, path), 0.0) + (score / total if total else 0.0)
            yield pd.DataFrame([(h, p, v) for (h, p), v in votes.items()], columns=["host", "path", "vote"])

    ballots = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{page}`").alias("page")).where("host <> ''")
    # Votes are settled to 9 decimals, so that their order does not decide a tie.
    counted = ballots.mapInPandas(vote, "host string, path string, vote double").groupBy("host", "path").agg(
        F.round(F.sum("vote"), 9).alias("vote"))
    return counted.groupBy("host").agg(F.min_by("path", F.struct(-F.col("vote"), "path")).alias("path"))


def extracted(pages: DataFrame, url: str = "url", page: str = "html", name: str = "text") -> DataFrame:
    """Adds the page's main text as `name` and its code points as `n_chars`; both replace columns of that name.

    Blocks stand in page order, one on a line, with single spaces inside. NULL and empty pages give an empty text; so
    do pages without a block of text. Repeated rows vote and return once each, long pages are read whole, ties between
    paths go to the one that sorts first. An empty table gives no row. Other columns pass unchanged.
    """
    winners = stored(winning_paths(pages, url, page))

    @F.pandas_udf("string")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for whole, path in batches:
            yield pd.Series([main_text(p, w) for p, w in zip(whole, path, strict=True)], dtype=object)

    keep = [F.col(f"p.`{c}`") for c in pages.columns if c not in (name, "n_chars")]
    joined = pages.alias("p").join(winners.alias("w"), host_of(F.col(f"p.`{url}`")) == F.col("w.host"), "left")
    return joined.select(*keep, read(F.col(f"p.`{page}`"), F.col("w.path")).alias(name)).withColumn(
        "n_chars", F.length(name).cast("long"))
