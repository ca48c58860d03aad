"""Main text of web pages by wrappers inferred for each host.

A wrapper is a union-free regular expression over a host's token streams: a
sequence of elements, text slots and groups, each of them once, optional or
repeated. Pages are read as streams of tags and texts; runs of like siblings
and tandem repeats fold into repeated groups. Two wrappers are aligned from the
start by longest common subsequence; what only one has becomes optional, and
texts that differ become slots. Alignment of wrappers is again a wrapper, so a
partition aligns its pages, and partial wrappers of a host are aligned in
rounds of a fixed fan-in, whatever the host's size.

The wrapper tells which of its slots hold content, and each page is read by its
host's slots. Content are the slots under an article element, else under a main
element, but for text that is the same on all of the host's pages (the template's
notices and labels; see content_paths), and without menus, footers, sides,
notices, adverts, forms and comments, known by element and by whole class, id
and role names; inside an article, a name counts only if all names of that
attribute do. Names of what encloses an article only count against other article
or main elements of the page. For pages with neither element, content are all
containers with running text that differs between the host's pages, asides left
out as long as any other is left.

Null and empty pages have an empty text; a null url is a host of its own.
Repeated rows each get their row, and a host of equal pages keeps their text.
Equal texts in several slots are kept in page order. Very long pages are read
whole. Cut-off and unclosed markup ends with the
page. Other columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

#: Fixed names: elements without an end, elements whose content is no text, elements inside a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Fixed names: elements and words of class or id that mark what isn't the article; words stand for whole names.
ASIDE = frozenset("nav header footer aside form button select dialog menu fieldset figure".split())
ASIDE_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs byline comment comments consent cookie cookies discussion disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted recommended related replies respond share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget".split())
#: Marks of a label: some or all whole names of a class, id or role are ASIDE_WORDS.
SOME_ASIDE, ALL_ASIDE = "!", "!!"
#: Fixed: an element of the first set ends where one of the second starts.
ENDS = {
    "p": frozenset("address article aside blockquote center dd details div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
WORD = re.compile(r"[a-z]+")
FAN_IN = 16


def label_of(tag: str, attributes: str) -> str:
    """Element name and the letter words of its class, id and role, with marks if whole names of these are ASIDE_WORDS."""
    values = [value.strip("\"'").lower() for value in NAMED.findall(attributes)]
    marks = set()
    for names in map(str.split, values):
        if not ASIDE_WORDS.isdisjoint(names):
            marks.add(ALL_ASIDE if ASIDE_WORDS.issuperset(names) else SOME_ASIDE)
    return ".".join([tag, *sorted({w for value in values for w in WORD.findall(value)} | marks)])


def blocks(page: str | None) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """(path of labels, text, characters in links) of each block with text, in page order."""
    path: list[str] = []
    parts: list[str] = []
    state = {"links": 0, "in_link": False}
    page = page or ""

    def flush():
        text = " ".join("".join(parts).split())
        parts.clear()
        links, state["links"] = state["links"], 0
        return [(tuple(path), text, links)] if text else []

    def add(raw: str) -> None:
        if raw:
            raw = entities.unescape(raw)
            parts.append(raw)
            if state["in_link"]:
                state["links"] += len(raw)

    at = 0
    while True:
        found = TOKEN.search(page, at)
        if not found:
            break
        add(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "a":
                state["in_link"] = False
            if tag in INLINE:
                continue
            yield from flush()
            for depth in range(len(path) - 1, -1, -1):
                if path[depth].split(".", 1)[0] == tag:
                    del path[depth:]
                    break
            continue
        if tag in RAW:
            if not found[0].endswith("/>"):
                end = re.compile(f"</{tag}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            if tag not in INLINE:
                yield from flush()
            continue
        if tag == "a":
            state["in_link"] = True
        if tag == "br":
            parts.append(" ")
        if tag in INLINE or tag == "br":
            continue
        yield from flush()
        while path and tag in ENDS.get(path[-1].split(".", 1)[0], ()):
            path.pop()
        if tag not in VOID and not found[0].endswith("/>"):
            path.append(label_of(tag, found[3]))
    add(page[at:])
    yield from flush()


# A wrapper node: [label, times, pages, text, mass, children]. label "#" is a
# text slot, "(" a group of siblings. times: "1", "?", "+" or "*". text: the
# text of a slot while all pages agree, else None. mass: characters outside links.


def node(label: str, text: str | None = None, mass: int = 0) -> list:
    return [label, "1", 1, text, mass, []]


def page_wrapper(page: str | None) -> list:
    """The wrapper that one page alone gives."""
    root = node("")
    trail: list[tuple[str, list]] = []
    for path, text, links in blocks(page):
        keep = 0
        while keep < len(trail) and keep < len(path) - 1 and trail[keep][0] == path[keep]:
            keep += 1  # a block opens its innermost element anew
        del trail[keep:]
        for label in path[keep:]:
            new = node(label)
            (trail[-1][1] if trail else root)[5].append(new)
            trail.append((label, new))
        (trail[-1][1] if trail else root)[5].append(node("#", text, max(0, len(text) - links)))
    fold(root)
    return root


def _times(a: str, b: str) -> str:
    many, none = a in "+*" or b in "+*", a in "?*" or b in "?*"
    return {(False, False): "1", (False, True): "?", (True, False): "+", (True, True): "*"}[many, none]


def _key(item: list):
    return item[0] if item[0] != "(" else ("(", tuple(_key(c) for c in item[5]))


def _repeat(into: list, other: list) -> None:
    """other stands beside into: one of them, repeated."""
    _unite(into, other)
    into[1] = {"1": "+", "?": "*"}.get(into[1], into[1])


def _unite(into: list, other: list) -> None:
    """Aligns other with into, of the same label; into becomes the wrapper of both."""
    into[1] = _times(into[1], other[1])
    into[2] += other[2]
    into[4] += other[4]
    if into[3] != other[3]:
        into[3] = None
    into[5] = align(into[5], other[5])


def fold(item: list) -> None:
    """Runs and tandem repeats of like children become repeated items."""
    for child in item[5]:
        fold(child)
    row = item[5]
    for width in range(1, 5):
        out: list = []
        for one in row:
            out.append(one)
            while len(out) >= 2 * width and [_key(x) for x in out[-width:]] == [_key(x) for x in out[-2 * width : -width]]:
                again = out[-width:]
                del out[-width:]
                if width == 1:
                    _repeat(out[-1], again[0])
                    continue
                for a, b in zip(out[-width:], again, strict=True):
                    _unite(a, b)
                out[-width:] = [["(", "+", 1, None, 0, out[-width:]]]
                break
            while width > 1 and len(out) > width and out[-width - 1][0] == "(" and [_key(x) for x in out[-width:]] == [_key(x) for x in out[-width - 1][5]]:
                for a, b in zip(out[-width - 1][5], out[-width:], strict=True):
                    _unite(a, b)
                del out[-width:]
        row = out
    item[5] = row


def align(left: list, right: list) -> list:
    """One row of items for two, by longest common subsequence; the others turn optional."""
    a, b = [_key(x) for x in left], [_key(x) for x in right]
    if a == b:
        for x, y in zip(left, right, strict=True):
            _unite(x, y)
        return left
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i] == b[j]:
            _unite(left[i], right[j])
            out.append(left[i])
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append(left[i])
            out[-1][1] = _times(out[-1][1], "?")
            i += 1
        else:
            out.append(right[j])
            out[-1][1] = _times(out[-1][1], "?")
            j += 1
    return out


def merged(wrappers: Iterator[list]) -> list | None:
    total = None
    for one in wrappers:
        if total is None:
            total = one
        else:
            _unite(total, one)
    return total


def expression(item: list) -> str:
    """The wrapper as a regular expression over tags and texts, for people to read."""
    inside = "".join(expression(c) for c in item[5])
    if item[0] == "#":
        own = "#text" if item[3] is None else json.dumps(item[3], ensure_ascii=False)
    else:
        own = inside if item[0] == "(" else f"<{item[0]}>{inside}</>" if item[0] else inside
    return own if item[1] == "1" else f"({own}){item[1]}"


def is_aside(label: str, inside_article: bool) -> bool:
    tag, *words = label.split(".")
    if tag in ("html", "body", "main", "article"):
        return False
    if tag in ASIDE and not (tag == "header" and inside_article):
        return True
    return ALL_ASIDE in words or SOME_ASIDE in words and not inside_article


@lru_cache(maxsize=65_536)
def article_rank(path: tuple[str, ...]) -> int | None:
    """0 under an article element, 1 under main or articlebody, 2 more for each name around these that would be an aside's; None for other paths and asides."""
    inner = next((k for k, label in enumerate(path) if label.split(".")[0] in ("article", "main") or "articlebody" in label.split(".")), None)
    if inner is None or any(is_aside(label, True) for label in path[inner + 1 :]):
        return None
    around = [label for label in path[:inner] if is_aside(label, False)]
    if any(label.split(".")[0] in ASIDE - {"form"} for label in around):
        return None
    return (not any(label.split(".")[0] == "article" for label in path)) + 2 * len(around)


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Pages from which on a host's wrapper can tell template text from the article's.
TELLING = 3


#: Rank of slots that aren't in an article or main element.
FALLBACK = 1_000_000


def content_paths(wrapper: list) -> dict[tuple[str, ...], int]:
    """The wrapper's content slots by path, with the rank of their element: the article's (see article_rank), FALLBACK for pages without one.

    A slot whose text is the same on all pages, and that no page lacks, is part
    of the template. Within articles that goes for hosts of TELLING pages or
    more whose articles differ elsewhere, and not for headings.
    """
    slots: dict[tuple[str, ...], list] = {}

    def walk(item: list, path: tuple[str, ...], sure: bool) -> None:
        for child in item[5]:
            always = sure and child[1] in "1+"
            if child[0] == "#":
                own = slots.setdefault(path, [0, True, False])
                own[0] += child[4]
                own[1] = own[1] and child[3] is not None and child[2] > 1
                own[2] = own[2] or always
            else:
                walk(child, path if child[0] == "(" else (*path, child[0]), always)

    walk(wrapper, (), True)
    ranks = {path: rank for path in slots if (rank := article_rank(path)) is not None}
    if wrapper[2] >= TELLING and any(not slots[path][1] for path in ranks):
        ranks = {p: r for p, r in ranks.items() if not (slots[p][1] and slots[p][2]) or p[-1].split(".")[0] in HEADINGS}

    def clean(path):
        return not any(is_aside(label, False) for label in path)

    def clean_elements(path):
        return not any(label.split(".")[0] in ASIDE - {"form"} for label in path)

    differing = [p for p in slots if not slots[p][1]] or list(slots)  # the others are the same on all pages: part of the template, unless nothing differs
    good = next((g for test in (clean, clean_elements) if (g := [p for p in differing if test(p)])), differing)
    mass: dict[tuple[str, ...], int] = {}
    for path in good:
        mass[_holder(path)] = mass.get(_holder(path), 0) + slots[path][0]
    return {p: FALLBACK for p in [p for p in good if mass[_holder(p)]] or good} | ranks


def _holder(path: tuple[str, ...]) -> tuple[str, ...]:
    return path[:-1] if path and path[-1].split(".")[0] in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote") else path


def page_text(page: str | None, content: dict[tuple[str, ...], int]) -> str:
    """The page read by its host's wrapper: the blocks in the content slots of the best rank that the page has.

    Slots of FALLBACK serve only pages without an article or main element.
    """
    own = list(blocks(page))
    best = min((rank for path, _, _ in own if (rank := article_rank(path)) is not None), default=FALLBACK)
    wanted = {path for path, rank in content.items() if rank == best or best == FALLBACK}
    return " ".join(text for path, text, _ in own if path in wanted)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _pack(wrapper: list) -> str:
    return json.dumps(wrapper, ensure_ascii=False, separators=(",", ":"))


#: Hosts whose wrappers a task holds before it hands them on.
HOSTS_AT_ONCE = 2_000


def wrappers(pages: DataFrame) -> DataFrame:
    """host and its wrapper (JSON), from all of its pages."""
    slim = pages.select(host_of(F.col("url")).alias("host"), "html")

    def of_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([_pack(w) for w in held.values()], pa.string())], ["host", "wrapper"])

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                one = page_wrapper(page.as_py())
                if host in held:
                    _unite(held[host], one)
                else:
                    held[host] = one
            if len(held) >= HOSTS_AT_ONCE:
                yield out()
                held.clear()
        yield out()

    def of_parts(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = merged(json.loads(w.as_py()) for batch in batches for w in batch.column("wrapper"))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([_pack(total)])], ["host", "wrapper"])

    parts = cut_lineage(slim.mapInArrow(of_pages, "host string, wrapper string"))
    most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    while most > FAN_IN:  # rounds of a fixed fan-in for hosts in many parts
        spread = -(-most // FAN_IN)
        dealt = parts.withColumn("part", F.pmod(F.xxhash64("wrapper", F.monotonically_increasing_id()), F.lit(spread)))
        parts = cut_lineage(dealt.groupBy("host", "part").applyInArrow(of_parts, "host string, wrapper string"))
        most = min(spread, most - 1)
    return parts.groupBy("host").applyInArrow(of_parts, "host string, wrapper string")


#: Bytes of content paths up to which they are broadcast to the pages; beyond, both are shuffled by host.
BROADCAST_BYTES = 32_000_000


def content(pages: DataFrame) -> DataFrame:
    """host and its content slots (JSON): paths and ranks."""

    def of_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [json.dumps(list(content_paths(json.loads(w.as_py())).items()), ensure_ascii=False) for w in batch.column("wrapper")]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())], ["host", "paths"])

    return cut_lineage(wrappers(pages).mapInArrow(of_wrappers, "host string, paths string"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    known = content(pages).withColumnRenamed("host", "__host")
    size = known.agg(F.sum(F.length("__host") + F.length("paths"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        known = F.broadcast(known)
    slim = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    joined = slim.join(known, slim["host"] == known["__host"], "left").select("page_id", "url", "html", "paths")
    schema = slim.select("page_id", "url").withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for page, paths in zip(batch.column("html"), batch.column("paths"), strict=True):
                key = paths.as_py() or "[]"
                if key not in seen:
                    if len(seen) >= HOSTS_AT_ONCE:
                        seen.clear()
                    seen[key] = {tuple(path): rank for path, rank in json.loads(key)}
                texts.append(page_text(page.as_py(), seen[key]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, schema)
