"""Main text of web pages by differencing pages of near URLs.

Pages are put in the order of host and URL path, so a page's nearest URLs of its host are its neighbours. The blocks
(lines) of a page are aligned with its neighbour's by longest common subsequence, and the lines they share - the
site's frame - are deleted. Mark-up decides what differencing cannot see: elements and containers that are never
article text (menus, forms, adverts that change from page to page, reader comments) go before the comparison, and
where a page marks its article, the text is taken from there, without the lines it shares; its headings stay.
"""

from __future__ import annotations

import html as entities
import itertools
import re
from collections import deque
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema, bounded_batches, shuffle_partitions

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
                     r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_TOKEN = re.compile(r"[a-z0-9]+")
#: Elements whose content is not mark-up.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math", "object", "canvas"}
#: Elements that never hold article text.
FRAME = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset"} | RAW
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Kinds of blocks beside plain text.
LINKS, HEADING = 1, 2
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu",
         "menubar", "form"}
#: Words of class and id names that mark a container as frame, and those that mark the article.
FRAME_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
               "promotion", "nav", "navbar", "navigation", "menu", "menubar", "sidebar", "breadcrumb", "breadcrumbs",
               "footer", "masthead", "topbar", "toolbar", "cookie", "cookies", "consent", "gdpr", "notice", "banner",
               "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing",
               "social", "comment", "comments", "commentlist", "disqus", "respond", "replies", "reply", "related",
               "recommended", "recommendations", "trending", "widget", "pagination", "pager", "search", "skip", "alert"}
#: First parts that make a name a state ("no-sidebar"), and last parts that only say what shape a container has ("ad-box").
STATES = {"no", "not", "has", "with", "without", "is"}
SHAPES = {"area", "bar", "block", "bottom", "box", "button", "buttons", "container", "form", "group", "header", "icons",
          "inner", "item", "items", "left", "link", "links", "list", "outer", "panel", "posts", "right", "section", "slot",
          "title", "top", "unit", "wrap", "wrapper"}
MAIN_NAMES = {"article", "articlebody", "content", "main", "maincontent", "entry", "story", "storybody", "post"}


class _Region:
    __slots__ = ("name", "frame", "main")

    def __init__(self, name, frame, main):
        self.name, self.frame, self.main = name, frame, main


def _frame_name(pieces: list[str]) -> bool:
    """Whether a class or id, given by its words, names a frame: as a whole, by its last word, or before a shape."""
    if "".join(pieces) in FRAME_NAMES:
        return True
    if pieces[0] in STATES:
        return False
    while len(pieces) > 1 and (pieces[-1] in SHAPES or pieces[-1].isdigit()):
        pieces = pieces[:-1]
    return pieces[-1] in FRAME_NAMES


def _names(attributes: str) -> tuple[set[str], set[str], bool, int]:
    """Words of class and id, roles, whether the element is hidden, and how its names mark it.

    That is 2 if a whole class or id is a frame name, 1 if one only ends like one, 0 if none does or if another one is
    a whole article name.
    """
    words: set[str] = set()
    named, main = 0, False
    roles: set[str] = set()
    hidden = False
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        if name.lower() in ("class", "id"):
            for part in value.split():
                pieces = _TOKEN.findall(part)
                words.update(pieces)
                words.add("".join(pieces))
                if pieces:
                    main |= "".join(pieces) in MAIN_NAMES
                    named = max(named, 2 if "".join(pieces) in FRAME_NAMES else int(_frame_name(pieces)))
        elif name.lower() == "role":
            roles.update(value.split())
        elif name.lower() == "hidden" or value == "true":
            hidden = True
    return words, roles, hidden, 0 if main else named


def blocks(source: str, by_name: bool = True) -> list[tuple[str, bool, int]]:
    """(text, inside a marked article, kind) of the page's blocks outside frame elements, in page order.

    The kind is 0 for text, ``LINKS`` for what is mostly links and ``HEADING`` for what ends in a heading element.

    Where the page marks no article by an element, containers named like one count; where it has neither, no block is
    marked. An article element is frame only if a whole class or id of it says so. Where class and id names would take
    all text of a page, they decide nothing (as without ``by_name``): no block is marked, and differencing decides.
    """
    out: list[list] = []
    stack: list[_Region] = []
    frame = strong = weak = linked = 0
    parts: list[str] = []
    in_links = headed = 0
    dropped = False

    def end_block():
        nonlocal in_links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append([text, strong > 0, weak > 0, LINKS if 2 * in_links > len(text) else HEADING if headed else 0])
            parts.clear()
        in_links = 0

    def add(raw: str):
        nonlocal in_links
        if raw and not frame:
            text = entities.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if linked:
                in_links += len(text)

    at, n = 0, len(source)
    while at < n:
        found = _MARKUP.search(source, at)
        if found is None:
            add(source[at:])
            break
        add(source[at:found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        closing, attributes = found.group(1), found.group(3)
        if name not in INLINE:
            if name == "br":
                if not frame:
                    parts.append(" ")
                continue
            end_block()
            headed = name in HEADINGS and not closing
            if not closing and stack and stack[-1].name in ("p", name) and stack[-1].name in ("p", "li", "td", "tr"):
                region = stack.pop()  # the end tag may be left out
                frame -= region.frame
                strong -= region.main == 2
                weak -= region.main == 1
        if name == "a":
            linked = 0 if closing else 1
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name == name:
                    end_block()
                    for region in stack[k:]:
                        frame -= region.frame
                        strong -= region.main == 2
                        weak -= region.main == 1
                    del stack[k:]
                    break
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            at = stop.end() if stop else (n if name in ("script", "style") else at)
            continue
        if name in VOID or attributes.endswith("/") and name not in ("div", "p", "section", "article", "main"):
            continue
        words, roles, hidden, named = _names(attributes) if attributes.strip() else (set(), set(), False, 0)
        is_main = 2 if name in ("article", "main") or roles & {"main", "article"} else 1 if words & MAIN_NAMES else 0
        top_header = name == "header" and not strong  # an article's own header holds its headline
        is_frame = name in FRAME or top_header or hidden or bool(roles & ROLES)
        if by_name and not is_frame and name not in ("html", "body", "main") and named > (name == "article"):
            is_frame = dropped = True
        # Every container is tracked, so that an unclosed one ends with what encloses it.
        if is_frame or is_main or name not in ("p", "li", "b", "i", "em", "strong", "span", "a", "td", "tr", "dt", "dd"):
            if is_frame and name in INLINE:
                end_block()
            stack.append(_Region(name, int(is_frame), 0 if is_frame else is_main))
            frame += int(is_frame)
            strong += not is_frame and is_main == 2
            weak += not is_frame and is_main == 1
    end_block()
    if dropped and not out:
        return [(t, False, kind) for t, _, kind in blocks(source, by_name=False)]
    any_strong, any_weak = any(b[1] for b in out), any(b[2] for b in out)
    return [(t, s if any_strong else w if any_weak else False, kind) for t, s, w, kind in out]


def aligned(a: list, b: list) -> set[int]:
    """Places in ``a`` that a longest common subsequence of the two lists takes."""
    known = set(a) & set(b)
    where = [i for i, x in enumerate(a) if x in known]
    left, right = [a[i] for i in where], [x for x in b if x in known]
    if not left:
        return set()
    masks: dict = {}
    for j, x in enumerate(right):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(right)) - 1
    rows, v = [], full
    for x in left:
        u = v & masks[x]
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    out, i, j = set(), len(left), len(right)
    while i and j:  # a clear bit is a column where the common length grows
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if i and not rows[i - 1] >> (j - 1) & 1:
            continue
        j -= 1
        out.add(where[i])
    return out


def main_text(own: list, near: list[list], own_words: int = 5, evidence: int = 1) -> str:
    """Text of a page's blocks after deleting what it shares with the pages of ``near`` that are not copies of it.

    ``near`` holds the blocks of its neighbours, nearest first. Both pages of a frame have text of their own in it. Where
    fewer than ``own_words`` words of text of either page are left over, one is a copy (or another address) of the other,
    and says nothing about the frame. An unmarked page loses what it shares with the first that is no copy.

    Of a marked article only its own blocks count, and its headings are kept. Two articles may well share a sentence, so a
    line of it goes only if all neighbours share it that are no copies and share no more than half of the article's
    words, if these are ``evidence`` pages or more, and if nothing else stands between it and an end of the article.
    """
    marked = any(b[1] for b in own)
    lines = [b[0] for b in own]

    def words(page: list, shared: set[int], inside: bool) -> int:
        """Words of text that the page does not share, or those that it shares."""
        article = any(b[1] for b in page)
        return sum(len(b[0].split()) for i, b in enumerate(page)
                   if (i in shared) == inside and not b[2] and (b[1] or not article))

    gone: set[int] | None = None
    seen = 0
    for other in near:
        shared = aligned(lines, [b[0] for b in other])
        if not shared:
            gone = None
            break
        theirs = aligned([b[0] for b in other], lines)
        if words(own, shared, False) < own_words or words(other, theirs, False) < own_words:
            continue
        if not marked:
            gone = shared
            break
        if words(own, shared, True) > words(own, shared, False):
            continue
        gone, seen = shared if gone is None else gone & shared, seen + 1
    gone = gone or set()
    if not marked:
        return " ".join(text for i, (text, _, _) in enumerate(own) if i not in gone)
    article = [i for i, b in enumerate(own) if b[1]]
    edges: set[int] = set()
    for side in (article, article[::-1]) if seen >= evidence else ():
        for i in side:
            if i not in gone and own[i][2] != HEADING:
                break
            edges.add(i)
    return " ".join(own[i][0] for i in article if i not in edges or i not in gone or own[i][2] == HEADING)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (lower case, without user and port) and path (without query, fragment and closing slash) of a URL."""
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*?)/?(?:[?#]|$)", 1)
    return host, path


#: Distinct pages of the host that a page is compared with, on either side; those it takes to cut a marked article.
NEIGHBOURS, EVIDENCE = 5, 5


def _cuts(keys: DataFrame, n: int) -> np.ndarray:
    """At most ``n - 1`` sorted cut points of the string ``key``: quantiles of a sample that grows with ``n``."""
    total = keys.count()
    rate = min(1.0, max(20_000, 20 * n) / max(1, total))
    picked = keys.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1).select("key").distinct()
    sample = np.sort(np.array([r.key for r in picked.limit(4 * max(20_000, 20 * n)).collect()], object))
    return np.unique(sample[(np.arange(1, n) * len(sample)) // n]) if len(sample) > 1 else sample[:0]


def _lent(keys: DataFrame) -> dict[str, list[int]]:
    """Keys of pages that ranges other than their own need, and those ranges.

    Each range tells its first and last few pages of distinct html; from the bounds of every range the nearest distinct
    ones are looked up beyond it, over as many ranges as that takes. What comes to the driver is a few keys per range.
    """
    most = NEIGHBOURS + 1
    ends = keys.groupBy("shard", "same").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    up, down = Window.partitionBy("shard").orderBy("first"), Window.partitionBy("shard").orderBy(F.desc("last"))
    sides = (ends.withColumn("end", F.row_number().over(up)).where(F.col("end") <= most).select(
                 "shard", F.col("first").alias("key"), "same", F.lit(True).alias("front"))
             .unionByName(ends.withColumn("end", F.row_number().over(down)).where(F.col("end") <= most).select(
                 "shard", F.col("last").alias("key"), "same", F.lit(False).alias("front"))))
    front: dict[int, list] = {}
    back: dict[int, list] = {}
    for r in sides.collect():
        (front if r.front else back).setdefault(r.shard, []).append((r.key, r.same))
    order = sorted(front)
    lent: dict[str, list[int]] = {}

    def look(shards: Iterable[int], ends: dict[int, list], falling: bool, to: int) -> None:
        seen: set[int] = set()
        for shard in shards:
            for key, same in sorted(ends[shard], reverse=falling):
                if same not in seen and len(seen) < most:
                    seen.add(same)
                    lent.setdefault(key, []).append(to)
            if len(seen) == most:
                return

    for k, shard in enumerate(order):
        look((order[j] for j in range(k - 1, -1, -1)), back, True, shard)
        look((order[j] for j in range(k + 1, len(order))), front, False, shard)
    return lent


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):  # noqa: B905 - the shorter path ends it
        if x != y:
            break
        n += 1
    return n


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` (empty if none) of every page.

    A page is compared with up to ``NEIGHBOURS`` pages of its host on either side, in the order of path, id and a hash
    of the html; of pages with equal html only the nearest counts, and one equal to the page itself does not. Pages are
    dealt into ranges of that order by one shuffle of the html; the pages at the ends that others beyond need are also
    sent there, so that the result does not depend on the ranges, and a host with a third of all pages is spread like
    any other. A null html is empty; a null or unreadable url is the empty host and path. Repeated rows are pages of
    their own, as are null ids. An empty table gives no rows.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    host, path = url_parts(url)
    source = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    # Codes below any printable character part the key, so hosts and paths sort as units.
    key = F.concat_ws("\x01", host, path, F.lpad(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), 20, " "),
                      F.hex(F.xxhash64(source)))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        host.alias("host"), path.alias("path"), source.alias("html"), F.xxhash64(source).alias("same"),
                        key.alias("key"))
    n = shuffle_partitions(spark)
    keys = pages.select(key.alias("key"), host.alias("host"), F.xxhash64(source).alias("same"))
    points = _cuts(keys, n)

    @F.pandas_udf(T.IntegerType())
    def shard_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, key.to_numpy(object), "right").astype(np.int32))

    lent = _lent(keys.withColumn("shard", shard_of("key")))

    @F.pandas_udf("array<int>")
    def dealt_to(key: pd.Series) -> pd.Series:
        own = np.searchsorted(points, key.to_numpy(object), "right").tolist()
        return pd.Series([[k, *lent.get(x, ())] for k, x in zip(own, key)])

    dealt = (rows.select("id", "url", "host", "path", "html", "same", "key", F.posexplode(dealt_to("key")).alias("lent", "at"))
             .repartitionById(len(points) + 1, "at").sortWithinPartitions("key", "url", "html")
             .select("id", "url", "host", "path", "html", "same", "lent"))
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType())])
    target = arrow_schema(schema)

    def run(batches):
        before: dict[int, dict] = {}  # the last distinct pages, nearest last
        waiting: deque[dict] = deque()  # pages that still look for pages behind them, in order

        def settled(page):
            near = [p for pair in itertools.zip_longest(page["before"], page["after"]) for p in pair if p is not None]
            near.sort(key=lambda p: -_common(p["path"], page["path"]))
            return page["id"], page["url"], main_text(page["blocks"], [p["blocks"] for p in near], evidence=EVIDENCE)

        def meet(page):
            """Takes the next page in; gives the pages that need nothing further.

            Whatever page lies before the last one of the same html has met that html, so the search goes back only so
            far, and a page takes part in as many steps as it finds others, however long a row of copies it waits in. Of
            two waiting pages the first has met as many, so those that are done stand at the front.
            """
            done = []
            if waiting and waiting[0]["host"] != page["host"]:
                done += waiting
                waiting.clear()
            for p in reversed(waiting):
                if page["same"] == p["same"] or page["same"] in p["seen"]:
                    break
                p["seen"].add(page["same"])
                p["after"].append(page)
            while waiting and len(waiting[0]["after"]) >= NEIGHBOURS:
                done.append(waiting.popleft())
            if not page["lent"]:
                page["before"] = [p for h, p in reversed(before.items())
                                  if h != page["same"] and p["host"] == page["host"]][:NEIGHBOURS]
                waiting.append({**page, "after": [], "seen": set()})
            before.pop(page["same"], None)
            before[page["same"]] = {k: page[k] for k in ("host", "path", "blocks")}
            if len(before) > NEIGHBOURS + 1:
                before.pop(next(iter(before)))
            return [settled(p) for p in done]

        def emit(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(target)],
                                              schema=target)

        for batch in batches:
            done = []
            columns = [c.to_pylist() for c in batch.columns]
            for values in zip(*columns, strict=True):
                page = dict(zip(("id", "url", "host", "path", "html", "same", "lent"), values, strict=True))
                source = page.pop("html")
                # Near copies share their blocks, so that a long row of them waits in little space.
                page["blocks"] = before[page["same"]]["blocks"] if page["same"] in before else blocks(source)
                done += meet(page)
            yield emit(done)
        yield emit([settled(p) for p in waiting])

    return dealt.mapInArrow(run, schema)
