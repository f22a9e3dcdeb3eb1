"""Main text of web pages by wrappers: union-free expressions inferred per host.

A page is a tree of block tags with text slots, and so is a wrapper: a node is told by its path
from the root, one that some pages lack is optional, one that a page has several times is
repeated, and a slot whose text differs between pages varies. Merging two such trees is adding
up by path, so a host's wrapper is an aggregate over (host, path) in which no task holds more
than a part of the pages. The wrapper accepts every page of the host, up to rare paths; it tells
which slots are the same on all pages, and with the path of tags above a slot that decides what
is main text.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import slices, table, whole

# HTML elements by role.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe".split())
# Other names for tags hold there, and a slash closes an element.
FOREIGN = frozenset({"svg", "math"})
CHROME = frozenset("nav header footer aside form menu dialog button fieldset head select".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Names in class, id and role that mark a part as not the article, and as the article.
BOILERPLATE = frozenset("ad ads advert advertisement adverts sponsor sponsored promo promotion banner cookie cookies consent notice notices alert popup modal overlay sidebar side menu nav navbar navigation breadcrumb breadcrumbs header footer masthead comment comments commentlist disqus reply replies respond share sharing social related recommended newsletter subscribe subscription signup login pagination pager widget toolbar search complementary contentinfo".split())
ARTICLE = frozenset("article content post entry story articlebody maincontent postcontent entrycontent articlecontent".split())
MEANT = BOILERPLATE | ARTICLE | {"main", "related", "!hidden"}
# How a choice weighs: the rank of text outside containers, the part of the heaviest holder's weight
# that makes another one main text, and the pages on which a container's slot must be the same.
BARE, NEAR, SURE = 0.25, 0.25, 3
MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


def host_of(url: Column) -> Column:
    """The host in lower case; a null or odd url gives an empty one."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _signature(tag: str, attributes: str) -> str:
    """A tag with the names in its class, id and role, sorted. Numbers at a name's end are left
    out, and so are names with digits elsewhere: they number pages."""
    words = {w for m in NAMED.finditer(attributes) for n in re.findall(r"[a-z0-9]+", (m[2] or m[3] or m[4] or "").lower()) if (w := n.rstrip("0123456789")).isalpha()}
    if HIDDEN.search(attributes):
        words.add("!hidden")
    return ".".join([tag, *sorted(words)])


def tokens(page: str) -> list[tuple[str, str]]:
    """(path, text) of the page's blocks in order: the path of block tags above it, from the
    root. Inline tags are part of the text, raw elements are left out, and tags that HTML closes
    without a mark are closed."""
    blocks: list[tuple[str, str]] = []
    stack: list[str] = []
    text: list[str] = []
    at, n = 0, len(page)

    def flush() -> None:
        joined = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if joined:
            blocks.append(("/".join(stack), joined))

    def close(names: set[str] | frozenset[str], within: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            tag = stack[i].split(".", 1)[0]
            if tag in names:
                del stack[i:]
                return
            if tag in within:
                return

    while at < n:
        m = MARK.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        text.append(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        slashed = m[3].rstrip().endswith("/")
        if slashed and not m[1] and any(step.split(".", 1)[0] in FOREIGN for step in stack):
            flush()
        elif tag in RAW and not m[1]:
            flush()
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
        elif tag == "br":
            text.append(" ")
        elif tag in INLINE:
            if not m[1] and (marks := _signature(tag, m[3])) != tag and ("!hidden" in marks or set(marks.split(".")) & BOILERPLATE):
                flush()
                stack.append(marks)
            elif m[1] and stack and stack[-1].split(".", 1)[0] == tag:
                flush()
                stack.pop()
        else:
            flush()
            if m[1]:
                close({tag})
            else:
                if tag in CLOSES_P:
                    close({"p"}, frozenset({"td", "th", "button", "object"}))
                if tag in SELF_CLOSING:
                    close(SELF_CLOSING[tag], frozenset({"ul", "ol", "dl", "table", "select"}))
                if tag not in VOID and not slashed:
                    stack.append(_signature(tag, m[3]))
    flush()
    return blocks


@lru_cache(1 << 14)
def plain(path: str) -> str:
    """The path with the names that have a meaning of their own: for one that few pages have."""
    kept = []
    for step in path.split("/"):
        tag, *names = step.split(".")
        kept.append(".".join([tag, *(w for w in names if w in MEANT)]))
    return "/".join(kept)


@lru_cache(1 << 14)
def excluded(path: str) -> bool:
    """Is something above the slot no part of an article?"""
    for step in path.split("/"):
        tag, *names = step.split(".")
        if tag in CHROME or "!hidden" in names or (BOILERPLATE & set(names) and tag not in ("html", "body", "article", "main")):
            return True
        if tag in ("article", "section", "main") and {"comment", "comments", "related", "ad", "sponsored", "reply"} & set(names):
            return True
    return False


@lru_cache(1 << 14)
def container(path: str) -> int:
    """How surely the path says article: 3 article, 2 main, 1 a name such as content, 0 not."""
    rank = 0
    for step in path.split("/"):
        tag, *names = step.split(".")
        rank = max(rank, 3 if tag == "article" else 2 if tag == "main" or "main" in names else 1 if ARTICLE & set(names) else 0)
    return rank


@lru_cache(1 << 14)
def holder(path: str) -> str:
    """The part of the page that a slot is in: down to the first article, else down to the first
    other container, else ""."""
    steps = path.split("/")
    of_rank = [k for k, step in enumerate(steps) if container(step)]
    articles = [k for k in of_rank if container(steps[k]) == 3]
    return "/".join(steps[:(articles or of_rank)[0] + 1]) if of_rank else ""


def chosen(wrapper: list[dict]) -> set[str]:
    """Paths of main text. Slots are weighed by what varies in them, by holder: its characters
    a page, times the rank of its container. The heaviest holder has main text, with those
    around it and those of at least `NEAR` of its weight; in a holder that has a container
    a slot must be the same on `SURE` pages to be left out. Where nothing varies all is kept."""
    left = [u for u in wrapper if not excluded(u["path"])]
    varying = [u for u in left if u["varies"] or container(u["path"]) and u["pages"] < SURE] or left
    chars: dict[str, int] = {}
    pages: dict[str, int] = {}
    for u in varying:
        h = holder(u["path"])
        chars[h], pages[h] = chars.get(h, 0) + u["chars"], max(pages.get(h, 0), u["pages"])
    weight = {h: chars[h] / pages[h] * (container(h) or BARE) for h in chars}
    top = max(sorted(weight), key=weight.__getitem__, default="")
    main = {h for h in weight if h == top or h and (weight[h] >= NEAR * weight[top])}
    main |= {h for h in weight if h and any(m.startswith(h + "/") for m in main)}
    return {u["path"] for u in varying if holder(u["path"]) in main}


def by_itself(blocks: list[tuple[str, str]]) -> set[str]:
    """Paths of main text of a page that is judged alone: all that it has counts as varying."""
    chars: dict[str, int] = {}
    for p, t in blocks:
        chars[p] = chars.get(p, 0) + len(t)
    return chosen([{"path": p, "pages": 1, "chars": n, "varies": True} for p, n in chars.items()])


def decided(page: str, known: dict[str, int]) -> tuple[str, str]:
    """Main text and what decided: "wrapper", "both", or "page" where the host has no wrapper or
    the wrapper chooses nothing of the page. A path that the wrapper lacks goes by the page."""
    blocks = tokens(page)
    says = [known.get(p, known.get(plain(p))) for p, _ in blocks]
    own = by_itself(blocks) if None in says or 1 not in says else set()
    if 1 not in says:
        return " ".join(t for p, t in blocks if p in own), "page"
    text = " ".join(t for (p, t), s in zip(blocks, says, strict=True) if s or s is None and p in own)
    return text, "both" if None in says else "wrapper"


def extract(page: str, known: dict[str, int]) -> str:
    """Main text under a wrapper's choice."""
    return decided(page, known)[0]


# A wrapper has the paths of at least this many pages and this part of the host's pages, so its
# size follows that of a page and not the number of pages.
LEAST_PAGES, LEAST_SHARE = 2, 0.01
EVERY = "*"  # counts the pages of a host; it is no path


def slots(page: str) -> dict[str, tuple[int, int, int]]:
    """Checksum of the text, its length and the number of blocks of each path, and of each
    path's plain form."""
    found: dict[str, tuple[int, int, int]] = {}
    for path, text in tokens(page):
        for p in {path, plain(path)}:
            crc, chars, n = found.get(p, (0, 0, 0))
            found[p] = (zlib.crc32(text.encode(), crc), chars + len(text), n + 1)
    return found


def infer(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, paths (JSON object: the wrapper's paths, and 1 for those of main text) and wrapper
    (JSON list of path, pages, chars, optional, repeated, varies), for hosts of several pages.

    Slots are summed by host and path before and after one shuffle; what few pages have is
    left out before a host's paths meet.
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_html"):
            rows: dict[tuple[str, str], list[int]] = {}
            for host, page in zip(b["_host"].to_pylist(), b["_html"].to_pylist(), strict=True):
                of_page = zlib.crc32(page.encode())
                for path, (crc, chars, n) in [*slots(page).items(), (EVERY, (0, 0, 0))]:
                    r = rows.setdefault((host, path), [0, 0, crc, crc, of_page, of_page, 0])
                    r[:] = r[0] + 1, r[1] + chars, min(r[2], crc), max(r[3], crc), min(r[4], of_page), max(r[5], of_page), max(r[6], n)
            columns = list(zip(*rows.values(), strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in rows], pa.string()), pa.array([p for _, p in rows], pa.string()),
                 *(pa.array(c, pa.int64()) for c in columns)],
                ["host", "path", "pages", "chars", "low", "high", "low_page", "high_page", "most"])

    found = pages.select(host_of(F.col(url_col)).alias("_host"), whole(html_col).alias("_html")).mapInArrow(
        sums, "host string, path string, pages long, chars long, low long, high long, low_page long, high_page long, most long")
    # A path's texts are the same on all its pages exactly when least and largest agree; copies
    # of one page tell nothing about its slots, which then count as varying.
    summed = table(found.groupBy("host", "path").agg(
        F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_page").alias("low_page"), F.max("high_page").alias("high_page"), F.max("most").alias("most")).filter(F.col("pages") >= LEAST_PAGES), "slots")
    kept = summed.filter(F.col("path") != EVERY).join(
        summed.filter(F.col("path") == EVERY).select("host", F.col("pages").alias("total")), "host"
    ).filter(F.col("pages") >= F.col("total") * LEAST_SHARE)

    def choose(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        wrapper = [
            {"path": r.path, "pages": int(r.pages), "chars": int(r.chars), "optional": bool(r.pages < r.total), "repeated": bool(r.most > 1), "varies": bool(r.low != r.high or r.low_page == r.high_page)}
            for r in group.sort_values("path").itertuples()]
        of_main = chosen(wrapper)
        paths = {u["path"]: int(u["path"] in of_main) for u in wrapper}
        return pd.DataFrame({"host": [key[0]], "paths": [json.dumps(paths)], "wrapper": [json.dumps(wrapper)]})

    return kept.groupBy("host").applyInPandas(choose, "host string, paths string, wrapper string")


@lru_cache(4096)
def known_paths(paths: str | None) -> dict[str, int]:
    return json.loads(paths or "{}")


BROADCAST_BYTES = 32 << 20


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text (empty if none), n_chars, per row of pages.

    A null page is empty; a null url belongs to a host of its own; repeated rows repeat; other
    columns are not read; an empty table gives none. The hosts' choices are broadcast where
    their total size, which is computed first, is under 32 MB, and joined by host otherwise.
    """
    chosen_ = table(infer(pages, url_col, html_col).select(F.col("host").alias("_host"), F.col("paths").alias("_paths")), "wrappers")
    size = chosen_.agg(F.sum(F.length("_paths") + F.length("_host") + 64)).first()[0] or 0
    rows = pages.select(id_col, url_col, host_of(F.col(url_col)).alias("_host"), whole(html_col).alias("_html"))
    joined = rows.join(F.broadcast(chosen_) if size < BROADCAST_BYTES else chosen_, "_host", "left").select(id_col, url_col, "_html", "_paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_html"):
            texts = [extract(h, known_paths(p)) for h, p in zip(b["_html"].to_pylist(), b["_paths"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b[id_col], b[url_col], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [id_col, url_col, "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return joined.mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
