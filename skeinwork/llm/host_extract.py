r"""Main text of web pages: what the markup leaves open is decided by a suffix array over each host.

A page is read once, in linear time, into blocks of text. Navigation, headers, footers, asides, forms, scripts, notices,
adverts and comments go by element, role, class and id. A class or id counts as a whole or as a compound of known words, and takes
out no element around an article or main, nor one with most of the page's text; inside an article it always counts, and inside
main unless the page has no other article. Where a page says which part is the article (or main), its blocks are the text, and
`decided` is `markup`.

The token streams of all other text are concatenated by host: of marked pages what stands around the article (menus, notices and
adverts included), of the others everything. A suffix array finds the runs of RUN tokens or more that stand on PAGES distinct
pages of the host (pages with the same article are one page). A page that marks no article has its text from the host, and
`decided` is `host`: what such runs cover is boilerplate, the unique runs of each block stay.

The array is built in pieces: each Arrow batch sorts the suffixes of its pages' streams to a depth of RUN tokens and sends on
every distinct head with its number of pages; Spark adds these up by host and head. No host, however large, is brought together
in one task, and the result is that of one array over the whole host.

Inside a marked article nothing is removed, though the array could be run there too: tables of near copies and of passages that
many documents share would lose them (README), and the article is the answer asked for.

Cases: null html is empty and has an empty text; null url or one without a host is a host of its own; pages that repeat count
as one page; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, settled, slices, table
from .words import STEP, mix

RUN, PAGES = 6, 3

RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "plaintext"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROP = {"head", "nav", "footer", "aside", "form", "noscript", "template", "svg", "math", "button", "select", "option", "datalist", "object", "audio", "video", "canvas", "dialog", "menu"}
SECTION = {"html", "body", "article", "main", "div", "section", "nav", "header", "footer", "aside", "form", "table", "ul", "ol", "dl", "fieldset", "figure", "blockquote", "details", "tbody", "thead", "tfoot", "menu", "dialog"}
ITEM = {"p": SECTION, "li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "dt": {"dl"}, "dd": {"dl"}}
BLOCK = SECTION | set(ITEM) | {"h1", "h2", "h3", "h4", "h5", "h6", "pre", "address", "hr", "figcaption", "summary", "caption", "legend", "center", "hgroup"}
CLOSES_P = BLOCK - {"li", "tr", "td", "th", "dt", "dd", "tbody", "thead", "tfoot", "caption", "legend", "summary", "figcaption"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
MARKS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs",
    "sidebar", "footer", "cookie", "cookies", "consent", "gdpr", "notice", "banner", "newsletter", "subscribe", "signup", "popup", "modal", "overlay", "comment", "comments", "disqus",
    "replies", "respond", "related", "recommended", "share", "sharing", "social", "widget", "pagination", "pager", "masthead", "topbar", "toolbar", "skip", "login", "search", "alert",
}
#: Words that make a compound with a mark: site-footer, comment-list.
BESIDE = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "container", "content", "fixed", "form", "global", "group", "header", "icon", "icons", "inner", "item", "items", "left", "line", "link", "links",
    "list", "main", "media", "mobile", "page", "panel", "post", "posts", "primary", "right", "row", "secondary", "section", "side", "site", "slot", "sticky", "text", "title", "to", "top", "unit", "wrap", "wrapper",
}
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*+)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
MARKUP = re.compile(r"<(?=[a-zA-Z/!?])")
NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_TAG_SIGN = re.compile(r"[\"'>]")

HARD, SOFT = 2, 1
#: Level of what is left out of the text, and the mark of its pieces.
ASIDE, OUT = -1, -2


def _marked(value: str, inside: int) -> bool:
    """Whether one of the names in a class or id is a mark, or a compound of marks and words beside them."""
    for name in value.split():
        parts = [x for x in re.split(r"[_-]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if x]
        marks = [x in MARKS or x == "header" and not inside for x in parts]
        if any(marks) and all(m or x in BESIDE or x[0].isdigit() for x, m in zip(parts, marks)):
            return True
    return False


def _excluded(name: str, attributes: str, inside: int, nested: bool = False) -> int:
    """HARD if an element's own tag takes it out of the text, SOFT if only its class or id does; nested tells of an article inside an article."""
    if name in DROP or name == "header" and not inside:
        return HARD
    if not attributes or name in ("html", "body", "main") or name == "article" and not nested:
        return 0
    soft = 0
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return HARD
        if key == "role" and value.lower() in ROLES:
            return HARD
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return HARD
        if key in ("class", "id") and _marked(value, inside):
            soft = SOFT
    return soft


def _tag_end(html: str, a: int, last: dict[str, int]) -> int:
    """The > that ends the tag at a; one inside a value in quotes doesn't. -1 if there is none."""
    at = a
    while m := _TAG_SIGN.search(html, at):
        sign, at = m.group(), m.end()
        if sign == ">":
            return m.start()
        if last[sign] >= at and html[max(a, m.start() - 64) : m.start()].rstrip().endswith("="):
            at = html.find(sign, at) + 1
    return -1


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(level, text) of the page's blocks in order: 2 in an article, 1 in main, 0 elsewhere, ASIDE for what is excluded."""
    html = html or ""
    out: list[tuple[int, list[tuple[str, int]]]] = []
    stack: list[tuple[str, int, bool, int]] = []  # name, level, excluded, innermost soft element or -1
    soft: list[list] = []  # outer soft element, level around it, whether it holds an article or main
    open_: Counter = Counter()
    held: list[tuple[str, int]] = []
    last = {q: html.rfind(q) for q in "\"'"}
    loose = False

    def flush() -> None:
        nonlocal held
        if held:
            out.append((stack[-1][1] if stack else 0, held))
            held = []

    def pop(to: int) -> None:
        for name, *_ in stack[to:]:
            open_[name] -= 1
        del stack[to:]

    def close(name: str, stop: set[str]) -> None:
        """Pops to the innermost open element of this name, unless an element of stop is nearer."""
        if open_[name] > 0:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop(i)
                    return
                if stack[i][0] in stop:
                    return

    at, n = 0, len(html)
    while at < n:
        m = MARKUP.search(html, at)
        a = m.start() if m else n
        if a > at:
            held.append((html[at:a], -1 if not stack else OUT if stack[-1][2] else stack[-1][3]))
        if not m:
            break
        if html.startswith("<!--", a):
            end = html.find("-->", a + 4)
            at = n if end < 0 else end + 3
            continue
        end = html.find(">", a) if loose else _tag_end(html, a, last)
        if end < 0 and not loose:  # quotes that don't pair off: from here on any > ends a tag
            loose, end = True, html.find(">", a)
        if end < 0:
            break
        at = end + 1
        if html[a + 1] in "!?":
            continue
        shut = html[a + 1] == "/"
        found = NAME.match(html, a + 1 + shut)
        if not found or found.end() > end:
            continue
        name = found.group().lower()
        if shut:
            if name in BLOCK:
                flush()
                close(name, SECTION if name not in SECTION else set())
            else:
                close(name, BLOCK)
            continue
        if name in RAW:
            tail = re.compile(f"</{name}", re.I).search(html, at)
            at = n if not tail else max(html.find(">", tail.start()) + 1, tail.end())
            continue
        if name in BLOCK:
            flush()
            if name in CLOSES_P:
                close("p", SECTION)
            if name in ITEM and name != "p":
                close(name, ITEM[name])
        elif name == "br":
            held.append((" ", held[-1][1] if held else -1))
        if name in VOID:
            continue
        level, excluded, around = stack[-1][1:] if stack else (0, False, -1)
        outer = level
        attributes = html[found.end() : end]
        if name == "article":
            level = 2
        elif name == "main" or re.search(r"role\s*=\s*[\"']?main\b", attributes):
            level = max(level, 1)
        elif "articleBody" in attributes:
            level = 2
        how = _excluded(name, attributes, level, outer == 2)
        excluded = excluded or how == HARD
        if not excluded and (level > outer or name in ("article", "main")):
            x = around
            while x >= 0 and not soft[x][2]:
                soft[x][2] = True
                x = soft[x][0]
        if how == SOFT and not excluded and (not attributes.endswith("/") or name in BLOCK):
            # An element that is itself marked as the article is not taken out by its class.
            soft.append([around, outer, level > outer])
            around = len(soft) - 1
        if not attributes.endswith("/") or name in BLOCK:
            stack.append((name, level, excluded, around))
            open_[name] += 1
    flush()
    return _settle(out, soft)


def _settle(found: list[tuple[int, list[tuple[str, int]]]], soft: list[list]) -> list[tuple[int, str]]:
    """The blocks; the soft elements that stay excluded are ASIDE."""
    chars, whole, plain = [0] * len(soft), 0, False
    for level, held in found:
        for text, x in held:
            if x == OUT:
                continue
            n = len("".join(text.split()))
            whole += n
            plain |= level == 2 and x < 0 and n > 0
            if x >= 0:
                chars[x] += n
    for x in range(len(soft) - 1, -1, -1):
        if soft[x][0] >= 0:
            chars[soft[x][0]] += chars[x]
    gone = []
    for x, (outer, level, holds) in enumerate(soft):
        spared = level == 0 and (holds or 2 * chars[x] > whole) or level == 1 and holds and not plain
        gone.append(not spared or outer >= 0 and gone[outer])
    out = []
    for level, held in found:
        aside = [x == OUT or x >= 0 and gone[x] for _, x in held]
        for at, here in ((level, False), (ASIDE, True)):
            if here in aside and (text := " ".join(unescape("".join(t for (t, _), g in zip(held, aside) if g == here)).split())):
                out.append((at, text))
    return out


def main_text(html: str | None) -> tuple[str | None, list[str]]:
    """(text, all other blocks) where markup settles it or there is none, else (None, the open blocks)."""
    found = blocks(html)
    top = max((level for level, _ in found), default=ASIDE)
    own = [text for level, text in found if level == top]
    if top == 0:
        return None, own
    return ("\n".join(own) if top > 0 else ""), [text for level, text in found if level != top or top < 0]


def suffix_array(tokens: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling on whole arrays; in order of their first `depth` tokens at least, if given."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while n and k < n and (depth is None or k < depth) and rank.max() < n - 1:
        second = np.full(n, -1, dtype=np.int64)
        second[: n - k] = rank[k:]
        order = np.lexsort((second, rank))
        a, b = rank[order], second[order]
        new = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        k *= 2
    return order


def heads(tokens: np.ndarray, page: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(start of one suffix, number of distinct pages) for every distinct head of `run` tokens. tokens: the pages' streams, each followed by a token of its own page, which no other stream has."""
    n = len(tokens) - run + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    order = suffix_array(tokens, run)
    inside = page[: n] == page[run - 1 :]  # heads that lie in one stream, its end left out
    inside &= ~_ends(page)[run - 1 :]
    order = order[order < n]
    order = order[inside[order]]
    if not len(order):
        return order, order
    a, b = order[:-1], order[1:]
    same = np.ones(len(order) - 1, dtype=bool)
    for j in range(run):  # neighbours in the array with a common prefix of `run` tokens
        same &= tokens[a + j] == tokens[b + j]
    group = np.concatenate([[0], np.cumsum(~same)])
    by = np.lexsort((page[order], group))
    g, p = group[by], page[order][by]
    fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (p[1:] != p[:-1])])
    return order[np.concatenate([[True], ~same])], np.bincount(g[fresh])


def _ends(page: np.ndarray) -> np.ndarray:
    """Which tokens are the last of their stream."""
    return np.concatenate([page[1:] != page[:-1], [True]]) if len(page) else np.zeros(0, dtype=bool)


def _unique_runs(parts: list[list[str]], covered: np.ndarray) -> str:
    out, at = [], 0
    for words in parts:
        keep = [w for w, c in zip(words, covered[at : at + len(words)]) if not c]
        at += len(words)
        if keep:
            out.append(" ".join(keep))
    return "\n".join(out)


def word_hashes(words: list[str]) -> np.ndarray:
    known: dict[str, int] = {}
    for w in words:
        if w not in known:
            known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))


def head_hashes(h: np.ndarray, run: int = RUN) -> np.ndarray:
    """One hash for every `run` tokens in a row."""
    n = len(h) - run + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    out = h[:n].copy()
    for j in range(1, run):
        out *= STEP
        out += h[j : j + n]
    return mix(out).astype(np.int64)


def _page_words(parts: list[str]) -> list[str]:
    return [w for b in parts for w in b.split(" ")]


def _pieces(batch):
    """(host, head, pages) of the suffix arrays of some pages' streams, a host's streams in one array."""
    hosts, streams = batch.column(0).to_pylist(), [_page_words(p) for p in batch.column(1).to_pylist()]
    by: dict[str, list[int]] = {}
    for i, h in enumerate(hosts):
        by.setdefault(h, []).append(i)
    for host, rows in by.items():
        for a, b in slices([streams[i] for i in rows], 1 << 18):
            words, page = [], []
            for i in rows[a:b]:
                words += streams[i]
                words.append(f"\0{i}")
                page += [i] * (len(streams[i]) + 1)
            h, page = word_hashes(words), np.array(page)
            start, n = heads(h, page)
            if len(start):
                yield pa.RecordBatch.from_arrays([pa.array([host] * len(start), pa.string()), pa.array(head_hashes(h)[start]), pa.array(n.astype(np.int64))], names=["host", "head", "n"])


def _page_heads(batch):
    host, key, found = [], [], []
    for h, k, parts in zip(*(batch.column(i).to_pylist() for i in range(3))):
        own = np.unique(head_hashes(word_hashes(_page_words(parts))))
        host += [h] * len(own)
        key += [k] * len(own)
        found.append(own)
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(key, pa.string()), pa.array(np.concatenate(found))], names=["host", "key", "head"])


def _page_unique(batch):
    keys, texts = batch.column(0).to_pylist(), []
    for parts, common in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        split = [b.split(" ") for b in parts]
        words = [w for p in split for w in p]
        covered = np.zeros(len(words), dtype=bool)
        for start in np.flatnonzero(np.isin(head_hashes(word_hashes(words)), np.array(common or [], dtype=np.int64))):
            covered[start : start + RUN] = True
        texts.append(_unique_runs(split, covered))
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(texts, pa.string())], names=["key", "text"])


def _key(*parts: str) -> str:
    return hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _streams(batch):
    """host, key (the same for pages of one article or, without one, of one text), whether the host decides, the blocks of the stream, and the text that the markup gives."""
    keys, open_, parts, texts = [], [], [], []
    for html in batch.column(3).to_pylist():
        text, others = main_text(html)
        texts.append(text)
        keys.append(_key("article", text) if text else _key("open" if text is None else "none", *others))
        open_.append(text is None)
        parts.append(others)
    yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(keys), pa.array(open_), pa.array(parts, pa.list_(pa.string())), pa.array(texts, pa.string())], names=["page_id", "url", "host", "key", "open", "parts", "text"])


def extract(pages: DataFrame, least: int = PAGES) -> DataFrame:
    """page_id, url, text, n_chars, decided of every page. `least`: distinct pages of a host that make a run boilerplate."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    # Pages are parsed once, which costs more than writing what is kept of them. Of pages with one article the least stream counts, so that reruns agree.
    held = settled(map_arrow(pages.select("page_id", "url", host.alias("host"), "html"), _streams, "page_id long, url string, host string, key string, open boolean, parts array<string>, text string"))
    streams = held.groupBy("host", "key").agg(F.min("parts").alias("parts"), F.max("open").alias("open"))
    pieces = map_arrow(streams.select("host", "parts"), _pieces, "host string, head long, n long")
    common = pieces.groupBy("host", "head").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("host", "head")
    waiting = held.where("open").dropDuplicates(["host", "key"]).select("host", "key", "parts")
    found = map_arrow(waiting, _page_heads, "host string, key string, head long").join(common, ["host", "head"]).groupBy("host", "key").agg(F.collect_set("head").alias("common"))
    keyed = waiting.join(found, ["host", "key"], "left").select(F.concat_ws(" ", "key", "host").alias("key"), "parts", "common")
    solved = map_arrow(keyed, _page_unique, "key string, text string")
    rest = held.where("open").select("page_id", "url", F.concat_ws(" ", "key", "host").alias("key")).join(solved, "key").select("page_id", "url", "text", F.lit("host").alias("decided"))
    marked = held.where(~F.col("open")).select("page_id", "url", "text", F.lit("markup").alias("decided"))
    return marked.union(rest).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "decided")


def op5_host_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
