"""Main text of web pages, by markup and by the suffix arrays of their hosts.

Markup cuts a page into blocks and tells what they are: plain parts of the
article, parts that are named as something else, and doubtful ones: blocks of
the article whose names are so in part (``share-price``), and blocks outside any
article. All but the plain parts form the page's token stream. The streams of a
host are put behind each other and their suffixes sorted; long runs of tokens
that distinct pages share are the host's boilerplate. Doubtful blocks lose what
these cover and keep their unique runs.

Plain parts of an article are not asked for: articles recur as copies on other
pages of a host, and menus and notices that occur once are no article.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_rows

#: A run of so many tokens on so many pages of a host is boilerplate.
RUN_TOKENS, RUN_PAGES = 6, 3
#: Tokens of one host that are sorted at a time; runs of hosts with more are counted together.
SORTED_TOKENS = 200_000

# Elements of HTML by what they mean here.
BLOCKS = frozenset("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav header footer aside form script style head title noscript template button select textarea dialog menu svg iframe object".split())
MAIN = frozenset(("article", "main"))
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form".split())
DROPPED_NAMES = frozenset("ad ads advert alert gdpr adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo promotion related replies share sharing sidebar social sponsor sponsored subscribe widget".split())
# Words of class names that say nothing of what a part is about.
PLAIN_NAMES = frozenset("area article articles aside bar block body bottom box btn button buttons card col column container content desktop fixed form global group holder icons inline inner item items large layer left line link links list main mobile more new outer page panel policy post posts primary reader readers right row secondary section signup site slot small sticky strip text thread title top unit user wrap wrapper".split())

PLAIN, DOUBTFUL, OUTSIDE, OTHER = range(4)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe|svg|template)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][\w:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


def _named(name: str, attributes: str, inside: bool) -> int:
    """OTHER if an element is named as something else than the article, DOUBTFUL if it is so in part, else PLAIN."""
    if name in DROPPED:
        return OTHER
    if not attributes or name in ("html", "body") or name in MAIN and not inside:
        return PLAIN
    found = PLAIN
    for key, *values in _ATTRIBUTE.findall(attributes):
        for own in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", unescape("".join(values))).lower().split():
            if key.lower() == "role":
                if own in DROPPED_ROLES:
                    return OTHER
                continue
            words = [w for w in re.split(r"[_\W\d]+", own) if w]
            if any(w in DROPPED_NAMES for w in words):
                if all(w in DROPPED_NAMES or w in PLAIN_NAMES for w in words):
                    return OTHER
                found = DOUBTFUL
    return found


def blocks_of(html: str) -> tuple[int, list[tuple[int, str]]]:
    """How many articles a page marks, none inside another, and its blocks of text as (what they are, text) in order."""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    lost: list[str] = []
    stack: list[str] = []
    other_at = doubt_at = main_at = articles = at = 0  # depths at which such a part began

    def end_block() -> None:
        for parts, kind in ((held, (DOUBTFUL if doubt_at else PLAIN) if main_at else OUTSIDE), (lost, OTHER)):
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((kind, text))

    def pop_to(depth: int) -> None:
        nonlocal other_at, doubt_at, main_at
        del stack[depth:]
        other_at, doubt_at, main_at = (0 if x > depth else x for x in (other_at, doubt_at, main_at))

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            (lost if other_at else held).append(html[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            end_block()
        if m[2]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth] == name:
                    pop_to(depth)
                    break
            continue
        if name in BLOCKS and stack:  # a block ends an open paragraph, an item the item before it
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth] == "p" or stack[depth] == name == "li":
                    pop_to(depth)
                    break
                if stack[depth] in BLOCKS:
                    break
        if name in VOID or (m[4] or "").endswith("/"):
            continue
        stack.append(name)
        if other_at:
            continue
        kind = _named(name, m[4] or "", main_at > 0)
        if kind == OTHER:
            other_at = len(stack)
        elif name in MAIN and not main_at:
            main_at, articles = len(stack), articles + 1
        elif kind == DOUBTFUL and main_at and not doubt_at and name in BLOCKS:
            doubt_at = len(stack)
    if at < len(html):
        (lost if other_at else held).append(html[at:])
    end_block()
    return articles, out


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the sorted suffixes, and how many tokens each shares with the one before it, by doubling prefixes."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    levels, have = [rank], 1
    while n and rank.max() < n - 1:
        second = np.full(n, -1, np.int64)
        second[: n - have] = rank[have:]
        rank = np.unique(rank * (n + 1) + second + 1, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
        have *= 2
    order = np.argsort(rank, kind="stable")
    shared = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero(b + shared[1:] < n)
        inside = inside[a[inside] + shared[1:][inside] < n]
        same = inside[levels[k][a[inside] + shared[1:][inside]] == levels[k][b[inside] + shared[1:][inside]]]
        shared[1:][same] += 1 << k
    return order, shared


_B = 0x9E3779B97F4A7C15


def _tokens(text: str) -> list[str]:
    """Words and, as tokens, the ends of blocks."""
    out: list[str] = []
    for k, block in enumerate(text.split("\n")):
        if k:
            out.append("\n")
        out += block.split(" ")
    return out


def _hashes(tokens: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in tokens), np.uint64, len(tokens))


def _run_hashes(h: np.ndarray) -> np.ndarray:
    """A hash of each run of RUN_TOKENS token hashes."""
    out = np.zeros(max(0, len(h) - RUN_TOKENS + 1), np.uint64)
    for k in range(RUN_TOKENS):
        out = out * np.uint64(_B) + h[k : k + len(out)]
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def shared_runs(pages: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of RUN_TOKENS tokens in the streams of some pages of a host, and on how many of these pages each is."""
    parts, page, at = [], [], 0
    for k, streams in enumerate(pages):
        for h in streams:
            parts += [h, np.array([at], np.uint64)]  # ends of streams are told apart below
            page.append(np.full(len(h) + 1, k))
            at += 1
    flat, page = np.concatenate(parts), np.concatenate(page)
    ends = np.cumsum([len(x) for x in parts])[1::2] - 1
    is_end = np.zeros(len(flat), bool)
    is_end[ends] = True
    ids = np.unique(flat, return_inverse=True)[1].astype(np.int64)
    ids[ends] = ids.max() + 1 + np.arange(len(ends))
    order, shared = suffix_array(ids)
    # suffixes that share RUN_TOKENS or more follow each other
    group = np.cumsum(shared < RUN_TOKENS)
    left = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(len(flat))
    whole = left[order] >= RUN_TOKENS
    order, group = order[whole], group[whole]
    if not len(order):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(group * (len(pages) + 1) + page[order])
    groups, count = np.unique(pairs // (len(pages) + 1), return_counts=True)
    first = order[np.searchsorted(group, groups)]
    return _run_hashes(flat)[first], count


def uncovered(blocks: list[str], boilerplate: np.ndarray) -> list[str]:
    """Each block without the tokens that boilerplate runs (their sorted hashes) cover."""
    if not len(boilerplate) or not blocks:
        return blocks
    tokens = _tokens("\n".join(blocks))
    runs = _run_hashes(_hashes(tokens))
    at = np.minimum(np.searchsorted(boilerplate, runs), len(boilerplate) - 1)
    covered = np.zeros(len(tokens), bool)
    for i in np.flatnonzero(boilerplate[at] == runs).tolist():
        covered[i : i + RUN_TOKENS] = True
    out: list[list[str]] = [[]]
    for w, gone in zip(tokens, covered.tolist()):
        if w == "\n":
            out.append([])
        elif not gone:
            out[-1].append(w)
    return [" ".join(x) for x in out]


def main_text(html: str, boilerplate: np.ndarray) -> str:
    """A page's main text, given the sorted hashes of its host's boilerplate runs.

    The article, where one is marked, else the blocks outside; and these too if
    there are several articles, as teasers are, with less text between them.
    """
    articles, blocks = blocks_of(html)
    kept = {PLAIN: [t for k, t in blocks if k == PLAIN]}
    for kind in (DOUBTFUL, OUTSIDE):
        kept[kind] = uncovered([t for k, t in blocks if k == kind], boilerplate)
    inside, outside = sum(map(len, kept[PLAIN])) + sum(map(len, kept[DOUBTFUL])), sum(map(len, kept[OUTSIDE]))
    wanted = (OUTSIDE,) if not articles or articles > 1 and outside > inside else (PLAIN, DOUBTFUL)
    each = {k: iter(v) for k, v in kept.items()}
    return "\n".join(t for t in (next(each[k]) for k, _ in blocks if k in wanted) if t)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars of every row; blocks of text are joined by line feeds.

    A null or empty page gives an empty text. Repeated rows give repeated
    results, but count as one page in the suffix arrays; pages without a url are
    of one host. An empty table gives an empty result. Pages are parsed twice, so
    that only the streams are written.
    """
    scratch = Scratch(pages.sparkSession, "html")
    d = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "://([^/?#]*)", 1))
    keyed = d.withColumns({"host": host, "key": F.xxhash64("html")})

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        for own_host, key, html in rows:
            _, blocks = blocks_of(html or "")
            doubt, outside, other = ("\n".join(t for k, t in blocks if k == kind) for kind in (DOUBTFUL, OUTSIDE, OTHER))
            if doubt or outside or other:
                yield own_host, key, doubt, outside, other

    streams = scratch.keep(map_rows(keyed, ["host", "key", "html"], "host string, key long, doubt string, outside string, other string", read))

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list[list[np.ndarray]] = []
        size, last, last_key = 0, None, None

        def flush() -> Iterator[tuple]:
            runs, n = shared_runs(held)
            yield from zip([last] * len(runs), runs.tolist(), n.tolist())

        for own_host, key, *texts in rows:
            if (own_host, key) == (last, last_key):
                continue
            if held and (own_host != last or size > SORTED_TOKENS):
                yield from flush()
                held, size = [], 0
            last, last_key = own_host, key
            held.append([_hashes(_tokens(t)) for t in texts if t])
            size += sum(map(len, held[-1]))
        if held:
            yield from flush()

    # a page is one row here, as copies meet in the same range
    ordered = streams.repartitionByRange("host", "key").sortWithinPartitions("host", "key")
    runs = map_rows(ordered, ["host", "key", "doubt", "outside", "other"], "host string, run long, pages long", count)
    common = scratch.keep(runs.groupBy("host", "run").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= RUN_PAGES).select("host", "run"))

    def asked(rows: Iterator[tuple]) -> Iterator[tuple]:
        for own_host, key, *texts in rows:
            for h in np.unique(np.concatenate([_run_hashes(_hashes(_tokens(t))) for t in texts])).tolist():
                yield own_host, key, h

    doubtful = streams.where("doubt <> '' or outside <> ''").dropDuplicates(["host", "key"])
    hits = map_rows(doubtful, ["host", "key", "doubt", "outside"], "host string, key long, run long", asked).join(common, ["host", "run"], "left_semi")
    hits = scratch.keep(hits.groupBy("host", "key").agg(F.sort_array(F.collect_list("run")).alias("runs")))

    def clean(rows: Iterator[tuple]) -> Iterator[tuple]:
        for i, url, html, own in rows:
            yield i, url, main_text(html or "", np.array(own or [], np.int64))

    joined = keyed.join(hits, ["host", "key"], "left")
    out = map_rows(joined, ["id", "url", "html", "runs"], f"id {d.schema['id'].dataType.simpleString()}, url string, text string", clean)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
