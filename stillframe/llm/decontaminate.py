"""Benchmark decontamination by the q-gram lemma in diagonal bands.

Item and document are compared as characters, lower-cased and with white space
as single spaces. An item of L characters that occurs with at most e edits
shares at least L - q + 1 - q * e q-grams with the document, on diagonals that
differ by at most e. Diagonals are dealt into blocks of e + 1; any such run of
diagonals lies in two neighbouring blocks. Bands of two blocks with enough
shared q-grams are candidates, and a banded alignment decides. Items too short
for a q-gram of 12 at their number of edits have shorter ones, down to the item
itself, so that each is found with all the edits that the rate allows it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

Q, EDIT_RATE = 12, 0.05
#: Items are indexed and sent to the executors in blocks of about so many characters.
BLOCK_CHARS = 1_000_000

_B = 0x100000001B3
_K = np.uint64(0x9E3779B97F4A7C15)
#: Hits that are expanded to item positions at a time.
_SLICE = 50_000


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(points: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of all runs of ``q`` characters, put together from runs of powers of two."""
    n = len(points) - q + 1
    run, size, out, have = points.astype(np.uint64), 1, np.zeros(n, np.uint64), 0
    while True:
        if q & size:
            out = out * np.uint64(pow(_B, size, 1 << 64)) + run[have : have + n]
            have += size
        if have == q:
            return out * _K
        run = run[:-size] * np.uint64(pow(_B, size, 1 << 64)) + run[size:]
        size *= 2


def q_of(length: int, edits: int) -> int:
    """The q-grams of an item: Q, or the longest of which ``edits`` must leave one whole."""
    return min(Q, length // (edits + 1))


@dataclass
class Index:
    """Items of one q with a bitmap over their q-grams' hashes and the places of each q-gram."""

    q: int
    ids: list
    texts: list[str]
    edits: np.ndarray
    least: np.ndarray
    shift: np.uint64
    bitmap: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray


def build(items: list[tuple], edit_rate: float = EDIT_RATE) -> list[Index]:
    """Indexes of ``(id, text)`` items, one for each q; items without a character are left out."""
    by: dict[int, set] = {}
    for i, t in ((i, normalise(t)) for i, t in items):
        if t:
            by.setdefault(q_of(len(t), int(len(t) * edit_rate)), set()).add((i, t))
    return [_build(q, sorted(own, key=lambda x: (x[1], str(x[0]))), edit_rate) for q, own in sorted(by.items())]


def _build(q: int, kept: list[tuple], edit_rate: float) -> Index:
    lengths = np.array([len(t) for _, t in kept], np.int64)
    edits = (lengths * edit_rate).astype(np.int64)
    hashes = [_grams(_points(t), q) for _, t in kept]
    every = np.concatenate(hashes)
    item = np.repeat(np.arange(len(kept)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes])
    order = np.argsort(every, kind="stable")
    grams, first = np.unique(every[order], return_index=True)
    bits = max(10, math.ceil(math.log2(max(1, len(grams)) * 64)))
    bitmap = np.zeros(1 << bits, bool)
    bitmap[grams >> np.uint64(64 - bits)] = True
    return Index(q, [i for i, _ in kept], [t for _, t in kept], edits, lengths - q + 1 - q * edits, np.uint64(64 - bits), bitmap, grams, np.append(first, len(every)), item[order], place[order])


def align(item: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int, int]:
    """Least edits between ``item`` and a stretch of ``text`` on the ``width`` diagonals from ``low`` on, and the stretch.

    A cell holds edits and, below them, the diagonal on which its path began.
    """
    unit = 1 << 16
    steps = np.arange(width) * unit
    text = np.concatenate((np.zeros(max(0, -low), np.uint32), text, np.zeros(max(0, low + width + len(item) - len(text)), np.uint32)))
    at = max(low, 0)
    cells = np.arange(width, dtype=np.int64)
    # a path may begin only inside the text
    cells[np.arange(width) + low < 0] += unit * (len(item) + 1)
    for i, c in enumerate(item):
        cost = cells + unit * (text[at + i : at + i + width] != c)
        cost[:-1] = np.minimum(cost[:-1], cells[1:] + unit)
        cells = np.minimum.accumulate(cost - steps) + steps
    best = int(cells.argmin())
    edits, begun = divmod(int(cells[best]), unit)
    return edits, low + begun, low + len(item) + best


def found_in(text: str, indexes: list[Index]) -> Iterator[tuple]:
    """``(item id, begin, end, edits)`` of every occurrence of an item of any index in a normalised text."""
    points = _points(text)
    for index in indexes:
        for i, a, b, edits in matches(text, points, index):
            yield index.ids[i], a, b, edits


def _stands_alone(text: str, a: int, b: int) -> bool:
    return not (a and text[a].isalnum() and text[a - 1].isalnum()) and not (b < len(text) and text[b - 1].isalnum() and text[b].isalnum())


def matches(text: str, points: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    """``(item, begin, end, edits)`` of every occurrence of an item in a normalised text; of overlapping ones of one item the best.

    Items under Q characters must be whole words of the text, as their letters
    alone stand in many others.
    """
    if len(text) < index.q:
        return []
    h = _grams(points, index.q)
    hit = np.flatnonzero(index.bitmap[h >> index.shift])
    if not len(hit):
        return []
    g = np.searchsorted(index.grams, h[hit])
    g[g == len(index.grams)] = 0
    same = index.grams[g] == h[hit]
    hit, g = hit[same], g[same]
    span, longest, counts = 1 << 40, max(map(len, index.texts)), {}
    keys_of = []
    for at in range(0, len(hit), _SLICE):
        begin, many = index.first[g[at : at + _SLICE]], np.diff(index.first)[g[at : at + _SLICE]]
        k = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item = index.item[k]
        diagonal = np.repeat(hit[at : at + _SLICE], many) - index.place[k] + longest
        keys_of.append(np.unique(item * span + diagonal // (index.edits[item] + 1), return_counts=True))
    if not keys_of:
        return []
    if len(keys_of) == 1:
        keys, n = keys_of[0]
    else:
        for ks, ns in keys_of:
            for a, b in zip(ks.tolist(), ns.tolist()):
                counts[a] = counts.get(a, 0) + b
        keys = np.array(sorted(counts))
        n = np.array([counts[a] for a in keys.tolist()])
    # bands of a block and the one after it; a block without its predecessor also forms one with that
    after = np.zeros_like(n)
    nxt = np.searchsorted(keys, keys + 1)
    ok = nxt < len(keys)
    ok[ok] = keys[nxt[ok]] == keys[ok] + 1
    after[ok] = n[nxt[ok]]
    found = []
    for key in keys[n + after >= index.least[keys // span]].tolist():
        i, block = divmod(key, span)
        e = int(index.edits[i])
        low, width, want = block * (e + 1) - longest - e, 2 * (e + 1) + 2 * e, index.texts[i]
        begin = text.find(want, max(0, low), max(0, low + width + len(want)))
        if len(want) < Q:  # without edits the band is that of one diagonal and its neighbour
            while 0 <= begin and not _stands_alone(text, begin, begin + len(want)):
                begin = text.find(want, begin + 1, max(0, low + width + len(want)))
            if begin >= 0:
                found.append((0, i, begin, begin + len(want)))
            continue
        if begin >= 0:
            found.append((0, i, begin, begin + len(want)))
            continue
        edits, a, b = align(_points(want), points, low, width)
        if edits <= e:
            found.append((edits, i, a, min(b, len(text))))
    kept: list[tuple[int, int, int, int]] = []
    for edits, i, a, b in sorted(set(found)):
        if not any(i == k and a < d and c < b for k, c, d, _ in kept):
            kept.append((i, a, b, edits))
    return sorted(kept)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, edit_rate: float) -> Iterator[list[Index]]:
    """Indexes over all items, each of about BLOCK_CHARS characters, whatever their number."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        yield build([tuple(r) for r in own.collect()], edit_rate)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", edit_rate: float = EDIT_RATE) -> DataFrame:
    """``(doc, item, begin_char, end_char, edits)`` for every benchmark item in every document.

    Places are in the normalised text. An item of L characters is found with up
    to ``edit_rate`` * L edits, rounded down; items under Q characters only where
    they are whole words. Null or empty texts and items match nothing; repeated
    rows are reported again; empty tables give an empty result. Each block of
    items is one pass over the documents.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = d.schema["id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    out = None
    for index in item_blocks(benchmark, item_col, item_text_col, edit_rate):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(rows: Iterator[tuple], sent=sent) -> Iterator[tuple]:
            for doc, text in rows:
                for item, a, b, edits in found_in(normalise(text), sent.value):
                    yield doc, item, a, b, edits

        own = map_rows(d, ["id", "text"], f"doc_id {kinds[0]}, item_id {kinds[1]}, begin_char long, end_char long, edits long", run)
        out = own if out is None else out.unionByName(own)
    return out


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", edit_rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs`` without any benchmark item, all columns unchanged."""
    columns = docs.columns
    names = [f"k{i}" for i in range(len(columns))]
    d = docs.toDF(*names)
    at = columns.index(text_col)
    schema = ", ".join(f"{n} {d.schema[n].dataType.simpleString()}" for n in names)
    for index in item_blocks(benchmark, item_col, item_text_col, edit_rate):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(rows: Iterator[tuple], sent=sent) -> Iterator[tuple]:
            for row in rows:
                if next(found_in(normalise(row[at]), sent.value), None) is None:
                    yield row

        d = map_rows(d, names, schema, run)
    return d.toDF(*columns)
