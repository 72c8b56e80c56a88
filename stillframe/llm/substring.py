"""Substring dedup by relative Lempel-Ziv parsing against the blocks of all documents.

A window is 35 consecutive words. Of its 18 runs of 18 words the one with the
least hash is its anchor, so equal windows have equal anchors at equal places.
The windows that share one occurrence of an anchor follow each other; the words
they cover are a block, and every different block is a reference block, indexed
by its anchor with its first and its last place in the corpus.

Every document is a row of blocks and is parsed against the index from left to
right: a factor is the longest stretch, block after block, that the text at one
of these places goes on with, and the next one begins behind it. At the ends of
factors are blocks whose anchor occurs elsewhere while their words differ there:
their windows are looked up one by one, by a hash of 128 bits, and lengthen the
factor or form one of their own. Factors have 35 words or more; what they cover
is removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_rows, remembered, tidied, with_rows

WINDOW, ANCHOR = 35, 18
RUNS = WINDOW - ANCHOR + 1
#: Words of one document that are held as hashes at a time; and words whose hashes a worker remembers.
CHUNK, REMEMBERED = 1 << 20, 1 << 19

_M = np.uint64(0x9E3779B97F4A7C15)


def _power(k: int) -> np.uint64:
    return np.uint64(pow(int(_M), k, 1 << 64))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 35)
        return h


def _mix(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def _runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ANCHOR and of WINDOW words."""
    n = len(h)
    h2 = h[:-1] * _M + h[1:]
    h4 = h2[:-2] * _power(2) + h2[2:]
    h8 = h4[:-4] * _power(4) + h4[4:]
    h16 = h8[:-8] * _power(8) + h8[8:]
    h32 = h16[:-16] * _power(16) + h16[16:]
    h18 = h16[: n - 17] * _power(2) + h2[16 : n - 1]
    return h18, (h32[: n - 34] * _power(2) + h2[32 : n - 2]) * _M + h[34:]


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(remembered("substring", _Hashes).__getitem__, words), np.uint64, len(words))


def blocks(words: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchor hash, block hash, first window and number of windows of every block of a document, in pieces."""
    for at in range(0, max(1, len(words) - WINDOW + 1), CHUNK):
        piece = words[at : at + CHUNK + WINDOW - 1]
        if len(piece) < WINDOW:
            return
        h18, h35 = _runs(_word_hashes(piece))
        v = _mix(h18)
        low = np.arange(len(v))
        for step in (1, 2, 4, 8, 2):  # the last least value of 18
            left, right = low[:-step], low[step:]
            low = np.where(v[right] <= v[left], right, left)
        first = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
        count = np.diff(np.concatenate((first, [len(low)])))
        anchor = low[first]
        # the first and the last window cover the block, as it has 18 windows at most
        block = _mix(h35[first] * _power(3) + h35[first + count - 1] * _power(5) + (anchor - first).astype(np.uint64) * _power(7) + count.astype(np.uint64))
        yield v[anchor], block, first + at, count


def window_hashes(words: list[bytes], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each window that begins at ``starts`` (ascending)."""
    a, b = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    for at in range(0, max(1, len(words) - WINDOW + 1), CHUNK):
        lo, hi = np.searchsorted(starts, [at, at + CHUNK])
        if lo < hi:
            h = _word_hashes(words[at : at + CHUNK + WINDOW - 1])
            own = starts[lo:hi] - at
            a[lo:hi], b[lo:hi] = _runs(h)[1][own], _runs(_mix(h + np.uint64(1)))[1][own]
    return a, b


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _index(docs: DataFrame) -> DataFrame:
    """``(h, block, id, first, count)`` of every block of every document."""
    schema = pa.schema([("h", pa.int64()), ("block", pa.int64()), ("id", pa.int64()), ("first", pa.int32()), ("count", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            h, block, ids, first, count = (np.concatenate(c) for c in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(block.view(np.int64)), pa.array(ids), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))], schema=schema)

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                for h, block, first, count in blocks(_words(text.as_py())):
                    held.append((h, block, np.full(len(h), i, np.int64), first, count))
                    size += len(h)
                    if size >= 100_000:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return docs.select("id", "text").mapInArrow(tidied(run), "h long, block long, id long, first int, count int")


def _pack(tag: int) -> F.Column:
    return F.shiftleft(F.col("first").cast("long"), 8) + F.col("count") * 4 + tag


def _looked_up(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(a, b, id, first, weight)`` for each window of the wanted blocks."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("id", pa.int64()), ("first", pa.int32()), ("weight", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text, packed in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                p = np.sort(packed.values.to_numpy(zero_copy_only=False))
                first, count = p >> 8, p >> 2 & 63
                starts = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                a, b = window_hashes(_words(text.as_py()), starts)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(len(a), i, np.int64)), pa.array(starts.astype(np.int32)), pa.array(np.repeat(p & 3, count).astype(np.int32))], schema=schema)

    each = wanted.groupBy("id").agg(F.collect_list("packed").alias("packed"))
    return docs.select("id", "text").join(each, "id").select("id", "text", "packed").mapInArrow(tidied(run), "a long, b long, id long, first int, weight int")


def cut(text: str, covered: np.ndarray, layout: bool) -> str:
    """``text`` without the covered words; the rest joined by one space, or as it was laid out."""
    if not layout:
        words = _words(text)
        return b" ".join([words[k] for k in np.flatnonzero(~covered)]).decode("utf-8", "surrogatepass")
    spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
    kept, at = [], 0
    for a, b in zip(edges[::2], edges[1::2]):
        kept.append(text[at : spans[a][0]])
        at = spans[b][0] if b < len(spans) else len(text)
    return "".join([*kept, text[at:]])


def _place() -> F.Column:
    return F.struct("id", "first")


def _span(count: F.Column) -> F.Column:
    """First window, number of windows, and the two reference places, as numbers."""
    return F.array(*[c.cast("long") for c in (F.col("first"), count, F.col("low.id"), F.col("low.first"), F.col("high.id"), F.col("high.first"))]).alias("span")


def _spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, spans)``: of every document the blocks and the windows of other blocks that occur elsewhere, and where."""
    index = scratch.keep(_index(docs))
    # written first, so that the join's shuffle is its own and a hot anchor's rows can be split
    common = scratch.keep(index.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    known = scratch.keep(index.join(common, "h", "left_semi"))
    scratch.forget(index)
    scratch.forget(common)
    kinds = scratch.keep(known.groupBy("h", "block").agg(F.count("*").alias("n"), F.first("count").alias("count"), F.min(_place()).alias("low"), F.max(_place()).alias("high")))
    edge, reference = kinds.where("n = 1"), kinds.where("n > 1")
    whole = scratch.keep(known.join(reference.select("h", "block", "low", "high"), ["h", "block"]).select("id", _span(F.col("count"))))
    scratch.forget(known)
    # windows of edge blocks are compared with those of every other block around the same anchor
    others = reference.join(edge.select("h").distinct(), "h", "left_semi")
    wanted = lambda d, tag: d.select("low.id", "low.first", "count").select("id", _pack(tag).alias("packed"))
    windows = scratch.keep(_looked_up(docs, wanted(edge, 1).unionByName(wanted(others, 2))))
    again = scratch.keep(windows.groupBy("a", "b").agg(F.sum("weight").alias("n"), F.min(_place()).alias("low"), F.max(_place()).alias("high")).where("n > 1").select("a", "b", "low", "high"))
    found = windows.where("weight = 1").join(again, ["a", "b"]).select("id", _span(F.lit(1)))
    spans = scratch.keep(whole.unionByName(found).groupBy("id").agg(F.flatten(F.collect_list("span")).alias("spans")))
    for t in (kinds, whole, windows, again):
        scratch.forget(t)
    return spans


def parse(spans: list[int], own: int) -> list[tuple[int, int, int, int]]:
    """A document's factors, as (first word, words, document and first word of the reference)."""
    rows = np.array(spans, np.int64).reshape(-1, 6)
    rows = rows[np.argsort(rows[:, 0], kind="stable")].tolist()
    out, i, n = [], 0, len(rows)
    while i < n:
        first, count, *places = rows[i]
        best = (i, 0, 0, 0)
        for source, at in (places[:2], places[2:]):
            if source == own and at == first:
                continue
            shift, end, j = at - first, first + count, i + 1
            while j < n:
                f, c, low, low_at, high, high_at = rows[j]
                if f != end or not (low == source and low_at - f == shift or high == source and high_at - f == shift):
                    break
                end, j = end + c, j + 1
            if j > best[0]:
                best = (j, end, source, at)
        i, end, source, at = best
        out.append((first, end - first + WINDOW - 1, source, at))
    return out


def factors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, begin, words, source, source_begin)`` of every factor, for whole-number ids that are given and unique.

    Places are words, from 0. The text at the source has the factor's words.
    """
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for i, spans in rows:
            yield from ((i, *f) for f in parse(spans, i))

    return map_rows(_spans(d, Scratch(docs.sparkSession, "factors")), ["id", "spans"], "id long, begin long, words long, source long, source_begin long", run)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", layout: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (the id) with the text left of every row, n_words and n_removed.

    A word is removed if a window of 35 words over it has the words of a window
    that begins anywhere else, in the same or in another row; words are runs
    without ASCII white space and are compared unchanged. A null text has no
    words and gives an empty one. Repeated rows, and rows of one id or without
    one, are documents of their own, so long ones remove each other. Texts under
    35 words stay. An empty table gives an empty result. ``layout`` keeps the
    white space of what stays; else words are joined by one space.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    keep = keep or [id_col]
    names = [f"k{i}" for i in range(len(keep))]
    d = docs.select(F.col(id_col).alias("given"), F.col(text_col).cast("string").alias("text"), *[F.col(c).alias(n) for c, n in zip(keep, names)])
    d = with_rows(d, "given", "id", scratch)
    spans = _spans(d, scratch)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for *kept, text, i, own in rows:
            text = text or ""
            n = len(_words(text))
            covered = np.zeros(n, bool)
            if own:
                for begin, words, *_ in parse(own, i):
                    covered[begin : begin + words] = True
            gone = int(covered.sum())
            yield *kept, cut(text, covered, layout) if gone or not layout else text, n, gone

    schema = ", ".join(f"{n} {d.schema[n].dataType.simpleString()}" for n in names)
    joined = d.join(spans, "id", "left")
    return map_rows(joined, [*names, "text", "id", "spans"], f"{schema}, text string, n_words long, n_removed long", run).toDF(*keep, f"{text_col}_kept", "n_words", "n_removed")
