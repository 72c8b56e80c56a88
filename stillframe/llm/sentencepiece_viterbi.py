"""SentencePiece encoding by Viterbi over a double-array trie of scored pieces, and decoding.

A space becomes the marker U+2581 and one is put before the text. Of all ways to
cut the text into pieces the one of the greatest summed score is taken;
characters without a piece become byte pieces. Pieces do not go on past the
beginning of a marker, so a text is cut into units there, and each worker
remembers the pieces of the units that it has met.

A unigram model's file has log probabilities. A BPE model's has the negated
ranks of its merges, whose sums mean nothing; its pieces get log probabilities by
Zipf's law instead, p ~ 1 / (rank + 1) over their order in the file. Nothing is
trained.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE_CHARS, remembered, tidied

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
#: Characters of units that are cut together, which bounds the arrays over all their pieces.
TOGETHER = 100_000
#: Units that a worker remembers, and as many older ones; longer ones than this many characters are not remembered.
REMEMBERED, LONGEST_REMEMBERED = 200_000, 64
UNKNOWN_PENALTY = 10.0
NORMAL, UNKNOWN, USER_DEFINED, UNUSED, BYTE = 1, 2, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class Model:
    """Pieces with a double array: from a node, character code c leads to base[node] + c if check there is the node."""

    pieces: list[str]
    kinds: list[int]
    scores: np.ndarray
    prefix: bool
    squeeze: bool
    codes: dict[int, int]
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    unit: str


def double_array(words: dict[str, int], codes: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value (a word's number, or -1) of a trie of ``words``."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for word, number in words.items():
        node = 0
        for ch in word:
            c = codes[ord(ch)]
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][c]
        ends[node] = number
    size = 2 * len(children) + 2 * len(codes) + 16
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = bytearray(size)
    used[0] = 1
    # nodes of many children are placed before those of one, as they are harder to place
    free, hint, wide, narrow = 1, 0, [(0, 0)], []
    while wide or narrow:
        node, at = wide.pop() if wide else narrow.pop()
        value[at] = ends[node]
        kids = sorted(children[node])
        if not kids:
            continue
        while used[free]:
            free += 1
        b = begun = max(0, free - kids[0], hint if len(kids) > 1 else 0)
        while any(used[b + c] for c in kids):
            b += 1
            if b + len(codes) + 2 >= len(used):
                used.extend(bytes(len(used)))
        if b - begun > 200:  # it is crowded here
            hint = b
        if len(used) > len(base):
            more = len(used) - len(base)
            base, check, value = (np.concatenate((x, np.full(more, f, np.int32))) for x, f in ((base, 0), (check, -1), (value, -1)))
        base[at] = b
        for c in kids:
            used[b + c] = 1
            check[b + c] = at
            kid = children[node][c]
            (wide if len(children[kid]) > 1 else narrow).append((kid, b + c))
    return base, check, value


def log_scores(scores: list[float], kinds: list[int], model_type: int) -> np.ndarray:
    """Log scores of pieces: a unigram model's own, or by Zipf's law over the order of a BPE model's.

    Pieces defined by the user get more than any cut of their characters can have.
    """
    if model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    out, normal = np.array(scores, np.float64), np.array([k == NORMAL for k in kinds], bool)
    if model_type == BPE:
        rank = np.arange(1, normal.sum() + 1)
        out[normal] = -np.log(rank) - math.log((1.0 / rank).sum())
    return out


def load(path: str = MODEL) -> Model:
    with open(path, "rb") as f:
        data = f.read()
    pieces, kinds, scores, prefix, squeeze, model_type = [], [], [], True, True, UNIGRAM
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            pieces.append(own.get(1, b"").decode())
            scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            kinds.append(own.get(3, NORMAL))
        elif number == 2:
            model_type = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            own = dict(_fields(value))
            prefix, squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
            if own.get(2):
                raise ValueError("models with a map of characters are not supported")
    return model_of(pieces, kinds, scores, prefix, squeeze, model_type)


def model_of(pieces: list[str], kinds: list[int], scores: list[float], prefix: bool = True, squeeze: bool = False, model_type: int = UNIGRAM) -> Model:
    own = log_scores(scores, kinds, model_type)
    best = max((s for s, k in zip(own.tolist(), kinds) if k == NORMAL), default=0.0)
    for i, k in enumerate(kinds):
        if k == USER_DEFINED:
            own[i] = len(pieces[i]) * max(best, 0.0) + 1.0
    words = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k in (NORMAL, USER_DEFINED)}
    codes = {ord(c): n for n, c in enumerate(sorted(set("".join(words))), 1)}
    # a unit goes up to the next marker, and a line feed is one, if no piece goes past these
    if any(re.search(f"[^{MARKER}]{MARKER}", p) for p in words):
        unit = r"(?s).+"
    elif any("\n" in p for p in words):
        unit = f"(?s){MARKER}+[^{MARKER}]*|[^{MARKER}]+"
    else:
        unit = f"{MARKER}+[^{MARKER}\n]*|[^{MARKER}\n]+|\n"
    return Model(pieces, kinds, own, prefix, squeeze, codes, *double_array(words, codes), unit)


class Codec:
    """Encodes and decodes with a model; remembers units."""

    def __init__(self, model: Model):
        self.m = model
        self.table = np.zeros(0x110000, np.int32)
        for point, code in model.codes.items():
            self.table[point] = code
        normal = [s for s, k in zip(model.scores.tolist(), model.kinds) if k == NORMAL]
        self.unknown_score = min(normal, default=0.0) - UNKNOWN_PENALTY
        self.longest = max((len(p) for p in model.pieces), default=1)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == BYTE}
        self.unknown_id = next((i for i, k in enumerate(model.kinds) if k == UNKNOWN), 0)
        self.is_byte = np.array([k == BYTE for k in model.kinds], bool)
        self.spelled = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARKER, " ").encode() if k in (NORMAL, USER_DEFINED, UNUSED) else b"" for p, k in zip(model.pieces, model.kinds)]
        self.find = re.compile(model.unit).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _bytes(self, ch: str) -> list[int]:
        return [self.byte_ids[b] for b in ch.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown_id]

    def units(self, text: str) -> list[str]:
        """The units of a text; a marker that the text itself has stands alone, as an empty unit, else it would be read as a space."""
        if self.m.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return []
        out: list[str] = []
        for k, part in enumerate(text.split(MARKER)):
            if k:
                out.append("")
            if part or not k:
                spaced = part.replace(" ", MARKER)
                out += self.find(MARKER + spaced if self.m.prefix and not k else spaced)
        return out

    def _viterbi(self, units: list[str]) -> list[bytes]:
        m, text = self.m, "\0".join(units) + "\0"
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        starts = np.cumsum(lengths + 1) - lengths - 1
        codes = self.table[points]
        codes[starts + lengths] = 0
        inside = np.ones(len(points), bool)
        inside[starts + lengths] = False
        # all pieces from all places, by length
        at = np.flatnonzero(inside)
        node = np.zeros(len(at), np.int64)
        local = np.arange(len(points)) - np.repeat(starts, lengths + 1)
        found, single = [], np.zeros(len(points), bool)
        for size in range(1, self.longest + 1):
            c = codes[at + size - 1]
            nxt = m.base[node] + c
            ok = (c > 0) & (m.check[np.minimum(nxt, len(m.check) - 1)] == node)
            at, node = at[ok], nxt[ok].astype(np.int64)
            if not len(at):
                break
            v = m.value[node]
            hit = v >= 0
            found.append((at[hit], np.full(hit.sum(), size), v[hit]))
            if size == 1:
                single[at[hit]] = True
        lone = np.flatnonzero(inside & ~single)
        found.append((lone, np.ones(len(lone), np.int64), np.full(len(lone), -1)))
        begin, size, piece = (np.concatenate(x) for x in zip(*found))
        score = np.where(piece >= 0, m.scores[piece], self.unknown_score)
        best = np.full(len(points) + 1, -np.inf)
        best[starts] = 0
        came, how = np.zeros(len(points) + 1, np.int64), np.zeros(len(points) + 1, np.int64)
        long = np.repeat(lengths > 4 * LONGEST_REMEMBERED, lengths + 1)
        alone = np.repeat(lengths > 4 * LONGEST_REMEMBERED, lengths + 1)[begin]
        # short units go forward together: of one place and one length each end is met once
        b, s, p, w = (x[~alone] for x in (begin, size, piece, score))
        key = local[b] * (self.longest + 1) + s
        order = np.argsort(key, kind="stable")
        b, s, p, w = b[order], s[order], p[order], w[order]
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(b)]):
            x, to = b[lo:hi], b[lo:hi] + s[lo:hi]
            total = best[x] + w[lo:hi]
            better = total > best[to]
            to = to[better]
            best[to], came[to], how[to] = total[better], x[better], p[lo:hi][better]
        # long ones one by one
        b, s, p, w = (x[alone] for x in (begin, size, piece, score))
        order = np.lexsort((s, b))
        for x, n, i, y in zip(b[order].tolist(), s[order].tolist(), p[order].tolist(), w[order]):
            total = best[x] + y
            if total > best[x + n]:
                best[x + n], came[x + n], how[x + n] = total, x, i
        # back from all ends together, a piece at a time
        unit, at = np.arange(len(units)), starts + lengths
        steps = []
        while len(unit):
            steps.append((unit, at, how[at]))
            at = came[at]
            on = at > starts[unit]
            unit, at = unit[on], at[on]
        unit, end, piece = (np.concatenate(x) for x in zip(*steps))
        order = np.lexsort((end, unit))
        piece, many = piece[order].astype(np.int32), np.bincount(unit, minlength=len(units))
        flat, cuts = piece.tobytes(), (np.cumsum(many) * 4).tolist()
        out = [flat[a:b] for a, b in zip([0, *cuts], cuts)]
        end = end[order]
        for u in np.unique(unit[order][piece < 0]).tolist():  # characters that are spelled in bytes
            own = slice(cuts[u] // 4 - int(many[u]), cuts[u] // 4)
            ids: list[int] = []
            for i, e in zip(piece[own].tolist(), end[own].tolist()):
                ids += [i] if i >= 0 else self._bytes(units[u][e - 1 - starts[u]])
            out[u] = np.array(ids, np.int32).tobytes()
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Piece numbers of each text."""
        if "" not in self.known:
            self.known[""] = np.array(self._bytes(MARKER), np.int32).tobytes()
        split = [self.units(t) for t in texts]
        new = {u for own in split for u in own if u not in self.known}
        if len(self.known) + len(new) > REMEMBERED:
            # what is met again is taken over, the rest goes with the next change
            self.older, self.known = self.known, {"": self.known[""]}
            new = {u for own in split for u in own if u}
        self.known.update((u, self.older[u]) for u in new & self.older.keys())
        new -= self.older.keys()
        todo, size = [], 0
        for u in sorted(new, key=len):
            todo.append(u)
            size += len(u) + 1
            if size > TOGETHER:
                self.known.update(zip(todo, self._viterbi(todo)))
                todo, size = [], 0
        if todo:
            self.known.update(zip(todo, self._viterbi(todo)))
        get = self.known.__getitem__
        out = [np.frombuffer(b"".join(map(get, own)), np.int32) for own in split]
        for u in new:
            if len(u) > LONGEST_REMEMBERED:
                del self.known[u]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece numbers; broken byte sequences become U+FFFD."""
        text = b"".join(map(self.spelled.__getitem__, ids.tolist()))
        if self.m.prefix and text.startswith(b" "):
            text = text[1:]
        try:
            return text.decode("utf-8", "surrogatepass")
        except UnicodeDecodeError:
            return text.decode("utf-8", "replace")


def _codec_of(model: Model) -> Codec:
    """One for each worker; a broadcast value is the same object in all tasks of a worker."""
    return remembered("sentencepiece", lambda: Codec(model), lambda codec: codec.m is model)


def encode(docs: DataFrame, keep: list[str], text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``keep`` columns with ids, n_tokens, n_byte_tokens and round_trip of every row.

    round_trip tells whether the decoded ids are the text again, which models
    that drop extra spaces do not promise. A null text is
    encoded as an empty one, without pieces. Repeated rows give repeated results
    and an empty table an empty one. The model is read by the driver.
    """
    sent = docs.sparkSession.sparkContext.broadcast(load(model))
    names = [f"k{i}" for i in range(len(keep))]
    d = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec_of(sent.value)
        for whole in batches:
            at = 0
            sizes = np.cumsum([len(x) for x in (t.as_py() for t in whole.column(len(names)))])
            while at < whole.num_rows:  # in pieces of bounded text
                base = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, base + PIECE_CHARS, "right")))
                b = whole.slice(at, to - at)
                at = to
                texts = b.column(len(names)).to_pylist()
                ids = codec.encode(texts)
                n = [len(x) for x in ids]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))
                by = [int(codec.is_byte[x].sum()) for x in ids]
                same = [codec.decode(x) == t for x, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], lists, pa.array(n, pa.int64()), pa.array(by, pa.int64()), pa.array(same, pa.bool_())], names=[*names, "ids", "n_tokens", "n_byte_tokens", "round_trip"])

    schema = ", ".join(f"{n} {d.schema[n].dataType.simpleString()}" for n in names)
    return d.mapInArrow(tidied(run), f"{schema}, ids array<int>, n_tokens long, n_byte_tokens long, round_trip boolean").toDF(*keep, "ids", "n_tokens", "n_byte_tokens", "round_trip")
