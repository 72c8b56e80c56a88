"""Document scores by masked pseudo-likelihood.

Every token is predicted from the WINDOW tokens on both of its sides, and a
document's score is the sum of the logs. A prediction has two factors:

* the word's class, by a network with one hidden layer over the neighbours, each
  place with vectors of its own: softmax(O tanh(sum of E[place, neighbour] + a) + b);
* the word within its class, by how often the other documents have it. All words
  of all documents are counted, in a table that grows with the corpus, and a
  document's own occurrences are taken off, as they are what is masked.

The most frequent words are classes and neighbours of their own; others share
them by their endings, but not their counts. Both factors are distributions.

The network is trained in numpy where the documents are: each partition takes
steps from the same start over every token that it has, and the results are
averaged by their numbers of tokens. The same pass takes the second
factor and writes every text as symbols, which the network then scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROWS, Scratch, map_rows, with_rows

#: Classes to predict, the first OWN of which are single words; symbols of neighbours, of which the edge of a text is the first, then single words, then endings.
CLASSES, OWN, SYMBOLS, OWN_SYMBOLS, LETTERS = 256, 128, 2048, 1023, 3
ENDINGS = SYMBOLS - OWN_SYMBOLS - 1
#: Tokens on each side, hidden units, tokens of a step, learning rate and start.
WINDOW, HIDDEN, BATCH, RATE, SEED = 2, 32, 1024, 0.1, 1
#: What a word that no other document has counts as.
UNSEEN = 0.5
#: Counts of the most frequent words, so many at most, are sent to the executors; others are joined.
MOST_SENT = 1 << 18
#: Words that a worker remembers, tokens that are handled at a time, and of these so many in the network.
REMEMBERED, HELD, SLICE = 1 << 20, 200_000, 1024
#: Keys whose values are added one key after the other.
FEW = 24
_PLACES = [d for d in range(-WINDOW, WINDOW + 1) if d]


def _hashes(words: list[bytes]) -> np.ndarray:
    """64 bits of each word, signed."""
    return np.fromiter((xxhash.xxh64_intdigest(w, 1) for w in words), np.uint64, len(words)).view(np.int64)


class _Endings(dict):
    """A number below ENDINGS for each ending of LETTERS bytes."""

    def __missing__(self, ending: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self[ending] = xxhash.xxh64_intdigest(ending, 2) % ENDINGS
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self[w[-LETTERS:]] for w in words), np.int16, len(words))


def _words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


@dataclass
class Counts:
    """Frequent words, most frequent first, with their counts; for each class its tokens and its different words; and the class of each symbol."""

    hashes: np.ndarray
    n: np.ndarray
    tokens: np.ndarray
    words: np.ndarray
    kind: np.ndarray


def count_words(docs: DataFrame, text_col: str, scratch: Scratch) -> tuple[DataFrame, Counts]:
    """``(h, n)`` of the words that are not sent, and the Counts of those that are."""

    schema = pa.schema([("h", pa.int64()), ("ending", pa.int16()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, endings = Counter(), _Endings()

        def out() -> Iterator[pa.RecordBatch]:
            words, counts = list(n), np.fromiter(n.values(), np.int64, len(n))
            for lo in range(0, len(words), 50_000):
                own = words[lo : lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(_hashes(own)), pa.array(endings.of(own)), pa.array(counts[lo : lo + 50_000])], schema=schema)

        for batch in batches:
            for text in batch.column(0):
                n.update(_words(text.as_py()))
                if len(n) >= REMEMBERED:
                    yield from out()
                    n.clear()
        yield from out()

    d = docs.select(F.col(text_col).cast("string").alias("t"))
    every = scratch.keep(d.mapInArrow(count, "h long, ending short, n long").groupBy("h").agg(F.sum("n").alias("n"), F.min("ending").alias("ending")))
    levels = {r["level"]: r["words"] for r in every.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count("*").alias("words")).collect()}
    least, sent = 62, 0
    for level in sorted(levels, reverse=True):  # counts of a power of two and more, as long as there are few enough
        sent += levels[level]
        if sent > MOST_SENT:
            break
        least = level
    rows = every.where(F.col("n") >= 1 << least).toPandas().sort_values(["n", "h"], ascending=[False, True])
    by = every.groupBy((F.col("ending") % (CLASSES - OWN)).alias("kind")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).toPandas()
    tokens, words, kind = np.zeros(CLASSES), np.zeros(CLASSES), np.zeros(SYMBOLS, np.int64)
    tokens[OWN + by["kind"].to_numpy(int)], words[OWN + by["kind"].to_numpy(int)] = by["n"], by["words"]
    shared = OWN + rows["ending"].to_numpy(np.int64) % (CLASSES - OWN)
    kind[1 : 1 + min(len(rows), OWN_SYMBOLS)] = shared[:OWN_SYMBOLS]
    kind[1 + OWN_SYMBOLS :] = OWN + np.arange(ENDINGS) % (CLASSES - OWN)
    for c, n in enumerate(rows["n"][:OWN].tolist()):
        tokens[c], words[c], kind[1 + c] = n, 1, c
        tokens[shared[c]] -= n
        words[shared[c]] -= 1
    return every.where(F.col("n") < 1 << least).select("h", "n"), Counts(rows["h"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), tokens, words, kind)


class Vocabulary(dict):
    """A number for each word met, and by it the word's hash, symbol, and count (0 if it was not sent).

    Words get their numbers when they are met, and the rest when ``settle`` is
    called, all together.
    """

    def __init__(self, counts: Counts):
        super().__init__()
        self.order = np.argsort(counts.hashes, kind="stable")
        self.sorted, self.counts = counts.hashes[self.order], counts.n
        self.endings = _Endings()
        self._start()

    def _start(self) -> None:
        self.clear()
        self.fresh: list[bytes] = []
        self.hash, self.symbol, self.n = (np.empty(0, t) for t in (np.int64, np.int16, np.int64))

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        self.fresh.append(word)
        return i

    def numbers(self, text: str | None) -> np.ndarray:
        words = _words(text)
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def settle(self) -> None:
        words, known = self.fresh, len(self.counts)
        if not words:
            return
        h = _hashes(words)
        at = np.minimum(np.searchsorted(self.sorted, h), max(0, known - 1))
        rank = np.where(self.sorted[at] == h, self.order[at], known) if known else np.zeros(len(h), np.int64)
        symbol = np.where(rank < min(OWN_SYMBOLS, known), 1 + rank, 1 + OWN_SYMBOLS + self.endings.of(words))
        n = np.where(rank < known, self.counts[np.minimum(rank, known - 1)], 0) if known else np.zeros(len(h), np.int64)
        self.hash, self.symbol, self.n = (np.concatenate((x, y.astype(x.dtype))) for x, y in ((self.hash, h), (self.symbol, symbol), (self.n, n)))
        self.fresh = []

    def tidy(self) -> None:
        """Between texts whose numbers are in use; forgets when too many words were met."""
        if len(self) > REMEMBERED:
            self._start()


def _summed(keys: np.ndarray, of: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, those of most values first, and for each the sum of its ``values[of]``."""
    order = np.argsort(keys, kind="stable")
    keys, of = keys[order], of[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    many = np.diff(first, append=len(keys))
    by = np.argsort((-many).astype(np.int16 if len(keys) < 1 << 15 else np.int64), kind="stable")
    first, many = first[by], many[by]
    sums, k = values.take(of[first], 0), 1
    while (more := int(np.searchsorted(-many, -k))) > FEW:  # the next value of all keys that have one
        sums[:more] += values.take(of[first[:more] + k], 0)
        k += 1
    for j in range(more):
        sums[j] += values.take(of[first[j] + k : first[j] + many[j]], 0).sum(0)
    return keys[first], sums


class Network:
    """The class of a token by its neighbours."""

    NAMES = ("e", "a", "o", "b")
    room: np.ndarray | None = None

    def __init__(self, prior: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.e, self.a, self.o = normal(len(_PLACES) * SYMBOLS, HIDDEN), np.zeros(HIDDEN, np.float32), normal(HIDDEN, CLASSES)
        self.b = np.log((prior + 0.5) / (prior.sum() + 0.5 * len(prior))).astype(np.float32)

    def parameters(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def set(self, flat: np.ndarray) -> None:
        at = 0
        for k in self.NAMES:
            x = getattr(self, k)
            setattr(self, k, flat[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size

    def _hidden(self, around: np.ndarray) -> np.ndarray:
        hidden = self.e.take(around[:, 0], 0, mode="clip")  # which spares a copy; there is no place outside
        hidden += self.a
        for k in range(1, len(_PLACES)):
            hidden += self.e.take(around[:, k] + k * SYMBOLS, 0, mode="clip")
        return np.tanh(hidden, out=hidden)

    def log_p(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden units and log probabilities of all classes for rows of neighbours, one column for each place."""
        hidden = self._hidden(around)
        q = hidden @ self.o
        q += self.b
        q -= q.max(1, keepdims=True)
        q -= np.log(np.exp(q).sum(1, keepdims=True))
        return hidden, q

    def _scores(self, around: np.ndarray, weights: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hidden units with a column of ones, and by weights with the biases under them the classes' exponents, bounded so that they can be taken; these stand in the network's own room."""
        hidden = np.ones((len(around), HIDDEN + 1), self.o.dtype)
        hidden[:, :HIDDEN] = self._hidden(around)
        if self.room is None or len(self.room) < len(around) or self.room.dtype != weights.dtype:
            self.room = np.empty((max(BATCH, len(around)), CLASSES), weights.dtype)  # new pages for each step would take longer than what is done with them
        q = np.matmul(hidden, weights, out=self.room[: len(around)])
        if not small:
            q -= q.max(1, keepdims=True)
        return hidden, q

    def _weights(self) -> tuple[np.ndarray, bool]:
        """Weights with the biases under them; and whether no exponent is too large, as hidden units are within 1."""
        weights = np.vstack((self.o, self.b))
        return weights, float(np.abs(weights).sum(0).max()) < 60

    def log_p_of(self, flat: np.ndarray, at: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Log probability of the class of each token at some places."""
        out, (weights, small) = np.empty(len(kinds)), self._weights()
        ones = np.ones(CLASSES, weights.dtype)
        for lo in range(0, len(kinds), SLICE):
            own = kinds[lo : lo + SLICE]
            _, q = self._scores(_around(flat, at[lo : lo + SLICE]), weights, small)
            of = q[np.arange(len(own)), own]
            out[lo : lo + SLICE] = of - np.log(np.exp(q, out=q) @ ones)
        return out

    def gradients(self, around: np.ndarray, kinds: np.ndarray) -> dict:
        """Of the mean log probability of the classes; those of e as rows and their sums."""
        weights, small = self._weights()
        hidden, q = self._scores(around, weights, small)
        total = np.exp(q, out=q) @ np.ones(CLASSES, q.dtype)
        q[np.arange(len(q)), kinds] -= total
        share = (-1 / (len(q) * total)).astype(q.dtype)[:, None]  # by which the narrow sides are multiplied, not q
        to = (q.T @ (hidden[:, :HIDDEN] * share)).T
        back = (q @ self.o.T) * (share * (1 - hidden[:, :HIDDEN] ** 2))
        rows = (around + np.arange(len(_PLACES)) * SYMBOLS).ravel().astype(np.int16)  # sorted by their digits
        return {"o": to, "b": share[:, 0] @ q, "a": back.sum(0), "e": _summed(rows, np.repeat(np.arange(len(q)), len(_PLACES)), back)}

    def step(self, around: np.ndarray, kinds: np.ndarray, squares: dict) -> None:
        """One step upwards, by Adagrad."""
        for k, g in self.gradients(around, kinds).items():
            x = getattr(self, k)
            if k not in squares:
                squares[k] = np.full(x.shape, 1e-8, np.float32)
            at, g = g if k == "e" else (np.arange(len(x)), g)
            s = squares[k].take(at, 0, mode="clip")
            s += g * g
            squares[k][at] = s
            np.divide(g, np.sqrt(s, out=s), out=s)
            s *= RATE
            s += x.take(at, 0, mode="clip")
            x[at] = s


def _laid_out(symbols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Some texts between edges, behind each other; where their tokens are, and which text each is of."""
    edge = np.zeros(WINDOW, np.int16)
    flat = np.concatenate([x for s in symbols for x in (edge, s, edge)]).astype(np.int64)
    lengths = np.array([len(s) for s in symbols])
    text = np.repeat(np.arange(len(symbols)), lengths)
    return flat, np.arange(lengths.sum()) + WINDOW * (2 * text + 1), text


def _around(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The neighbours of the tokens at some places."""
    return flat.take(at[:, None] + np.array(_PLACES), mode="clip")


def _held(rows: Iterator[tuple], vocabulary: Vocabulary) -> Iterator[list[tuple]]:
    """Rows that end with a text, with its word numbers in its place, in lists of about HELD tokens."""
    held, size = [], 0
    for *row, text in rows:
        held.append((*row, vocabulary.numbers(text)))
        size += len(held[-1][-1])
        if size >= HELD or len(held) >= 2000:
            vocabulary.settle()
            yield held
            held, size = [], 0
            vocabulary.tidy()
    if held:
        vocabulary.settle()
        yield held


class Trainer:
    """Takes every token of what it is given, and steps when there are enough."""

    def __init__(self, counts: Counts):
        self.network, self.kind = Network(counts.tokens), counts.kind
        self.squares, self.pool, self.held, self.seen = {}, [], 0, 0
        self.rng = np.random.default_rng(SEED)

    def take(self, flat: np.ndarray, places: np.ndarray) -> None:
        self.seen += len(places)
        self.held += len(places)
        self.pool.append((flat, places))
        if self.held >= 64 * BATCH:
            self.steps()

    def steps(self) -> None:
        if not self.pool:
            return
        starts = np.cumsum([0, *(len(flat) for flat, _ in self.pool)])
        flat = np.concatenate([flat for flat, _ in self.pool])
        places = self.rng.permutation(np.concatenate([places + at for at, (_, places) in zip(starts, self.pool)]))
        self.pool, self.held = [], 0
        for lo in range(0, len(places), BATCH):
            own = places[lo : lo + BATCH]
            self.network.step(_around(flat, own), self.kind[flat[own]], self.squares)


def _within(counts: Counts, vocabulary: Vocabulary, numbers: list[np.ndarray], text: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Logs of each text's words within their classes, without its own occurrences, but for words that were not sent; and of these the text, hash and number of occurrences."""
    k = np.bincount(text * CLASSES + kinds, minlength=1)
    at = np.flatnonzero(k)
    k, own = k[at], at % CLASSES
    total = -np.bincount(at // CLASSES, k * np.log(counts.tokens[own] - k + UNSEEN * (counts.words[own] + 1)), len(numbers)).astype(np.float64)
    at, k = np.unique(text * len(vocabulary) + np.concatenate(numbers), return_counts=True)
    at, own = at // max(1, len(vocabulary)), at % max(1, len(vocabulary))
    sent = vocabulary.n[own] > 0
    total += np.bincount(at[sent], k[sent] * np.log(vocabulary.n[own[sent]] - k[sent] + UNSEEN), len(numbers))
    return total, at[~sent], vocabulary.hash[own[~sent]], k[~sent]


def encode(docs: DataFrame, counts: Counts) -> DataFrame:
    """Of ``docs(row, id, text)``, all in one table: ``(row, id, n_tokens, total, symbols)`` of each text, its logs within classes; ``(row, h, k)`` of each of its words that was not sent; and ``(seen, network)`` of each partition."""
    sent = docs.sparkSession.sparkContext.broadcast(counts)
    kind = docs.schema["id"].dataType.simpleString()
    names = ["row", "id", "n_tokens", "total", "symbols", "h", "k", "seen", "network"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, trainer = Vocabulary(sent.value), Trainer(sent.value)
        types = [pa.int64(), None, pa.int64(), pa.float64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

        def rows() -> Iterator[tuple]:
            for b in batches:
                types[1] = b.schema.field(1).type
                for at in range(0, b.num_rows, ROWS):
                    yield from zip(*(c.to_pylist() for c in b.slice(at, ROWS).columns))

        def out(n: int, **given) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, t in zip(names, types)], names=names)

        for held in _held(rows(), vocabulary):
            numbers = [w for *_, w in held]
            symbols = [vocabulary.symbol[w] for w in numbers]
            flat, places, text = _laid_out(symbols)
            trainer.take(flat, places)
            total, at, words, k = _within(sent.value, vocabulary, numbers, text, sent.value.kind[flat[places]])
            row = np.array([r for r, *_ in held], np.int64)
            yield out(len(held), row=row, id=[i for _, i, _ in held], n_tokens=[len(w) for w in numbers], total=total, symbols=[s.tobytes() for s in symbols])
            yield out(len(at), row=row[at], h=words, k=k)
        trainer.steps()
        if trainer.seen:
            yield out(1, seen=[trainer.seen], network=[trainer.network.parameters().tobytes()])

    return docs.select("row", "id", "text").mapInArrow(run, f"row long, id {kind}, n_tokens long, total double, symbols binary, h long, k long, seen long, network binary")


def average(encoded: DataFrame, counts: Counts) -> Network:
    """The network that the partitions' networks are on average, by their tokens."""

    def mean(rows: Iterator[tuple]) -> Iterator[tuple]:
        total, n = 0.0, 0
        for seen, data in rows:
            total, n = total + seen * np.frombuffer(data, np.float32).astype(np.float64), n + seen
        if n:
            yield n, (total / n).astype(np.float32).tobytes()

    parts, network = encoded.where("network is not null").select("seen", "network"), Network(counts.tokens)
    few = max(1, math.isqrt(parts.count()))
    for _, data in mean((r["seen"], r["network"]) for r in map_rows(parts.repartition(few), ["seen", "network"], "seen long, network binary", mean).toLocalIterator()):
        network.set(np.frombuffer(data, np.float32))
    return network


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, log_likelihood and mean_log_likelihood of every row, by counts and a network of all of them.

    A null or blank text has no tokens, a sum of 0 and a null mean. Repeated
    rows count and are scored each time. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "lm")
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    d = with_rows(d, "id", "row", scratch)
    rest, counts = count_words(d, "text", scratch)
    encoded = scratch.keep(encode(d, counts))
    sent = docs.sparkSession.sparkContext.broadcast((average(encoded, counts), counts.kind))
    texts = encoded.where("symbols is not null").select("row", "id", "n_tokens", "total", "symbols")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, kind = sent.value
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                b = whole.slice(lo, ROWS)
                flat, places, text = _laid_out([np.frombuffer(x.as_py(), np.int16) for x in b.column(4)])
                logs = np.bincount(text, network.log_p_of(flat, places, kind[flat[places]]), b.num_rows).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(b.column(3).to_numpy() + logs)], names=["row", "id", "n_tokens", "total"])

    out = texts.mapInArrow(run, f"row long, id {d.schema['id'].dataType.simpleString()}, n_tokens long, total double")
    more = encoded.where("h is not null").select("row", "h", "k").join(rest, "h").groupBy("row").agg(F.sum(F.col("k") * F.log(F.col("n") - F.col("k") + UNSEEN)).alias("more"))
    total = F.col("total") + F.coalesce("more", F.lit(0.0))
    return out.join(more, "row", "left").select("id", "n_tokens", total.alias("log_likelihood"), F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"))
