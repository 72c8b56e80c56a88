"""Language identification by hyperdimensional profiles.

Each letter of any script has a random vector of +1 and -1, made from its code
point alone. A trigram's vector binds its letters' vectors, the first rotated
twice and the second once, by elementwise product. A text's vector bundles
(adds) those of its trigrams, a language's prototype bundles its texts. A text
takes the language of the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, remembered

DIMENSIONS, SEED = 1024, 9
#: Trigrams whose vectors a worker remembers, and trigrams that are bundled at a time.
REMEMBERED, SLICE = 1 << 15, 1 << 12
#: Different trigrams of a language that are gathered before they are bundled.
GATHERED = 1 << 18
#: Different trigrams at which half of a bound is asked, and the least part of it that is.
HALF_TRIGRAMS, LEAST_PART = 60, 0.25
UNDETERMINED = "und"
_BITS = 21


class Encoder:
    """Trigram counts of texts and their hypervectors; vectors of letters are made when first met, and those of trigrams remembered."""

    def __init__(self) -> None:
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        self.letters: dict[int, np.ndarray] = {0: self._vector(0)}
        self.keys, self.slots = np.empty(0, np.int64), np.empty(0, np.int32)
        self.vectors = np.empty((0, DIMENSIONS), np.int8)

    def _vector(self, point: int) -> np.ndarray:
        return np.random.default_rng([SEED, point]).choice(np.array([-1, 1], np.int8), DIMENSIONS)

    def letter(self, points: np.ndarray) -> np.ndarray:
        own, at = np.unique(points, return_inverse=True)
        for c in own.tolist():
            if c not in self.letters:
                self.letters[c] = self._vector(c)
        return np.stack([self.letters[c] for c in own.tolist()])[at]

    def trigrams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigrams, as three code points in one number, and their counts; white space and other non-letters count as one gap, 0; none without a letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        s = np.where(self.is_letter[points], points, 0).astype(np.int64)
        if not s.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        s = np.concatenate(([0], s, [0]))
        s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]
        return np.unique((s[:-2] << 2 * _BITS) | (s[1:-1] << _BITS) | s[2:], return_counts=True)

    def make(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of trigrams, bound anew."""
        mask = (1 << _BITS) - 1
        return np.roll(self.letter(grams >> 2 * _BITS), 2, 1) * np.roll(self.letter(grams >> _BITS & mask), 1, 1) * self.letter(grams & mask)

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(DIMENSIONS, np.float64)
        for lo in range(0, len(grams), SLICE):
            g, n = grams[lo : lo + SLICE], counts[lo : lo + SLICE].astype(np.float32)
            at = np.searchsorted(self.keys, g)
            known = at < len(self.keys)
            known[known] = self.keys[at[known]] == g[known]
            new = g[~known]
            if len(new) and len(self.keys) + len(new) <= REMEMBERED:
                slots = np.arange(len(self.vectors), len(self.vectors) + len(new), dtype=np.int32)
                self.vectors = np.concatenate((self.vectors, self.make(new)))
                order = np.argsort(keys := np.concatenate((self.keys, new)), kind="stable")
                self.keys, self.slots = keys[order], np.concatenate((self.slots, slots))[order]
                at, known = np.searchsorted(self.keys, g), np.ones(len(g), bool)
            total += n[known] @ self.vectors[self.slots[at[known]]].astype(np.float32)
            if not known.all():
                total += n[~known] @ self.make(g[~known]).astype(np.float32)
        return total


def encoder() -> Encoder:
    """One for each Python worker."""
    return remembered("language_id", Encoder)


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes, from every row with a text and a language.

    Each partition bundles its own texts, and their sums are added; what comes
    to the driver is DIMENSIONS numbers for each language.
    """

    def add(rows: Iterator[tuple]) -> Iterator[tuple]:
        e = encoder()
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[str, int] = {}

        def summed(lang: str) -> tuple[np.ndarray, np.ndarray]:
            grams, at = np.unique(np.concatenate([g for g, _ in held[lang]]), return_inverse=True)
            return grams, np.bincount(at, np.concatenate([n for _, n in held[lang]]), len(grams)).astype(np.int64)

        def out(lang: str) -> Iterator[tuple]:
            v = np.rint(e.bundle(*summed(lang))).astype(np.int64)
            del held[lang], sizes[lang]
            yield from ((lang, k, x) for k, x in enumerate(v.tolist()))

        for text, lang in rows:
            if lang not in held and len(held) >= 64:  # bounds memory where languages are many
                yield from out(max(sizes, key=sizes.get))
            own = e.trigrams(text)
            held.setdefault(lang, []).append(own)
            sizes[lang] = sizes.get(lang, 0) + len(own[0])
            if sizes[lang] > 2 * GATHERED:
                held[lang] = [summed(lang)]
                sizes[lang] = len(held[lang][0][0])
                if sizes[lang] > GATHERED:
                    yield from out(lang)
        for lang in list(held):
            yield from out(lang)

    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    got = map_rows(rows, ["text", "lang"], "lang string, place int, x long", add).groupBy("lang", "place").agg(F.sum("x").alias("x")).toPandas()
    langs = sorted(got["lang"].unique())
    protos = np.zeros((len(langs), DIMENSIONS))
    protos[np.searchsorted(langs, got["lang"].to_numpy(str)) if langs else [], got["place"].to_numpy()] = got["x"].to_numpy(float)
    return langs, protos / np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-12)


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns with lang_pred, score (cosine, from 0 to 1) and n_trigrams (different ones) of every row.

    A null text, one without a letter, and any text when nothing was learned
    gives "und" and 0. Ties go to the first language in order.
    """
    protos = np.asarray(prototypes, np.float64)

    def judge(rows: Iterator[tuple]) -> Iterator[tuple]:
        e = encoder()
        for *kept, text in rows:
            grams, counts = e.trigrams(text or "")
            if not len(grams) or not langs:
                yield *kept, UNDETERMINED, 0.0, 0
                continue
            v = e.bundle(grams, counts)
            cos = protos @ v
            best = int(cos.argmax())
            yield *kept, langs[best], float(min(1.0, max(0.0, cos[best] / max(float(np.linalg.norm(v)), 1e-12)))), len(grams)

    # by position, so that names in the input cannot clash with those given here
    names = [f"k{i}" for i in range(len(keep))]
    d = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_col).cast("string").alias("t"))
    schema = ", ".join(f"{n} {d.schema[n].dataType.simpleString()}" for n in names)
    return map_rows(d, [*names, "t"], f"{schema}, lang_pred string, score double, n_trigrams long", judge).toDF(*keep, "lang_pred", "score", "n_trigrams")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, then predict every row: id, held_out, lang_pred, score.

    Repeated rows give repeated results. A null id is never learned from. An
    empty table gives an empty result.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).withColumn("held_out", held_out("id"))
    langs, protos = learn(d.where("id is not null and not held_out"))
    return predict(d, langs, protos, ["id", "held_out"]).drop("n_trigrams")


def reject(docs: DataFrame, min_score: float, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is recognised, all columns unchanged.

    A long text needs a score of ``min_score``. Of n different trigrams the part
    n / (n + HALF_TRIGRAMS) of it is asked, as short texts score low by nature,
    but LEAST_PART of it at least.
    Where no row has a language to learn from, every text with a letter stays.
    """
    # by position, so that no column of the input can clash
    columns = docs.columns
    names = [f"c{i}" for i in range(len(columns))]
    at = dict(zip(columns, names))
    d = docs.toDF(*names)
    langs, protos = learn(d.where(F.col(at[id_col]).isNotNull() & ~held_out(at[id_col])), at[text_col], at[lang_col])
    if not langs:
        return docs.where(F.rlike(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(r"\p{L}")))
    found = predict(d, langs, protos, names, at[text_col])
    bound = min_score * F.greatest(F.lit(LEAST_PART), F.col("n_trigrams") / (F.col("n_trigrams") + HALF_TRIGRAMS))
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= bound)).select(*names).toDF(*columns)
