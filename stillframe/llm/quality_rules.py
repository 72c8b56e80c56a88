"""Quality rules: a decision list learned by sequential covering.

Rules are grown one at a time on labelled statistics of texts, each a
conjunction of thresholds, pruned on labels kept back for that, and taken while
they are precise. The list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_rows

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct_words", "longest_word")
#: The labelled rows that rules are learned from, at most; those of the smallest id hashes.
MAX_LABELLED = 50_000


def text_counts(text: str) -> tuple[int, ...]:
    """The COUNTS of a text. Words are runs without ASCII white space."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    points = np.frombuffer(data, np.uint8)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    repeats = 0
    if n >= 3:
        w = np.fromiter(map(ids.__getitem__, words), np.int64, n)
        pairs = w[:-1] * len(ids) + w[1:]
        if len(ids) > 1 << 20:  # three numbers would not fit in 63 bits
            pairs = np.unique(pairs, return_inverse=True)[1]
        windows = pairs[:-1] * len(ids) + w[2:]
        _, at, found = np.unique(windows, return_inverse=True, return_counts=True)
        again = found[at] >= 2
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= again
        repeats = int(covered.sum())
    letters = len(text) - sum(map(text.count, SPACES))
    return (
        n, letters, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeats, len(lines),
        int(np.count_nonzero((points >= 65) & (points <= 90))), int(np.count_nonzero((points >= 48) & (points <= 57))),
        sum(map(text.count, "!?;:")), len(ids), max(map(len, words), default=0),
    )


#: Statistics that rules may test, as SQL over COUNTS.
FEATURES = {
    "words": "cast(n_words as double)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "longest_word": "cast(longest_word as double)",
}


@dataclass(frozen=True)
class Rule:
    """All of the tests (statistic, '<=' or '>', threshold) together reject a text."""

    tests: tuple[tuple[str, str, float], ...]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        hit = np.ones(len(next(iter(x.values()))), bool)
        for name, op, cut in self.tests:
            hit &= x[name] <= cut if op == "<=" else x[name] > cut
        return hit

    def column(self) -> Column:
        """The same over a table with the FEATURES as columns."""
        hit = F.lit(True)
        for name, op, cut in self.tests:
            hit = hit & (F.col(name) <= cut if op == "<=" else F.col(name) > cut)
        return hit


def _cuts(v: np.ndarray) -> np.ndarray:
    u = np.unique(v)
    mids = (u[1:] + u[:-1]) / 2
    return mids if len(mids) <= 128 else np.unique(mids[np.linspace(0, len(mids) - 1, 128).astype(int)])


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, longest: int) -> Rule:
    tests: list[tuple[str, str, float]] = []
    hit = np.ones(len(bad), bool)
    while len(tests) < longest and (~bad & hit).any():
        p0, n0, best = int((bad & hit).sum()), int((~bad & hit).sum()), (0.0, None, None)
        if not p0:
            break
        base = math.log2(p0 / (p0 + n0))
        for name, v in x.items():
            own, own_bad = v[hit], bad[hit]
            order = np.argsort(own, kind="stable")
            s, c = own[order], np.concatenate(([0], np.cumsum(own_bad[order])))
            cuts = _cuts(own)
            at = np.searchsorted(s, cuts, "right")
            for op, p, n in (("<=", c[at], at - c[at]), (">", c[-1] - c[at], len(s) - at - (c[-1] - c[at]))):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / np.maximum(p + n, 1)) - base), 0.0)
                if len(gain) and gain.max() > best[0] + 1e-9:
                    k = int(gain.argmax())
                    best = (float(gain[k]), (name, op, float(cuts[k])), None)
        if best[1] is None:
            break
        tests.append(best[1])
        hit &= Rule((best[1],)).covers(x)
    return Rule(tuple(tests))


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        hit = r.covers(x)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((Rule(rule.tests[:k]) for k in range(len(rule.tests), 0, -1)), key=worth, default=rule)


def learn_list(x: dict[str, np.ndarray], bad: np.ndarray, keep_back: np.ndarray, precision: float = 0.95, most_rules: int = 16, longest: int = 4, least: int = 4) -> list[Rule]:
    """Ordered rules that reject ``bad`` rows; a rule must be right in ``precision`` of the rows it covers and cover ``least`` bad ones."""
    left, rules = np.ones(len(bad), bool), []
    pick = lambda m: {k: v[m] for k, v in x.items()}
    while len(rules) < most_rules and (left & bad & ~keep_back).any():
        g, k = left & ~keep_back, left & keep_back
        rule = _grow(pick(g), bad[g], longest)
        if not rule.tests:
            break
        rule = _prune(rule, pick(k), bad[k]) if bad[k].any() else rule
        hit = rule.covers(x) & left
        right = int((hit & bad).sum())
        if right < least or right < precision * int(hit.sum()):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True where a text is kept: the first rule that covers it rejects it."""
    out = None
    for r in rules:
        out = F.when(r.column(), F.lit(False)) if out is None else out.when(r.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the COUNTS of every row; a null text counts as empty."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for i, text in rows:
            yield i, *text_counts(text or "")

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(d, ["id", "text"], f"id {d.schema['id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS), run)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> tuple[DataFrame, list[Rule]]:
    """Statistics of every row with base_failed and kept, and the rules learned.

    base_failed: under 50 words, or over half of the words in repeated windows.
    kept: false for those, else the decision list's verdict. Learned from rows
    with a label 0 (bad) or 1, of repeated labels the least; nulls are left out.
    Without labels nothing beyond the base rules is rejected. Repeated rows give
    repeated results; an empty table an empty result.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.keep(statistics(docs, id_col, text_col))
    features = {k: F.expr(v) for k, v in FEATURES.items()}
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id is not null and label is not null").groupBy("id").agg(F.min("label").alias("label"))
    learned = stats.where(~base).join(known, "id").withColumn("order", F.xxhash64("id")).orderBy("order", "id").limit(max_labelled)
    rows = learned.withColumns(features).select("order", "label", *FEATURES).toPandas().sort_values(["order", *FEATURES])
    x = {k: rows[k].to_numpy(float) for k in FEATURES}
    rules = learn_list(x, rows["label"].to_numpy() == 0, rows["order"].to_numpy() % 3 == 0) if len(rows) else []
    out = stats.withColumn("base_failed", base).withColumns(features)
    return out.withColumn("kept", ~F.col("base_failed") & verdict(rules)), rules
