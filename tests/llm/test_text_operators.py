"""LM scoring, decontamination, quality rules, language ID: brute force, held-out accuracy and edges."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from stillframe.llm import decontaminate, language_id, masked_lm, quality_rules, queries
from stillframe.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA)


# --- 1: masked pseudo-likelihood


def brute_score(texts, network, sent=None):
    """Each text's sum, token by token, from plain counters and the network's weights."""
    import xxhash

    lm = masked_lm
    own = [(t or "").lower().encode().split() for t in texts]
    n = Counter(w for t in own for w in t)
    signed = lambda w: (h := xxhash.xxh64_intdigest(w, 1)) - (1 << 64) * (h >> 63)
    rank = {w: i for i, w in enumerate(sorted(n, key=lambda w: (-n[w], signed(w))))}
    kind = {w: r if (r := rank[w]) < lm.OWN else lm.OWN + xxhash.xxh64_intdigest(w[-3:], 2) % 1024 % (lm.CLASSES - lm.OWN) for w in n}
    symbol = {w: 1 + r if (r := rank[w]) < lm.OWN_SYMBOLS else 1 + lm.OWN_SYMBOLS + xxhash.xxh64_intdigest(w[-3:], 2) % 1024 for w in n}
    tokens, words = Counter(), Counter(kind.values())
    for w, c in n.items():
        tokens[kind[w]] += c
    e, o = network.e.reshape(4, lm.SYMBOLS, -1).astype(float), network.o.astype(float)
    out = []
    for t in own:
        s = [0, 0, *(symbol[w] for w in t), 0, 0]
        mine, mine_of = Counter(t), Counter(kind[w] for w in t)
        total = 0.0
        for i, w in enumerate(t):
            q = np.tanh(network.a + e[0, s[i]] + e[1, s[i + 1]] + e[2, s[i + 3]] + e[3, s[i + 4]]) @ o + network.b
            total += q[kind[w]] - np.log(np.exp(q).sum())
            total += math.log(n[w] - mine[w] + lm.UNSEEN) - math.log(tokens[kind[w]] - mine_of[kind[w]] + lm.UNSEEN * (words[kind[w]] + 1))
        out.append(total)
    return out


def test_scores_like_brute_force(spark, tiny, monkeypatch):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    for sent in (masked_lm.MOST_SENT, 1500):  # the second leaves most words to the join
        monkeypatch.setattr(masked_lm, "MOST_SENT", sent)
        got = {r.id: r for r in masked_lm.score(docs).collect()}
        _, counts = masked_lm.count_words(docs, "text", Scratch(spark, "test"))
        assert len(counts.n) <= sent and len(got) == len(rows)
        network = masked_lm.average(masked_lm.encode(docs.selectExpr("doc_id as row", "doc_id as id", "text"), counts), counts)
        for r, want in zip(rows, brute_score([r.text for r in rows], network)):
            assert got[r.doc_id].n_tokens == len((r.text or "").split()) or "\x1c" in r.text
            assert got[r.doc_id].log_likelihood == pytest.approx(want, rel=1e-3, abs=1e-3)
            if got[r.doc_id].n_tokens:
                assert got[r.doc_id].mean_log_likelihood == pytest.approx(want / got[r.doc_id].n_tokens, rel=1e-3)


def test_both_factors_are_distributions(spark):
    """All classes sum to one, and so do all words of a class with what is unseen."""
    texts = [f"a b c{i % 7} d{i % 50} ending{i}" for i in range(300)]
    _, counts = masked_lm.count_words(docs_of(spark, [(i, t, "en") for i, t in enumerate(texts)]), "text", Scratch(spark, "test"))
    network = masked_lm.Network(counts.tokens)
    around = np.random.default_rng(1).integers(0, masked_lm.SYMBOLS, (50, 4))
    p = np.exp(network.log_p(around)[1])
    assert p.sum(1) == pytest.approx(np.ones(50), abs=1e-4)
    flat, at, _ = masked_lm._laid_out([np.arange(30, dtype=np.int16), np.arange(5, 25, dtype=np.int16)])
    own, kinds = masked_lm._around(flat, at), np.arange(50) % masked_lm.CLASSES
    assert own[0].tolist() == [0, 0, 1, 2] and own[49].tolist() == [22, 23, 0, 0]
    assert network.log_p_of(flat, at, kinds) == pytest.approx(network.log_p(own)[1][np.arange(50), kinds], abs=1e-4)
    network.o *= 1000  # too large to exponentiate as they are
    assert np.isfinite(network.log_p_of(flat, at, kinds)).all()
    v = masked_lm.Vocabulary(counts)
    v.numbers(" ".join(texts))
    v.settle()
    of, n = counts.kind[v.symbol], v.n
    for c in range(masked_lm.CLASSES):
        assert counts.tokens[c] == n[of == c].sum() and counts.words[c] == (of == c).sum()
        total = counts.tokens[c] + masked_lm.UNSEEN * (counts.words[c] + 1)
        assert (n[of == c] + masked_lm.UNSEEN).sum() + masked_lm.UNSEEN == pytest.approx(total)


def test_every_place_is_trained_on_and_scored(spark):
    """Each token of each text is met once in training, short texts and slices' ends included, and once in the sum."""
    lengths = [0, 1, 3, 7, 9, 1024, 1025, 2500]
    docs = docs_of(spark, [(i, " ".join(f"w{k % 40}" for k in range(n)), "en") for i, n in enumerate(lengths)]).coalesce(1)
    _, counts = masked_lm.count_words(docs, "text", Scratch(spark, "test"))
    encoded = masked_lm.encode(docs.selectExpr("doc_id as row", "doc_id as id", "text"), counts)
    assert [r.seen for r in encoded.where("network is not null").collect()] == [sum(lengths)]
    trainer, met = masked_lm.Trainer(counts), []
    trainer.network.step = lambda around, kinds, squares: met.extend(map(tuple, around.tolist()))
    symbols = [np.arange(lo, lo + n, dtype=np.int16) for lo, n in zip(np.cumsum([1, *lengths[:-1]]) % 900, (n % 900 for n in lengths))]
    flat, places, _ = masked_lm._laid_out(symbols)
    trainer.take(flat, places)
    trainer.steps()
    assert sorted(met) == sorted(map(tuple, masked_lm._around(flat, places).tolist()))
    network = trainer.network
    kinds = counts.kind[flat[places]]
    assert network.log_p_of(flat, places, kinds) == pytest.approx([network.log_p(masked_lm._around(flat, places[i : i + 1]))[1][0, k] for i, k in enumerate(kinds)], abs=1e-4)


def test_gradients_like_differences():
    rng = np.random.default_rng(3)
    network = masked_lm.Network(np.ones(masked_lm.CLASSES))
    for k in network.NAMES:
        setattr(network, k, getattr(network, k).astype(np.float64) + rng.normal(0, 0.1, getattr(network, k).shape))
    around, kinds = rng.integers(0, 6, (40, 4)), rng.integers(0, 9, 40)
    mean = lambda: network.log_p(around)[1][np.arange(40), kinds].mean()
    for k, g in network.gradients(around, kinds).items():
        x = getattr(network, k)
        rows, sums = g if k == "e" else (np.arange(len(x)), g)
        for _ in range(8):
            i = rng.integers(len(rows))
            at = (rows[i], *(rng.integers(m) for m in x.shape[1:]))
            before, h = x[at], 1e-5
            x[at] = before + h
            up = mean()
            x[at] = before - h
            slope = (up - mean()) / (2 * h)
            x[at] = before
            assert np.asarray(sums)[(i, *at[1:])] == pytest.approx(slope, abs=1e-6)


def test_sums_of_rows_like_one_by_one():
    rng = np.random.default_rng(4)
    for n, kinds in ((1, 1), (40, 3), (4096, 2000), (4096, 9)):
        keys, of, values = (rng.integers(0, kinds, n) ** 2).astype(np.int16), rng.integers(0, 50, n), rng.normal(0, 1, (50, 6))
        want = np.zeros((int(keys.max()) + 1, 6))
        np.add.at(want, keys, values[of])
        at, sums = masked_lm._summed(keys, of, values)
        assert sorted(at.tolist()) == np.unique(keys).tolist() and sums == pytest.approx(want[at])


def test_steps_use_the_room_there_is():
    """A step makes no table of all rows and none of all classes for each token; large weights give finite steps."""
    rng = np.random.default_rng(6)
    network, squares = masked_lm.Network(np.ones(masked_lm.CLASSES)), {}
    around, kinds = rng.integers(0, masked_lm.SYMBOLS, (masked_lm.BATCH, 4)), rng.integers(0, masked_lm.CLASSES, masked_lm.BATCH)
    network.step(around, kinds, squares)
    tracemalloc.start()
    network.step(around, kinds, squares)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1.8e6
    for bound in (50, 79, 200):
        network.o *= bound / np.abs(network._weights()[0]).sum(0).max()
        found = network.gradients(around, kinds)
        assert all(np.isfinite(g[1] if k == "e" else g).all() for k, g in found.items())


def test_order_and_support_by_other_documents_raise_scores(spark):
    """Texts in the corpus's order score above the same words shuffled, copies above texts that occur once."""
    rng = random.Random(5)
    follow = {i: [rng.randrange(60) for _ in range(2)] for i in range(60)}
    rows = []
    for i in range(400):
        w, own = rng.randrange(60), []
        for _ in range(80):
            own.append(f"w{w}")
            w = rng.choice(follow[w])
        rows.append((i, " ".join(own), "en"))
    rare = lambda k: " ".join(f"rare{k}x{j} w{rng.randrange(60)}" for j in range(20))
    shuffled = [(1000 + i, " ".join(rng.sample(t.split(), 80)), "en") for i, t, _ in rows[:40]]
    copies, single = [rare(k) for k in range(20)], [rare(100 + k) for k in range(20)]
    rows += shuffled + [(2000 + 10 * k + j, t, "en") for k, t in enumerate(copies) for j in range(2)] + [(3000 + k, t, "en") for k, t in enumerate(single)]
    got = {r.id: r.mean_log_likelihood for r in masked_lm.score(docs_of(spark, rows)).collect()}
    assert sum(got[1000 + i] < got[i] for i in range(40)) > 36
    assert min(got[2000 + 10 * k] for k in range(20)) > max(got[3000 + k] for k in range(20))


def test_scores_of_odd_rows(spark):
    rows = [(1, None, None), (1, "", "en"), (2, " \n ", "en"), (3, "one", "en"), (3, "one", "en"), (4, "a b " * 300_000, "en"), (None, "a b", "en")]
    got = masked_lm.score(docs_of(spark, rows)).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 0, 1, 1, 2, 600_000]
    assert all((r.mean_log_likelihood is None) == (r.n_tokens == 0) and math.isfinite(r.log_likelihood) for r in got)
    assert masked_lm.score(docs_of(spark, [])).count() == 0


# --- 4: q-grams in bands


def brute_distance(item, text):
    """Least edits between item and any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks_like_brute_force():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(12, 30))) for i in range(8)]
    (index,) = decontaminate.build(items)
    place = {i: k for k, i in enumerate(index.ids)}
    for trial in range(60):
        i, own = items[trial % 8]
        changed = list(decontaminate.normalise(own))
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(changed))
            kind = rng.randrange(3)
            if kind == 0:
                changed[at] = rng.choice("xyz")
            elif kind == 1:
                del changed[at]
            else:
                changed.insert(at, rng.choice("xyz"))
        doc = decontaminate.normalise(text(15) + " " + "".join(changed) + " " + text(15))
        got = {m[0]: m for m in decontaminate.matches(doc, decontaminate._points(doc), index)}
        for k, want in enumerate(index.texts):
            d = brute_distance(want, doc)
            assert (k in got) == (d <= index.edits[k]), (trial, k, d)
            if k in got:
                assert got[k][3] == d and brute_distance(want, doc[got[k][1] : got[k][2]]) == d
        assert place[i] is not None


@pytest.mark.parametrize("length", [12, 17, 19, 20, 21, 23, 24, 39, 40, 41, 60])
def test_short_items_have_all_their_edits(length):
    """Every item is found with length // 20 edits, wherever these are, and with no more."""
    rng = random.Random(length)
    item = "".join(rng.choice("abcdef ") for _ in range(length - 2)).replace("  ", "ab").join("xy")
    want = decontaminate.normalise(item)
    most, indexes = int(len(want) * 0.05), decontaminate.build([(1, item)])
    for _ in range(40):
        for edits in (most, most + 1):
            own = list(want)
            for at in rng.sample(range(1, len(own) - 1), edits):
                own[at] = "#"
            doc = "zz zz " + "".join(own) + " zz"
            found = list(decontaminate.found_in(doc, indexes))
            assert [f[3] for f in found] == ([edits] if brute_distance(want, doc) <= most else [])


def test_items_under_a_q_gram_are_found_as_whole_words():
    indexes = decontaminate.build([(1, "2 + 2 = 4?"), (2, "Is it?"), (3, "cat"), (4, ""), (5, None), (6, "x" * 11)])
    found = lambda t: sorted(decontaminate.found_in(decontaminate.normalise(t), indexes))
    assert found("so 2 + 2 =  4? yes") == [(1, 3, 13, 0)] and found("12 + 2 = 4?") == []
    assert found("concatenate cats") == [] and found("concat cat") == [(3, 7, 10, 0)] and found("CAT") == [(3, 0, 3, 0)]
    assert [f[0] for f in found("this it? is it? cat-cat")] == [2, 3, 3]
    assert found("") == [] and found("x" * 12) == []


def test_planted_leaks_of_the_query(spark, small):
    docs, items = (pd.read_parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    norm = decontaminate.normalise
    want = {(int(d), int(i)) for d, t in zip(docs.doc_id, map(norm, docs.text)) for i, x in zip(items.item_id, map(norm, items.text)) if x in t}
    got = {(r.doc_id, r.item_id) for r in queries.op4_decontamination(spark, small).collect()}
    assert want and want <= got
    assert all(r.edits > 0 for r in queries.op4_decontamination(spark, small).collect() if (r.doc_id, r.item_id) not in want)


def test_leaks_of_odd_rows(spark, monkeypatch):
    leak = "The quick brown fox jumps over the lazy dog and sleeps"
    items = spark.createDataFrame([(1, leak), (2, None), (3, "shorter"), (4, leak), (5, "another passage that is long enough to be found")], "item_id long, text string")
    rows = [(1, None, "en"), (2, "", "en"), (3, f"x {leak.upper()}\n y", "en"), (3, f"x {leak.upper()}\n y", "en"), (4, "clean " * 200_000, "en"), (5, leak.replace("quick", "quiet"), "en")]
    docs = docs_of(spark, rows).withColumnRenamed("source", "item_id")
    for size in (1_000_000, 60):  # the second takes several passes
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", size)
        got = sorted((r.doc_id, r.item_id, r.edits) for r in decontaminate.find(docs, items).collect())
        assert got == [(3, 1, 0), (3, 1, 0), (3, 4, 0), (3, 4, 0), (5, 1, 2), (5, 4, 2)]
        kept = decontaminate.remove(docs, items)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    assert decontaminate.find(docs.limit(0), items).count() == 0 and decontaminate.find(docs, items.limit(0)).count() == 0


# --- 5: decision lists


def brute_counts(text):
    words = text.encode().split()
    seen = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if seen[w] > 1:
            inside |= {i, i + 1, i + 2}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in lines
            lines.add(line)
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def test_statistics_of_the_query(spark, small):
    docs = pd.read_parquet(f"{small}/documents.parquet")
    want = {int(i): brute_counts(t) for i, t in zip(docs.doc_id, docs.text)}
    got = queries.op5_quality_rules(spark, small).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got} == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)


def brute_features(text):
    """The statistics that rules test, from the text alone."""
    n, chars, symbols, dup, repeats = brute_counts(text)
    words, lines = text.encode().split(), [x for x in text.split("\n") if x.encode().split()]
    share = lambda a, b: a / max(b, 1)
    return {
        "words": float(n), "symbols_per_word": share(symbols, n), "repeat_share": share(repeats, n), "dup_line_share": share(dup, len(lines)),
        "upper_share": share(sum("A" <= c <= "Z" for c in text), chars), "digit_share": share(sum("0" <= c <= "9" for c in text), chars),
        "marks_per_word": share(sum(c in "!?;:" for c in text), n), "distinct_share": share(len(set(words)), n),
        "word_length": share(chars, n), "longest_word": float(max(map(len, words), default=0)),
    }


def test_verdicts_of_the_query_like_brute_force(spark, small):
    """kept, document by document: the base rules, then the first learned rule all of whose tests hold."""
    read = lambda t: spark.read.parquet(f"{small}/{t}.parquet")
    _, rules = quality_rules.judge(read("documents"), read("labels"))
    got, rejected = {r.doc_id: r for r in queries.op5_quality_rules(spark, small).collect()}, 0
    assert rules
    for r in read("documents").collect():
        x = brute_features(r.text or "")
        base = x["words"] < 50 or 100 * x["repeat_share"] > 50
        hit = any(all(x[name] <= cut if op == "<=" else x[name] > cut for name, op, cut in rule.tests) for rule in rules)
        assert (got[r.doc_id].base_failed, got[r.doc_id].kept) == (base, not base and not hit)
        rejected += not base and hit
    assert rejected


def test_first_test_of_a_rule_like_exhaustive_search():
    rng = np.random.default_rng(12)
    for _ in range(20):
        x = {k: rng.integers(0, 9, 60).astype(float) for k in "abc"}
        bad = (x["a"] > 5) & (rng.random(60) < 0.8) | (rng.random(60) < 0.1)
        base, best = math.log2(bad.mean()), 0.0
        for v in x.values():
            for cut in sorted(set(v))[:-1]:
                for hit in (v <= cut, v > cut):
                    p, n = (bad & hit).sum(), (~bad & hit).sum()
                    best = max(best, p * (math.log2(p / (p + n)) - base) if p else 0.0)
        first = quality_rules.Rule(quality_rules._grow(x, bad, 1).tests)
        hit = first.covers(x)
        p, n = (bad & hit).sum(), (~bad & hit).sum()
        assert p * (math.log2(p / (p + n)) - base) == pytest.approx(best)


def test_counts_of_odd_texts():
    for t in ("", " ", "a", "a b c a b c", "x\n\nx\n x\n", "é\u00a0ü # |", "a b c d a b c e", "n " * 50):
        assert quality_rules.text_counts(t)[:5] == brute_counts(t), t


def test_rules_hold_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    out = labels.where("doc_id % 3 = 0")
    found, rules = quality_rules.judge(docs, labels.where("doc_id % 3 <> 0"))
    p = found.join(out, found["id"] == out["doc_id"]).where("not base_failed").toPandas()
    assert rules and len(p) > 500
    assert p[p.quality == 1].kept.mean() > 0.99 and p[p.quality == 0].kept.mean() < 0.3
    # the Spark expression says what the rules say
    whole = found.toPandas()
    hit = np.zeros(len(whole), bool)
    for r in rules:
        hit |= r.covers({k: whole[k].to_numpy(float) for k in quality_rules.FEATURES})
    assert (whole.kept == (~whole.base_failed & ~hit)).all()


def test_rules_of_odd_rows(spark):
    docs = docs_of(spark, [(1, None, "en"), (1, "a " * 60, "en"), (2, " ".join(f"w{i}" for i in range(60)), "en"), (None, "x", "en")])
    none = spark.createDataFrame([], "doc_id long, quality int, text string")
    found, rules = quality_rules.judge(docs, none)
    assert rules == [] and sorted((r.n_words, r.kept) for r in found.collect()) == [(0, False), (1, False), (60, False), (60, True)]
    some = spark.createDataFrame([(1, 0, "t"), (2, 1, "t"), (2, None, "t"), (None, 0, "t")], "doc_id long, quality int, text string")
    assert quality_rules.judge(docs, some)[0].count() == 4 and quality_rules.judge(docs.limit(0), some)[0].count() == 0


# --- 9: hypervectors


def test_language_of_held_out_documents(spark, small):
    docs = pd.read_parquet(f"{small}/documents.parquet").set_index("doc_id")
    got = queries.op9_language_id(spark, small).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    own = got[got.held_out]
    assert (own.lang_pred == docs.lang[own.doc_id].to_numpy()).mean() > 0.98 and got.score.between(0, 1).all()


def letter_vector(c):
    return np.random.default_rng([language_id.SEED, c]).choice(np.array([-1, 1], np.int8), language_id.DIMENSIONS).astype(int)


def brute_bundle(text, memo={}):  # noqa: B006
    """The sum over all trigrams, each bound anew from its letters' vectors."""
    points = [0]
    for ch in text.lower():
        if ch.isalpha() or points[-1]:
            points.append(ord(ch) if ch.isalpha() else 0)
    points += [0] if points[-1] else []
    out = np.zeros(language_id.DIMENSIONS, int)
    for a, b, c in zip(points, points[1:], points[2:]):
        if (a, b, c) not in memo:
            memo[a, b, c] = np.roll(letter_vector(a), 2) * np.roll(letter_vector(b), 1) * letter_vector(c)
        out += memo[a, b, c]
    return out


def test_bundles_like_definition(monkeypatch):
    for text in ("Abba, ähm 12 Ωσ", "дом домой 東京 𝔞𝔟", "a", "a!", "the cat " * 3000):
        for remembered, at_a_time in ((1 << 15, 1 << 12), (4, 3)):
            monkeypatch.setattr(language_id, "REMEMBERED", remembered)
            monkeypatch.setattr(language_id, "SLICE", at_a_time)
            e = language_id.Encoder()
            for _ in range(2):
                assert (e.bundle(*e.trigrams(text)) == brute_bundle(text)).all(), text
    long = language_id.Encoder().trigrams("the cat " * 20_000)
    assert long[1].sum() == 159_999  # " the cat the cat ... cat " has one gap for every word and one more


def test_language_query_like_brute_force(spark, tiny):
    docs = pd.read_parquet(f"{tiny}/documents.parquet")
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in docs.doc_id]
    vectors = [brute_bundle(t or "") for t in docs.text]
    protos = {}
    for v, lang, out in zip(vectors, docs.lang, held):
        if not out and lang is not None:
            protos[lang] = protos.get(lang, 0) + v
    got = {r.doc_id: r for r in queries.op9_language_id(spark, tiny).collect()}
    assert len(got) == len(docs)
    cos = lambda a, b: a @ b / math.sqrt(float(a @ a) * float(b @ b))
    for i, v, out in zip(docs.doc_id, vectors, held):
        want = max((cos(v, protos[k]), k) for k in sorted(protos)) if v.any() else (0.0, "und")
        assert got[i].held_out == out and got[i].lang_pred == want[1] and got[i].score == pytest.approx(max(0.0, want[0]), abs=1e-6)


def test_scripts_are_told_apart(spark):
    """Letters far beyond a to z keep vectors of their own."""
    say = {"ru": "все люди рождаются свободными и равными в своём достоинстве и правах", "uk": "всі люди народжуються вільними і рівними у своїй гідності та правах", "el": "όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι", "zh": "人人生而自由在尊嚴和權利上一律平等他們賦有理性和良心", "ja": "すべての人間は生まれながらにして自由でありかつ尊厳と権利とについて平等である"}
    rows = [(10 * k + j, t, lang) for k, (lang, t) in enumerate(say.items()) for j in range(10)]
    got = {r.id: r.lang_pred for r in language_id.identify(docs_of(spark, rows)).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_languages_of_odd_rows(spark):
    rows = [(i, "the cat sat on the mat and the dog", "en") for i in range(20)] + [(i, "der hund und die katze sind nicht hier", "de") for i in range(20, 40)]
    rows += [(50, None, "en"), (51, "", None), (52, "123 !!", "de"), (None, "the dog", "xx"), (53, "the mat", None), (53, "the mat", None), (54, "und die " * 100_000, None), (55, "𝔞𝔟 𐐀𐐁", None)]
    got = language_id.identify(docs_of(spark, rows).withColumnRenamed("source", "held_out")).collect()
    pred = {r.id: r for r in got}
    assert len(got) == 48 and pred[53].lang_pred == "en" and pred[54].lang_pred == "de" and all(pred[i].lang_pred == "und" and pred[i].score == 0 for i in (50, 51, 52))
    assert pred[None].held_out is False and pred[None].lang_pred == "en" and "xx" not in {r.lang_pred for r in got}
    kept = language_id.reject(docs_of(spark, rows), 0.05)
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ") and {50, 51, 52}.isdisjoint({r.doc_id for r in kept.collect()})
    assert [r.doc_id for r in language_id.reject(docs_of(spark, [(1, "abc", None), (2, "12", None)]), 0.05).collect()] == [1]
    nothing = language_id.identify(docs_of(spark, [(1, "abc", None)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert language_id.identify(docs_of(spark, [])).count() == 0


def test_texts_of_no_known_language_are_rejected(spark, small):
    import base64

    import corpus_pipeline

    rng = random.Random(6)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    polish = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa każdy człowiek posiada wszystkie prawa i wolności zawarte w niniejszej deklaracji bez względu na różnice rasy koloru płci języka"
    odd = [" ".join(word() for _ in range(500)) for _ in range(5)] + [base64.b64encode(rng.randbytes(3000)).decode() for _ in range(5)] + [rng.randbytes(3000).hex() for _ in range(5)] + [polish]
    rows = docs_of(spark, [(-1 - k, t, None) for k, t in enumerate(odd)]).selectExpr(*[f"cast({c} as {t}) as {c}" for c, t in docs.dtypes])
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, docs.unionByName(rows), small).select("doc_id").collect()}
    own = {r.doc_id for r in docs.where(r"text rlike '\\p{L}'").select("doc_id").collect()}
    assert min(kept) >= 0 and len(own - kept) <= len(own) // 500
