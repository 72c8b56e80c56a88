"""SimHash groups and substring removal against brute force."""

import hashlib
from collections import Counter

import xxhash

from stillframe.llm import queries, simhash, substring
from stillframe.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], SCHEMA)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{id: least id reachable} for [(id, fingerprint)]."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    fps = sorted({f for _, f in prints})
    for i, a in enumerate(fps):
        root(a)
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[root(b)] = root(a)
    least = {}
    for i, f in prints:
        least[root(f)] = min(i, least.get(root(f), i))
    return {i: least[root(f)] for i, f in prints}


def test_fingerprints_and_components_of_the_query(spark, small):
    import pandas as pd

    rows = pd.read_parquet(f"{small}/documents.parquet")
    want = [(int(i), brute_fingerprint(t)) for i, t in zip(rows.doc_id, rows.text)]
    comp = brute_components(want)
    got = queries.op2_simhash_near_dedup(spark, small).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{f:016x}", comp[i]) for i, f in want}
    assert len(got) == len(want)


def test_links_near_and_hot(spark):
    import random

    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(20):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 4)):
                y ^= 1 << b
            fps.add(y)
            x = y if rng.random() < 0.3 else x
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = brute_components([(s, f) for s, f in zip(signed, fps)])
    from stillframe.llm.components import connected_components

    for pairwise in (2000, 2):  # the second sends every shared bucket the way of the hot ones
        scratch = Scratch(spark, "test")
        found = {r.node: r.component for r in connected_components(simhash.links(table, scratch, pairwise), scratch).collect()}
        groups = {f: found.get(f, f) for f in signed}
        assert all((groups[a] == groups[b]) == (want[a] == want[b]) for a in signed for b in signed)


def test_simhash_edges(spark):
    texts = [None, "", " \n", "one", "One", "a b c d e f", "a b c d e f", "long " * 300_000]
    got = {r.id: r for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert [got[i].fp for i in range(3)] == [0, 0, 0] and {got[i].component_id for i in range(3)} == {0}
    assert got[3].component_id == got[4].component_id == 3 and got[6].component_id == 5
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0
    twice = simhash.near_duplicates(docs_of(spark, ["x y z", "x y z", "q"], [7, 7, None]).withColumnRenamed("lang", "fp")).collect()
    assert sorted((r.id or -1, r.component_id or -1) for r in twice) == [(-1, -1), (7, 7), (7, 7)]


def brute_kept(texts):
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + 35]) for w in split for i in range(len(w) - 34))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def test_substrings_of_the_query(spark, small):
    import pandas as pd

    rows = pd.read_parquet(f"{small}/documents.parquet")
    want = {int(i): (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, (n, g, k) in zip(rows.doc_id, brute_kept(rows.text))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op3_substring_dedup(spark, small).collect()}
    assert got == want


def test_substring_cases(spark):
    import random

    rng = random.Random(3)
    word = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    p, q = word(60), word(36)
    texts = [
        " ".join(word(50) + p + word(20)), " ".join(p), " ".join(word(3) + p[5:41] + word(9)), " ".join(p[:34]), " ".join(word(5) + q + word(5) + q),
        "ha " * 120, "ha " * 36, "a b " * 40, " ".join(word(34)), " ".join(word(35)), None, "", "x", "é ü " * 50, " ".join(q[1:]),
        " ".join(word(10) + p[:40] + ["edit"] + p[41:] + word(3)), " ".join(word(4) + p[10:50] + q),
    ]
    got = {r.doc_id: r for r in substring.remove_repeats(docs_of(spark, texts)).collect()}
    for i, w in enumerate(brute_kept(texts)):
        assert (got[i].n_words, got[i].n_removed, got[i].text_kept) == w, i
    # rows of one id are documents of their own
    ids = [4, 4, None]
    same = substring.remove_repeats(docs_of(spark, [texts[0], texts[1], texts[8]], ids)).collect()
    want = brute_kept([texts[0], texts[1], texts[8]])
    assert sorted((r.n_words, r.n_removed, r.text_kept) for r in same) == sorted(want)
    assert substring.remove_repeats(docs_of(spark, [])).count() == 0
    laid = {r.doc_id: r.text_kept for r in substring.remove_repeats(docs_of(spark, ["top\n" + " ".join(p) + "\n  tail  end\n", " ".join(p)]), layout=True).collect()}
    assert laid == {0: "top\ntail  end\n", 1: ""}


def check_factors(texts, rows):
    """Factors say what their sources say, are long, lie apart but for what windows share, and cover what is repeated."""
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    covered = {i: [False] * len(w) for i, w in words.items()}
    last = {}
    for r in sorted(rows, key=lambda r: (r.id, r.begin)):
        assert r.words >= 35 and (r.id, r.begin) != (r.source, r.source_begin)
        assert words[r.id][r.begin : r.begin + r.words] == words[r.source][r.source_begin : r.source_begin + r.words]
        covered[r.id][r.begin : r.begin + r.words] = [True] * r.words
        if r.id in last:
            assert r.begin > last[r.id].begin + last[r.id].words - 35
            if r.begin == last[r.id].begin + last[r.id].words - 34:  # the next window: the factor before went on nowhere
                assert (r.source, r.source_begin - r.begin) != (last[r.id].source, last[r.id].source_begin - last[r.id].begin)
        last[r.id] = r
    where = {}
    for i, w in words.items():
        for k in range(len(w) - 34):
            where.setdefault(tuple(w[k : k + 35]), []).append((i, k))
    want = {i: [False] * len(w) for i, w in words.items()}
    for places in where.values():
        if len(places) > 1:
            for i, k in places:
                want[i][k : k + 35] = [True] * 35
    assert covered == want
    return len(rows)


def test_factors(spark, small):
    import random

    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert check_factors({r.doc_id: r.text for r in docs.collect()}, substring.factors(docs).collect()) > 100
    rng = random.Random(8)
    base = [f"b{i}" for i in range(400)]
    texts = {0: " ".join(base)}
    for i in range(1, 40):  # stretches of the base, some behind each other, some in doubled words
        own = []
        for _ in range(rng.randint(1, 5)):
            a = rng.randrange(360)
            own += base[a : a + rng.randint(5, 200)] + [f"x{i}"] * rng.randrange(60)
        texts[i] = " ".join(own)
    got = substring.factors(docs_of(spark, list(texts.values()), list(texts))).collect()
    check_factors(texts, got)
    whole = substring.factors(docs_of(spark, [" ".join(base)] * 2 + [" ".join(base[50:300])], [1, 2, 3])).collect()
    assert sorted((r.id, r.begin, r.words, r.source, r.source_begin) for r in whole if r.id == 3) == [(3, 0, 250, 1, 50)]


def test_long_documents_in_pieces(spark, monkeypatch):
    import random

    monkeypatch.setattr(substring, "CHUNK", 50)
    rng = random.Random(8)
    w = [f"v{rng.randrange(40)}".encode() for _ in range(400)]
    whole = [b for part in substring.blocks(w) for b in zip(*(x.tolist() for x in part))]
    assert sum(b[3] for b in whole) == 366 and [b[2] for b in whole] == sorted(b[2] for b in whole)
    import numpy as np

    starts = np.arange(366)
    a, _ = substring.window_hashes(w, starts)
    monkeypatch.setattr(substring, "CHUNK", 1 << 20)
    assert (a == substring.window_hashes(w, starts)[0]).all()


def brute_kept_ids(rows, similarity=0.8):
    """Least ids of the groups by shared five-word shingles, the stage's only rule; texts without words are one group."""
    sets, parent = {}, {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        root(a)
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or (both and both >= similarity * (len(sets[a]) + len(sets[b]) - both)):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {root(i) for i in ids}


def test_one_of_each_group(spark, small):
    import random

    import pandas as pd

    rng = random.Random(11)
    docs = pd.read_parquet(f"{small}/documents.parquet").head(300)
    rows = list(zip(docs.doc_id.tolist(), docs.text))
    long = [t for t in docs.text if len(t.split()) > 150]
    for k in range(60):  # near copies with some words changed
        words = long[k % 20].split()
        for _ in range(rng.randint(1, max(2, len(words) // 60))):
            words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
        rows.append((10_000 + k, " ".join(words)))
    table = docs_of(spark, [t for _, t in rows], [i for i, _ in rows])
    for bucket in (64, 2):  # the second compares every bucket in blocks
        simhash.SMALL_BUCKET, before = bucket, simhash.SMALL_BUCKET
        try:
            kept = simhash.keep_one(table)
        finally:
            simhash.SMALL_BUCKET = before
        assert kept.columns == table.columns
        assert {r.doc_id for r in kept.collect()} == brute_kept_ids(rows)


def edited_copies(rng, n, words=300):
    """``n`` texts of one base, each with 0.3 to 2.5 % of its words changed."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for at in rng.sample(range(words), rng.randint(words * 3 // 1000 or 1, words * 25 // 1000)):
            own[at] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_large_buckets_like_brute_force(spark, monkeypatch):
    """Groups of edited copies hold together by pairs that no chosen text is part of."""
    import random

    texts = edited_copies(random.Random(7), 400)
    want = brute_kept_ids(list(enumerate(texts)))
    for shingles in (simhash.BLOCK_SHINGLES, 30_000):  # the second deals a bucket into several blocks
        monkeypatch.setattr(simhash, "BLOCK_SHINGLES", shingles)
        assert {r.doc_id for r in simhash.keep_one(docs_of(spark, texts)).collect()} == want


def test_repeated_lines_do_not_hide_copies(spark):
    import random

    rng, texts = random.Random(21), []
    for _ in range(60):  # a pair has the same words but two, and the line 50 times or twice
        w, line = ([f"v{rng.randrange(10**6)}" for _ in range(n)] for n in (300, 30))
        texts += [" ".join(w + line * 50), " ".join(w + ["another", "end"] + line * 2)]
    want = brute_kept_ids(list(enumerate(texts)))
    assert want == set(range(0, 120, 2))
    assert {r.doc_id for r in simhash.keep_one(docs_of(spark, texts)).collect()} == want


def test_a_shared_line_makes_no_copies(spark):
    import random

    rng, texts = random.Random(22), []
    for _ in range(60):
        line = [f"l{rng.randrange(10**6)}" for _ in range(30)] * 50
        texts += [" ".join([f"v{rng.randrange(10**6)}" for _ in range(300)] + line) for _ in range(2)]
    assert simhash.keep_one(docs_of(spark, [*texts, "", None])).count() == 121


def test_kept_rows_of_odd_tables(spark):
    rows = docs_of(spark, [None, "", "a b c", "a b c", "x " * 200_000], [1, 2, 3, 3, None])
    assert sorted((r.doc_id or -1) for r in simhash.keep_one(rows).collect()) == [-1, 1, 3]
    assert simhash.keep_one(rows.limit(0)).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    import random

    from stillframe.llm.components import connected_components

    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 64)] + [(1000 + i, 999) for i in range(50)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(300, 300), (5, 6), (6, 5), (None, 3)]
    order = list(range(2000, 2040))
    rng.shuffle(order)
    edges += list(zip(order, order[1:]))
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    want = {**{i: 0 for i in range(65)}, **{i: 999 for i in range(999, 1050)}, **{i: 200 for i in range(200, 209)}, **{i: 2000 for i in order}}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def test_components_of_a_long_chain_in_few_rounds(spark):
    from stillframe.llm.components import connected_components

    class Counted(Scratch):
        kept = 0

        def keep(self, df):
            Counted.kept += 1
            return super().keep(df)

    edges = spark.range(2000).selectExpr("id as a", "id + 1 as b")
    got = connected_components(edges, Counted(spark, "test"))
    assert got.count() == 2001 and got.where("component <> 0").isEmpty()
    assert (Counted.kept - 1) / 4 < 12
