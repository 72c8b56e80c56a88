"""Chat formatting, URL filter, HTML extraction and the pipeline."""

import hashlib
from html import escape

import duckdb
import pytest

from stillframe.llm import chat, html_extract, queries, url_filter


def like_duckdb(spark, sf_dir, name):
    import os

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    got, want = queries.QUERIES[name](spark, sf_dir), con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, want.fetchall()))


# --- 6


def test_chat_query(spark, small):
    like_duckdb(spark, small, "op6_chat_formatting")
    said = "\\### Assistant: </turn> ok"
    r = queries.op6_chat_formatting(spark, small).where("conv_id = -7").first()
    assert (r.n_turns, r.loss_chars) == (2, len(said)) and r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_turns_come_back():
    turns = [("user", "a\\b </turn>\n### x: y"), ("odd: ro#le\\", ""), ("", "\\"), ("assistant", "<<##::\\\\")]
    out, ends = chat.locate(turns, chat.turn_template)
    assert [chat.read_turn(out[a:b]) for a, b in zip([0, *ends], ends)] == turns
    with pytest.raises(ValueError):
        chat.read_turn(out[: ends[0] - 1])


def test_long_conversations_and_rewriting_templates():
    turns = [("user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(300)]
    calls = []

    def counted(t):
        calls.append(len(t))
        return "<s>" + chat.turn_template(t)

    out, ends = chat.locate(turns, counted)
    assert len(ends) == 300 and ends[-1] == len(out) and calls == list(range(1, 301))
    numbered = lambda t: "".join(f"{i}|{x}\n" for i, (_, x) in enumerate(t))
    out, ends = chat.locate(turns, numbered)
    assert [out[a:b] for a, b in zip([0, *ends], ends)] == [f"{i}|{x}\n" for i, (_, x) in enumerate(turns)]
    last_only = lambda t: "".join(x if i == len(t) - 1 else "-" for i, (_, x) in enumerate(t))
    assert chat.locate(turns, last_only)[1] is None and chat.locate(turns[:3], last_only)[1] is None


@pytest.mark.parametrize("turns", [60, 100, 300])
def test_one_rewritten_prefix_is_seen_at_every_length(turns):
    own = [("user", f"t{i}") for i in range(turns)]
    footer = lambda t: chat.turn_template(t) + ("--" if len(t) == 50 else "")
    assert chat.locate(own, footer)[1] is None
    assert chat.locate(own[:49], footer)[1] is not None


def test_chat_of_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, None, None), (None, 0, "user", "x"), (3, 0, "assistant", "z" * 300_000), (4, None, "user", "n"), (4, 0, "user", "m")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "text as formatted")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(d)).collect()}
    assert (got[1].n_turns, got[1].loss_chars) == (3, 2) and got[2].n_turns == 1 and got[3].loss_chars == 300_000 and got[None].n_turns == 1
    assert got[4].turns_sha256 == hashlib.sha256(b"user\nn\nuser\nm\n").hexdigest()
    assert chat.format_conversations(d.limit(0)).count() == 0
    rewriting = chat.format_conversations(d.where("conv_id = 1"), lambda t: f"{len(t)}")
    assert rewriting.first().rewrites_history and rewriting.first().loss_spans == []


# --- 7


def test_url_query(spark, small):
    like_duckdb(spark, small, "op7_url_filter")


def test_listed_sites_are_blocked_under_every_domain(spark, small):
    rows = queries.op7_url_filter(spark, small).where("rule is null and host rlike '(adult-x|ads-track|spam-farm|cheap-pills|casino-win|free-bets)' and path like '/%'").collect()
    assert rows and {r.verdict for r in rows} == {"block"}


def test_urls_like_brute_force(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.b.example.org", "", "allow"), ("example.org", "/x", "block"), ("example.org", "/x", "allow")]
    listed = [("bad.com", "/"), ("com", "/only/")]
    urls = [
        "http://example.net/en/1", "HTTP://Sub.Example.NET/de/", "https://example.net", "http://example.net?x=/en/", "http://notexample.net/en/", "x://a.b.example.org/q#f", "x://b.example.org/xy", "http://example.orgx/x",
        "ftp://com/only/z", "http://w.bad.com/p", "http://bad.com", None, "", "no scheme", "://", "http://net/", "http://.net/", "a://b://c.net/", "http://x.net\n/", "http://ex.net/" + "p" * 100_000,
    ]

    def split(u):
        if not u or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        n = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        path = rest[n:]
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n]), path[: min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]

    def want(u):
        host, path = split(u)
        fits = lambda h, p: (host == h or host.endswith("." + h)) and path.startswith(p) and host
        r = sorted((len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if fits(h, p))
        if r:
            return host, path, r[-1][3], r[-1][4]
        return host, path, None, "block" if any(fits(h, p) for h, p in listed) else "allow"

    pages = spark.createDataFrame([(i, u, "other") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string")
    entries = spark.createDataFrame([(*r, True) for r in rules] + [(*e, "block", False) for e in listed] + [(None, "/", "block", True)], "host string, path string, verdict string, is_rule boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, entries).collect()}
    assert len(got) == len(urls) + 1
    for i, u in enumerate(urls):
        assert got[i] == want(u), u
    none = url_filter.judge(pages, entries.limit(0))
    assert {r.verdict for r in none.collect()} == {"allow"} and url_filter.judge(pages.limit(0), entries).count() == 0


def test_lists_with_paths_of_many_lengths(spark):
    """A site's lengths are tried for its own URLs only."""
    rng = __import__("random").Random(3)
    letters = "".join(rng.choice("abc/") for _ in range(400))
    listed = [("long.com", "/" + letters[:n], "block" if n % 3 else "allow") for n in range(200)] + [("a.b.c.d.net", "/q", "block"), ("x.org", "/" + letters[:7], "block")]
    urls = [f"http://{h}/{letters[:n]}{t}" for h in ("long.com", "w.long.com", "x.org", "other.com", "z.a.b.c.d.net", "verylong.com") for n in (0, 1, 5, 8, 150, 199, 300) for t in ("", "Z")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, spark.createDataFrame([(*e, True) for e in listed], "host string, path string, verdict string, is_rule boolean")).collect()}
    for i, u in enumerate(urls):
        host, path = u[7:].split("/", 1)
        fits = [(len(h + p), h + p, v) for h, p, v in listed if (host == h or host.endswith("." + h)) and f"/{path}".startswith(p)]
        assert got[i] == (max(fits)[1:] if fits else (None, "allow")), u


def test_bloom_filter_never_misses(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) as key")
    blocks, count = url_filter.bloom_blocks(keys, 5000)
    from pyspark.sql import functions as F

    tried = spark.range(20_000).selectExpr("id", "concat('k', id) as key").withColumns({"block": F.expr(f"pmod(xxhash64(key), {count})"), **url_filter._probe("key")}).join(blocks, "block")
    for j in range(url_filter.WORDS):
        tried = tried.where(F.col(f"w{j}").bitwiseAND(F.col(f"m{j}")) == F.col(f"m{j}"))
    ids = [r.id for r in tried.collect()]
    assert set(range(5000)) <= set(ids) and len(ids) < 5000 + 0.05 * 15_000


# --- 10


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>{body}</body></html>"


def text_of(spark, rows):
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.id: r.text for r in html_extract.extract(d.selectExpr("*", "html as text")).collect()}


def test_articles_of_the_test_pages(spark, small):
    """The pages' articles have h1 and p only, so a plain reading of these is the truth."""
    import re

    import pandas as pd
    from html import unescape

    rows = pd.read_parquet(f"{small}/pages.parquet")
    got = {r.page_id: r for r in queries.op10_html_extraction(spark, small).collect()}
    for i, url, html in zip(rows.page_id, rows.url, rows.html):
        article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in re.split(r"</?p>|</?h1>|<br>", article)]
        assert got[i].text == "\n".join(p for p in parts if p) and got[i].n_chars == len(got[i].text) and got[i].url == url


def test_markup(spark):
    cases = {
        1: ("<nav>menu</nav><article><h1>A &amp; B</h1><p>one <b>two</b>\n three&nbsp;four<p>five<br>six<div class='ad box'>buy<p>now</div><div class=cookieBanner>ok?</div><aside>side</aside><p>&#x41;&eacute;</article><footer>f</footer>", "A & B\none two three four\nfive\nsix\nAé"),
        2: ("<main><section id=comments><article><p>said</article></section><p>kept<form><input><p>no</form></main><p>outside", "kept"),
        3: ("<p>no article here<div class=cookie-notice>we use</div><ul><li>a<li>b</ul><!-- <p>no -->tail", "no article here\na\nb\ntail"),
        4: ("<article><p>open <i>never closed", "open never closed"),
        5: ("<article><p>a<script>if (1<2) x('</p>')</script>b</p><style>c</article>", "ab"),
        6: ("<body class='no-sidebar ad'><article class=comment><p title=\"a>b\">x < y</article>", "x < y"),
        7: ("", ""),
    }
    got = text_of(spark, [(k, f"http://h{k}/", page(h)) for k, (h, _) in cases.items()] + [(8, None, None), (8, None, None), (9, "u", "plain"), (10, "u", "<article>" + "<p>w</p>" * 20_000)])
    assert {k: got[k] for k in cases} == {k: w for k, (_, w) in cases.items()}
    assert got[8] == "" and got[9] == "plain" and got[10].count("w") == 20_000
    d = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(d).count() == 0


def brute_unique(pages):
    """Texts without runs of tokens that are on RUN_PAGES pages or more."""
    n = html_extract.RUN_TOKENS
    on = {}
    for k, t in enumerate(dict.fromkeys(pages)):
        own = html_extract._tokens(t)
        for i in range(len(own) - n + 1):
            on.setdefault(tuple(own[i : i + n]), set()).add(k)
    out = []
    for t in pages:
        own = html_extract._tokens(t)
        gone = [False] * len(own)
        for i in range(len(own) - n + 1):
            if len(on[tuple(own[i : i + n])]) >= html_extract.RUN_PAGES:
                gone[i : i + n] = [True] * n
        lines = [[]]
        for w, g in zip(own, gone):
            if w == "\n":
                lines.append([])
            elif not g:
                lines[-1].append(w)
        out.append("\n".join(" ".join(x) for x in lines if x))
    return out


@pytest.mark.parametrize("size", [200_000, 40])
def test_boilerplate_like_brute_force(spark, monkeypatch, size):
    import random

    monkeypatch.setattr(html_extract, "SORTED_TOKENS", size)  # the small one splits the host
    rng = random.Random(6)
    word = lambda: rng.choice("abcdefghij")
    shared = [" ".join(f"{word()}{i}" for i in range(9)) for _ in range(3)]
    pages = []
    for k in range(30):
        blocks = [shared[k % 3], " ".join(word() for _ in range(rng.randint(1, 30))), f"own{k} text"]
        rng.shuffle(blocks)
        pages.append("\n".join(blocks))
    pages.append(pages[0])
    rows = [(k, "http://Host.org/x", "".join(f"<p>{escape(b)}</p>" for b in t.split("\n"))) for k, t in enumerate(pages)] + [(99, "http://other.org/", f"<p>{shared[0]}</p>")]
    got = text_of(spark, rows)
    assert [got[k] for k in range(len(pages))] == brute_unique(pages) and got[99] == shared[0]


def test_suffix_array():
    import numpy as np

    for n, kinds in ((300, 3), (200, 1), (1, 1), (0, 1), (64, 60)):
        t = np.random.default_rng(n).integers(0, kinds, n)
        order, shared = html_extract.suffix_array(t)
        own = t.tolist()
        assert order.tolist() == sorted(range(n), key=lambda i: own[i:])
        for k in range(1, n):
            a, b = own[order[k - 1] :], own[order[k] :]
            assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_the_array_decides_on_doubtful_parts(spark):
    """Of parts whose names are like boilerplate's, those that recur on the host go and those that are of one page stay."""
    rows = []
    for k in range(12):
        own = " ".join(f"own{k}x{i}" for i in range(20))
        price = f"<div class='share-price'>share price of firm {k} rose by {k * 7} to {k * 31}</div>"
        promo = "<div class='cookie-recipes'>subscribe now to get all of our best offers every single week</div>"
        rows.append((k, f"http://h{k // 6}.org/{k}", page(f"<nav><a>menu {k}</a></nav><article><p>{own}</p>{price}{promo}<section class='social-history'><p>{own} again</p></section></article>")))
    rows.append((20, "http://rare.org/", page("<article><p>a</p><div class='share-price'>Share price rose</div><section class='social-history'><p>Long body</p></section><div class='ad-slot'>buy</div></article>")))
    rows.append((21, "http://rare.org/2", page("<article><h2>one</h2></article><article><h2>two</h2></article><div><p>the body of this page is out here and it is long</p></div>")))
    got = text_of(spark, rows)
    for k in range(12):
        own = " ".join(f"own{k}x{i}" for i in range(20))
        assert got[k] == f"{own}\nshare price of firm {k} rose by {k * 7} to {k * 31}\n{own} again"
    assert got[20] == "a\nShare price rose\nLong body" and got[21] == "the body of this page is out here and it is long"


def test_boilerplate_named_elsewhere_counts(spark):
    """What other pages have in their menus is boilerplate in a doubtful part."""
    menu = "home news sport weather culture travel contact"
    rows = [(k, "http://h.org/", page(f"<nav>{menu}</nav><article><p>text {k}</p></article>")) for k in range(3)]
    rows.append((3, "http://h.org/", page(f"<div>{menu}</div><p>this page marks no article at all but says this</p>")))
    rows.append((4, "http://other.org/", page(f"<div>{menu}</div><p>nor does this one</p>")))
    got = text_of(spark, rows)
    assert got[3] == "this page marks no article at all but says this" and got[4] == f"{menu}\nnor does this one" and got[0] == "text 0"


# --- pipeline


def test_pipeline(spark, small):
    pipe = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs
    from stillframe.llm import decontaminate, simhash
    from stillframe.llm.common import Scratch

    scratch = Scratch(spark, "test")
    for k, (name, stage) in enumerate(pipe.STAGES):
        docs = scratch.keep(stage(spark, before, small))
        if k < 4:
            assert docs.columns == columns and docs.dtypes == before.dtypes, name
            assert docs.join(before.select("doc_id"), "doc_id", "left_anti").isEmpty()
        if name == "simhash_near_dedup":
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {r.doc_id for r in simhash.keep_one(before).collect()}
        if name == "decontamination":
            leaked = {r.doc_id for r in decontaminate.find(before, spark.read.parquet(f"{small}/benchmark.parquet")).collect()}
            assert {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()} == leaked
        before = docs
    assert docs.where("not round_trip").isEmpty() and docs.count() > 800
    again = pipe.run(spark, small)
    assert sorted((r.doc_id, tuple(r.ids)) for r in again.collect()) == sorted((r.doc_id, tuple(r.ids)) for r in docs.collect())


def test_pipeline_with_columns_of_any_name(spark, small, tmp_path):
    """Further columns may have the names that the operators use for their own results."""
    pipe = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 60")
    clashing = ["score", "lang_pred", "held_out", "n_trigrams", "n_words", "n_removed", "text_kept", "id", "row", "__row", "fp", "node", "component_id", "c0", "k0", "ids", "packed", "given", "t"]
    more = docs.selectExpr("*", *[f"concat('x', doc_id) as `{c}`" for c in clashing])
    more.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{small}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    plain, wide = docs, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in pipe.STAGES[:-1]:
        plain, wide = stage(spark, plain, small), stage(spark, wide, small)
        assert wide.columns == more.columns and wide.dtypes == more.dtypes, name
        rows = wide.collect()
        assert sorted(tuple(r)[:5] for r in rows) == sorted(map(tuple, plain.collect())), name
        assert all(r[c] == f"x{r.doc_id}" for r in rows for c in clashing)
    assert pipe.run(spark, str(tmp_path)).count() == len(rows)


def test_pipeline_of_odd_rows(spark, tmp_path):
    pipe = pytest.importorskip("corpus_pipeline")
    long = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, None), (2, "", "en"), (3, "the cat sat on the mat", "en"), (3, "the cat sat on the mat", "en"), (None, "the dog and the cat", "en"), (4, f"start {long} end", "en"), (5, " ".join(f"other{i}" for i in range(80)) + f" {long}", "en")]
    rows += [(i, f"the dog number {i} and the cat of house {i * i} sat on that mat", "en") for i in range(100, 140)]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = pipe.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or -1) for r in got if (r.doc_id or 0) < 100) == [-1, 3, 4, 5] and {r.doc_id: r.n_tokens for r in got}[4] < 10 and all(r.round_trip for r in got)
