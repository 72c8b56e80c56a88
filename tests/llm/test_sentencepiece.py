"""Viterbi pieces against the library's own unigram search, and exact round trips."""

import gc
import os
import random
import struct
import tracemalloc
import weakref

import numpy as np
import pytest

from stillframe.llm import sentencepiece_viterbi as sv

pytestmark = pytest.mark.skipif(not os.path.exists(sv.MODEL), reason="no vocabulary file here")


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def proto(pieces, kinds, scores, squeeze=False, kind=1):
    """A model file of the given type."""
    message = lambda number, body: varint(number << 3 | 2) + varint(len(body)) + body
    own = (message(1, message(1, p.encode()) + b"\x15" + struct.pack("<f", s) + b"\x18" + varint(k)) for p, k, s in zip(pieces, kinds, scores))
    byte_fallback = b"\x98\x02\x01" if sv.BYTE in kinds else b""
    return b"".join(own) + message(2, b"\x18" + varint(kind) + byte_fallback) + message(3, message(1, b"identity") + b"\x18\x01\x20" + varint(int(squeeze)) + b"\x28\x01")


@pytest.fixture(scope="module")
def codec():
    return sv.Codec(sv.load())


@pytest.fixture(scope="module")
def library(codec):
    """The library's unigram search with the same log scores."""
    import sentencepiece

    m = codec.m
    return sentencepiece.SentencePieceProcessor(model_proto=proto(m.pieces, m.kinds, m.scores.tolist()))


def samples():
    rng = random.Random(4)
    alphabet = "abcdefgh  étß中文\n\tΩ😀.,!0123" + " the and of "
    texts = ["", " ", "  ", "a", "Hello world", " Hello  world\nfoo   bar é中 ", "\n\n a\n", "x" * 40, "ab " * 200, "é" * 300, "the" * 200, "日本語のテキスト", "​ tab\there", "<0x0A> <s> </s> <unk>"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(200)]
    return texts


def total(codec, ids):
    return sum(float(codec.m.scores[i]) if not codec.is_byte[i] else 0.0 for i in ids)


def brute(codec, text):
    """The best cut of a text by plain dynamic programming; of equal ones that whose last piece begins first."""
    m = codec.m
    known = {p: i for i, (p, k) in enumerate(zip(m.pieces, m.kinds)) if k in (sv.NORMAL, sv.USER_DEFINED)}
    text = sv.MARKER + text.replace(" ", sv.MARKER) if text else ""
    best = [(0.0, 0, None)] + [(float("-inf"), 0, None)] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - codec.longest), end):
            i = known.get(text[begin:end], -1 if end - begin == 1 else None)
            if i is not None:
                score = best[begin][0] + (m.scores[i] if i >= 0 else codec.unknown_score)
                if score > best[end][0]:
                    best[end] = (score, begin, i)
    out, at = [], len(text)
    while at:
        _, begin, i = best[at]
        out[:0] = [i] if i >= 0 else codec._bytes(text[begin:at])
        at = begin
    return out


def as_good(codec, got, want):
    """Cuts of a long text may differ where two have the same score but for rounding."""
    return codec.decode(got) == codec.decode(np.array(want)) and total(codec, got) == pytest.approx(total(codec, want), rel=1e-9) and sum(a == b for a, b in zip(got, want)) > 0


def words_of(sf_dir):
    import pandas as pd

    return sorted({w for t in pd.read_parquet(f"{sf_dir}/documents.parquet").text for w in t.split()})


def test_best_cuts_like_brute_force(codec, tiny):
    texts = samples() + words_of(tiny)[:4000]
    for t, got in zip(texts, codec.encode(texts)):
        assert got.tolist() == brute(codec, t), repr(t)


def test_no_worse_than_the_library(codec, library, small):
    """The library's search in single precision finds most of the best cuts and none that are better."""
    texts = samples() + words_of(small)
    got = [g.tolist() for g in codec.encode(texts)]
    want = [library.encode(t) for t in texts]
    assert all(total(codec, g) >= total(codec, w) - 1e-6 for g, w in zip(got, want))
    assert sum(g == w for g, w in zip(got, want)) > 0.98 * len(texts)


def test_whole_documents_like_brute_force(codec, tiny):
    """The query's own numbers, over whole texts."""
    import pandas as pd

    texts = [t or "" for t in pd.read_parquet(f"{tiny}/documents.parquet").text][:60]
    for t, got in zip(texts, codec.encode(texts)):
        assert not t or as_good(codec, got, brute(codec, t))


def test_query_like_brute_force(spark, codec, tiny):
    from stillframe.llm import queries

    rows = queries.op8_sentencepiece(spark, tiny).join(spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    for r in sorted(rows, key=lambda r: len(r.text or ""))[:100]:
        assert not r.text or as_good(codec, np.array(r.ids), brute(codec, r.text))


def test_log_scores_favour_whole_words(codec):
    """Log probabilities sum to one, and known words come as few pieces."""
    m = codec.m
    normal = np.array([k == sv.NORMAL for k in m.kinds])
    assert np.exp(m.scores[normal]).sum() == pytest.approx(1)
    got = [m.pieces[i] for i in codec.encode(["The international organisation published recommendations yesterday."])[0]]
    assert len(got) <= 9 and {"▁The", "▁international", "▁published"} <= set(got)


def test_kinds_of_pieces(tmp_path):
    """Unused pieces are never given, those defined by the user always; extra spaces go where the model says so."""
    import sentencepiece

    pieces = ["<unk>", "▁", "a", "b", "c", "ab", "▁ab", "abc", "bc", "▁a"]
    kinds = [sv.UNKNOWN] + [sv.NORMAL] * 9
    scores = [0.0, -3.0, -4.0, -4.1, -4.2, -1.0, -1.1, -1.5, -9.0, -2.0]
    for unused, user in ((None, None), (5, None), (None, 8), (7, 8)):
        own = [sv.UNUSED if i == unused else sv.USER_DEFINED if i == user else k for i, k in enumerate(kinds)]
        for squeeze in (False, True):
            data = proto(pieces, own, scores, squeeze)
            (path := tmp_path / "m.model").write_bytes(data)
            codec, library = sv.Codec(sv.load(str(path))), sentencepiece.SentencePieceProcessor(model_proto=data)
            for text in ("abc", "ab abc c", "  abc   ab ", "bcbca", "aaabbbccc abc"):
                assert codec.encode([text])[0].tolist() == library.encode(text), (unused, user, squeeze, text)
    with pytest.raises(ValueError):
        path.write_bytes(proto(pieces, kinds, scores, kind=3))
        sv.load(str(path))


def test_round_trips(codec):
    texts = [*samples(), "a ▁ b", "▁", "▁▁ x▁", " ▁ "]
    for t, got in zip(texts, codec.encode(texts)):
        assert codec.decode(got) == t


def test_double_array_holds_every_piece(codec):
    m = codec.m
    for i, p in enumerate(m.pieces):
        if m.kinds[i] != sv.NORMAL:
            continue
        node = 0
        for ch in p:
            nxt = m.base[node] + m.codes[ord(ch)]
            assert m.check[nxt] == node
            node = nxt
        assert m.value[node] >= 0 and m.pieces[m.value[node]] == p


def test_rows(spark):
    rows = [(1, "Hello", "x"), (1, "Hello", "x"), (2, None, "y"), (3, "", None), (4, "lang " * 200_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sv.encode(docs, ["doc_id"]).collect()
    assert sorted((r.doc_id, r.n_tokens > 0, r.round_trip) for r in got) == [(1, True, True), (1, True, True), (2, False, True), (3, False, True), (4, True, True)]
    assert sv.encode(docs.limit(0), ["doc_id"]).count() == 0


# --- the memory of workers, which go on from one stage of the pipeline to the next


def test_a_worker_remembers_for_one_operator_only(codec):
    from stillframe.llm import language_id, substring

    of_languages = weakref.ref(language_id.encoder())
    assert language_id.encoder() is of_languages()
    substring._word_hashes([b"a", b"b"])
    gc.collect()
    assert of_languages() is None
    first = weakref.ref(sv._codec_of(codec.m))
    assert sv._codec_of(codec.m) is first()
    sv._codec_of(sv.load())
    gc.collect()
    assert first() is None


def test_workers_give_memory_back(spark):
    """A worker that held 300 MB has not kept them when it is idle or at the next task."""
    from stillframe.llm.common import map_rows

    def own():
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(x.split()[1]) for x in f if x.startswith("Private_Dirty")) // 1024

    def fill(rows):
        import stillframe.llm.common as common

        list(rows)
        held = [bytes(3000) for _ in range(100_000)]
        common.pinned = held[::200]  # so that the heap's end can't move
        yield os.getpid(), own()

    def look(rows):
        list(rows)
        yield os.getpid(), own()

    one = spark.range(0, 1, 1, 1)
    ((pid, most),) = map_rows(one, ["id"], "pid long, mb long", fill).collect()
    later = [r.mb for _ in range(12) for r in map_rows(one, ["id"], "pid long, mb long", look).collect() if r.pid == pid]
    assert most > 300 and later and max(later) < most - 200


def test_new_units_are_cut_a_part_at_a_time(codec):
    """Cutting a million characters of new units takes no more than some of them need."""
    rng = random.Random(8)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(12)) for _ in range(80_000))
    own = sv.Codec(codec.m)
    tracemalloc.start()
    own.encode([text])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 110e6
