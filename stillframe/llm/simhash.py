"""SimHash near-duplicate groups with pigeonring filtering.

A document's fingerprint has 64 bits; two link if they differ in at most three.
The 64 bits form a ring of four segments. If all differ by at most 3 in total,
then from some segment on the first l differ by at most 3 * l / 4 in total, for
every l: the first not at all, the first two by one bit at most, the first
three by two. The first two conditions make a join key of 32 bits, the third is
a condition of the join, and only then is the whole distance taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, groupby

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_rows, with_rows
from .components import connected_components

SEGMENTS, WIDTH, LINK_BITS = 4, 16, 3
#: Buckets of more fingerprints than this are joined by points between them, not pair by pair.
PAIRWISE = 2000


def digests(text: str | None, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of every word shingle of a text, in order and with repeats; A-Z are lower-cased.

    Words are runs without ASCII white space; a text of fewer words than a
    shingle is one shingle, and one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    n, joined = max(1, len(words) - shingle + 1), b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: n - 1]))
    ends = ends[min(shingle, len(words)) - 1 :] - 1
    digest, out = xxhash.xxh64_intdigest, np.empty(n, np.uint64)
    for at in range(0, n, 65_536):
        cuts = zip(starts[at : at + 65_536].tolist(), ends[at : at + 65_536].tolist())
        out[at : at + 65_536] = [digest(joined[a:b], seed) for a, b in cuts]
    return out


def fingerprint_of(h: np.ndarray) -> int:
    """Signed 64 bits, each set if it is in over half of the digests; 0 of none."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):
        total += np.unpackbits(h[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int(np.packbits(total * 2 > len(h), bitorder="little").view(np.int64)[0])


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    return fingerprint_of(digests(text, shingle, seed))


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _keys(fps: DataFrame) -> DataFrame:
    """``(key, fp, start, up)``: for each start the first two segments as they are (up 0), and with each unset bit of the second set (up 1).

    Of two fingerprints whose second segments differ in one bit, one has it
    unset, so they meet at the key of the other.
    """
    rows = []
    for i in range(SEGMENTS):
        second = _segment(F.col("fp"), i + 1)
        key = F.lit(i << 2 * WIDTH) + F.shiftleft(_segment(F.col("fp"), i), WIDTH) + second
        rows.append(F.struct(key.alias("key"), F.lit(i).cast("byte").alias("start"), F.lit(0).cast("byte").alias("up")))
        rows += [F.when(second.bitwiseAND(F.lit(1 << b)) == 0, F.struct((key + F.lit(1 << b)).alias("key"), F.lit(i).cast("byte").alias("start"), F.lit(1).cast("byte").alias("up"))) for b in range(WIDTH)]
    return fps.select("fp", F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.key", "fp", "r.start", "r.up")


def _cold(rows: DataFrame) -> DataFrame:
    """Links between fingerprints of one bucket, by the ring's further conditions."""
    a, b = rows.where("up = 0").select("key", F.col("fp").alias("a"), "start"), rows.select(F.col("key").alias("key2"), F.col("fp").alias("b"), "up")
    x = F.col("a").bitwiseXOR(F.col("b"))
    third = F.bit_count(F.expr("shiftrightunsigned(a ^ b, 16 * ((start + 2) % 4)) & 65535"))
    return a.join(b, (F.col("key") == F.col("key2")) & (F.col("a") != F.col("b")) & ((F.col("up") == 1) | (F.col("a") < F.col("b"))) & (F.col("up") + third <= 2) & (F.bit_count(x) <= LINK_BITS)).select("a", "b")


def _hot(fps: DataFrame) -> DataFrame:
    """Links that connect what lies within three bits, in rows linear in the fingerprints.

    Any two within three bits have a point within one bit of the first and two
    of the second. All within one bit of a point lie within two of each other,
    so each point needs links to one of them only.
    """
    def masks(most: int) -> list[int]:
        found = [sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(64), k)]
        return [m - (1 << 64) if m >= 1 << 63 else m for m in found]

    around = lambda most: fps.select("fp", F.explode(F.transform(F.array(*map(F.lit, masks(most))), lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    hubs = around(1).groupBy("point").agg(F.min("fp").alias("a"))
    return around(2).join(hubs, "point").where("a <> fp").select("a", F.col("fp").alias("b")).distinct()


def links(fps: DataFrame, scratch: Scratch, pairwise: int = PAIRWISE) -> DataFrame:
    """Edges ``(a, b)`` over distinct ``fp``, such that all within three bits are connected."""
    # some forty rows come from each fingerprint, so few files of them must not mean few tasks
    rows = _keys(fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp"))
    shared = scratch.keep(rows.groupBy("key").agg(F.count("*").alias("n"), F.min("up").alias("least")).where("n > 1 and least = 0").select("key", "n"))
    rows = scratch.keep(rows.join(shared, "key").select("key", "fp", "start", "up", "n"))
    edges = _cold(rows.where(F.col("n") <= pairwise).drop("n"))
    hot = rows.where(F.col("n") > pairwise).select("fp").distinct()
    if not hot.isEmpty():
        edges = edges.unionByName(_hot(hot))
    return edges


def _components(own: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, fp, component_id)`` of rows ``(id, fp)`` by edges between fingerprints."""
    fps = own.groupBy("fp").agg(F.min("id").alias("least"))
    found = connected_components(edges, scratch)
    named = fps.join(found, fps["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = scratch.keep(named.join(least, "component").select("fp", "component_id"))
    return own.join(named, "fp").select("id", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, pairwise: int = PAIRWISE) -> DataFrame:
    """``(id, fp, component_id)`` per row: the group by links of at most three bits, named by its least id.

    A null or blank text has fingerprint 0, linked like any other. Repeated rows
    give repeated results. Rows whose id is null take part in links; a group
    without any id has a null component. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "simhash")

    def prints(rows):
        for i, text in rows:
            yield i, fingerprint(text, shingle, seed)

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    own = scratch.keep(map_rows(d, ["id", "text"], f"id {d.schema['id'].dataType.simpleString()}, fp long", prints))
    # copies are gathered before anything is compared
    fps = scratch.keep(own.select("fp").distinct())
    return _components(own, links(fps, scratch, pairwise), scratch)


# Similar texts beyond three bits.
#
# Two texts whose five-word shingles agree to 0.8 differ in some ten bits of 64,
# too many for segments that a join could use. Candidates are therefore texts
# that share the least shingles under four of 64 orders, and the shingles
# themselves decide. Fingerprints prune none: no number of bits is sure to hold
# all such texts, least of all with repeated lines.

BANDS, ROWS = 16, 4
#: Buckets of more texts than this are compared in one task, which leaves out pairs that are connected already.
SMALL_BUCKET = 64
#: Such a task holds two blocks of a bucket, each of so many shingles or of one text.
BLOCK_SHINGLES = 2_000_000

_ORDERS = np.random.default_rng(2).integers(1, 1 << 63, BANDS * ROWS, np.uint64) | np.uint64(1)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key for each band: the least hashes of its orders together."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        h = hashes[at : at + 4096, None] * _ORDERS
        least = np.minimum(least, (h ^ (h >> np.uint64(29))).min(0))
    keys = np.arange(BANDS, dtype=np.uint64)
    for v in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ v) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def bucket_links(sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """Places of pairs that agree to ``similarity``, such that all that do are connected.

    Sets are of different members, none empty. One after the other is compared
    with all it is not connected to, until those not compared are connected to
    each other. Of any two that are not connected one was then compared with
    the other.
    """
    size = np.array([len(x) for x in sets])
    ends = np.cumsum(size)
    starts = ends - size
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    group, waiting, own = np.arange(len(sets)), np.ones(len(sets), bool), np.zeros(flat.max() + 1, np.int32)
    while True:
        largest = np.bincount(group).argmax()
        rest = np.flatnonzero(waiting & (group != largest))
        if not len(rest):
            return
        x = int(rest[0])
        waiting[x] = False
        own[flat[starts[x] : ends[x]]] = 1
        both = np.add.reduceat(own[flat], starts)
        own[flat[starts[x] : ends[x]]] = 0
        near = np.flatnonzero((group != group[x]) & (both >= similarity * (size + size[x] - both)))
        joined, at = np.unique(group[near], return_index=True)
        yield from ((x, int(y)) for y in near[at])
        group[np.isin(group, joined)] = group[x]


def _members(shingle: int, seed: int) -> Callable[[str | None], np.ndarray]:
    return lambda text: (np.unique(digests(text, shingle, seed)) >> np.uint64(1)).astype(np.int64)


def _large_buckets(texts: DataFrame, rows: DataFrame, scratch: Scratch, similarity: float, shingle: int, seed: int) -> DataFrame:
    """Edges ``(a, b)`` that connect what agrees to ``similarity`` within buckets ``rows(key, node, volume)``.

    A bucket is dealt into blocks by its shingles, and any two blocks meet in a
    task, so that every pair of the bucket does.
    """
    members = _members(shingle, seed)

    def pack(rows):
        for node, text in rows:
            yield node, members(text).tobytes()

    packed = scratch.keep(map_rows(texts.join(rows.select("node").distinct(), "node", "left_semi"), ["node", "text"], "node long, members binary", pack))
    dealt = rows.withColumn("blocks", F.ceil(F.col("volume") / BLOCK_SHINGLES).cast("int")).withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("blocks = 1 or other <> block")
    met = met.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node")
    met = met.join(packed, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(rows):
        for _, own in groupby(rows, key=lambda r: r[:3]):
            nodes, sets = [], []
            for *_, node, m in own:
                nodes.append(node)
                sets.append(np.frombuffer(m, np.int64))
            for x, y in bucket_links(sets, similarity):
                yield nodes[x], nodes[y]

    return map_rows(met, ["key", "i", "j", "node", "members"], "a long, b long", compare).distinct()


def similar_links(docs: DataFrame, kinds: DataFrame, scratch: Scratch, similarity: float, shingle: int, seed: int = 42) -> DataFrame:
    """Edges ``(a, b)`` between nodes whose texts agree to ``similarity`` in their different shingles.

    ``docs(id, text)``, ``kinds(node, id, fp, size, bands)`` with one row for
    each set of shingles. Pairs at three bits are compared like those of one
    bucket. All of one bucket that agree are connected; in
    buckets of more than SMALL_BUCKET sets not every such pair is an edge.
    """
    rows = kinds.select("node", "size", F.explode(F.array_distinct("bands")).alias("key"))
    shared = scratch.keep(rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("volume")).where("n > 1"))
    rows = scratch.keep(rows.join(shared, "key"))
    few, many = rows.where(F.col("n") <= SMALL_BUCKET), rows.where(F.col("n") > SMALL_BUCKET)
    side = lambda x: few.select("key", F.col("node").alias(x), F.col("size").alias(f"n{x}"))
    pairs = side("a").join(side("b"), "key").where(F.col("a") < F.col("b")).where(F.least("na", "nb") >= similarity * F.greatest("na", "nb")).select("a", "b")
    pairs = scratch.keep(pairs.unionByName(_close(kinds, scratch)).distinct())
    texts = docs.join(kinds.where("size > 0").select("id", "node"), "id")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    members = _members(shingle, seed)

    def sets(rows):
        for node, text in rows:
            yield node, members(text).tolist()

    known = scratch.keep(map_rows(texts.join(wanted, "node", "left_semi"), ["node", "text"], "node long, members array<long>", sets))
    both = pairs.join(known.toDF("a", "ma"), "a").join(known.toDF("b", "mb"), "b")
    in_both = F.size(F.array_intersect("ma", "mb"))
    edges = both.where(in_both >= similarity * (F.size("ma") + F.size("mb") - in_both)).select("a", "b")
    if many.isEmpty():
        return edges
    return edges.unionByName(_large_buckets(texts, many, scratch, similarity, shingle, seed))


def _close(kinds: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs ``(a, b)`` of nodes by three bits: one node of each fingerprint with those of the fingerprints near it, and with the others of its own."""
    kinds = kinds.where("size > 0")
    first = scratch.keep(kinds.groupBy("fp").agg(F.min("node").alias("node")))
    near = links(first.select("fp"), scratch).toDF("fa", "fb").join(first.toDF("fa", "a"), "fa").join(first.toDF("fb", "b"), "fb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    same = kinds.select("fp", F.col("node").alias("b")).join(first.withColumnRenamed("node", "a"), "fp").where("a <> b").select("a", "b")
    return near.unionByName(same)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, seed: int = 42) -> DataFrame:
    """The row of the least id of each group, all columns unchanged; of rows without an id, or with the same, the first.

    Texts are of one group if they agree to ``similarity`` in their different
    shingles, as ``similar_links`` finds, or by way of others that do. Texts
    without words are one group. An empty table gives an empty result.
    """
    scratch, columns = Scratch(docs.sparkSession, "simhash-kept"), docs.columns
    names = [f"c{i}" for i in range(len(columns))]  # by position, so that no column of the input can clash
    rows = with_rows(docs.toDF(*names), names[columns.index(id_col)], "row", scratch)
    d = rows.select(F.col("row").alias("id"), F.col(names[columns.index(text_col)]).cast("string").alias("text"))

    def sketch(rows):
        for i, text in rows:
            h = digests(text, shingle, seed)
            own = np.unique(h)
            node = int(np.array(xxhash.xxh64_intdigest(own.tobytes(), seed), np.uint64).view(np.int64))
            yield i, node, fingerprint_of(h), len(own), band_keys(own).tolist() if len(h) else []

    own = scratch.keep(map_rows(d, ["id", "text"], "id long, node long, fp long, size long, bands array<long>", sketch))
    # texts of the same different shingles are one node
    kinds = scratch.keep(own.join(own.groupBy("node").agg(F.min("id").alias("id")), ["node", "id"], "left_semi"))
    edges = similar_links(d, kinds, scratch, similarity, shingle, seed)
    found = _components(own.select("id", F.col("node").alias("fp")), edges, scratch)
    kept = found.where("id = component_id").select(F.col("id").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*names).toDF(*columns)
