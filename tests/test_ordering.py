"""Row numbers and running sums in ranges like those over the whole table."""

import random

from pyspark.sql import functions as F

from stillframe.operators.ordering import _range_of, numbered, percentiles, running_counts


def table(spark, n=3000, keys=400):
    rng = random.Random(n)
    rows = [(rng.randrange(keys), f"name{rng.randrange(keys):04}", i, rng.choice("abc"), rng.randrange(5)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k long, s string, tie long, g string, v long")


def test_row_numbers(spark):
    rows, d = table(spark)
    for column, i in (("k", 0), ("s", 1)):
        got = {r.tie: r.rn for r in numbered(d, [column, "tie"]).collect()}
        assert got == {r[2]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[i], r[2])), 1)}
    assert numbered(d.limit(0), ["k"]).count() == 0
    one = numbered(d.withColumn("k", F.lit(7)), ["k", "tie"])  # a single key is a single range
    assert one.agg(F.max("rn")).first()[0] == len(rows)


def test_many_ranges(spark):
    rows, d = table(spark, 5000, 5000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        got = {r.tie: r.rn for r in numbered(d, ["k", "tie"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {r[2]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[0], r[2])), 1)}


def test_running_sums(spark):
    rows, d = table(spark)
    for column, i in (("k", 0), ("s", 1)):
        got = {r.tie: (r.n, r.total) for r in running_counts(d, [column, "tie"], "g", {"n": F.lit(1), "total": F.col("v")}).collect()}
        n, total, want = {}, {}, {}
        for r in sorted(rows, key=lambda r: (r[i], r[2])):
            n[r[3]], total[r[3]] = n.get(r[3], 0) + 1, total.get(r[3], 0) + r[4]
            want[r[2]] = (n[r[3]], total[r[3]])
        assert got == want


def test_ranges_are_even_whatever_the_keys_share(spark):
    """Long common prefixes, outliers, and one leading value for most rows."""
    names = [f"product-photo-{i:08}" for i in range(20_000)] + ["aaa", "zzz", None]
    d = spark.createDataFrame([(n, "x" if i % 10 else "y", i) for i, n in enumerate(names)], "name string, kind string, i long")
    for order in (["name"], ["kind", "name"], ["kind", "i"]):
        sizes = [r["count"] for r in d.groupBy(_range_of(d, order).alias("r")).count().collect()]
        assert max(sizes) <= 4 * sum(sizes) / 64 and len(sizes) > 32
    got = {r.i: r.rn for r in numbered(d, ["name"]).collect()}
    assert got[20_002] == 1 and got[20_000] == 2 and got[20_001] == 20_003 and all(got[i] == i + 3 for i in range(20_000))


def test_percentiles_like_the_aggregate(spark):
    rng = random.Random(9)
    for values in ([], [None], [2.5], [1.0, 2.0], [rng.random() for _ in range(2001)] + [None] * 5, [float(rng.randrange(7)) for _ in range(500)], [0.5] * 300):
        d = spark.createDataFrame([(v,) for v in values], "v double")
        shares = [0.0, 0.1, 0.333, 0.5, 0.95, 1.0]
        want = d.agg(F.percentile("v", shares).alias("p")).first()["p"] or [0.0] * len(shares)
        assert all(abs(a - b) < 1e-12 for a, b in zip(percentiles(d, F.col("v"), shares), want))
