"""Row numbers and running sums over a whole table without gathering it in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that a table's order is cut into, at least and at most; between these as many as a shuffle has partitions.
LEAST_RANGES, MOST_RANGES = 64, 4096
#: Rows drawn for each range; only how even the ranges are depends on them.
DRAWN = 32


def _range_of(df: DataFrame, order: list[str]) -> Column:
    """Number of the range that a row falls into, by its whole key; bounds are keys of drawn rows, so ranges have about as many rows each.

    A key is looked for among every so many bounds first, and then among those
    that follow the one found. Nulls come first, as in an ascending sort.
    """
    ranges = max(LEAST_RANGES, min(MOST_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    drawn = df.select(*order).withColumn("__draw", F.rand(1)).orderBy("__draw").limit(ranges * DRAWN).drop("__draw").orderBy(*order).collect()
    cuts = list(dict.fromkeys(tuple(drawn[k * len(drawn) // ranges]) for k in range(1, ranges))) if drawn else []
    if not cuts:
        return F.lit(0)
    kinds = [df.schema[c].dataType for c in order]
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    literal = lambda rows: F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(row, kinds))]) for row in rows])
    step = math.isqrt(len(cuts) - 1) + 1
    parts = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    not_over = lambda array: F.size(F.filter(array, lambda b: b <= key))
    at = not_over(literal([p[0] for p in parts]))
    inside = not_over(F.element_at(F.array(*map(literal, parts)), F.greatest(F.lit(1), at)))
    return F.when(at == 0, F.lit(0)).otherwise((at - 1) * step + inside)


def numbered(df: DataFrame, order: list[str], name: str = "rn") -> DataFrame:
    """``df`` with a row number from 1 on over ``order``, nulls first.

    Rows are dealt into ranges of their whole key, numbered there, and moved up
    by how many rows earlier ranges have; those counts are one row a range.
    """
    d = df.withColumn("__range", _range_of(df, order))
    found = {r[0]: r[1] for r in d.groupBy("__range").count().collect()}
    before = [0]
    for i in range(max(found, default=0)):
        before.append(before[-1] + found.get(i, 0))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return d.withColumn(name, F.element_at(F.array(*[F.lit(n).cast("long") for n in before]), F.col("__range") + 1) + own).drop("__range")


def running_counts(df: DataFrame, order: list[str], group: str, values: dict[str, Column]) -> DataFrame:
    """``df`` with, for each value, its sum over the rows of the same group up to this one in ``order``."""
    d = df.withColumn("__range", _range_of(df, order)).withColumns({f"__{k}": v for k, v in values.items()})
    sums = d.groupBy(group, "__range").agg(*[F.sum(f"__{k}").alias(f"__s_{k}") for k in values])
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "__range", *[F.coalesce(F.sum(f"__s_{k}").over(before), F.lit(0)).alias(f"__b_{k}") for k in values])
    own = Window.partitionBy(group, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.join(sums, [group, "__range"])
    return d.withColumns({k: F.col(f"__b_{k}") + F.sum(f"__{k}").over(own) for k in values}).drop("__range", *[f"__{k}" for k in values], *[f"__b_{k}" for k in values])


def percentiles(df: DataFrame, value: Column, shares: list[float]) -> list[float]:
    """Exact percentiles with linear interpolation, nulls left out; 0 of nothing.

    Different values are counted and dealt into ranges; only the ranges that hold
    a wanted rank are summed value by value.
    """
    d = df.select(value.cast("double").alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    d = d.withColumn("__range", _range_of(d, ["v"]))
    sizes = {r["__range"]: r["n"] for r in d.groupBy("__range").agg(F.sum("n").alias("n")).collect()}
    total = sum(sizes.values())
    if not total:
        return [0.0] * len(shares)
    wanted = [(math.floor(x), math.ceil(x), x) for x in (p * (total - 1) for p in shares)]
    ranks, before, starts = {r for w in wanted for r in w[:2]}, 0, {}
    for k in sorted(sizes):
        if any(before <= r < before + sizes[k] for r in ranks):
            starts[k] = before
        before += sizes[k]
    up_to = F.sum("n").over(Window.partitionBy("__range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    own = d.where(F.col("__range").isin(*starts)).withColumn("end", up_to)
    begun = F.element_at(F.create_map(*[F.lit(int(x)) for kv in starts.items() for x in kv]), F.col("__range"))
    own = own.select("v", (begun + F.col("end") - F.col("n")).alias("first"), (begun + F.col("end") - 1).alias("last"))
    held = own.where(F.exists(F.array(*[F.lit(r) for r in sorted(ranks)]), lambda r: (r >= F.col("first")) & (r <= F.col("last")))).collect()
    at = lambda rank: next(r["v"] for r in held if r["first"] <= rank <= r["last"])
    return [at(lo) if lo == hi else (hi - x) * at(lo) + (x - lo) * at(hi) for lo, hi, x in wanted]
