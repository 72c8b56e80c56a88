"""Comparison of two runs, image by image."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import is_good

#: Changes of the fill ratio over this are reported; and over this on the console.
REPORTED_FILL, CONSOLE_FILL = 0.01, 0.05


def classify(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row for each name of either run with both sides and change: improved, regressed, unchanged_ok, unchanged_bad, new or removed.

    The category is the later one, or the earlier one where that is empty; an
    image in one run only keeps its own, empty or not.
    """
    columns = ("status", "category", "flags", "fill_ratio")
    side = lambda d, s: d.select("name", F.lit(True).alias(f"in_{s}"), *[F.col(c).alias(f"{s}_{c}") for c in columns])
    d = side(before, "before").join(side(after, "after"), "name", "full_outer")
    both = F.col("in_before") & F.col("in_after")
    b, a = is_good(F.coalesce("before_status", F.lit(""))), is_good(F.coalesce("after_status", F.lit("")))
    change = F.when(F.col("in_before").isNull(), "new").when(F.col("in_after").isNull(), "removed").when(~b & a, "improved").when(b & ~a, "regressed").when(a, "unchanged_ok").otherwise("unchanged_bad")
    category = F.when(both & (F.coalesce("after_category", F.lit("")) != ""), F.col("after_category")).when(both, F.coalesce("before_category", F.lit("UNKNOWN"))).otherwise(F.coalesce("after_category", "before_category", F.lit("UNKNOWN")))
    return d.select("name", category.alias("category"), change.alias("change"), (F.col("in_before").isNotNull() & b).alias("before_ok"), (F.col("in_after").isNotNull() & a).alias("after_ok"), *[f"{s}_{c}" for s in ("before", "after") for c in ("status", "flags", "fill_ratio")])


def counters(rows: DataFrame) -> DataFrame:
    """How many images were in each run, in both, and of each change; one row."""
    n = lambda *kinds: F.count_if(F.col("change").isin(*kinds))
    changes = ("improved", "regressed", "unchanged_ok", "unchanged_bad", "new", "removed")
    every = F.count(F.lit(1))
    return rows.agg((every - n("new")).alias("before_count"), (every - n("removed")).alias("after_count"), (every - n("new", "removed")).alias("compared"), *[n(c).alias(c) for c in changes])


def category_deltas(rows: DataFrame) -> DataFrame:
    """Totals, successes and rates of both runs for each category, and what changed."""
    there = {"before": F.col("change") != "new", "after": F.col("change") != "removed"}
    sums = [x for s, c in there.items() for x in (F.count_if(c).alias(f"{s}_total"), F.count_if(F.col(f"{s}_ok")).alias(f"{s}_ok"))]
    d = rows.groupBy("category").agg(*sums, *[F.count_if(F.col("change") == c).alias(c) for c in ("improved", "regressed")])
    rate = {s: F.col(f"{s}_ok") / F.greatest(F.lit(1), F.col(f"{s}_total")) for s in there}
    return d.select("category", "before_total", "before_ok", F.round(rate["before"], 4).alias("before_rate"), "after_total", "after_ok", F.round(rate["after"], 4).alias("after_rate"), F.round((rate["after"] - rate["before"]) * 100, 1).alias("delta_pct"), "improved", "regressed")


def flag_changes(rows: DataFrame) -> DataFrame:
    """How often each flag came or went between images of both runs."""
    both = rows.where(~F.col("change").isin("new", "removed"))
    gone, come = F.array_except("before_flags", "after_flags"), F.array_except("after_flags", "before_flags")
    tagged = lambda k, x: F.transform(x, lambda f: F.struct(F.lit(k).alias("direction"), f.alias("flag")))
    pairs = F.concat(tagged("added", come), tagged("removed", gone))
    return both.select(F.explode(pairs).alias("p")).groupBy("p.direction", "p.flag").agg(F.count("*").alias("n"))


def fill_changes(rows: DataFrame, over: float = REPORTED_FILL) -> DataFrame:
    """Images of both runs whose fill ratios, both known and above 0, differ by more than ``over``."""
    d = rows.where(~F.col("change").isin("new", "removed")).select("name", "before_fill_ratio", "after_fill_ratio", F.abs(F.col("after_fill_ratio") - F.col("before_fill_ratio")).alias("change"))
    return d.where((F.col("before_fill_ratio") > 0) & (F.col("after_fill_ratio") > 0) & (F.col("change") > over))


def largest_fill_changes(rows: DataFrame, n: int = 20, over: float = CONSOLE_FILL) -> DataFrame:
    return fill_changes(rows, over).orderBy(F.desc("change"), "name").limit(n)


def first_of_change(rows: DataFrame, change: str, n: int = 30) -> DataFrame:
    return rows.where(F.col("change") == change).orderBy("name").limit(n)


def categories(before: DataFrame, after: DataFrame) -> DataFrame:
    """All categories of either run."""
    return before.select("category").union(after.select("category")).distinct()
