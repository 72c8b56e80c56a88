"""Quality gate: success rates of categories, at the end or while a run goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import GateRules
from ..functions.flags import category_or_unknown, is_good
from .ordering import numbered, running_counts


def _rows(results: DataFrame) -> DataFrame:
    return results.withColumns({"category": category_or_unknown(F.col("category")), "good": is_good(F.coalesce("status", F.lit("")))})


def counts(results: DataFrame) -> DataFrame:
    """``(category, total, good)``."""
    return _rows(results).groupBy("category").agg(F.count("*").alias("total"), F.count_if("good").alias("good"))


def breaches(results: DataFrame, gate: GateRules) -> DataFrame:
    """Categories with enough images whose share of good ones is too small."""
    return counts(results).withColumn("rate", F.col("good") / F.col("total")).where((F.col("total") >= gate.min_samples) & (F.col("rate") < gate.min_success_rate))


def top_flags(results: DataFrame, gate: GateRules, n: int = 3) -> DataFrame:
    """The most frequent flags of the images that are not good, for each breach; ties go to the flag met first."""
    d = _rows(results).where(~F.col("good")).join(breaches(results, gate).select("category"), "category", "left_semi")
    counts = d.select("category", "seq", F.posexplode("flags").alias("pos", "flag")).groupBy("category", "flag").agg(F.count("*").alias("n"), F.min(F.struct("seq", "pos")).alias("met"))
    w = Window.partitionBy("category").orderBy(F.desc("n"), "met")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select("category", "flag", "n", "rank")


def running(results: DataFrame, gate: GateRules) -> DataFrame:
    """``(tick, category, total, good, rate, breach)`` after every check_interval-th image in order of seq, for the categories met by then.

    A category's state at a tick is that of its last image up to it. Of each
    stretch between ticks only the last image of each category matters, and
    states are carried on over stretches without one.
    """
    d = running_counts(numbered(_rows(results), ["seq"]), ["seq"], "category", {"total": F.lit(1), "ok": F.col("good").cast("int")})
    d = d.withColumn("tick", F.ceil(F.col("rn") / gate.check_interval))
    last = d.groupBy("category", "tick").agg(F.max(F.struct("rn", "total", "ok")).alias("s")).select("category", "tick", "s.total", "s.ok")
    end = results.count() // gate.check_interval
    until = F.least(F.lead("tick").over(Window.partitionBy("category").orderBy("tick")) - 1, F.lit(end))
    spans = last.withColumn("until", F.coalesce(until, F.lit(end))).where("tick <= until")
    each = spans.select("category", "total", "ok", F.explode(F.sequence("tick", "until")).alias("tick"))
    rate = F.col("ok") / F.col("total")
    return each.select("tick", "category", "total", F.col("ok").alias("good"), F.round(rate, 4).alias("rate"), ((F.col("total") >= gate.min_samples) & (rate < gate.min_success_rate)).alias("breach"))


def until_abort(results: DataFrame, gate: GateRules) -> DataFrame:
    """The images that a run handles that stops at its first breach."""
    first = running(results, gate).where("breach").agg(F.min("tick").alias("t")).first()["t"]
    d = numbered(results, ["seq"])
    return d if first is None else d.where(F.col("rn") <= first * gate.check_interval)
