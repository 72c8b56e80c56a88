"""Statistics of one run over its result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import category_or_unknown, described
from ..schema import BAD, FAILED, FLAGGED, OK, RECOVERED
from .ordering import percentiles

STATUSES = (OK, FLAGGED, FAILED, RECOVERED)


def _count(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def _mean(value: Column, places: int = 4) -> Column:
    return F.round(F.coalesce(F.avg(value), F.lit(0.0)), places)


def general(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("total_attempted"), *[_count(s).alias(s) for s in STATUSES])


def by_background(results: DataFrame) -> DataFrame:
    return results.where("background_type is not null").groupBy("background_type").agg(F.count("*").alias("n"))


def by_category(results: DataFrame) -> DataFrame:
    d = results.groupBy(category_or_unknown(F.col("category")).alias("category")).agg(F.count(F.lit(1)).alias("total"), *[_count(s).alias(s) for s in STATUSES])
    tried = F.col(FLAGGED) + F.col(FAILED) + F.col(RECOVERED)
    return d.withColumns({
        "success_rate": F.round((F.col(OK) + F.col(RECOVERED)) / F.greatest(F.lit(1), F.col("total")), 4),
        "fallback_recovery_rate": F.round(F.col(RECOVERED) / F.greatest(F.lit(1), tried), 4),
    })


def by_flag(results: DataFrame) -> DataFrame:
    return results.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def quality(results: DataFrame) -> DataFrame:
    """Fill ratios of images that have one, and the crop area over the same images."""
    has = F.col("fill_ratio") > 0
    fill, area = F.when(has, F.col("fill_ratio")), F.when(has, F.col("crop_area_ratio"))
    zero, shares = F.lit(0.0), (10, 50, 90)
    at = percentiles(results, fill, [p / 100 for p in shares])
    return results.agg(
        _mean(fill).alias("fill_avg"), F.round(F.coalesce(F.min(fill), zero), 4).alias("fill_min"), F.round(F.coalesce(F.max(fill), zero), 4).alias("fill_max"),
        *[F.round(F.lit(x), 4).alias(f"fill_p{p}") for p, x in zip(shares, at)], _mean(area).alias("crop_area_avg"),
    )


def mapping(results: DataFrame) -> DataFrame:
    has = lambda f: F.count_if(F.array_contains("flags", f))
    return results.agg(has("missing_mapping").alias("missing_mapping"), has("naming_conflict").alias("naming_conflict"))


def performance(results: DataFrame) -> DataFrame:
    """Times of all images, of crops that took any, and of fallbacks that were tried."""
    crop = F.when(F.col("crop_time_s") > 0, F.col("crop_time_s"))
    tried = F.count_if(F.col("fallback_attempted"))
    (p95,), (crop_p95,) = (percentiles(results, c, [0.95]) for c in (F.col("processing_time_s"), crop))
    return results.agg(
        _mean(F.col("processing_time_s")).alias("processing_avg_s"), F.round(F.lit(p95), 4).alias("processing_p95_s"),
        _mean(crop).alias("crop_avg_s"), F.round(F.lit(crop_p95), 4).alias("crop_p95_s"),
        _mean(F.when(F.col("fallback_attempted"), F.col("fallback_time_s"))).alias("fallback_avg_s"), tried.alias("fallback_count"),
        F.round(tried / F.greatest(F.lit(1), F.count(F.lit(1))), 4).alias("fallback_rate"),
    )


def projection(results: DataFrame) -> DataFrame:
    """What the results file holds of each image."""
    return results.select("name", "status", "category", "flags", F.round("fill_ratio", 4).alias("fill_ratio"), F.round("crop_area_ratio", 4).alias("crop_area_ratio"), "component_count", "fallback_attempted", "background_type")


def review(results: DataFrame) -> DataFrame:
    """Images for the reviewer, with their flags described."""
    return results.where(F.col("status").isin(*BAD)).withColumn("flag_descriptions", described(F.col("flags")))
