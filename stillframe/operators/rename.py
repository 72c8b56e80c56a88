"""Names by master SKUs: which SKU a file's stem contains, and unique safe names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import replace_first, sanitise, stem
from .mapping import first_of_each_sku
from .ordering import numbered


def longest_match(files: DataFrame, skus: DataFrame) -> DataFrame:
    """``files(name, seq)`` with the longest of ``skus(sku, article, seq)`` that its stem contains, ties to the first; null without one.

    All substrings of a stem that are as long as some SKU are joined with the
    whole SKUs, so that what SKUs of one brand share does not matter; SKUs are
    compared with case. The first occurrence is replaced by the sanitised article.
    """
    skus = first_of_each_sku(skus).where("sku <> ''")
    lengths = [r[0] for r in skus.select(F.length("sku").alias("n")).distinct().collect()]
    keyed = skus.select("sku", "article", F.col("seq").alias("sku_seq"))
    d = files.withColumn("stem", stem(F.col("name")))
    stems = d.select("stem").distinct()

    def cuts(n: int) -> F.Column:
        places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("stem") - n + 1))
        cut = F.transform(places, lambda i: F.substring(F.col("stem"), i, F.lit(n)))
        return F.when(F.length("stem") >= n, cut).otherwise(F.array().cast("array<string>"))

    if not lengths:
        return d.withColumns({"sku": F.lit(None).cast("string"), "new_stem": F.lit(None).cast("string")})
    each = stems.select("stem", F.explode(F.array_distinct(F.concat(*map(cuts, lengths)))).alias("sku"))
    hits = each.join(keyed, "sku")
    best = hits.groupBy("stem").agg(F.max(F.struct(F.length("sku").alias("n"), (-F.col("sku_seq")).alias("first"), "sku", "article")).alias("b"))
    best = best.select("stem", "b.sku", "b.article")
    d = d.join(best, "stem", "left")
    return d.withColumn("new_stem", F.when(F.col("sku").isNotNull(), replace_first(F.col("stem"), F.col("sku"), sanitise(F.col("article"))))).drop("article")


def summary(matched: DataFrame, skip_unmatched: bool = True) -> DataFrame:
    """How many files matched, how many did not, and of these how many are skipped or copied as they are."""
    has = F.col("sku").isNotNull()
    skipped = F.count_if(~has) if skip_unmatched else F.lit(0)
    return matched.agg(F.count(F.lit(1)).alias("files"), F.count_if(has).alias("matched"), F.count_if(~has).alias("unmatched"), skipped.alias("skipped"), (F.count(F.lit(1)) - skipped).alias("copied"))


def safe_names(stems: DataFrame) -> DataFrame:
    """Distinct ``stem`` with safe, unique but for names that already end like a number given here.

    In order of stems, from 0: an empty name becomes image-NNNN, one that an
    earlier stem has gets its number appended.
    """
    d = numbered(stems.select("stem").distinct(), ["stem"]).withColumn("idx", F.col("rn") - 1)
    number = F.lpad(F.col("idx").cast("string"), 4, "0")
    number = F.when(F.col("idx") > 9999, F.col("idx").cast("string")).otherwise(number)
    plain = F.coalesce(F.nullif(sanitise(F.col("stem")), F.lit("")), F.concat(F.lit("image-"), number))
    d = d.withColumn("plain", plain)
    again = F.row_number().over(Window.partitionBy("plain").orderBy("idx")) > 1
    return d.withColumn("again", again).select("stem", "idx", F.when(F.col("again"), F.concat("plain", F.lit("-"), number)).otherwise(F.col("plain")).alias("safe"))
