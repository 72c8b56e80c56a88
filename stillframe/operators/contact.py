"""Contact sheets: which output belongs to which result, and where its thumbnail goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import category_or_unknown, is_good
from ..functions.text import stem
from ..schema import BAD, RECOVERED
from .ordering import numbered

BORDER, HEADER, PADDING = 2, 28, 4
CROPPED = ("jpg", "jpeg", "png", "webp")


def match(results: DataFrame, outputs: DataFrame) -> DataFrame:
    """Results with matched, the output file of their name: the same name, else the stem with -cropped, else the first that begins with the stem.

    Beginnings are compared regardless of case, by an equi-join on those of the
    lengths that stems have.
    """
    names = outputs.select(F.col("output_name").alias("file"))
    d = results.withColumn("stem", stem(F.col("name")))
    d = d.join(names.withColumnRenamed("file", "exact"), F.col("name") == F.col("exact"), "left")
    # one of the four suffixes at most, by their order
    cut = names.select(F.regexp_extract("file", rf"^(.*)-cropped\.(?:{'|'.join(CROPPED)})$", 1).alias("of"), F.col("file").alias("cropped"), F.array_position(F.array(*map(F.lit, CROPPED)), F.regexp_extract("file", r"\.([^.]+)$", 1)).alias("rank")).where("of <> ''")
    cut = cut.groupBy("of").agg(F.min_by("cropped", "rank").alias("cropped"))
    d = d.join(cut, F.col("stem") == F.col("of"), "left").drop("of")
    # the first file of every beginning that is as long as some stem
    open_ = d.where("exact is null and cropped is null").select(F.lower("stem").alias("low_stem")).distinct()
    lengths = [r[0] for r in open_.select(F.length("low_stem")).distinct().collect()]
    starts = names.select("file", F.explode(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>")).alias("n")).where(F.length("file") >= F.col("n"))
    begins = starts.groupBy(F.substring(F.lower("file"), F.lit(1), F.col("n")).alias("low_stem")).agg(F.min("file").alias("begins"))
    d = d.join(begins, F.lower("stem") == F.col("low_stem"), "left")
    return d.withColumn("matched", F.coalesce("exact", "cropped", "begins")).drop("stem", "exact", "cropped", "low_stem", "begins")


def entries(results: DataFrame, outputs: DataFrame) -> DataFrame:
    """``(category, file, name, status, flags)`` of every thumbnail; outputs that no result has are UNCATEGORIZED."""
    found = match(results, outputs).where("matched is not null").select(category_or_unknown(F.col("category")).alias("category"), F.col("matched").alias("file"), "name", "status", "flags")
    rest = outputs.select(F.col("output_name").alias("file")).join(found.select("file"), "file", "left_anti").where(F.lower("file").rlike(r"\.(jpg|jpeg|png)$"))
    empty = F.array().cast("array<string>")
    return found.unionByName(rest.select(F.lit("UNCATEGORIZED").alias("category"), "file", F.col("file").alias("name"), F.lit("").alias("status"), empty.alias("flags")))


def headers(found: DataFrame) -> DataFrame:
    return found.groupBy("category").agg(F.count("*").alias("n"), F.count_if(is_good(F.col("status"))).alias("ok"))


def border(status: Column, flags: Column) -> Column:
    return F.when(status == RECOVERED, "green").when(status.isin(*BAD) | (F.size(flags) > 0), "red").otherwise("gray")


def layout(found: DataFrame, thumb: int = 100, columns: int = 20) -> DataFrame:
    """Place of each thumbnail's cell: categories below each other, each under its header, in rows of ``columns``."""
    cell = thumb + 2 * BORDER
    rows = F.ceil(F.col("n") / columns)
    above = Window.orderBy("category").rowsBetween(Window.unboundedPreceding, -1)
    sums = lambda c: F.coalesce(F.sum(c).over(above), F.lit(0))  # noqa: E731  over categories, which are few
    tops = headers(found).select("category", (PADDING + HEADER + sums(HEADER + rows * cell)).alias("top"), sums(F.col("n")).alias("before"))
    d = numbered(found, ["category", "name", "file"], "i").join(F.broadcast(tops), "category").withColumn("i", F.col("i") - 1 - F.col("before"))
    return d.withColumns({"x": PADDING + F.col("i") % columns * cell, "y": F.col("top") + F.floor(F.col("i") / columns) * cell}).drop("i", "top", "before")
