"""What a run still has to do, and which output names are taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import suffix
from ..schema import IMAGE_EXTENSIONS


def discover(images: DataFrame) -> DataFrame:
    """Files whose suffix is that of an image, in order of their lower-cased names."""
    return images.where(suffix(F.col("name")).isin(*IMAGE_EXTENSIONS)).orderBy(F.lower("name"), "name")


def limited(images: DataFrame, n: int | None) -> DataFrame:
    found = discover(images)
    return found.limit(n) if n and n > 0 else found


def not_done(images: DataFrame, completed: DataFrame) -> DataFrame:
    return images.join(completed.select("name"), "name", "left_anti")


def stale(proposed: DataFrame, outputs: DataFrame, newest_reference=None, force: set[str] | None = None) -> DataFrame:
    """Names of mapped images to process again: forced by category, or with an output that is missing or too old.

    ``proposed(name, mtime, category, output_name)`` has a row for each expected
    output, ``outputs(output_name, output_mtime)`` what is there.
    """
    forced = F.upper("category").isin([c.upper() for c in force]) if force else F.lit(False)
    fresh = F.col("output_mtime").isNotNull() & (F.col("output_mtime") >= F.col("mtime"))
    if newest_reference is not None:
        fresh = fresh & (F.col("output_mtime") >= newest_reference)
    d = proposed.join(outputs.select("output_name", "output_mtime"), "output_name", "left")
    return d.groupBy("name").agg(F.bool_and(fresh).alias("fresh"), F.max(forced).alias("forced")).where(~F.col("fresh") | F.col("forced"))


def to_process(images: DataFrame, proposed: DataFrame, outputs: DataFrame, newest_reference=None, force: set[str] | None = None) -> DataFrame:
    """Images without a mapping, and those that are stale."""
    old = stale(proposed, outputs, newest_reference, force).select("name")
    unmapped = images.select("name").join(proposed.select("name"), "name", "left_anti")
    return images.join(old.unionByName(unmapped).distinct(), "name", "left_semi")


def collisions(writes: DataFrame, existing: DataFrame, overwrite: bool = False) -> DataFrame:
    """``writes(output_name, seq, row_idx, has_image)`` with conflict: whether the name was taken before, in this run or, unless overwritten, on disk.

    Only rows with an image take a name; the first in order of seq and row gets it.
    """
    w = Window.partitionBy("output_name", "has_image").orderBy("seq", "row_idx")
    d = writes.withColumn("turn", F.row_number().over(w)).join(existing.select("output_name", F.lit(True).alias("there")), "output_name", "left")
    on_disk = F.lit(False) if overwrite else F.coalesce("there", F.lit(False))
    return d.withColumn("conflict", F.col("has_image") & ((F.col("turn") > 1) | on_disk)).drop("turn", "there")
