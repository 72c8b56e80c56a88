"""New files of a folder as a stream: each is handled once, and the stream's checkpoint remembers which."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Rules
from ..functions.flags import category_or_unknown, is_good
from ..functions.text import base_name, suffix
from ..kernels.strategy import Strategy
from ..operators import mapping
from ..operators.crop_stage import cropped
from ..schema import IMAGE_EXTENSIONS

_FILES = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, folder: str, per_batch: int = 1000) -> DataFrame:
    """Images of a folder as they come."""
    d = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", per_batch).load(folder)
    d = d.withColumn("name", base_name(F.col("path"))).where(suffix(F.col("name")).isin(*IMAGE_EXTENSIONS))
    return d.select("path", "name", F.col("modificationTime").alias("mtime"), F.col("length").alias("size_bytes"))


def process_new(spark: SparkSession, folder: str, rows: DataFrame, rules: Rules, results_path: str, checkpoint: str, primary: Strategy | None = None, fallback: Strategy | None = None) -> None:
    """Crop all files not handled before and append their results to a table; returns when none is left.

    A batch that is repeated after a failure replaces its own part of the table.
    """
    from ..sources.files import decoded

    def handle(batch: DataFrame, number: int) -> None:
        d = mapping.lookup(batch.withColumn("seq", F.xxhash64("path")), rows)
        crops = cropped(decoded(batch.sparkSession, folder, d.where("sku_key is not null").select("seq", "category", "path")), rules, primary, fallback)
        out = d.select("seq", "name", "path", "category").join(crops.drop("preview"), "seq", "left")
        out = out.withColumns({"status": F.coalesce("status", F.lit("flagged")), "flags": F.coalesce("flags", F.array(F.lit("missing_mapping")))})
        out.write.mode("overwrite").parquet(f"{results_path}/batch={number}")

    few = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(few)
    spark.conf.set(few, "8")  # rows of pixels are large
    try:
        new_files(spark, folder).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(few, before)


def monitored(results: DataFrame) -> DataFrame:
    """Running totals and success rates of each category over a stream of results; bounded by the categories."""
    d = results.groupBy(category_or_unknown(F.col("category")).alias("category")).agg(F.count("*").alias("total"), F.count_if(is_good(F.col("status"))).alias("good"))
    return d.withColumn("rate", F.round(F.col("good") / F.col("total"), 4))
