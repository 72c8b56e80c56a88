"""Image files and other listings as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name, stem, suffix
from ..schema import RESULT_JSON

#: Bytes of a file that can hold its camera's notes.
HEAD_BYTES = 65_536
#: Files up to this number are decoded by their paths; more are decoded with their whole folder and filtered.
LISTED_PATHS = 10_000

_LISTING = "path string, mtime timestamp, size_bytes long, name string, stem string, ext string"


def listing(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Path, time and size of the files of a folder; their content is not read. An empty folder gives an empty table."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    d = d.select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("size_bytes"))
    name = F.url_decode(F.regexp_replace(base_name(F.col("path")), r"\+", "%2B"))
    return d.withColumn("name", name).withColumns({"stem": stem(F.col("name")), "ext": suffix(F.col("name"))})


def by_folder(spark: SparkSession, root: str, categories: dict[str, str]) -> DataFrame:
    """Files under some folders of a root, with the category of their folder, in order of folders and paths."""
    order = {f: i for i, f in enumerate(categories)}
    d = listing(spark, root, True).withColumn("inside", F.substring("path", F.lit(1), F.length("path")))
    folder = F.url_decode(F.regexp_extract("path", rf"{root.rstrip('/')}/([^/]+)/", 1))
    pairs = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
    d = d.withColumn("folder", folder).where(F.col("folder").isin(*categories) & F.col("ext").isin("png", "jpg", "jpeg", "tif", "tiff"))
    return d.withColumns({"category": F.try_element_at(pairs(categories), F.col("folder")), "folder_order": F.try_element_at(pairs(order), F.col("folder"))}).drop("inside")


def decoded(spark: SparkSession, folder: str, todo: DataFrame) -> DataFrame:
    """``todo`` with height, width, channels and data of each file, and head, its first bytes, of JPEGs.

    A few files are read by their paths. Of many, the whole folder is decoded,
    as the image source takes no filter on rows.
    """
    paths = [r["path"] for r in todo.select("path").limit(LISTED_PATHS + 1).collect()]
    where: str | list[str] = paths if len(paths) <= LISTED_PATHS else folder
    if not paths:
        where = folder
    img = spark.read.format("image").option("dropInvalid", "false").load(where)
    img = img.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"), F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))
    heads = spark.read.format("binaryFile").load(where).select("path", F.substring("content", 1, HEAD_BYTES).alias("head"))
    same = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  the sources write the scheme in two ways
    keyed = todo.withColumn("key", same("path"))
    keyed = keyed.join(img.withColumn("key", same("path")).drop("path"), "key", "left")
    return keyed.join(heads.where(F.lower("path").rlike(r"\.jpe?g$")).withColumn("key", same("path")).drop("path"), "key", "left").drop("key")


def results_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a results file, which is one object keyed by image names; of a repeated name the last."""
    d = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,{RESULT_JSON}>", {"mode": "FAILFAST"}).alias("m"))
    d = d.select(F.explode("m").alias("name", "r")).select("name", "r.*")
    empty = F.array().cast("array<string>")
    return d.withColumns({"flags": F.coalesce("flags", empty), "status": F.coalesce("status", F.lit("")), "fill_ratio": F.coalesce("fill_ratio", F.lit(0.0))})
