"""The table that maps supplier SKUs to articles of the store: checks and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import from_pattern, is_safe, output_name, stem, strip
from ..schema import MAPPING_OPTIONAL, MAPPING_REQUIRED


def normalised_header(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def missing_columns(columns: list[str]) -> list[str]:
    return sorted(set(MAPPING_REQUIRED) - {normalised_header(c) for c in columns})


def cleaned(raw: DataFrame) -> DataFrame:
    """Known columns, stripped, nulls as empty strings, with seq and the lookup key."""
    raw = raw.toDF(*map(normalised_header, raw.columns))
    cell = lambda c: strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in raw.columns else F.lit("")
    d = raw.select("seq", *[cell(c).alias(c) for c in (*MAPPING_REQUIRED, *MAPPING_OPTIONAL)])
    return d.withColumns({"sku_key": F.lower("supplier_sku"), "output_name": output_name(F.col("store_article"), F.col("suffix"))})


def valid(rows: DataFrame) -> DataFrame:
    """Rows with SKU, article and suffix; a category may be missing."""
    return rows.where("supplier_sku <> '' and store_article <> '' and suffix <> ''")


def unsafe_names(rows: DataFrame) -> DataFrame:
    """Valid rows whose output name is no plain file name; of a path only the last part counts."""
    last = F.regexp_extract("output_name", r"([^/]*)$", 1)
    return valid(rows).where(~is_safe(stem(last)))


def duplicate_outputs(rows: DataFrame) -> DataFrame:
    return valid(rows).groupBy("output_name").agg(F.count("*").alias("n")).where("n > 1")


def issues(rows: DataFrame) -> DataFrame:
    """``(seq, flag, message)`` of everything wrong with a mapping; seq is null for names that several rows have."""
    sku = F.concat(F.lit("SKU '"), "supplier_sku", F.lit("': "))
    row = F.concat(F.lit("Row "), F.col("seq").cast("string"), F.lit(": "))
    at = lambda d, flag, message: d.select("seq", F.lit(flag).alias("flag"), message.alias("message"))
    has_sku = rows.where("supplier_sku <> ''")
    found = [
        at(rows.where("supplier_sku = ''"), "missing_mapping", F.concat(row, F.lit("empty supplier_sku"))),
        at(has_sku.where("store_article = '' or suffix = ''"), "missing_mapping", F.concat(row, F.lit("empty store_article or suffix for SKU '"), "supplier_sku", F.lit("'"))),
        at(valid(rows).where("category = ''"), "missing_mapping", F.concat(sku, F.lit("missing category"))),
        at(unsafe_names(rows), "naming_conflict", F.concat(sku, F.lit("unsafe output filename '"), "output_name", F.lit("'"))),
        duplicate_outputs(rows).select(F.lit(None).cast(rows.schema["seq"].dataType).alias("seq"), F.lit("naming_conflict").alias("flag"), F.concat(F.lit("Output filename '"), "output_name", F.lit("' appears "), F.col("n").cast("string"), F.lit(" times")).alias("message")),
    ]
    out = found[0]
    for d in found[1:]:
        out = out.unionByName(d)
    return out


def by_sku(rows: DataFrame) -> DataFrame:
    """One row per key with the number of its mapping rows and the category of the first."""
    return valid(rows).groupBy("sku_key").agg(F.count("*").alias("n_rows"), F.min_by("category", "seq").alias("category"))


def lookup(images: DataFrame, rows: DataFrame) -> DataFrame:
    """Images with stem, and sku_key, n_rows and category of the mapping of their stem, else of their whole name, regardless of case; the key is null without one."""
    keyed = by_sku(rows)
    side = lambda k: keyed.select(F.col("sku_key").alias(f"key{k}"), F.col("n_rows").alias(f"n{k}"), F.col("category").alias(f"category{k}"))
    d = images.withColumn("stem", stem(F.col("name")))
    d = d.join(side(1), F.lower("stem") == F.col("key1"), "left").join(side(2), F.lower("name") == F.col("key2"), "left")
    found = {"sku_key": F.coalesce("key1", "key2"), "n_rows": F.coalesce("n1", "n2", F.lit(0)), "category": F.when(F.col("key1").isNotNull(), F.col("category1")).otherwise(F.coalesce("category2", F.lit("")))}
    return d.withColumns(found).drop(*[f"{c}{k}" for c in ("key", "n", "category") for k in (1, 2)])


def missing(images: DataFrame, rows: DataFrame) -> DataFrame:
    return lookup(images, rows).where("sku_key is null").drop("sku_key", "n_rows", "category")


def proposed_names(looked_up: DataFrame, rows: DataFrame, pattern: str, ext: str) -> DataFrame:
    """One row for each image and mapping row of its key, with row_idx from 0 and the output name that the pattern gives."""
    place = F.row_number().over(Window.partitionBy("sku_key").orderBy("seq")) - 1
    own = valid(rows).select("sku_key", place.alias("row_idx"), F.col("store_article").alias("__article"), F.col("suffix").alias("__suffix"))
    name = from_pattern(pattern, ext, source_stem=F.col("stem"), store_article=F.col("__article"), suffix=F.col("__suffix"))
    return looked_up.join(own, "sku_key").withColumn("output_name", name).drop("__article", "__suffix")


def first_of_each_stem(images: DataFrame) -> DataFrame:
    """Of images of one stem the one of the best format (png, tif, jpg, others), the first of these."""
    ext = F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1))
    rank = F.when(ext == "png", 0).when(ext.isin("tif", "tiff"), 1).when(ext.isin("jpg", "jpeg"), 2).otherwise(9)
    d = images.withColumns({"stem": stem(F.col("name")), "priority": rank})
    w = Window.partitionBy("stem").orderBy("priority", "seq")
    return d.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def first_of_each_sku(rows: DataFrame, key: str = "sku") -> DataFrame:
    w = Window.partitionBy(key).orderBy("seq")
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
