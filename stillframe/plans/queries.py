"""Registered queries: the operators over the stand-in relations, with plain columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import GateRules, GlobalRules, category_table
from ..functions import flags as fl
from ..functions.text import digest, sanitise
from ..operators import contact, control, diff, gate, geometry, mapping, rename, stats, usage, validation
from . import relations as r

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
GATE = GateRules(check_interval=500, min_samples=50, min_success_rate=0.66)
CANVAS, LIMIT, TOP = 1000, 100, 20


def query(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    QUERIES[f.__name__] = f
    return f


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def joined(c: str | Column) -> Column:
    return F.array_join(c, ",")


def _diff(s: SparkSession, d: str) -> DataFrame:
    return diff.classify(r.spark(s, d, r.BEFORE), r.spark(s, d, r.AFTER))


def _after(s: SparkSession, d: str) -> DataFrame:
    return r.spark(s, d, r.AFTER)


def _mapping(s: SparkSession, d: str) -> DataFrame:
    return mapping.cleaned(r.spark(s, d, r.MAPPING))


def _images(s: SparkSession, d: str) -> DataFrame:
    return r.spark(s, d, r.IMAGES)


def _boxes(s: SparkSession, d: str) -> DataFrame:
    return geometry.with_rules(r.spark(s, d, r.BOXES))


@query
def diff_category_delta(s, d):
    return diff.category_deltas(_diff(s, d))


@query
def diff_classify(s, d):
    return _diff(s, d).select("name", "category", "change", "before_ok", "after_ok", "before_status", "after_status", joined("before_flags").alias("before_flags"), joined("after_flags").alias("after_flags"))


@query
def diff_counters(s, d):
    return diff.counters(_diff(s, d))


@query
def diff_flag_changes(s, d):
    return diff.flag_changes(_diff(s, d))


@query
def diff_fill_changes(s, d):
    return diff.fill_changes(_diff(s, d)).withColumn("change", F.round("change", 6))


@query
def diff_fill_changes_top20(s, d):
    return diff.largest_fill_changes(_diff(s, d).withColumns({c: F.round(c, 2) for c in ("before_fill_ratio", "after_fill_ratio")}), TOP).withColumn("change", F.round("change", 6))


@query
def diff_first_regressed(s, d):
    return diff.first_of_change(_diff(s, d), "regressed").select("name", "category")


@query
def diff_first_improved(s, d):
    return diff.first_of_change(_diff(s, d), "improved").select("name", "category")


@query
def diff_categories_union(s, d):
    return diff.categories(r.spark(s, d, r.BEFORE), _after(s, d))


@query
def stats_general(s, d):
    return stats.general(_after(s, d))


@query
def stats_by_background(s, d):
    return stats.by_background(_after(s, d))


@query
def stats_by_category(s, d):
    return stats.by_category(_after(s, d))


@query
def stats_by_flag(s, d):
    return stats.by_flag(_after(s, d))


@query
def stats_quality(s, d):
    return stats.quality(_after(s, d))


@query
def stats_mapping(s, d):
    return stats.mapping(_after(s, d))


@query
def stats_performance(s, d):
    return stats.performance(_after(s, d))


@query
def results_projection(s, d):
    return longs(stats.projection(_after(s, d)), "component_count").withColumn("flags", joined("flags"))


@query
def review_manifest(s, d):
    found = stats.review(_after(s, d))
    return found.select("name", "status", "category", joined("flags").alias("flags"), F.array_join("flag_descriptions", "|").alias("flag_descriptions"), "fallback_attempted")


@query
def mapping_valid_rows(s, d):
    return mapping.valid(_mapping(s, d)).select("seq", "sku_key", "supplier_sku", "store_article", "suffix", "category", "output_name")


@query
def mapping_issues(s, d):
    return mapping.issues(_mapping(s, d)).withColumn("seq", F.coalesce("seq", F.lit(-1)))


@query
def mapping_duplicate_outputs(s, d):
    return mapping.duplicate_outputs(_mapping(s, d))


@query
def mapping_unsafe_names(s, d):
    return mapping.unsafe_names(_mapping(s, d)).select("seq", "output_name")


@query
def image_lookup(s, d):
    found = mapping.lookup(_images(s, d), _mapping(s, d))
    return found.select("seq", "name", "sku_key", "n_rows", "category")


@query
def image_missing_mapping(s, d):
    return mapping.missing(_images(s, d), _mapping(s, d)).select("seq", "name")


@query
def proposed_filenames(s, d):
    found = mapping.proposed_names(mapping.lookup(_images(s, d), _mapping(s, d)), _mapping(s, d), "{store_article}_{suffix}-{source_stem}.{ext}", "jpg")
    return longs(found.select("seq", "row_idx", "output_name"), "row_idx")


@query
def discover_filter_sort(s, d):
    return control.discover(_images(s, d)).select("seq", "name")


@query
def discover_limit(s, d):
    return control.limited(_images(s, d).dropDuplicates(["name"]), LIMIT).select("name")


@query
def dedup_by_stem_priority(s, d):
    return longs(mapping.first_of_each_stem(_images(s, d)).select("stem", "name", "seq", "priority"), "priority")


@query
def dedup_master_sku(s, d):
    rows = _mapping(s, d).select(F.col("sku_key").alias("sku"), F.col("store_article").alias("article"), "seq")
    return mapping.first_of_each_sku(rows)


@query
def sanitize_filename(s, d):
    names = r.spark(s, d, "SELECT p_partkey AS seq, concat('_', p_name, ' ', p_brand, '  å_', p_type, 'a\u0323\u030a e\u0316\u0301x\u0301-\u212a\u0327--') AS name FROM {part}")
    return names.select("seq", sanitise(F.col("name")).alias("safe"))


@query
def safe_name_uniquify(s, d):
    return longs(rename.safe_names(r.spark(s, d, "SELECT CASE WHEN p_partkey % 50 = 0 THEN concat('ö', substring('ööööööö', 1, CAST(p_partkey % 7 AS INT))) WHEN p_partkey % 2 = 0 THEN concat(p_name, ' ', p_size) ELSE concat(p_name, '_', p_size) END AS stem FROM {part}")), "idx")


def _renames(s: SparkSession, d: str) -> DataFrame:
    files = r.spark(s, d, "SELECT o_orderkey AS seq, concat('x', o_orderkey, '-', o_custkey, '.jpg') AS name FROM {orders}")
    skus = r.spark(s, d, "SELECT p_partkey AS seq, CAST(p_partkey * 3 AS STRING) AS sku, concat('Art ', p_partkey, '_', p_size) AS article FROM {part}".replace("STRING", "VARCHAR(20)"))
    return rename.longest_match(files, skus)


@query
def rename_longest_match(s, d):
    return _renames(s, d).select("seq", "name", "sku", "new_stem")


@query
def rename_summary(s, d):
    return longs(rename.summary(_renames(s, d)), "skipped", "copied")


@query
def category_rules(s, d):
    t = category_table(s)
    return t.select("name", *[F.col(c).cast("double").alias(c) for c, kind in t.dtypes if kind in ("double", "int")], "margin_mode", "thin_object_protection")


@query
def resolve_margins(s, d):
    return geometry.with_rules(category_table(s).select(F.col("name").alias("category"))).select("category", *[c.alias(f"margin_{k}") for k, c in geometry.margins().items()])


def _expanded(s: SparkSession, d: str) -> DataFrame:
    return geometry.expanded(_boxes(s, d))


@query
def expand_bbox(s, d):
    return longs(_expanded(s, d).select("id", "x", "y", "w", "h", "category", "ex", "ey", "ew", "eh"), "ex", "ey", "ew", "eh")


@query
def resize_geometry(s, d):
    return longs(geometry.resized(_expanded(s, d), CANVAS).select("id", "ew", "eh", "category", "rw", "rh"), "ew", "eh", "rw", "rh")


@query
def fill_ratio(s, d):
    return r.spark(s, d, r.BOXES).select("id", "w", "h", geometry.fill_ratio(F.col("w"), F.col("h"), CANVAS).alias("fill_ratio"))


def _metrics(s: SparkSession, d: str) -> DataFrame:
    return geometry.metrics(geometry.resized(_expanded(s, d), CANVAS), CANVAS)


@query
def crop_metrics(s, d):
    return longs(_metrics(s, d).select("id", "category", "degenerate", F.round("fill_ratio", 6).alias("fill_ratio"), F.round("crop_area_ratio", 6).alias("crop_area_ratio"), "margin_px"), "margin_px")


@query
def bbox_algebra(s, d):
    return longs(geometry.box_algebra(r.spark(s, d, r.BOXES)).select("id", "x2", "y2", "area", F.round("aspect_ratio", 6).alias("aspect_ratio"), "cx", "cy", "cw", "ch"), "cw", "ch")


def _validated(s: SparkSession, d: str, t: float) -> DataFrame:
    rows = _metrics(s, d).withColumns({"mask_pixels": F.col("tenfold") / 4000, "edge_distance": (F.col("id") % 9).cast("long")})
    return validation.validated(rows, GlobalRules(), t, edge_distance="edge_distance")


@query
def validate_primary(s, d):
    return _validated(s, d, 1.0).select("id", "x", "y", "w", "h", "category", joined("new_flags").alias("flags"))


@query
def validate_relaxed(s, d):
    return _validated(s, d, 0.8).select("id", "x", "y", "w", "h", "category", joined("new_flags").alias("flags"))


@query
def fallback_dispatch(s, d):
    rows = _after(s, d)
    return rows.select("seq", fl.dispatched(F.col("flags"), F.col("component_count") > 0).alias("strategy"))


@query
def route_status(s, d):
    rows = _after(s, d)
    none = F.array().cast("array<string>")
    second = F.when(F.col("seq") % 3 == 0, none).otherwise(F.slice("flags", 1, 1))
    return rows.select("seq", fl.routed(F.col("category") != "", F.col("background_type").isNotNull(), F.col("flags"), F.col("component_count") > 0, F.col("fallback_attempted"), second, F.lit(True)).alias("status"))


@query
def merge_flags(s, d):
    return _diff(s, d).where("change not in ('new', 'removed')").select("name", joined(fl.merged(F.col("after_status"), F.col("before_flags"), F.col("after_flags"))).alias("flags"))


@query
def flag_sets(s, d):
    both = _diff(s, d).where("change not in ('new', 'removed')")
    return both.select("name", joined(F.array_except("after_flags", "before_flags")).alias("added"), joined(F.array_intersect("before_flags", "after_flags")).alias("kept"), F.arrays_overlap("before_flags", "after_flags").alias("overlap"), (F.size(F.array_except("before_flags", "after_flags")) == 0).alias("subset"))


def _writes(s: SparkSession, d: str) -> DataFrame:
    rows = mapping.proposed_names(mapping.lookup(_images(s, d), _mapping(s, d)), _mapping(s, d), "{store_article}_{suffix}.{ext}", "jpg")
    return rows.select("output_name", "seq", "row_idx", (F.col("seq") % 9 != 0).alias("has_image"))


@query
def naming_collision(s, d):
    there = r.spark(s, d, "SELECT concat('ART', p_partkey % 1500, '_front.jpg') AS output_name FROM {part} WHERE p_partkey % 12 = 0").distinct()
    return longs(control.collisions(_writes(s, d), there), "row_idx")


@query
def resume_filter(s, d):
    done = _images(s, d).where("seq % 3 = 1").select("name").distinct()
    return control.not_done(control.limited(_images(s, d).dropDuplicates(["name"]), 400), done).select("name")


def _proposed(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    images = r.spark(s, d, "SELECT concat('SKU', o_orderkey, '.jpg') AS name, o_orderkey AS seq, o_orderdate AS mtime FROM {orders}")
    rows = mapping.proposed_names(mapping.lookup(images, _mapping(s, d)), _mapping(s, d), "{source_stem}-{store_article}.{ext}", "jpg").select("name", "mtime", "category", "output_name")
    outputs = r.spark(s, d, "SELECT concat('SKU', o_orderkey, '-ART', CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 1500 ELSE (o_orderkey + o_custkey % 2) % 1500 END, '.jpg') AS output_name, CASE WHEN o_custkey % 3 = 0 THEN o_orderdate - INTERVAL '1' DAY ELSE o_orderdate + INTERVAL '1' DAY END AS output_mtime FROM {orders}")
    return images, rows, outputs


@query
def incremental_filter(s, d):
    images, rows, outputs = _proposed(s, d)
    return control.to_process(images, rows, outputs, F.lit("1993-06-01 00:00:00").cast("timestamp")).select("name")


@query
def force_category(s, d):
    images, rows, outputs = _proposed(s, d)
    return control.to_process(images, rows, outputs, None, {"ball", "Shoe"}).select("name")


@query
def quality_gate_final(s, d):
    return gate.breaches(_after(s, d), GATE).withColumn("rate", F.round("rate", 4))


@query
def quality_gate_running(s, d):
    return longs(gate.running(_after(s, d), GATE), "tick", "total", "good")


@query
def quality_gate_top_flags(s, d):
    return longs(gate.top_flags(_after(s, d), GATE), "rank")


@query
def quality_gate_abort_prefix(s, d):
    return longs(gate.until_abort(_after(s, d), GATE).select("seq", "name", "rn"), "rn")


def _sheet(s: SparkSession, d: str) -> DataFrame:
    return contact.entries(_after(s, d), r.spark(s, d, r.OUTPUTS).dropDuplicates(["output_name"]))


@query
def contact_match(s, d):
    return contact.match(_after(s, d).select("name"), r.spark(s, d, r.OUTPUTS).select("output_name").distinct()).select("name", "matched")


@query
def contact_layout(s, d):
    return longs(contact.layout(_sheet(s, d)).select("category", "file", "name", "x", "y"), "x", "y")


@query
def contact_header(s, d):
    return contact.headers(_sheet(s, d))


@query
def contact_border(s, d):
    return _sheet(s, d).select("category", "file", "name", contact.border(F.col("status"), F.col("flags")).alias("border"))


@query
def contact_uncategorised(s, d):
    return _sheet(s, d).where("category = 'UNCATEGORIZED'").select("file")


@query
def file_hash(s, d):
    return r.spark(s, d, "SELECT event_id, props FROM {events}").select("event_id", digest(F.col("props").cast("binary")).alias("sha256"))


for _name in usage.QUERIES:
    QUERIES[_name] = (lambda f: lambda s, d: f(lambda text: r.spark(s, d, text)))(usage.QUERIES[_name])
