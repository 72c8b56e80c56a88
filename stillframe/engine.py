"""A run over a folder of photographs, from listing to reports."""

from __future__ import annotations

import logging
import os
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .config import Rules
from .functions.text import output_extension
from .kernels.strategy import Strategy
from .operators import control, gate, mapping, stats
from .operators.crop_stage import copied, cropped, written
from .operators.ordering import numbered
from .schema import BAD, FLAGGED, METRICS, RESULTS
from .sources import files
from .sources.workspace import Progress, kept, workspace

log = logging.getLogger(__name__)

#: Images between two records of progress; a gate that aborts has its own interval.
STRETCH = 1000


class GateBreach(RuntimeError):
    """Too few good images in a category; holds the results so far."""

    def __init__(self, message: str, results: DataFrame):
        super().__init__(message)
        self.results = results


@dataclass
class Run:
    results: DataFrame
    discovered: int
    seconds: float


class Engine:
    """``Engine(spark, rules).run(...)``; strategies are sent to the executors as they are."""

    def __init__(self, spark: SparkSession, rules: Rules | None = None, primary: Strategy | None = None, fallback: Strategy | None = None):
        self.spark, self.rules, self.primary, self.fallback = spark, rules or Rules(), primary, fallback

    def _breaches(self, counts: dict[str, list[int]]) -> list[str]:
        """Categories that break the gate, by running counts of (all, good) images."""
        g = self.rules.gate
        return sorted(c for c, (n, good) in counts.items() if n >= g.min_samples and good / n < g.min_success_rate) if g.enabled else []

    def _gate_message(self, counts: dict[str, list[int]], results: DataFrame) -> str:
        found = self._breaches(counts)
        if not found:
            return ""
        g, tops = self.rules.gate, {}
        for r in gate.top_flags(results, g).orderBy("category", "rank").collect():
            tops.setdefault(r["category"], []).append(f"{r['flag']} ({r['n']})")
        lines = [f"{c}: {counts[c][0] - counts[c][1]} of {counts[c][0]} not good ({counts[c][1] / counts[c][0]:.0%} success, {g.min_success_rate:.0%} wanted); most frequent: {', '.join(tops.get(c, []))}" for c in found]
        return "quality gate: " + "; ".join(lines)

    def todo(self, input_dir: str, output_dir: str, rows: DataFrame, limit: int | None, checkpoint: Progress | None, incremental: bool, references: tuple, force: set[str] | None) -> tuple[DataFrame, int]:
        """Images still to process, with seq and mapping rows, and how many there are in all."""
        g = self.rules.globals
        found = control.discover(files.listing(self.spark, input_dir))
        total = found.count()
        found = found.limit(limit) if limit and limit > 0 else found
        if checkpoint is not None:
            found = control.not_done(found, checkpoint.table())
        d = mapping.lookup(numbered(found.withColumn("lower_name", F.lower("name")), ["lower_name", "name"], "seq"), rows)
        if incremental:
            expected = mapping.proposed_names(d, rows, g.filename_pattern, output_extension(g.output_format))
            there = files.listing(self.spark, output_dir).select(F.col("name").alias("output_name"), F.col("mtime").alias("output_mtime"))
            newest = F.lit(max(references)).cast("double").cast("timestamp") if references else None
            d = control.to_process(d, expected, there, newest, force)
        return d, total

    def run(self, input_dir: str, output_dir: str, review_dir: str, rows: DataFrame, limit: int | None = None, checkpoint: Progress | None = None, incremental: bool = False, references: tuple = (), force: set[str] | None = None) -> Run:
        """Process a folder; ``rows`` is a mapping as ``sources.tables.load_mapping`` gives it.

        With a gate that aborts, or a record of progress, images are handled in
        stretches, in order of their names; else all at once. Results are
        appended to one table, of which the gate keeps counts by category.
        """
        few, before = "spark.sql.execution.arrow.maxRecordsPerBatch", self.spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        self.spark.conf.set(few, "8")  # rows of pixels are large
        try:
            return self._run(input_dir, output_dir, review_dir, rows, limit, checkpoint, incremental, references, force)
        finally:
            self.spark.conf.set(few, before)

    def _run(self, input_dir: str, output_dir: str, review_dir: str, rows: DataFrame, limit: int | None, checkpoint: Progress | None, incremental: bool, references: tuple, force: set[str] | None) -> Run:
        began = time.time()
        for d in (output_dir, review_dir):
            os.makedirs(d, exist_ok=True)
        place, g = workspace(self.spark), self.rules.gate
        todo, total = self.todo(input_dir, output_dir, rows, limit, checkpoint, incremental, references, force)
        todo = kept(numbered(todo.drop("lower_name"), ["seq"]), f"{place}/todo")
        n, path, counts = todo.count(), f"{place}/results", {}
        self.spark.createDataFrame([], RESULTS).write.parquet(path)
        stretch = g.check_interval if g.enabled and g.action == "abort" else STRETCH if checkpoint is not None else max(n, 1)
        for k, at in enumerate(range(0, n, stretch)):
            own = self._stretch(todo.where((F.col("rn") > at) & (F.col("rn") <= at + stretch)), rows, input_dir, output_dir, review_dir, self._results(path), f"{place}/{k}")
            own.write.mode("append").parquet(path)
            if checkpoint is not None:
                checkpoint.add(own)
            for r in gate.counts(own).collect():
                both = counts.setdefault(r["category"], [0, 0])
                both[0], both[1] = both[0] + r["total"], both[1] + r["good"]
            if g.enabled and g.action == "abort" and self._breaches(counts):
                break
        results = self._results(path)
        message = self._gate_message(counts, results)
        if message:
            log.warning(message)
            if g.action == "abort":
                raise GateBreach(message, results)
        return Run(results, total, time.time() - began)

    def _results(self, path: str) -> DataFrame:
        return self.spark.read.schema(StructType.fromDDL(RESULTS)).parquet(path)

    def _stretch(self, todo: DataFrame, rows: DataFrame, input_dir: str, output_dir: str, review_dir: str, before: DataFrame, place: str) -> DataFrame:
        g = self.rules.globals
        ext = output_extension(g.output_format)
        mapped = todo.where("sku_key is not null")
        crops = kept(cropped(files.decoded(self.spark, input_dir, mapped.select("seq", "category", "path")), self.rules, self.primary, self.fallback), f"{place}/crops")
        names = mapping.proposed_names(mapped, rows, g.filename_pattern, ext).select("seq", "row_idx", "output_name")
        wanted = names.join(crops.select("seq", F.col("encoded").isNotNull().alias("has_image")), "seq")
        earlier = before.select(F.explode("output_names").alias("output_name"))
        there = files.listing(self.spark, output_dir).select(F.col("name").alias("output_name"))
        taken = (earlier if g.overwrite else earlier.unionByName(there)).distinct()
        writes = kept(control.collisions(wanted, taken), f"{place}/writes")
        written(writes.where("has_image and not conflict").join(crops.select("seq", "encoded"), "seq"), output_dir)
        out = writes.groupBy("seq").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("row_idx", "output_name"))), lambda x: x["output_name"]).alias("proposed_filenames"),
            F.transform(F.sort_array(F.collect_list(F.when(F.col("has_image") & ~F.col("conflict"), F.struct("row_idx", "output_name")))), lambda x: x["output_name"]).alias("output_names"),
            F.bool_or("conflict").alias("conflict"),
        )
        none = F.array().cast("array<string>")
        base = todo.select("seq", "name", F.col("path").alias("source_path"), "category", F.col("size_bytes").alias("source_size_bytes"), F.col("sku_key").isNotNull().alias("mapped"))
        d = base.join(crops.drop("encoded", "preview"), "seq", "left").join(out, "seq", "left")
        d = d.withColumns({
            "status": F.when(~F.col("mapped"), FLAGGED).otherwise(F.col("status")),
            "flags": F.when(~F.col("mapped"), F.array(F.lit("missing_mapping"))).when(F.coalesce("conflict", F.lit(False)), F.array_union("flags", F.array(F.lit("naming_conflict")))).otherwise(F.col("flags")),
            "proposed_filenames": F.coalesce("proposed_filenames", none), "output_names": F.coalesce("output_names", none),
            **{c: F.coalesce(c, F.lit(0.0)) for c in ("processing_time_s", "crop_time_s", "fallback_time_s")}, "fallback_attempted": F.coalesce("fallback_attempted", F.lit(False)),
        })
        columns = [p.split()[0] for p in RESULTS.replace(f" {METRICS}", " x").split(", ")]
        results = kept(d.select(*columns), f"{place}/results")
        written(results.where(F.col("status") == FLAGGED).join(crops.select("seq", "preview"), "seq").withColumn("file", F.concat(F.regexp_replace("name", r"\.[^.]+$", ""), F.lit("_preview.png"))), review_dir, "file", "preview")
        copied(results.where(F.col("status") == FLAGGED).select(F.col("source_path").alias("path")), review_dir)
        return results


def flat_results(results: DataFrame) -> DataFrame:
    """Results with the measures that statistics take, as columns of their own."""
    return results.withColumns({"fill_ratio": F.coalesce("crop_metrics.fill_ratio", F.lit(0.0)), "crop_area_ratio": F.col("crop_metrics.crop_area_ratio"), "component_count": F.col("crop_metrics.component_count")})


# Keys of the statistics file.
QUALITY_KEYS = {"fill_avg": "avg_fill_ratio", "fill_min": "min_fill_ratio", "fill_max": "max_fill_ratio", "fill_p10": "fill_ratio_p10", "fill_p50": "fill_ratio_p50", "fill_p90": "fill_ratio_p90", "crop_area_avg": "avg_crop_area_ratio"}
PERFORMANCE_KEYS = {"processing_avg_s": "avg_per_image_s", "processing_p95_s": "per_image_p95_s", "crop_avg_s": "primary_crop_avg_s", "crop_p95_s": "primary_crop_p95_s", "fallback_avg_s": "avg_fallback_time_s", "fallback_count": "fallback_invocation_count", "fallback_rate": "fallback_invocation_rate"}


def statistics(run: Run) -> dict:
    """All statistics of a run, as plain values."""
    d = flat_results(run.results)
    one = lambda f: f(d).first().asDict()
    by = lambda f, k: {r[k]: {c: v for c, v in r.asDict().items() if c != k} for r in sorted(f(d).collect())}
    named = lambda values, names: {names.get(k, k): v for k, v in values.items()}
    return {
        "general": {"total_discovered": run.discovered, **named(one(stats.general), {s: f"total_{s}" for s in stats.STATUSES})},
        "by_background_type": {k: v["n"] for k, v in by(stats.by_background, "background_type").items()},
        "by_category": by(stats.by_category, "category"), "by_flag": {k: v["n"] for k, v in by(stats.by_flag, "flag").items()},
        "quality": named(one(stats.quality), QUALITY_KEYS), "mapping": {f"{k}_count": v for k, v in one(stats.mapping).items()},
        "performance": {"total_time_s": round(run.seconds, 2), **named(one(stats.performance), PERFORMANCE_KEYS)},
    }


def review_rows(results: DataFrame) -> DataFrame:
    return stats.review(results.where(F.col("status").isin(*BAD)))
