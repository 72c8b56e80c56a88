"""Command line: run, diff, contact-sheet, prepare, rename. Exit codes: 0 done, 1 wrong input, 2 stopped by the quality gate."""

from __future__ import annotations

import argparse
import logging
import os
import shutil
import sys
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config, reports
from .engine import Engine, GateBreach, Run
from .operators import mapping as mp
from .operators import rename as rn
from .sources import files, tables
from .sources.workspace import Progress, RulesChanged, hash_file

FORMATS = ("jpg", "jpeg", "png", "tiff", "tif")
#: Folders of the supplier's delivery and their categories.
FOLDERS = {"Bollar": "BALL", "Putters": "CLUB_LONG", "Golf Bags": "BAG", "Kläder": "APPAREL_FOLDED", "Footwear - OBS Embargo": "SHOE"}

log = logging.getLogger(__name__)


def session(workers: int | None = None) -> SparkSession:
    """The active session, or a local one with so many threads."""
    found = SparkSession.getActiveSession()
    if found is not None:
        return found
    return SparkSession.builder.master(f"local[{workers or '*'}]").appName("stillframe").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stillframe", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="process a folder of photographs")
    for flags in (("--input", "-i"), ("--output", "-o"), ("--review",), ("--mapping", "-m"), ("--rules", "-r")):
        r.add_argument(*flags, required=True)
    r.add_argument("--canvas-size", "-s", type=int)
    r.add_argument("--format", "-f")
    for name in ("--stats", "--results", "--contact-sheet", "--html-report"):
        r.add_argument(name)
    for flags in (("--overwrite",), ("--verbose", "-v"), ("--dry-run",), ("--parallel", "-p"), ("--resume",), ("--force",), ("--no-checkpoint",), ("--no-quality-gate",), ("--incremental",)):
        r.add_argument(*flags, action="store_true")
    r.add_argument("--limit", "-n", type=int)
    r.add_argument("--workers", "-w", type=int, default=0)
    r.add_argument("--quality-gate", choices=("warn", "abort", "ignore"))
    r.add_argument("--force-category", action="append", default=[])
    d = sub.add_parser("diff", help="compare the results files of two runs")
    d.add_argument("--before", required=True)
    d.add_argument("--after", required=True)
    d.add_argument("--output")
    c = sub.add_parser("contact-sheet", help="thumbnails of a folder of outputs")
    for name in ("--input", "--results", "--output"):
        c.add_argument(name, name[1:3], required=True)
    for name, value in (("--thumb-size", 100), ("--columns", 20), ("--quality", 90)):
        c.add_argument(name, name[1:3], type=int, default=value)
    g = sub.add_parser("prepare", help="mapping and links for a delivery in folders by category")
    for name in ("--source", "--mapping", "--input"):
        g.add_argument(name, required=True)
    n = sub.add_parser("rename", help="copy outputs under the store's article numbers")
    for name in ("--input", "--output", "--masters"):
        n.add_argument(name, required=True)
    for name in ("--dry-run", "--skip-unmatched", "--overwrite"):
        n.add_argument(name, action="store_true")
    return p


def rules_for(a: argparse.Namespace) -> config.Rules:
    """The file's rules with what the command line says instead."""
    rules = config.load(a.rules)
    over = {"canvas_size": a.canvas_size, "output_format": a.format.lower() if a.format else None, "overwrite": True if a.overwrite else None}
    rules.globals = replace(rules.globals, **{k: v for k, v in over.items() if v is not None})
    if a.no_quality_gate:
        rules.gate = replace(rules.gate, enabled=False)
    elif a.quality_gate:
        rules.gate = replace(rules.gate, enabled=True, action=a.quality_gate)
    return rules


def threads(a: argparse.Namespace) -> int | None:
    if a.workers > 1:
        return a.workers
    n = os.cpu_count() or 1
    return (n - 1 if n > 2 else n) if a.parallel else None


def _wrong(message: str) -> int:
    print(f"error: {message}", file=sys.stderr)
    return 1


def run(a: argparse.Namespace) -> int:
    if a.verbose:
        logging.basicConfig(level=logging.INFO)
    if not os.path.isdir(a.input):
        return _wrong(f"no folder {a.input}")
    for path in (a.mapping, a.rules):
        if not os.path.isfile(path):
            return _wrong(f"no file {path}")
    if a.format and a.format.lower() not in FORMATS:
        return _wrong(f"no output format {a.format}; there are {', '.join(FORMATS)}")
    rules, spark = rules_for(a), session(threads(a))
    rows, issues = tables.load_mapping(spark, a.mapping)
    for i in issues.toLocalIterator():
        log.warning("%s: %s", i.flag, i.message)
    if a.dry_run:
        print(f"dry run: {rows.count()} mapping rows, {issues.count()} issues")
        return 0
    checkpoint = None
    if a.resume or not a.no_checkpoint:
        try:
            checkpoint = Progress(spark, os.path.join(os.path.abspath(a.output), ".checkpoint"), hash_file(spark, os.path.abspath(a.rules)), a.resume, a.force)
        except RulesChanged as e:
            return _wrong(str(e))
    references = tuple(os.path.getmtime(p) for p in (a.rules, a.mapping)) if a.incremental else ()
    code = 0
    try:
        done = Engine(spark, rules).run(a.input, a.output, a.review, rows, a.limit, checkpoint, a.incremental, references, set(a.force_category))
    except GateBreach as e:
        print(str(e), file=sys.stderr)
        done, code = Run(e.results, e.results.count(), 0.0), 2
    if checkpoint is not None:
        checkpoint.export(os.path.join(a.output, ".checkpoint.json"))
    reports.review_manifest(done.results, os.path.join(a.review, "manifest.json"))
    print(reports.console(reports.statistics(done)))
    if a.stats:
        reports.stats_json(done, a.stats)
    if a.results:
        reports.results_json(done.results, a.results)
    if a.html_report:
        reports.html_report(done, a.html_report)
    if a.contact_sheet:
        reports.contact_sheet(done.results.select("name", "category", "status", "flags"), a.output, a.contact_sheet)
    return code


def diff(a: argparse.Namespace) -> int:
    for path in (a.before, a.after):
        if not os.path.isfile(path):
            return _wrong(f"no file {path}")
    spark = session()
    found = reports.diff_report(files.results_json(spark, a.before), files.results_json(spark, a.after))
    print(reports.diff_console(found))
    if a.output:
        reports.diff_html(found, a.output)
    return 0


def contact_sheet(a: argparse.Namespace) -> int:
    if not os.path.isdir(a.input) or not os.path.isfile(a.results):
        return _wrong(f"no folder {a.input} or no file {a.results}")
    done = reports.contact_sheet(files.results_json(session(), a.results), a.input, a.output, a.thumb_size, a.columns, a.quality)
    return 0 if done else _wrong("no images")


def prepared(spark: SparkSession, source: str) -> DataFrame:
    """``(path, name, supplier_sku, store_article, suffix, category)`` of a delivery: the best file of each stem under a safe name."""
    found = files.by_folder(spark, source, FOLDERS)
    order = F.struct("folder_order", "path")
    best = mp.first_of_each_stem(found.withColumn("seq", order))
    safe = rn.safe_names(best.select("stem"))
    return best.join(safe, "stem").orderBy("stem").select("path", "name", F.col("stem").alias("supplier_sku"), F.col("safe").alias("store_article"), F.lit("cropped").alias("suffix"), "category")


def prepare(a: argparse.Namespace) -> int:
    """Writes the mapping and links the files; what the folder of links held before stays unless it is a link."""
    import csv

    if not os.path.isdir(a.source):
        return _wrong(f"no folder {a.source}")
    rows = prepared(session(), a.source).collect()
    os.makedirs(os.path.dirname(os.path.abspath(a.mapping)), exist_ok=True)
    with open(a.mapping, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["supplier_sku", "store_article", "suffix", "category"])
        w.writerows([r.supplier_sku, r.store_article, r.suffix, r.category] for r in rows)
    os.makedirs(a.input, exist_ok=True)
    for e in os.scandir(a.input):
        if e.is_symlink():
            os.unlink(e.path)
    for r in rows:
        target = os.path.join(a.input, r.name)
        if not os.path.exists(target):
            from urllib.parse import unquote

            os.symlink(unquote("/" + r.path.removeprefix("file:").lstrip("/")), target)
    print(f"{len(rows)} images mapped")
    return 0


def rename(a: argparse.Namespace) -> int:
    if not os.path.isdir(a.input) or not os.path.isdir(a.masters):
        return _wrong(f"no folder {a.input} or {a.masters}")
    spark = session()
    found = files.listing(spark, a.input).where(F.col("ext").isin("jpg", "jpeg", "png", "webp", "tif", "tiff")).withColumn("seq", F.xxhash64("name"))
    matched = rn.longest_match(found.select("name", "seq", "path", "ext"), tables.load_masters(spark, a.masters))
    counts = rn.summary(matched, a.skip_unmatched).first().asDict()
    counts |= {"written": 0, "there": 0, "errors": 0}
    wrong: list[str] = []
    if not a.dry_run:
        os.makedirs(a.output, exist_ok=True)
    for r in matched.orderBy("name").toLocalIterator():
        if r.sku is None and a.skip_unmatched:
            continue
        target = os.path.join(a.output, (r.new_stem if r.sku is not None else r.stem) + r.name[len(r.stem) :])
        if os.path.exists(target) and not a.overwrite:
            counts["there"] += 1
        elif not a.dry_run:
            try:
                shutil.copy2(os.path.join(a.input, r.name), target)
                counts["written"] += 1
            except OSError as e:
                counts["errors"] += 1
                wrong += [f"{r.name}: {e}"] if len(wrong) < 20 else []
    print(", ".join(f"{k} {v}" for k, v in counts.items()))
    for line in wrong:  # the first 20
        print(f"error: {line}", file=sys.stderr)
    return 1 if counts["errors"] else 0


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    return {"run": run, "diff": diff, "contact-sheet": contact_sheet, "prepare": prepare, "rename": rename}[a.command](a)


if __name__ == "__main__":
    sys.exit(main())
