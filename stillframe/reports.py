"""Reports for people and other programs, written by the driver from small aggregates."""

from __future__ import annotations

import json
import os
from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .engine import Run, flat_results, review_rows, statistics
from .kernels import codec, sheets
from .operators import contact, diff, stats
from .sources import files


def _write(path: str, text: str | bytes) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def _json(path: str, value) -> None:
    _write(path, json.dumps(value, ensure_ascii=False, indent=2))


def stats_json(run: Run, path: str) -> None:
    _json(path, statistics(run))


def results_json(results: DataFrame, path: str) -> None:
    """One object keyed by image names; measures that an image lacks are left out."""
    rows = stats.projection(flat_results(results).withColumn("fill_ratio", F.col("crop_metrics.fill_ratio")))
    out = {}
    for r in rows.orderBy("name").toLocalIterator():
        own = r.asDict()
        out[own.pop("name")] = {k: v for k, v in own.items() if v is not None}
    _json(path, out)


def review_manifest(results: DataFrame, path: str) -> None:
    measures = lambda m: None if m is None else {k: round(v, 4) if isinstance(v, float) else v for k, v in m.asDict(True).items()}
    rows = [
        {
            "source": r.source_path, "source_size_bytes": r.source_size_bytes, "source_dimensions": [r.source_width or 0, r.source_height or 0], "category": r.category, "status": r.status,
            "proposed_outputs": r.proposed_filenames, "flags": r.flags, "flag_descriptions": r.flag_descriptions, "fallback_attempted": r.fallback_attempted, "fallback_succeeded": r.status == "recovered",
            "error": r.error_message, "primary_metrics": measures(r.crop_metrics), "fallback_metrics": measures(r.fallback_metrics),
        }
        for r in review_rows(results).orderBy("seq").toLocalIterator()
    ]
    _json(path, rows)


def _table(head: list[str], rows: list[list]) -> str:
    cells = lambda tag, row: "<tr>" + "".join(f"<{tag}>{escape(str(c))}</{tag}>" for c in row) + "</tr>"
    return "<table>" + cells("th", head) + "".join(cells("td", r) for r in rows) + "</table>"


def _page(title: str, body: str) -> str:
    return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{escape(title)}</title><style>body{{font-family:sans-serif}}td,th{{padding:2px 8px;border:1px solid #ccc}}table{{border-collapse:collapse}}</style></head><body><h1>{escape(title)}</h1>{body}</body></html>'


def console(s: dict) -> str:
    g, p, q = s["general"], s["performance"], s["quality"]
    lines = [f"{g['total_discovered']} images found, {g['total_attempted']} processed: {g['total_ok']} ok, {g['total_recovered']} recovered, {g['total_flagged']} flagged, {g['total_failed']} failed"]
    lines += [f"  {c:<26}{v['total']:>6} images {v['success_rate']:>7.1%}  ({v['ok']} ok, {v['recovered']} recovered, {v['flagged']} flagged, {v['failed']} failed)" for c, v in s["by_category"].items()]
    lines += [f"  {f:<26}{n:>6}" for f, n in sorted(s["by_flag"].items(), key=lambda x: (-x[1], x[0]))]
    lines += [f"fill {q['avg_fill_ratio']:.3f} on average, from {q['min_fill_ratio']:.3f} to {q['max_fill_ratio']:.3f}, median {q['fill_ratio_p50']:.3f}"]
    lines += [f"fallback tried {p['fallback_invocation_count']} times ({p['fallback_invocation_rate']:.1%}), {p['avg_fallback_time_s']:.2f} s each; crops {p['primary_crop_avg_s']:.2f} s, 95 % within {p['primary_crop_p95_s']:.2f} s"]
    return "\n".join([*lines, f"{p['total_time_s']:.1f} s, {p['avg_per_image_s']:.2f} s an image, 95 % within {p['per_image_p95_s']:.2f} s"])


def html_report(run: Run, path: str) -> None:
    s = statistics(run)
    body = "".join(f"<h2>{k.replace('_', ' ')}</h2>" + _table(["", "value"], [[a, b] for a, b in v.items()]) for k, v in s.items() if k != "by_category")
    heads = ["category", *next(iter(s["by_category"].values()), {})]
    body += "<h2>by category</h2>" + _table(heads, [[c, *v.values()] for c, v in s["by_category"].items()])
    rows = [[r.name, r.category, r.status, ", ".join(r.flag_descriptions), "tried" if r.fallback_attempted else "no"] for r in review_rows(run.results).orderBy("seq").toLocalIterator()]
    summary = "<pre>" + escape(console(s).split("\n", 1)[0]) + "</pre>"
    _write(path, _page("Run report", summary + body + "<h2>to review</h2>" + _table(["image", "category", "status", "why", "fallback"], rows)))


def diff_report(before: DataFrame, after: DataFrame) -> dict:
    rows = diff.classify(before, after).cache()
    try:
        flags = diff.flag_changes(rows).orderBy(F.desc("n"), "flag").collect()
        return {
            "counters": diff.counters(rows).first().asDict(), "categories": [r.asDict() for r in diff.category_deltas(rows).orderBy("category").collect()],
            "flags_added": {r.flag: r.n for r in flags if r.direction == "added"}, "flags_removed": {r.flag: r.n for r in flags if r.direction == "removed"},
            **{c: [(r.name, r.category) for r in diff.first_of_change(rows, c).collect()] for c in ("improved", "regressed")},
            "fill_changes": [(r.name, r.before_fill_ratio, r.after_fill_ratio) for r in diff.largest_fill_changes(rows).collect()],
        }
    finally:
        rows.unpersist()


def diff_console(d: dict) -> str:
    c = d["counters"]
    lines = [f"before {c['before_count']} images, after {c['after_count']}, in both {c['compared']}", f"improved {c['improved']}, regressed {c['regressed']}, new {c['new']}, removed {c['removed']}, unchanged {c['unchanged_ok']} ok and {c['unchanged_bad']} bad"]
    lines += [f"  {r['category']:<26}{r['before_rate']:>8.1%} -> {r['after_rate']:>7.1%} ({r['delta_pct']:+.1f})" for r in d["categories"]]
    lines += [f"  {k}: {n} ({c_})" for k in ("improved", "regressed") for n, c_ in d[k]]
    lines += [f"  flags {k[6:]}: " + ", ".join(f"{f} {n}" for f, n in d[k].items()) for k in ("flags_added", "flags_removed") if d[k]]
    return "\n".join(lines + [f"  fill of {n}: {a:.2f} -> {b:.2f}" for n, a, b in d["fill_changes"]])


def diff_html(d: dict, path: str) -> None:
    body = _table(["", "images"], [[k, v] for k, v in d["counters"].items()])
    body += "<h2>categories</h2>" + _table(list(d["categories"][0]) if d["categories"] else [], [list(r.values()) for r in d["categories"]])
    body += "".join(f"<h2>{k.replace('_', ' ')}</h2>" + _table(["flag", "images"], list(d[k].items())) for k in ("flags_added", "flags_removed"))
    body += "".join(f"<h2>{k}</h2>" + _table(["image", "category"], d[k]) for k in ("improved", "regressed"))
    _write(path, _page("Run comparison", body + "<h2>fill changes</h2>" + _table(["image", "before", "after"], d["fill_changes"])))


def contact_sheet(results: DataFrame, image_dir: str, path: str, thumb: int = 100, columns: int = 20, quality: int = 90) -> bool:
    """The contact sheet of a folder of outputs; False without any image. Thumbnails are made by the executors."""
    spark = results.sparkSession
    outputs = files.listing(spark, image_dir).select(F.col("name").alias("output_name"), "path")
    found = contact.entries(results, outputs).withColumn("border", contact.border(F.col("status"), F.col("flags")))
    placed = contact.layout(found, thumb, columns)
    data = files.decoded(spark, image_dir, placed.join(outputs, F.col("file") == F.col("output_name")).select("path", "file", "x", "y", "border"))

    def thumbs(batches):
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                img = codec.from_row(r["height"] or -1, r["width"] or -1, r["channels"] or -1, r["data"])
                t = None if img is None else sheets.thumbnail(codec.flat(img), thumb)
                yield pa.RecordBatch.from_pylist([{"x": r["x"], "y": r["y"], "border": r["border"], "h": 0 if t is None else t.shape[0], "data": None if t is None else t.tobytes()}], schema=pa.schema([("x", pa.int64()), ("y", pa.int64()), ("border", pa.string()), ("h", pa.int64()), ("data", pa.binary())]))

    import numpy as np

    small = data.withColumns({"x": F.col("x").cast("long"), "y": F.col("y").cast("long")}).select("x", "y", "border", "height", "width", "channels", "data").mapInArrow(thumbs, "x long, y long, border string, h long, data binary").collect()
    cells = [{"x": r.x, "y": r.y, "border": r.border, "image": None if r.data is None else np.frombuffer(r.data, np.uint8).reshape(r.h, -1, 3)} for r in small]
    if not cells:
        return False
    tops = {r.category: r.y for r in placed.groupBy("category").agg(F.min("y").alias("y")).collect()}
    heads = [{"y": int(tops[r.category]) - contact.HEADER, "text": f"{r.category} ({r.n} images, {r.ok} ok)"} for r in contact.headers(found).collect()]
    sheet = sheets.contact_sheet(cells, heads, thumb, columns)
    _write(path, codec.encode(sheet, "jpg" if path.lower().endswith((".jpg", ".jpeg")) else "png", quality))
    return True
