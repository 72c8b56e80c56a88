"""The same results in DuckDB's SQL."""

from __future__ import annotations

from dataclasses import asdict

from ..config import KNOWN, CategoryRules, GlobalRules
from ..operators import usage
from ..schema import FLAG_DESCRIPTIONS, IMAGE_EXTENSIONS
from . import queries as q
from . import relations as r

G = GlobalRules()
GOOD = "('ok', 'recovered')"


def _value(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else f"CAST({v!r} AS DOUBLE)"


_FIELDS = list(asdict(CategoryRules()))
_RULE_ROWS = ", ".join("(" + ", ".join(map(_value, asdict(c).values())) + ")" for c in (*KNOWN.values(), CategoryRules()))
RULES = f"rules({', '.join(_FIELDS)}) AS (VALUES {_RULE_ROWS})"

DIFF = r.ctes("before", "after") + f""", diff AS (
  SELECT coalesce(b.name, a.name) AS name,
    CASE WHEN b.name IS NULL THEN coalesce(a.category, 'UNKNOWN') WHEN a.name IS NULL THEN coalesce(b.category, 'UNKNOWN') WHEN coalesce(a.category, '') <> '' THEN a.category ELSE coalesce(b.category, 'UNKNOWN') END AS category,
    b.status AS before_status, a.status AS after_status, b.flags AS before_flags, a.flags AS after_flags, b.fill_ratio AS before_fill_ratio, a.fill_ratio AS after_fill_ratio,
    coalesce(b.status IN {GOOD}, false) AS before_ok, coalesce(a.status IN {GOOD}, false) AS after_ok, b.name IS NOT NULL AS in_b, a.name IS NOT NULL AS in_a
  FROM before b FULL JOIN after a ON a.name = b.name
), rows AS (
  SELECT *, CASE WHEN NOT in_b THEN 'new' WHEN NOT in_a THEN 'removed' WHEN NOT before_ok AND after_ok THEN 'improved' WHEN before_ok AND NOT after_ok THEN 'regressed' WHEN after_ok THEN 'unchanged_ok' ELSE 'unchanged_bad' END AS change FROM diff
), both_runs AS (SELECT * FROM rows WHERE in_a AND in_b)
"""
AFTER = r.ctes("after")
_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_SAFE = "regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '[\\s_]+', '-', 'g'), '[^a-zA-Z0-9\\-.]', '', 'g'), '-{{2,}}', '-', 'g'), '^[-.]+|[-.]+$', '', 'g')"


def safe(c: str) -> str:
    return _SAFE.format(c)


def stem(c: str) -> str:
    return rf"regexp_replace({c}, '(.)\.[^.]+$', '\1')"


MAPPING = r.ctes("mapping") + ", cells AS (SELECT seq, " + ", ".join(f"{_TRIM.format(c)} AS {c}" for c in ("supplier_sku", "store_article", "suffix", "category")) + """ FROM mapping),
m AS (SELECT *, lower(supplier_sku) AS sku_key, store_article || '_' || suffix || '.jpg' AS output_name FROM cells),
valid AS (SELECT * FROM m WHERE supplier_sku <> '' AND store_article <> '' AND suffix <> ''),
unsafe AS (SELECT * FROM valid WHERE NOT regexp_matches(regexp_replace(regexp_extract(output_name, '[^/]*$'), '\\.jpg$', ''), '^[\\p{L}\\p{N}_-]+$')),
dups AS (SELECT output_name, count(*) AS n FROM valid GROUP BY output_name HAVING count(*) > 1)
"""


def lookup(images: str) -> str:
    """Images with the rows of their stem, else of their name."""
    return MAPPING + f""", images AS ({images}), keys AS (SELECT DISTINCT sku_key FROM valid),
    keyed AS (SELECT i.*, {stem('i.name')} AS stem, coalesce(a.sku_key, b.sku_key) AS sku_key FROM images i LEFT JOIN keys a ON lower({stem('i.name')}) = a.sku_key LEFT JOIN keys b ON lower(i.name) = b.sku_key),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY sku_key ORDER BY seq) - 1 AS row_idx FROM valid)
    """


LOOKUP = lookup(r.duck(r.IMAGES))

def boxes(relation: str, canvas: int) -> str:
    """Boxes of objects with their margins, sizes on a canvas and measures."""
    return "WITH " + RULES + f""", boxes AS ({relation}),
b AS (SELECT boxes.*, rules.* EXCLUDE (name) FROM boxes JOIN rules ON rules.name = CASE WHEN boxes.category IN (SELECT name FROM rules) THEN boxes.category ELSE '' END),
c AS (SELECT *, CASE WHEN margin_mode = 'object' THEN w ELSE greatest(img_w, img_h) END AS ref_x, CASE WHEN margin_mode = 'object' THEN h ELSE greatest(img_w, img_h) END AS ref_y, thin_object_protection AND greatest(w, h) / least(w, h) > 3.0 AS thin FROM b),
d AS (SELECT *, trunc(ref_y * CASE WHEN margin_top < 0 THEN margin_pct ELSE margin_top END) AS t0, trunc(ref_y * CASE WHEN margin_bottom < 0 THEN margin_pct ELSE margin_bottom END) AS b0,
  trunc(ref_x * CASE WHEN margin_left < 0 THEN margin_pct ELSE margin_left END) AS l0, trunc(ref_x * CASE WHEN margin_right < 0 THEN margin_pct ELSE margin_right END) AS r0 FROM c),
e AS (SELECT *, CASE WHEN thin AND w < h THEN trunc(l0 * 1.5) ELSE l0 END AS l1, CASE WHEN thin AND w < h THEN trunc(r0 * 1.5) ELSE r0 END AS r1, CASE WHEN thin AND w >= h THEN trunc(t0 * 1.5) ELSE t0 END AS t1, CASE WHEN thin AND w >= h THEN trunc(b0 * 1.5) ELSE b0 END AS b1 FROM d),
f AS (SELECT *, x - l1 AS x1, y - t1 AS y1, w + l1 + r1 AS w1, h + t1 + b1 AS h1, floor(greatest(w, h) / 4) AS least_side FROM e),
g AS (SELECT *, CASE WHEN thin AND w1 < least_side THEN floor((least_side - w1) / 2) ELSE 0 END AS gw, CASE WHEN thin AND w1 >= least_side AND h1 < least_side THEN floor((least_side - h1) / 2) ELSE 0 END AS gh FROM f),
k AS (SELECT *, greatest(0, x1 - gw) AS ex, greatest(0, y1 - gh) AS ey FROM g),
expanded AS (SELECT *, greatest(0, least(img_w, x1 + w1 + gw) - ex) AS ew, greatest(0, least(img_h, y1 + h1 + gh) - ey) AS eh FROM k),
s0 AS (SELECT *, least(trunc({canvas} * target_fill_ratio_max) / greatest(1, ew), trunc({canvas} * target_fill_ratio_max) / greatest(1, eh)) AS sc0 FROM expanded),
s1 AS (SELECT *, CASE WHEN sc0 > 1 AND target_fill_ratio_max < 0.8 THEN least(1.0, {canvas} / greatest(1, ew, eh)) ELSE sc0 END AS sc, least(min_output_px / greatest(1, ew, eh), {canvas} / greatest(1, ew, eh)) AS up FROM s0),
s2 AS (SELECT *, greatest(1, trunc(ew * sc)) AS nw, greatest(1, trunc(eh * sc)) AS nh FROM s1),
sized AS (SELECT *, CASE WHEN min_output_px > 0 AND greatest(nw, nh) < min_output_px THEN greatest(1, trunc(ew * up)) ELSE nw END AS rw, CASE WHEN min_output_px > 0 AND greatest(nw, nh) < min_output_px THEN greatest(1, trunc(eh * up)) ELSE nh END AS rh FROM s2),
measured AS (SELECT *, ew < 1 OR eh < 1 AS degenerate, greatest(rw, rh) / {float(canvas)} AS fill_ratio, ew * eh / greatest(1, img_w * img_h) AS crop_area_ratio, greatest(x - ex, y - ey, ex + ew - x - w, ey + eh - y - h, 0) AS margin_px FROM sized)
"""


BOXES = boxes(r.duck(r.BOXES), q.CANVAS)


def big(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


def checks(t: float, edge: str | None) -> str:
    """The flags of a row of ``measured``, as a list; ``edge`` is the distance from the canvas's edge."""
    own = lambda c, other: f"(CASE WHEN {c} > 0 THEN {c} ELSE {other} END * {t})"
    area, aspect = "greatest(1, img_w * img_h)", "(greatest(w, h) / greatest(1, least(w, h)))"
    rules = {
        "mask_too_small": f"tenfold / 4000 / {area} < {own('min_object_ratio', G.min_object_ratio)}",
        "bbox_too_large": f"w * h / {area} > {G.max_bbox_ratio}",
        "bbox_too_small": f"w * h / {area} < {own('min_bbox_ratio', G.min_bbox_ratio)}",
        "crop_category_inconsistent": f"w > 0 AND h > 0 AND ({aspect} < expected_aspect_ratio_min * {t} OR {aspect} > expected_aspect_ratio_max / {t})",
        "fill_ratio_too_low": f"fill_ratio > 0 AND fill_ratio < target_fill_ratio_min * {t}",
        "fill_ratio_too_high": f"fill_ratio > 0 AND fill_ratio > least(1.0, target_fill_ratio_max / {t})",
    }
    if edge is not None:
        rules["object_too_close_to_edge"] = f"edge_proximity_px > 0 AND {edge} < greatest(1, trunc(edge_proximity_px * {t}))"
    cases = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in rules.items())
    return f"[f FOR f IN [{cases}] IF f IS NOT NULL]"


def validate(t: float) -> str:
    return BOXES + f"SELECT id, x, y, w, h, category, coalesce(array_to_string({checks(t, 'id % 9')}, ','), '') AS flags FROM measured"


GATE = AFTER + f", g AS (SELECT *, CASE WHEN coalesce(category, '') = '' THEN 'UNKNOWN' ELSE category END AS cat, status IN {GOOD} AS good FROM after), breaches AS (SELECT cat AS category, count(*) AS total, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE good) / count(*) AS rate FROM g GROUP BY cat HAVING count(*) >= {q.GATE.min_samples} AND count(*) FILTER (WHERE good) / count(*) < {q.GATE.min_success_rate})"
RUNNING = GATE + f""", n AS (SELECT *, row_number() OVER (ORDER BY seq) AS rn FROM g),
ticks AS (SELECT rn AS upto, rn // {q.GATE.check_interval} AS tick FROM n WHERE rn % {q.GATE.check_interval} = 0),
running AS (SELECT tick, cat AS category, count(*) AS total, count(*) FILTER (WHERE good) AS good FROM ticks JOIN n ON n.rn <= ticks.upto GROUP BY tick, cat),
checked AS (SELECT *, good / total AS rate, total >= {q.GATE.min_samples} AND good / total < {q.GATE.min_success_rate} AS breach FROM running)"""

SHEET = AFTER + f""", outs AS (SELECT DISTINCT output_name FROM ({r.duck(r.OUTPUTS)})),
st AS (SELECT name, {stem('name')} AS stem FROM after),
cropped AS (SELECT name, min_by(output_name, list_position(['jpg', 'jpeg', 'png', 'webp'], regexp_extract(output_name, '\\.([^.]+)$', 1))) AS f FROM st JOIN outs ON output_name IN (stem || '-cropped.jpg', stem || '-cropped.jpeg', stem || '-cropped.png', stem || '-cropped.webp') GROUP BY name),
begins AS (SELECT name, min(output_name) AS f FROM st JOIN outs ON starts_with(lower(output_name), lower(stem)) WHERE name NOT IN (SELECT output_name FROM outs) AND name NOT IN (SELECT name FROM cropped) GROUP BY name),
matched AS (SELECT a.name, a.status, a.flags, a.category, coalesce(o.output_name, c.f, b.f) AS file FROM after a LEFT JOIN outs o ON o.output_name = a.name LEFT JOIN cropped c USING (name) LEFT JOIN begins b USING (name)),
entries AS (SELECT CASE WHEN coalesce(category, '') = '' THEN 'UNKNOWN' ELSE category END AS category, file, name, status, flags FROM matched WHERE file IS NOT NULL
  UNION ALL SELECT 'UNCATEGORIZED', output_name, output_name, '', CAST([] AS VARCHAR[]) FROM outs WHERE output_name NOT IN (SELECT file FROM matched WHERE file IS NOT NULL) AND regexp_matches(lower(output_name), '\\.(jpg|jpeg|png)$')),
heads AS (SELECT category, count(*) AS n, count(*) FILTER (WHERE status IN {GOOD}) AS ok FROM entries GROUP BY category)
"""

_INC_IMAGES = "SELECT concat('SKU', o_orderkey, '.jpg') AS name, o_orderkey AS seq, o_orderdate AS mtime FROM orders"
INCREMENTAL = lookup(_INC_IMAGES) + f""", outs AS (SELECT concat('SKU', o_orderkey, '-ART', CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 1500 ELSE (o_orderkey + o_custkey % 2) % 1500 END, '.jpg') AS output_name, CASE WHEN o_custkey % 3 = 0 THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate + INTERVAL 1 DAY END AS output_mtime FROM orders),
heads AS (SELECT sku_key, category FROM ranked WHERE row_idx = 0),
proposed AS (SELECT k.name, k.mtime, k.stem || '-' || r.store_article || '.jpg' AS output_name, h.category FROM keyed k JOIN ranked r USING (sku_key) JOIN heads h USING (sku_key)),
joined AS (SELECT p.*, o.output_mtime FROM proposed p LEFT JOIN outs o USING (output_name))
"""


def incremental(reference: str, forced: str) -> str:
    fresh = "output_mtime IS NOT NULL AND output_mtime >= mtime" + (f" AND output_mtime >= TIMESTAMP '{reference}'" if reference else "")
    return INCREMENTAL + f"SELECT name FROM images WHERE name NOT IN (SELECT name FROM proposed) OR name IN (SELECT name FROM joined GROUP BY name HAVING NOT bool_and({fresh}) OR bool_or(upper(category) IN ({forced})))"


_EXT = ", ".join(f"'{e}'" for e in IMAGE_EXTENSIONS)
IMAGES = r.ctes("images")
_IS_IMAGE = rf"lower(regexp_extract(name, '.\.([^.]+)$', 1)) IN ({_EXT})"

_USED = f"WITH l AS ({r.duck(usage.LICENCES)}), u AS ({r.duck(usage.USAGE)}), p AS (SELECT l.*, coalesce((SELECT sum(images) FROM u WHERE u.customer = l.customer AND u.used_at >= l.starts AND u.used_at < l.ends), 0) AS used FROM l) "
_JOBS = f"WITH j AS ({r.duck(usage.JOBS)}), n AS (SELECT job, count(*) AS processed, count(*) FILTER (WHERE good AND NOT failed) AS success, count(*) FILTER (WHERE NOT good AND NOT failed) AS flagged, count(*) FILTER (WHERE failed) AS failed FROM j GROUP BY job) "
_RENAME = f"""WITH files AS (SELECT o_orderkey AS seq, concat('x', o_orderkey, '-', o_custkey, '.jpg') AS name FROM orders), skus AS (SELECT p_partkey AS seq, CAST(p_partkey * 3 AS VARCHAR) AS sku, concat('Art ', p_partkey, '_', p_size) AS article FROM part),
stems AS (SELECT *, {stem('name')} AS stem FROM files), hits AS (SELECT f.seq AS fseq, s.*, row_number() OVER (PARTITION BY f.seq ORDER BY length(s.sku) DESC, s.seq) AS rn FROM stems f JOIN skus s ON contains(f.stem, s.sku)),
found AS (SELECT f.seq, f.name, f.stem, h.sku, CASE WHEN h.sku IS NOT NULL THEN substr(f.stem, 1, instr(f.stem, h.sku) - 1) || {safe('h.article')} || substr(f.stem, instr(f.stem, h.sku) + length(h.sku)) END AS new_stem FROM stems f LEFT JOIN hits h ON h.fseq = f.seq AND h.rn = 1) """
_DESCRIBED = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in FLAG_DESCRIPTIONS.items()) + "}"


def rate(total: str, ok: str) -> str:
    return f"({ok} / greatest(1, {total}))"


_n = lambda c: f"count(*) FILTER (WHERE {c})"
_st = ", ".join(f"{_n(f"status = '{s}'")} AS {s}" for s in ("ok", "flagged", "failed", "recovered"))

ORACLE: dict[str, str] = {
    "diff_classify": DIFF + "SELECT name, category, change, before_ok, after_ok, before_status, after_status, array_to_string(before_flags, ',') AS before_flags, array_to_string(after_flags, ',') AS after_flags FROM rows",
    "diff_counters": DIFF + "SELECT count(*) FILTER (WHERE in_b) AS before_count, count(*) FILTER (WHERE in_a) AS after_count, count(*) FILTER (WHERE in_a AND in_b) AS compared, " + ", ".join(f"{_n(f"change = '{c}'")} AS {c}" for c in ("improved", "regressed", "unchanged_ok", "unchanged_bad", "new", "removed")) + " FROM rows",
    "diff_category_delta": DIFF + f", t AS (SELECT category, {_n('in_b')} AS before_total, {_n('before_ok')} AS before_ok, {_n('in_a')} AS after_total, {_n('after_ok')} AS after_ok, {_n("change = 'improved'")} AS improved, {_n("change = 'regressed'")} AS regressed FROM rows GROUP BY category) SELECT category, before_total, before_ok, round({rate('before_total', 'before_ok')}, 4) AS before_rate, after_total, after_ok, round({rate('after_total', 'after_ok')}, 4) AS after_rate, round(({rate('after_total', 'after_ok')} - {rate('before_total', 'before_ok')}) * 100, 1) AS delta_pct, improved, regressed FROM t",
    "diff_flag_changes": DIFF + "SELECT direction, flag, count(*) AS n FROM (SELECT 'added' AS direction, unnest([f FOR f IN after_flags IF NOT list_contains(before_flags, f)]) AS flag FROM both_runs UNION ALL SELECT 'removed', unnest([f FOR f IN before_flags IF NOT list_contains(after_flags, f)]) FROM both_runs) GROUP BY direction, flag",
    "diff_fill_changes": DIFF + "SELECT name, before_fill_ratio, after_fill_ratio, round(abs(after_fill_ratio - before_fill_ratio), 6) AS change FROM both_runs WHERE before_fill_ratio > 0 AND after_fill_ratio > 0 AND abs(after_fill_ratio - before_fill_ratio) > 0.01",
    "diff_fill_changes_top20": DIFF + f"SELECT name, before_fill_ratio, after_fill_ratio, round(d, 6) AS change FROM (SELECT *, abs(after_fill_ratio - before_fill_ratio) AS d FROM both_runs WHERE before_fill_ratio > 0 AND after_fill_ratio > 0) WHERE d > 0.05 ORDER BY d DESC, name LIMIT {q.TOP}",
    "diff_first_regressed": DIFF + "SELECT name, category FROM rows WHERE change = 'regressed' ORDER BY name LIMIT 30",
    "diff_first_improved": DIFF + "SELECT name, category FROM rows WHERE change = 'improved' ORDER BY name LIMIT 30",
    "diff_categories_union": r.ctes("before", "after") + "SELECT category FROM before UNION SELECT category FROM after",
    "stats_general": AFTER + f"SELECT count(*) AS total_attempted, {_st} FROM after",
    "stats_by_background": AFTER + "SELECT background_type, count(*) AS n FROM after WHERE background_type IS NOT NULL GROUP BY 1",
    "stats_by_category": AFTER + f"SELECT *, round((ok + recovered) / greatest(1, total), 4) AS success_rate, round(recovered / greatest(1, flagged + failed + recovered), 4) AS fallback_recovery_rate FROM (SELECT CASE WHEN coalesce(category, '') = '' THEN 'UNKNOWN' ELSE category END AS category, count(*) AS total, {_st} FROM after GROUP BY 1)",
    "stats_by_flag": AFTER + "SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM after) GROUP BY flag",
    "stats_quality": AFTER + "SELECT " + ", ".join([f"round(coalesce({e}, 0.0), 4) AS {n}" for n, e in (("fill_avg", "avg(fill_ratio)"), ("fill_min", "min(fill_ratio)"), ("fill_max", "max(fill_ratio)"), ("fill_p10", "quantile_cont(fill_ratio, 0.1)"), ("fill_p50", "quantile_cont(fill_ratio, 0.5)"), ("fill_p90", "quantile_cont(fill_ratio, 0.9)"), ("crop_area_avg", "avg(crop_area_ratio)"))]) + " FROM after WHERE fill_ratio > 0",
    "stats_mapping": AFTER + f"SELECT {_n("list_contains(flags, 'missing_mapping')")} AS missing_mapping, {_n("list_contains(flags, 'naming_conflict')")} AS naming_conflict FROM after",
    "stats_performance": AFTER + "SELECT " + ", ".join(f"round(coalesce({e}, 0.0), 4) AS {n}" for n, e in (("processing_avg_s", "avg(processing_time_s)"), ("processing_p95_s", "quantile_cont(processing_time_s, 0.95)"), ("crop_avg_s", "avg(crop_time_s) FILTER (WHERE crop_time_s > 0)"), ("crop_p95_s", "quantile_cont(crop_time_s, 0.95) FILTER (WHERE crop_time_s > 0)"), ("fallback_avg_s", "avg(fallback_time_s) FILTER (WHERE fallback_attempted)"))) + f", {_n('fallback_attempted')} AS fallback_count, round({_n('fallback_attempted')} / greatest(1, count(*)), 4) AS fallback_rate FROM after",
    "results_projection": AFTER + "SELECT name, status, category, array_to_string(flags, ',') AS flags, round(fill_ratio, 4) AS fill_ratio, round(crop_area_ratio, 4) AS crop_area_ratio, CAST(component_count AS BIGINT) AS component_count, fallback_attempted, background_type FROM after",
    "review_manifest": AFTER + f"SELECT name, status, category, array_to_string(flags, ',') AS flags, array_to_string([coalesce({_DESCRIBED}[f], f) FOR f IN flags], '|') AS flag_descriptions, fallback_attempted FROM after WHERE status IN ('flagged', 'failed')",
    "mapping_valid_rows": MAPPING + "SELECT seq, sku_key, supplier_sku, store_article, suffix, category, output_name FROM valid",
    "mapping_duplicate_outputs": MAPPING + "SELECT * FROM dups",
    "mapping_unsafe_names": MAPPING + "SELECT seq, output_name FROM unsafe",
    "mapping_issues": MAPPING + """SELECT seq, 'missing_mapping' AS flag, 'Row ' || seq || ': empty supplier_sku' AS message FROM m WHERE supplier_sku = ''
      UNION ALL SELECT seq, 'missing_mapping', 'Row ' || seq || ': empty store_article or suffix for SKU ''' || supplier_sku || '''' FROM m WHERE supplier_sku <> '' AND (store_article = '' OR suffix = '')
      UNION ALL SELECT seq, 'missing_mapping', 'SKU ''' || supplier_sku || ''': missing category' FROM valid WHERE category = ''
      UNION ALL SELECT seq, 'naming_conflict', 'SKU ''' || supplier_sku || ''': unsafe output filename ''' || output_name || '''' FROM unsafe
      UNION ALL SELECT -1, 'naming_conflict', 'Output filename ''' || output_name || ''' appears ' || n || ' times' FROM dups""",
    "image_lookup": LOOKUP + ", found AS (SELECT sku_key, count(*) AS n, arg_min(category, seq) AS category FROM valid GROUP BY sku_key) SELECT k.seq, k.name, k.sku_key, coalesce(f.n, 0) AS n_rows, coalesce(f.category, '') AS category FROM keyed k LEFT JOIN found f USING (sku_key)",
    "image_missing_mapping": LOOKUP + "SELECT seq, name FROM keyed WHERE sku_key IS NULL",
    "proposed_filenames": LOOKUP + "SELECT k.seq, r.row_idx, r.store_article || '_' || r.suffix || '-' || k.stem || '.jpg' AS output_name FROM keyed k JOIN ranked r USING (sku_key)",
    "discover_filter_sort": IMAGES + f"SELECT seq, name FROM images WHERE {_IS_IMAGE} ORDER BY lower(name), name",
    "discover_limit": IMAGES + f"SELECT name FROM (SELECT DISTINCT name FROM images WHERE {_IS_IMAGE}) ORDER BY lower(name), name LIMIT {q.LIMIT}",
    "dedup_by_stem_priority": IMAGES + f", p AS (SELECT {stem('name')} AS stem, name, seq, CAST(CASE lower(regexp_extract(name, '\\.([^.]+)$', 1)) WHEN 'png' THEN 0 WHEN 'tif' THEN 1 WHEN 'tiff' THEN 1 WHEN 'jpg' THEN 2 WHEN 'jpeg' THEN 2 ELSE 9 END AS BIGINT) AS priority FROM images) SELECT stem, name, seq, priority FROM p QUALIFY row_number() OVER (PARTITION BY stem ORDER BY priority, seq) = 1",
    "dedup_master_sku": MAPPING + "SELECT sku_key AS sku, store_article AS article, seq FROM m QUALIFY row_number() OVER (PARTITION BY sku_key ORDER BY seq) = 1",
    "sanitize_filename": "SELECT p_partkey AS seq, " + safe("nfc_normalize(concat('_', p_name, ' ', p_brand, '  å_', p_type, 'a\u0323\u030a e\u0316\u0301x\u0301-\u212a\u0327--'))") + " AS safe FROM part",
    "safe_name_uniquify": f"""WITH s AS (SELECT DISTINCT CASE WHEN p_partkey % 50 = 0 THEN concat('ö', substring('ööööööö', 1, CAST(p_partkey % 7 AS INT))) WHEN p_partkey % 2 = 0 THEN concat(p_name, ' ', p_size) ELSE concat(p_name, '_', p_size) END AS stem FROM part),
      n AS (SELECT stem, row_number() OVER (ORDER BY stem) - 1 AS idx FROM s), p AS (SELECT *, lpad(CAST(idx AS VARCHAR), CAST(greatest(4, length(CAST(idx AS VARCHAR))) AS INTEGER), '0') AS num FROM n),
      o AS (SELECT *, coalesce(nullif({safe('stem')}, ''), 'image-' || num) AS plain FROM p)
      SELECT stem, idx, CASE WHEN row_number() OVER (PARTITION BY plain ORDER BY idx) > 1 THEN plain || '-' || num ELSE plain END AS safe FROM o""",
    "rename_longest_match": _RENAME + "SELECT seq, name, sku, new_stem FROM found",
    "rename_summary": _RENAME + f"SELECT count(*) AS files, {_n('sku IS NOT NULL')} AS matched, {_n('sku IS NULL')} AS unmatched, {_n('sku IS NULL')} AS skipped, {_n('sku IS NOT NULL')} AS copied FROM found",
    "category_rules": f"WITH {RULES} SELECT * FROM rules",
    "resolve_margins": f"WITH {RULES} SELECT name AS category, " + ", ".join(f"CASE WHEN margin_{s} < 0 THEN margin_pct ELSE margin_{s} END AS margin_{s}" for s in ("top", "bottom", "left", "right")) + " FROM rules",
    "expand_bbox": BOXES + f"SELECT id, x, y, w, h, category, {big('ex', 'ey', 'ew', 'eh')} FROM expanded",
    "resize_geometry": BOXES + f"SELECT id, category, {big('ew', 'eh', 'rw', 'rh')} FROM sized",
    "fill_ratio": f"WITH b AS ({r.duck(r.BOXES)}) SELECT id, w, h, greatest(w, h) / {float(q.CANVAS)} AS fill_ratio FROM b",
    "crop_metrics": BOXES + f"SELECT id, category, degenerate, round(fill_ratio, 6) AS fill_ratio, round(crop_area_ratio, 6) AS crop_area_ratio, {big('margin_px')} FROM measured",
    "bbox_algebra": f"WITH b AS ({r.duck(r.BOXES)}) SELECT id, x + w AS x2, y + h AS y2, w * h AS area, round(CASE WHEN h = 0 THEN 0.0 ELSE w / h END, 6) AS aspect_ratio, greatest(0, x) AS cx, greatest(0, y) AS cy, greatest(0, least(img_w, x + w) - greatest(0, x)) AS cw, greatest(0, least(img_h, y + h) - greatest(0, y)) AS ch FROM b",
    "validate_primary": validate(1.0),
    "validate_relaxed": validate(0.8),
    "fallback_dispatch": AFTER + "SELECT seq, CASE WHEN len(flags) > 0 AND component_count > 0 AND len([f FOR f IN flags IF f NOT IN ('crop_category_inconsistent', 'fill_ratio_too_low', 'fill_ratio_too_high', 'bbox_too_small')]) = 0 THEN 'reuse' WHEN list_has_any(flags, ['mask_too_small', 'no_object_found', 'mask_too_fragmented']) THEN 'remask' ELSE 'grabcut' END AS strategy FROM after",
    "route_status": AFTER + "SELECT seq, CASE WHEN category = '' THEN 'flagged' WHEN background_type IS NULL THEN 'failed' WHEN component_count > 0 AND len([f FOR f IN flags IF f <> 'naming_conflict']) = 0 THEN 'ok' WHEN fallback_attempted AND (seq % 3 = 0 OR len([f FOR f IN flags[1:1] IF f <> 'naming_conflict']) = 0) THEN 'recovered' ELSE 'flagged' END AS status FROM after",
    "merge_flags": DIFF + f"SELECT name, array_to_string(CASE WHEN after_status IN {GOOD} THEN before_flags ELSE list_concat(before_flags, [f FOR f IN after_flags IF NOT list_contains(before_flags, f)]) END, ',') AS flags FROM both_runs",
    "flag_sets": DIFF + "SELECT name, array_to_string([f FOR f IN after_flags IF NOT list_contains(before_flags, f)], ',') AS added, array_to_string([f FOR f IN before_flags IF list_contains(after_flags, f)], ',') AS kept, list_has_any(before_flags, after_flags) AS overlap, len([f FOR f IN before_flags IF NOT list_contains(after_flags, f)]) = 0 AS subset FROM both_runs",
    "naming_collision": LOOKUP + ", wr AS (SELECT r.store_article || '_' || r.suffix || '.jpg' AS output_name, k.seq, r.row_idx, k.seq % 9 <> 0 AS has_image FROM keyed k JOIN ranked r USING (sku_key)), disk AS (SELECT DISTINCT concat('ART', p_partkey % 1500, '_front.jpg') AS output_name FROM part WHERE p_partkey % 12 = 0) SELECT *, has_image AND (row_number() OVER (PARTITION BY output_name, has_image ORDER BY seq, row_idx) > 1 OR output_name IN (SELECT output_name FROM disk)) AS conflict FROM wr",
    "resume_filter": IMAGES + f"SELECT name FROM (SELECT name FROM (SELECT DISTINCT name FROM images WHERE {_IS_IMAGE}) ORDER BY lower(name), name LIMIT 400) WHERE name NOT IN (SELECT name FROM images WHERE seq % 3 = 1)",
    "incremental_filter": incremental("1993-06-01 00:00:00", "'-'"),
    "force_category": incremental("", "'BALL', 'SHOE'"),
    "quality_gate_final": GATE + "SELECT category, total, good, round(rate, 4) AS rate FROM breaches",
    "quality_gate_running": RUNNING + "SELECT CAST(tick AS BIGINT) AS tick, category, total, good, round(rate, 4) AS rate, breach FROM checked",
    "quality_gate_abort_prefix": RUNNING + f"SELECT seq, name, rn FROM n WHERE rn <= coalesce((SELECT min(tick) FROM checked WHERE breach) * {q.GATE.check_interval}, rn)",
    "quality_gate_top_flags": GATE + ", e AS (SELECT cat AS category, unnest(flags) AS flag, seq, generate_subscripts(flags, 1) AS pos FROM g WHERE NOT good AND cat IN (SELECT category FROM breaches)), c AS (SELECT category, flag, count(*) AS n, min(seq * 100 + pos) AS met FROM e GROUP BY category, flag) SELECT category, flag, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, met) AS rank FROM c) WHERE rank <= 3",
    "contact_match": SHEET + "SELECT name, file AS matched FROM matched",
    "contact_header": SHEET + "SELECT category, n, ok FROM heads",
    "contact_border": SHEET + "SELECT category, file, name, CASE WHEN status = 'recovered' THEN 'green' WHEN status IN ('flagged', 'failed') OR len(flags) > 0 THEN 'red' ELSE 'gray' END AS border FROM entries",
    "contact_uncategorised": SHEET + "SELECT file FROM entries WHERE category = 'UNCATEGORIZED'",
    "contact_layout": SHEET + ", tops AS (SELECT category, 32 + coalesce(sum(28 + ceil(n / 20) * 104) OVER (ORDER BY category ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS top FROM heads), i AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY name, file) - 1 AS i FROM entries) SELECT i.category, file, name, CAST(4 + i % 20 * 104 AS BIGINT) AS x, CAST(top + i // 20 * 104 AS BIGINT) AS y FROM i JOIN tops USING (category)",
    "file_hash": "SELECT event_id, sha256(props) AS sha256 FROM events",
    "quota_remaining": _USED + "SELECT customer, quota, CAST(used AS BIGINT) AS used, CAST(quota - used AS BIGINT) AS remaining FROM p",
    "invoice_overage": _USED + "SELECT customer, CAST(greatest(0, used - quota) AS BIGINT) AS over, CAST(CAST(base + CAST(greatest(0, used - quota) AS DECIMAL(10,0)) * overage AS DECIMAL(10,2)) AS DOUBLE) AS total FROM p",
    "quota_warnings": _USED + "SELECT customer, CASE WHEN used / quota >= 0.95 THEN 'critical' WHEN used / quota >= 0.8 THEN 'warning' ELSE 'none' END AS level FROM p",
    "usage_by_month": f"SELECT strftime(used_at, '%Y-%m') AS month, CAST(sum(images) AS BIGINT) AS images, count(*) AS jobs FROM ({r.duck(usage.USAGE)}) GROUP BY 1",
    "dashboard_totals": f"SELECT CAST(sum(images) AS BIGINT) AS images, count(*) AS jobs, count(DISTINCT customer) AS customers FROM ({r.duck(usage.USAGE)})",
    "dashboard_top_customers": f"SELECT customer, CAST(sum(images) AS BIGINT) AS images FROM ({r.duck(usage.USAGE)}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "job_counters": _JOBS + "SELECT * FROM n",
    "job_lifecycle": _JOBS + "SELECT job, CASE WHEN processed < 60 THEN 'processing' WHEN flagged > 0 THEN 'reviewing' ELSE 'complete' END AS state FROM n",
    "usage_7day": _JOBS + "SELECT strftime(w, '%Y-%m-%d') AS week, count(*) AS n, round(count(*) FILTER (WHERE good) / count(*), 4) AS success_rate FROM (SELECT *, time_bucket(INTERVAL 7 DAYS, ts, TIMESTAMP '1970-01-01') AS w FROM j) GROUP BY w",
    "usage_event_report": _JOBS + "SELECT job, category, count(*) AS n FROM j GROUP BY 1, 2",
}
