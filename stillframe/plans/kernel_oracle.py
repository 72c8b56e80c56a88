"""What the pixel kernels give for drawn pictures, in DuckDB's SQL: a row of pixels is a number with one bit for each."""

from __future__ import annotations

from ..config import KNOWN, GlobalRules
from . import kernel_queries as k
from . import relations as r
from .oracle import boxes, checks

G = GlobalRules()
ALL = (1 << r.SIDE) - 1
_bits = "((CAST(1 AS BIGINT) << CAST({w} AS INT)) - 1) << CAST({x} AS INT)"
_rects = " UNION ALL ".join(f"SELECT part, {i} AS k, x{i} AS x, y{i} AS y, w{i} AS w, h{i} AS h FROM p" for i in (1, 2, 3))
DRAWN = f"""WITH RECURSIVE p AS ({r.duck(r.PICTURES)}), rects AS ({_rects}),
m0 AS (SELECT p.*, t.y, {" | ".join(f"CASE WHEN t.y >= y{i} AND t.y < y{i} + h{i} THEN {_bits.format(w=f'w{i}', x=f'x{i}')} ELSE 0 END" for i in (1, 2, 3))} AS m FROM p, range({r.SIDE}) t(y))"""


def dilated(source: str, name: str, halves: dict[int, int]) -> str:
    """Rows of a mask spread by a kernel with these half widths by row."""
    terms = []
    for dy, half in halves.items():
        row = "m" if not dy else f"coalesce(lag(m, {dy}) OVER w, 0)" if dy > 0 else f"coalesce(lead(m, {-dy}) OVER w, 0)"
        terms += [row] + [f"({row} {way} {d})" for d in range(1, half + 1) for way in ("<<", ">>")]
    return f", {name} AS (SELECT part, y, ({' | '.join(terms)}) & {ALL} AS m FROM {source} WINDOW w AS (PARTITION BY part ORDER BY y))"


def eroded(source: str, name: str, halves: dict[int, int]) -> str:
    turned = f", {name}_o AS (SELECT part, y, {ALL} - m AS m FROM {source})"
    return turned + dilated(f"{name}_o", f"{name}_d", halves) + f", {name} AS (SELECT part, y, {ALL} - m AS m FROM {name}_d)"


def steps(source: str, ways: str, halves: dict[int, int]) -> str:
    """Dilations (d) and erosions (e) one after the other; the last one is ``source_ways``."""
    out = ""
    for i, way in enumerate(ways):
        out += (dilated if way == "d" else eroded)(source if not i else f"{source}_{ways[:i]}_{len(halves)}", f"{source}_{ways[: i + 1]}_{len(halves)}", halves)
    return out


#: Half widths of the ellipses of three and five rows.
THREE, FIVE = {-1: 0, 0: 1, 1: 0}, {-2: 0, -1: 2, 0: 2, 1: 2, 2: 0}

_lin = "CASE WHEN {0} / 255.0 <= 0.04045 THEN {0} / 255.0 / 12.92 ELSE pow(({0} / 255.0 + 0.055) / 1.055, 2.4) END"
_f = "CASE WHEN {0} > 0.008856 THEN cbrt({0}) ELSE 7.787 * {0} + 16.0 / 116 END"
_eight = "greatest(0, least(255, round_even({0}, 0)))"
LAB = f""", linear AS (SELECT part, CAST({_lin.format("red")} AS DOUBLE) AS lr, CAST({_lin.format("green")} AS DOUBLE) AS lg, CAST({_lin.format("blue")} AS DOUBLE) AS lb FROM p),
xyz AS (SELECT part, (0.412453 * lr + 0.357580 * lg + 0.180423 * lb) / 0.950456 AS tx, 0.212671 * lr + 0.715160 * lg + 0.072169 * lb AS ty, (0.019334 * lr + 0.119193 * lg + 0.950227 * lb) / 1.088754 AS tz FROM linear),
fs AS (SELECT part, {_f.format("tx")} AS fx, {_f.format("ty")} AS fy, {_f.format("tz")} AS fz, ty FROM xyz),
lab AS (SELECT part, {_eight.format("CASE WHEN ty > 0.008856 THEN 116 * fy - 16 ELSE 903.3 * ty END * 2.55")} AS l, {_eight.format("500 * (fx - fy) + 128")} AS a, {_eight.format("200 * (fy - fz) + 128")} AS b FROM fs),
away AS (SELECT part, sqrt(pow(0.5 * (l - 255), 2) + pow(a - 128, 2) + pow(b - 128, 2)) AS away FROM lab)"""

_STRIP, _EDGE = 5, r.SIDE - 5
_border = f"bit_count(m) * (CAST(y < {_STRIP} AS INT) + CAST(y >= {_EDGE} AS INT)) + bit_count(m & {(1 << _STRIP) - 1}) + bit_count(m & {((1 << _STRIP) - 1) << _EDGE})"
MASKS = DRAWN + LAB + f""", n AS (SELECT part, any_value(see_through) AS see_through, CAST(sum(bit_count(m)) AS BIGINT) AS px, sum({_border}) AS border FROM m0 GROUP BY part),
kinds AS (SELECT *, CASE WHEN see_through AND px > 0 AND {r.SIDE**2} - px > {0.01 * r.SIDE**2} THEN 'transparent'
  WHEN ({4 * _STRIP * r.SIDE} - CASE WHEN away < {G.white_distance_threshold} THEN 0 ELSE border END) / {4 * _STRIP * r.SIDE} >= {G.edge_whiteness_threshold} THEN 'white_bg' ELSE 'complex_bg' END AS background FROM n JOIN away USING (part))
SELECT part, background, CASE background WHEN 'transparent' THEN px WHEN 'white_bg' THEN CASE WHEN away > {max(1.0, G.white_distance_threshold + KNOWN["CLUB_LONG"].threshold_bias)} THEN px ELSE 0 END END AS pixels,
  CASE WHEN away > 12.0 THEN px ELSE 0 END AS off_white, CASE WHEN see_through THEN px END AS opaque FROM kinds"""

_SHAPES = {"pixels": "m0", "dilated": "m0_d_5", "eroded": "m0_e_3", "cleaned": "m0_ddeeed_5", "thin_kept": "m0_ddee_3"}
MORPHOLOGY = (
    DRAWN + steps("m0", "ddeeed", FIVE) + steps("m0", "ddee", THREE) + eroded("m0", "m0_e_3", THREE)
    + "".join(f", n_{n} AS (SELECT part, CAST(sum(bit_count(m)) AS BIGINT) AS {n} FROM {t} GROUP BY part)" for n, t in _SHAPES.items())
    + f" SELECT part, {', '.join(_SHAPES)} FROM n_pixels " + " ".join(f"JOIN n_{n} USING (part)" for n in list(_SHAPES)[1:])
)

COMPONENTS = DRAWN + f""", reach AS (SELECT part, k, k AS j, x, y, w, h FROM rects
  UNION SELECT a.part, a.k, b.k, b.x, b.y, b.w, b.h FROM reach a JOIN rects b ON a.part = b.part AND a.x <= b.x + b.w AND b.x <= a.x + a.w AND a.y <= b.y + b.h AND b.y <= a.y + a.h),
named AS (SELECT part, k, min(j) AS c FROM reach GROUP BY ALL), own AS (SELECT * FROM rects JOIN named USING (part, k)),
lines AS (SELECT part, c, t.y, bit_or({_bits.format(w="w", x="x")}) AS m FROM own, range({r.SIDE}) t(y) WHERE t.y >= own.y AND t.y < own.y + h GROUP BY ALL),
sizes AS (SELECT part, c, CAST(sum(bit_count(m)) AS BIGINT) AS area, min(y) AS top, arg_min(m & -m, y) AS first FROM lines GROUP BY ALL),
largest AS (SELECT *, count(*) FILTER (WHERE area >= {k.LEAST}) OVER (PARTITION BY part) AS parts FROM sizes QUALIFY row_number() OVER (PARTITION BY part ORDER BY area DESC, top, first) = 1),
boxes AS (SELECT part, c, min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h FROM own GROUP BY ALL)
SELECT part, parts, CASE WHEN parts > 0 THEN area ELSE 0 END AS pixels, {", ".join(f"CASE WHEN parts > 0 THEN {v} ELSE 0 END AS {v}" for v in "xywh")}, parts > 0 AND greatest(w, h) / least(w, h) > 3.0 AS thin FROM largest JOIN boxes USING (part, c)"""

def everywhere(side: int, c: int) -> int:
    """Sum of 1 + channel + 3 x + 7 y over a square."""
    return side * side * (1 + c) + 10 * side * (side * (side - 1) // 2)


_region = "(nw * nh * (1 + {c}) + 3 * nh * (nw * ox + nw * (nw - 1) // 2) + 7 * nw * (nh * oy + nh * (nh - 1) // 2))"
_place = "greatest(0, least({free}, {free} // 2 + {bias}))"
CANVAS = f"""WITH p AS ({r.duck(r.PICTURES)}), s0 AS (SELECT *, CASE WHEN part % 2 = 1 THEN 0.9 ELSE 0.5 END AS fill, CAST(greatest(w1, h1) AS DOUBLE) AS longest FROM p),
s1 AS (SELECT *, least(trunc({k.CANVAS} * fill) / w1, trunc({k.CANVAS} * fill) / h1) AS sc FROM s0),
s2 AS (SELECT *, CASE WHEN sc > 1 AND fill < 0.8 THEN least(1.0, {k.CANVAS} / longest) ELSE sc END AS scale, least(30 / longest, {k.CANVAS} / longest) AS up FROM s1),
s3 AS (SELECT *, greatest(1, trunc(w1 * scale)) AS fw, greatest(1, trunc(h1 * scale)) AS fh FROM s2),
s4 AS (SELECT *, CAST(CASE WHEN greatest(fw, fh) < 30 THEN greatest(1, trunc(w1 * up)) ELSE fw END AS BIGINT) AS nw, CAST(CASE WHEN greatest(fw, fh) < 30 THEN greatest(1, trunc(h1 * up)) ELSE fh END AS BIGINT) AS nh FROM s3),
s5 AS (SELECT *, {_place.format(free=f"({k.CANVAS} - nw)", bias=k.CANVAS // 20)} AS ox, {_place.format(free=f"({k.CANVAS} - nh)", bias=-k.CANVAS // 10)} AS oy FROM s4)
SELECT part, nw AS w, nh AS h, CAST({" + ".join(f"255 * {everywhere(k.CANVAS, c)} + ({v} - 255) * {_region.format(c=c)}" for c, v in enumerate(("red", "green", "blue")))} AS BIGINT) AS weighed FROM s5"""

ENCODE = DRAWN + f""", pixels AS (SELECT part, y, t.x FROM m0, range({r.SIDE}) t(x) WHERE (m >> CAST(t.x AS INT)) & 1 = 1),
sums AS (SELECT part, count(*) AS n, sum(3 * x + 7 * y) AS places FROM pixels GROUP BY part),
all_of AS (SELECT part, CAST({" + ".join(f"255 * {everywhere(r.SIDE, c)} + ({v} - 255) * ({1 + c} * n + places)" for c, v in enumerate(("red", "green", "blue")))} + CASE WHEN see_through THEN 255 * (4 * n + places) ELSE 0 END AS BIGINT) AS v FROM p JOIN sums USING (part))
SELECT part, v AS png, v AS tiff, CAST({r.SIDE} AS BIGINT) AS jpg_height, CAST({r.SIDE} AS BIGINT) AS jpg_width FROM all_of"""

_parts = "greatest(0, least(255, floor(CAST(embedding[i] AS DOUBLE) * 128) + 128))"
LAB_DISTANCE = f"""WITH v AS (SELECT vec_id, (i - 1) // 3 AS pixel, CASE (i - 1) % 3 WHEN 0 THEN pow({_parts} - 255, 2) ELSE 4 * pow({_parts} - 128, 2) END AS q FROM embeddings, range(1, 64) t(i)),
d AS (SELECT vec_id, pixel, sum(q) AS q FROM v GROUP BY ALL)
SELECT vec_id, CAST(sum(q) AS BIGINT) AS quarters, count(*) FILTER (WHERE q > 4 * 144) AS off_white FROM d GROUP BY vec_id"""

#: Opening by an ellipse of five rows takes two pixels from each corner of a rectangle; thin things are not opened.
_OBJECTS = f"SELECT *, 64 AS img_w, 64 AS img_h, w * h - CASE WHEN category = 'CLUB_LONG' THEN 0 ELSE 8 END AS px, 4000 * px AS tenfold FROM ({r.duck(r.OBJECTS)})"
_found = lambda names: ", ".join(f"CASE WHEN found THEN CAST({n} AS BIGINT) END AS {n}" for n in names)
PRIMARY = boxes(_OBJECTS, k.CANVAS) + f""", seen AS (SELECT *, px >= min_component_size AS found FROM measured)
SELECT id, category, CASE WHEN found THEN coalesce(array_to_string({checks(1.0, None)}, ','), '') ELSE 'mask_too_fragmented,no_object_found,mask_too_small' END AS flags, {_found(("ex", "ey", "ew", "eh"))},
  CASE WHEN found THEN px END AS pixels, CASE WHEN found THEN round(fill_ratio, 6) END AS fill_ratio, CASE WHEN found THEN CAST(round(crop_area_ratio * 64 * 64) AS BIGINT) END AS crop_px, {_found(["margin_px"])} FROM seen"""

ORACLE = {
    "kernel_primary": PRIMARY,
    "kernel_masks": MASKS,
    "kernel_morphology": MORPHOLOGY,
    "kernel_components": COMPONENTS,
    "kernel_canvas": CANVAS,
    "kernel_encode": ENCODE,
    "lab_distance_vectors": LAB_DISTANCE,
    "pixel_table_bbox": r.ctes("pixels") + "SELECT min(x) AS x, min(y) AS y, max(x) - min(x) + 1 AS w, max(y) - min(y) + 1 AS h, count(*) AS pixels FROM pixels WHERE value < 200",
    "pixel_table_border_white": r.ctes("pixels") + ", e AS (SELECT max(x) AS mx, max(y) AS my FROM pixels), s AS (SELECT value, CAST(x < 5 AS INT) + CAST(x > mx - 5 AS INT) + CAST(y < 5 AS INT) + CAST(y > my - 5 AS INT) AS n FROM pixels, e) SELECT CAST(sum(n) AS BIGINT) AS border, CAST(sum(CASE WHEN value > 250 THEN n ELSE 0 END) AS BIGINT) AS white FROM s",
}
