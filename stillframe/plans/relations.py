"""Relations like those of a run, derived from the test tables by SQL that Spark and DuckDB both take.

``{name}`` is a table. ``flags(...)`` is written for each engine by ``sql``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..config import KNOWN

CATEGORIES = (*KNOWN, "")
_CATEGORY = "CASE {key} % 10 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CATEGORIES)) + " END"

MAPPING = """
SELECT CAST(p_partkey AS BIGINT) AS seq,
  CASE WHEN p_partkey % 97 = 0 THEN '   ' WHEN p_partkey % 5 = 0 THEN concat('  sku', p_partkey, ' ') ELSE concat('SKU', p_partkey - p_partkey % 2) END AS supplier_sku,
  CASE WHEN p_partkey % 89 = 0 THEN '' WHEN p_partkey % 83 = 0 THEN concat('ART/', p_partkey) ELSE concat('ART', p_partkey % 1500) END AS store_article,
  CASE p_partkey % 4 WHEN 0 THEN 'front' WHEN 1 THEN 'side' WHEN 2 THEN 'bäck' ELSE CASE WHEN p_partkey % 7 = 0 THEN 'fr ont' ELSE 'top' END END AS suffix,
  """ + _CATEGORY.format(key="p_partkey") + """ AS category
FROM {part}"""

IMAGES = """
SELECT CAST(o_orderkey AS BIGINT) AS seq, o_orderdate AS mtime,
  concat(CASE WHEN o_orderkey % 2 = 0 THEN 'SKU' ELSE 'sku' END, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 700 ELSE o_orderkey END,
    CASE o_orderkey % 5 WHEN 0 THEN '.png' WHEN 1 THEN '.TIF' WHEN 2 THEN '.jpg' WHEN 3 THEN '.jpeg' ELSE '.txt' END) AS name
FROM {orders}"""

OUTPUTS = """
SELECT DISTINCT CASE o_orderkey % 4 WHEN 0 THEN concat('SKU', o_orderkey, '-cropped.jpg') WHEN 1 THEN concat('IMG', o_orderkey, '-cropped.png')
    WHEN 2 THEN concat('IMG', o_orderkey) ELSE concat('img', o_orderkey, 'x.JPG') END AS output_name, o_orderdate AS output_mtime
FROM {orders}"""

_RESULTS = """
SELECT CAST(event_id AS BIGINT) AS seq, concat('IMG', event_id) AS name,
  CASE WHEN event_id % 23 = 0 THEN '' ELSE event_type END AS category,
  CASE WHEN (user_id * MULT + event_id * STEP) % 20 < 11 THEN 'ok' WHEN (user_id * MULT + event_id * STEP) % 20 < 13 THEN 'recovered' WHEN (user_id * MULT + event_id * STEP) % 20 < 18 THEN 'flagged' ELSE 'failed' END AS status,
  flags((event_id * STEP + user_id) % 5 = 0: mask_too_small, (event_id + user_id * MULT) % 4 = 0: fill_ratio_too_low, (event_id + MULT) % 6 = 0: naming_conflict, (event_id * STEP) % 17 = 0: missing_mapping, user_id % 6 = 0: unheard_of) AS flags,
  CAST((event_id * STEP) % 101 AS DOUBLE) / 100 AS fill_ratio, CAST((event_id * STEP) % 89 AS DOUBLE) / 88 AS crop_area_ratio,
  CAST(event_id % 4 AS INT) AS component_count, (event_id * STEP) % 7 < 2 AS fallback_attempted,
  CASE (event_id + user_id) % 4 WHEN 0 THEN 'transparent' WHEN 1 THEN 'white_bg' WHEN 2 THEN 'complex_bg' END AS background_type,
  CAST(event_id % 997 AS DOUBLE) / 100 AS processing_time_s, CAST((event_id * STEP) % 311 AS DOUBLE) / 100 AS crop_time_s, CAST(event_id % 53 AS DOUBLE) / 100 AS fallback_time_s
FROM {events} WHERE event_id % LEFT_OUT <> 0"""

BEFORE = _RESULTS.replace("MULT", "7").replace("STEP", "1").replace("LEFT_OUT", "11")
AFTER = _RESULTS.replace("MULT", "11").replace("STEP", "3").replace("LEFT_OUT", "13")

BOXES = """
SELECT CAST(l_orderkey AS BIGINT) AS id, CAST(l_partkey % 300 AS BIGINT) AS x, CAST((l_suppkey * 7) % 200 AS BIGINT) AS y,
  CAST(l_orderkey % 350 + 1 AS BIGINT) AS w, CAST((l_orderkey * 3 + l_linenumber * 5) % 350 + 1 AS BIGINT) AS h,
  CAST(400 + l_partkey % 200 AS BIGINT) AS img_w, CAST(400 + l_suppkey % 100 AS BIGINT) AS img_h,
  CAST((l_orderkey % 350 + 1) * ((l_orderkey * 3 + l_linenumber * 5) % 350 + 1) * (l_partkey % 10 + 1) AS BIGINT) AS tenfold,
  """ + _CATEGORY.format(key="l_suppkey") + """ AS category
FROM {lineitem}"""

#: A small grid of pixels, one row each; white but for a rectangle.
PIXELS = """
SELECT CAST(a.n_nationkey AS BIGINT) AS x, CAST(b.n_nationkey AS BIGINT) AS y,
  CASE WHEN a.n_nationkey BETWEEN 5 AND 14 AND b.n_nationkey BETWEEN 8 AND 19 THEN 40 ELSE 255 END AS value
FROM {nation} a JOIN {nation} b ON a.n_nationkey * 0 = b.n_nationkey * 0"""

SIDE = 32
#: Pictures of SIDE x SIDE pixels, one for each part: three rectangles of one colour on white, some see-through but for these.
PICTURES = """
SELECT CAST(p_partkey AS BIGINT) AS part, p_partkey % 3 = 0 AS see_through,
  CAST(CASE WHEN p_partkey % 4 = 0 THEN 225 + p_size % 31 ELSE (p_size * 5 + p_partkey) % 256 END AS BIGINT) AS red,
  CAST(CASE WHEN p_partkey % 4 = 0 THEN 225 + (p_size + p_partkey) % 31 ELSE (p_size * 3 + length(p_name)) % 256 END AS BIGINT) AS green,
  CAST(CASE WHEN p_partkey % 4 = 0 THEN 240 ELSE (p_partkey * 11) % 256 END AS BIGINT) AS blue,
  CAST(2 + p_size % 14 AS BIGINT) AS x1, CAST(1 + (p_partkey * 7) % 17 AS BIGINT) AS y1, CAST(1 + (p_partkey + p_size) % 9 AS BIGINT) AS w1, CAST(1 + (p_size * 3) % 10 AS BIGINT) AS h1,
  CAST((p_partkey * 5) % 22 AS BIGINT) AS x2, CAST((p_size * 7) % 20 AS BIGINT) AS y2, CAST(1 + p_size % 8 AS BIGINT) AS w2, CAST(1 + p_partkey % 11 AS BIGINT) AS h2,
  CAST(3 + (p_partkey * 13 + p_size) % 24 AS BIGINT) AS x3, CAST((p_partkey * 3) % 26 AS BIGINT) AS y3, CAST(1 + (p_partkey * 3) % 5 AS BIGINT) AS w3, CAST(1 + length(p_type) % 6 AS BIGINT) AS h3
FROM {part}"""

#: One see-through picture of 64 x 64 pixels for each part, opaque in a rectangle that is no nearer than 5 pixels to an edge.
OBJECTS = """
SELECT CAST(p_partkey AS BIGINT) AS id, CAST(5 + p_partkey % 17 AS BIGINT) AS x, CAST(5 + p_size % 19 AS BIGINT) AS y,
  CAST(5 + (p_partkey * 7 + p_size) % 33 AS BIGINT) AS w, CAST(5 + (p_size * 3 + length(p_name)) % 31 AS BIGINT) AS h,
  """ + _CATEGORY.format(key="p_partkey") + """ AS category
FROM {part}"""


def _flags(text: str, duck: bool) -> str:
    def write(m: re.Match) -> str:
        # conditions hold parentheses, so parts are split where a name ends
        parts = re.findall(r"(.+?): (\w+)(?:, |$)", m[1])
        cases = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in parts)
        return f"[f FOR f IN [{cases}] IF f IS NOT NULL]" if duck else f"array_compact(array({cases}))"

    return re.sub(r"flags\((.*)\) AS flags", lambda m: write(m) + " AS flags", text)


def duck(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", _flags(text, True))


def spark(session: SparkSession, sf_dir: str, text: str) -> DataFrame:
    tables = {t: session.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", text))}
    return session.sql(_flags(text, False), **tables)


def ctes(*names: str) -> str:
    """A WITH clause of the relations, for DuckDB."""
    return "WITH " + ", ".join(f"{n} AS ({duck(globals()[n.upper()])})" for n in names)
