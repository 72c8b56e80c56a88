"""Crop geometry as column expressions: margins, boxes, sizes and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Rules, category_table

SIDES = ("top", "bottom", "left", "right")


def truncated(c: Column) -> Column:
    """Toward zero."""
    return c.cast("long")


def with_rules(df: DataFrame, rules: Rules | None = None) -> DataFrame:
    """Each row with its category's rules, or the generic ones, as struct r; the rules are a few dozen rows at most."""
    table = category_table(df.sparkSession, rules)
    names = [n["name"] for n in table.select("name").collect()]
    r = table.select(F.col("name").alias("__category"), F.struct(*table.columns).alias("r"))
    own = F.when(F.col("category").isin(*names), F.col("category")).otherwise(F.lit(""))
    return df.withColumn("__category", own).join(F.broadcast(r), "__category").drop("__category")


def margins() -> dict[str, Column]:
    """Share of each side, margin_pct where a side has none."""
    return {s: F.when(F.col(f"r.margin_{s}") < 0, F.col("r.margin_pct")).otherwise(F.col(f"r.margin_{s}")) for s in SIDES}


def expanded(df: DataFrame) -> DataFrame:
    """``x, y, w, h`` in an image of ``img_w, img_h`` widened by the margins, within the image, as ex, ey, ew, eh.

    Thin objects (sides over 3 to 1) of protected categories get half as much
    again on their narrow axis, and that axis at least a quarter of the long one.
    """
    m = margins()
    by_object = F.col("r.margin_mode") == "object"
    longest = F.greatest("img_w", "img_h")
    ref = {"top": "h", "bottom": "h", "left": "w", "right": "w"}
    d = df.withColumns({f"m_{s}": truncated(F.when(by_object, F.col(ref[s])).otherwise(longest) * m[s]) for s in SIDES})
    long, short = F.greatest("w", "h"), F.least("w", "h")
    d = d.withColumn("thin", F.col("r.thin_object_protection") & (short > 0) & (long / F.greatest(short, F.lit(1)) > 3.0))
    upright = F.col("w") < F.col("h")
    wide = {"left": upright, "right": upright, "top": ~upright, "bottom": ~upright}
    d = d.withColumns({f"m_{s}": F.when(F.col("thin") & wide[s], truncated(F.col(f"m_{s}") * 1.5)).otherwise(F.col(f"m_{s}")) for s in SIDES})
    d = d.withColumns({"x1": F.col("x") - F.col("m_left"), "y1": F.col("y") - F.col("m_top"), "w1": F.col("w") + F.col("m_left") + F.col("m_right"), "h1": F.col("h") + F.col("m_top") + F.col("m_bottom")})
    least = F.floor(long / 4)
    grow_w = F.when(F.col("thin") & (F.col("w1") < least), F.floor((least - F.col("w1")) / 2)).otherwise(0)
    grow_h = F.when(F.col("thin") & (F.col("w1") >= least) & (F.col("h1") < least), F.floor((least - F.col("h1")) / 2)).otherwise(0)
    d = d.withColumns({"gw": grow_w, "gh": grow_h})
    d = d.withColumns({"ex": F.greatest(F.lit(0), F.col("x1") - F.col("gw")), "ey": F.greatest(F.lit(0), F.col("y1") - F.col("gh"))})
    x2, y2 = F.least(F.col("img_w"), F.col("x1") + F.col("w1") + F.col("gw")), F.least(F.col("img_h"), F.col("y1") + F.col("h1") + F.col("gh"))
    d = d.withColumns({"ew": F.greatest(F.lit(0), x2 - F.col("ex")), "eh": F.greatest(F.lit(0), y2 - F.col("ey"))})
    return d.drop("x1", "y1", "w1", "h1", "gw", "gh", "thin", *[f"m_{s}" for s in SIDES])


def resized(df: DataFrame, canvas: int, w: str = "ew", h: str = "eh") -> DataFrame:
    """Size rw, rh after fitting into the category's share of the canvas; small images grow only where that share is 0.8 or more, or to the least output size."""
    fill = F.col("r.target_fill_ratio_max")
    sides = {"w": F.greatest(F.lit(1), F.col(w)), "h": F.greatest(F.lit(1), F.col(h))}
    longest = F.greatest(F.lit(1), F.greatest(w, h))
    target = truncated(canvas * fill)
    scale = F.least(target / sides["w"], target / sides["h"])
    scale = F.when((scale > 1) & (fill < 0.8), F.least(F.lit(1.0), canvas / longest)).otherwise(scale)
    d = df.withColumn("scale", scale)
    size = lambda by: [F.greatest(F.lit(1), truncated(F.col(c) * by)) for c in (w, h)]
    nw, nh = size(F.col("scale"))
    least = F.col("r.min_output_px")
    up = F.least(least / longest, canvas / longest)
    uw, uh = size(up)
    small = (least > 0) & (F.greatest(nw, nh) < least)
    return d.withColumns({"rw": F.when(small, uw).otherwise(nw), "rh": F.when(small, uh).otherwise(nh)}).drop("scale")


def fill_ratio(w: Column, h: Column, canvas: int) -> Column:
    return F.greatest(w, h) / F.lit(float(canvas)) if canvas > 0 else F.lit(0.0)


def metrics(df: DataFrame, canvas: int) -> DataFrame:
    """fill_ratio, crop_area_ratio and margin_px of expanded and resized rows; degenerate is an empty crop."""
    sides = [F.col("x") - F.col("ex"), F.col("y") - F.col("ey"), F.col("ex") + F.col("ew") - F.col("x") - F.col("w"), F.col("ey") + F.col("eh") - F.col("y") - F.col("h")]
    return df.withColumns({
        "degenerate": (F.col("ew") < 1) | (F.col("eh") < 1),
        "fill_ratio": fill_ratio(F.col("rw"), F.col("rh"), canvas),
        "crop_area_ratio": F.col("ew") * F.col("eh") / F.greatest(F.lit(1), F.col("img_w") * F.col("img_h")),
        "margin_px": F.greatest(*sides, F.lit(0)),
    })


def box_algebra(df: DataFrame) -> DataFrame:
    """Right and lower edge, area, aspect ratio (0 without height) and the box within its image."""
    x, y = F.greatest(F.lit(0), F.col("x")), F.greatest(F.lit(0), F.col("y"))
    x2, y2 = F.col("x") + F.col("w"), F.col("y") + F.col("h")
    return df.withColumns({
        "x2": x2, "y2": y2, "area": F.col("w") * F.col("h"), "aspect_ratio": F.when(F.col("h") == 0, 0.0).otherwise(F.col("w") / F.col("h")),
        "cx": x, "cy": y, "cw": F.greatest(F.lit(0), F.least(F.col("img_w"), x2) - x), "ch": F.greatest(F.lit(0), F.least(F.col("img_h"), y2) - y),
    })
