"""Checks of a crop against its category, from its measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import GlobalRules
from ..functions.flags import collected, new_only


def rules_of(g: GlobalRules, t: float, edge_distance: str | None = "edge_distance") -> dict[str, Column]:
    """Each flag's condition for rows with mask_pixels, x, y, w, h, img_w, img_h, fill_ratio and r; ``t`` below 1 relaxes.

    edge_distance is how far the object on the canvas is from its border; null
    without a final image. The largest box allowed is not relaxed.
    """
    area = F.greatest(F.lit(1), F.col("img_w") * F.col("img_h"))
    own = lambda c, other: F.when(F.col(f"r.{c}") > 0, F.col(f"r.{c}")).otherwise(F.lit(other)) * t
    box = F.col("w") * F.col("h") / area
    aspect = F.greatest("w", "h") / F.greatest(F.lit(1), F.least("w", "h"))
    fill, near = F.col("fill_ratio"), F.col("r.edge_proximity_px")
    has_box = F.col("w").isNotNull()
    out = {
        "mask_too_small": F.col("mask_pixels") / area < own("min_object_ratio", g.min_object_ratio),
        "bbox_too_large": has_box & (box > g.max_bbox_ratio),
        "bbox_too_small": has_box & (box < own("min_bbox_ratio", g.min_bbox_ratio)),
        "crop_category_inconsistent": (F.col("w") > 0) & (F.col("h") > 0) & ((aspect < F.col("r.expected_aspect_ratio_min") * t) | (aspect > F.col("r.expected_aspect_ratio_max") / t)),
        "fill_ratio_too_low": (fill > 0) & (fill < F.col("r.target_fill_ratio_min") * t),
        "fill_ratio_too_high": (fill > 0) & (fill > F.least(F.lit(1.0), F.col("r.target_fill_ratio_max") / t)),
    }
    if edge_distance:
        out["object_too_close_to_edge"] = (near > 0) & (F.col(edge_distance) < F.greatest(F.lit(1), (near * t).cast("long")))
    return out


def validated(df: DataFrame, g: GlobalRules, t: float = 1.0, already: str | None = None, edge_distance: str | None = None) -> DataFrame:
    """``df`` with new_flags in the order of the rules, without those it has."""
    found = collected(rules_of(g, t, edge_distance))
    return df.withColumn("new_flags", new_only(found, F.col(already)) if already else F.array_distinct(found))
