"""Statuses and ordered, duplicate-free flag arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import FAILED, FLAG_DESCRIPTIONS, FLAGGED, GOOD, OK, RECOVERED


def is_good(status: Column) -> Column:
    return status.isin(*GOOD)


def category_or_unknown(category: Column) -> Column:
    return F.when(F.coalesce(category, F.lit("")) == "", F.lit("UNKNOWN")).otherwise(category)


def described(flags: Column) -> Column:
    """Flags as descriptions; an unknown flag is its own."""
    known = F.create_map(*[F.lit(x) for kv in FLAG_DESCRIPTIONS.items() for x in kv])
    return F.transform(flags, lambda f: F.coalesce(F.try_element_at(known, f), f))


def collected(rules: dict[str, Column]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))


def blocking(flags: Column) -> Column:
    """Flags that keep an image back: all but a naming conflict."""
    return F.array_remove(flags, "naming_conflict")


def new_only(flags: Column, already: Column) -> Column:
    return F.array_except(F.array_distinct(flags), already)


def merged(status: Column, primary: Column, fallback: Column) -> Column:
    """Kept images keep the primary flags; flagged ones get the new ones of the fallback after them."""
    return F.when(is_good(status), primary).otherwise(F.array_distinct(F.concat(primary, fallback)))


def routed(mapped: Column, readable: Column, primary: Column, has_primary: Column, tried: Column, fallback: Column, has_fallback: Column) -> Column:
    """Status of an image from what the two attempts gave."""
    return (
        F.when(~mapped, FLAGGED).when(~readable, FAILED)
        .when(has_primary & (F.size(blocking(primary)) == 0), OK)
        .when(tried & has_fallback & (F.size(blocking(fallback)) == 0), RECOVERED)
        .otherwise(FLAGGED)
    )


#: Flags after which the primary crop itself can be tried again, and those that need a new mask.
RETRY_SAME = ("crop_category_inconsistent", "fill_ratio_too_low", "fill_ratio_too_high", "bbox_too_small")
RETRY_MASK = ("mask_too_small", "no_object_found", "mask_too_fragmented")


def dispatched(flags: Column, has_primary: Column) -> Column:
    """Which fallback an image's primary flags lead to: reuse, remask or grabcut."""
    names = lambda xs: F.array(*map(F.lit, xs))
    only = (F.size(flags) > 0) & (F.size(F.array_except(flags, names(RETRY_SAME))) == 0)
    return F.when(only & has_primary, "reuse").when(F.arrays_overlap(flags, names(RETRY_MASK)), "remask").otherwise("grabcut")
