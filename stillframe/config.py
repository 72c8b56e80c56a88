"""Rules: settings with their defaults, YAML input, and the rules of each category."""

from __future__ import annotations

import logging
from dataclasses import asdict, dataclass, field, fields, replace
from typing import Any, get_type_hints

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


# The names of the settings in a rules file, and their defaults.


@dataclass
class GlobalRules:
    canvas_size: int = 1000
    jpeg_quality: int = 95
    background_color: tuple = (255, 255, 255)
    white_distance_threshold: float = 12.0
    edge_whiteness_threshold: float = 0.85
    alpha_threshold: int = 128
    min_object_ratio: float = 0.005
    max_bbox_ratio: float = 1.0
    min_bbox_ratio: float = 0.01
    morph_kernel_size: int = 5
    morph_iterations: int = 2
    min_component_size: int = 500
    edge_proximity_px: int = 5
    adaptive_block_size: int = 21
    adaptive_c: float = 10.0
    output_format: str = "jpg"
    filename_pattern: str = "{source_stem}-cropped.{ext}"
    overwrite: bool = False


@dataclass
class CategoryRules:
    """Margins below 0 mean margin_pct; object and bbox ratios of 0 mean the global ones."""

    name: str = ""
    margin_pct: float = 0.05
    margin_top: float = -1.0
    margin_bottom: float = -1.0
    margin_left: float = -1.0
    margin_right: float = -1.0
    margin_mode: str = "image"
    threshold_bias: float = 0.0
    morph_kernel_size: int = 5
    morph_iterations: int = 2
    min_component_size: int = 500
    target_fill_ratio_min: float = 0.25
    target_fill_ratio_max: float = 0.90
    centering_bias_x: float = 0.0
    centering_bias_y: float = 0.0
    thin_object_protection: bool = False
    min_output_px: int = 50
    edge_proximity_px: int = 5
    min_object_ratio: float = 0.0
    min_bbox_ratio: float = 0.0
    expected_aspect_ratio_min: float = 1.0
    expected_aspect_ratio_max: float = 15.0
    adaptive_block_size: int = 21
    adaptive_c: float = 10.0

    def margins(self) -> tuple[float, float, float, float]:
        """Top, bottom, left, right."""
        sides = (self.margin_top, self.margin_bottom, self.margin_left, self.margin_right)
        return tuple(self.margin_pct if s < 0 else s for s in sides)


@dataclass
class FallbackRules:
    enabled: bool = True
    strategy: str = "grabcut"
    grabcut_iterations: int = 5
    max_attempts: int = 1
    validation_tolerance: float = 0.8


@dataclass
class GateRules:
    enabled: bool = True
    check_interval: int = 50
    min_samples: int = 10
    min_success_rate: float = 0.70
    action: str = "warn"


@dataclass
class Rules:
    globals: GlobalRules = field(default_factory=GlobalRules)
    fallback: FallbackRules = field(default_factory=FallbackRules)
    gate: GateRules = field(default_factory=GateRules)
    categories: dict[str, CategoryRules] = field(default_factory=dict)

    def category_or_globals(self, name: str) -> CategoryRules:
        """A category as the file has it, else the generic one with the shared settings of the globals."""
        return self.categories.get(name) or CategoryRules(name=name, **shared(self.globals))


def _category(name: str, margin: float, fill: float, most_aspect: float, least_aspect: float = 1.0, **other: Any) -> CategoryRules:
    return CategoryRules(name=name, margin_pct=margin, target_fill_ratio_min=fill, target_fill_ratio_max=1.0, edge_proximity_px=0, expected_aspect_ratio_min=least_aspect, expected_aspect_ratio_max=most_aspect, **other)


#: The known categories.
KNOWN = {
    c.name: c
    for c in (
        _category("CLUB_LONG", 0.0, 0.75, 25.0, margin_top=0.05, margin_bottom=0.0, threshold_bias=-2.0, morph_kernel_size=3, min_component_size=300, thin_object_protection=True, min_output_px=30),
        _category("CLUB_HEAD_ONLY", 0.06, 0.80, 3.0, min_component_size=400),
        _category("BALL", 0.08, 0.70, 1.5, threshold_bias=-6.0, min_component_size=200, min_object_ratio=0.001, min_bbox_ratio=0.005),
        _category("SHOE", 0.02, 0.80, 4.0, 1.3, margin_left=0.02, margin_right=0.02),
        _category("BAG", 0.02, 0.80, 3.5, margin_top=0.02, margin_bottom=0.02),
        _category("APPAREL_FOLDED", 0.01, 0.80, 3.0, margin_top=0.0, margin_bottom=0.0),
        _category("APPAREL_WORN_OR_SHAPED", 0.02, 0.75, 4.0),
        _category("ACCESSORY_SMALL", 0.05, 0.08, 15.0, min_component_size=50, min_object_ratio=0.0001, min_bbox_ratio=0.0003, min_output_px=100),
        _category("BOX_OR_PACKAGING", 0.02, 0.85, 3.0),
    )
}


def coerce(value: Any, kind: type) -> Any:
    """``value`` as the declared type; what cannot be converted stays as it is, with a warning."""
    if kind is bool:
        return value.lower() in ("true", "1", "yes") if isinstance(value, str) else bool(value)
    if kind is str:
        return str(value)
    if kind is tuple:
        return tuple(value)
    try:
        return kind(value)
    except (TypeError, ValueError):
        log.warning("%r is no %s and is kept as it is", value, kind.__name__)
        return value


def fill_in(rules: Any, given: dict[str, Any]) -> Any:
    """A copy of settings with the given ones that it has, coerced; unknown names are ignored."""
    kinds = get_type_hints(type(rules))
    return replace(rules, **{k: coerce(v, kinds[k]) for k, v in given.items() if k in kinds})


def shared(g: GlobalRules) -> dict[str, Any]:
    """Settings that globals and categories both have."""
    return {f.name: getattr(g, f.name) for f in fields(CategoryRules) if hasattr(g, f.name)}


def layered(name: str, given: dict[str, Any] | None, g: GlobalRules) -> CategoryRules:
    """A category's settings: those shared with the globals, over them its own, over these the ends of its fill ratio."""
    own = dict(given or {})
    pair = own.pop("target_fill_ratio", None)
    ends = zip(("target_fill_ratio_min", "target_fill_ratio_max"), map(float, pair)) if isinstance(pair, list) and len(pair) == 2 else ()
    return fill_in(CategoryRules(), {**shared(g), **own, **dict(ends), "name": name})


def parse(raw: dict[str, Any] | None) -> Rules:
    """Rules from the parsed file; categories inherit the shared settings of its globals."""
    part = lambda key: (raw or {}).get(key) or {}
    g, given = fill_in(GlobalRules(), part("global")), part("categories")
    for name in given.keys() - KNOWN.keys():
        log.warning("category %r is none of %s", name, ", ".join(sorted(KNOWN)))
    return Rules(g, fill_in(FallbackRules(), part("fallback")), fill_in(GateRules(), part("quality_gate")), {name: layered(name, own, g) for name, own in given.items()})


def load(path: str) -> Rules:
    import yaml

    with open(path, encoding="utf-8") as f:
        return parse(yaml.safe_load(f))


def resolve(name: str, categories: dict[str, CategoryRules]) -> CategoryRules:
    """The rules used for a category: the known ones, changed where the file's differ from what default globals would give."""
    base = KNOWN.get(name) or CategoryRules(name=name)
    given = categories.get(name)
    if given is None:
        return base
    plain = asdict(CategoryRules(name=name, **shared(GlobalRules())))
    return replace(base, **{k: v for k, v in asdict(given).items() if k != "name" and v != plain[k]})


def category_table(spark: SparkSession, rules: Rules | None = None) -> DataFrame:
    """One row per known or given category, and one named '' for all others."""
    rules = rules or Rules()
    names = [*dict.fromkeys([*KNOWN, *rules.categories]), ""]
    rows = [asdict(resolve(n, rules.categories)) | {"name": n} for n in names]
    kinds = {str: "string", int: "int", float: "double", bool: "boolean"}
    hints = get_type_hints(CategoryRules)
    schema = ", ".join(f"{f.name} {kinds[hints[f.name]]}" for f in fields(CategoryRules))
    return spark.createDataFrame([tuple(r[f.name] for f in fields(CategoryRules)) for r in rows], schema)
