"""Rules: coercion, inheritance, categories."""

from stillframe import config
from stillframe.config import CategoryRules, parse, resolve


def test_coercion():
    r = parse({"global": {"canvas_size": "800", "overwrite": "Yes", "edge_whiteness_threshold": 1, "background_color": [1, 2, 3], "unknown": 1, "jpeg_quality": 90.7}})
    g = r.globals
    assert (g.canvas_size, g.overwrite, g.edge_whiteness_threshold, g.background_color, g.jpeg_quality) == (800, True, 1.0, (1, 2, 3), 90)
    assert parse({"global": {"canvas_size": "abc"}}).globals.canvas_size == "abc"
    assert parse({"global": {"overwrite": "on"}}).globals.overwrite is False
    assert parse(None).gate.action == "warn"


def test_margins():
    assert CategoryRules(margin_pct=0.1, margin_top=0.2).margins() == (0.2, 0.1, 0.1, 0.1)


def test_categories_of_a_file():
    r = parse({"global": {"min_component_size": 900}, "categories": {"BALL": {"target_fill_ratio": [0.3, 0.6], "morph_kernel_size": 7}, "odd": None}})
    ball = resolve("BALL", r.categories)
    # a global that is not the default reaches every category of the file, and none other
    assert (ball.target_fill_ratio_min, ball.target_fill_ratio_max, ball.morph_kernel_size, ball.min_component_size) == (0.3, 0.6, 7, 900)
    assert ball.threshold_bias == -6.0 and resolve("SHOE", r.categories) == config.KNOWN["SHOE"]
    assert r.category_or_globals("new").min_component_size == 900 and resolve("new", r.categories).min_component_size == 500


def test_a_value_like_the_generic_default_is_ignored():
    r = parse({"categories": {"BALL": {"margin_pct": 0.05, "edge_proximity_px": 5}}})
    assert resolve("BALL", r.categories).margin_pct == 0.08 and resolve("BALL", r.categories).edge_proximity_px == 0


def test_category_match_is_exact():
    assert resolve("ball", {}).margin_pct == 0.05 and resolve("BALL", {}).margin_pct == 0.08
