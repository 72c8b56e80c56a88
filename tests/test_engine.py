"""Runs over generated photographs, end to end."""

import hashlib
import json
import os
import zipfile

import numpy as np
import pytest

from stillframe import cli, config, reports
from stillframe.engine import Engine, GateBreach, statistics
from stillframe.kernels import codec
from stillframe.sources import files, tables
from stillframe.sources.workspace import Progress, RulesChanged, hash_file


def white(y0=None, y1=None, x0=None, x1=None, value=40, size=200):
    img = np.full((size, size, 3), 255, np.uint8)
    if y0 is not None:
        img[y0:y1, x0:x1] = value
    return img


def save(folder, **images):
    os.makedirs(folder, exist_ok=True)
    for name, img in images.items():
        with open(os.path.join(folder, f"{name}.png"), "wb") as f:
            f.write(img if isinstance(img, bytes) else codec.png(img))


def mapping_file(path, *rows, head="supplier_sku,store_article,suffix,category"):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([head, *rows]) + "\n")
    return str(path)


@pytest.fixture()
def place(tmp_path):
    return {k: str(tmp_path / k) for k in ("in", "out", "review")} | {"map": str(tmp_path / "map.csv"), "dir": tmp_path}


def run(spark, p, rules=None, **more):
    rules = rules or config.Rules()
    rules.globals.canvas_size = 200
    rows, _ = tables.load_mapping(spark, p["map"])
    return Engine(spark, rules).run(p["in"], p["out"], p["review"], rows, **more)


def by_name(r):
    return {x.name: x for x in r.results.collect()}


def test_every_outcome(spark, place):
    two = white(20, 60, 20, 60)
    two[140:180, 140:180] = 40
    save(place["in"], good=white(60, 140, 60, 140), ball=white(40, 160, 65, 135), empty=white(), bad=b"not an image", stray=white(60, 140, 60, 140), Case=white(60, 140, 60, 140))
    open(os.path.join(place["in"], "notes.txt"), "w").close()
    mapping_file(place["map"], "good,1,a,BAG", "good,2,b,BAG", "BALL,3,a,BALL", "empty,4,a,BAG", "bad,5,a,BAG", "case.PNG,6,a,BAG")
    rules = config.Rules()
    rules.globals.filename_pattern = "{store_article}-{suffix}.{ext}"
    r = run(spark, place, rules)
    got = by_name(r)
    assert {n: x.status for n, x in got.items()} == {"good.png": "ok", "ball.png": "recovered", "empty.png": "flagged", "bad.png": "failed", "stray.png": "flagged", "Case.png": "ok"}
    assert got["good.png"].output_names == ["1-a.jpg", "2-b.jpg"] and sorted(os.listdir(place["out"])) == ["1-a.jpg", "2-b.jpg", "3-a.jpg", "6-a.jpg"]
    assert got["ball.png"].flags == ["crop_category_inconsistent"] and got["stray.png"].flags == ["missing_mapping"] and got["bad.png"].flags == ["image_read_error"]
    assert got["empty.png"].fallback_attempted and {"mask_too_fragmented", "no_object_found"} <= set(got["empty.png"].flags)
    assert {"empty.png", "stray.png", "empty_preview.png"} <= set(os.listdir(place["review"]))
    s = statistics(r)
    assert s["general"] == {"total_discovered": 6, "total_attempted": 6, "total_ok": 2, "total_flagged": 2, "total_failed": 1, "total_recovered": 1}
    assert {"general", "by_background_type", "by_category", "by_flag", "quality", "mapping", "performance"} == set(s) and {"avg_fill_ratio", "fill_ratio_p90", "avg_crop_area_ratio"} <= set(s["quality"])
    assert set(s["mapping"]) == {"missing_mapping_count", "naming_conflict_count"} and {"per_image_p95_s", "fallback_invocation_rate", "avg_fallback_time_s"} <= set(s["performance"])
    for f, name in ((reports.stats_json, "s.json"), (reports.html_report, "r.html")):
        f(r, str(place["dir"] / name))
    reports.results_json(r.results, str(place["dir"] / "r.json"))
    reports.review_manifest(r.results, str(place["dir"] / "m.json"))
    assert len(json.load(open(place["dir"] / "m.json"))) == 3 and "good.png" in json.load(open(place["dir"] / "r.json"))
    assert "2 ok" in reports.console(s)
    again = files.results_json(spark, str(place["dir"] / "r.json"))
    d = reports.diff_report(again, again)
    assert d["counters"]["unchanged_ok"] == 3 and d["counters"]["unchanged_bad"] == 3 and "in both 6" in reports.diff_console(d)
    reports.diff_html(d, str(place["dir"] / "d.html"))
    assert reports.contact_sheet(again, place["out"], str(place["dir"] / "sheet.png"), 50, 5)


def test_collisions_limit_and_overwrite(spark, place):
    save(place["in"], a=white(60, 140, 60, 140), b=white(80, 120, 80, 120), c=white(60, 140, 60, 140))
    mapping_file(place["map"], "a,1,x,BAG", "b,1,x,BAG", "c,2,x,BAG")
    rules = config.Rules()
    rules.globals.filename_pattern = "{store_article}.{ext}"
    r = run(spark, place, rules, limit=2)
    got = by_name(r)
    assert r.discovered == 3 and len(got) == 2 and got["a.png"].output_names == ["1.jpg"]
    assert got["b.png"].output_names == [] and "naming_conflict" in got["b.png"].flags and got["b.png"].status == "ok"
    before = os.path.getmtime(os.path.join(place["out"], "1.jpg"))
    again = by_name(run(spark, place, rules))
    assert "naming_conflict" in again["a.png"].flags and again["c.png"].output_names == ["2.jpg"]
    assert os.path.getmtime(os.path.join(place["out"], "1.jpg")) == before
    rules.globals.overwrite = True
    assert by_name(run(spark, place, rules))["a.png"].output_names == ["1.jpg"]


def test_incremental_and_force(spark, place):
    save(place["in"], a=white(60, 140, 60, 140), b=white(60, 140, 40, 160))
    mapping_file(place["map"], "a,1,x,BAG", "b,2,x,SHOE")
    assert len(by_name(run(spark, place, incremental=True))) == 2
    assert len(by_name(run(spark, place, incremental=True))) == 0
    assert list(by_name(run(spark, place, incremental=True, force={"bag"}))) == ["a.png"]
    save(place["in"], c=white(60, 140, 60, 140))
    assert list(by_name(run(spark, place, incremental=True))) == ["c.png"]
    assert len(by_name(run(spark, place, incremental=True, references=(4e9,)))) == 3


def test_checkpoint(spark, place, tmp_path):
    path = str(tmp_path / "cp")
    c = Progress(spark, path, "h1")
    assert c.table().isEmpty()
    save(place["in"], a=white(60, 140, 60, 140), b=white(60, 140, 60, 140))
    mapping_file(place["map"], "a,1,x,BAG", "b,2,x,BAG")
    assert len(by_name(run(spark, place, checkpoint=c, limit=1))) == 1
    again = Progress(spark, path, "h1")
    assert again.started_at == c.started_at and [(r.name, r.status, len(r.outputs)) for r in again.table().collect()] == [("a.png", "ok", 1)]
    assert list(by_name(run(spark, place, checkpoint=again))) == ["b.png"]
    with pytest.raises(RulesChanged):
        Progress(spark, path, "h2")
    forced = Progress(spark, path, "h2", force=True)
    assert forced.table().count() == 2
    forced.export(str(tmp_path / "cp.json"))
    told = json.load(open(tmp_path / "cp.json"))
    assert told["total_completed"] == 2 and told["config_hash"] == "h1" and told["completed"]["a.png"]["status"] == "ok"
    assert Progress(spark, path, "h3", resume=False).table().isEmpty()
    odd = tmp_path / "rules [1]{a}*.yaml"
    odd.write_bytes(b"global: {}\n")
    assert hash_file(spark, str(odd)) == hashlib.sha256(b"global: {}\n").hexdigest()


def test_gate(spark, place):
    save(place["in"], **{f"i{k:02}": white(size=40) for k in range(8)})
    mapping_file(place["map"], *[f"i{k:02},{k},x,BAG" for k in range(8)])
    rules = config.Rules()
    rules.gate = config.GateRules(check_interval=4, min_samples=3, min_success_rate=0.5, action="abort")
    rules.fallback.enabled = False
    with pytest.raises(GateBreach) as e:
        run(spark, place, rules)
    assert e.value.results.count() == 4 and "no_object_found" in str(e.value)
    rules.gate.action = "warn"
    assert run(spark, place, rules).results.count() == 8


def test_mapping_files(spark, tmp_path):
    good = mapping_file(tmp_path / "m.csv", " S1 ,A1,front,BALL,red", "s1,A2,side,,", ",A3,x,BAG,", "S4,NA,x,BAG,", "S5,100/001,fr ont,BAG,", "S6,A1,front,BAG,", head="Supplier SKU,store_article,suffix,category,color")
    rows, issues = tables.load_mapping(spark, good)
    found = {i.message for i in issues.collect()}
    assert found == {"SKU 's1': missing category", "Row 2: empty supplier_sku", "Row 3: empty store_article or suffix for SKU 'S4'", "SKU 'S5': unsafe output filename '100/001_fr ont.jpg'", "Output filename 'A1_front.jpg' appears 2 times"}
    from stillframe.operators import mapping as mp

    assert {r.sku_key: r.n_rows for r in mp.by_sku(rows).collect()} == {"s1": 2, "s5": 1, "s6": 1}
    for name, text in (("no.csv", None), ("wrong.csv", "sku,article\n1,2\n")):
        if text:
            (tmp_path / name).write_text(text)
        rows, issues = tables.load_mapping(spark, str(tmp_path / name))
        assert rows.count() == 0 and issues.count() == 1
    with pytest.raises(ValueError):
        tables.raw_mapping(spark, "old.xls")


def workbook(path, rows):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    texts = list(dict.fromkeys(str(c) for r in rows for c in r if c is not None))
    cells = lambda k, r: "".join(f'<c r="{chr(65 + i)}{k}" t="s"><v>{texts.index(str(c))}</v></c>' for i, c in enumerate(r) if c is not None)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{t}</t></si>" for t in texts) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>" + "".join(f'<row r="{k}">{cells(k, r)}</row>' for k, r in enumerate(rows, 1)) + "</sheetData></worksheet>")


def test_workbooks(spark, tmp_path):
    workbook(tmp_path / "m.xlsx", [["supplier_sku", "store_article", "suffix", "category"], ["S1", "A1", "x", "BAG"], [None, "A2", "x", None]])
    rows, issues = tables.load_mapping(spark, str(tmp_path / "m.xlsx"))
    assert [(r.seq, r.supplier_sku) for r in rows.orderBy("seq").collect()] == [(0, "S1"), (1, "")] and issues.count() == 1
    os.makedirs(tmp_path / "masters")
    for name, sku in (("a.xlsx", "AB1"), ("b.xlsx", "AB12"), ("~$c.xlsx", "no")):
        workbook(tmp_path / "masters" / name, [["title"], ["h"] * 9, [None] * 7 + ["Artnr", "x"], [None] * 7 + [f"Art {sku}", sku], [None] * 7 + ["other", "AB1"]])
    masters = tables.load_masters(spark, str(tmp_path / "masters"))
    assert sorted((r.sku, r.article) for r in masters.collect()) == [("AB1", "Art AB1"), ("AB1", "other"), ("AB1", "other"), ("AB12", "Art AB12")]
    save(str(tmp_path / "in"), **{"x-AB12-1": white(size=10), "y-AB1": white(size=10), "none": white(size=10)})
    assert cli.main(["rename", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--masters", str(tmp_path / "masters"), "--skip-unmatched"]) == 0
    assert sorted(os.listdir(tmp_path / "out")) == ["x-Art-AB12-1.png", "y-Art-AB1.png"]


def test_command_line(spark, place):
    p = place
    save(p["in"], a=white(60, 140, 60, 140), b=white(60, 140, 60, 140))
    mapping_file(p["map"], "a,1,x,BAG", "b,2,x,BAG")
    rules = str(p["dir"] / "rules.yaml")
    with open(rules, "w") as f:
        f.write("global:\n  canvas_size: '150'\nquality_gate:\n  action: warn\n")
    base = ["run", "-i", p["in"], "-o", p["out"], "--review", p["review"], "-m", p["map"], "-r", rules]
    assert cli.main([*base, "--dry-run"]) == 0 and not os.path.exists(p["out"])
    assert cli.main([*base, "-n", "1", "-f", "png", "--stats", str(p["dir"] / "s.json"), "--results", str(p["dir"] / "r.json"), "--html-report", str(p["dir"] / "r.html"), "--contact-sheet", str(p["dir"] / "c.jpg")]) == 0
    assert json.load(open(p["dir"] / "s.json"))["general"]["total_discovered"] == 2 and os.path.exists(os.path.join(p["out"], "a-cropped.png")) and os.path.exists(p["dir"] / "c.jpg")
    assert cli.main([*base, "--resume"]) == 0 and os.path.exists(os.path.join(p["out"], "b-cropped.jpg"))
    with open(rules, "a") as f:
        f.write("fallback:\n  enabled: false\n")
    assert cli.main([*base, "--resume"]) == 1 and cli.main([*base, "--resume", "--force"]) == 0
    assert cli.main([*base, "-f", "gif"]) == 1 and cli.main(["run", "-i", "/nowhere", *base[3:]]) == 1
    r = str(p["dir"] / "r.json")
    assert cli.main(["diff", "--before", r, "--after", r, "--output", str(p["dir"] / "d.html")]) == 0 and cli.main(["diff", "--before", "/no", "--after", r]) == 1
    assert cli.main(["contact-sheet", "--input", p["out"], "--results", r, "--output", str(p["dir"] / "c.png"), "--columns", "3"]) == 0
    assert cli.main(["contact-sheet", "-i", p["out"], "-r", r, "-o", str(p["dir"] / "c2.png"), "-t", "40", "-c", "2", "-q", "80"]) == 0


def test_gate_exit_code(spark, place):
    save(place["in"], **{f"i{k}": white(size=30) for k in range(4)})
    mapping_file(place["map"], *[f"i{k},{k},x,BAG" for k in range(4)])
    rules = str(place["dir"] / "rules.yaml")
    with open(rules, "w") as f:
        f.write("quality_gate: {check_interval: 2, min_samples: 2}\nfallback: {enabled: no}\n")
    assert cli.main(["run", "-i", place["in"], "-o", place["out"], "--review", place["review"], "-m", place["map"], "-r", rules, "--quality-gate", "abort"]) == 2


def test_prepare(spark, tmp_path):
    save(str(tmp_path / "src" / "Bollar" / "deep"), **{"a b": white(size=10)})
    save(str(tmp_path / "src" / "Golf Bags"), **{"a_b": white(size=10), "ö": white(size=10)})
    (tmp_path / "src" / "Bollar" / "a b.jpg").write_bytes(b"x")
    assert cli.main(["prepare", "--source", str(tmp_path / "src"), "--mapping", str(tmp_path / "m.csv"), "--input", str(tmp_path / "in")]) == 0
    rows = (tmp_path / "m.csv").read_text().splitlines()[1:]
    assert rows == ["a b,a-b,cropped,BALL", "a_b,a-b-0001,cropped,BAG", "ö,image-0002,cropped,BAG"]
    assert sorted(os.listdir(tmp_path / "in")) == ["a b.png", "a_b.png", "ö.png"]


def test_stream(spark, place):
    from stillframe.streaming import incremental as inc

    save(place["in"], a=white(60, 140, 60, 140), stray=white())
    mapping_file(place["map"], "a,1,x,BAG", "b,2,x,BAG")
    rows, _ = tables.load_mapping(spark, place["map"])
    args = (spark, place["in"], rows, config.Rules(globals=config.GlobalRules(canvas_size=100)), place["out"], str(place["dir"] / "cp"))
    inc.process_new(*args)
    save(place["in"], b=white(60, 140, 60, 140))
    inc.process_new(*args)
    got = spark.read.parquet(place["out"])
    assert sorted((r.name, r.status, r.batch) for r in got.collect()) == [("a.png", "ok", 0), ("b.png", "ok", 1), ("stray.png", "flagged", 0)]
    assert {(r.category, r.total, r.good) for r in inc.monitored(got).collect()} == {("BAG", 2, 2), ("UNKNOWN", 1, 0)}
