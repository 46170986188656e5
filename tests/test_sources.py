"""Round trips of sources and sinks."""

import json

import pytest

from plinth.operators import catalogue as C, reports
from plinth.sources import staging, tables as S

ITEMS = [{"sheet": "2.0", "id": "2.1", "label": "Torn lap", "cause_effect": "c", "choice_order": ["a"], "recommendations": {"a": {"choice": "x", "text": "y"}}}, {"category": "3.0", "id": "3.1", "label": "Débris"}, {"id": "9", "label": " "}]


@pytest.mark.parametrize("body", [json.dumps({"version": 1, "items": ITEMS}), json.dumps(ITEMS), "﻿" + json.dumps({"items": ITEMS}), json.dumps({"items": ITEMS}).replace('"', "'")])
def test_taxonomy(spark, tmp_path, body):
    (tmp_path / "t.json").write_text(body, encoding="utf-8")
    got = S.read_taxonomy(spark, str(tmp_path / "t.json")).orderBy("ord").collect()
    assert [(r.sheet, r.id) for r in got] == [("2.0", "2.1"), ("3.0", "3.1")]
    assert got[0].recommendations["a"].text == "y"


def test_taxonomy_of_another_form_is_an_error(spark, tmp_path):
    (tmp_path / "t.json").write_text("plain text")
    with pytest.raises(Exception, match="neither an object"):
        S.read_taxonomy(spark, str(tmp_path / "t.json")).collect()


def test_taxonomy_round_trip(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"items": [*ITEMS[:2], {"sheet": "2.0", "id": "2.10", "label": "z"}, {"sheet": "2.0", "id": "2.9", "label": "y"}]}), encoding="utf-8")
    first = S.read_taxonomy(spark, str(tmp_path / "t.json"))
    S.write_taxonomy(first, str(tmp_path / "out"))
    written = json.loads("".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part-*")))
    assert written["version"] == 1 and written["source_sheets"] == ["2.0", "3.0"] and "Débris" in str(written)
    assert [i["id"] for i in written["items"]] == ["2.1", "2.9", "2.10", "3.1"]  # numbers by value
    again = S.read_taxonomy(spark, str(tmp_path / "out"))
    rows = lambda df: sorted((r.sheet, r.id, r.label, r.cause_effect, repr(r.choice_order), repr(r.recommendations)) for r in df.collect())
    assert rows(again) == rows(first)


def test_fallback_chain(spark, tmp_path):
    (tmp_path / "bad.json").write_text("nothing")
    (tmp_path / "empty.json").write_text('{"items": []}')
    (tmp_path / "t.csv").write_text('Obs_ID,Name,Group\n2.1,"Torn, lap",2.0\n,no id,2.0\n')
    found, tried = S.load_taxonomy(spark, str(tmp_path / "bad.json"), str(tmp_path / "t.csv"))
    assert [(r.sheet, r.id, r.label) for r in found.collect()] == [("2.0", "2.1", "Torn, lap")]
    assert tried[0].startswith("json: ") and tried[1] == "csv: ok"
    assert S.load_taxonomy(spark, str(tmp_path / "empty.json"), str(tmp_path / "t.csv"))[1] == ["json: no items", "csv: ok"]
    (tmp_path / "books").mkdir()
    (tmp_path / "books" / "2.0.csv").write_text("2.1,Torn lap,c,a,x,t\n,,,b,y,u\n")
    found, tried = S.load_taxonomy(spark, str(tmp_path / "none.json"), str(tmp_path / "none.csv"), (str(tmp_path / "books"), "2.0"))
    assert [(r.sheet, r.id, r.label) for r in found.collect()] == [("2.0", "2.1", "Torn lap")] and len(tried) == 3
    with pytest.raises(ValueError, match="no taxonomy"):
        S.load_taxonomy(spark, str(tmp_path / "none.json"))


def test_workbook_to_items(spark, tmp_path):
    assert S.list_sheets(str(tmp_path)) == []
    with pytest.raises(FileNotFoundError):
        S.list_sheets(str(tmp_path / "none.xlsx"))
    cells = [
        ["ID", "Observation", "Cause/Effect", "Letter", "Choice", "Text"],
        ["2.1", "Torn lap", "wind", "", "Patch", "p"],
        ["", "", "", "(c)", "Replace", "r"],
        [],
        ["2.2", "", "", "a", "lost", "with its id"],
        ["", "", "", "b", "lost", "too"],
        ["2.3", " Debris ", "", "", "Clean", "c", "a seventh cell"],
        ["2.1", "Torn lap", "wind", "a", "Patch again", "q"],
    ]
    rows = S.six_cells(spark.createDataFrame([("2.0", i, c) for i, c in enumerate(cells)], "sheet string, row_no long, cells array<string>"))
    got = {r.id: r for r in C.items_of_rows(rows).collect()}
    assert set(got) == {"2.1", "2.3"} and got["2.3"].label == "Debris" and got["2.3"].choice_order == ["a"]
    assert got["2.1"].choice_order == ["a", "c"]  # the blank row's letter c is that of the row before it, and is written last
    assert got["2.1"].recommendations["a"].choice == "Patch again" and got["2.1"].recommendations["c"].choice == ""


def test_label_map_and_calibration(spark, tmp_path):
    items = spark.createDataFrame([(0, "a", "A", "1.0"), (1, "b", "B", "1.0"), (2, "a", "A2", "2.0")], "ord int, id string, label string, sheet string")
    m = json.loads(S.label_map(items).first().value)
    assert m["id_to_idx"] == {"a": 2, "b": 1} and m["idx_to_info"]["2"] == {"id": "a", "label": "A2", "sheet": "2.0"} and m["sheet_to_ids"] == {"1.0": ["a", "b"], "2.0": ["a"]} and m["image_size"] == 518
    S.write_calibration(spark.createDataFrame([(1.3, 0.5)], "temperature double, mean_nll double"), str(tmp_path / "c"))
    assert S.read_calibration(spark, str(tmp_path / "c")) == 1.3


def test_csv_falls_back_only_if_it_may_not_be_written(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    assert S.write_csv(df, str(tmp_path / "o")) == str(tmp_path / "o")
    with pytest.raises(Exception, match="broken"):
        S.write_csv(df.selectExpr("raise_error('broken') AS x"), str(tmp_path / "p"))
    assert not list(tmp_path.glob("p*"))


def test_pages_and_images(spark, tmp_path):
    spans = spark.createDataFrame([("r", 1, 1, 0.0, 0.0, 1.0, 1.0, "second"), ("r", 1, 0, 0.0, 0.0, 1.0, 1.0, "first"), ("r", 1, 2, 0.0, 0.0, 1.0, 1.0, None)], "report_id string, page int, block_no int, x0 double, y0 double, x1 double, y1 double, text string")
    blocks = S.text_blocks(spans)
    assert blocks.count() == 2 and S.raw_text(blocks).first().raw_text == "first\nsecond"
    (tmp_path / "a.png").write_bytes(b"png")
    wanted = spark.createDataFrame([("a.png",), ("b.png",)], "image_file string")
    got = {r.image_file: (bytes(r.content), r.found) for r in S.image_contents(wanted, S.read_files(spark, str(tmp_path), "*.png"), b"\0\0").collect()}
    assert got == {"a.png": (b"png", True), "b.png": (b"\0\0", False)}
    folder = S.write_summary({"totals": wanted}, str(tmp_path / "runs"), "1")
    assert spark.read.parquet(f"{folder}/totals").count() == 2


def test_staging_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError, match="checkpoint"):
        staging.shared_folder(Session())


def test_snapshot(spark, tmp_path):
    path = str(tmp_path / "s")
    stats = spark.createDataFrame([("r1", 2, 5), ("r2", 1, 1)], S.SNAPSHOT)
    S.write_snapshot(stats, path)
    assert sorted(tuple(r) for r in S.read_snapshot(spark, path).collect()) == [("__totals__", 3, 6), ("r1", 2, 5), ("r2", 1, 1)]
    (tmp_path / "h").write_text("# c\n\nr1|2|5\nbad|line\nr2|x|1\n")
    assert [tuple(r) for r in S.read_snapshot(spark, str(tmp_path / "h")).collect()] == [("r1", 2, 5)]


def test_manifest_and_aliases(spark, tmp_path):
    (tmp_path / "m.csv").write_text("image_file,label\na,b\n")
    with pytest.raises(ValueError, match="observation_id"):
        S.read_manifest(spark, str(tmp_path / "m.csv"))
    df = spark.createDataFrame([("1", "x", "s")], "OBS_ID string, Name string, Group string")
    assert S.resolve(df).columns == ["id", "label", "sheet"]
    with pytest.raises(ValueError, match="sheet"):
        S.resolve(df.drop("Group"))


def test_workbook_rows(spark, tmp_path):
    (tmp_path / "w.csv").write_text('1.1, A ,"c\nd",a,x,t\n,,,,,\n')
    got = S.read_workbook_rows(spark, str(tmp_path / "w.csv"), "2.0").orderBy("row_no").collect()
    assert (got[0].c_observation, got[0].c_cause_effect, got[1].c_id) == ("A", "c\nd", "")


def test_buckets_on_disk(spark, tmp_path):
    rows = spark.createDataFrame([("a", "l", 0.9), ("b", "l", 0.1)], "image_file string, label string, confidence double")
    reports.write_buckets(rows, str(tmp_path / "b"))
    assert {p.name for p in (tmp_path / "b").iterdir() if p.is_dir()} == {"bucket=high", "bucket=low"}


def test_downloads_and_cache(spark, tmp_path):
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "name string")
    assert [r.name for r in S.to_download(names("p/a", "p/b"), names("a"), "p/").collect()] == ["b"]
    calls = []
    compute = lambda: calls.append(1) or spark.createDataFrame([(0, [1.0])], "ord int, embedding array<float>")
    for _ in range(2):
        assert S.cached_embeddings(spark, str(tmp_path / "e"), "sig", compute).count() == 1
    assert len(calls) == 1
