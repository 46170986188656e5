"""Page rules on literal strings, and right-hand texts on a page made for each strategy."""

import pytest
from pyspark.sql import functions as F

from plinth.functions import geometry as G
from plinth.operators import pages as P

HEADINGS = [
    ("1.1 Observations and Recommendations", "OBS", "1.1 Observations and Recommendations"),
    ("2.10.3summary recommendations", "BLOCK", "summary heading"),
    ("Summary & Recommendations", "BLOCK", "summary heading"),
    ("Summaryless words", "OTHER", ""),
    ("x Summary", "OTHER", ""),
    ("Conclusions", "BLOCK", "summary heading"),
    ("Conclusionsx", "OTHER", ""),
    ("Roof  System Description", "BLOCK", "blocked heading (strict)"),
    ("Site overview", "BLOCK", "overview line: Site overview"),
    ("Siteoverview", "OTHER", ""),
    ("overview of deficiencies", "OTHER", ""),
    ("Deficiencies recommendations", "OBS", "Deficiencies recommendations"),
    ("  Observation: x", "OBS", "Observation"),
    ("Observational", "OTHER", ""),
    ("see observations & recommendations", "OBS", "observations & recommendations"),
    ("see observations", "OTHER", ""),
]
DOMAINS = [("Canopy", "ROOF"), ("Canopying", "OTHER"), ("roof area 4", "ROOF"), ("Roof areas 4", "OTHER"), ("Façade", "BUILDING"), ("facades", "OTHER"), ("North  elevation", "BUILDING"), ("x Roof plan", "OTHER"), ("a\nRoof plan", "ROOF")]
CONTENTS = [
    ("x\nTable of Contents\ny", True),
    ("tables of contents", False),
    (" \n contents \n", True),
    ("contents\nmore", False),
    ("roof section 1\nroof section 2\nROOF SECTION 33", True),
    ("roof section 1\nroof section 2\nroof sections 3", False),
    ("    a\n    b\n\tx\n    c", True),
    ("    a\n    b\n   c", False),
    ("Seams .... 12", True),
    ("Seams ....12", False),
    ("Seams   12", True),
    ("ab .. 12", True),
    ("a .. 1", False),
    ("Seams .... 12345", False),
    ("a long line\nanother\nthird\nSeams .... 12", False),
    ("a\n" * 20 + "Seams .... 12\n" * 6, True),
    ("", False),
    (" \n ", False),
    (None, False),
]
HINTS = [("leak", True), ("leakage", False), ("a photo of a leak", True), ("photosynthesis", False)]


@pytest.fixture(scope="module")
def of(spark):
    def run(values, column):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
        return [r.x for r in rows.select("i", column(F.col("t")).alias("x")).orderBy("i").collect()]

    return run


def test_headings(of):
    top = lambda t: F.split(t, "\n")
    got = of([h[0] for h in HEADINGS], lambda t: P.heading(top(t), t))
    assert [(h[0], r["class"], r.why) for h, r in zip(HEADINGS, got, strict=True)] == HEADINGS
    assert of([d[0] for d in DOMAINS], lambda t: P.domain_class(top(t))) == [d[1] for d in DOMAINS]


def test_contents(of):
    assert of([c[0] for c in CONTENTS], P.toc_like) == [c[1] for c in CONTENTS]
    assert of(["word " * 40_000], P.toc_like) == [False]


def test_hints(of):
    assert of([h[0] for h in HINTS], lambda t: P.has(t, *P.PATTERNS.strong)) == [True, False, True, False]
    assert of([h[0] for h in HINTS], lambda t: P.has(t, *P.PATTERNS.weak)) == [False, False, True, False]


def test_appendix(spark):
    rows = [("a", p, 6, False, None, None, t) for p, t in enumerate(["Appendix", "Appendix", "x", " APPENDIX", "Appendix A", "y"])]
    rows += [("b", p, 9, p in (1, 2, 5), 1, 2, t) for p, t in enumerate(["", "Appendix .... 40", "see appendixes 3\nAppendix A .. 8\nappendix B 7", "", "", "Appendix 2", "", "", ""])]
    df = spark.createDataFrame(rows, "report_id string, page0 int, n_pages int, toc boolean, toc_start int, toc_end int, raw_text string")
    assert {r.report_id: r.appendix_start for r in P.appendix_starts(df).collect()} == {"a": 3, "b": 6}


def test_gate(spark):
    names = "report_id string, page0 int, n_pages int, toc_start int, toc_end int, appendix_start int, heading string, domain string, images int, layout_ok boolean, raw_text string"
    base = [("OTHER", "ROOF", 1, True, ""), ("OBS", "OTHER", 1, True, ""), ("OBS", "OTHER", 1, True, ""), ("OTHER", "OTHER", 1, True, ""), ("OTHER", "OTHER", 0, True, ""), ("OTHER", "BUILDING", 1, True, ""), ("BLOCK", "ROOF", 1, True, ""), ("OTHER", "OTHER", 1, True, "photo of a leak"), ("OTHER", "OTHER", 1, False, ""), ("OTHER", "OTHER", 1, True, "leakage photo"), ("OBS", "OTHER", 1, True, ""), ("OBS", "OTHER", 1, True, "")]
    df = spark.createDataFrame([("r", i, 12, 1, 1, 10, *b) for i, b in enumerate(base)], names)
    got = [r.reason for r in P.gate(df).orderBy("page0").collect()]
    assert got == ["title", "toc", "in-OBS-section (persistent)", "in-OBS-section (persistent)", "no images", "blocked-by-domain", "blocked-heading", "outside-OBS: strong-inline+weak-hints", "layout-not-left-img_right-text", "outside-OBS: no strong obs context", "appendix", "last(summary)"]


def test_right_text(spark):
    rect = lambda *x: G.rect(*[F.lit(float(v)) for v in x])
    blocks = [("p", 0, 320.0, 110.0, 560.0, 160.0, "beside " * 12 + "\nPage 1 of 9"), ("p", 1, 320.0, 10.0, 560.0, 30.0, "page header " * 9), ("e", 0, 320.0, 600.0, 560.0, 650.0, "far below " * 9), ("h", 0, 330.0, 300.0, 600.0, 350.0, "in the right half " * 4), ("n", 0, 10.0, 100.0, 100.0, 150.0, "left " * 30)]
    b = spark.createDataFrame([(k, 1, *x) for k, *x in blocks], "report_id string, page int, block_no int, x0 double, y0 double, x1 double, y1 double, text string")
    b = b.select("report_id", "page", "block_no", G.rect(*map(F.col, ("x0", "y0", "x1", "y1"))).alias("r"), "text")
    i = spark.createDataFrame([(k,) for k in "penh"], "report_id string")
    right = F.when(F.col("report_id") == "h", 585.0).otherwise(300.0)
    i = i.select("report_id", F.lit(1).alias("page"), F.lit(1).alias("image_id"), G.rect(F.lit(100), F.lit(100), right, F.lit(250)).alias("r"), rect(0, 0, 612, 792).alias("pg"))
    got = {r.report_id: r for r in P.right_text(i, b).collect()}
    assert {k: r.strategy for k, r in got.items()} == {"p": "primary", "e": "expanded-vertical", "h": "proximity-right-half", "n": "none"}
    assert got["p"].footer_dropped and "Page" not in got["p"].right_text and "header" not in got["p"].right_text
    assert tuple(got["p"].region) == (314.0, 40.0, 594.0, 310.0) and tuple(got["h"].region) == (306.0, 18.0, 594.0, 774.0) and got["n"].right_chars == 0
