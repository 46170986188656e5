"""Page classification and gating: headings, table of contents, appendix, sections kept by latches.

Pattern packs are data; the defaults are the domain's own. Each pattern is searched for with letter case aside; ^ and $ are those of lines only where a pattern says (?m).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from plinth.functions import geometry as G, text as T


@dataclass(frozen=True)
class Patterns:
    """Heading vocabularies, in order. Fixed values."""

    toc_header: tuple[str, ...] = (r"\btable of contents\b", r"^\s*contents\s*$")
    toc_line: str = r".{3,}(\.{2,}|\s{2,})\s+(\d{1,4})\s*$"
    toc_line_from_end: str = r"^\s*\d{1,4}\s+(\.{2,}|\s{2,}).{3,}"  # toc_line of a reversed line, where it needs no search
    toc_appendix: str = r"\bappendix\b"
    roof_section_line: str = r"\broof section\s+\d+\b"
    indented_line: str = r"^\s{4,}\S"
    appendix_heading: str = r"(?mi)^\s*appendix(?:\s+[A-Z0-9]+)?\b"
    summary: tuple[str, ...] = (
        r"(?mi)^\s*(?:\d+(?:\.\d+)*)?\s*summary\s*(?:&|and)?\s*recommendations\b",
        r"(?mi)^\s*executive\s+summary\b",
        r"(?mi)^\s*overall\s+condition\b",
        r"(?mi)^\s*conclusion[s]?\b",
        r"(?mi)^\s*summary\b",
    )
    blocked: tuple[str, ...] = (
        r"(?mi)^\s*condition\s+assessment\b",
        r"(?mi)^\s*roof\s+condition\s+assessment\b",
        r"(?mi)^\s*existing\s+conditions\b",
        r"(?mi)^\s*roof\s+system\s+description\b",
        r"(?mi)^\s*roof\s+composition\b",
    )
    observation: tuple[str, ...] = (
        r"(?mi)^\s*(?:\d+(?:\.\d+)*)?\s*observations?\s*(?:&|and)\s*recommendations?\b",
        r"(?mi)^\s*deficienc(?:y|ies)\s*(?:&|and)?\s*recommendations?\b",
        r"(?mi)^\s*observations?\b",
        r"(?mi)^\s*deficienc(?:y|ies)\b",
        r"(?mi)^\s*recommendations?\b",
        r"(?mi)\bobservations?\s*(?:&|and)\s*recommendations?\b",
        r"(?mi)\bdeficienc(?:y|ies)\s*(?:&|and)?\s*recommendations?\b",
    )
    overview: str = r"\boverview\b"
    not_overview: str = r"observations?|deficienc(?:y|ies)|recommendations?"
    weak: tuple[str, ...] = (
        r"\bphotograph[s]?\b",
        r"\bphoto[s]?\b",
        r"\bfigure[s]?\b",
        r"(?mi)^\s*item\s+\d+\b",
        r"(?mi)^\s*section\s+\d+\b",
        r"\broof\s*(area|section)\s+\d+\b",
    )
    strong: tuple[str, ...] = (r"\bobservation[s]?\b", r"\bdeficienc(?:y|ies)\b", r"\brecommendation[s]?\b", r"\bdeterioration\b", r"\bleak\b")
    roof: tuple[str, ...] = (r"(?mi)^\s*roof\s+assessment\b", r"(?mi)^\s*roof\s+(area|section)\s+\d+\b", r"(?mi)^\s*canopy\b", r"(?mi)^\s*roof\s+plan\b")
    building: tuple[str, ...] = (r"(?mi)^\s*building\s+envelope\b", r"(?mi)^\s*(north|south|east|west)\s+elevation\b", r"(?mi)^\s*fa(?:ç|c)ade\b", r"(?mi)^\s*wall\s+assembly\b")


PATTERNS = Patterns()
#: Where lines end. Fixed values.
LINE_ENDS = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def has(text: Column, *patterns: str) -> Column:
    """Any of the patterns is found; false for null."""
    return F.coalesce(text.rlike("(?i)(?:" + "|".join(f"(?:{p})" for p in patterns) + ")"), F.lit(False))


def lines_of(text: Column) -> Column:
    return F.split(text, LINE_ENDS)


def full_lines(text: Column) -> Column:
    """The lines of a text that aren't blank."""
    return F.filter(lines_of(text), lambda x: x.rlike(r"[^\s\p{Z}]"))


def toc_like(text: Column, p: Patterns = PATTERNS, lines: Column | None = None) -> Column:
    """True for a page that looks like a table of contents; false for a page without any line. lines: its full_lines, where they are a column already."""
    lines = full_lines(text) if lines is None else lines
    hits = lambda rx: F.size(F.filter(lines, lambda x: has(x, rx)))
    dotted = F.size(F.filter(lines, lambda x: F.reverse(x).rlike(p.toc_line_from_end)))
    many = (hits(p.roof_section_line) >= 3) | (hits(p.indented_line) >= 3) | (dotted >= 6) | (dotted / F.greatest(F.size(lines), F.lit(1)) >= 0.30)
    return F.coalesce((F.size(lines) > 0) & (has(text, *p.toc_header) | many), F.lit(False))


def heading(top: Column, page: Column, p: Patterns = PATTERNS) -> Column:
    """struct(class, why): BLOCK before OBS before OTHER. top: the top lines of a page (array); page: its whole text, in which a summary heading anywhere counts."""
    text = F.array_join(top, "\n")
    overview = F.get(F.filter(top, lambda x: has(x, p.overview) & ~has(x, p.not_overview)), F.lit(0))
    block = F.when(has(page, *p.summary), "summary heading").when(has(text, *p.blocked), "blocked heading (strict)").when(overview.isNotNull(), F.concat(F.lit("overview line: "), overview))
    seen = F.coalesce(*[F.nullif(F.regexp_extract(text, f"(?i){rx}", 0), F.lit("")) for rx in p.observation])
    kind = F.when(block.isNotNull(), "BLOCK").when(seen.isNotNull(), "OBS").otherwise("OTHER")
    return F.struct(kind.alias("class"), F.coalesce(block, T.strip(seen), F.lit("")).alias("why"))


def domain_class(top: Column, p: Patterns = PATTERNS) -> Column:
    """ROOF before BUILDING before OTHER, from the top lines of a page (array)."""
    text = F.array_join(top, "\n")
    return F.when(has(text, *p.roof), "ROOF").when(has(text, *p.building), "BUILDING").otherwise("OTHER")


def top_lines(blocks: Column, width: Column, height: Column, most: int = 14, bands: G.Bands = G.BANDS) -> Column:
    """The first non-blank lines of the blocks in the top band that start left or are wide."""
    inside = F.filter(blocks, lambda b: (b["y0"] <= bands.top * height) & ((b["x0"] <= bands.heading_x * width) | (b["x1"] - b["x0"] >= bands.heading_width * width)))
    return F.slice(F.filter(F.transform(F.flatten(F.transform(inside, lambda b: lines_of(b["text"]))), T.strip), lambda x: x != ""), 1, most)


def latch(df: DataFrame, group: str, order: list[str], name: str, sets: Column, clears: Column, moves: Column | None = None, value: str = "OBS") -> DataFrame:
    """A state per row: ``value`` since the last row that set it, NONE since the last that cleared it or from the start.

    Rows for which ``moves`` is false leave the state as it is.
    """
    event = F.when(clears, F.lit("NONE")).when(sets, F.lit(value))
    if moves is not None:
        event = F.when(moves, event)
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.coalesce(F.last(event, ignorenulls=True).over(w), F.lit("NONE")))


def last_seen(df: DataFrame, group: str, order: list[str], name: str, event: Column, default: str) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.coalesce(F.last(event, ignorenulls=True).over(w), F.lit(default)))


def toc_ranges(pages: DataFrame, scan: int = 20) -> DataFrame:
    """report_id, toc_start, toc_end: the first run of contents pages among 0-based pages 1 .. min(n, scan) - 1.

    pages: report_id, page0, n_pages, toc (boolean). Reports under three pages have none.
    """
    seen = pages.where((F.col("page0") >= 1) & (F.col("page0") < F.least("n_pages", F.lit(scan))) & (F.col("n_pages") >= 3))
    w = Window.partitionBy("report_id").orderBy("page0")
    runs = seen.withColumn("__break", F.sum(F.when(F.col("toc"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("toc")
    per_run = runs.groupBy("report_id", "__break").agg(F.min("page0").alias("a"), F.max("page0").alias("b"))
    return per_run.groupBy("report_id").agg(F.min(F.struct("a", "b")).alias("r")).select("report_id", F.col("r.a").alias("toc_start"), F.col("r.b").alias("toc_end"))


def appendix_starts(pages: DataFrame, p: Patterns = PATTERNS) -> DataFrame:
    """report_id, appendix_start (0-based): the least page number that a line on an appendix gives in the contents, else the first page
    from the third on, not like a table of contents, with an appendix heading.

    pages: report_id, page0, n_pages, toc, toc_start, toc_end (of its report, null for none), raw_text.
    """
    inside = (F.col("page0") >= F.col("toc_start")) & (F.col("page0") <= F.col("toc_end"))
    listed = pages.where(inside).select("report_id", "n_pages", F.explode(lines_of(F.col("raw_text"))).alias("line")).where(has(F.col("line"), p.toc_appendix))
    number = F.regexp_extract("line", r"(\d{1,4})\s*$", 1).try_cast("int")
    from_toc = listed.withColumn("n", number).where((F.col("n") >= 1) & (F.col("n") <= F.col("n_pages"))).groupBy("report_id").agg((F.min("n") - 1).alias("listed"))
    headed = pages.where((F.col("page0") >= 2) & ~F.col("toc") & has(F.col("raw_text"), p.appendix_heading)).groupBy("report_id").agg(F.min("page0").alias("headed"))
    return from_toc.join(headed, "report_id", "full_outer").select("report_id", F.coalesce("listed", "headed").cast("int").alias("appendix_start"))


def hints(page: Column, p: Patterns = PATTERNS) -> Column:
    """A page's text has both strong and weak hints."""
    return has(page, *p.strong) & has(page, *p.weak)


def gate(pages: DataFrame, p: Patterns = PATTERNS) -> DataFrame:
    """pages with obs_state, domain_state, reason and process.

    pages: report_id, page0, n_pages, toc_start, toc_end, appendix_start, heading (BLOCK, OBS, OTHER), domain (ROOF, BUILDING, OTHER), images, layout_ok, and hinted (``hints`` of a page) or else raw_text, which is then sorted with the pages.
    Title, last, contents and appendix pages leave the section latch as it is but move the domain latch; a page without images moves both. Contents are the range found, not any page that
    looks like it.
    """
    contents = (F.col("page0") >= F.col("toc_start")) & (F.col("page0") <= F.col("toc_end"))
    early = F.when(F.col("page0") == 0, "title").when(F.col("page0") == F.col("n_pages") - 1, "last(summary)").when(contents, "toc").when(F.col("page0") >= F.col("appendix_start"), "appendix")
    out = pages.withColumn("__early", early)
    out = latch(out, "report_id", ["page0"], "obs_state", F.col("heading") == "OBS", F.col("heading") == "BLOCK", F.col("__early").isNull())
    out = last_seen(out, "report_id", ["page0"], "domain_state", F.when(F.col("domain") != "OTHER", F.col("domain")), "OTHER")
    hinted = F.col("hinted") if "hinted" in pages.columns else hints(F.col("raw_text"), p)
    stop = (
        F.when(F.col("__early").isNotNull(), F.col("__early"))
        .when(F.col("heading") == "BLOCK", "blocked-heading")
        .when(F.col("images") == 0, "no images")
        .when(~F.col("layout_ok"), "layout-not-left-img_right-text")
        .when((F.col("obs_state") != "OBS") & ~hinted, "outside-OBS: no strong obs context")
        .when(F.col("domain_state") != "ROOF", "blocked-by-domain")
    )
    go = F.when(F.col("obs_state") == "OBS", "in-OBS-section (persistent)").otherwise("outside-OBS: strong-inline+weak-hints")
    return out.withColumn("reason", F.coalesce(stop, go)).withColumn("process", stop.isNull()).drop("__early")


def layout(images: DataFrame, blocks: DataFrame, bands: G.Bands = G.BANDS) -> DataFrame:
    """report_id, page, layout_ok, why of pages with an image or a text: all images together on the left, all texts together on the right, at overlapping heights.

    images, blocks: report_id, page, r (rectangle), pg (page rectangle). Images in the header or footer don't count.
    """
    kept = F.when(~G.in_header_or_footer(F.col("r"), F.col("pg"), bands), F.col("r"))
    left = images.groupBy("report_id", "page").agg(G.union_of(kept).alias("i"), F.first("pg").alias("pg"))
    right = blocks.groupBy("report_id", "page").agg(G.union_of(F.col("r")).alias("t"), F.lit(True).alias("text"))
    both = left.withColumn("image", F.lit(True)).join(right, ["report_id", "page"], "full_outer")
    width = F.col("pg.x1") - F.col("pg.x0")
    fine = ((F.col("i.x0") + F.col("i.x1")) / 2 <= bands.left_column * width) & ((F.col("t.x0") + F.col("t.x1")) / 2 >= bands.right_text * width) & G.overlap_vertically(F.col("i"), F.col("t"))
    why = (
        F.when(F.col("image").isNull() | F.col("text").isNull(), "no image or no text blocks")
        .when(F.col("i").isNull(), "all images were header/footer")
        .when(G.area(F.col("i")) / F.greatest(G.area(F.col("pg")), F.lit(1.0)) < bands.least_union_area, "combined-image-area tiny")
    )
    return both.select("report_id", "page", (why.isNull() & F.coalesce(fine, F.lit(False))).alias("layout_ok"), F.coalesce(why, F.lit("")).alias("why"))


def image_rects(native: DataFrame, fallback: DataFrame, listed: DataFrame) -> DataFrame:
    """report_id, page, ord, xref: native image rectangles, or those of page blocks for pages without any native one.

    A block without a reference of its own takes that of the page's listed image of the same position; rows without any are left out.
    native, fallback: report_id, page, ord, xref; listed: report_id, page, ord, listed_xref.
    """
    blocks = fallback.join(native.select("report_id", "page").distinct(), ["report_id", "page"], "left_anti")
    named = blocks.join(listed, ["report_id", "page", "ord"], "left").select("report_id", "page", "ord", F.coalesce("xref", "listed_xref").alias("xref"))
    return native.select("report_id", "page", "ord", "xref").unionByName(named).where("xref is not null")


def number_images(images: DataFrame, order: str = "ord") -> DataFrame:
    """Saved images with image_index (from 1 per report and page) and image_file."""
    w = Window.partitionBy("report_id", "page").orderBy(order)
    out = images.where("saved").withColumn("image_index", F.row_number().over(w))
    return out.withColumn("image_file", T.image_name(F.col("report_id"), F.col("page"), F.col("image_index")))


def right_text(images: DataFrame, blocks: DataFrame, gutter: float = 14, headroom: float = 60, least_primary: int = 80, least_half: int = 40, margin: float = 18, reach: float = 180, strip: float = 36) -> DataFrame:
    """Text beside each image, by the first strategy that finds enough of it, with its length, the region searched and whether a page footer was dropped.

    primary: blocks right of the image within ``headroom`` points of its height; expanded-vertical: right of it over the whole page; proximity-right-half: the right half
    of the page at most ``reach`` points from the image; else none, with the first region. A block counts in a region that holds over a quarter of it; blocks within ``strip`` points of the
    page's upper or lower end never count. images: report_id, page, image_id, r, pg; blocks: report_id, page, block_no, r, text.
    One equi-join on the page with the geometry as a filter; the blocks of an image are gathered once, in reading order, and each strategy picks its own.
    """
    b = blocks.select("report_id", "page", "block_no", F.col("r").alias("b"), "text")
    near = images.join(b, ["report_id", "page"], "left")
    start = F.least(F.col("pg.x1") - margin, F.greatest(F.col("r.x1") + gutter, F.col("pg.x0") + margin))
    low, high, end = F.col("pg.y0") + margin, F.col("pg.y1") - margin, F.col("pg.x1") - margin
    regions = {
        "primary": G.rect(start, F.greatest(low, F.col("r.y0") - headroom), end, F.least(high, F.col("r.y1") + headroom)),
        "expanded-vertical": G.rect(start, low, end, high),
        "proximity-right-half": G.rect((F.col("pg.x0") + F.col("pg.x1")) / 2, low, end, high),
    }
    middle, centre = (F.col("r.y0") + F.col("r.y1")) / 2, (F.col("b.y0") + F.col("b.y1")) / 2
    close = (F.abs(centre - middle) <= reach) | ((F.col("b.y0") <= F.col("r.y1") + reach) & (F.col("b.y1") >= F.col("r.y0") - reach))
    counts = (F.col("b.y1") > strip) & (F.col("b.y0") < F.col("pg.y1") - strip)
    inside = {k: F.coalesce(counts & (G.covered_share(F.col("b"), F.col(f"r{i}")) > 0.25), F.lit(False)) for i, k in enumerate(regions)}
    inside["proximity-right-half"] &= F.coalesce(close, F.lit(False))
    # Regions, then what lies in them, are projections of their own, so the aggregate gets plain columns.
    near = near.withColumns({f"r{i}": r for i, r in enumerate(regions.values())})
    near = near.withColumns({f"in{i}": x for i, x in enumerate(inside.values())})
    entry = F.struct(F.round("b.y0", 1).alias("y"), F.round("b.x0", 1).alias("x"), F.col("block_no").alias("n"), F.rtrim("text").alias("t"), F.array("in0", "in1", "in2").alias("in"))
    near = near.select("report_id", "page", "image_id", "r0", "r1", "r2", F.when(F.col("in0") | F.col("in1") | F.col("in2"), entry).alias("entry"))
    # Regions are of the image, so they are the same in all rows of a group.
    page = near.groupBy("report_id", "page", "image_id").agg(F.array_sort(F.collect_list("entry")).alias("e"), *[F.first(f"r{i}").alias(f"r{i}") for i in range(3)])
    whole = lambda i: T.strip(F.array_join(F.transform(F.filter("e", lambda e: e["in"][i]), lambda e: e["t"]), "\n"))
    found, enough = page, F.lit(False)
    for i, n in enumerate((least_primary, least_primary, least_half)):  # a strategy's text is made only where those before it found too little
        found = found.withColumn(f"w{i}", F.when(~enough, whole(i))).withColumn(f"t{i}", T.clean_footers(F.col(f"w{i}")))
        found = found.withColumn(f"n{i}", F.coalesce(F.length(f"t{i}"), F.lit(0)))
        enough = enough | (F.col(f"n{i}") >= n)
    least = (least_primary, least_primary, least_half)
    pick = None
    for i, name in enumerate(regions):
        own = F.struct(F.lit(name).alias("strategy"), F.col(f"t{i}").alias("text"), F.col(f"r{i}").alias("region"), (F.col(f"t{i}") != F.col(f"w{i}")).alias("footer_dropped"))
        test = F.col(f"n{i}") >= least[i]
        pick = F.when(test, own) if pick is None else pick.when(test, own)
    nothing = F.struct(F.lit("none").alias("strategy"), F.lit("").alias("text"), F.col("r0").alias("region"), F.lit(False).alias("footer_dropped"))
    out = found.select("report_id", "page", "image_id", pick.otherwise(nothing).alias("s"))
    return out.select("report_id", "page", "image_id", "s.strategy", F.col("s.text").alias("right_text"), F.length("s.text").alias("right_chars"), "s.region", "s.footer_dropped")
