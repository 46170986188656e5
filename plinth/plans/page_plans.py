"""Geometry and page queries. Image rectangles are derived from lineitem, latch streams from events, pages from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plinth.functions import geometry as G
from plinth.operators import cascade, pages as P
from plinth.plans.registry import query, spread, table
from plinth.sources.staging import staged

WIDTH, HEIGHT = 612.0, 792.0


def page_rect():
    return G.rect(F.lit(0.0), F.lit(0.0), F.lit(WIDTH), F.lit(HEIGHT))


def rects(spark, sf_dir) -> DataFrame:
    """report_id (order), page (1), ord (line number), r, pg."""
    li = table(spark, sf_dir, "lineitem")
    y0 = 50 + F.col("l_orderkey") % 600
    r = G.rect(40 + F.col("l_partkey") % 100, y0, 225 + F.col("l_suppkey") % 150, y0 + 100 + 5 * F.col("l_quantity"))
    return li.select(F.col("l_orderkey").alias("report_id"), F.lit(1).alias("page"), F.col("l_linenumber").alias("ord"), r.alias("r"), page_rect().alias("pg"), "l_returnflag", "l_partkey")


RECTS_SQL = """
rects AS (SELECT l_orderkey AS report_id, l_linenumber AS ord, (40 + l_partkey % 100)::DOUBLE AS x0, (50 + l_orderkey % 600)::DOUBLE AS y0, (225 + l_suppkey % 150)::DOUBLE AS x1,
  50 + l_orderkey % 600 + 100 + 5 * l_quantity AS y1, l_returnflag, l_partkey FROM lineitem)"""
_HF = "(y1 <= 79.2 OR y0 >= 792.0 - 79.2)"
_TINY = "((x1 - x0) * (y1 - y0) / (612.0 * 792.0) < 0.03)"
_KEEP = "(x0 > 40 AND x0 < 125 AND x1 > 225 AND x1 < 350 AND y0 > 50 AND y0 < 600 AND y1 > 200 AND y1 < 760)"


@query(f"WITH {RECTS_SQL} SELECT report_id, ord, {_HF} AS header_footer, {_TINY} AS tiny, {_KEEP} AS keep, concat_ws(', ', CASE WHEN {_HF} THEN 'header/footer' END, CASE WHEN {_TINY} THEN 'tiny' END, CASE WHEN NOT {_KEEP} THEN 'outside window' END) AS reasons FROM rects")
def skip_reasons(spark, sf_dir):
    r, pg = F.col("r"), F.col("pg")
    return rects(spark, sf_dir).select("report_id", "ord", G.in_header_or_footer(r, pg).alias("header_footer"), G.is_tiny(r, pg).alias("tiny"), G.in_keep_window(r).alias("keep"), G.skip_reasons(r, pg).alias("reasons"))


@query(f"WITH {RECTS_SQL} SELECT report_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM rects GROUP BY report_id")
def rect_union(spark, sf_dir):
    u = rects(spark, sf_dir).groupBy("report_id").agg(G.union_of(F.col("r")).alias("u"))
    return u.select("report_id", "u.x0", "u.y0", "u.x1", "u.y1")


@query(f"""WITH {RECTS_SQL}
SELECT a.report_id, a.ord AS a_ord, b.ord AS b_ord, round((least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)), 4) AS common
FROM rects a JOIN rects b ON a.report_id = b.report_id AND a.ord < b.ord
WHERE least(a.x1, b.x1) > greatest(a.x0, b.x0) AND least(a.y1, b.y1) > greatest(a.y0, b.y0)""")
def rect_overlap_join(spark, sf_dir):
    r = rects(spark, sf_dir)
    a, b = r.select("report_id", F.col("ord").alias("a_ord"), F.col("r").alias("a")), r.select("report_id", F.col("ord").alias("b_ord"), F.col("r").alias("b"))
    both = a.join(b, "report_id").where("a_ord < b_ord").withColumn("i", G.intersection(F.col("a"), F.col("b"))).where("i is not null")
    return both.select("report_id", "a_ord", "b_ord", F.round(G.area(F.col("i")), 4).alias("common"))


@query(f"""WITH {RECTS_SQL},
i AS (SELECT report_id, min(x0) FILTER (NOT {_HF}) AS x0, min(y0) FILTER (NOT {_HF}) AS y0, max(x1) FILTER (NOT {_HF}) AS x1, max(y1) FILTER (NOT {_HF}) AS y1, 1 AS has FROM rects WHERE ord % 2 = 1 GROUP BY report_id),
t AS (SELECT report_id, min(x0 + 120) AS tx0, max(x1 + 120) AS tx1, min(y0) AS ty0, max(y1) AS ty1, 1 AS has_text FROM rects WHERE ord % 2 = 0 GROUP BY report_id),
w AS (SELECT *, CASE WHEN has IS NULL OR has_text IS NULL THEN 'no image or no text blocks' WHEN x0 IS NULL THEN 'all images were header/footer' WHEN (x1 - x0) * (y1 - y0) / (612.0 * 792.0) < 0.04 THEN 'combined-image-area tiny' ELSE '' END AS why FROM i FULL JOIN t USING (report_id))
SELECT report_id, why = '' AND coalesce((x0 + x1) / 2 <= 0.6 * 612 AND (tx0 + tx1) / 2 >= 0.38 * 612 AND NOT (y1 <= ty0 OR ty1 <= y0), false) AS layout_ok, why FROM w""")
def layout_check(spark, sf_dir):
    r = rects(spark, sf_dir)
    shifted = G.rect(F.col("r.x0") + 120, F.col("r.y0"), F.col("r.x1") + 120, F.col("r.y1"))
    return P.layout(r.where("ord % 2 = 1"), r.where("ord % 2 = 0").withColumn("r", shifted)).select("report_id", "layout_ok", "why")


@query(f"""WITH {RECTS_SQL},
p AS (SELECT *, CASE WHEN ord % 3 = 0 THEN NULL ELSE x1 + 14 END AS rx0, greatest(18, y0 - 60) AS ry0, least(774, y1 + 60) AS ry1 FROM rects),
q AS (SELECT *, CASE WHEN rx0 IS NULL THEN y0 ELSE ry0 END AS top, CASE WHEN rx0 IS NULL THEN y1 ELSE ry1 END AS bottom FROM p),
s AS (SELECT *, greatest(0.0, least(1.0, (CASE WHEN rx0 IS NULL THEN 0.10 ELSE 0.35 END) + least(0.25, 0.25 * greatest(0.0, least(y1, bottom) - greatest(y0, top)) / greatest(1.0, y1 - y0)) + (CASE WHEN ord % 2 = 0 THEN 0.15 ELSE 0.0 END)
  - ((CASE WHEN top < 90 THEN 0.15 ELSE 0.0 END) + (CASE WHEN 792 - bottom < 80 THEN 0.15 ELSE 0.0 END) + (CASE WHEN rx0 IS NOT NULL AND 594 - rx0 < 80 THEN 0.10 ELSE 0.0 END)))) AS score FROM q)
SELECT report_id, ord, round(score, 6) AS confidence_linkage, round(score, 6) < 0.35 AS low FROM s""")
def linkage_score(spark, sf_dir):
    r = rects(spark, sf_dir)
    region = F.when(F.col("ord") % 3 != 0, G.rect(F.col("r.x1") + 14, F.greatest(F.lit(18.0), F.col("r.y0") - 60), F.lit(594.0), F.least(F.lit(774.0), F.col("r.y1") + 60)))
    out = r.select("report_id", "ord", cascade.linkage_of(F.col("r"), region, F.lit(HEIGHT), F.col("ord") % 2 == 0).alias("l"))
    return out.select("report_id", "ord", "l.confidence_linkage", "l.low")


@query(f"""WITH {RECTS_SQL} SELECT report_id, ord, (row_number() OVER (PARTITION BY report_id ORDER BY ord))::INTEGER AS image_index, report_id::VARCHAR || '_page1_img' || row_number() OVER (PARTITION BY report_id ORDER BY ord)::VARCHAR || '.png' AS image_file FROM rects WHERE l_returnflag <> 'R'""")
def image_index(spark, sf_dir):
    r = rects(spark, sf_dir).withColumn("saved", F.col("l_returnflag") != "R").withColumn("report_id", F.col("report_id").cast("string"))
    return P.number_images(r).select(F.col("report_id").cast("long").alias("report_id"), "ord", "image_index", "image_file")


NEAR_SQL = r"""
u AS (SELECT report_id, ord, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, min(l_partkey) AS l_partkey FROM rects GROUP BY report_id, ord),
b AS (SELECT r.report_id, r.ord AS block_no, x0 + 250 AS bx0, y0 + (ord - 3) * 40 AS by0, x0 + 450 AS bx1, y0 + (ord - 3) * 40 + 60 AS by1, CASE WHEN p_partkey % 3 = 0 THEN 'Photograph 1.' || (p_partkey % 9)::VARCHAR || ' Observation: ' ELSE '' END || p_name || chr(10) || 'Page 3 of ' || p_size::VARCHAR || chr(10) || repeat(p_type || ' ', 3) AS text FROM u r JOIN part ON l_partkey = p_partkey),
n AS (SELECT i.report_id, i.ord, i.x0, i.y0, i.x1, i.y1, least(594.0, greatest(i.x1 + 14, 18.0)) AS gx, greatest(18.0, i.y0 - 60) AS a_top, least(774.0, i.y1 + 60) AS a_bottom, b.* EXCLUDE (report_id), (i.y0 + i.y1) / 2 AS mid FROM u i LEFT JOIN b ON i.report_id = b.report_id),
c AS (SELECT *, by1 > 36 AND by0 < 792 - 36 AS counts, greatest(0, least(bx1, 594) - greatest(bx0, gx)) AS wide, greatest(0, least(bx1, 594) - greatest(bx0, 306)) AS half, greatest(0, least(by1, 774) - greatest(by0, 18)) AS tall, greatest(0, least(by1, a_bottom) - greatest(by0, a_top)) AS near, (bx1 - bx0) * (by1 - by0) AS size FROM n),
f AS (SELECT *, counts AND wide * near / size > 0.25 AS in_a, counts AND wide * tall / size > 0.25 AS in_b, counts AND half * tall / size > 0.25 AND (abs((by0 + by1) / 2 - mid) <= 180 OR (by0 <= y1 + 180 AND by1 >= y0 - 180)) AS in_c FROM c),
w AS (SELECT report_id, ord, any_value(gx) AS gx, any_value(a_top) AS a_top, any_value(a_bottom) AS a_bottom,
  coalesce(trim(string_agg(rtrim(text), chr(10) ORDER BY round(by0, 1), round(bx0, 1), block_no) FILTER (in_a)), '') AS wa,
  coalesce(trim(string_agg(rtrim(text), chr(10) ORDER BY round(by0, 1), round(bx0, 1), block_no) FILTER (in_b)), '') AS wb,
  coalesce(trim(string_agg(rtrim(text), chr(10) ORDER BY round(by0, 1), round(bx0, 1), block_no) FILTER (in_c)), '') AS wc FROM f GROUP BY report_id, ord),
k AS (SELECT *, array_to_string(list_filter(string_split(wa, chr(10)), lambda x: NOT regexp_matches(x, '(?i)^\s*page\s+\d+\s+of\s+\d+\s*$')), chr(10)) AS a,
  array_to_string(list_filter(string_split(wb, chr(10)), lambda x: NOT regexp_matches(x, '(?i)^\s*page\s+\d+\s+of\s+\d+\s*$')), chr(10)) AS b,
  array_to_string(list_filter(string_split(wc, chr(10)), lambda x: NOT regexp_matches(x, '(?i)^\s*page\s+\d+\s+of\s+\d+\s*$')), chr(10)) AS c FROM w),
s AS (SELECT *, CASE WHEN length(a) >= 80 THEN 'primary' WHEN length(b) >= 80 THEN 'expanded-vertical' WHEN length(c) >= 40 THEN 'proximity-right-half' ELSE 'none' END AS strategy FROM k)"""


@query(f"""WITH {RECTS_SQL}, {NEAR_SQL}
SELECT report_id, ord, strategy, CASE strategy WHEN 'primary' THEN a WHEN 'expanded-vertical' THEN b WHEN 'proximity-right-half' THEN c ELSE '' END AS right_text,
CASE strategy WHEN 'primary' THEN a <> wa WHEN 'expanded-vertical' THEN b <> wb WHEN 'proximity-right-half' THEN c <> wc ELSE false END AS footer_dropped,
CASE strategy WHEN 'proximity-right-half' THEN 306.0 ELSE gx END AS region_x0, CASE WHEN strategy IN ('primary', 'none') THEN a_top ELSE 18.0 END AS region_y0, CASE WHEN strategy IN ('primary', 'none') THEN a_bottom ELSE 774.0 END AS region_y1 FROM s""")
def right_text_cascade(spark, sf_dir):
    images, blocks = images_and_blocks(spark, sf_dir)
    found = P.right_text(images, blocks)
    return found.select("report_id", F.col("image_id").alias("ord"), "strategy", "right_text", "footer_dropped", F.col("region.x0").alias("region_x0"), F.col("region.y0").alias("region_y0"), F.col("region.y1").alias("region_y1"))


def images_and_blocks(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Each order is a page; its lines (those of one number together) are images with a text block of the line's part beside them."""
    r = rects(spark, sf_dir).groupBy("report_id", "page", "ord").agg(G.union_of(F.col("r")).alias("r"), F.min("l_partkey").alias("l_partkey")).withColumn("pg", page_rect())
    before = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Photograph 1."), (F.col("p_partkey") % 9).cast("string"), F.lit(" Observation: "))).otherwise("")
    text = F.concat(before, F.col("p_name"), F.lit("\nPage 3 of "), F.col("p_size").cast("string"), F.lit("\n"), F.repeat(F.concat("p_type", F.lit(" ")), F.lit(3)))
    p = table(spark, sf_dir, "part").select("p_partkey", text.alias("text"))
    y = F.col("r.y0") + (F.col("ord") - 3) * 40
    blocks = r.join(p, F.col("l_partkey") == F.col("p_partkey")).select("report_id", "page", F.col("ord").alias("block_no"), G.rect(F.col("r.x0") + 250, y, F.col("r.x0") + 450, y + 60).alias("r"), "text")
    return r.select("report_id", "page", F.col("ord").alias("image_id"), "r", "pg"), blocks


#: What the texts of documents begin with here, so that headings occur: a third of them only look like one. Fixed values.
TOPS = (
    "1.1 Observations and Recommendations",
    "Executive Summary",
    "Roof Composition",
    "Site overview",
    "Deficiencies recommendations",
    "North elevation",
    "Roof area 4",
    "Photo 3 leak",
    "Existing conditions",
    "  Observation:",
    "2.10.3 summary recommendations",
    "Summaryless leakage photosynthesis",
    "Canopying roof areas 4",
    "Conclusion",
    "overview of observations",
    "see observations & recommendations",
    "Roof section 2\nroof section 3\nRoof  section 4",
    "Photographs of deterioration",
)
_TOPS_SQL = "[" + ", ".join("'" + t.replace("\n", "' || chr(10) || '") + "'" for t in TOPS) + "]"
_TOP = f"{_TOPS_SQL}[(doc_id % {len(TOPS)})::INTEGER + 1]"


def top_of(c):
    return F.element_at(F.array(*map(F.lit, TOPS)), (c % len(TOPS) + 1).cast("int"))


#: The same vocabularies once more, as SQL; they don't come from the operators. Fixed values.
_SUMMARY = r"(?mi)^\s*(?:\d+(?:\.\d+)*)?\s*summary\s*(?:&|and)?\s*recommendations\b|^\s*executive\s+summary\b|^\s*overall\s+condition\b|^\s*conclusions?\b|^\s*summary\b"
_BLOCKED = r"(?mi)^\s*condition\s+assessment\b|^\s*roof\s+condition\s+assessment\b|^\s*existing\s+conditions\b|^\s*roof\s+system\s+description\b|^\s*roof\s+composition\b"
_SEEN = (
    r"(?mi)^\s*(?:\d+(?:\.\d+)*)?\s*observations?\s*(?:&|and)\s*recommendations?\b",
    r"(?mi)^\s*deficienc(?:y|ies)\s*(?:&|and)?\s*recommendations?\b",
    r"(?mi)^\s*observations?\b",
    r"(?mi)^\s*deficienc(?:y|ies)\b",
    r"(?mi)^\s*recommendations?\b",
    r"(?i)\bobservations?\s*(?:&|and)\s*recommendations?\b",
    r"(?i)\bdeficienc(?:y|ies)\s*(?:&|and)?\s*recommendations?\b",
)
_STRONG = r"(?i)\bobservations?\b|\bdeficienc(?:y|ies)\b|\brecommendations?\b|\bdeterioration\b|\bleak\b"
_WEAK = r"(?mi)\bphotographs?\b|\bphotos?\b|\bfigures?\b|^\s*item\s+\d+\b|^\s*section\s+\d+\b|\broof\s*(?:area|section)\s+\d+\b"
_ROOF = r"(?mi)^\s*roof\s+assessment\b|^\s*roof\s+(?:area|section)\s+\d+\b|^\s*canopy\b|^\s*roof\s+plan\b"
_BUILDING = r"(?mi)^\s*building\s+envelope\b|^\s*(?:north|south|east|west)\s+elevation\b|^\s*fa[çc]ade\b|^\s*wall\s+assembly\b"
_LINES = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def _head_sql(frm: str) -> str:
    """heading, why and domain of rows with raw_text: the top lines are its first 14 that aren't blank."""
    strip = lambda c: f"regexp_replace({c}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"
    seen = ", ".join(f"nullif(regexp_extract(top, '{rx}', 0), '')" for rx in _SEEN)
    return f"""
ht AS (SELECT *, list_filter(list_transform(regexp_split_to_array(raw_text, '{_LINES}'), lambda x: {strip('x')}), lambda x: x <> '')[1:14] AS tops FROM {frm}),
hv AS (SELECT *, array_to_string(tops, chr(10)) AS top, list_filter(tops, lambda x: regexp_matches(x, '(?i)\\boverview\\b') AND NOT regexp_matches(x, '(?i)observations?|deficienc(?:y|ies)|recommendations?'))[1] AS overview FROM ht),
hw AS (SELECT *, CASE WHEN regexp_matches(raw_text, '{_SUMMARY}') THEN 'summary heading' WHEN regexp_matches(top, '{_BLOCKED}') THEN 'blocked heading (strict)' WHEN overview IS NOT NULL THEN 'overview line: ' || overview END AS blocked, coalesce({seen}) AS seen FROM hv),
hd AS (SELECT *, CASE WHEN blocked IS NOT NULL THEN 'BLOCK' WHEN seen IS NOT NULL THEN 'OBS' ELSE 'OTHER' END AS heading, coalesce(blocked, {strip('seen')}, '') AS why,
  CASE WHEN regexp_matches(top, '{_ROOF}') THEN 'ROOF' WHEN regexp_matches(top, '{_BUILDING}') THEN 'BUILDING' ELSE 'OTHER' END AS domain FROM hw)"""


def first_lines(text, most: int = 14):
    """The first lines of a text that aren't blank: those of a page that is one block over its whole width."""
    return P.top_lines(F.array(F.struct(*[F.lit(v).alias(n) for n, v in (("x0", 0.0), ("y0", 0.0), ("x1", WIDTH), ("y1", HEIGHT))], text.alias("text"))), F.lit(WIDTH), F.lit(HEIGHT), most)


@query(f"WITH d AS (SELECT doc_id, {_TOP} || chr(10) || text AS raw_text FROM documents), {_head_sql('d')} SELECT doc_id, heading, why, domain FROM hd")
def heading_class(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents")).select("doc_id", F.concat(top_of(F.col("doc_id")), F.lit("\n"), "text").alias("raw_text"))
    d = d.withColumn("top", first_lines(F.col("raw_text")))
    return d.select("doc_id", P.heading(F.col("top"), F.col("raw_text")).alias("h"), P.domain_class(F.col("top")).alias("domain")).select("doc_id", F.col("h.class").alias("heading"), "h.why", "domain")


PAGES_OF_A_REPORT = 500  # ids
_TOC_HIT = r".{3,}(?:\.{2,}|\s{2,})\s+\d{1,4}\s*$"
_PAGED_SQL = rf"""
d AS (SELECT *, source || '-' || (doc_id // {PAGES_OF_A_REPORT})::VARCHAR AS report_id FROM documents),
e AS (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY doc_id) - 1 AS page0, count(*) OVER (PARTITION BY report_id) AS n_pages FROM d),
g AS (SELECT *, CASE WHEN doc_id % 37 = 0 THEN ' Contents ' || chr(10) ELSE {_TOP} || CASE WHEN page0 IN (1, 2) THEN repeat(chr(10) || 'Section on seams .....  ' || (doc_id % 90 + 1)::VARCHAR, 7) || chr(10) || 'Appendix list ....  ' || (doc_id % 40)::VARCHAR ELSE '' END
  || CASE WHEN doc_id % 11 = 0 THEN chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'Appendix B' ELSE 'APPENDIX' END ELSE '' END || chr(10) || text END AS raw_text FROM e),
l AS (SELECT *, regexp_split_to_array(raw_text, '{_LINES}') AS lines FROM g),
m AS (SELECT *, list_filter(lines, lambda x: trim(x) <> '') AS full_lines FROM l),
c AS (SELECT *, len(list_filter(full_lines, lambda x: regexp_matches(x, '{_TOC_HIT}'))) AS dotted FROM m),
paged AS (SELECT *, len(full_lines) > 0 AND (regexp_matches(raw_text, '(?i)\btable of contents\b|^\s*contents\s*$') OR len(list_filter(full_lines, lambda x: regexp_matches(x, '(?i)\broof section\s+\d+\b'))) >= 3
  OR len(list_filter(full_lines, lambda x: regexp_matches(x, '^\s{{4,}}\S'))) >= 3 OR dotted >= 6 OR dotted / greatest(len(full_lines), 1)::DOUBLE >= 0.3) AS toc FROM c),
ts AS (SELECT * FROM paged WHERE page0 >= 1 AND page0 < least(n_pages, 20) AND n_pages >= 3),
tr AS (SELECT *, sum(CASE WHEN toc THEN 0 ELSE 1 END) OVER (PARTITION BY report_id ORDER BY page0 ROWS UNBOUNDED PRECEDING) AS brk FROM ts),
tg AS (SELECT report_id, brk, min(page0) AS a, max(page0) AS b FROM tr WHERE toc GROUP BY ALL),
toc AS (SELECT report_id, min(a)::INTEGER AS toc_start, arg_min(b, a)::INTEGER AS toc_end FROM tg GROUP BY report_id),
al AS (SELECT report_id, n_pages, unnest(lines) AS line FROM paged JOIN toc USING (report_id) WHERE page0 BETWEEN toc_start AND toc_end),
an AS (SELECT report_id, n_pages, try_cast(regexp_extract(line, '(\d{{1,4}})\s*$', 1) AS INTEGER) AS n FROM al WHERE regexp_matches(line, '(?i)\bappendix\b')),
af AS (SELECT report_id, min(n) - 1 AS listed FROM an WHERE n BETWEEN 1 AND n_pages GROUP BY report_id),
ah AS (SELECT report_id, min(page0) AS headed FROM paged WHERE page0 >= 2 AND NOT toc AND regexp_matches(raw_text, '(?mi)^\s*appendix(?:\s+[A-Z0-9]+)?\b') GROUP BY report_id),
ap AS (SELECT report_id, coalesce(listed, headed)::INTEGER AS appendix_start FROM af FULL JOIN ah USING (report_id))"""


def paged(spark, sf_dir, judged: bool = False) -> DataFrame:
    """Documents as pages of reports (a source's documents within a range of ids), with headings, contents and appendix lines before their texts. judged: with what the gate takes from a text."""
    d = spread(table(spark, sf_dir, "documents")).select("doc_id", "text", F.concat_ws("-", "source", F.floor(F.col("doc_id") / PAGES_OF_A_REPORT).cast("string")).alias("report_id"))
    w = Window.partitionBy("report_id")
    numbers = d.select("report_id", "doc_id").withColumns({"page0": (F.row_number().over(w.orderBy("doc_id")) - 1).cast("int"), "n_pages": F.count("*").over(w)})  # without texts
    out = d.join(numbers, ["report_id", "doc_id"])
    contents = F.concat(F.repeat(F.concat(F.lit("\nSection on seams .....  "), (F.col("doc_id") % 90 + 1).cast("string")), F.lit(7)), F.lit("\nAppendix list ....  "), (F.col("doc_id") % 40).cast("string"))
    appendix = F.when(F.col("doc_id") % 11 == 0, F.when(F.col("doc_id") % 2 == 0, "\nAppendix B").otherwise("\nAPPENDIX")).otherwise("")
    raw = F.when(F.col("doc_id") % 37 == 0, " Contents \n").otherwise(F.concat(top_of(F.col("doc_id")), F.when(F.col("page0").isin(1, 2), contents).otherwise(""), appendix, F.lit("\n"), "text"))
    # lines are made once, in a projection of their own
    out = out.select("report_id", "doc_id", "page0", "n_pages", raw.alias("raw_text")).withColumn("lines", P.full_lines(F.col("raw_text"))).withColumn("toc", P.toc_like(F.col("raw_text"), lines=F.col("lines"))).drop("lines")
    if judged:
        text = F.col("raw_text")
        out = out.withColumn("top", first_lines(text)).withColumns({"heading": P.heading(F.col("top"), text)["class"], "domain": P.domain_class(F.col("top")), "hinted": P.hints(text)}).drop("top")
    return staged(out, "pages")


def ranged(pages: DataFrame) -> DataFrame:
    return pages.join(P.toc_ranges(pages), "report_id", "left")


@query(f"WITH {_PAGED_SQL} SELECT doc_id, toc FROM paged")
def toc_like(spark, sf_dir):
    return paged(spark, sf_dir).select("doc_id", "toc")


@query(f"WITH {_PAGED_SQL} SELECT * FROM toc")
def toc_range(spark, sf_dir):
    return P.toc_ranges(paged(spark, sf_dir))


@query(f"WITH {_PAGED_SQL} SELECT report_id, appendix_start FROM ap")
def appendix_start(spark, sf_dir):
    return P.appendix_starts(ranged(paged(spark, sf_dir)))


_GATE_SQL = f"""{_PAGED_SQL}, {_head_sql('paged')},
j AS (SELECT hd.*, toc_start, toc_end, appendix_start FROM hd LEFT JOIN toc USING (report_id) LEFT JOIN ap USING (report_id)),
o AS (SELECT *, CASE WHEN page0 = 0 THEN 'title' WHEN page0 = n_pages - 1 THEN 'last(summary)' WHEN page0 BETWEEN toc_start AND toc_end THEN 'toc' WHEN page0 >= appendix_start THEN 'appendix' END AS early FROM j),
st AS (SELECT *, coalesce(last_value(CASE WHEN early IS NULL THEN CASE heading WHEN 'BLOCK' THEN 'NONE' WHEN 'OBS' THEN 'OBS' END END IGNORE NULLS) OVER w, 'NONE') AS obs_state,
  coalesce(last_value(CASE WHEN domain <> 'OTHER' THEN domain END IGNORE NULLS) OVER w, 'OTHER') AS domain_state FROM o WINDOW w AS (PARTITION BY report_id ORDER BY page0 ROWS UNBOUNDED PRECEDING))"""


@query(f"""WITH {_GATE_SQL}
SELECT doc_id, obs_state, domain_state, coalesce(early, CASE WHEN heading = 'BLOCK' THEN 'blocked-heading' WHEN doc_id % 5 = 0 THEN 'no images' WHEN doc_id % 7 = 0 THEN 'layout-not-left-img_right-text'
  WHEN obs_state <> 'OBS' AND NOT (regexp_matches(raw_text, '{_STRONG}') AND regexp_matches(raw_text, '{_WEAK}')) THEN 'outside-OBS: no strong obs context'
  WHEN domain_state <> 'ROOF' THEN 'blocked-by-domain' WHEN obs_state = 'OBS' THEN 'in-OBS-section (persistent)' ELSE 'outside-OBS: strong-inline+weak-hints' END) AS reason FROM st""")
def page_gate(spark, sf_dir):
    return gated(spark, sf_dir).select("doc_id", "obs_state", "domain_state", "reason")


def gated(spark, sf_dir) -> DataFrame:
    p = ranged(paged(spark, sf_dir, judged=True))
    rows = p.drop("raw_text").join(P.appendix_starts(p), "report_id", "left").withColumns({"images": (F.col("doc_id") % 5).cast("int"), "layout_ok": F.col("doc_id") % 7 != 0})
    return P.gate(rows)


@query("""SELECT event_id, coalesce(last_value(CASE event_type WHEN 'error' THEN 'NONE' WHEN 'signup' THEN 'OBS' END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 'NONE') AS state FROM events""")
def obs_latch(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return P.latch(e, "user_id", ["ts", "event_id"], "state", F.col("event_type") == "signup", F.col("event_type") == "error").select("event_id", "state")


@query("""SELECT event_id, coalesce(last_value(CASE event_type WHEN 'click' THEN 'ROOF' WHEN 'purchase' THEN 'BUILDING' END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 'OTHER') AS domain FROM events""")
def domain_latch(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "click", "ROOF").when(F.col("event_type") == "purchase", "BUILDING")
    return P.last_seen(e, "user_id", ["ts", "event_id"], "domain", kind, "OTHER").select("event_id", "domain")


@query("""WITH n AS (SELECT l_orderkey AS report_id, 1 AS page, l_linenumber AS ord, l_partkey AS xref FROM lineitem WHERE l_returnflag = 'N'),
f AS (SELECT l_orderkey AS report_id, 1 AS page, l_linenumber AS ord, max(CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END) AS xref, max(CASE WHEN l_linenumber % 3 = 0 THEN l_suppkey END) AS listed FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL)
SELECT * FROM n UNION ALL SELECT report_id, page, ord, coalesce(xref, listed) FROM f WHERE coalesce(xref, listed) IS NOT NULL AND report_id NOT IN (SELECT report_id FROM n)""")
def image_rects_fallback(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("report_id"), F.lit(1).alias("page"), F.col("l_linenumber").alias("ord"), "l_partkey", "l_suppkey", "l_returnflag")
    native = li.where("l_returnflag = 'N'").withColumn("xref", F.col("l_partkey"))
    rest = li.where("l_returnflag <> 'N'").groupBy("report_id", "page", "ord").agg(F.max("l_partkey").alias("l_partkey"), F.max("l_suppkey").alias("l_suppkey"))
    listed = rest.where("ord % 3 = 0").select("report_id", "page", "ord", F.col("l_suppkey").alias("listed_xref"))
    return P.image_rects(native, rest.select("report_id", "page", "ord", F.when(F.col("ord") % 2 == 0, F.col("l_partkey")).alias("xref")), listed)


@query(f"""WITH {RECTS_SQL}, b AS (SELECT report_id, ord, x0, x1, y0, y1, string_split(p_name || chr(10) || ' ' || chr(10) || p_type, chr(10)) AS lines FROM rects JOIN part ON l_partkey = p_partkey),
l AS (SELECT report_id, ord, x0, y0, x1, y1, list_filter(list_transform(lines, lambda x: trim(x)), lambda x: x <> '') AS lines FROM b WHERE y0 <= 0.3 * 792.0 AND (x0 <= 0.45 * 612.0 OR x1 - x0 >= 0.6 * 612.0))
SELECT report_id, array_to_string(flatten(list(lines ORDER BY ord, x0, y0, x1, y1, lines))[1:14], '|') AS top FROM l GROUP BY report_id""")
def top_heading_lines(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit("\n \n"), "p_type").alias("text"))
    rows = rects(spark, sf_dir).join(p, F.col("l_partkey") == F.col("p_partkey"))
    block = F.struct("ord", *[F.col(f"r.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")], "text")
    per_page = rows.groupBy("report_id").agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    top = P.top_lines(F.col("blocks"), F.lit(WIDTH), F.lit(HEIGHT))
    return per_page.select("report_id", F.array_join(top, "|").alias("top")).where("top <> ''")
