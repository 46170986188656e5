"""Text, key and catalogue queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plinth.functions import similarity as S, text as T
from plinth.operators import catalogue as C
from plinth.plans import sqlgen as Q
from plinth.plans.registry import query, spread, table

SOME_PHRASES = ("drain clogged with debris", "standing water at drain strainer", "remove gravel from drain screen", "membrane blister at seam lap", "vegetation and leaves blocked flow", "open parapet coping", "pipe flashing", "slow drain ponding")
_PHRASES_SQL = "[" + ", ".join(f"'{p}'" for p in SOME_PHRASES) + "]"
#: A text per part with words of the domain, and the same in SQL.
PART_TEXT_SQL = f"(p_name || ' ' || {_PHRASES_SQL}[(p_partkey % {len(SOME_PHRASES)})::INTEGER + 1] || ' ' || p_type)"


def part_text():
    return F.concat_ws(" ", "p_name", F.element_at(F.array(*map(F.lit, SOME_PHRASES)), (F.col("p_partkey") % len(SOME_PHRASES) + 1).cast("int")), "p_type")


def parts_as_catalogue(spark, sf_dir) -> DataFrame:
    raw = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("id"), F.when(F.col("p_size") % 7 == 1, "Other").otherwise(F.concat_ws(" ", "p_name", "p_type")).alias("label"), F.concat((F.col("p_size") % 9).cast("string"), F.lit(".0 "), "p_type").alias("sheet"))
    return C.items(raw)


CATALOGUE_SQL = f"""
raw AS (SELECT p_partkey AS ord, p_brand AS id, CASE WHEN p_size % 7 = 1 THEN 'Other' ELSE p_name || ' ' || p_type END AS label, (p_size % 9)::VARCHAR || '.0 ' || p_type AS sheet FROM part),
items AS (SELECT ord, id, {Q.strip('label')} AS label, {Q.sheet_key('sheet')} AS sheet_key, {Q.strip('sheet')} AS sheet_title, {Q.canon('label')} AS canon FROM raw)"""


@query(f"SELECT doc_id, {Q.canon('text')} AS canon FROM documents")
def canon_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.canon(F.col("text")).alias("canon"))


@query(f"SELECT doc_id, {Q.norm('text')} AS normal FROM documents")
def norm_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.norm(F.col("text")).alias("normal"))


@query(f"SELECT doc_id, {Q.fold_newlines('text')} AS folded FROM documents")
def raw_newline_normalise(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.fold_newlines(F.col("text")).alias("folded"))


@query(f"WITH w AS (SELECT DISTINCT unnest({Q.words(Q.canon(PART_TEXT_SQL))}) AS word FROM part) SELECT word, {Q.singular('word')} AS singular FROM w")
def plural_tokens(spark, sf_dir):
    w = table(spark, sf_dir, "part").select(F.explode(T.words(T.canon(part_text()))).alias("word")).distinct()
    return w.select("word", T.singular(F.col("word")).alias("singular"))


@query("SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(p_name || ' / ' || p_type, '[^\\p{L}\\p{N}.\\-]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'model') AS slug FROM part")
def slugify(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.slug(F.concat_ws(" / ", "p_name", "p_type")).alias("slug"))


@query("SELECT p_partkey, (p_size::VARCHAR || '.' || (p_partkey % 10)::VARCHAR) AS photo_id FROM part")
def photo_id_extract(spark, sf_dir):
    text = F.concat(F.lit("Photograph: "), F.col("p_size").cast("string"), F.lit("."), (F.col("p_partkey") % 10).cast("string"), F.lit(" "), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", T.photo_id(text).alias("photo_id"))


@query("SELECT p_partkey, CASE WHEN p_size % 9 BETWEEN 1 AND 7 THEN (p_size % 9)::VARCHAR || '.0' END AS section FROM part")
def section_line(spark, sf_dir):
    text = F.concat(F.col("p_name"), F.lit("\n"), (F.col("p_size") % 9).cast("string"), F.lit("."), (F.col("p_partkey") % 5).cast("string"), F.lit(" "), "p_type", F.lit("\n"), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", T.section_of_page(text).alias("section"))


@query("SELECT doc_id, source || '-' || (doc_id % 17)::VARCHAR AS report_id FROM documents")
def report_id_stem(spark, sf_dir):
    path = F.concat(F.lit("/data/img.d/"), "source", F.lit("-"), (F.col("doc_id") % 17).cast("string"), F.lit("_page"), F.col("doc_id").cast("string"), F.lit("_img1.png"))
    return table(spark, sf_dir, "documents").select("doc_id", T.report_of_image(path).alias("report_id"))


@query("SELECT p_partkey, p_name AS observation_raw, 'observation' AS label_source, p_size::VARCHAR || '.2' AS photo_id FROM part")
def structured_panel_parse(spark, sf_dir):
    """Panels are written from parts, so what should be parsed from them is known."""
    text = F.concat(F.lit("Photograph "), F.col("p_size").cast("string"), F.lit(".2\nObservation:\n"), "p_name", F.lit("\n\nRecommendation: replace the "), "p_type", F.lit(".\nLocation: "), "p_brand")
    p = table(spark, sf_dir, "part").select("p_partkey", T.panel(text).alias("p"))
    return p.select("p_partkey", "p.observation_raw", "p.label_source", "p.photo_id")


@query(f"SELECT p_partkey, (row_number() OVER (PARTITION BY p_type ORDER BY {Q.natural_key('id')}, p_partkey))::INTEGER AS position FROM (SELECT *, p_size::VARCHAR || '.' || (CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE (p_partkey % 13)::VARCHAR END) AS id FROM part)")
def natural_sort_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "part").withColumn("id", F.concat(F.col("p_size").cast("string"), F.lit("."), F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise((F.col("p_partkey") % 13).cast("string"))))
    return C.natural_order(ids, "p_type", T.id_sort_key(F.col("id")), "p_partkey").select("p_partkey", "position")


@query(f"SELECT p_partkey, (row_number() OVER (PARTITION BY p_type ORDER BY {Q.report_key('id')}, p_partkey))::INTEGER AS position FROM (SELECT *, p_brand || '-' || p_size::VARCHAR AS id FROM part)")
def report_sort_key(spark, sf_dir):
    ids = table(spark, sf_dir, "part").withColumn("id", F.concat_ws("-", "p_brand", F.col("p_size").cast("string")))
    return C.natural_order(ids, "p_type", T.report_sort_key(F.col("id")), "p_partkey").select("p_partkey", "position")


@query("""
WITH a AS (SELECT DISTINCT CASE WHEN p_size % 3 = 0 THEN (p_size % 9)::VARCHAR || '.0' ELSE ' ' || (p_size % 9)::VARCHAR || '.0 ' || p_type END AS sheet FROM part),
t AS (SELECT unnest(['1.0', '2.0', '3.0', '4.0', '5.0', '6.0', '7.0']) AS target),
m AS (SELECT target, sheet, row_number() OVER (PARTITION BY target ORDER BY (lower(trim(sheet)) <> target), sheet) AS r FROM t JOIN a ON starts_with(lower(trim(sheet)), target))
SELECT target, sheet FROM m WHERE r = 1""")
def sheet_pick(spark, sf_dir):
    digit = (F.col("p_size") % 9).cast("string")
    names = table(spark, sf_dir, "part").select(F.when(F.col("p_size") % 3 == 0, F.concat(digit, F.lit(".0"))).otherwise(F.concat(F.lit(" "), digit, F.lit(".0 "), "p_type")).alias("sheet")).distinct()
    return C.pick_sheets(names.withColumn("ord", F.col("sheet")))


@query(f"""WITH {CATALOGUE_SQL}
SELECT sheet_key, arg_max(sheet_title, ord) AS title, arg_max(id, ord) FILTER (canon = 'other') AS other_id, len(list_distinct(list(canon)))::INTEGER AS labels FROM items GROUP BY sheet_key""")
def catalog_maps(spark, sf_dir):
    return C.sheet_maps(parts_as_catalogue(spark, sf_dir)).select("sheet_key", "title", "other_id", F.size("labels").alias("labels"))


@query(f"WITH {CATALOGUE_SQL} SELECT canon, min(ord) AS ord, arg_min(id, ord) AS id, arg_min(label, ord) AS label, arg_min(sheet_key, ord) AS sheet_key FROM items GROUP BY canon")
def catalog_first_by_canon(spark, sf_dir):
    return C.first_by_canon(parts_as_catalogue(spark, sf_dir))


@query(f"WITH {CATALOGUE_SQL} SELECT sheet_key, count(*) AS items FROM items GROUP BY sheet_key")
def catalog_counts(spark, sf_dir):
    return C.counts_by_sheet(parts_as_catalogue(spark, sf_dir))


def _blocks(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumn("own", F.when(F.col("turn") % 3 == 0, F.concat(F.lit("("), F.chr(F.lit(98) + F.col("turn") % 5), F.lit(")"))).otherwise("")).withColumn("label", F.col("text"))
    return C.fill_blocks(rows, "conv_id", "turn", F.col("role") == "user", F.length("text") > 60, ["label"])


_BLOCKS_SQL = """
c AS (SELECT *, CASE WHEN turn % 3 = 0 THEN '(' || chr((98 + turn % 5)::INTEGER) || ')' ELSE '' END AS own, text AS label FROM conversations),
b AS (SELECT *, sum((role = 'user')::INTEGER) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS block FROM c),
f AS (SELECT *, first_value(label) OVER w AS block_label, first_value(length(text) > 60) OVER w AS fine, row_number() OVER w - 1 AS pos FROM b WHERE block > 0 WINDOW w AS (PARTITION BY conv_id, block ORDER BY turn)),
o AS (SELECT conv_id, turn, block::BIGINT AS block, block_label, CASE WHEN own <> '' THEN substring(own, 2, 1) ELSE chr((97 + pos)::INTEGER) END AS letter FROM f WHERE fine)"""


@query(f"WITH {_BLOCKS_SQL} SELECT * FROM o")
def merged_block_fill(spark, sf_dir):
    return _blocks(spark, sf_dir).select("conv_id", "turn", "block", F.col("label").alias("block_label"), C.option_letter(F.col("own"), F.col("block_pos")).alias("letter"))


@query(f"""WITH {_BLOCKS_SQL},
l AS (SELECT conv_id, block_label, letter, min(turn) AS first, max(turn) AS last FROM o GROUP BY ALL)
SELECT conv_id, block_label, string_agg(letter, ',' ORDER BY first, letter) AS letters, string_agg(last::VARCHAR, ',' ORDER BY first, letter) AS last_turns FROM l GROUP BY ALL""")
def catalog_group_options(spark, sf_dir):
    options = _blocks(spark, sf_dir).select("conv_id", F.col("label").alias("block_label"), F.col("turn").alias("seq"), C.option_letter(F.col("own"), F.col("block_pos")).alias("letter"), F.col("turn").cast("string").alias("choice"), F.lit("").alias("text"))
    grouped = C.group_options(options, ["conv_id", "block_label"])
    last = F.transform("choice_order", lambda x: F.try_element_at("recommendations", x)["choice"])
    return grouped.select("conv_id", "block_label", F.array_join("choice_order", ",").alias("letters"), F.array_join(last, ",").alias("last_turns"))


@query(f"WITH {CATALOGUE_SQL} SELECT sha1(string_agg(sha1(concat_ws(chr(31), ord::VARCHAR, id, label, sheet_key)), '' ORDER BY ord)) AS signature FROM items")
def catalog_signature(spark, sf_dir):
    return C.signature(parts_as_catalogue(spark, sf_dir))


@query(f"""WITH g AS (SELECT p_partkey, unnest({Q.char_grams(PART_TEXT_SQL)}) AS gram FROM part) SELECT p_partkey, gram, count(*) AS n FROM g GROUP BY ALL""")
def char_grams(spark, sf_dir):
    parts = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"))
    return S.gram_counts(parts.select("p_partkey", part_text().alias("text")), "p_partkey", "text")


@query("""SELECT conv_id, min(turn) AS first_turn, bool_or(regexp_matches(lower(text), 'id|observation|cause|choice|recommendation|text')) AS headerlike FROM conversations GROUP BY conv_id""")
def header_rows(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(F.min("turn").alias("first_turn"), F.bool_or(C.is_header(F.array("text"))).alias("headerlike"))




@query("""SELECT p_partkey, p_name AS cleaned, p_name || chr(10) || p_type AS lines, 'by ' || p_brand AS rest, p_type AS section, CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 0 END AS number,
CASE WHEN p_partkey % 3 = 0 THEN chr((97 + p_partkey % 26)::INTEGER) END AS letter FROM part""")
def panel_helpers(spark, sf_dir):
    """Texts are written from parts, so what the helpers should find in them is known."""
    p = table(spark, sf_dir, "part")
    footed = F.concat(F.col("p_name"), F.lit("\n  Page 3 of "), F.col("p_size").cast("string"))
    spaced = F.concat(F.lit("\n "), "p_name", F.lit("\n\n  "), "p_type", F.lit(" \n"))
    titled = F.concat(F.lit("Observation:\nx\nCause / Effect:\n"), "p_type", F.lit("\nRecommendation\ny"))
    own = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" ("), F.chr(F.lit(97) + F.col("p_partkey") % 26), F.lit("). "))).otherwise("ab")
    return p.select(
        "p_partkey",
        T.clean_footers(footed).alias("cleaned"),
        T.non_blank_lines(spaced).alias("lines"),
        T.without_first(F.concat(F.upper("p_name"), F.lit(" by "), "p_brand"), F.col("p_name")).alias("rest"),
        T.titled_section(titled).alias("section"),
        T.safe_int(F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).otherwise("n/a")).alias("number"),
        T.letter(own).alias("letter"),
    )


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_name || ' ' || p_type), lower(p_type)) THEN p_name || ' ' || p_type ELSE p_name || ' ' || p_type || ' [SEP] ' || p_type END || ' [SEP] ' || p_brand AS candidate,
p_name || ' ' || p_name || ' ' AS weighted FROM part""")
def candidate_texts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    label = F.concat_ws(" ", "p_name", "p_type")
    return p.select("p_partkey", T.candidate_text(label, F.col("p_type"), F.col("p_brand")).alias("candidate"), T.weighted_pair(F.lit(""), F.col("p_name"), 0, 2).alias("weighted"))
