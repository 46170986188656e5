"""The record table: one row per kept image, with its text, label and confidences, in the order of the main output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plinth.functions import geometry as G, text as T
from plinth.operators import cascade as K, pages as P
from plinth.sources.staging import staged

COLUMNS = (
    "report_id page image_index image_file x0 x1 y0 y1 page_width page_height right_text_blocks_used right_text_raw right_text_strategy right_text_chars right_region right_footer_dropped "
    "observation_raw discussion_or_description label_source photo_id observation_label observation_id confidence_label confidence_linkage flag_review flag_reason label_method label_method_info "
    "alt1_label alt1_score alt2_label alt2_score section dx dy rtx0 rty0 rtx1 rty1 rtdx rtdy"
).split()
LOW_LINKAGE = 0.35


def kept_images(images: DataFrame, pages: DataFrame) -> DataFrame:
    """The images of processed pages that pass all geometric tests and could be saved, numbered per page.

    images: report_id, page, ord, r, pg, saved; pages: report_id, page, process.
    """
    fine = images.where(G.skip_reasons(F.col("r"), F.col("pg")) == "").join(pages.where("process").select("report_id", "page"), ["report_id", "page"], "left_semi")
    return P.number_images(fine)


def headed(text: Column) -> Column:
    """A text that is nothing but a heading of observations, discussion or recommendations."""
    return F.coalesce(text.rlike(r"(?i)^\s*(?:observations?|discussion|description|recommendations?)\s*:?\s*$"), F.lit(False))


def records(images: DataFrame, blocks: DataFrame, pages: DataFrame, items: DataFrame, maps: DataFrame, semantic: DataFrame | None = None, cfg: K.CascadeConfig = K.CONFIG) -> DataFrame:
    """The 41 columns of each kept image.

    images: as kept_images; blocks: report_id, page, block_no, r, text; pages: report_id, page, process, raw_text; items, maps: of the catalogue. An image is q = image_file in ``semantic``.
    """
    kept = staged(kept_images(images, pages), "kept")
    beside = P.right_text(kept.select("report_id", "page", F.col("image_index").alias("image_id"), "r", "pg"), blocks)
    rows = kept.join(beside.withColumnRenamed("image_id", "image_index"), ["report_id", "page", "image_index"]).join(pages.select("report_id", "page", F.col("raw_text").alias("page_text")), ["report_id", "page"])
    rows = rows.withColumns({"p": T.panel(F.col("right_text")), "section": T.section_of_page(F.col("page_text"))})
    rows = staged(rows.select("report_id", "page", "image_index", "image_file", "r", "pg", "strategy", "right_chars", "region", "footer_dropped", "section", "page_text", "p.*"), "beside")
    labels = K.label(rows.select(F.col("image_file").alias("q"), "observation_raw", "label_source", "panel_raw", "section", "page_text"), items, maps, semantic, cfg)
    out = rows.join(labels, rows.image_file == labels.q)
    height = F.col("pg.y1") - F.col("pg.y0")
    out = out.withColumn("linkage", K.linkage_of(F.col("r"), F.col("region"), height, headed(F.col("raw_right_text"))))
    low = F.col("linkage.low")
    reasons = F.concat_ws("; ", F.nullif("flag_reason", F.lit("")), F.when(low, F.concat(F.lit("Low linkage confidence ("), T.fixed(F.col("linkage.confidence_linkage"), 2), F.lit(")"))))
    region = F.col("region")
    shown = F.concat(F.lit("("), F.concat_ws(", ", *[region[c].cast("string") for c in ("x0", "y0", "x1", "y1")]), F.lit(")"))
    new = {
        **{c: F.col(f"r.{c}") for c in ("x0", "x1", "y0", "y1")},
        "page_width": F.col("pg.x1") - F.col("pg.x0"),
        "page_height": height,
        "right_text_blocks_used": F.lit(None).cast("int"),
        "right_text_raw": F.col("raw_right_text"),
        "right_text_strategy": F.col("strategy"),
        "right_text_chars": F.col("right_chars"),
        "right_region": shown,
        "right_footer_dropped": F.when(F.col("footer_dropped"), "1").otherwise("0"),
        "discussion_or_description": F.lit(""),
        "observation_label": F.col("label"),
        "confidence_label": F.round("confidence_label", 3),
        "confidence_linkage": F.round("linkage.confidence_linkage", 3),
        "flag_review": F.col("flag_review") | low,
        "flag_reason": reasons,
        "dx": F.col("r.x1") - F.col("r.x0"),
        "dy": F.col("r.y1") - F.col("r.y0"),
        **{f"rt{c}": region[c] for c in ("x0", "y0", "x1", "y1")},
        "rtdx": region["x1"] - region["x0"],
        "rtdy": region["y1"] - region["y0"],
    }
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in COLUMNS])
