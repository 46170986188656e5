"""Rectangles as column expressions. A rectangle is a struct (x0, y0, x1, y1) of doubles in page points."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Bands:
    """Page geometry. Fixed values."""

    header: float = 0.10
    footer: float = 0.10
    least_image_area: float = 0.03
    left_column: float = 0.60
    right_text: float = 0.38
    least_union_area: float = 0.04
    top: float = 0.30
    heading_x: float = 0.45
    heading_width: float = 0.60
    keep_x0: tuple[float, float] = (40.0, 125.0)
    keep_x1: tuple[float, float] = (225.0, 350.0)
    keep_y0: tuple[float, float] = (50.0, 600.0)
    keep_y1: tuple[float, float] = (200.0, 760.0)


BANDS = Bands()


def rect(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(*[c.cast("double").alias(n) for c, n in ((x0, "x0"), (y0, "y0"), (x1, "x1"), (y1, "y1"))])


def area(r: Column) -> Column:
    return F.coalesce(F.greatest(r["x1"] - r["x0"], F.lit(0.0)) * F.greatest(r["y1"] - r["y0"], F.lit(0.0)), F.lit(0.0))


def intersection(a: Column, b: Column) -> Column:
    """The common rectangle, null where they are apart or only touch."""
    x0, y0 = F.greatest(a["x0"], b["x0"]), F.greatest(a["y0"], b["y0"])
    x1, y1 = F.least(a["x1"], b["x1"]), F.least(a["y1"], b["y1"])
    return F.when((x1 > x0) & (y1 > y0), rect(x0, y0, x1, y1))


def union_of(r: Column) -> Column:
    """Aggregate: the bounding box of a group's rectangles; null for none."""
    box = rect(F.min(r["x0"]), F.min(r["y0"]), F.max(r["x1"]), F.max(r["y1"]))
    return F.when(F.count(r) > 0, box)


def overlap_vertically(a: Column, b: Column) -> Column:
    return (F.least(a["y1"], b["y1"]) > F.greatest(a["y0"], b["y0"]))


def in_header_or_footer(r: Column, page: Column, bands: Bands = BANDS) -> Column:
    h = page["y1"] - page["y0"]
    return (r["y1"] <= page["y0"] + bands.header * h) | (r["y0"] >= page["y1"] - bands.footer * h)


def is_tiny(r: Column, page: Column, bands: Bands = BANDS) -> Column:
    return area(r) / F.greatest(area(page), F.lit(1.0)) < bands.least_image_area


def in_keep_window(r: Column, bands: Bands = BANDS) -> Column:
    """Open intervals on all four sides."""
    inside = lambda c, limits: (c > limits[0]) & (c < limits[1])
    return inside(r["x0"], bands.keep_x0) & inside(r["x1"], bands.keep_x1) & inside(r["y0"], bands.keep_y0) & inside(r["y1"], bands.keep_y1)


def skip_reasons(r: Column, page: Column) -> Column:
    """All reasons to leave an image out, comma-joined; empty if none."""
    tests = F.array(
        F.when(in_header_or_footer(r, page), "header/footer"),
        F.when(is_tiny(r, page), "tiny"),
        F.when(~in_keep_window(r), "outside window"),
    )
    return F.array_join(F.array_compact(tests), ", ")


def covered_share(block: Column, region: Column) -> Column:
    """The share of a block that lies in a region."""
    return area(intersection(block, region)) / F.greatest(area(block), F.lit(1e-9))


def linkage(region: Column, overlap: Column, density: Column, headings: Column, penalties: Column) -> Column:
    """Confidence that a text belongs to an image."""
    base = F.when(region == "narrow", 0.35).when(region == "wide", 0.20).otherwise(0.10)
    score = base + F.least(F.lit(0.25), overlap * 0.25) + F.least(F.lit(0.15), density * 0.15) + F.when(headings, 0.15).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score - penalties))


def linkage_penalties(top: Column, bottom_gap: Column, width: Column, header: float = 90, footer: float = 80, least_width: float = 80) -> Column:
    return F.when(top < header, 0.15).otherwise(0.0) + F.when(bottom_gap < footer, 0.15).otherwise(0.0) + F.when(width < least_width, 0.10).otherwise(0.0)
