"""Building the label catalogue: sheets, merged blocks, grouped options, lookup maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plinth.functions import text as T

#: Words that mark a header row, each tested as a substring of any cell. Fixed values.
HEADER_WORDS = ("id", "observation", "cause", "cause/effect", "choice", "choice_order", "recommendation", "text", "recommendation text")
TARGET_SHEETS = tuple(f"{d}.0" for d in range(1, 8))


def is_header(cells: Column) -> Column:
    """True if any cell contains any header word."""
    return F.exists(cells, lambda c: F.exists(F.array(*map(F.lit, HEADER_WORDS)), lambda w: F.contains(F.lower(c), w)))


def drop_header(rows: DataFrame, cells: list[str], sheet: str = "sheet", order: str = "row_no") -> DataFrame:
    """Leaves out a sheet's first row if it looks like a header."""
    first = F.min(order).over(Window.partitionBy(sheet))
    return rows.withColumn("__first", first).where(~((F.col(order) == F.col("__first")) & is_header(F.array(*[F.coalesce(c, F.lit("")) for c in cells])))).drop("__first")


def pick_sheets(available: DataFrame, targets: tuple[str, ...] = TARGET_SHEETS) -> DataFrame:
    """target, sheet: for each target the sheet of that name, letter case aside, else the first that begins with it.

    available: sheet, ord.
    """
    wanted = F.explode(F.array(*map(F.lit, targets))).alias("target")
    name = F.lower(T.strip(F.col("sheet")))
    fits = available.select("sheet", "ord", wanted).where(name.startswith(F.col("target")))
    best = F.min(F.struct((F.lower(T.strip(F.col("sheet"))) != F.col("target")).alias("loose"), "ord", "sheet"))
    return fits.groupBy("target").agg(best.alias("b")).select("target", F.col("b.sheet").alias("sheet"))


def fill_blocks(rows: DataFrame, group: str, order: str, starts: Column, valid: Column, carry: list[str]) -> DataFrame:
    """Rows with the carried columns of the row that starts their block, and position ``block_pos`` in it.

    A block starts where ``starts`` holds and lasts until the next start; blocks whose first row isn't ``valid`` are left out, as are
    rows before the first start.
    """
    w = Window.partitionBy(group).orderBy(order)
    marked = rows.withColumn("__start", F.coalesce(starts, F.lit(False))).withColumn("__valid", F.coalesce(valid, F.lit(False)))
    block = F.sum(F.col("__start").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = marked.withColumn("block", block).where("block > 0")
    inside = Window.partitionBy(group, "block").orderBy(order)
    whole = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = marked.withColumns({c: F.first(c).over(whole) for c in carry} | {"__valid": F.first("__valid").over(whole), "block_pos": F.row_number().over(inside) - 1})
    return out.where("__valid").drop("__start", "__valid")


def option_letter(own: Column, position: Column) -> Column:
    """The row's own letter, else that of its position in the block."""
    return F.coalesce(T.letter(own), F.chr(F.lit(97) + position))


def group_options(options: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """keys, choice_order (letters by first occurrence), recommendations (letter -> choice, text; the last one written wins).

    options: keys, order, letter, choice, text. Equal keys in two blocks are joined.
    """
    per_letter = options.groupBy(*keys, "letter").agg(F.min(order).alias("first"), F.max(F.struct(order, "choice", "text")).alias("last"))
    entry = F.struct("first", "letter", F.struct(F.col("last.choice").alias("choice"), F.col("last.text").alias("text")).alias("value"))
    grouped = per_letter.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("o"))
    return grouped.select(*keys, F.transform("o", lambda x: x["letter"]).alias("choice_order"), F.map_from_arrays(F.transform("o", lambda x: x["letter"]), F.transform("o", lambda x: x["value"])).alias("recommendations"))


def items_of_rows(rows: DataFrame) -> DataFrame:
    """sheet, id, label, cause_effect, choice_order, recommendations of workbook rows (sheet, row_no and the six cells c_id .. c_text).

    A sheet's header goes. An item is a row with an id and what follows up to the next id; blank rows inside count as options. Items of an id without a label are left out, with their rows.
    """
    cells = ["c_id", "c_observation", "c_cause_effect", "c_letter", "c_choice", "c_text"]
    named = {"id": F.col("c_id"), "label": F.col("c_observation"), "cause_effect": F.col("c_cause_effect")}
    blocks = fill_blocks(drop_header(rows, cells).withColumns(named), "sheet", "row_no", F.col("c_id") != "", F.col("c_observation") != "", list(named))
    options = blocks.select("sheet", *named, F.col("row_no").alias("seq"), option_letter(F.col("c_letter"), F.col("block_pos").cast("int")).alias("letter"), F.col("c_choice").alias("choice"), F.col("c_text").alias("text"))
    return group_options(options, ["sheet", *named])


def items(labels: DataFrame) -> DataFrame:
    """labels (ord, id, label, sheet) with sheet_key, sheet_title, canon, label_terms; blank labels are left out."""
    named = labels.where(T.strip(F.coalesce("label", F.lit(""))) != "")
    return named.select("ord", F.coalesce("id", F.lit("")).alias("id"), T.strip(F.col("label")).alias("label"), T.sheet_key(F.col("sheet")).alias("sheet_key"), T.strip(F.col("sheet")).alias("sheet_title"), T.canon(F.col("label")).alias("canon"), T.strip(F.col("label")).alias("label_terms"))


def first_by_canon(catalogue: DataFrame) -> DataFrame:
    return catalogue.groupBy("canon").agg(F.min(F.struct("ord", "id", "label", "sheet_key")).alias("i")).select("canon", "i.ord", "i.id", "i.label", "i.sheet_key")


def sheet_maps(catalogue: DataFrame) -> DataFrame:
    """sheet_key, title (last), other_id (of the last item named "Other" that has an id), labels (set of canonical labels, sorted), first_ord."""
    other = F.max(F.when((F.col("canon") == "other") & (F.col("id") != ""), F.struct("ord", "id")))
    return catalogue.groupBy("sheet_key").agg(F.max(F.struct("ord", "sheet_title"))["sheet_title"].alias("title"), other["id"].alias("other_id"), F.array_sort(F.collect_set("canon")).alias("labels"), F.min("ord").alias("first_ord"))


def counts_by_sheet(catalogue: DataFrame) -> DataFrame:
    return catalogue.groupBy("sheet_key").agg(F.count("*").alias("items"))


def natural_order(df: DataFrame, partition: str, key: Column, tie: str, name: str = "position") -> DataFrame:
    """The position of each row of a partition in the order of a sort key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(partition).orderBy(key, tie)))


def signature(catalogue: DataFrame) -> DataFrame:
    """One row: SHA-1 of the catalogue's canonical form. Rows are hashed first, so only digests are gathered."""
    row = F.sha1(F.concat_ws("\x1f", F.col("ord").cast("string"), "id", "label", "sheet_key"))
    return catalogue.agg(F.sha1(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", row.alias("h")))), lambda x: x["h"]), "")).alias("signature"))
