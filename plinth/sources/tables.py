"""Sources and sinks: taxonomy, workbook rows, manifest, snapshot, label map, embeddings cache, documents."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.errors import AnalysisException, PySparkException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plinth.functions import text as T
from plinth.sources.staging import staged

ITEM = "struct<sheet:string,category:string,id:string,label:string,cause_effect:string,choice_order:array<string>,recommendations:map<string,struct<choice:string,text:string>>>"
WORKBOOK = "c_id string, c_observation string, c_cause_effect string, c_letter string, c_choice string, c_text string"
SNAPSHOT = "key string, pages_used int, images int"
#: Accepted names of the columns of a taxonomy table. Fixed values.
ALIASES = {"id": ("id", "observation_id", "obs_id"), "label": ("label", "name", "class"), "sheet": ("sheet", "category", "group")}


def _items_of(text: Column) -> Column:
    """The items of a taxonomy text: an object with ``items``, or a bare array; as it is, or with single quotes for double ones. Null if it is neither."""
    either = lambda c: F.coalesce(F.from_json(c, f"items array<{ITEM}>")["items"], F.from_json(c, f"array<{ITEM}>"))
    return F.coalesce(either(text), either(F.replace(text, F.lit("'"), F.lit('"'))))


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """ord, sheet, id, label, cause_effect, choice_order, recommendations of taxonomy JSON: one file, or a folder that ``write_taxonomy`` wrote.

    A byte order mark is dropped, and single quotes are repaired if the text doesn't parse as it is. ord is the position in the file; items without a label are left out. A text that is
    neither an object with ``items`` nor an array is an error.
    """
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\ufeff", "").alias("t"))
    items = F.coalesce(_items_of(F.col("t")), F.raise_error(F.lit("the taxonomy is neither an object with items nor an array")).cast(f"array<{ITEM}>"))
    parsed = raw.select(items.alias("items"))
    out = parsed.select(F.posexplode("items").alias("ord", "i")).where("i is not null and trim(coalesce(i.label, '')) <> ''")
    return out.select("ord", F.coalesce("i.sheet", "i.category").alias("sheet"), "i.id", "i.label", "i.cause_effect", "i.choice_order", "i.recommendations")


def write_taxonomy(items: DataFrame, path: str, version: int = 1) -> None:
    """The items in the order of their sheets and ids as one object ``{version, source_sheets, items}``, which ``read_taxonomy`` reads; non-ASCII text stays as it is.

    A catalogue is one document, so it is gathered in one row.
    """
    columns = ("sheet", "id", "label", "cause_effect", "choice_order", "recommendations")
    blank = {"choice_order": "array<string>", "recommendations": "map<string,struct<choice:string,text:string>>"}
    have = items.select(*[(F.col(c) if c in items.columns else F.lit(None).cast(blank.get(c, "string"))).alias(c) for c in columns])
    keyed = have.select(F.struct(T.sheet_sort_key(F.coalesce("sheet", F.lit(""))).alias("a"), T.id_sort_key(F.coalesce("id", F.lit(""))).alias("b"), F.col("label").alias("c")).alias("k"), F.struct(*columns).alias("i"))
    # maps can't be ordered, so items are found again by their position
    whole = keyed.agg(F.collect_list("k").alias("k"), F.collect_list("i").alias("i"))
    order = F.array_sort(F.transform("k", lambda k, n: F.struct(k.alias("k"), n.alias("n"))))
    document = F.struct(F.lit(version).alias("version"), F.array_sort(F.array_distinct(F.transform("i", lambda i: i["sheet"]))).alias("source_sheets"), F.transform(order, lambda o: F.get("i", o["n"])).alias("items"))
    whole.select(F.to_json(document).alias("value")).write.mode("overwrite").text(path)


def read_taxonomy_table(spark: SparkSession, path: str) -> DataFrame:
    """ord, sheet, id, label of a taxonomy table: a CSV file with a header, its columns under any of their accepted names."""
    found = resolve(spark.read.csv(path, header=True, multiLine=True, escape='"'))
    fine = found.where("trim(coalesce(id, '')) <> '' and trim(coalesce(label, '')) <> ''")
    return fine.select(F.monotonically_increasing_id().alias("ord"), F.trim("sheet").alias("sheet"), F.trim("id").alias("id"), F.trim("label").alias("label"))


def load_taxonomy(spark: SparkSession, json_path: str | None = None, csv_path: str | None = None, workbook: tuple[str, str] | None = None) -> tuple[DataFrame, list[str]]:
    """The items (ord, sheet, id, label at least) of the first source that can be read and has any: JSON, then CSV, then a workbook (path, sheet).

    Also what each source tried gave. If none can be used, that is the error.
    """
    tried = []
    sources = (("json", json_path, lambda: read_taxonomy(spark, json_path)), ("csv", csv_path, lambda: read_taxonomy_table(spark, csv_path)), ("workbook", workbook, lambda: read_workbook_table(spark, *workbook)))
    for name, given, read in sources:
        if not given:
            continue
        try:
            found = read().where("trim(coalesce(id, '')) <> ''")
            if found.isEmpty():
                tried.append(f"{name}: no items")
                continue
            return found, [*tried, f"{name}: ok"]
        except (AnalysisException, SparkRuntimeException, PySparkException, ValueError, RuntimeError, OSError) as e:
            tried.append(f"{name}: {str(e).splitlines()[0][:200]}")
    raise ValueError("no taxonomy: " + ("; ".join(tried) or "no source given"))


CELLS = tuple(c.split()[0] for c in WORKBOOK.split(", "))


def read_workbook_rows(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """Headerless all-string rows of an exported sheet, cells stripped, with sheet and row_no."""
    rows = spark.read.schema(WORKBOOK).csv(path, header=False, multiLine=True)
    cells = [F.coalesce(T.strip(F.col(c)), F.lit("")).alias(c) for c in rows.columns]
    return rows.select(F.lit(sheet).alias("sheet"), F.monotonically_increasing_id().alias("row_no"), *cells)


def six_cells(rows: DataFrame) -> DataFrame:
    """sheet, row_no and six cells from rows of any number of them (cells array<string>): missing ones are empty, more are dropped."""
    cell = lambda i: F.coalesce(T.strip(F.get("cells", F.lit(i))), F.lit(""))
    return rows.select("sheet", "row_no", *[cell(i).alias(c) for i, c in enumerate(CELLS)])


def list_sheets(path: str) -> list[str]:
    """The sheet names of a workbook, by pandas or else openpyxl; of a folder of exported sheets, the names of its CSV files."""
    if os.path.isdir(path):
        return sorted(f[:-4] for f in os.listdir(path) if f.endswith(".csv"))
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    for read in (_sheets_by_pandas, _sheets_by_openpyxl):
        try:
            return read(path)
        except ImportError:
            continue
    raise RuntimeError("neither pandas with a workbook engine nor openpyxl is installed; export the sheets as CSV files to a folder")


def _sheets_by_pandas(path: str) -> list[str]:
    import pandas as pd

    with pd.ExcelFile(path) as book:
        return [str(s) for s in book.sheet_names]


def _sheets_by_openpyxl(path: str) -> list[str]:
    import openpyxl

    book = openpyxl.load_workbook(path, read_only=True)
    try:
        return list(book.sheetnames)
    finally:
        book.close()


def resolve(df: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES) -> DataFrame:
    """Selects the columns by their accepted names, letter case aside."""
    by = {c.lower(): c for c in df.columns}
    found = {k: next((by[a] for a in names if a in by), None) for k, names in aliases.items()}
    if lacking := [k for k, c in found.items() if c is None]:
        raise ValueError(f"no column for {', '.join(lacking)} among {', '.join(df.columns)}")
    return df.select(*[F.col(f"`{c}`").alias(k) for k, c in found.items()])


def read_manifest(spark: SparkSession, path: str, required: tuple[str, ...] = ("image_file", "label", "observation_id")) -> DataFrame:
    df = spark.read.csv(path, header=True)
    if lacking := sorted(set(required) - set(df.columns)):
        raise ValueError(f"the manifest lacks {', '.join(lacking)}")
    return df


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """``key|pages_used|images`` lines; comments, blank lines and lines of another form are left out."""
    parts = F.split(F.trim("value"), r"\|")
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)")).select(parts.alias("p")).where(F.size("p") == 3)
    return lines.select(F.col("p")[0].alias("key"), F.col("p")[1].try_cast("int").alias("pages_used"), F.col("p")[2].try_cast("int").alias("images")).where("pages_used is not null and images is not null")


def write_snapshot(stats: DataFrame, path: str) -> None:
    """stats: key, pages_used, images. A totals line is added."""
    total = stats.agg(F.lit("__totals__").alias("key"), F.sum("pages_used").alias("pages_used"), F.sum("images").alias("images"))
    lines = total.unionByName(stats.select("key", "pages_used", "images")).select(F.concat_ws("|", *[F.col(c).cast("string") for c in ("key", "pages_used", "images")]).alias("value"))
    lines.write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Writes to path, or to a time-stamped path beside it if that may not be written; returns the one used. A failing query is an error."""
    kept = staged(df, "csv")  # so that a second attempt doesn't run the query again
    try:
        kept.write.mode("overwrite").csv(path, header=True)
        return path
    except Exception as e:
        if not any(sign in str(e) for sign in ("Permission denied", "AccessControlException", "Unable to clear output directory", "Mkdirs failed")):
            raise
        other = f"{path}_{datetime.now():%Y%m%d_%H%M%S}"
        kept.write.csv(other, header=True)
        return other


def write_summary(parts: dict[str, DataFrame], path: str, run: str | None = None) -> str:
    """A run's summary tables (name -> frame) as Parquet under path/<stamp>/<name>; returns that folder."""
    folder = f"{path}/{run or f'{datetime.now():%Y%m%d_%H%M%S}'}"
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return folder


def write_calibration(best: DataFrame, path: str) -> None:
    """The temperature (one row: temperature, mean_nll) as a JSON object ``{"temperature": ...}``."""
    best.select(F.to_json(F.struct("temperature")).alias("value")).write.mode("overwrite").text(path)


def read_calibration(spark: SparkSession, path: str, default: float = 1.0) -> float:
    """The temperature of a calibration file; the default if the file holds none."""
    row = spark.read.text(path, wholetext=True).select(F.from_json("value", "temperature double")["temperature"].alias("t")).first()
    return default if row is None or row.t is None else row.t


def label_map(items: DataFrame, image_size: int = 518) -> DataFrame:
    """One row, ``value``: the class map as JSON: id to index, index to item, sheet to ids. Of a repeated id the last index counts."""
    by_id = items.groupBy("id").agg(F.max("ord").alias("ord"))
    of = lambda df, k, v: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k.alias("k"), v.alias("v"))))).alias("m"))
    ids = of(by_id, F.col("id"), F.col("ord")).withColumnRenamed("m", "id_to_idx")
    info = of(items, F.col("ord").cast("string"), F.struct("id", "label", "sheet")).withColumnRenamed("m", "idx_to_info")
    per_sheet = items.groupBy("sheet").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "id"))), lambda x: x["id"]).alias("ids"))
    sheets = of(per_sheet, F.col("sheet"), F.col("ids")).withColumnRenamed("m", "sheet_to_ids")
    return ids.crossJoin(info).crossJoin(sheets).select(F.to_json(F.struct("id_to_idx", "idx_to_info", "sheet_to_ids", F.lit(image_size).alias("image_size"))).alias("value"))  # rows of one each


def cached_embeddings(spark: SparkSession, path: str, signature: str, compute) -> DataFrame:
    """Embeddings (ord, embedding) of a catalogue signature, computed and stored if they aren't there."""
    try:
        found = spark.read.parquet(path).where(F.col("signature") == signature)
        if not found.isEmpty():
            return found.drop("signature")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    compute().withColumn("signature", F.lit(signature)).write.mode("append").partitionBy("signature").parquet(path)
    return spark.read.parquet(path).where(F.col("signature") == signature).drop("signature")


def read_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """path, length, content of matching files, for a decoder of your choice."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length", "content")


def read_workbook(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """sheet, row_no and six stripped cells of a workbook's sheet, by openpyxl if that is installed; of a folder of exported sheets, from its CSV file."""
    if os.path.isdir(path):
        return read_workbook_rows(spark, f"{path}/{sheet}.csv", sheet)
    try:
        import openpyxl
    except ImportError as e:
        raise RuntimeError("openpyxl isn't installed; export the sheets as CSV files to a folder") from e
    book = openpyxl.load_workbook(path, read_only=True, data_only=True)
    rows = [(sheet, n, ["" if c is None else str(c) for c in row]) for n, row in enumerate(book[sheet].iter_rows(values_only=True))]
    book.close()
    return six_cells(spark.createDataFrame(rows, "sheet string, row_no long, cells array<string>"))


def read_workbook_table(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """ord, sheet, id, label of a workbook's sheet in the six columns of a catalogue: its first two cells, where both are there."""
    rows = read_workbook(spark, path, sheet).where("c_id <> '' and c_observation <> ''")
    return rows.select(F.col("row_no").alias("ord"), "sheet", F.col("c_id").alias("id"), F.col("c_observation").alias("label"))


def text_blocks(spans: DataFrame) -> DataFrame:
    """report_id, page, block_no, r, text of the text blocks of pages, whatever their type, as long as they have a text (an image block's is null).

    spans: report_id, page, block_no, x0, y0, x1, y1, text, as a decoder of page files gives them.
    """
    r = F.struct(*[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])
    return spans.where("text is not null").select("report_id", "page", "block_no", r.alias("r"), "text")


def raw_text(blocks: DataFrame) -> DataFrame:
    """report_id, page, raw_text: the texts of a page's blocks in the decoder's order. A page has a bounded number of blocks."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("block_no", "text"))), lambda b: b["text"])
    return blocks.groupBy("report_id", "page").agg(F.array_join(lines, "\n").alias("raw_text"))


def image_contents(wanted: DataFrame, files: DataFrame, blank: bytes, column: str = "image_file") -> DataFrame:
    """wanted with content and found: the bytes of its image file, or the given blank image where there is none. files: path, content (``read_files``)."""
    named = files.select(T.file_name(F.col("path")).alias(column), "content")
    joined = wanted.join(named, column, "left")
    return joined.withColumn("found", F.col("content").isNotNull()).withColumn("content", F.coalesce("content", F.lit(bytearray(blank))))


def to_download(remote: DataFrame, local: DataFrame, prefix: str = "") -> DataFrame:
    """Remote names (without prefix) that aren't there locally. remote, local: name."""
    bare = remote.select(F.when(F.col("name").startswith(prefix), F.substring("name", F.lit(len(prefix) + 1), F.length("name"))).otherwise(F.col("name")).alias("name")) if prefix else remote
    return bare.where("name <> ''").join(local.select("name").distinct(), "name", "left_anti")
