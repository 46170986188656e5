"""Text functions as column expressions: normalisation, keys, panel fields.

Unicode rules are spelled out in classes, as the word class of Java patterns is ASCII.
Every function maps null to null unless it says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EDGE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
NON_WORD = r"[^\p{L}\p{N}_\s\p{Z}]"
NON_WORD_OR_DASH = r"[^\p{L}\p{N}_\s\p{Z}\-]"
SPACES = r"[\s\p{Z}]+"
DASHES = "â€“|–|—"
#: Headings that end a captured field. Fixed values.
FIELD_TOKENS = ("Observation", "Observations", "Discussion", "Description", "Issue", "Recommendation", "Location", "Priority", "Cause/Effect", "Photograph")
_WORD_START, _WORD_END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, EDGE, "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, SPACES, " ")


def canon(c: Column) -> Column:
    """Canonical label text. Ends are stripped first, so trailing punctuation leaves a space."""
    return collapse(F.regexp_replace(F.lower(strip(c)), NON_WORD, " "))


def norm(c: Column) -> Column:
    """Normalised matching text: dashes unified and kept, other punctuation dropped."""
    dashed = F.regexp_replace(F.lower(c), DASHES, "-")
    return F.trim(collapse(F.regexp_replace(dashed, NON_WORD_OR_DASH, " ")))


def words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def fold_newlines(c: Column) -> Column:
    """One paragraph per sentence end: a line break stays only behind a full stop."""
    t = F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), DASHES, "-")
    t = F.regexp_replace(t, r"([^.\s])\s*\n\s*", "$1 ")
    t = F.regexp_replace(t, r"^\s+", "")
    t = F.regexp_replace(t, "[ \t]{2,}", " ")
    return strip(F.regexp_replace(t, "(?m)[ \t]+$", ""))


def sheet_key(c: Column) -> Column:
    """A leading digit 1 to 7 gives ``d.0``, anything else its stripped self."""
    digit = F.regexp_extract(c, r"^\s*([1-7])(?:[.)]\s*|\s+|$)", 1)
    return F.when(digit != "", F.concat(digit, F.lit(".0"))).otherwise(strip(c))


def letter(c: Column) -> Column:
    """The single letter of ``(a)``, ``b.``, ``C:``; null for anything else."""
    bare = F.regexp_replace(F.regexp_replace(strip(c), r"^[(\[{]+", ""), r"[)\]}.:;,\-]+$", "")
    return F.when(bare.rlike(r"^\p{L}$"), F.lower(bare))


def singular(w: Column) -> Column:
    """A rough singular of an English word."""
    n = F.length(w)
    drop = lambda k: F.substring(w, 1, n - k)
    return (
        F.when(n <= 3, w)
        .when(w.endswith("ies") & (n > 4), F.concat(drop(3), F.lit("y")))
        .when(w.rlike("(s|x|z|ch|sh)es$") & (n > 4), drop(2))
        .when(w.endswith("es"), drop(2))
        .when(w.endswith("s") & ~w.endswith("ss"), drop(1))
        .otherwise(w)
    )


def phrase_words(c: Column) -> Column:
    return F.transform(words(collapse(c)), singular)


def slug(c: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}.\-]", "_"), "^_+|_+$", "")
    return F.when(bare == "", F.lit("model")).otherwise(bare)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def report_of_image(path: Column) -> Column:
    return F.substring_index(file_stem(path), "_page", 1)


def image_name(report: Column, page: Column, index: Column) -> Column:
    return F.concat(report, F.lit("_page"), page.cast("string"), F.lit("_img"), index.cast("string"), F.lit(".png"))


def photo_id(c: Column) -> Column:
    found = F.regexp_extract(c, r"(?i)\bphotograph\s*[:\-–—]?\s*([0-9]+(?:\.[0-9]+)?)", 1)
    return F.when(found != "", found)


def section_of_page(c: Column) -> Column:
    """``N.0`` of the last line of the form ``N.d text``, N from 1 to 7."""
    lines = F.filter(F.split(c, "\n"), lambda x: x.rlike(r"^\s*[1-7]\.\d+\s+\S"))
    digit = F.regexp_extract(F.try_element_at(lines, F.lit(-1)), r"^\s*([1-7])\.", 1)
    return F.when(digit != "", F.concat(digit, F.lit(".0")))


def clean_footers(c: Column) -> Column:
    return strip(F.array_join(F.filter(F.split(c, "\n"), lambda x: ~x.rlike(r"(?i)^\s*page\s+\d+\s+of\s+\d+\s*$")), "\n"))


def non_blank_lines(c: Column) -> Column:
    return strip(F.array_join(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), "\n"))


def weighted_pair(observation: Column, cause: Column, observation_times: int = 3, cause_times: int = 7) -> Column:
    """Index text in which the cause counts more: each part repeated, each time with a space."""
    part = lambda c, k: F.repeat(F.concat(strip(F.translate(F.coalesce(c, F.lit("")), " ", " ")), F.lit(" ")), k)
    return F.concat(part(cause, cause_times), part(observation, observation_times))


def observation_field(c: Column) -> Column:
    """The observation of a panel (newlines folded first), up to the next field heading; null if there is none."""
    t = fold_newlines(c)
    stop = rf"(?={_WORD_START}(?:{'|'.join(FIELD_TOKENS)}){_WORD_END}\s*[:\-]|$)"
    found = strip(F.regexp_extract(t, rf"(?is){_WORD_START}observations?{_WORD_END}\s*[:\-]\s*(.+?){stop}", 1))
    return F.when(found != "", found)


def panel(c: Column) -> Column:
    """struct(observation_raw, label_source, raw_right_text, photo_id, panel_raw) of a right-hand text."""
    text = fold_newlines(F.coalesce(c, F.lit("")))
    observation = observation_field(text)
    own = F.when(observation.rlike(r"(?i)^\s*photograph\b"), F.regexp_replace(observation, r"^[^\n]*\n?", "")).otherwise(observation)
    return F.struct(
        F.coalesce(strip(own), F.lit("")).alias("observation_raw"),
        F.when(observation.isNotNull(), "observation").otherwise("full text").alias("label_source"),
        text.alias("raw_right_text"),
        photo_id(text).alias("photo_id"),
        text.alias("panel_raw"),
    )


def titled_section(c: Column) -> Column:
    """The text under a Cause/Effect heading that has a line of its own, else under Discussion or Description, else empty."""
    any_title = r"(?:Observation|Discussion|Description|Cause\s*[/&]?\s*Effect|Recommendations?)"

    def under(title: str) -> Column:
        return strip(F.regexp_extract(c, rf"(?im)^\s*{title}\s*:?[ \t]*$((?s:.*?))(?=^\s*{any_title}\s*:?[ \t]*$|\z)", 1))

    cause, discussion = under(r"Cause\s*[/&]?\s*Effect"), under("(?:Discussion|Description)")
    return F.coalesce(F.nullif(cause, F.lit("")), F.nullif(discussion, F.lit("")), F.lit(""))


def without_first(block: Column, part: Column) -> Column:
    """The block without the first occurrence of part, letter case aside; the rests joined by a line break."""
    at = F.position(F.lower(part), F.lower(block))
    before = strip(F.substring(block, F.lit(1), at - 1))
    after = strip(F.substring(block, at + F.length(part), F.length(block)))
    joined = F.array_join(F.filter(F.array(before, after), lambda x: x != ""), "\n")
    return F.when((F.coalesce(part, F.lit("")) == "") | (at == 0), strip(block)).otherwise(joined)


def fixed(c: Column, digits: int) -> Column:
    """A double from 0 on with so many digits (up to 6), as C's printf writes it: by its binary value, ties to even. ``format_string`` takes the shortest decimal instead, so 0.7995, which is a bit less, becomes 0.800 there."""
    # scaled is rounded; its error is exact, as the halves of the split have 26 bits and the scale has 20 at most
    scale, x = 10.0**digits, c.cast("double")
    scaled, split = x * scale, x * 134217729.0
    high = split - (split - x)
    error = (high * scale - scaled) + (x - high) * scale
    whole = F.floor(scaled)
    part = scaled - whole
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    n = whole + up.cast("long")
    return F.concat(F.floor(n / scale).cast("string"), F.lit("."), F.lpad((n % int(scale)).cast("string"), digits, "0"))


def safe_int(c: Column) -> Column:
    return F.coalesce(c.try_cast("int"), F.lit(0))


def candidate_text(label: Column, sheet: Column, terms: Column) -> Column:
    """Text to encode for a catalogue item; parts that the label contains already are left out."""
    extra = lambda c: F.when(~F.contains(F.lower(label), F.lower(c)), c)
    return F.concat_ws(" [SEP] ", label, F.nullif(extra(sheet), F.lit("")), F.nullif(extra(terms), F.lit("")))


def id_sort_key(c: Column) -> Column:
    """Dotted ids in natural order: numbers before words at each position; a total order."""
    number = lambda p: p.try_cast("int")
    return F.transform(F.split(c, r"\."), lambda p: F.struct(number(p).isNull().alias("word"), F.coalesce(number(p), F.lit(0)).alias("number"), F.when(number(p).isNull(), p).otherwise("").alias("text")))


def report_sort_key(c: Column) -> Column:
    """Runs of letters before runs of digits, numbers by value, separators ignored."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"([A-Za-z]+|\d+)"), F.lit(1)), lambda t: F.struct(t.rlike(r"^\d").cast("int").alias("rank"), F.coalesce(t.try_cast("long"), F.lit(0)).alias("number"), F.upper(t).alias("text")))


def sheet_sort_key(c: Column) -> Column:
    major, minor = (F.regexp_extract(c, r"^\s*(\d+)\.(\d+)", i) for i in (1, 2))
    number = lambda x: F.when(x != "", x.cast("int")).otherwise(9999)
    return F.struct(number(major).alias("major"), number(minor).alias("minor"), F.lower(c).alias("text"))
