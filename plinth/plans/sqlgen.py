"""SQL texts of the functions in ``plinth.functions``, for the DuckDB side of each query."""

from __future__ import annotations

from plinth.functions import text as T


def strip(c: str) -> str:
    return f"regexp_replace({c}, '{T.EDGE}', '', 'g')"


def collapse(c: str) -> str:
    return f"regexp_replace({c}, '{T.SPACES}', ' ', 'g')"


def canon(c: str) -> str:
    return collapse(f"regexp_replace(lower({strip(c)}), '{T.NON_WORD}', ' ', 'g')")


def norm(c: str) -> str:
    dashed = f"regexp_replace(lower({c}), '{T.DASHES}', '-', 'g')"
    return f"trim({collapse(f"regexp_replace({dashed}, '{T.NON_WORD_OR_DASH}', ' ', 'g')")})"


def words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '')"


def fold_newlines(c: str) -> str:
    t = f"regexp_replace(regexp_replace({c}, '\\r\\n?', chr(10), 'g'), '{T.DASHES}', '-', 'g')"
    t = f"regexp_replace({t}, '([^.\\s])\\s*\\n\\s*', '\\1 ', 'g')"
    t = f"regexp_replace({t}, '^\\s+', '')"
    t = f"regexp_replace({t}, '[ \\t]{{2,}}', ' ', 'g')"
    return strip(f"regexp_replace({t}, '(?m)[ \\t]+$', '', 'g')")


def sheet_key(c: str) -> str:
    rx = r"^\s*([1-7])(?:[.)]\s*|\s+|$)"
    return f"CASE WHEN regexp_matches({c}, '{rx}') THEN regexp_extract({c}, '{rx}', 1) || '.0' ELSE {strip(c)} END"


def singular(w: str) -> str:
    return (
        f"CASE WHEN length({w}) <= 3 THEN {w} WHEN {w} LIKE '%ies' AND length({w}) > 4 THEN {w}[:-4] || 'y' "
        f"WHEN regexp_matches({w}, '(s|x|z|ch|sh)es$') AND length({w}) > 4 THEN {w}[:-3] WHEN {w} LIKE '%es' THEN {w}[:-3] "
        f"WHEN {w} LIKE '%s' AND {w} NOT LIKE '%ss' THEN {w}[:-2] ELSE {w} END"
    )


def phrase_words(c: str) -> str:
    return f"list_transform({words(collapse(c))}, lambda x: {singular('x')})"


def jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b})))::DOUBLE END"


def containment(a: str, b: str) -> str:
    """Of two canonical texts."""
    pa, pb = phrase_words(a), phrase_words(b)
    ja, jb = (f"(' ' || array_to_string({p}, ' ') || ' ')" for p in (pa, pb))
    la, lb = (f"length(array_to_string({p}, ''))" for p in (pa, pb))
    ratio = f"(CASE WHEN contains({jb}, {ja}) THEN {la} / greatest({lb}, 1)::DOUBLE WHEN contains({ja}, {jb}) THEN {lb} / greatest({la}, 1)::DOUBLE END)"
    return f"CASE WHEN len({pa}) = 0 OR len({pb}) = 0 THEN 0.0 WHEN {ja} = {jb} THEN 0.99 WHEN {ratio} >= 0.45 THEN 0.90 + 0.09 * least(1.0, {ratio}) ELSE 0.0 END"


def natural_key(c: str) -> str:
    return f"list_transform(string_split({c}, '.'), lambda p: {{'w': try_cast(p AS INTEGER) IS NULL, 'n': coalesce(try_cast(p AS INTEGER), 0), 't': CASE WHEN try_cast(p AS INTEGER) IS NULL THEN p ELSE '' END}})"


def report_key(c: str) -> str:
    return f"list_transform(regexp_extract_all({c}, '([A-Za-z]+|\\d+)', 1), lambda t: {{'r': regexp_matches(t, '^\\d')::INTEGER, 'n': coalesce(try_cast(t AS BIGINT), 0), 't': upper(t)}})"


def char_grams(c: str) -> str:
    """All n-grams of 3 to 5 characters inside padded words."""
    per = " ".join(f"WHEN n = {n} THEN list_transform(range(1, greatest(length(w) - {n} + 1, 1) + 1), lambda i: substring(w, i, {n}))" for n in (3, 4, 5))
    padded = f"list_transform({words(f"trim(regexp_replace(lower({c}), '\\s+', ' ', 'g'))")}, lambda w: ' ' || w || ' ')"
    return f"flatten(list_transform({padded}, lambda w: flatten(list_transform([3, 4, 5], lambda n: CASE WHEN length(w) < n THEN CAST([] AS VARCHAR[]) {per} END))))"
