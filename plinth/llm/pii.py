"""Personal data replaced by format-preserving Feistel pseudonyms.

Numbers and dates are validated before they are touched (Luhn, mod-97, area and group rules, octets, the calendar) and then
permuted by a keyed Feistel network within their own format, so a pseudonym passes the same validation, and equal values
become equal pseudonyms in every document. Permutations act on the bare value, so one number in two notations stays one
number. Where the set of valid values isn't a power of the radix, or only a part of it can be written in a format, the walk is cycled until
it is back in the set: on every format the map is one to one.

| kind | valid if | what is permuted |
|-|-|-|
| card | 13-19 digits, Luhn | all but the check digit, which is recomputed |
| iban | country, check digits 02 to 98, mod 97 | letters and digits of the account part, each within its class; check digits recomputed |
| ssn | AAA-GG-SSSS, area and group rules | nine digits, cycled to a valid one |
| phone | 8-15 digits in phone notation; ten digits parted by spaces alone need an area and exchange from 200 on | the digits behind the country code; an area and exchange from 200 on stay so |
| ip | four octets up to 255 | the 32-bit address |
| ip6 | IPv6 notation with three groups or more | the 128-bit address |
| date | a day of the calendar, years 1900-2099 | the day number within those years |
| email | local part, domain labels, last label of letters | letters and digits of all but the last label, each within its class |
| secret | a run of 32 or more hexadecimal digits with both letters and digits | the hexadecimal digits |

No kind has a greatest length but those that the kind itself has. A date's reading is that of its string: year first; day first; or month first, if
it is no day of the calendar day first. Strings of one reading and one way of zero padding are permuted among themselves. A time behind a date stays.

A match that fails validation gives way to shorter ends and to the other kinds at the same place, and then to what begins at its next group of letters and digits.

The key is a parameter of the operator, without a default. ``session_key`` takes it from the session's setting ``spark.plinth.pii.key``. Where that is not set, a
random key is drawn once a session: nobody can reverse the pseudonyms then, and they are linked across the documents of the session only.

Defined cases: a null text stays null; empty texts and texts without personal data stay as they are, whatever their length; repeated rows get equal
results; an empty table gives no rows; other columns of the table stay, and where one is called as a new column the new one has underscores added;
a value that fails validation stays; IPv4 octets lose leading zeros.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import secrets
from collections.abc import Iterator
from datetime import date, timedelta
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plinth.llm.common import free_names

SETTING = "spark.plinth.pii.key"
ROUNDS = 8
_drawn: dict[str, bytes] = {}


def session_key(spark: SparkSession) -> bytes:
    """The key of the session: its setting, or random bytes that stay the same as long as the application runs."""
    given = spark.conf.get(SETTING, None)
    return given.encode() if given else _drawn.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


class Feistel:
    """Keyed permutations of digit strings of any radix and length, and of ranges."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key).digest()

    def digits(self, value: list[int], radix: int, tweak: str) -> list[int]:
        """An unbalanced alternating network over the halves of value: digit by digit, one half is shifted by what the key makes of the other."""
        n = len(value)
        a, b = value[: n // 2], value[n // 2 :]
        if n == 1:
            a, b = b, a
        for i in range(ROUNDS):
            stream = hashlib.shake_256(self.key + f"{tweak}|{radix}|{n}|{i}|".encode() + bytes(b)).digest(2 * len(a))
            a, b = b, [(d + x + 256 * y) % radix for d, x, y in zip(a, stream[::2], stream[1::2], strict=True)]
        return a + b

    def below(self, value: int, size: int, tweak: str) -> int:
        """A permutation of range(size): of the next power of two, walked until inside."""
        bits = max(2, (size - 1).bit_length())
        while True:
            out = self.digits([value >> k & 1 for k in range(bits)], 2, tweak)
            value = sum(d << k for k, d in enumerate(out))
            if value < size:
                return value


def luhn_digit(digits: str) -> str:
    """The check digit that follows these digits."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 else d * 2 - 9 * (d > 4)
    return str(-total % 10)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _valid_ssn(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def _fill(pattern: str, chars: str, is_slot=str.isdigit) -> str:
    """pattern with its slots taken from chars in order."""
    it = iter(chars)
    return "".join(next(it) if is_slot(c) else c for c in pattern)


_FIRST, _DAYS = date(1900, 1, 1), (date(2099, 12, 31) - date(1900, 1, 1)).days + 1
_NO_WORD = r"(?![0-9A-Za-z])"
#: By kind, in order of precedence where two begin at the same place.
_FORMS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@(?:[A-Za-z0-9\-]++\.)+[A-Za-z]{2,}" + _NO_WORD,
    "secret": rf"(?<![A-Za-z0-9])[0-9a-fA-F]{{32,}}+{_NO_WORD}",
    "iban": rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{_NO_WORD}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z/.\-])(?:[0-9]{4}(?P<s1>[-/.])[0-9]{2}(?P=s1)[0-9]{2}|[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)[0-9]{4})(?!(?!T[0-9]{2}:?[0-9]{2})[0-9A-Za-z]|[-/.][0-9])",
    "ip6": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:]|\.[0-9])",
    "ssn": rf"(?<![0-9A-Za-z\-])[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9A-Za-z]|-[0-9])",
    "card": rf"(?<![0-9A-Za-z])(?:[0-9]{{13,19}}|[0-9]{{4}}(?P<s3>[ \-])[0-9]{{4}}(?P=s3)[0-9]{{4}}(?P=s3)[0-9]{{1,7}}(?:(?P=s3)[0-9]{{1,3}})?|[0-9]{{4}}(?P<s4>[ \-])[0-9]{{6}}(?P=s4)[0-9]{{5}}){_NO_WORD}",
    "phone": r"(?<![0-9A-Za-z+(])(?:" + "|".join((
        r"\+1[ .\-/]?(?:\([0-9]{3}\)|[0-9]{3})[ .\-/]?[0-9]{3}[ .\-/]?[0-9]{4}",
        r"\+[0-9]{1,3}[ .\-/]?\([0-9]{1,5}\)[ .\-/]?[0-9]{2,12}(?:(?P<s5>[ .\-/])[0-9]{2,12}(?:(?P=s5)[0-9]{2,12}){0,3})?",
        r"\+[0-9]{1,6}[ .\-/][0-9]{1,5}(?P<s6>[ .\-/])[0-9]{2,12}(?:(?P=s6)[0-9]{2,12}){0,4}",
        r"\+[0-9]{1,6}[ .\-/][0-9]{5,13}",
        r"\+[0-9]{8,15}",
        r"\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}",
        r"[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}",
        r"[2-9][0-9]{2} [2-9][0-9]{2} [0-9]{4}",
    )) + rf"){_NO_WORD}(?!\.[0-9])",
}
KINDS = tuple(_FORMS)
_PATTERN = re.compile("|".join(f"(?P<{k}>{rx})" for k, rx in _FORMS.items()))
_ONE = {k: re.compile(rx) for k, rx in _FORMS.items()}
_GROUP = re.compile(r"[0-9A-Za-z]+|.", re.S)
#: Texts without any of these can't hold personal data of the above kinds.
_HINT = re.compile(r"[0-9]{2}|[0-9]\.[0-9]|@|[0-9a-fA-F]{32}|[0-9][/-][0-9]|:[0-9a-fA-F]*:")
#: Country calling codes of one and two digits; all others have three. Fixed values.
_ONE_DIGIT = ("1", "7")
_TWO_DIGITS = ("20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")


def _calling_code(digits: str) -> str:
    return digits[: 1 if digits[:1] in _ONE_DIGIT else 2 if digits[:2] in _TWO_DIGITS else 3]


def _american(digits: str) -> bool:
    return len(digits) == 10 and digits[0] in "23456789" and digits[3] in "23456789"


def _shorter(kind: str, raw: str) -> list[int]:
    """Where a match in groups may end earlier: its last groups may be another word or number."""
    return [m.start() for m in re.finditer(r"[ .\-/]", raw)][:0:-1] if kind in ("iban", "phone", "card") else []


def _read_date(raw: str) -> tuple[int, tuple] | None:
    """Day number of a date string, and its format: separator, reading, and padding. None if it isn't a day of the years covered."""
    sep = next(c for c in raw if not c.isdigit())
    parts = raw.split(sep)
    if len(parts[0]) == 4:
        orders, (y, *fields) = ("ymd",), parts
        padding = "padded"
    else:
        orders, (*fields, y) = ("dmy", "mdy"), parts
        padding = "padded" if len(fields[0]) == len(fields[1]) == 2 else "mixed" if "0" in (fields[0][0], fields[1][0]) else "plain"
        if padding == "mixed":
            padding += str([len(f) for f in fields])
    for order in orders:
        m, d = map(int, fields if order != "dmy" else fields[::-1])
        try:
            n = (date(int(y), m, d) - _FIRST).days
        except ValueError:
            continue
        return (n, (sep, order, padding)) if 0 <= n < _DAYS else None
    return None


def _write_date(n: int, form: tuple) -> str:
    sep, order, padding = form
    day = _FIRST + timedelta(n)
    first, second = (day.day, day.month) if order == "dmy" else (day.month, day.day)
    if order == "ymd":
        return f"{day.year}{sep}{first:02d}{sep}{second:02d}"
    wide = {"padded": (2, 2), "plain": (1, 1)}.get(padding) or [int(c) for c in padding if c.isdigit()]
    return f"{first:0{wide[0]}d}{sep}{second:0{wide[1]}d}{sep}{day.year}"


class Pseudonymiser:
    def __init__(self, key: bytes):
        if not key:
            raise ValueError("pseudonyms need a key")
        self.f = Feistel(key)
        self.of = lru_cache(1 << 14)(self._of)

    def _classes(self, text: str, tweak: str) -> str:
        """Letters and digits permuted within their class, the positions of classes unchanged."""
        out = list(text)
        for name, alphabet in (("d", "0123456789"), ("l", "abcdefghijklmnopqrstuvwxyz"), ("u", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")):
            at = [i for i, c in enumerate(text) if c in alphabet]
            # the network is tweaked by the format, so different formats don't share a permutation
            for i, d in zip(at, self.f.digits([alphabet.index(text[i]) for i in at], len(alphabet), f"{tweak}{name}"), strict=True):
                out[i] = alphabet[d]
        return "".join(out)

    def _of(self, kind: str, raw: str) -> str | None:
        """The pseudonym of a raw match, or None if it isn't valid."""
        return getattr(self, f"_{kind}")(raw)

    def _card(self, raw: str) -> str | None:
        d = re.sub(r"\D", "", raw)
        if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or not d.strip("0"):
            return None
        body = "".join(map(str, self.f.digits(list(map(int, d[:-1])), 10, f"card{len(d)}")))
        return _fill(raw, body + luhn_digit(body))

    def _iban(self, raw: str) -> str | None:
        s = raw.replace(" ", "")
        if not 15 <= len(s) <= 34 or not 2 <= int(s[2:4]) <= 98 or _mod97(s[4:] + s[:4]) != 1:
            return None
        account = self._classes(s[4:], f"iban{s[:2]}{len(s)}")
        check = 98 - _mod97(account + s[:2] + "00")
        return _fill(raw, f"{s[:2]}{check:02d}{account}", str.isalnum)

    def _ssn(self, raw: str) -> str | None:
        d = raw.replace("-", "")
        if not _valid_ssn(d):
            return None
        while True:
            d = "".join(map(str, self.f.digits(list(map(int, d)), 10, "ssn")))
            if _valid_ssn(d):
                return _fill(raw, d)

    def _phone(self, raw: str) -> str | None:
        d = re.sub(r"\D", "", raw)
        if not 8 <= len(d) <= 15:
            return None
        code = _calling_code(d) if raw[0] == "+" else ""
        rest = d[len(code) :]
        american = _american(rest)
        while True:
            rest = "".join(map(str, self.f.digits(list(map(int, rest)), 10, f"phone{len(rest)}")))
            if _american(rest) == american:
                return _fill(raw, code + rest)

    def _ip(self, raw: str) -> str | None:
        octets = list(map(int, raw.split(".")))
        if max(octets) > 255:
            return None
        n = self.f.below(int.from_bytes(bytes(octets), "big"), 1 << 32, "ip")
        return ".".join(map(str, n.to_bytes(4, "big")))

    def _ip6(self, raw: str) -> str | None:
        if sum(1 for g in raw.split(":") if g) < 3:
            return None
        try:
            value = ipaddress.IPv6Address(raw)
        except ValueError:
            return None
        out = ipaddress.IPv6Address(self.f.below(int(value), 1 << 128, "ip6"))
        new = out.compressed if "::" in raw else ":".join(f"{int(g, 16):x}" for g in out.exploded.split(":"))
        return new.upper() if raw != raw.lower() else new

    def _date(self, raw: str) -> str | None:
        if (read := _read_date(raw)) is None:
            return None
        n, form = read
        while True:  # until the string is read in the same way
            n = self.f.below(n, _DAYS, "date")
            if _read_date(new := _write_date(n, form)) == (n, form):
                return new

    def _email(self, raw: str) -> str | None:
        body, dot, last = raw.rpartition(".")
        return self._classes(body, f"email{len(body)}") + dot + last

    def _secret(self, raw: str) -> str | None:
        low = raw.lower()
        if low.isdigit() or low.isalpha():
            return None
        out = low
        while True:
            out = "".join(f"{d:x}" for d in self.f.digits([int(c, 16) for c in out], 16, f"hex{len(out)}"))
            if not out.isdigit() and not out.isalpha():
                return out.upper() if raw == raw.upper() else out

    def _at(self, kind: str, raw: str) -> tuple[str, int] | None:
        """The pseudonym of a match or of a shorter end of it, and the length it stands for."""
        for end in (len(raw), *_shorter(kind, raw)):
            if (new := self.of(kind, raw[:end])) is not None:
                return new, end
        return None

    def replace(self, text: str | None) -> tuple[str | None, list[str]]:
        """The text with pseudonyms, and the kinds found in order."""
        if text is None or not _HINT.search(text):
            return text, []
        kinds: list[str] = []
        out: list[str] = []
        done = at = 0
        while m := _PATTERN.search(text, at):
            begin, tried = m.start(), next(k for k in KINDS if m[k] is not None)
            kind, new = tried, self._at(tried, m[0])
            for other in KINDS if new is None else ():
                if other != tried and (n := _ONE[other].match(text, begin)) and (new := self._at(other, n[0])):
                    kind = other
                    break
            if new is None:
                at = _GROUP.match(text, begin).end()
                continue
            kinds.append(kind)
            out += [text[done:begin], new[0]]
            done = at = begin + new[1]
        return "".join([*out, text[done:]]), kinds


def pseudonymise(docs: DataFrame, key: bytes, counts: bool = True) -> DataFrame:
    """docs with text replaced; with ``counts`` also pii_count long and pii_kinds string (distinct, sorted, comma-joined)."""
    at, names, fields = docs.columns.index("text"), list(docs.columns), docs
    if counts:
        count, found = free_names(docs.columns, "pii_count", "pii_kinds")
        names += [count, found]
        fields = docs.withColumn(count, F.lit(0).cast("long")).withColumn(found, F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pseudonymiser(key)
        for b in batches:
            done = [p.replace(t) for t in b.column(at).to_pylist()]
            columns = [b.column(i) for i in range(b.num_columns)]
            columns[at] = pa.array([t for t, _ in done], columns[at].type)
            if counts:
                columns += [pa.array([len(k) for _, k in done], pa.int64()), pa.array([",".join(sorted(set(k))) for _, k in done], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, fields.schema)
