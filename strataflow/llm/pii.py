"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, scheme separators and identifier cues.
Each anchor is expanded by a local parser that reads on from it (and, for at-signs and schemes, back to the last span of
its kind) and validates what it found. Per kind, spans are leftmost and never overlap; a span that fails its check is
dropped without another try inside it. No parser reads a stretch of text more often than a fixed number of times.

Base kinds: ``email``, ``ip`` (parts up to 255), ``card`` (16 to 19 digits, Luhn), ``phone`` (8 to 15 digits). Added kinds:
``account`` (a number behind a cue such as "account no", "ssn", "passport", in any case) and ``url`` (scheme, "://" and a
host). A number may have blanks; it ends where a number of its kind is complete: an IBAN, which must pass its checksum, at its
country's length, an SSN at nine digits, others before a group without a digit.

Defined cases: null and empty texts have no spans; offsets count code points, end exclusive; repeated rows come out as
often; columns named like an output are replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import add_columns, list_array, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "url")
# Words that announce an identifier.
CUES = ("account", "acct", "iban", "ssn", "social security", "passport", "customer id", "member id", "tax id")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Between a cue and its number, in lower-cased text.
_BEHIND = re.compile(r"(?:[ _-]?(?:number|num|no|nr|id)\b\.?)?[ \t]{0,3}[:=#]?[ \t]{0,3}")
_NUMBER = re.compile(r"[A-Za-z]{0,2}[0-9](?:[ -]?[0-9A-Z]){5,33}(?![0-9A-Za-z])")
_IBAN_START = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[ -]?[0-9A-Za-z]){11,30}")
# Lengths of IBANs by country.
_IBAN_LENGTH = {
    country: length for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BF BI CF DJ FR GR IT MC MR SM TG",
        28: "AL AZ BJ BY CG CI CM CY DO GT HN HU KM LB MA MG ML MZ NE NI PL SN SV TD", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 32: "LC", 33: "RU",
    }.items() for country in countries.split()
}
_URL_REST = re.compile(r"[^\s<>\"'`]+")

SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
])


@lru_cache(maxsize=1)
def anchors():
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for cue in CUES:
        found.add_word(cue, (f"cue:{cue}", len(cue)))
    found.make_automaton()
    return found


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _iban(text: str) -> bool:
    plain = re.sub(r"[ -]", "", text).upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", plain):
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _lower(text: str) -> str:
    """ASCII letters lower-cased, so that the length stays."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _group_ends(text: str, begin: int, end: int) -> list[int]:
    """Where the groups between blanks of a number end, from the first to the last."""
    return [k for k in range(begin + 1, end) if text[k] == " "] + [end]


def _iban_end(text: str, begin: int) -> int | None:
    """The end of the IBAN at ``begin``: its country's length, or the longest groups that pass where the country is not known."""
    m = _IBAN_START.match(text, begin)
    if not m:
        return None
    length = _IBAN_LENGTH.get(text[begin : begin + 2].upper())
    if length is None:
        ends = reversed(_group_ends(text, begin, m.end()))
    else:
        places = [k for k in range(begin, m.end()) if text[k] not in " -"]
        ends = [places[length - 1] + 1] if len(places) >= length else []
    for end in ends:
        if (end == len(text) or not (text[end].isascii() and text[end].isalnum())) and _iban(text[begin:end]):
            return end
    return None


def _number_end(text: str, begin: int, cue: str) -> int | None:
    """The end of the number at ``begin`` that fits its cue."""
    if cue == "iban":
        return _iban_end(text, begin)
    m = _NUMBER.match(text, begin)
    if not m:
        return None
    ends = _group_ends(text, begin, m.end())
    if cue in ("ssn", "social security"):
        return next((end for end in ends if len(_digits(text[begin:end])) == 9), None)
    for end, after in zip(ends, ends[1:], strict=False):
        if not _digits(text[end:after]) and len(_digits(text[begin:end])) >= 6:
            return end
    return m.end() if len(_digits(m[0])) >= 6 else None


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans, by kind in the order of KINDS, then by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_end = card_next = ip_next = phone_end = account_end = url_end = 0
    lower = _lower(text)
    for last, (tag, size) in anchors().iter(lower):
        at = last - size + 1
        if tag == "digit":
            if at >= card_next:
                m = _CARD.match(text, at)
                card_next = m.end() if m else at + 1
                if m and 16 <= len(digits := _digits(m[0])) <= 19 and _luhn(digits):
                    found["card"].append(m.span())
            if at >= ip_next:
                m = _IP.match(text, at)
                ip_next = m.end() if m else _DIGITS.match(text, at).end()
                if m and all(map(_small, m[0].split("."))):
                    found["ip"].append(m.span())
        elif tag == "at":
            begin = at
            while begin > email_end and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at and (m := _DOMAIN.match(text, at + 1)):
                email_end = m.end()
                found["email"].append((begin, email_end))
        elif tag == "plus":
            if at >= phone_end and (m := _PHONE.match(text, at)):
                phone_end = m.end()
                if 8 <= len(_digits(m[0])) <= 15:
                    found["phone"].append(m.span())
        elif tag == "scheme":
            begin = at
            while begin > url_end and text[begin - 1] in _SCHEME:
                begin -= 1
            while begin < at and not (text[begin].isascii() and text[begin].isalpha()):
                begin += 1
            m = _URL_REST.match(text, last + 1)
            if at >= url_end and begin < at and m:
                end = last + 1 + len(m[0].rstrip(".,;:!?)]}"))
                if end > last + 1 and text[last + 1].isalnum():
                    url_end = end
                    found["url"].append((begin, end))
        elif at >= account_end and not (at and text[at - 1].isalnum()):
            begin = _BEHIND.match(lower, last + 1).end()
            end = _number_end(text, begin, tag[4:])
            if end:
                account_end = end
                found["account"].append((begin, end))
    return [(kind, a, b) for kind in KINDS for a, b in found[kind]]


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans, the first to start, then the longest."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _span_array(spans: list[list[tuple[str, int, int]]]) -> pa.Array:
    flat = [s for row in spans for s in row]
    return list_array(map(len, spans), pa.StructArray.from_arrays(
        [pa.array([s[i] for s in flat], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))],
        names=["kind", "start", "end"],
    ))


def find(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Append ``pii``, the spans of each whole text."""
    return add_columns(
        df, text_col, [T.StructField("pii", T.ArrayType(SPAN))],
        lambda part: [_span_array([spans_of(t) for t in texts_of(part.column(text_col))])],
    )


def redact(df: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = (*BASE_KINDS, "account")) -> DataFrame:
    """Replace the spans of ``kinds`` in the text by their kind; a null text stays null."""

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([
            None if t is None else masked(t, [s for s in spans_of(t) if s[0] in kinds])
            for t in part.column(text_col).to_pylist()
        ], pa.string())]

    name = df.select(text_col).columns[0]
    return add_columns(df, text_col, [T.StructField(name, T.StringType())], work).select(*df.columns)


def span_text(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of ``kinds``, comma-joined in their order."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(
        chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
