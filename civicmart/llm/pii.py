"""Personal data in text: patterns propose spans, checksums confirm them, nearby words adjust the score.

Every kind has a pattern, a validator and a prior score out of 100. The base kinds (email, ip,
card, phone) stay whenever their validator passes; the score only tells how sure that is. The
added kinds (iban, ssn, local_phone) stay from ``THRESHOLD`` on, so a number without a checksum
needs a context word near it, and none of them may overlap a base span. Context words stand
within ``NEAR`` code points before or after a span; a word that speaks against the kind lowers
the score again.

Patterns are matched leftmost, without overlap within a kind; a match that its validator refuses
is dropped and not tried again at other lengths. All passes are linear in the text, so runs of
millions of digits or letters cost no more than prose: no scan starts inside a run that an earlier
scan has read to its end.

Spans are code points, end exclusive, ordered by start, then kind as in ``KINDS``. Defined results:
null and empty texts have no spans; repeated rows each get their own row; a null doc_id stays null;
other columns are ignored; ties in score need no order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import numbered, pick

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local_phone")
KINDS = (*BASE, *ADDED)
#: Score from which an added span stays; what a checksum and a context word are worth.
THRESHOLD, CHECKSUM, CONTEXT = 60, 40, 20
#: Reach of context words in code points.
NEAR = 40

# Patterns of the kinds (ASCII).
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "local_phone": r"\(?\b[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}\b",
}
PRIORS = {"email": 80, "ip": 50, "card": 40, "phone": 60, "iban": 40, "ssn": 40, "local_phone": 40}
# Words that speak for a kind, and words that speak against any, in lower case.
FOR = {
    "email": ("email", "e-mail", "mail", "contact", "correo"),
    "ip": ("ip", "address", "host", "server", "login", "adresse"),
    "card": ("card", "credit", "visa", "mastercard", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "handy"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "social insurance"),
    "local_phone": ("phone", "tel", "telephone", "mobile", "cell", "call", "fax"),
}
AGAINST = ("version", "isbn", "order", "invoice", "serial", "example", "sample")
# Lengths of account numbers by country (ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO EG GT HU LB NI PL SV", 29: "BR PS QA UA",
    30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}

LENGTH = {country: n for n, group in IBAN_LENGTHS.items() for country in group.split()}
_LOWER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# The same matches with bounded backtracking: no address starts inside a run of digits (what fails
# from the run's start fails from there too), and a card's digits never need to be given back.
_IP = re.compile(r"(?<![0-9])" + PATTERNS["ip"])
_OTHER = {k: re.compile(PATTERNS[k], re.ASCII) for k in ("phone", *ADDED)}
_OTHER["card"] = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_DIGIT = re.compile(r"[0-9]")


def near_pattern(words) -> str:
    """Pattern of any of the words, whole."""
    return r"\b(?:" + "|".join(re.escape(w) for w in words) + r")\b"


_FOR = {k: re.compile(near_pattern(w), re.ASCII) for k, w in FOR.items()}
_AGAINST = re.compile(near_pattern(AGAINST), re.ASCII)


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: int


def luhn(digits: str) -> bool:
    """Whether the digits' check digit is right: every second one from the right counts double."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number's check digits are right (letters count 10 to 35)."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern: from each ``@`` and its domain back over the local part, but
    not into the match before. Going back keeps long runs without an ``@`` linear."""
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def confirmed(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """Ranges of one kind that its validator lets pass."""
    if kind == "email":
        yield from emails(text)
        return
    if kind == "ip":
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in m.group().split("."))):
                yield m.span()
        return
    for m in _OTHER[kind].finditer(text):
        start, end = m.span()
        if kind == "iban":
            size, spaced = LENGTH.get(text[start : start + 2], 0), text[start + 4] == " "
            cut = start + size + ((size - 1) // 4 if spaced else 0)
            if not size or cut > end or (cut < end and text[cut] != " "):
                continue
            if mod97(text[start:cut].replace(" ", "")):
                yield start, cut
            continue
        digits = "".join(_DIGIT.findall(m.group()))
        if (
            (kind == "card" and 14 <= len(digits) <= 19 and luhn(digits))
            or (kind == "phone" and 10 <= len(digits) <= 15)
            or (kind == "ssn" and digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000")
            or kind == "local_phone"
        ):
            yield start, end


def score_of(kind: str, lowered: str, start: int, end: int) -> int:
    """Prior, checksum and context words of a span, between 0 and 100."""
    around = lowered[max(start - NEAR, 0) : start] + "\n" + lowered[end : end + NEAR]
    score = PRIORS[kind] + (CHECKSUM if kind in ("card", "iban") else 0)
    score += CONTEXT * bool(_FOR[kind].search(around)) - CONTEXT * bool(_AGAINST.search(around))
    return max(0, min(score, 100))


def spans_of(text: str | None) -> list[Span]:
    """All spans of one text, in order."""
    if not text:
        return []
    lowered = None
    found: list[Span] = []
    taken: list[tuple[int, int]] = []
    for kind in KINDS:
        if kind == ADDED[0]:
            taken = sorted((s.start, s.end) for s in found)
        at, reach = 0, -1
        for start, end in confirmed(kind, text):
            lowered = lowered if lowered is not None else text.translate(_LOWER)
            if kind in ADDED:
                # ends of the base spans that begin before this one's end
                while at < len(taken) and taken[at][0] < end:
                    reach = max(reach, taken[at][1])
                    at += 1
                if reach > start:
                    continue
            score = score_of(kind, lowered, start, end)
            if kind in BASE or score >= THRESHOLD:
                found.append(Span(kind, start, end, score))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    if text is None:
        return None
    out, done = [], 0
    for s in spans_of(text):
        if s.start >= done:
            out += [text[done : s.start], f"<{s.kind}>"]
        done = max(done, s.end)
    return "".join(out) + text[done:]


def _spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[(s.kind, s.start, s.end, s.score) for s in spans_of(t)] for t in texts], dtype=object)


def _redacted(texts: pd.Series) -> pd.Series:
    return pd.Series([redact(t) for t in texts], dtype=object)


def find(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end, score), one row per document."""
    spans = pandas_udf(_spans, "array<struct<kind: string, start: int, end: int, score: int>>")
    return pick(docs, "doc_id", "text").select("doc_id", spans("text").alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with personal data replaced in ``text``."""
    table, name = numbered(docs)
    clean = pandas_udf(_redacted, "string")
    return table.select(*(clean(c).alias(c) if c == name["text"] else c for c in table.columns)).toDF(*docs.columns)


def count_of(kind: str, spans: Column) -> Column:
    """How many spans are of a kind (long)."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
