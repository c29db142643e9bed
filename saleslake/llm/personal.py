"""Personal data in texts: patterns propose spans, checksums confirm them, nearby context words adjust the score.

Per kind, matches are taken from left to right without overlap; a match that fails its check is dropped and not
retried. The scans are linear in the length of a text: an address is sought only around its `@`, and all other kinds only
in texts that hold a digit, with patterns that never go back over what they have taken.

Kinds of the base set (email, ip, card, phone) are always kept; the context only moves their score. The further kinds (iban
with its mod-97 check, ssn) are kept when pattern, check and context together reach `KEEP`.

Defined results: a null or empty text has no spans; a null span list redacts nothing; offsets are code points with
an exclusive end. A column named `spans` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm.common import joined, list_array, query, slices, strings, table

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "ssn"]
SPANS = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
    .add("score", T.DoubleType())
)
KEEP = 0.6
REACH = 48

# Score of a confirmed match without context, and the context words that raise it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.75, "phone": 0.65, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": "mail email e-mail contact write kontakt correo courriel",
    "ip": "ip address host server login adresse servidor serveur",
    "card": "card visa mastercard credit debit payment karte kreditkarte tarjeta carte",
    "phone": "phone tel telephone call mobile fax telefon anruf llame teléfono téléphone",
    "iban": "iban bank account konto cuenta compte bic swift",
    "ssn": "ssn social security",
}
# Lengths of account numbers by country.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 "
    "GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 "
    "NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
)
LOWERS = "version order example test sample invoice item isbn id"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_RAISES = {kind: re.compile(rf"\b(?:{'|'.join(map(re.escape, words.split()))})\b", re.I) for kind, words in CONTEXT.items()}
_LOWERS = re.compile(rf"\b(?:{'|'.join(LOWERS.split())})\b", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _emails(text: str):
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            free = domain.end()
            yield start, free
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)


def _ips(text: str):
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 3 or (len(p) == 3 and p <= "255") for part in m.group().split(".")):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m.group())) <= 15:
            yield m.span()


_LENGTH_OF = {entry[:2]: int(entry[2:]) for entry in IBAN_LENGTHS.split()}
_ACCOUNT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def _ibans(text: str):
    """From a country and two digits, as many letters and digits as the country has, single blanks between them allowed."""
    free = 0
    for m in _IBAN.finditer(text):
        left, at = _LENGTH_OF.get(m.group()[:2], 0) - 4, m.end()
        if left <= 0 or m.start() < free:
            continue
        while left and at < len(text):
            if text[at] in _ACCOUNT:
                left -= 1
            elif text[at] != " " or text[at - 1] == " ":
                break
            at += 1
        whole = not left and (at == len(text) or not (text[at].isascii() and text[at].isalnum()))
        if whole and mod97(text[m.start() : at]):
            free = at
            yield m.start(), at


def _ssns(text: str):
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns}


def scored(text: str, kind: str, start: int, end: int) -> float:
    """The score of a confirmed match after a look at the words around it."""
    around = text[max(0, start - REACH) : start] + " \n " + text[end : end + REACH]
    score = SCORES[kind] + 0.2 * bool(_RAISES[kind].search(around)) - 0.15 * bool(_LOWERS.search(around))
    return round(min(1.0, max(0.0, score)), 3)


def spans_of(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of all kept spans, by kind in the order of `KINDS`, then by start."""
    found = []
    digits = bool(_DIGIT.search(text))
    for kind in KINDS:
        if digits or kind == "email":
            for start, end in _FINDERS[kind](text):
                score = scored(text, kind, start, end)
                if kind in BASE or score >= KEEP:
                    found.append((kind, start, end, score))
    return found


def redacted_text(text: str, spans: list[dict] | None) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named after the first."""
    out, free = [], 0
    for span in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
        if span["start"] >= free:
            out += [text[free : span["start"]], f"[{span['kind'].upper()}]"]
        free = max(free, span["end"])
    return "".join(out) + text[free:]


@F.arrow_udf(SPANS)
def find_spans(texts: pa.Array) -> pa.Array:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    pieces = []
    for piece in slices(texts):
        rows = [spans_of(t) for t in strings(piece)]
        flat = [s for row in rows for s in row]
        values = pa.StructArray.from_arrays(
            [pa.array([s[i] for s in flat], kind.field(i).type) for i in range(4)], fields=list(kind)
        )
        pieces.append(list_array(values, map(len, rows)))
    return joined(pieces, pa.list_(kind))


@F.arrow_udf(T.StringType())
def _redacted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Finds and replaces in one worker: a second function on the spans of a first one would keep another process for each task."""
    fields = ("kind", "start", "end", "score")
    for texts in batches:
        for piece in slices(texts):
            rows = ((t, t and [dict(zip(fields, s, strict=True)) for s in spans_of(t)]) for t in piece.to_pylist())
            yield pa.array([redacted_text(t, spans) if spans else t for t, spans in rows], pa.string())


def with_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Add `spans`: array of (kind, start, end, score)."""
    return df.withColumn("spans", find_spans(text))


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span of the text column by its kind in brackets; a null text stays null."""
    return df.withColumn(text, _redacted(text))


@query("op2_pii_spans")
def op2_pii_spans(spark, folder):
    """Spans of every document: counts of the base kinds, the digest of their places, and all spans."""
    found = with_spans(table(spark, folder, "documents").select("doc_id", "text")).drop("text")

    def places(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    base = F.filter("spans", lambda s: s["kind"].isin(BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.withColumns(
        {**{f"n_{k}": count(k) for k in BASE}, "base_sha256": F.sha2(places(base), 256), "min_score": F.array_min(F.transform("spans", lambda s: s["score"]))}
    ).withColumn("spans", places("spans"))
