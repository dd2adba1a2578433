"""Personal data in texts: patterns propose spans, checksums confirm them, context words raise scores.

Each kind has a pattern, a check and words that stand near such data. A span's score is what its
pattern is worth, plus what a checksum adds where the kind has one, plus what a context word within
``BEFORE`` code points before it (``AFTER`` behind it) adds. Kinds of ``ALWAYS`` need only their
pattern and check, and their spans stay whatever their score; the other kinds need ``ACCEPT``, so
that numbers of no clear meaning are left alone. A span of another kind that overlaps one of
``ALWAYS`` is dropped.

Every scan takes time in proportion to the text: patterns consume a whole run of digits or of
address characters where they start, so that none is tried again from inside the run.

Defined results: a null text is empty, an empty text has no spans; rows are judged one by one, so
repeated rows repeat their spans; a null doc_id stays null; places are code points, the end
exclusive. Kinds are told apart, so spans of different kinds of ``ALWAYS`` may overlap.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import in_small_batches

BEFORE, AFTER = 48, 16
ACCEPT = 0.7
PATTERN, CHECKSUM, CONTEXT = 0.4, 0.4, 0.3

#: Kinds in the order of the results; the first four are reported on pattern and check alone.
KINDS = ("email", "ip", "card", "phone", "iban", "local_phone", "ssn")
ALWAYS = KINDS[:4]

# Words that stand near such data, in several languages.
NEAR = {
    "email": ("e-mail", "email", "mail", "correo", "contact", "contacto", "kontakt"),
    "ip": ("ip", "host", "server", "address", "login", "servidor", "adresse"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "tarjeta", "karte", "carte"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte", "bic", "swift"),
    "local_phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "teléfono", "téléphone"),
    "ssn": ("ssn", "social security", "social-security", "taxpayer"),
}
# Length of an international bank account number by country.
IBAN_LENGTH = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24,
}

_LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]++((?:\.[0-9]++){3})?+")
_GROUPED = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_LOCAL_PHONE = re.compile(r"\(?[0-9]{2,5}\)?[ ./-]{1,2}[0-9]{3,4}(?:[ .-][0-9]{2,4}){1,2}")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_CONTEXT = {kind: re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words))})(?!\w)") for kind, words in NEAR.items()}
_NOT_DIGITS = str.maketrans("", "", " ().-")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """The check digit of payment cards."""
    twice = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    values = [ord(c) - 48 for c in reversed(digits)]
    return (sum(values[::2]) + sum(twice[v] for v in values[1::2])) % 10 == 0


def mod97(number: str) -> bool:
    """The check digits of bank account numbers: the first four signs moved to the end, letters as
    10 to 35, leave 1 when divided by 97."""
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Only an @ can stand between the parts of an address, so each is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(_LOCAL_PART))
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            done = domain.end()
            yield start, done
        else:
            done = at + 1
        at = text.find("@", done)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _DOTTED.finditer(text):
        if found[1]:
            parts = [part.lstrip("0") for part in found[0].split(".")]
            if all(len(part) < 3 or (len(part) == 3 and part <= "255") for part in parts):
                yield found.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _GROUPED.finditer(text):
        if found.end() - found.start() < 13:
            continue
        digits = found[0].translate(_NOT_DIGITS)
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 9 <= len(found[0].translate(_NOT_DIGITS)) - 1 <= 15:
            yield found.span()


def _apart(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit touches the span."""
    return not (text[start - 1: start].isalnum() or text[end: end + 1].isalnum())


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for found in _IBAN.finditer(text):
        size = IBAN_LENGTH.get(found[0][:2])
        signs = [at for at in range(*found.span()) if text[at] != " "]
        if size is None or len(signs) < size:
            continue
        start, end = found.start(), signs[size - 1] + 1
        if _apart(text, start, end) and mod97("".join(text[at] for at in signs[:size])):
            yield start, end


def local_phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _LOCAL_PHONE.finditer(text):
        digits = sum(c.isdigit() for c in found[0])
        if 9 <= digits <= 12 and _apart(text, *found.span()) and text[found.start() - 1: found.start()] not in ("+", "-", "."):
            yield found.span()


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for found in _SSN.finditer(text):
        area, group, serial = found[0].split("-")
        real = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
        if real and _apart(text, *found.span()):
            yield found.span()


#: What a kind's spans must hold at all, how they are found, and whether a checksum confirmed them.
_FINDERS: dict[str, tuple[str, Callable[[str], Iterator[tuple[int, int]]], bool]] = {
    "email": ("@", emails, False),
    "ip": (".", ips, False),
    "card": ("", cards, True),
    "phone": ("+", phones, False),
    "iban": ("", ibans, True),
    "local_phone": ("", local_phones, False),
    "ssn": ("-", ssns, False),
}


def _score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    around = f"{text[max(start - BEFORE, 0): start]} {text[end: end + AFTER]}".lower()
    near = _CONTEXT[kind].search(around) is not None
    return round(PATTERN + CHECKSUM * confirmed + CONTEXT * near, 2)


def spans(text: str | None, accept: float = ACCEPT) -> list[Span]:
    """All spans of a text, by kind and start."""
    if not text:
        return []
    out: list[Span] = []
    digits = _DIGIT.search(text) is not None
    for kind in KINDS:
        needs, find, confirmed = _FINDERS[kind]
        if needs not in text or not (digits or kind == "email"):
            continue
        certain = kind in ALWAYS
        for start, end in find(text):
            score = _score(text, kind, start, end, confirmed)
            if certain or (score >= accept and not any(s.start < end and start < s.end for s in out)):
                out.append(Span(kind, start, end, score))
    return out


def written(found: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in found)


def found(docs: DataFrame, accept: float = ACCEPT, text: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with an array of spans: kind, start, end, score and the text found."""
    fields = "kind string, start long, end long, score double, value string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("value", pa.string())]))
        for batch in batches:
            rows = [[s._asdict() | {"value": x[s.start: s.end]} for s in spans(x, accept)] for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, kind), batch.column(1)], names=["found", "_row"])

    return _beside(docs, text, work, T.ArrayType(T.StructType.fromDDL(fields)), name)


def masked(docs: DataFrame, accept: float = ACCEPT, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind, as in <card>; of spans that
    overlap, the whole stretch by the kind that starts first."""

    def hidden(value: str | None) -> str | None:
        out, done = [], 0
        for span in sorted(spans(value, accept), key=lambda s: (s.start, -s.end)):
            if span.start >= done:
                out += [value[done: span.start], f"<{span.kind}>"]
            done = max(done, span.end)
        return value if not out else "".join([*out, value[done:]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [hidden(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string()), batch.column(1)], names=["found", "_row"])

    return _beside(docs, text, work, T.StringType(), text).select(*[F.col(f"`{c}`") for c in docs.columns])


def _beside(docs: DataFrame, text: str, work: Callable, kind: T.DataType, name: str) -> DataFrame:
    """All columns of ``docs`` and what ``work`` makes of the text; the row travels as one struct."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    packed = in_small_batches(docs).select(F.col(f"`{text}`").alias("found"), row)
    schema = T.StructType([T.StructField("found", kind), T.StructField("_row", packed.schema["_row"].dataType)])
    out = packed.mapInArrow(work, schema)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != name], F.col("found").alias(name))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: spans of each kind of ``ALWAYS``, the digest of those, and all spans."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [spans(x) for x in batch.column(1).to_pylist()]
            base = [[s for s in row if s.kind in ALWAYS] for row in rows]
            counts = [pa.array([sum(s.kind == kind for s in row) for row in base], pa.int64()) for kind in ALWAYS]
            digests = [hashlib.sha256(written(row).encode()).hexdigest() for row in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digests, pa.string()), pa.array([written(row) for row in rows], pa.string())],
                names=["doc_id", *[f"n_{kind}" for kind in ALWAYS], "base_sha256", "spans"],
            )

    schema = f"doc_id long, {', '.join(f'n_{kind} long' for kind in ALWAYS)}, base_sha256 string, spans string"
    return in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, schema)
