"""Personal data: regular expressions propose, checksums confirm, nearby words adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import slices

# Order of kinds in results. The first four always report their confirmed spans.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

# Score of a confirmed span without context; a context word in the window adds CONTEXT.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
CONTEXT = 0.3
MIN_SCORE = 0.5
WINDOW = 60  # characters before and after a span

WORDS = {
    "email": r"e-?mail|mail|contact|kontakt|correo|courriel",
    "ip": r"ip|host|server|address|client|adresse",
    "card": r"card|credit|visa|mastercard|amex|karte|tarjeta|carte",
    "phone": r"phone|tel|call|mobile|fax|cell|telefon|teléfono",
    "iban": r"iban|bank|account|konto|cuenta|compte",
    "ssn": r"ssn|social security|social",
}
_CONTEXT = {k: re.compile(rf"(?<!\w)(?:{w})(?!\w)", re.IGNORECASE) for k, w in WORDS.items()}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is taken whole: where it may end does not depend on where it began.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
# Characters of an IBAN by country.
_IBAN_LENGTHS = {
    n: countries.split()
    for n, countries in (
        (15, "NO"), (16, "BE"), (18, "DK FI FK FO GL NL SD"), (19, "MK SI"), (20, "AT BA EE KZ LT LU MN XK"), (21, "CH HR LI LV"),
        (22, "BG BH CR DE GB GE IE ME RS VA"), (23, "AE GI IL IQ OM SO TL"), (24, "AD CZ ES MD PK RO SA SE SK TN VG"), (25, "LY PT ST"), (26, "IS TR"),
        (27, "BI DJ FR GR IT MC MR SM"), (28, "AL AZ BY CY DO GT HN HU LB NI PL SV"), (29, "BR EG PS QA UA"), (30, "JO KW MU YE"), (31, "MT SC"), (32, "LC"), (33, "RU"),
    )
}
IBAN_LENGTH = {c: n for n, countries in _IBAN_LENGTHS.items() for c in countries}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])
SPAN_DDL = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(code: str) -> bool:
    """ISO 7064 check of an IBAN: letters count from 10, the first four characters go to the end."""
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, in linear time: only an ``@`` starts any work."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _numbers(text: str, start: int, stop: int, listed: bool) -> Iterator[tuple[int, int]]:
    """Leftmost account numbers of countries with or without a known length, ending at a word's end."""
    m = _IBAN.search(text, start, stop)
    while m:
        end, want = m.start() + 1, IBAN_LENGTH.get(m[0][:2])
        if (want is not None) == listed:
            for at in (m.end(), *(i for i in range(m.end() - 1, m.start(), -1) if text[i] == " ")):
                code = text[m.start() : at].replace(" ", "")
                if (len(code) == want if listed else 15 <= len(code) <= 34) and mod97(code):
                    yield m.start(), at
                    end = at
                    break
        m = _IBAN.search(text, end, stop)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Non-overlapping account numbers, without the words that follow them.

    A country's numbers have one length. What lies between them may be a number of a country
    without a known one; it has as many words as the check confirms.
    """
    done = 0
    for start, end in [*_numbers(text, 0, len(text), True), (len(text), len(text))]:
        yield from _numbers(text, done, start, False)
        if start < end:
            yield start, end
        done = end


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    yield from (("email", *span) for span in _emails(text))
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m[0].split(".")):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", *m.span()
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield "phone", *m.span()
    yield from (("iban", *span) for span in _ibans(text))
    for m in _SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "ssn", *m.span()


def find_spans(text: str | None) -> list[dict]:
    """Spans of one text by kind, then start; ends are exclusive code points."""
    out = []
    for kind, start, end in _proposed(text or ""):
        score = START[kind]
        around = _CONTEXT[kind]
        if around.search(text, max(0, start - WINDOW), start) or around.search(text, end, end + WINDOW):
            score = min(1.0, score + CONTEXT)
        if score >= MIN_SCORE:
            out.append({"kind": kind, "start": start, "end": end, "score": score, "base": kind in BASE_KINDS})
    return out


def find(df: DataFrame, text_col: str, out_col: str = "spans") -> DataFrame:
    """``df`` with an array of spans ``(kind, start, end, score, base)``; a null text has none.

    Kinds may overlap each other. Rows are handled one by one, without a shuffle, so repeated
    rows and extra columns are kept; a column that is already called ``out_col`` is replaced.
    """
    kept = [c for c in df.columns if c != out_col or c == text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(kept)):
            spans = pa.array([find_spans(t) for t in batch.column("_text").to_pylist()], pa.list_(SPAN))
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, spans], names=[f"c{i}" for i in range(len(kept) + 1)])

    own = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(text_col).cast("string").alias("_text"))
    ddl = ", ".join(f"c{i} {own.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(kept)))
    found = own.mapInArrow(run, f"{ddl}{', ' if ddl else ''}c{len(kept)} {SPAN_DDL}")
    named = [F.col(f"c{i}").alias(c) for i, c in enumerate(kept) if c != out_col]
    return found.select(*named, F.col(f"c{len(kept)}").alias(out_col))


def mask_text(text: str | None, spans: list[dict]) -> str | None:
    """``text`` with each span, or group of overlapping spans, replaced by its first kind in brackets."""
    if text is None or not spans:
        return text
    out, done = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= done:
            out += [text[done : s["start"]], f"[{s['kind'].upper()}]"]
        done = max(done, s["end"])
    return "".join([*out, text[done:]])


def mask(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with the found spans of ``text_col`` masked; all other columns stay as they are."""
    columns, at = df.columns, df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            texts = batch.column(at).to_pylist()
            masked = pa.array([mask_text(t, find_spans(t)) for t in texts], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), masked)

    return df.mapInArrow(run, df.schema).select(*columns)
