"""Base spans against plain regular expressions; checksums, context and masking."""

import random
import re

from tagweave.llm import pii
from tests.llm.odd import odd_docs, odd_texts

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def base(text):
    return [(s["kind"], s["start"], s["end"]) for s in pii.find_spans(text) if s["base"]]


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab.@-+ 1234567890()é", k=rng.randrange(80))) for _ in range(20_000)]
    texts += ["".join(rng.choices("4111 1-", k=rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choices("a.@", k=rng.randrange(12))) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["1" * 3000 + ".1.1.1", "4111 1111 1111 1111", "x@y.z@a.b", "1.2.3.4.5.6.7.8", "+1 (555) 123-4567.", "0255.0.0.1"]
    for text in texts:
        assert base(text) == plain_spans(text), text[:200]
    assert sum(map(len, map(base, texts))) > 100


def test_checksums_and_context():
    kinds = lambda t: [(s["kind"], s["score"]) for s in pii.find_spans(t)]
    assert kinds("pay GB82 WEST 1234 5698 7654 32 now") == [("iban", 0.7)]
    assert kinds("iban GB82WEST12345698765432") == [("iban", 1.0)]
    assert kinds("iban GB82WEST12345698765433") == []
    assert kinds("code 123-45-6789") == []
    assert kinds("ssn 123-45-6789") == [("ssn", 0.6)]
    assert kinds("card 4111111111111111") == [("card", 1.0)]
    assert kinds("4111111111111112") == []


def test_odd_rows(spark):
    docs = odd_docs(spark, [*odd_texts(), (None, "me@x.org"), (5, "a b c d e")])
    got = pii.find(docs, "text")
    assert got.count() == docs.count() and got.columns == docs.columns
    assert [s.kind for r in got.where("doc_id is null").collect() for s in r.spans] == ["email"]
    assert pii.find(odd_docs(spark, []), "text").count() == 0
    masked = pii.mask(docs, "text")
    assert masked.schema == docs.schema
    assert [r.text for r in masked.where("doc_id is null").collect()] == ["[EMAIL]"]
    assert {r.doc_id: r.text for r in masked.collect() if r.doc_id}.items() >= {r.doc_id: r.text for r in docs.collect() if r.doc_id and r.doc_id not in (9,)}.items()


def test_mask_overlapping():
    spans = [{"kind": "phone", "start": 2, "end": 9}, {"kind": "card", "start": 5, "end": 12}, {"kind": "ip", "start": 14, "end": 16}]
    assert pii.mask_text("ab0123456789cdEFg", spans) == "ab[PHONE]cd[IP]g"


def test_ibans_beside_other_words():
    ibans = lambda t: [t[s["start"] : s["end"]] for s in pii.find_spans(t) if s["kind"] == "iban"]
    plain, spaced, british = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    for iban in (plain, spaced, british, "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"):
        for before in ("", "IBAN ", "AB12 ", "REF AB12 34 "):
            for after in ("", ".", " BIC COBADEFFXXX", " EUR 50", " 2024", " Eur", " and", ", EUR", " X"):
                assert ibans(before + iban + after) == [iban], (before, iban, after)
    assert ibans(f"{plain} {spaced} {british} END") == [plain, spaced, british]
    # Too long for its country, glued to other letters, or with a wrong digit.
    assert ibans(f"{plain}EUR") == ibans("DE89370400440532013001 BIC COBADEFFXXX") == []
    # A country that the table lacks: mod-97 tells where the number ends.
    code = next(c for c in (f"ZZ{k:02d}" + "1" * 20 for k in range(2, 99)) if pii.mod97(c))
    assert ibans(f"{code} EUR 50") == [code]
    text = f"to {spaced} BIC COBADEFFXXX"
    assert pii.mask_text(text, pii.find_spans(text)) == "to [IBAN] BIC COBADEFFXXX"
