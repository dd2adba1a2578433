"""Personal data against patterns matched the plain way."""

from __future__ import annotations

import hashlib
import random
import re

from ledgerloom.llm import personal_data as pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes_luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and passes_luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((kind, *m.span()))
    return out


def base_of(text):
    return [tuple(s[:3]) for s in pii.spans(text) if s.kind in pii.ALWAYS]


CASES = [
    "", None, "no data", "a@b.c@d.e a@b.c_x@d.e @@ x@ @y.z .@a.b", "a.b%c+d-e_f@host-1.example.org.", "x@y x@y. x@.y ü@a.b é@ñ.c",
    "1.2.3.4.5.6.7.8 300.1.2.3.4 01.002.0255.000256 1.2.3 1..2.3.4", "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111",
    "0000000000000 00000000000000000000 5500005555555559-1", "+49 (30) 123-4567. +1 +12 +1(2 +123456789012345678 ++44 20 7946 0958-",
    "+1 415 555 2671 415 555 2671 ip 10.0.0.1 10.0.0.256",
]


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(3)
    cases = CASES + ["".join(rng.choices("09 12.-+(@)aZ_%ü", weights=[4, 2, 2, 3, 3, 3, 2, 2, 1, 2, 1, 1, 1, 1, 1, 1], k=60)) for _ in range(4000)]
    for text in cases:
        assert base_of(text) == plain_spans(text), text


def test_long_texts_take_time_in_proportion():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "1 " * 1_000_000, "+1" * 1_000_000, "a@" * 1_000_000, "+1 " + "-" * 2_000_000):
        pii.spans(text)


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB83WEST12345698765432")


def test_added_kinds_need_a_checksum_or_context():
    text = "Bank: GB82 WEST 1234 5698 7654 32 AND MORE, GB83 WEST 1234 5698 7654 32."
    assert [(s.kind, text[s.start: s.end]) for s in pii.spans(text)] == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert [s.kind for s in pii.spans("my ssn is 123-45-6789")] == ["ssn"]
    assert not pii.spans("part 123-45-6789") and not pii.spans("ssn 000-45-6789")
    assert [s.kind for s in pii.spans("call (030) 555-0199-12 now")] == ["local_phone"]
    assert not pii.spans("order (030) 555-0199-12 now")
    # one that overlaps a span of the first four kinds is left to it
    assert [s.kind for s in pii.spans("call 4111 1111 1111 1111")] == ["card"]


def test_context_raises_scores():
    plain, near = pii.spans("x 4111111111111111")[0], pii.spans("visa card 4111111111111111")[0]
    assert plain.score < near.score and plain.kind == near.kind == "card"


def test_report_and_outputs(spark, make_docs):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(None, "a@b.cd"), (3, CASES[3]), (99, "ü " * 50_000 + "10.0.0.1")]
    docs = make_docs(rows)
    got = sorted((tuple(r)[:6] for r in pii.report(docs).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        base = plain_spans(text)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        want.append((doc_id, *[sum(s[0] == k for s in base) for k in pii.ALWAYS], digest))
    assert got == sorted(want, key=repr)
    assert pii.report(docs.limit(0)).collect() == []

    found = pii.found(docs)
    assert found.columns == [*[c for c in docs.columns if c != "spans"], "spans"]  # a column of that name is replaced
    for r in found.where("doc_id = 3").collect():
        assert all(s["value"] == r["text"][s["start"]: s["end"]] for s in r["spans"])
    hidden = {r["doc_id"]: r["text"] for r in pii.masked(docs).where("doc_id in (0, 1, 2, 10)").collect()}
    assert hidden == {0: "", 1: None, 2: "no data", 10: "+1 415 555 2671 415 555 2671 ip <ip> 10.0.0.256"}
    assert pii.masked(docs).columns == docs.columns
