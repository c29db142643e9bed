"""Spans against plain regular expressions, checks, context and masking."""

import random
import re

from saleslake.llm import personal
from saleslake.llm.common import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and personal.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                found.append((kind, *m.span()))
    return found


def test_base_spans_equal_plain_patterns():
    random.seed(1)
    alphabet = [*"a1234567890.@-+ ()%_é", "1.2.3.4", "a@b.c", "+1 555 ", "4111 1111 1111 1111"]
    for _ in range(5000):
        text = "".join(random.choice(alphabet) for _ in range(random.randint(0, 40)))
        assert [s[:3] for s in personal.spans_of(text) if s[0] in personal.BASE] == plain_spans(text)


def test_checks():
    assert personal.luhn("4111111111111111") and not personal.luhn("4111111111111112")
    assert personal.mod97("GB82 WEST 1234 5698 7654 32") and not personal.mod97("GB82 WEST 1234 5698 7654 33")


def test_context_decides_on_further_kinds():
    assert [s[0] for s in personal.spans_of("pay to iban DE89 3704 0044 0532 0130 00 now")] == ["iban"]
    assert [s[0] for s in personal.spans_of("social security 123-45-6789")] == ["ssn"]
    assert personal.spans_of("item 123-45-6789") == []
    near, far = personal.scored("call me: +1 555 555 5555", "phone", 9, 24), personal.scored("+1 555 555 5555", "phone", 0, 15)
    assert near > far


def test_odd_texts(spark):
    long = "x" * 200_000 + " a@b.de " + "1" * 200_000
    rows = [(1, None, "s"), (2, "", "s"), (3, "mail a@b.de, a@b.de", "s"), (3, "mail a@b.de, a@b.de", "s"), (4, long, "s"), (None, "+", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((r.doc_id or 0, len(r.spans)) for r in personal.with_spans(df).collect())
    assert got == [(0, 0), (1, 0), (2, 0), (3, 2), (3, 2), (4, 1)]
    texts = [r.text for r in personal.redacted(df).filter("doc_id <= 3").orderBy("doc_id").collect()]
    assert texts == [None, "", "mail [EMAIL], [EMAIL]", "mail [EMAIL], [EMAIL]"]
    assert personal.with_spans(df.limit(0)).count() == 0


def test_overlapping_spans_become_one():
    spans = [{"kind": "card", "start": 2, "end": 8}, {"kind": "phone", "start": 1, "end": 5}, {"kind": "ip", "start": 8, "end": 9}]
    assert personal.redacted_text("abcdefghij", spans) == "a[PHONE][IP]j"


def test_query(spark, tables):
    rows = QUERIES["op2_pii_spans"](spark, tables).collect()
    assert len(rows) == 200
    for r in rows:
        assert sum(r[f"n_{k}"] for k in personal.BASE) <= len([s for s in r.spans.split(",") if s])


def test_account_numbers_end_where_their_country_says():
    """The words behind a number are not taken for a part of it, with or without blanks inside."""
    found = lambda text: [text[a:b] for kind, a, b, _ in personal.spans_of(text) if kind == "iban"]
    for number in ("BE68 5390 0754 7034", "BE68539007547034", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "FR14 2004 1010 0505 0001 3M02 606"):
        for text in ("pay {}", "pay {} TODAY", "{} FROM me", "{} NOW 12 AND", "iban {}.", "({})", "{} {}"):
            times = text.count("{}")
            assert found(text.format(*[number] * times)) == [number] * times, text
    for wrong in ("BE69 5390 0754 7034", "BE68 5390 0754 7034X", "BE68 5390 0754  7034", "XX68 5390 0754 7034", "BE68", "BE68 5390", "aBE68539007547034"):
        assert found(f"pay {wrong} now") == []


def test_texts_are_masked_in_one_python_process_a_task(spark):
    """A function on the spans of another one had two processes for each task, and both kept their memory for the stages behind."""
    df = spark.createDataFrame([(1, "call +44 20 7946 0958"), (2, None), (3, ""), (4, "none")], "doc_id long, text string")
    masked = personal.redacted(df)
    assert masked._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [r.text for r in masked.orderBy("doc_id").collect()] == ["call [PHONE]", None, "", "none"]
