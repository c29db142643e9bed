"""The multiset hash is homomorphic, and the query equals a plain walk over the documents."""

import hashlib
import random

from saleslake.llm import fingerprint as fp
from saleslake.llm.common import QUERIES, table


def one(text):
    return fp.written_out(*[v[0] for v in fp.vectors([text])])


PARAGRAPHS = ["The first line of it all.", "Two", "Three words here", "", "The first line of it all.", "ünïcode wörds ärë hërë too"]


def test_order_does_not_matter_and_parts_add_up():
    shuffled = random.Random(1).sample(PARAGRAPHS, len(PARAGRAPHS))
    whole = one("\n".join(PARAGRAPHS))
    assert whole == one("\n".join(shuffled)) != one("\n".join(PARAGRAPHS[1:]))
    assert fp.combined(one("\n".join(PARAGRAPHS[:2])), one("\n".join(PARAGRAPHS[2:]))) == whole
    assert fp.combined(whole, one(PARAGRAPHS[0]), -1) == one("\n".join(PARAGRAPHS[1:]))
    assert one("") == one("\n \n") and one("a") != one("b")


def test_batches_do_not_matter():
    texts = PARAGRAPHS + ["\n".join(PARAGRAPHS), "x " * 5000]
    assert [fp.written_out(*v) for v in zip(*fp.vectors(texts), strict=True)] == [one(t) for t in texts]


def test_likeness_follows_the_share_in_common():
    random.seed(2)
    words = [f"w{random.randrange(10**6)}" for _ in range(800)]
    other = [f"v{i}" for i in range(800)]

    def like(a, b):
        (x, y), (p, q) = ([v[0] for v in fp.vectors([" ".join(t)])] for t in (a, b))
        return fp.likeness((x, y), (p, q))

    assert like(words, words) == 1.0
    assert 0.6 < like(words, words[:600] + other[:200]) < 0.9
    assert like(words, other) < 0.25


def test_columns(spark):
    df = spark.createDataFrame([(1, "a\nb c", "d"), (2, None, "d")], "id long, text string, fingerprint string")
    got = {r.id: r.fingerprint for r in fp.with_fingerprint(df).collect()}
    assert got == {1: one("a\nb c"), 2: one("")}
    more = fp.with_fingerprint(df).select("id", fp.with_paragraphs("fingerprint", "text").alias("twice"), fp.without_paragraphs("fingerprint", "text").alias("none"))
    for r in more.collect():
        assert r.none == one("") and r.twice == fp.combined(got[r.id], got[r.id])


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        a, b, c = ([v[0] for v in fp.vectors([t])] for t in (text, edited, following))
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), one(text), one(edited), fp.likeness(a, b), fp.likeness(a, c)))
    return out


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


def test_neighbours_of_odd_rows(spark):
    rows = [(None, "first of all words here"), (4, None), (4, "b"), (4, "b"), (9, ""), (7, "x " * 200_000), (-3, "minus one two three"), (12, "ünder the bridge")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(fp.compared_with_next(df)) == sorted(plain(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    assert fp.compared_with_next(df.limit(0)).count() == 0
    alone = fp.compared_with_next(spark.createDataFrame([(1, "some words stand here")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0


def test_query_equals_a_plain_walk(spark, tables):
    rows = [(r.doc_id, r.text) for r in table(spark, tables, "documents").collect()]
    got = as_rows(QUERIES["op8_multiset_fingerprints"](spark, tables))
    assert got == sorted(plain(rows), key=lambda r: (True, r[0], r[2]))
