"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import pytest

from saleslake.llm import pieces
from saleslake.llm.common import QUERIES, table

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


@pytest.fixture(scope="module")
def prefix_table():
    return pieces._of_worker(*pieces.vocabulary(pieces.model_path()))


def test_ids_equal_the_library(library, prefix_table):
    random.seed(3)
    alphabet = [*"abcdeth  sino", "  ", "\n", "é", "中", "▁", "😀", "\t", "\x00", "\x01", "ß", "<", ">", "0", ".", "     "]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(2000)]
    texts += [" " * n + "ab" + " " * n for n in range(80)] + ["internationalization" * 40, "\n" * 50]
    ids, counts = prefix_table.encoded(texts)
    at = 0
    for text, count in zip(texts, counts, strict=True):
        got, at = ids[at : at + count].tolist(), at + count
        assert got == library.encode(text), text
        assert prefix_table.decoded(got) == library.decode(got)


def test_decoding_any_ids(library, prefix_table):
    random.seed(4)
    for _ in range(2000):
        ids = [random.randrange(32000) if random.random() < 0.6 else random.randrange(3, 259) for _ in range(random.randint(0, 12))]
        assert prefix_table.decoded(ids) == library.decode(ids), ids


def test_memos_may_overflow(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_WORDS", 5)
    monkeypatch.setattr(pieces, "PAIR_BITS", 6)
    small = pieces.PrefixTable(*pieces.vocabulary(pieces.model_path()))
    for text in ["the cat sat on the mat and looked out", "another line of quite different words", "the cat sat"] * 3:
        assert small.encoded([text])[0].tolist() == library.encode(text)


def test_odd_rows(spark, library):
    long = "word " * 60_000
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (3, "a"), (4, long), (None, " ")], "doc_id long, text string")
    path = pieces.model_path()
    coded = pieces.with_decoded(pieces.with_ids(df.withColumn("ids", df.text), path), path).collect()
    for r in coded:
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids)
    assert pieces.with_ids(df.limit(0), path).count() == 0


def test_query(spark, tables, library):
    texts = {r.doc_id: r.text for r in table(spark, tables, "documents").collect()}
    for r in QUERIES["op4_piece_ids"](spark, tables).collect():
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_each_text_is_encoded_once(spark, tables):
    """One call per batch of input in the plan, and every text in one call."""
    plan = QUERIES["op4_piece_ids"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    calls = [line for line in plan.splitlines() if "ArrowEvalPython" in line and "[" in line]
    assert len(calls) == 1 and calls[0].count("coded(") == 1


def test_results_leave_in_pieces(spark, library):
    df = spark.createDataFrame([(i, f"text {i} " + "word " * 200_000) for i in range(6)], "doc_id long, text string").coalesce(1)
    coded = df.select("doc_id", pieces.Pieces(spark, pieces.model_path()).coded("text").alias("c")).select("doc_id", "c.*").collect()
    wanted = {i: library.encode(f"text {i} " + "word " * 200_000) for i in range(6)}
    assert {r.doc_id: r.ids for r in coded} == wanted and all(r.decoded == library.decode(r.ids) for r in coded)


def test_a_long_word_is_not_kept_for_good(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_CHARACTERS", 100)
    small = pieces.PrefixTable(*pieces.vocabulary(pieces.model_path()))
    for text in ["abc" * 100, "one two", "three"]:
        assert small.encoded([text])[0].tolist() == library.encode(text)
    assert small.characters < 100
