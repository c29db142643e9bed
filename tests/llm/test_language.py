"""Held-out accuracy, spans of mixed texts, Viterbi against brute force, odd rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslake.llm import language as lg
from saleslake.llm.common import QUERIES, table

ENGLISH = "the house of the man was on the hill and there was a tree with many leaves in the garden"
GERMAN = "das haus des mannes stand auf dem hügel und dort war ein baum mit vielen blättern im garten"
GREEK = "το σπίτι του άνδρα ήταν στο λόφο και υπήρχε ένα δέντρο με πολλά φύλλα στον κήπο"


def trained(spark):
    rows = [(i, " ".join(random.Random(i).sample(t.split(), 12)), k) for i in range(40) for t, k in ((ENGLISH, "en"), (GERMAN, "de"), (GREEK, "el"))]
    rows += [(99, None, "en"), (98, "unlabelled", None), (97, "", "de")]
    return lg.Languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_spans_of_mixed_text_and_odd_rows(spark):
    model = trained(spark)
    mixed = f"{ENGLISH}. {GERMAN}. {GREEK}."
    rows = [(1, mixed), (2, None), (3, ""), (4, "123 --- !"), (5, GREEK), (5, GREEK), (6, (ENGLISH + " ") * 12_000), (7, "的"), (None, ENGLISH.upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.f) for r in df.select("doc_id", model.predict("text").alias("f")).collect()]
    by = dict(got)
    assert len(got) == len(rows)
    spans = [(s.lang, mixed[s.start : s.end]) for s in by[1].spans]
    assert [k for k, _ in spans] == ["en", "de", "el"]
    assert spans[2][1] == GREEK
    assert [by[k].lang_pred for k in (2, 3, 4)] == ["und"] * 3 and by[2].score == 0.0
    assert by[5].lang_pred == "el" and by[5].score > 0.9
    assert by[6].lang_pred == "en" and by[None].lang_pred == "en"
    assert by[7].lang_pred in ("de", "el", "en") and by[7].score == 0.0
    assert df.limit(0).select(model.predict("text")).count() == 0


def test_without_labels_everything_is_undetermined(spark):
    model = lg.Languages(spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string"))
    df = spark.createDataFrame([("abc",)], "text string")
    assert df.select(model.predict("text").alias("f")).first().f.lang_pred == "und"


@pytest.mark.parametrize("few", [0, 1, 2, 6])
def test_viterbi_equals_brute_force(monkeypatch, few):
    monkeypatch.setattr(lg, "FEW", few)
    rng = np.random.default_rng(5)
    counts = [5, 1, 0, 6, 3]
    text = np.repeat(np.arange(5), counts)
    scores = -rng.exponential(6, (len(text), 3))
    labels = lg.viterbi(scores, text, 5)
    for t in range(5):
        mine = scores[text == t]

        def value(path, mine=mine):
            return sum(mine[i, k] for i, k in enumerate(path)) - lg.SWITCH * sum(a != b for a, b in itertools.pairwise(path))

        if len(mine):
            best = max(map(value, itertools.product(range(3), repeat=len(mine))))
            assert np.isclose(value(labels[text == t].tolist()), best)


def test_scripts_narrow_candidates(spark):
    model = trained(spark)
    words = lg.Words(["κήπο garden"])
    names, weights, allowed = ["a", "b"], np.zeros((len(lg.GRAMS), 1 << lg.BUCKET_BITS, 2), dtype=np.float32), np.zeros((lg.N_SCRIPTS, 2), bool)
    allowed[0, 0] = allowed[1, 1] = True
    scores = lg.word_scores(words, weights, allowed)
    assert scores[words.of[0]].tolist() == [-25.0, 0.0] and scores[words.of[1]].tolist() == [0.0, -25.0]
    assert model.names == ["de", "el", "en"] and names


def test_query_on_held_out_rows(spark, tables):
    found = QUERIES["op5_language_spans"](spark, tables)
    docs = table(spark, tables, "documents").select("doc_id", "lang", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("out"))
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == 200 and all(r.held_out == r.out and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_each_odd_row_alone(spark):
    """A batch that is a single short, empty or null text, in learning and in prediction."""
    odd = [None, "", "a", "é", "\u0301", "\u0301\u0308", "a\u0301", "ab", "1", " ", "\U0002FFFF", "的"]
    rows = [(i, t, "en") for i, t in enumerate(odd)]
    for t in odd:
        lg.train(spark.createDataFrame([(1, t, "en")], "doc_id long, text string, lang string").coalesce(1), "text", "lang")
    model = trained(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(len(rows), "doc_id")
    got = {r.doc_id: r.f for r in df.select("doc_id", model.predict("text").alias("f")).collect()}
    for i, t in enumerate(odd):
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")), repr(t)


def plain_words(text):
    """Words of letters and combining marks, with at least one letter."""
    runs = "".join(c if c.isalpha() or "\u0300" <= c < "\u0370" else " " for c in text).split()
    return [r for r in runs if any(map(str.isalpha, r))]


def plain_grams(word):
    padded = " " * lg.PAD + word.lower() + " " * lg.PAD
    for n in lg.GRAMS:
        first, stop = min(max(0, n - 2), len(word)), len(word) + (1 if n > 1 else 0)
        yield from ((n, padded[lg.PAD + end - n + 1 : lg.PAD + end + 1]) for end in range(first, stop))


def plain_bucket(n, gram):
    total = 0
    for i, c in enumerate(reversed(gram), 1):
        total += (ord(c) + i) * ((0x9E3779B97F4A7C15 * (2 * i + 1) ** 5 | 1) & (1 << 64) - 1)
    total &= (1 << 64) - 1
    return (((total ^ (total >> 29)) * 0xBF58476D1CE4E5B9) & (1 << 64) - 1) >> (64 - lg.BUCKET_BITS)


def test_learning_and_prediction_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lg, "HELD", 2)
    rng = random.Random(8)
    vocab = {k: t.split() for t, k in ((ENGLISH, "en"), (GERMAN, "de"), (GREEK, "el"))}
    rows = [(i, " ".join(rng.choice(vocab[k]) for _ in range(9)) + " e\u0301 X.", k) for i in range(30) for k in vocab]
    names, weights, shares = lg.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang")
    counts = np.zeros((len(lg.GRAMS), 1 << lg.BUCKET_BITS, 3))
    for _, text, k in rows:
        for word in plain_words(text):
            for n, gram in plain_grams(word):
                counts[lg.GRAMS.index(n), plain_bucket(n, gram), names.index(k)] += 1
    counts += lg.SMOOTHING
    assert np.allclose(weights, np.log(counts / counts.sum(axis=1, keepdims=True)), atol=1e-5)
    allowed = shares >= lg.SCRIPT_SHARE
    for _ in range(20):
        text = " ".join(rng.choice(vocab[rng.choice(["en", "de", "el"])]) for _ in range(5))
        scores = []
        for word in plain_words(text):
            grams = list(plain_grams(word))
            raw = np.array([weights[lg.GRAMS.index(n), plain_bucket(n, g)] for n, g in grams]).mean(axis=0) * len(word) ** 0.5
            raw = np.where(allowed[lg.Words([word]).script[0]], raw, -np.inf)
            scores.append(np.maximum(raw - raw.max(), -25.0))
        scores = np.array(scores)

        def value(path, scores=scores):
            return sum(scores[i, k] for i, k in enumerate(path)) - lg.SWITCH * sum(a != b for a, b in itertools.pairwise(path))

        best = max(itertools.product(range(3), repeat=len(scores)), key=value)
        letters = [sum(len(w) for w, k in zip(plain_words(text), best, strict=True) if k == j) for j in range(3)]
        found = lg.labelled_texts([text], names, weights, allowed)[0]
        assert found["lang_pred"] == names[int(np.argmax(letters))]
        assert [s["lang"] for s in found["spans"]] == [names[k] for k, _ in itertools.groupby(best)]


def test_many_languages(spark):
    """More languages than a task holds at a time."""
    rng = random.Random(9)
    word = [(chr(97 + i % 26) + "aeiou"[i // 26]) * 3 for i in range(70)]
    rows = [(i, " ".join(rng.choice([word[i], word[i][2:] + "s"]) for _ in range(12)), f"l{i:03}") for i in range(70)]
    model = lg.Languages(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1))
    assert len(model.names) == 70
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    assert df.select("*", model.predict("text").alias("f")).filter("lang_pred = f.lang_pred").count() >= 66


def test_ways_of_decoding_agree(monkeypatch):
    rng = np.random.default_rng(7)
    counts = rng.integers(0, 200, 40)
    text = np.repeat(np.arange(40), counts)
    scores = -rng.exponential(3, (50, 4))
    of = rng.integers(0, 50, len(text))
    found = []
    for few in (0, 3, 40):
        monkeypatch.setattr(lg, "FEW", few)
        found.append(lg.viterbi(scores, text, 40, of).tolist())
    assert found[0] == found[1] == found[2] and len(set(found[0])) == 4
