"""Restoration of disguised words, held-out quality, odd rows."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslake.llm import toxicity as tx
from saleslake.llm.common import QUERIES, table

BAD = ["idiot", "moron", "pathetic", "clown"]
PLAIN = "the garden was full of green leaves and people came to see them in the morning with their dogs".split()


def corpus(n=160):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = [rng.choice(PLAIN) for _ in range(30)]
        if i % 4 == 0:
            words[3], words[9] = rng.choice(BAD), rng.choice(BAD)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def model(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, toxic int")
    return tx.Toxicity(df.select("doc_id", "text"), df.select("text", "toxic"))


def test_disguised_words_are_read_again(spark):
    lm = tx.character_model(spark.createDataFrame(corpus(), "doc_id long, text string, toxic int"), "text").ravel().tolist()
    for disguised, word in (("1d10t", "idiot"), ("m0r0n", "moron"), ("idiooooot", "idiot"), ("i d i o t", "idiot"), ("p@th3tic", "pathetic"), ("c.l.o.w.n", "clown")):
        assert tx.restored(f"the {disguised} was", lm, {}) == f"the {word} was"
    for plain in ("a b", "on 12.5 km", "4716 1234", "of%%% the&&& was$$$", "24be64439e3e49cf46b2d7c90f3602a3d0b907ffaaaa"):
        assert tx.restored(plain, lm, {}) == plain


def test_scores_and_odd_rows(spark):
    m = model(spark)
    rows = [
        (1, "the garden was green with 1d10t and m0r0n people"), (2, "the garden was green with people"), (3, None), (4, ""),
        (5, "such p a t h e t i c clown came"), (6, "green leaves " * 50_000), (2, "the garden was green with people"), (None, "IDIOT moron clown"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in df.select("doc_id", m.score("text").alias("s")).collect():
        got.setdefault(r.doc_id, []).append(r.s)
    assert got[1][0] > 0.5 and got[5][0] > 0.5 and got[None][0] > 0.5
    assert max(got[2] + got[3] + got[4] + got[6]) < 0.5 and len(set(got[2])) == 1
    assert all(0 <= s <= 1 for v in got.values() for s in v)
    assert df.limit(0).select(m.score("text")).count() == 0


def test_one_class_or_none(spark):
    df = spark.createDataFrame([("a b c", 1), ("d e", 1)], "text string, toxic int")
    assert df.select(tx.Toxicity(df, df).score("text").alias("s")).first().s > 0.99
    assert df.select(tx.Toxicity(df, df.limit(0)).score("text").alias("s")).first().s < 0.01


def test_fit_finds_the_slope():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(5000, 2))
    y = (rng.random(5000) < 1 / (1 + np.exp(-(x @ [2.0, 0.0] - 1)))).astype(float)
    w = tx.fitted(x, y)
    assert abs(w[0] + 1) < 0.15 and abs(w[1] - 2) < 0.2 and abs(w[2]) < 0.15


def test_toxic_rows_go(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "src") for i, t, _ in rows], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (999, 1)], "doc_id long, toxic int")
    kept = tx.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, y in rows if not y}


def test_query_on_held_out_rows(spark, tables):
    rows = QUERIES["op9_toxicity"](spark, tables).join(table(spark, tables, "labels").select("doc_id", "toxic"), "doc_id", "left").collect()
    assert len(rows) == 200 and all(r.predicted == int(r.score >= 0.5) for r in rows)
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
    out = table(spark, tables, "documents").select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("out")).collect()
    assert {r.doc_id: r.held_out for r in rows} == {r.doc_id: r.out for r in out}


def test_runs_and_words_of_any_length(spark):
    lm = tx.character_model(spark.createDataFrame(corpus(), "doc_id long, text string, toxic int"), "text").ravel().tolist()
    apart = " ".join("pathetic")
    assert tx.restored(apart, lm, {}) == "pathetic"
    for times in (2, 8, 300):
        assert tx.restored("  ".join([apart] * times), lm, {}).split() == ["pathetic"] * times
        assert tx.restored(" ".join([apart] * times), lm, {}).split() == ["pathetic"] * times
    assert tx.restored("p e o p l e c a m e i d i o t", lm, {}) == "people came idiot"
    assert tx.restored("id1ot" * 30, lm, {}).startswith("idiotidiot")
    assert tx.restored("the idio7 w@s a cl0wn", lm, {}) == "the idiot was a clown"
    assert tx.restored("m0r0n " * 5, lm, {}) == "moron " * 5


def test_viterbi_equals_all_readings(spark):
    lm = tx.character_model(spark.createDataFrame(corpus(), "doc_id long, text string, toxic int"), "text").ravel().tolist()
    rng = random.Random(5)
    for _ in range(150):
        token = "".join(rng.choice("idotmrncwl10@3. -$") for _ in range(rng.randint(3, 7)))
        if any(a == b for a, b in itertools.pairwise(token)):
            continue
        readings = list(all_readings(token, lm))
        mine = tx.restored_word(token, lm)
        assert np.isclose(min(c for c, _ in readings), min(c for c, w in readings if w == mine)), token


def all_readings(token, lm):
    options = []
    for char in token:
        letters = [char] if char.isalpha() else [*tx.LOOKALIKES.get(char, ""), *([" "] if char in tx.SEPARATORS else []), ""]
        options.append(letters)
    for path in itertools.product(*options):
        spent, x, y, word, fits = 0.0, 0, 0, "", True
        for char, letter in zip(token, path, strict=True):
            if not char.isalpha():
                sep = char in tx.SEPARATORS and letter in ("", " ")
                spent += tx.SEPARATOR_COST if sep else tx.KEEP_SIGN_COST if not letter else tx.SIGN_COST
            if letter == " " and not y:
                fits = False
                break
            if letter:
                z = 0 if letter == " " else tx._class(letter)
                spent -= lm[(x * tx.CLASSES + y) * tx.CLASSES + z]
                x, y, word = y, z, word + letter
        if fits:
            yield spent - (lm[(x * tx.CLASSES + y) * tx.CLASSES] if y else 0.0), word.strip()


def test_copies_of_one_text_are_one_row_of_the_sample(spark, monkeypatch):
    monkeypatch.setattr(tx, "FIT_ROWS", 40)
    rows = [(t, y) for _, t, y in corpus(60)] + [(corpus(1)[0][1], 1)] * 500 + [("green leaves and people", 0)] * 700
    df = spark.createDataFrame(rows, "text string, toxic int")
    m = tx.Toxicity(df.select("text"), df)
    got = {r.text: r.s for r in df.select("text", m.score("text").alias("s")).distinct().collect()}
    assert got[corpus(1)[0][1]] > got["green leaves and people"]


def test_weights_count_like_rows():
    rng = np.random.default_rng(2)
    x, often = rng.normal(size=(60, 2)), rng.integers(1, 5, 60)
    y = (rng.random(60) < 0.5).astype(float)
    assert np.allclose(tx.fitted(x, y, often), tx.fitted(np.repeat(x, often, axis=0), np.repeat(y, often)))


def test_clashing_columns(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t, _ in rows], "doc_id long, text string, _toxic int, toxic string")
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], "doc_id long, toxic int, text string")
    kept = tx.without_toxic(docs, labels)
    assert kept.columns == docs.columns and {r._toxic for r in kept.collect()} == {1}
    assert kept.count() == sum(not y for _, _, y in rows)


def plain_model(docs):
    """Log probabilities of trigrams by counting one place after another."""
    counts = np.zeros((tx.CLASSES,) * 3)
    for text in docs:
        c = [tx._class(x) if x.isalpha() else 0 for x in f"  {text.lower()}  "]
        for a, b, d in zip(c, c[1:], c[2:]):
            if d or b:
                counts[a, b, d] += 1
    pairs = counts.sum(axis=0) + 0.5
    lower = pairs / pairs.sum(axis=1, keepdims=True)
    return np.log((counts + 20 * lower) / (counts.sum(axis=2, keepdims=True) + 20)).astype(np.float32)


def plain_features(text, lm):
    words = re.findall("[a-z]+", tx.restored(text, lm, {}))
    return words, Counter(f for w in words for f in [("word", w), *[("begin", w[:k]) for k in tx.PREFIXES if len(w) >= k]])


def plain_scores(docs, labelled):
    lm = plain_model(docs).ravel().tolist()
    rows = [(plain_features(t, lm), y) for t, y in labelled]
    toxic = sum(y for _, y in rows)
    clean = len(rows) - toxic
    everywhere, there = Counter(f for (_, c), _ in rows for f in c), Counter(f for (_, c), y in rows if y for f in c)
    chosen = []
    for f, n in everywhere.items():
        p = n / len(rows)
        z = (there[f] / toxic - (n - there[f]) / clean) / math.sqrt(p * (1 - p + 1e-9) * (1 / toxic + 1 / clean))
        if z >= tx.LEAST_Z and there[f] >= 3:
            chosen.append(f)
    assert 5 < len(chosen) < tx.FEATURES

    def design(text_features):
        words, counts = text_features
        return [math.log1p(counts[f]) for f in chosen] + [math.log1p(len(words))]

    w = tx.fitted(np.array([design(f) for f, _ in rows]), np.array([y for _, y in rows]))
    return [1 / (1 + math.exp(-(w[0] + np.array(design(plain_features(t, lm))) @ w[1:]))) for t in docs]


def test_scores_against_a_plain_version(spark):
    rng = random.Random(6)
    rows = corpus(200)
    signs = {"i": "1", "o": "0", "a": "@", "e": "3"}
    for k, (i, text, y) in enumerate(rows):
        if y and k % 8 == 0:
            words = [rng.choice([w.translate(str.maketrans(signs)), w[0] * 4 + w[1:], " ".join(w)]) if w in BAD else w for w in text.split()]
            rows[k] = (i, " ".join(words), y)
    rows += [(900, rows[0][1], 1), (901, "one more, with words; and 12 numbers a1 b2 c3!", 0), (902, "great!! really *good* $5 (ok)", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    m = tx.Toxicity(df.select("doc_id", "text"), df.select("text", "toxic"))
    got = {r.doc_id: r.s for r in df.select("doc_id", m.score("text").alias("s")).collect()}
    wanted = plain_scores([t for _, t, _ in rows], [(t, y) for _, t, y in rows])
    assert [got[i] for i, _, _ in rows] == pytest.approx(wanted, abs=2e-4)


def test_memory_of_a_slice_is_bounded():
    """Of a batch of 8 MB no more than a part is unpacked at a time."""
    import tracemalloc

    import pyarrow as pa

    from saleslake.llm import common

    texts = pa.array(["some words of a text " * 100] * 4000)
    model = [0.0] * tx.CLASSES**3
    tracemalloc.start()
    for piece in common.slices(texts, tx.SLICE):
        for _ in tx._prepared(piece, model, {}).features():
            pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000


def test_fit_holds_its_rows_once():
    """The driver makes a slice of the rows wide at a time: beside the rows themselves it takes no more memory the more rows there are."""
    import tracemalloc

    rng = np.random.default_rng(5)
    x = rng.random((12_000, 60), dtype=np.float32)
    y, often = (x[:, 0] + rng.random(len(x)) > 1.0).astype(int), rng.integers(1, 4, len(x))
    tracemalloc.start()
    w = tx.fitted(x, y, often)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < x.nbytes
    blocks = [x[:5000], x[5000:5001], x[5001:]]
    assert np.allclose(w, tx.fitted(blocks, y, often))
    gradient = np.column_stack([np.ones(len(x)), x]).T @ (often * (1 / (1 + np.exp(-(w[0] + x @ w[1:]))) - y))
    assert np.allclose(gradient + np.r_[1e-6, np.full(60, tx.RIDGE)] * w, 0, atol=1e-3)
