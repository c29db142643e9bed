"""Repetition within texts against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from saleslake.llm import repetition
from saleslake.llm.common import QUERIES, table

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """Counts of one text, and the longest repeat from each word, by comparing all pairs of words."""
    text = text or ""
    words = _WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    longest = [0] * len(words)
    after = [0] * (len(words) + 1)
    for i in range(len(words) - 1, -1, -1):
        now = [0] * (len(words) + 1)
        for j in range(len(words)):
            if i != j and words[i] == words[j]:
                now[j] = after[j + 1] + 1
                # the next row's diagonal holds 0 at j = i + 1, where a suffix would meet itself
        longest[i], after = max(now), now
    within = {j for i, n in enumerate(longest) if n >= repetition.REPEAT for j in range(i, i + n)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "covered_words": len(within),
        "longest_repeat": max(longest, default=0),
    }


def check(texts):
    found = repetition.measured(texts)
    for i, text in enumerate(texts):
        for name, value in plain(text).items():
            assert found[name][i] == value, (name, text[:200])
    return found


def test_random_texts_of_few_words():
    random.seed(1)
    texts = []
    for _ in range(300):
        alphabet = random.choice([["a"], ["a", "b"], ["a", "b", "é#"], [*"abcdefgh"], [f"w{i}" for i in range(60)]])
        texts.append("".join(random.choice(alphabet) + random.choice([" ", " ", "\n", "\t\x0b ", " x "]) for _ in range(random.randint(0, 90))))
    check(texts + ["", " ", "\n\n", "a", "a a", "a a a", "😀 😀 😀 😀", "x\n x\nx\nx "])


def test_repeated_passages_and_their_spans():
    random.seed(2)
    fill = lambda n: " ".join(f"u{random.random()}" for _ in range(n))
    passage = fill(30)
    text = f"{fill(40)} {passage}\n{fill(50)}  {passage} {fill(20)}"
    found = check([text, fill(100), text])
    assert found["covered_words"].tolist() == [60, 0, 60] and found["longest_repeat"].tolist() == [30, 0, 30]
    for i in (0, 2):
        assert [text[a:b] for a, b in found["spans"][i]] == [passage, passage]
    assert found["spans"][1] == []


def test_long_texts():
    found = repetition.measured(["x " * 300_000, "a b " * 100_000 + "c", " ".join(map(str, range(200_000)))])
    assert found["longest_repeat"].tolist() == [299_999, 199_998, 0]
    assert found["n_repeat_words"].tolist() == [300_000, 200_000, 0]
    assert found["covered_words"].tolist() == [300_000, 200_000, 0]


def test_odd_rows(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None), (2, ""), (3, good), (3, good), (None, good + " " + good), (4, "a"), (5, good + "\n" + "long " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept", "2 as n_words", "3 as spans")
    found = repetition.with_verdict(df).collect()
    assert [(r.doc_id, r.base_failed, r.kept) for r in found] == [
        (1, True, False), (2, True, False), (3, False, True), (3, False, True), (None, True, False), (4, True, False), (5, True, False)
    ]
    left = repetition.without_repetitive(df)
    assert left.columns == df.columns and left.count() == 2
    assert repetition.with_verdict(df.limit(0)).count() == 0


def test_verdict_beyond_the_base_rules(spark):
    """A passage of 40 % of the words stands twice: below the base limit, above that of the method."""
    words = [f"w{i}" for i in range(160)]
    text = " ".join(words + words[:36])
    row = repetition.with_verdict(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert not row.base_failed and not row.kept and row.covered_words == 72


def test_query(spark, tables):
    texts = {r.doc_id: r.text for r in table(spark, tables, "documents").collect()}
    found = QUERIES["op12_repetition_rules"](spark, tables).collect()
    assert len(found) == len(texts)
    for r in found:
        if len(texts[r.doc_id] or "") < 12_000:
            wanted = plain(texts[r.doc_id])
            assert {c: r[c] for c in wanted} == wanted
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept <= (not r.base_failed)


@pytest.mark.parametrize("size", [0, 1, 2])
def test_suffix_array_of_tiny_input(size):
    order, levels = repetition.suffix_array(np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64))
    assert sorted(order.tolist()) == list(range(size))
    assert repetition.repeat_lengths(order, levels).tolist() == [[], [0], [1, 1]][size]
