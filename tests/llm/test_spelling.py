"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

from saleslake.llm import spelling
from saleslake.llm.common import QUERIES, table

_UPPER = {c: c + 32 for c in range(65, 91)}


def counted(docs):
    words = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            at = h % len(run)
            words[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words):
    beside = {w: [] for w in words}
    names = sorted(words)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if near(a, b):
                beside[a].append(b)
                beside[b].append(a)
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), words[w], len(beside[w]), words[form[w]] if form[w] else None) for w in words}


def rows(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def vocabulary():
    random.seed(1)
    bases = ["".join(random.choice("abcdeé") for _ in range(random.randint(7, 14))) for _ in range(40)] + ["aaaaaaaa", "aaaaaaaaa", "ababababab", "ÿÿÿÿÿÿÿÿ"]
    words = {}
    for base in bases:
        words[base] = random.choice([5, 500, 90_000])
        for _ in range(12):
            w = list(random.choice([base, random.choice(list(words))]))
            at = random.randrange(len(w))
            random.choice([lambda: w.pop(at), lambda: w.insert(at, random.choice("abé")), lambda: w.__setitem__(at, random.choice("abcdeéÀ"))])()
            if len(w) >= 7:
                words.setdefault("".join(w), random.choice([2, 2, 3, 40, 600]))
    return words


def test_all_pairs(spark):
    words = vocabulary()
    wanted = plain(words)
    assert sum(w[0] is not None for w in wanted.values()) > 100 and any(w[0] != w[1] and w[0] for w in wanted.values())
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(spelling.variants(frame)) == wanted


def test_large_blocks_are_cut(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 6)
    random.seed(2)
    words = {"wordend" + a + b + "s": random.randint(2, 3000) for a in "abcdefghijklm" for b in "abcdéfghij"} | vocabulary()
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(spelling.variants(frame)) == plain(words)


def test_long_words(spark):
    long = "abcdefghij" * 5000
    words = {long: 100, long[:777] + long[778:]: 2, "x" + long: 7, long + "yy": 3, "abcdefg": 50, "abcdefh": 3}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    wanted = {w: v for w, v in rows(spelling.variants(frame)).items()}
    assert wanted[long][3] == 2 and wanted[long[:777] + long[778:]][0] == long and wanted["x" + long][0] == long
    assert wanted[long + "yy"][3] == 0 and wanted["abcdefh"][0] == "abcdefg"


def test_documents(spark):
    random.seed(3)
    texts = [" ".join(random.choice(["Pathetic", "pathétic", "patheti", "ÉDUCATION", "éducatión", "short", "x×y÷zÿÿÿ"]) for _ in range(300)) for _ in range(40)]
    docs = [*enumerate(texts), (3, texts[3]), (None, texts[0]), (None, None), (77, None), (78, ""), (79, "a"), (80, "Longword " * 50_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as run", "4 as key")
    assert rows(spelling.variants(spelling.counted_words(frame))) == plain(counted(docs))
    assert spelling.variants(spelling.counted_words(frame.limit(0))).count() == 0


def test_query(spark, tables):
    docs = [(r.doc_id, r.text) for r in table(spark, tables, "documents").collect()]
    words = counted(docs)
    found = rows(QUERIES["op13_spelling_variants"](spark, tables))
    assert {w: v[2] for w, v in found.items()} == words
    some = dict(random.Random(4).sample(sorted(words.items()), min(len(words), 300)))
    for w in some:
        beside = [o for o in words if near(w, o)]
        best = min(beside, key=lambda o: (-words[o], o), default=None)
        assert found[w][3] == len(beside)
        assert found[w][0] == (best if best and words[best] >= 10 * words[w] else None)
