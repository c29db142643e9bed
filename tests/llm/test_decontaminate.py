"""Template windows against a plain search, slots, odd rows."""

import random
import re

from pyspark.sql import functions as F

from saleslake.llm import decontaminate as dc
from saleslake.llm.common import QUERIES, table

ITEM = "A train leaves the old station at 9 and travels 120 km in 3 hours before it stops again near the river bank"


def found(spark, docs, items):
    docs = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, hash string")
    items = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, pos string")
    return {(r.doc_id, r.item_id): r for r in dc.leaks(docs, items).collect()}


def test_reparameterised_questions(spark):
    docs = [
        (1, f"Some words first. {ITEM}. And more words follow here."),
        (2, ITEM.replace("9", "7").replace("120", "450").replace("3", "5").replace("km", "miles").upper().lower()),
        (3, "The train left. It was late. 9 and 3 and 120 km."),
        (4, " ".join(ITEM.split()[:14]) + " something else entirely follows after that and goes on and on"),
        (5, None), (6, ""), (7, "word " * 50_000), (1, f"Some words first. {ITEM}. And more words follow here."),
        (None, ITEM),
    ]
    got = found(spark, docs, [(10, ITEM), (11, "too short"), (12, None), (13, ITEM)])
    assert set(got) == {(d, i) for d in (1, 2, 4, None) for i in (10, 13)}
    assert got[1, 10].exact and got[1, 10].share == 1.0 and got[1, 10].changed_slots == 0
    assert not got[2, 10].exact and got[2, 10].changed_slots == 4
    assert got[4, 10].longest_run == 14


def test_slots_have_to_agree(spark):
    item = "if you take 5 apples and give away 5 apples to someone then 8 apples are 8 apples in the end"
    same = item.replace("5", "6").replace("8", "9")
    torn = "if you take 1 apples and give away 2 apples to someone then 3 apples are 4 apples in the end"
    merged = item.replace("5", "7").replace("8", "7")
    got = found(spark, [(1, same), (2, torn), (3, merged)], [(1, item)])
    assert set(got) == {(1, 1)}


def test_tokens_stay_aligned(spark):
    texts = [
        "He met Anna in Rome, then Bob. The 3 men | paid $5.00 (or 4,5 km) <b>now</b> #", "a1b2 ... 7% -- Ünder Das", "5 kg", "<num> km",
        None, "he  met\tAnna2 and O'Neil \n of 5 Km",
    ]
    df = dc.with_forms(spark.createDataFrame([(t,) for t in texts], "text string"), "text").collect()
    assert all(len(r.template) == len(r.surface) == len(r.folded) for r in df)
    assert df[0].template[:7] == ["he", "met", "<name>", "in", "<name>", "then", "<name>"]
    assert df[0].folded[:7] == df[0].surface[:7] == ["he", "met", "anna", "in", "rome", "then", "bob"]
    assert df[2].template == ["<num>", "<unit>"] and df[2].surface == ["5", "kg"] and df[3].template == ["num", "km"]
    assert df[4].template == [] and df[5].template == ["he", "met", "<num>", "and", "oneil", "of", "<num>", "<unit>"]


NAMED = (
    "On Monday the teacher asked Alice and Bob to share 12 apples with Carol, so that each of them gets the same number. "
    "How many apples does Bob keep if Alice eats 2 before lunch?"
)


def test_copies_in_other_case_spacing_and_names(spark):
    docs = [
        (1, NAMED), (2, NAMED.lower()), (3, NAMED.upper()), (4, NAMED.replace(" ", "  ")), (5, NAMED.replace(" ", "\n")),
        (6, NAMED.replace("Alice", "Dora").replace("Bob", "Emil").replace("Carol", "Fred").replace("12", "30")),
        (7, NAMED.lower().replace("12", "30").replace("2 ", "7 ")), (8, "Alice and Bob share apples with Carol in the morning before lunch."),
    ]
    got = found(spark, docs, [(1, NAMED), (2, NAMED.lower() + " tell us")])
    assert {d for d, i in got if i == 1} == {1, 2, 3, 4, 5, 6, 7} and {d for d, i in got if i == 2} >= {1, 2, 3, 4, 5, 7}
    assert all(got[d, 1].exact and got[d, 1].share == 1.0 for d in (1, 2, 3, 4, 5))
    # names and a number differ, but a run of more than 13 words between them does not
    assert got[6, 1].changed_slots == 4 and got[7, 1].changed_slots == 2


def plain_slots(doc, item):
    """Matches of an item by comparing forms at every pair of places; tokens as (type or None, word)."""
    size = min(dc.WINDOW, len(item[0]))
    usable = [a for a in range(len(item[0]) - size + 1) if sum(not t.startswith("<") for t in item[0][a : a + size]) >= dc.LITERALS]
    aligned = {}
    for a in usable:
        for p in range(len(doc[0]) - size + 1):
            for mine in (0, 1):
                for other in (0, 1):
                    window = item[mine][a : a + size]
                    if doc[other][p : p + size] == window:
                        group = aligned.setdefault(p - a, (set(), set(), set()))
                        words, seen = item[2][a : a + size], doc[2][p : p + size]
                        group[0].add(a)
                        if words == seen:
                            group[1].add(a)
                        group[2].update((t, i, d) for t, i, d in zip(window, words, seen) if t.startswith("<"))
    found, best = set(), 0
    for every, same, slots in aligned.values():
        fits = len({(t, i) for t, i, _ in slots}) == len({(t, d) for t, _, d in slots}) == len(slots)
        at = every if fits else same
        found |= at
        run = 0
        for a in sorted(at):
            run = run + 1 if a - 1 in at else 1
            best = max(best, run + size - 1)
    return bool(usable) and (len(found) >= dc.SHARE * len(usable) or best >= dc.RUN)


def test_slots_against_brute_force(spark):
    rng = random.Random(6)
    words, names = [f"w{c}" for c in "abcdefghij"], ["Ann", "Ben", "Cid"]

    def text(n):
        return " ".join(rng.choice([rng.choice(words), rng.choice(words), rng.choice(words), rng.choice(names), str(rng.randint(1, 4)), f"{rng.randint(1, 4)} km"]) for _ in range(n))

    items = [(i, text(rng.choice([5, 7, 9, 14, 22]))) for i in range(12)]
    docs = []
    for i in range(60):
        body = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(body))
            body[at] = rng.choice([*names, "1", "2", "3", "wa", body[at].lower(), body[at].upper()])
        docs.append((i, f"{text(6)} {' '.join(body)} {text(5)}"))
    forms = {}
    for label, rows in (("doc", docs), ("item", items)):
        df = dc.with_forms(spark.createDataFrame(rows, "id long, text string"), "text").collect()
        forms[label] = {r.id: (r.template, r.folded, r.surface) for r in df}
    wanted = {(d, i) for d, doc in forms["doc"].items() for i, item in forms["item"].items() if len(item[0]) >= dc.SHORTEST and plain_slots(doc, item)}
    assert wanted and set(found(spark, docs, items)) == wanted


def test_repeated_keys_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "nothing of it", "x"), (1, ITEM, "y"), (1, None, "z"), (2, "nothing", "x")], "doc_id long, text string, hash string")
    for name in ("_row", "_key", "_item", "_text", "tokens", "places", "window", "item_id", "pos", "length", "named"):
        kept = dc.without_leaks(docs.withColumnRenamed("hash", name), spark.createDataFrame([(1, ITEM, 1)], "item_id long, text string, at int"))
        assert [tuple(r) for r in kept.collect()] == [(2, "nothing", "x")]


def test_very_long_text(spark):
    """The work per window must not grow with the text."""
    long = "some other words of a quite ordinary text in Paris with 12 of them " * 60_000 + ITEM
    assert set(found(spark, [(1, long), (2, "x")], [(1, ITEM)])) == {(1, 1)}


def test_short_items_and_empty_tables(spark):
    got = found(spark, [(1, "we say that all is well here today")], [(1, "all is well here today"), (2, "is well here")])
    assert set(got) == {(1, 1)}
    assert found(spark, [], [(1, ITEM)]) == {} and found(spark, [(1, ITEM)], []) == {}


def test_several_blocks_give_the_same(spark, monkeypatch, tables):
    docs, items = table(spark, tables, "documents"), table(spark, tables, "benchmark")
    whole = sorted(map(tuple, dc.leaks(docs, items).collect()))
    monkeypatch.setattr(dc, "BLOCK_WINDOWS", 300)
    assert sorted(map(tuple, dc.leaks(docs, items).collect())) == whole


def test_query_finds_planted_passages(spark, tables):
    def words(text):
        return re.findall(r"\w+", text.lower())

    items = {r.item_id: words(r.text) for r in table(spark, tables, "benchmark").collect()}
    want = set()
    for r in table(spark, tables, "documents").collect():
        text = " " + " ".join(words(r.text)) + " "
        want |= {(r.doc_id, i) for i, w in items.items() if f" {' '.join(w)} " in text}
    got = QUERIES["op3_template_leaks"](spark, tables)
    assert want and {(r.doc_id, r.item_id) for r in got.collect()} == want
    kept = dc.without_leaks(table(spark, tables, "documents"), table(spark, tables, "benchmark"))
    assert kept.count() == 200 - len({d for d, _ in want})
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_null_keys_stay_in_the_pipeline_stage(spark):
    docs = spark.createDataFrame([(None, ITEM), (1, ITEM), (2, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert sorted(r.doc_id or 0 for r in dc.without_leaks(docs, items).collect()) == [0, 2]
    assert dc.without_leaks(docs, items).filter(F.col("doc_id").isNull()).count() == 1
