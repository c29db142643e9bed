"""Cosines against plain Python, prefix filtering, inheritance, odd rows."""

import math
import re
from collections import Counter

from saleslake.llm import licences as lc
from saleslake.llm.common import QUERIES, table


def plain(docs):
    """Best (licence, score) per key, over all segments and templates."""
    n = len(docs)
    df = Counter(t for _, text in docs for t in set(lc._terms_of(text or "")))

    def weight(term):
        known = any(term in lc._terms_of(body) for _, body in lc.TEMPLATES)
        return math.log(1 + (n + 1) / (df[term] * known + 1))

    def vector(text):
        return {t: k * weight(t) for t, k in Counter(lc._terms_of(text)).items()}

    templates = [(name, vector(body)) for name, body in lc.TEMPLATES]
    best = {}
    for key, text in docs:
        for segment in re.split(r"(?<=[.!?])\s+|\n", text or ""):
            v = vector(segment)
            norm = math.sqrt(sum(w * w for w in v.values()))
            for i, (name, t) in enumerate(templates):
                size = math.sqrt(sum(w * w for w in t.values()))
                if norm and size:
                    score = round(sum(w * v.get(k, 0) for k, w in t.items()) / norm / size, 6)
                    if score >= lc.THRESHOLD and (key not in best or (score, -i) > best[key][0]):
                        best[key] = ((score, -i), name)
    return {k: (name, rank[0]) for k, (rank, name) in best.items()}


NOTICES = [
    (1, "Some words here.\nReleased under the MIT License."),
    (2, "Licensed under the Apache License, Version 2.0. And then more prose follows in another sentence."),
    (3, "released*** UNDER&&& the MIT$$$ license"),
    (4, "the license of a man to drive a car in the city is something else entirely and not a notice of any kind"),
    (5, None), (6, ""), (7, "word " * 60_000), (8, "Licensed under CC BY-NC 4.0."),
    (9, "This work is licensed under the GNU General Public License, version 3."),
    *[(100 + i, f"plain text number {i} of the house and the garden under the tree") for i in range(30)],
]


def test_scores_equal_plain_cosines(spark):
    df = spark.createDataFrame([(*r, "x") for r in NOTICES], "doc_id long, text string, template string")
    got = {r.doc_id: (r.licence, r.score) for r in lc.notices(df, "doc_id", "text").collect()}
    want = plain(NOTICES)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-5 for k in want)
    assert {k: v[0] for k, v in got.items()} == {1: "MIT", 2: "Apache-2.0", 3: "MIT", 8: "CC-BY-NC-4.0", 9: "GPL-3.0"}
    assert lc.notices(df.limit(0), "doc_id", "text").count() == 0


def test_heaviest_terms_are_needed_for_the_threshold():
    vector = {"a": 5.0, "b": 3.0, "c": 1.0, "d": 1.0}
    taken = lc.heaviest(vector, 0.6)
    rest = math.sqrt(sum(w * w for t, w in vector.items() if t not in taken))
    assert rest < 0.6 * math.sqrt(sum(w * w for w in vector.values())) and taken == {"a"}


def test_nearest_ancestor(spark):
    mit, gpl = NOTICES[0][1], NOTICES[8][1]
    rows = [
        (1, "LICENSE", mit), (2, "a/x.txt", "nothing"), (3, "a/b/COPYING", gpl), (4, "a/b/c/y.txt", "nothing"), (5, "a/bb/z.txt", "none"),
        (6, "a/b/own.txt", NOTICES[1][1]), (7, None, "nothing"), (8, "top.txt", None), (4, "a/b/c/y.txt", "nothing"), (None, "a/b/n.txt", mit),
        *[(100 + i, f"q/{i}.txt", f"plain text number {i} of the house") for i in range(30)],
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    out = lc.scanned(df, "doc_id", "path").collect()
    assert len(out) == len(rows)
    got = {r.doc_id: (r.licence, r.origin, r.from_path) for r in out}
    assert got[1] == ("MIT", "own", "LICENSE") and got[2] == ("MIT", "inherited", "") and got[8] == ("MIT", "inherited", "")
    assert got[4] == ("GPL-3.0", "inherited", "a/b") and got[5] == ("MIT", "inherited", "")
    assert got[6][:2] == ("Apache-2.0", "own") and got[7] == (None, "none", None) and got[None] == ("GPL-3.0", "inherited", "a/b")
    assert lc.scanned(df.limit(0), "doc_id", "path").count() == 0


def test_query(spark, tables):
    docs = [(r.doc_id, r.text) for r in table(spark, tables, "documents").collect()]
    rows = QUERIES["op7_licence_scan"](spark, tables).collect()
    assert len(rows) == len(docs)
    want = plain(docs)
    assert {r.doc_id: r.licence for r in rows if r.origin == "own"} == {k: v[0] for k, v in want.items()}


def test_each_sentence_of_a_template_is_a_notice(spark):
    """Documents hold single sentences, so templates of several are sought by sentences too, however many documents there are."""
    lines = [
        ("Proprietary", "All rights reserved."),
        ("Proprietary", "No part of this work may be reproduced without permission."),
        ("Apache-2.0", "You may not use this file except in compliance with the License."),
        ("MIT", "Licensed under the MIT License."),
    ]
    rows = [(i, f"some words of row w{i}\n{line}\nand a last line") for i, (_, line) in enumerate(lines)]
    rows += [(100 + i, f"Nothing of that kind in x{i}") for i in range(500)]
    rows += [(901, "Copyright.")]
    found = lc.notices(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert {r.doc_id: r.licence for r in found} == {i: name for i, (name, _) in enumerate(lines)}


def test_notices_that_all_documents_hold(spark):
    for rows in ([(i, f"Text {i}.\nReleased under the MIT License.") for i in range(5)], [(1, "Released under the MIT License.")]):
        found = lc.notices(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
        assert [r.licence for r in found] == ["MIT"] * len(rows)


def test_spdx_lines(spark):
    rows = [
        (1, "// SPDX-License-Identifier: MIT\nint main() {}"), (2, "# spdx-license-identifier: (Apache-2.0 OR MIT)\nLicensed under CC BY-NC 4.0."),
        (3, "SPDX-License-Identifier:"), (4, "no such line"),
    ]
    found = lc.notices(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert {r.doc_id: (r.licence, r.score) for r in found} == {1: ("MIT", 1.0), 2: ("Apache-2.0", 1.0)}


def test_very_long_texts(spark):
    """A text of 20 MB in many lines, one without line ends, and one that is a single sentence."""
    line = "some more words of a quite ordinary line number"
    long = "\n".join(f"{line} {i}" for i in range(380_000)) + "\nReleased under the MIT License."
    flat = " ".join(f"{line} {i}." for i in range(100_000)) + " Released under the MIT License."
    rows = [(1, long), (2, flat), (3, "word " * 1_000_000)]
    assert len(long) > 20e6
    df = spark.createDataFrame([(i,) for i, _ in rows], "doc_id long")
    texts = spark.sparkContext.broadcast(dict(rows))
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    df = df.withColumn("text", F.udf(lambda i: texts.value[i], T.StringType())("doc_id"))
    assert {r.doc_id: r.licence for r in lc.notices(df, "doc_id", "text").collect()} == {1: "MIT", 2: "MIT"}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a/b.txt", None, 0.0), (2, "a/LICENSE", "MIT", 0.9)], "doc_id long, path string, licence string, score double")
    for name in ("dir", "dir_licence", "dir_score", "_dir", "up", "n", "file", "states", "from_path"):
        from pyspark.sql import functions as F

        out = lc.inherited(df.withColumn(name, F.lit(7)), F.col("doc_id") == 2, "doc_id", "path").collect()
        assert {r.doc_id: (r.licence, r.origin) for r in out} == {1: ("MIT", "inherited"), 2: ("MIT", "own")}
        assert name == "from_path" or all(r[name] == 7 for r in out)
