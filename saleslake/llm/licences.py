"""Licence scans: sparse TF-IDF cosine of notices to templates, then inheritance from the nearest ancestor directory.

Texts are cut into segments (lines, and sentences within them), and templates of several sentences are sought by each of them
as well. Terms are weighted by their inverse document frequency over all documents, ln(1 + (n + 1) / (df + 1)), which never
falls to 0: a notice that every document holds is found in every document. The frequencies are needed for the templates' terms
only, other terms weigh like a term of no document. A segment's vector keeps all its terms, so a few licence words in a long
sentence do not make a notice. A line `SPDX-License-Identifier: <id>` is a notice of that licence with score 1.

Rows that are made from a text hold one segment each, and never the text.

Which segments are scored follows from the weights by prefix filtering. A segment which shares none of a template's
heaviest terms has a cosine of at most the norm of the other terms; the heaviest terms are taken until that is below
the threshold. So nothing that reaches it is missed, and only segments with such a term are joined with the templates.

Inheritance: each licence file states the licence of its directory. A document without a notice of its own gets that of
the nearest directory above it which has one. Ancestors are joined per directory, not per document.

Defined results: a null or empty text has no notice; a null path has no directory and inherits nothing; equal scores go to the
template that stands first; of several licence files in one directory the highest score counts, then the name. Repeated
keys keep a row each, with the best notice of all rows of the key.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import query, table
from saleslake.sources.shared import written

THRESHOLD = 0.6
LICENCE_SHARE = 0.25  # of a document's words in notices, from which the query takes it as a licence file

# Short notices of common licences, by identifier.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright to this work, dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved. No part of this work may be reproduced without permission."),
]
# Sentences of the templates that state no licence by themselves.
GENERAL = {"Copyright.", "See the LICENSE file for details.", "2.0."}

_SEGMENT = r"(?<=[.!?])\s+|\n"
_TERM = r"[^a-z0-9]+"
_SPDX = r"(?i)SPDX-License-Identifier:\s*\(?([A-Za-z0-9][A-Za-z0-9.+-]*)"


def with_sentences(templates) -> list[tuple[str, str]]:
    """The templates, and the sentences of those that have several, cut as documents are."""
    cut = [(name, part) for name, body in templates for part in re.split(_SEGMENT, body) if part not in GENERAL and part != body]
    return [*templates, *cut]


TEMPLATES = with_sentences(NOTICES)


def _terms_of(text: str) -> list[str]:
    return [t for t in re.split(_TERM, text.lower()) if t]


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _TERM), lambda t: t != "")


def _literals(values) -> Column:
    return F.array(*map(F.lit, sorted(values)))


def inverse_frequencies(docs: DataFrame, text: str, vocabulary: set[str]) -> tuple[dict[str, float], float]:
    """ln(1 + (n + 1) / (df + 1)) of the terms over all rows, and the weight of a term of no document.

    One number per template term reaches the driver.
    """
    parts = F.split(F.coalesce(F.col(text), F.lit("")), _SEGMENT)
    # of each segment only what the vocabulary holds
    held = F.array_distinct(F.flatten(F.transform(parts, lambda s: F.array_intersect(_literals(vocabulary), _terms(s)))))
    found = docs.select(F.explode(held).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    n = docs.count()
    df = {r["term"]: r["n"] for r in found.collect()}
    return {t: math.log(1 + (n + 1) / (df.get(t, 0) + 1)) for t in vocabulary}, math.log(n + 2)


def heaviest(vector: dict[str, float], threshold: float) -> set[str]:
    """The terms of which a text has to share one to reach the threshold with this template."""
    rest, norm, taken = sum(w * w for w in vector.values()), sum(w * w for w in vector.values()), set()
    for term in sorted(vector, key=lambda t: (-vector[t], t)):
        if rest < threshold * threshold * norm:
            break
        taken.add(term)
        rest -= vector[term] ** 2
    return taken


def notices(docs: DataFrame, key: str, text: str, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per key with a notice: licence, score, and `share` of its words that stand in notices."""
    counted = [(i, name, Counter(_terms_of(body))) for i, (name, body) in enumerate(templates)]
    vocabulary = {t for _, _, terms in counted for t in terms}
    weights, rare = inverse_frequencies(docs, text, vocabulary)
    rows, prefix = [], set()
    for i, _, terms in counted:
        vector = {t: k * weights[t] for t, k in terms.items()}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        if norm:
            # dot products need the text's weight once more
            rows += [(i, t, w * weights[t] / norm) for t, w in vector.items() if w]
            prefix |= heaviest(vector, threshold)
    # as many rows as the templates have terms
    small = docs.sparkSession.createDataFrame(rows, "template int, term string, weight double")
    square = F.create_map(*[F.lit(x) for t in sorted(vocabulary) for x in (t, weights[t] ** 2)])
    # below the explode, where the whole text still is
    counted_words = docs.select(F.col(key).alias("_key"), F.regexp_count(F.lower(F.col(text)), F.lit("[a-z0-9]+")).alias("words"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    segments = counted_words.select("_key", "words", F.posexplode(F.split("_text", _SEGMENT)).alias("at", "segment")).withColumn("terms", _terms(F.col("segment")))
    likely = segments.filter(F.arrays_overlap("terms", _literals(prefix))) if prefix else segments.limit(0)
    # distinct terms with their counts
    spread = likely.select("_key", "at", "words", F.size("terms").alias("length"), F.explode("terms").alias("term"))
    counts = spread.groupBy("_key", "at", "words", "length", "term").agg(F.count(F.lit(1)).alias("k"))
    weighed = counts.withColumn("norm", F.col("k") * F.col("k") * F.coalesce(F.try_element_at(square, F.col("term")), F.lit(rare * rare)))
    norms = weighed.groupBy("_key", "at", "words", "length").agg(
        F.sum("norm").alias("norm"), F.collect_list(F.struct("term", "k")).alias("terms")  # no longer than the segment
    )
    scored = (
        norms.filter("norm > 0")
        .select("_key", "at", "words", "length", "norm", F.inline("terms"))
        .join(F.broadcast(small), "term")
        .groupBy("_key", "at", "words", "length", "norm", "template")
        .agg((F.sum(F.col("k") * F.col("weight"))).alias("dot"))
        .withColumn("score", F.round(F.col("dot") / F.sqrt("norm"), 6))
        .filter(F.col("score") >= threshold)
    )
    named = F.element_at(F.array(*[F.lit(name) for name, _ in templates]), F.col("template") + 1)
    by_text = scored.select("_key", "at", "words", "length", "score", (-F.col("template")).alias("place"), named.alias("licence"))
    stated = segments.withColumn("licence", F.regexp_extract("segment", _SPDX, 1)).filter("licence != ''")
    by_line = stated.select("_key", "at", "words", F.size("terms").alias("length"), F.lit(1.0).alias("score"), F.lit(1).alias("place"), "licence")
    rank = F.max(F.struct("score", "place", "licence")).alias("best")
    best = by_text.unionByName(by_line).groupBy("_key", "at", "words", "length").agg(rank)
    return best.groupBy("_key").agg(F.max("best").alias("best"), (F.sum("length") / F.max("words")).alias("share")).select(
        F.col("_key").alias(key), "best.licence", "best.score", F.least("share", F.lit(1.0)).alias("share")
    )


def inherited(files: DataFrame, licence_file: Column, key: str, path: str) -> DataFrame:
    """`files` (key, path, licence, score, ...) with `origin` (own, inherited, none) and `from_path`.

    `licence_file` says which rows state the licence of their directory. Directories are the parts of a path before its
    slashes; the root is the empty one.
    """
    directory = F.regexp_extract(F.col(path), r"\A(.*)/[^/]*\z", 1)
    # the rows' own columns stay in one, apart from those that are made here
    rows = files.select(F.struct(*files.columns).alias("file"), directory.alias("dir"), licence_file.alias("states"))
    licence, score, own = F.col("file.licence"), F.col("file.score"), F.col("file.licence").isNotNull()
    stated = rows.filter(F.col("states") & own & F.col("dir").isNotNull())
    # the highest score, then the first name
    rank = F.struct((-score).alias("s"), F.col(f"file.{path}").alias("p"), licence.alias("l"))
    of_dir = written(stated.groupBy("dir").agg(F.min(rank).alias("r")).select(F.col("dir").alias("up"), F.col("r.l").alias("dir_licence"), F.col("r.s").alias("dir_score")), "licences-stated")
    wanting = rows.filter(~own & F.col("dir").isNotNull()).select("dir").distinct()
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    met = wanting.select("dir", F.posexplode(ancestors).alias("depth", "up")).join(of_dir, "up")
    nearest = written(
        met.groupBy("dir").agg(F.max_by(F.struct("up", "dir_licence", "dir_score"), "depth").alias("n")).select("dir", "n.*"),
        "licences-nearest",
    )
    return rows.join(nearest, "dir", "left").select(
        *[F.col("file")[c].alias(c) for c in files.columns if c not in ("licence", "score", "origin", "from_path")],
        F.coalesce(licence, "dir_licence").alias("licence"),
        F.coalesce(score, -F.col("dir_score")).alias("score"),
        F.when(own, "own").when(F.col("dir_licence").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(own, F.col(f"file.{path}")).otherwise(F.col("up")).alias("from_path"),
    )


def scanned(
    docs: DataFrame, key: str, path: str, text: str = "text", licence_file: Column | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """Key, path, licence, score, share, origin and from_path of every row.

    Without `licence_file`, files called like LICENSE, LICENCE or COPYING state their directory's licence.
    """
    if licence_file is None:
        licence_file = F.col(path).rlike(r"(?i)(\A|/)(licen[cs]e|copying)(\.[a-z]+)?\z")
    docs = docs.select(key, path, text)
    found = written(notices(docs, key, text, threshold=threshold), "licences-notices")
    # null keys match nothing, and so have no notice of their own
    files = docs.select(key, path).join(found, key, "left")
    return inherited(files, licence_file, key, path)


@query("op7_licence_scan")
def op7_licence_scan(spark, folder):
    """The licence of every document, its own or that of the nearest directory with one.

    Documents have no paths, so they are placed by source and id (hundreds within thousands); those that are mostly
    a notice serve as licence files.
    """
    docs = table(spark, folder, "documents")
    place = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 100), "doc_id")
    placed = docs.select("doc_id", place.alias("path"), "text")
    return scanned(placed, "doc_id", "path", licence_file=F.col("share") >= LICENCE_SHARE)
