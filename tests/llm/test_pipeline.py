"""The stages one after another, against the operators' own decisions."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from saleslake.llm import personal, pieces
from saleslake.llm.common import table


def test_stages(spark, tables, tmp_path):
    docs = table(spark, tables, "documents")
    columns, count = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, tables).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        assert docs.count() <= count
        count = docs.count()
    assert all(not personal.spans_of(r.text or "") for r in docs.collect())
    final = corpus_pipeline.STAGES[-1][1](spark, docs, tables)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = final.collect()
    assert len(rows) == count and {r.doc_id: r.decoded for r in rows} == texts
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, tables).collect()) == sorted(texts)


def test_empty_documents(spark, tables, tmp_path):
    docs = table(spark, tables, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, tables).write.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            docs = spark.read.parquet(f"{tmp_path}/{name}")
            assert docs.count() == 0


WORDS = [a + b + c for a in ("ba", "de", "fi", "go", "lu", "me", "na", "po", "ri", "su") for b in ("ka", "len", "mor", "tis", "vel") for c in ("", "ra", "ton", "bly")]
INSULTS = ["idiot", "moron", "pathetic", "clown", "1d10t", "m0r0n", "p a t h e t i c"]
ITEM = "A train leaves the old station at 9 and travels 120 km in 3 hours before it stops again near the river bank"


def planted():
    """Documents by what has to become of them: (id, text, label) lists."""
    rng = random.Random(31)

    def prose(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))

    parts = {"clean": [(i, prose(90), 0) for i in range(160)]}
    toxic = [(1000 + i, prose(40), 1) for i in range(80)]
    parts["toxic"] = [(i, f"{t} {rng.choice(INSULTS[:4])} {prose(5)} {rng.choice(INSULTS)} {rng.choice(INSULTS)}", y if i % 3 else None) for i, t, y in toxic]
    parts["copies"] = []
    for group in range(8):
        base = prose(120).split()
        for k in range(4):
            edit = list(base)
            if k > 1:
                edit[rng.randrange(120)] = rng.choice(WORDS)
            parts["copies"].append((2000 + 10 * group + k, " ".join(edit).upper() if k == 1 else " ".join(edit), 0))
    parts["leaks"] = [(3000 + i, f"{prose(30)}. {ITEM if i % 2 else ITEM.upper()}. {prose(30)}", 0) for i in range(6)]
    parts["personal"] = [(4000 + i, f"{prose(40)} mail ann{i}@example.org or card 4111 1111 1111 1111 {prose(40)}", 0) for i in range(5)]
    long = " ".join(f"{rng.choice(WORDS)}{rng.choice(WORDS)}" for _ in range(60_000))
    parts["odd"] = [(5000, None, 0), (5001, None, None), (5002, "", 0), (5003, " \n", None), (5004, long, None), (None, prose(60), None)]
    again = prose(70)
    parts["repeated"] = [(5005, again, 0), (5005, again, 0)]
    return parts


def test_planted_documents(spark, tmp_path):
    """Against a plain version: what was planted goes, is masked or stays, and ids are those of the library."""
    sentencepiece = pytest.importorskip("sentencepiece")
    parts = planted()
    rows = [(i, t, "xx", "s", len(t or "")) for part in parts.values() for i, t, _ in part]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    labels = {i: y for part in parts.values() for i, _, y in part if i is not None and y is not None}
    spark.createDataFrame([(i, 1, y) for i, y in labels.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    left = [r.doc_id for r in final]
    kept = [i for name in ("clean", "personal", "odd", "repeated") for i, _, _ in parts[name]]
    assert Counter(i for i in left if i is None or not 2000 <= i < 3000) == Counter(kept)
    assert Counter(i // 10 for i in left if i is not None and 2000 <= i < 3000) == {200 + g: 1 for g in range(8)}

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts = {i: t for part in parts.values() for i, t, _ in part}
    for r in final:
        text = (texts[r.doc_id] or "").replace("4111 1111 1111 1111", "[CARD]")
        text = re.sub(r"ann[0-9]@example\.org", "[EMAIL]", text)
        ids = library.encode(text)
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
