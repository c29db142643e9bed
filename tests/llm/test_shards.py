"""The permutation is a bijection, and places can be computed and inverted."""

import zlib

import pytest

from saleslake.llm import shuffle_shards as sh
from saleslake.llm.common import QUERIES, table


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 97, 1000, 4097])
def test_bijection(n):
    out = sh.permuted(range(n), n)
    assert sorted(out.tolist()) == list(range(n))
    assert sh.permuted(out, n, back=True).tolist() == list(range(n))


def test_seeds_differ():
    assert sh.permuted(range(500), 500, 1).tolist() != sh.permuted(range(500), 500, 2).tolist()
    # neighbours are torn apart
    assert sum(abs(int(a) - int(b)) < 5 for a, b in zip(sh.permuted(range(499), 500), sh.permuted(range(1, 500), 500))) < 40


def test_query(spark, tables):
    docs = {r.doc_id: r.text or "" for r in table(spark, tables, "documents").collect()}
    rows = QUERIES["op10_feistel_shards"](spark, tables).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    by_shard = {}
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        assert (r.shard, r.slot) == sh.place(r.row_number, len(rows))
        assert sh.row_at(r.shard, r.slot, len(rows)) == r.row_number
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], "doc_id long, shard string")
    rows = sh.sharded(df, ["doc_id"], 3).orderBy("row_number").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 2] and [r.row_number for r in rows] == [0, 1, 2, 3]
    assert sorted((r.shard, r.slot) for r in rows) == [(0, 0), (0, 1), (1, 0), (2, 0)]
    assert sh.sharded(df.limit(0), ["doc_id"]).count() == 0
