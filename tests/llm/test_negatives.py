"""Hard negatives against all inner products."""

import random

import duckdb
import numpy as np
import pytest

from saleslake.llm import negatives
from saleslake.llm.common import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """The contract, pair by pair."""
    usable = {}
    for key, vector, label in rows:
        if key is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if key % 7 == 0 else label
        row = (label, [int(np.floor(256 * float(np.float32(x)))) for x in vector])
        usable[key] = min(usable.get(key, row), row)
    out = []
    for a, (label, v) in usable.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), key, other) for key, (other, w) in usable.items() if key != a)
        for minus, p, _ in [s for s in scored if s[2] == label][:5]:
            fits = [(-s, key) for s, key, other in scored if other != label and 80 * -minus <= 100 * -s <= 100 * -minus][:5]
            out += [(a, p, rank, key, -minus, s) for rank, (s, key) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, tmp_path, extra=""):
    frame = spark.createDataFrame(rows, SCHEMA)
    if extra:
        frame = frame.withColumns({c: frame.vec_id for c in extra.split()})
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = QUERIES["op11_hard_negatives"](spark, str(tmp_path))
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_oracle(spark, tables):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{tables}/embeddings.parquet'")
    asked = "select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from"
    wanted = db.execute(f"{asked} ({ORACLES['op11_hard_negatives']})").fetchall()
    got = [tuple(r) for r in QUERIES["op11_hard_negatives"](spark, tables).collect()]
    assert wanted and sorted(got) == sorted(wanted)


def test_ties_groups_of_copies_and_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 60)
    monkeypatch.setattr(negatives, "QUERIES", 4)
    random.seed(1)
    few = [[random.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)] for _ in range(12)]
    rows = [(i, random.choice(few) if i % 3 else [1.0, 1.0, 0.25], random.randrange(4)) for i in range(900)]
    rows += [(900, [1.0, float("nan"), 0.0], 1), (901, [1.0, None, 0.0], 1), (902, None, 1), (903, [9.0] * 3, None), (904, [float("inf")] * 3, 2)]
    rows += [(1000, [0.5, 0.5, 0.5], 1), (1000, [0.5, 0.5, 0.5], 1), (1000, [1.0, 0.5, 0.5], 0), (1100, [-1.0, -1.0, -1.0], 2), (1200, [0.0] * 3, 3)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (None, [2.0, 1.0, 1.0], None)]
    wanted = plain(rows)
    assert len(wanted) > 100
    assert mined(spark, rows, tmp_path, "id label_2 v work") == wanted


def test_scattered_vectors_over_many_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 500)
    monkeypatch.setattr(negatives, "TOGETHER", 7)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (10, 16))
    rows = [(i, (centres[i % 10] + rng.normal(0, 0.6, 16)).tolist(), int(rng.integers(10))) for i in range(3000)]
    assert mined(spark, rows, tmp_path) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(100, [1.0], 1)], [(100, [], 1), (1, [], 1), (2, [], 2)]])
def test_small_tables(spark, tmp_path, rows):
    assert mined(spark, rows, tmp_path) == plain(rows)


def test_tree_and_bounds():
    rng = np.random.default_rng(3)
    points = np.vstack([rng.integers(-200, 200, (700, 8)), np.tile(rng.integers(-200, 200, 8), (300, 1))])
    tree = negatives.CoverTree(points)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(1000))
    assert tree.sizes == sorted(tree.sizes) and len(tree.sizes) > 3
    queries = rng.integers(-200, 200, (40, 8))
    low, high = np.full(40, 10_000.0), np.full(40, 30_000.0)
    bounds, scores = tree.bounds(queries, low, high), queries @ points.T
    for leaf, rows in enumerate(tree.leaves):
        inside = np.where((scores[:, rows] >= 10_000) & (scores[:, rows] <= 30_000), scores[:, rows], -np.inf).max(axis=1)
        assert (inside <= bounds[:, leaf]).all()
    assert np.isinf(bounds).any()  # some leaves are skipped


def test_scores_beyond_floating_point():
    points = np.array([[(1 << 30) + 1, 3], [5, 7]], dtype=np.int64)
    assert negatives.CoverTree(points).scores(points[:1], [0]).tolist() == [[((1 << 30) + 1) ** 2 + 9]]
