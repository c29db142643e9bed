"""What is moved and broadcast, read from the plans: it must not change its kind when tables grow."""

from saleslake.operators import keys, models, quality
from saleslake.sources.order_lines import order_lines
from saleslake.sources.shared import written

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_dimension_is_not_broadcast(spark, monkeypatch):
    dim = written(spark.range(2000).selectExpr("id as k", "id as key"), "dim")
    lines = spark.range(100).selectExpr("id as k")
    assert "BroadcastHashJoin" in plan(lines.join(keys.beside(dim), "k"))
    monkeypatch.setattr(keys, "BROADCAST_ROWS", 1000)
    assert "BroadcastHashJoin" not in plan(lines.join(keys.beside(dim), "k"))


def test_orphans_without_broadcast(spark):
    child = spark.createDataFrame([(1,), (1,), (7,), (7,), (8,), (None,)], "c long")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "p long")
    found = quality.orphans(child, "c", parent, "p", "c -> p")
    assert "Broadcast" not in plan(found)
    assert [tuple(r) for r in found.collect()] == [("c -> p", 3, 2)]
    none = quality.orphans(child.limit(0), "c", parent, "p", "c -> p")
    assert [tuple(r) for r in none.collect()] == [("c -> p", 0, 0)]


def test_lines_move_once_for_products_and_once_for_orders(spark):
    """Customers meet the orders, so there are two joins above the lines; no table that grows is broadcast."""
    tree = plan(order_lines(spark, FOLDER))
    merges = [line for line in tree.splitlines() if "SortMergeJoin" in line]
    assert len(merges) == 3 and sum("l_orderkey" in m or "l_partkey" in m for m in merges) == 2
    assert tree.count("BroadcastExchange") == 2  # nations and regions


def test_no_second_pass_without_repeated_hashes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "i int, t string")
    found = quality.surplus_duplicates(rows)
    assert "Join" not in plan(found) and found.collect()[0][0] == 0 and found.dtypes == [("total_duplicates", "bigint")]
    assert quality.surplus_duplicates(rows.union(rows).union(rows.limit(1))).collect()[0][0] == 4


def test_training_tasks_grow_with_the_lines(spark, monkeypatch):
    rows = [(i, float(i % 7), 1.0, 2.0, 0.1, 3.0, *[f"v{i % 3}"] * 6) for i in range(3000)]
    names = "id long, sales double, profit double, quantity double, discount double, shipment_days double"
    frame = spark.createDataFrame(rows, names + "".join(f", {c} string" for c in ("segment", "category", "sub_category", "region", "country", "state")))
    monkeypatch.setattr(models, "TASK_LINES", 100)
    train, test = models.vectors(frame, ["id"])
    assert train.rdd.getNumPartitions() == 30
    assert train.count() + test.count() == 3000
    train.unpersist()
    test.unpersist()
