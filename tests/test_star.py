"""The star over source tables with orphans, lost keys and repeated rows: numbered in orders, or over the cluster."""

from datetime import datetime
from functools import partial

import pytest

from saleslake.operators import star
from saleslake.sources.order_lines import _SCHEMAS, order_lines, with_dim_keys


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("source"))
    day = datetime(2020, 1, 5)
    rows = {
        "region": [(1, "EU"), (2, "US")],
        "nation": [(1, "FR", 1), (2, "NY", 2)],
        # 3 has no name, 4 no nation, and 2 comes twice with two names
        "customer": [(1, "a", 1, 0.0, "x"), (2, "b", 2, 0.0, "y"), (2, "c", 2, 0.0, "y"), (3, None, 1, 0.0, None), (4, "d", None, 0.0, "x")],
        "supplier": [(1, "s", 1, 0.0)],
        "part": [(1, "p", "b1", "t1", 1, 10.0), (2, None, None, None, 1, 20.0), (5, "q", "b2", "t1", 1, 5.0)],
        # order 6 is of a customer that is nowhere, 7 of none
        "orders": [(o, c, "O", 1.0, day, p) for o, c, p in [(1, 1, "1-URGENT"), (2, 2, "2-HIGH"), (3, 3, None), (4, 4, "x"), (6, 99, "2-HIGH"), (7, None, None)]],
        # orders 5 and None are nowhere; part 9 too
        "lineitem": [
            (o, p, 1, n, 2.0, 10.0 * n + (o or 0), 0.1, 0.02, "AR"[n % 2], "O", None if n == 3 else datetime(2020, 2, n))
            for o in (1, 2, 3, 4, 5, 6, 7, None) for n, p in enumerate([1, 2, 9, None, 1], 1)
        ],
    }
    for name, some in rows.items():
        spark.createDataFrame(some, _SCHEMAS[name]).write.parquet(f"{at}/{name}.parquet")
    return at


def built(spark, folder, keyed=True):
    def with_keys(dims):
        return partial(order_lines, spark, folder, tables=with_dim_keys(spark, folder, dims))

    fact, dims = star.build_star(partial(order_lines, spark, folder), keyed=with_keys if keyed else None)
    rows, dims = fact.collect(), {n: sorted(map(tuple, d.collect()), key=repr) for n, d in dims.items()}
    # the lines of order 2 come twice, with two customers: which of the two is first is open
    twice = [k for k, o, *_ in dims["dim_order"] if o == 2]
    return sorted((tuple(r) if r.order_key not in twice else (0, *r[1:]) for r in rows), key=repr), dims, sorted(r.fact_key for r in rows)


def test_numbers_in_orders_are_those_over_the_cluster(spark, folder, monkeypatch):
    named, numbered = [], star.numbered
    monkeypatch.setattr(star, "numbered", lambda df, order, name, *more: (named.append(name), numbered(df, order, name, *more))[1])
    fact, dims, places = first = built(spark, folder)
    assert "fact_key" not in named and "order_key" in named  # the lines are neither moved nor written to be numbered
    assert places == list(range(1, 46)) and len(fact) == 45 == order_lines(spark, folder).count()
    assert all(None not in r[:5] for r in fact)
    assert first == built(spark, folder, keyed=False)
    monkeypatch.setattr(star, "HOT_ORDER", 3)
    assert first == built(spark, folder) and "fact_key" in named
    # every line has the ids that its keys stand for
    ids = {name: {r[0]: r[1] for r in rows} for name, rows in dims.items()}
    found = sorted((ids["dim_order"][r[1]], ids["dim_customer"][r[2]], ids["dim_product"][r[3]]) for r in fact if r[1] > 1 and ids["dim_product"][r[3]] and ids["dim_customer"][r[2]])
    lines = order_lines(spark, folder, "order_id", "customer_id", "product_id", "customer_name", "product_name").collect()
    assert found == sorted(r[:3] for r in lines if None not in r[:3])


def test_few_orders_keep_the_numbers_of_all(spark, folder, monkeypatch):
    """Only their lines meet products and customers, and the number is the one among all lines."""
    every = [r for r in built(spark, folder)[0] if 1 < r[1] <= 5]
    source = partial(order_lines, spark, folder)
    for limit in (star.HOT_ORDER, 3):
        monkeypatch.setattr(star, "HOT_ORDER", limit)
        few, dims = star.build_star(source, where="order_key between 1 and 5")
        two = next(r.order_key for r in dims["dim_order"].collect() if r.order_id == 2)
        assert sorted((tuple(r) if r.order_key != two else (0, *r[1:]) for r in few.collect()), key=repr) == every


def test_running_sums_beside_dense_numbers(spark):
    from saleslake.operators.keys import numbered

    df = spark.range(1, 2001).selectExpr("id * 7919 % 2003 as id", "id % 5 as n").repartition(7)
    rows = sorted(numbered(df, ["id"], "place", "n").collect(), key=lambda r: r.id)
    assert [r.place for r in rows] == list(range(1, 2001))
    assert [r.before for r in rows] == [sum(r.n for r in rows[:k]) for k in range(2000)]
    assert numbered(df.limit(0), ["id"], "place", "n").count() == 0
