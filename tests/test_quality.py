import random

from saleslake.operators import quality


def quartile(values, q):
    values = sorted(values)
    at = q * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (at - low) * (values[high] - values[low])


def test_quartiles_and_outliers_against_brute_force(spark):
    random.seed(1)
    rows = [(g, float(random.randint(0, 40)) if i % 50 else 500.0, i) for g, n in (("a", 400), ("b", 41), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, v double, id int")
    got = {r.g: (r.q1, r.q3) for r in quality.quartiles(df, "g", "v", ["id"]).collect()}
    want = {g: tuple(quartile([v for h, v, _ in rows if h == g], q) for q in (0.25, 0.75)) for g in ("a", "b", "c")}
    assert got == want
    outside = {(r.g, r.id) for r in quality.outliers(df, "g", "v", ["id"]).collect()}
    assert outside == {
        (g, i) for g, v, i in rows
        if v < want[g][0] - 1.5 * (want[g][1] - want[g][0]) or v > want[g][1] + 1.5 * (want[g][1] - want[g][0])
    }


def test_quantiles_with_ties_nulls_and_failing_brackets(spark, monkeypatch):
    random.seed(2)
    rows = [("hot", 7.0) if i % 3 else ("hot", float(random.randint(0, 15))) for i in range(3000)]
    rows += [(None, float(i)) for i in range(1000)] + [("x", None), ("one", 5.0)] + [("wide", random.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double")
    points = {"least": 0.0, "p10": 0.1, "median": 0.5, "p99": 0.99, "most": 1.0}
    want = {g: tuple(quartile([v for h, v in rows if h == g], q) for q in points.values()) for g in ("hot", None, "one", "wide")}
    for accuracy in (10_000, 20):  # a coarse sketch has wide brackets
        monkeypatch.setattr(quality, "_ACCURACY", accuracy)
        assert {r.g: tuple(r)[1:] for r in quality.quantiles(df, "g", "v", points).collect()} == want
    # brackets that miss their point are found out and widened
    brackets = quality._brackets
    monkeypatch.setattr(quality, "_brackets", lambda values, points, reach: brackets(values, points, reach) if reach > 2 else brackets(
        values, {p: min(1.0, q + 0.3) for p, q in points.items()}, reach))
    assert {r.g: tuple(r)[1:] for r in quality.quantiles(df, "g", "v", points).collect()} == want
    assert quality.quantiles(df.limit(0), "g", "v", points).count() == 0


def test_surplus_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "`x-y` int, t string")
    assert quality.surplus_duplicates(df).first().total_duplicates == 3
    assert quality.surplus_duplicates(df.limit(0)).first().total_duplicates == 0


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(2,), (3,)], "id int")
    row = quality.orphans(child, "k", parent, "id", "c").first()
    assert (row.orphan_rows, row.orphan_keys) == (3, 2)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, `b-c` string")
    assert {tuple(r) for r in quality.null_profile(df).collect()} == {("a", 1), ("b-c", 2)}
