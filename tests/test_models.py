"""Models on made-up lines with a known relation, and the customer score."""

import random
from datetime import date

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from saleslake.operators import features, models


@pytest.fixture(scope="module")
def relation(spark):
    random.seed(7)
    rows = []
    for i in range(1200):
        a, b = random.uniform(0, 10), random.uniform(0, 10)
        rows.append((float(20 + 3 * a + b * b), a, b, i))
    df = spark.createDataFrame(rows, "label double, a double, b double, id bigint")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    train, test = features.split(df, ["id"])
    return train.cache(), test.cache()


def r2(predictions):
    return models.score(predictions, "m").first().r2


def test_tree_models_learn_the_relation(relation):
    train, test = relation
    for make in (models.random_forest, models.gradient_boosting, models.tree):
        assert r2(make().fit(train).transform(test)) > 0.85


def test_linear(relation):
    train, test = relation
    assert r2(models.linear().fit(train).transform(test)) > 0.85


def test_boosted_median_beats_its_tree(relation):
    train, test = relation
    boosted = models.BoostedMedian(rounds=12, write_every=4).fit(train)
    assert len(boosted.members) == 12
    assert r2(boosted.transform(test)) > r2(models.tree(maxDepth=3).fit(train).transform(test)) > 0.5


def test_log_target(relation):
    train, test = relation
    assert r2(models.fit_log_target(models.random_forest(), train, test)) > 0.85


def test_scores_against_plain_python(spark):
    rows = [(10.0, 12.0), (20.0, 19.0), (30.0, 33.0)]
    got = models.score(spark.createDataFrame(rows, "label double, prediction double"), "m").first()
    mse = sum((a - p) ** 2 for a, p in rows) / 3
    assert got.rmse == pytest.approx(mse**0.5)
    assert got.r2 == pytest.approx(1 - 3 * mse / 200.0)
    assert got.mape == pytest.approx(100 * (0.2 + 0.05 + 0.1) / 3)


@pytest.mark.parametrize("count", [1, 3, 5, 7, 23])
def test_tile_equals_ntile(spark, count):
    from pyspark.sql import Window

    df = spark.range(1, count + 1).withColumn("want", F.ntile(5).over(Window.orderBy("id")))
    rows = df.withColumn("got", features.tile(F.col("id"), F.lit(count), 5)).collect()
    assert [r.got for r in rows] == [r.want for r in rows]


def test_rfm_scores_recent_frequent_rich_customers_high(spark):
    rows = [(c, c * 100 + n, date(2020, 1, 1 + 2 * c), 10.0 * c) for c in range(1, 11) for n in range(c)]
    scored = features.rfm(spark.createDataFrame(rows, "customer_id int, order_id int, order_date date, sales double"))
    got = {r.customer_id: r for r in scored.collect()}
    assert got[10].rfm_score == 15 and got[1].rfm_score == 3
    assert got[10].recency_days == 0 and got[1].recency_days == 18


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "order_id")
    one = {r[0] for r in features.split(df.coalesce(1), ["order_id"])[0].collect()}
    assert one == {r[0] for r in features.split(df.repartition(9), ["order_id"])[0].collect()}
    assert 700 < len(one) < 900


def test_string_index_keeps_unseen_values(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",)], "t string")
    model = features.string_indexer(["t"]).fit(train)
    test = spark.createDataFrame([("a",), ("b",), ("c",), ("new",)], "t string")
    assert {r.t: r.t_idx for r in model.transform(test).collect()} == {"b": 0.0, "a": 1.0, "c": 2.0, "new": 3.0}


def test_grid_search_fits_each_fold_once(spark, monkeypatch):
    """The errors are those of CrossValidator, from one forest for each fold and parameters: none is fitted for its own sake, over few tasks."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    random.seed(3)
    rows = [(float(i % 7 + random.random() + (i % 3) * 2), float(i % 7), "abc"[i % 3]) for i in range(400)]
    train = spark.createDataFrame(rows, "label double, a double, t string").coalesce(1)
    grid = {"numTrees": [2, 3], "maxDepth": [0, 1]}
    parts, fit = [], RandomForestRegressor._fit_java
    monkeypatch.setattr(RandomForestRegressor, "_fit_java", lambda self, df: (parts.append(df.rdd.getNumPartitions()), fit(self, df))[1])
    got = models.grid_search(train, ["a"], "t", "label", parallelism=spark.sparkContext.defaultParallelism, grid=grid)
    assert len(got) == 4 and parts == [1] * 12

    indexed = features.string_indexer(["t"]).fit(train).transform(train)
    frame = VectorAssembler(inputCols=["a", "t_idx"], outputCol="features").transform(indexed).select("features", "label")
    forest = models.random_forest(labelCol="label")
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(forest.getParam(name), values)
    maps, by_error = builder.build(), RegressionEvaluator(metricName="rmse")
    wanted = CrossValidator(estimator=forest, estimatorParamMaps=maps, evaluator=by_error, numFolds=3, seed=models.SEED).fit(frame).avgMetrics
    assert [p for p, _ in got] == [{p.name: v for p, v in m.items()} for m in maps]
    assert [e for (p, e) in got] == pytest.approx(wanted, rel=0.1)


def test_vectors_move_the_training_lines_once(spark):
    """As codes; the test lines stay where they are, and both get the codes of the training lines."""
    rows = [(i, float(i % 13), 1.0 * i, 2.0, 0.1, 3.0, *["abc"[i % 3]] * 6) for i in range(300)]
    names = ", ".join(f"{c} string" for c in features.CATEGORIES)
    base = spark.createDataFrame(rows, f"order_id bigint, sales double, profit double, quantity double, discount double, shipment_days double, {names}")
    train, test = models.vectors(base, ["order_id"])
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in (train, test)]
    assert plans[0].count("Exchange") == 1 and "Exchange" not in plans[1]
    assert train.columns == test.columns == ["label", "features"] and train.count() + test.count() == 300
    assert train.schema["features"].metadata["ml_attr"]["attrs"]["nominal"]
    is_train = {r.order_id: r.t for r in base.select("order_id", features.is_train(["order_id"]).alias("t")).collect()}
    assert sorted(r.features[0] for r in test.collect()) == [float(i) for i, t in sorted(is_train.items()) if not t]
