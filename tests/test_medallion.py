"""A small bronze file with dirty lines, through all layers."""

from datetime import date

import pytest

from saleslake.operators import clean, quality, star
from saleslake.plans import medallion
from saleslake.sources import layers
from saleslake.sources.order_lines import order_lines

FOLDER = "/root/testdata/sf0.001"

HEADER = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID", "Customer Name", "Segment", "City",
    "State", "Country", "Postal Code", "Market", "Region", "Product ID", "Category", "Sub-Category", "Product Name",
    "Sales", "Quantity", "Discount", "Profit", "Shipping Cost", "Order Priority",
]


def line(row, order, ordered, shipped, product="P1", name="Chair", sales="10.5", priority="High", postal="123", mode="First"):
    return (
        str(row), order, ordered, shipped, mode, "C1", "Ann", "Consumer", "Rome", "Lazio", "Italy", postal, "EU", "South",
        product, "Furniture", "Chairs", name, sales, "2", "0.1", "-1.25", "3.5", priority,
    )


LINES = [
    line(1, "A", "01-02-2020", "03-02-2020", priority="Low"),
    line(2, "A", "01-02-2020", "02-02-2020", product="P2", name="Desk", priority="Critical", mode="Second"),
    line(3, "B", "05-02-2020", "09-03-2020", name="Armchair", postal=None),
    line(4, "B", "05-02-2020", "09-03-2020", priority="Odd"),
    line(5, "C", "31-02-2020", "09-03-2020"),
    line(6, "D", "07-02-2020", "01-02-2020", sales="abc"),
    line(7, "F", "08-02-2020", "08-02-2020", priority=None),
    line(8, "E", "08-02-2020", "08-02-2020", priority="Odd"),
    line(9, "G", "08-02-2020", "08-02-2020", priority="Odd"),
    line(9, "G", "08-02-2020", "08-02-2020"),
    line("x", "H", "08-02-2020", "08-02-2020"),
]


@pytest.fixture(scope="module")
def layered(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layers"))
    layers.write_bronze(spark.createDataFrame(LINES, layers.all_text(HEADER)), f"{root}/bronze")
    silver = medallion.to_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/bad")
    gold = medallion.to_gold(silver, f"{root}/gold", ["row_id"])
    return root, silver, gold


def test_good_and_bad_are_disjoint_and_complete(spark, layered):
    root, silver, _ = layered
    bad = layers.read_silver(spark, f"{root}/bad").collect()
    assert {r.row_id for r in silver.collect()} == {1, 2, 3, 4, 8}
    assert {r.row_id: r.bad_reasons for r in bad} == {
        "5": ["unreadable_order_date", "no_order_date"],
        "6": ["unreadable_sales", "ship_before_order", "no_sales"],
        "7": ["no_priority"],
        "9": ["repeated_row_id"],
        "x": ["unreadable_row_id", "no_row_id"],
    }
    # the text that did not fit is still there
    assert {r.order_date for r in bad if r.row_id == "5"} == {"31-02-2020"} and {r.sales for r in bad if r.row_id == "6"} == {"abc"}
    assert len(bad) + silver.count() == len(LINES)


def test_silver_is_typed_and_filled(layered):
    _, silver, _ = layered
    row = silver.filter("row_id = 3").first()
    assert (row.postal_code, row.order_date, row.ship_quarter, str(row.sales)) == ("Unknown", date(2020, 2, 5), 1, "10.5000")


def test_star(layered):
    _, silver, gold = layered
    assert [(r.product_key, r.product_id, r.product_name) for r in gold["dim_product"].orderBy("product_key").collect()] == [
        (1, "P1", "Armchair"), (2, "P2", "Desk"),
    ]
    orders = {r.order_id: r for r in gold["dim_order"].collect()}
    assert (orders["A"].order_priority, orders["A"].ship_date, orders["A"].ship_mode) == ("Critical", date(2020, 2, 2), "First")
    assert orders["B"].order_priority == "High" and orders["E"].order_priority == "Unknown"
    # ship dates that are no order dates have keys as well, so no line is lost
    assert gold["dim_date"].count() == 6
    assert [r.fact_key for r in gold["fact_sales"].orderBy("fact_key").collect()] == [1, 2, 3, 4, 5]
    assert tuple(star.reconcile(silver, gold["fact_sales"]).first()) == (5, 5, 5)
    data = gold["fact_data"].filter("fact_key = 2").first()
    assert (data.order_id, data.product_name, data.ship_date_value) == ("A", "Desk", date(2020, 2, 2))


def test_normalised_entities_have_unique_keys(layered):
    _, silver, _ = layered
    entities = star.normalised(silver, ["row_id"])
    keys = {
        "customers": ["customer_id"], "orders": ["order_id"], "products": ["product_id"],
        "order_details": ["order_id", "product_id"], "locations": ["location_id"],
    }
    for name, key in keys.items():
        assert quality.uniqueness(entities[name], name, *key).first().repeated_keys == 0
    assert entities["order_details"].filter("order_id = 'B'").first().quantity == 4.0


def test_names_keep_their_dash(spark):
    df = clean.snake_case_names(spark.createDataFrame([("a", "b")], "`Sub-Category` string, `Order ID` string"))
    assert df.columns == ["sub-category", "order_id"]


def test_forecasts_are_written(spark, tmp_path):
    from pyspark.sql import functions as F

    months = spark.range(0, 36).select(
        F.add_months(F.lit("2018-01-01").cast("date"), F.col("id").cast("int")).alias("order_date"),
        (100 + F.col("id") % 12).cast("decimal(18,4)").alias("sales"), F.lit("x").alias("category"),
    )
    written = medallion.to_forecasts(months, str(tmp_path), grains={"category": (["category"], ["sales"])})
    got = [round(r.forecasted_sales, 6) for r in written["category"].orderBy("month").collect()]
    assert got == [100.0 + i for i in range(12)]
    assert written["category"].agg(F.min("month")).first()[0] == date(2021, 1, 1)


def dirty_lines(spark):
    rows = [
        (1, "A", "C1", "Ann", "Consumer", "Rome"), (2, "A", "C1", "Ann", "Corporate", "Rome"), (3, "B", None, None, None, "Oslo"),
        (4, "B", "C2", "Bob", "Consumer", None), (5, "C", "C2", "Bob", "Consumer", None),
    ]
    keys = "row_id int, order_id string, customer_id string, customer_name string, segment string, city string"
    return spark.createDataFrame(rows, keys).selectExpr(
        "*", "date '2020-01-05' as order_date", "if(row_id = 5, null, date '2020-01-06') as ship_date", "'First' as ship_mode",
        "'High' as order_priority", "'Italy' as country", "'L' as state", "'South' as region", "'EU' as market",
        "if(row_id = 4, null, 'P1') as product_id", "'Chair' as product_name", "'F' as category", "'C' as sub_category",
        "cast(1.5 as decimal(18,4)) as sales", "2 as quantity", "cast(0 as decimal(18,4)) as discount",
        "cast(1 as decimal(18,4)) as profit", "cast(1 as decimal(18,4)) as shipping_cost",
    )


def test_star_keeps_lines_with_lost_keys(spark, tmp_path):
    lines = dirty_lines(spark)
    gold = medallion.to_gold(lines, str(tmp_path), ["row_id"])
    assert tuple(star.reconcile(lines, gold["fact_sales"]).first()) == (5, 5, 5)
    data = {r.fact_key: r for r in gold["fact_data"].collect()}
    assert len(data) == 5 and data[3].customer_id is None and data[4].city is None and data[4].product_id is None
    assert (data[1].segment, data[2].segment) == ("Consumer", "Corporate") and data[5].ship_date_value is None


def test_all_forecasts_equal_their_operator(spark, tmp_path):
    from pyspark.sql import functions as F

    from saleslake.operators import forecast, panel

    lines = spark.range(0, 60).selectExpr(
        "add_months(date '2018-01-01', cast(id % 30 as int)) as order_date", "concat('s', id % 2) as segment", "'c' as category",
        "concat('u', id % 3) as sub_category", "'r' as region", "'l' as country", "'t' as state", "concat('y', id % 2) as city",
        "concat('p', id % 4) as product_name", "cast(10 + id % 7 as decimal(18,4)) as sales",
        "cast(id % 5 as decimal(18,4)) as profit", "cast(1 + id % 3 as int) as quantity",
    )
    written = medallion.to_forecasts(lines, str(tmp_path))
    assert set(written) == set(medallion.FORECASTS)
    for name, (keys, measures) in medallion.FORECASTS.items():
        direct = forecast.forecast(panel.monthly(lines, keys, measures), keys, measures)
        assert written[name].count() > 0
        assert written[name].exceptAll(direct).count() == 0 and direct.exceptAll(written[name]).count() == 0
    short = medallion.to_forecasts(lines, str(tmp_path / "w"), {"total": ([], ["sales"])}, whole_months=True)
    # the last line is dated on the first of its month
    assert short["total"].agg(F.min("month")).first()[0] == date(2020, 6, 1)


def test_scratch_tables_are_removed(spark, tmp_path):
    import os

    from saleslake.sources.shared import fresh_path, scratch, written

    with scratch(spark):
        path = fresh_path(spark, "x")
        frame = written(spark.range(3), "y")
        spark.range(2).write.parquet(path)
        files = frame.inputFiles()
        assert frame.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path) and not os.path.exists(files[0].removeprefix("file://"))


def test_a_dimension_reads_only_the_tables_it_needs(spark):
    """Each dimension had the lines joined to the products and the customers, whether it has use for them or not."""
    asked = []

    def of(*columns):
        asked.append(set(columns))
        return order_lines(spark, FOLDER, *columns)

    fact, dims = star.build_star(of)
    assert {"order_date", "ship_date"} in asked and {"product_id", "product_name", "category", "sub_category"} in asked
    assert not any("product_name" in columns and "customer_name" in columns for columns in asked)
    whole, _ = star.build_star(order_lines(spark, FOLDER))
    assert fact.exceptAll(whole).count() == 0 and fact.count() == whole.count()
