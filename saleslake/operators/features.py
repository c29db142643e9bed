"""Model features from order lines: base table, recency-frequency-monetary score, holidays, splits, vectors."""

from __future__ import annotations

from functools import partial

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.functions.dates import month_start, shipment_days
from saleslake.operators import panel as panels
from saleslake.operators.keys import numbered
from saleslake.sources.shared import side_by_side, written

# The columns of the feature table.
NUMERIC = ["sales", "profit", "quantity", "discount", "shipment_days"]
CATEGORIES = ["segment", "category", "sub_category", "region", "country", "state"]


def base_table(lines: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Label, four measures and six categories of each line; lines with a null among them are dropped."""
    wanted = lines.withColumn("shipment_days", shipment_days()).select(
        *(extra or []), *[F.col(c).cast("double").alias(c) for c in NUMERIC], *CATEGORIES
    )
    return wanted.na.drop(subset=[*NUMERIC, *CATEGORIES])


def is_train(key: list[str], percent: int = 80) -> Column:
    """A split that depends only on the line: the same in every run and under every partitioning.

    The key, of columns of any type, is hashed as text; NULL counts as the empty text.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(100)) < percent


def split(df: DataFrame, key: list[str], percent: int = 80) -> tuple[DataFrame, DataFrame]:
    train = is_train(key, percent)
    return df.filter(train), df.filter(~train)


def string_indexer(columns: list[str] = CATEGORIES) -> StringIndexer:
    """Index by falling frequency, equal frequencies by value; values unseen in training get an index of their own."""
    return StringIndexer(
        inputCols=columns, outputCols=[f"{c}_idx" for c in columns], stringOrderType="frequencyDesc", handleInvalid="keep"
    )


def vector_pipeline(numeric: list[str] | None = None, categories: list[str] = CATEGORIES) -> Pipeline:
    """Indexers and assembler: the measures except the label, then the indexed categories."""
    numeric = numeric or [c for c in NUMERIC if c != "sales"]
    assembler = VectorAssembler(inputCols=[*numeric, *[f"{c}_idx" for c in categories]], outputCol="features")
    return Pipeline(stages=[string_indexer(categories), assembler])


def tile(place: Column, count: Column, tiles: int) -> Column:
    """The tile 1..tiles of row `place` of `count`, as ntile gives it: the first tiles take the remainder."""
    small = F.floor(count / F.lit(tiles))
    extra = count % F.lit(tiles)
    edge = extra * (small + 1)
    low = F.floor((place - 1) / (small + 1)) + 1
    high = F.floor((place - 1 - edge) / F.greatest(small, F.lit(1))) + 1 + extra
    return F.when(place <= edge, low).otherwise(high).cast("int")


def rfm(lines: DataFrame, tiles: int = 5) -> DataFrame:
    """Recency, frequency and money of each customer, each scored 1..tiles (best last), and their sum.

    The scores rank all customers, so each ranking numbers the table over the whole cluster.
    """
    customers = lines.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order"),
        F.count_distinct("order_id").alias("frequency"),
        F.sum("sales").alias("money"),
    )
    customers = written(customers, "customers")
    last = customers.agg(F.max("last_order")).scalar()
    customers = customers.withColumn("recency_days", F.datediff(last, "last_order"))
    count = customers.agg(F.count(F.lit(1))).scalar()
    orders = {"recency": F.desc("recency_days"), "frequency": F.asc("frequency"), "money": F.asc("money")}

    def places(name: str) -> DataFrame:
        """Only the customer and the value that is ranked are moved and sorted."""
        value = "recency_days" if name == "recency" else name
        return numbered(customers.select("customer_id", value), [orders[name], F.asc("customer_id")], f"{name}_place").drop(value)

    ranked = customers
    for frame in side_by_side([partial(places, name) for name in orders]):
        ranked = ranked.join(frame.withColumnRenamed("customer_id", "_id"), F.col("customer_id").eqNullSafe(F.col("_id"))).drop("_id")
    scored = ranked.withColumns(
        {f"{n}_score": tile(F.col(f"{n}_place"), count, tiles) for n in ("recency", "frequency", "money")}
    )
    return scored.select(
        "customer_id", "recency_days", "frequency", F.col("money").cast("double").alias("money"),
        "recency_score", "frequency_score", "money_score",
        (F.col("recency_score") + F.col("frequency_score") + F.col("money_score")).alias("rfm_score"),
    )


def with_holiday(df: DataFrame, holidays: DataFrame, day: str = "order_date") -> DataFrame:
    """Flag the rows whose date is in `holidays` (a column `holiday`)."""
    calendar = holidays.select(F.col("holiday").alias(day), F.lit(True).alias("is_holiday")).dropDuplicates()
    return df.join(calendar, day, "left").na.fill(False, ["is_holiday"])


def yearly_holidays(days: DataFrame, day: str, fixed: list[tuple[int, int]]) -> DataFrame:
    """A calendar of (month, day) holidays over the years in which `days` lie."""
    years = days.select(F.year(day).alias("y")).distinct()
    dates = [F.make_date("y", F.lit(m), F.lit(d)) for m, d in fixed]
    return years.select(F.explode(F.array(*dates)).alias("holiday"))


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar, in whole numbers (the method of Meeus, Jones and Butcher)."""

    def whole(x: Column, by: int) -> Column:
        return F.floor(x / F.lit(by)).cast("int")

    golden, century, rest = year % 19, whole(year, 100), year % 100
    skipped = whole(century - whole(century + 8, 25) + 1, 3)
    moon = (golden * 19 + century - whole(century, 4) - skipped + 15) % 30
    weekday = ((century % 4) * 2 + whole(rest, 4) * 2 - moon - rest % 4 + 32) % 7
    late = whole(golden + moon * 11 + weekday * 22, 451)
    days = moon + weekday - late * 7 + 114
    return F.make_date(year, whole(days, 31), days % 31 + 1)


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """The n-th such weekday (1 Sunday to 7 Saturday) of a month, from its end with n < 0. NULL where the month has none."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n > 0:
        day = F.date_add(first, (F.lit(weekday) - F.dayofweek(first) + 7) % 7 + 7 * (n - 1))
    else:
        last = F.last_day(first)
        day = F.date_sub(last, (F.dayofweek(last) - F.lit(weekday) + 7) % 7 + 7 * (-n - 1))
    return F.when(F.month(day) == month, day)


def holidays_of_rules(days: DataFrame, day: str, rules: dict[str, tuple]) -> DataFrame:
    """(holiday, name) over the years in which `days` lie, and a year before and after.

    A rule is ("fixed", month, day), ("easter", days after it), or ("nth", month, weekday, n).
    """

    def date(year: Column, kind: str, *of: int) -> Column:
        if kind == "fixed":
            return F.make_date(year, F.lit(of[0]), F.lit(of[1]))
        return F.date_add(easter(year), of[0]) if kind == "easter" else nth_weekday(year, *of)

    years = days.select(F.explode(F.array(*[F.year(day) + i for i in (-1, 0, 1)])).alias("y")).filter("y is not null").distinct()
    each = F.array(*[F.struct(date(F.col("y"), *rule).alias("holiday"), F.lit(name).alias("name")) for name, rule in rules.items()])
    return years.select(F.inline(each)).filter("holiday is not null")


def with_holiday_distance(df: DataFrame, holidays: DataFrame, day: str = "order_date") -> DataFrame:
    """Add `is_holiday`, `days_since_holiday` and `days_to_holiday`, both 0 on a holiday; NULL where none lies on that side.

    Days and holidays are sorted into one list, and the last and next holiday filled along it. It has a row per day of the calendar,
    so the window without a key stays small however many rows `df` has.
    """
    marks = df.select(F.col(day).alias("day"), F.lit(None).cast("date").alias("mark")).filter("day is not null").distinct()
    marks = marks.union(holidays.select("holiday", F.col("holiday").alias("mark"))).groupBy("day").agg(F.max("mark").alias("mark"))
    in_time = Window.orderBy("day")
    before = F.last("mark", ignorenulls=True).over(in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("mark", ignorenulls=True).over(in_time.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    filled = marks.select(
        F.col("day").alias(day), F.col("mark").isNotNull().alias("is_holiday"), F.datediff("day", before).alias("days_since_holiday"),
        F.datediff(after, F.col("day")).alias("days_to_holiday"),
    )
    return df.join(filled, day, "left").na.fill(False, ["is_holiday"])


def monthly_history(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Previous month and three-month mean of sales, per key and month."""
    full = panels.padded(panels.monthly(lines, keys, ["sales"]), keys, ["sales"])
    return panels.lag_and_rolling(full, keys, "sales").drop("sales")


def planned_features(lines: DataFrame, holidays: DataFrame) -> DataFrame:
    """Lines with month, year, quantity, sales history of the category, holiday flag and customer score."""
    # few rows; written, so that the planner sees that and leaves the lines where they are
    history = written(monthly_history(lines, ["category"]), "history")
    scores = rfm(lines).select("customer_id", "rfm_score")
    wide = (
        lines.withColumn("month", month_start("order_date"))
        .join(history, ["category", "month"])
        .join(scores, "customer_id")
    )
    return with_holiday(wide, holidays).select(
        *lines.columns,
        F.month("order_date").alias("order_month"),
        F.year("order_date").alias("order_year"),
        F.coalesce("sales_lag_1", F.lit(0.0)).alias("sales_lag_1"),
        "sales_rolling_avg_3m",
        F.col("is_holiday").cast("int").alias("is_holiday"),
        "rfm_score",
    )
