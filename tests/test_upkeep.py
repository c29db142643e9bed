"""Panels kept up to date, mergeable profiles, moving holidays."""

import calendar
import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from saleslake.operators import features, forecast, panel, profiles
from saleslake.plans import upkeep
from saleslake.plans.upkeep import Upkeep
from saleslake.sources import published


def lines(spark, rows):
    return spark.createDataFrame(rows, "order_date date, k string, sales decimal(18,4)")


def months_of(keys, months=30, seed=1):
    rng = random.Random(seed)
    return [(date(2018 + m // 12, m % 12 + 1, rng.randint(1, 28)), k, rng.randint(1, 99)) for m in range(months) for k in keys for _ in range(2)]


def decimals(rows):
    from decimal import Decimal

    return [(d, k, None if v is None else Decimal(v)) for d, k, v in rows]


def same(spark, root, frame):
    """Whether panel and forecast below `root` are those of all lines."""
    whole = panel.monthly(frame, ["k"], ["sales"])
    ahead = forecast.forecast(whole, ["k"], ["sales"])
    for name, wanted in (("panel", whole), ("forecast", ahead)):
        got = published.read_published(spark, root, name)
        assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0, name
    return True


def test_only_what_changed_is_summed_and_fitted(spark, tmp_path):
    root, rows = str(tmp_path), months_of("abcd")
    first = lines(spark, decimals(rows))
    assert upkeep.update(first, root, ["k"], ["sales"]) == Upkeep(30, 30, 4, 4) and same(spark, root, first)
    # the order of the lines does not matter
    assert upkeep.update(lines(spark, decimals(rows[::-1])), root, ["k"], ["sales"]) == Upkeep(30, 0, 4, 0)
    # an equal line more, a changed value, a line that has gone and a line without a date
    later = [*rows[1:], rows[5], (date(2019, 3, 3), "b", 7), (None, "d", 5)]
    second = lines(spark, decimals(later))
    done = upkeep.update(second, root, ["k"], ["sales"])
    assert (done.months, done.series) == (31, 4) and done.months_summed == 3 and same(spark, root, second)
    # a key with a new month: all forecasts move
    third = lines(spark, decimals([*later, (date(2021, 1, 5), "e", 9)]))
    done = upkeep.update(third, root, ["k"], ["sales"])
    assert done == Upkeep(32, 1, 5, 5) and same(spark, root, third)


def test_series_without_a_changed_month_keep_their_forecast(spark, tmp_path):
    root = str(tmp_path)
    rows = months_of("abc") + [(date(2018, 5, 5), "z", 3)]
    upkeep.update(lines(spark, decimals(rows)), root, ["k"], ["sales"])
    # z alone has a line in no other month; the others have lines in all of them
    changed = [r for r in rows if r[1] != "a" or r[0].month != 7] + [(date(2018, 7, 1), "a", 1)]
    frame = lines(spark, decimals(changed))
    done = upkeep.update(frame, root, ["k"], ["sales"])
    assert done.series_fitted == 3 and done.series == 4 and same(spark, root, frame)


def test_sketches_of_parts_merge_to_those_of_the_whole(spark):
    rng = random.Random(3)
    rows = [(date(2020, 1, 1) + timedelta(days=rng.randint(0, 200)), f"c{rng.randint(0, 5000)}", rng.random() * 100) for _ in range(20_000)]
    df = spark.createDataFrame([*rows, (date(2020, 1, 1), None, None), (None, "x", 1.0)], "order_date date, c string, v double")
    stored = profiles.monthly_sketches(df, ["c"], ["v"])
    assert stored.count() == len({d.month for d, _, _ in rows}) + 1
    for some in (F.lit(True), F.col("month") < "2020-03-01", F.col("month").isNull()):
        mine = df.withColumn("month", F.trunc("order_date", "MM")).filter(some)
        state = profiles.merged(stored.filter(some))
        exact, n = mine.agg(F.count_distinct("c"), F.count(F.lit(1))).first()
        assert state.first().rows == n
        assert abs(profiles.distinct_estimates(state, ["c"]).first().estimate - exact) <= 0.03 * exact + 1
        values = sorted(r.v for r in mine.filter("v is not null").collect())
        for r in profiles.quantile_estimates(state, ["v"], [0.0, 0.3, 0.9, 1.0]).collect():
            rank = sum(v <= r.estimate for v in values) / len(values)
            assert abs(rank - r.quantile) <= 0.01 + 1 / len(values)


def test_easter_and_weekdays(spark):
    known = {1954: (4, 18), 1981: (4, 19), 2000: (4, 23), 2019: (4, 21), 2024: (3, 31), 2025: (4, 20), 2038: (4, 25), 2285: (3, 22)}
    years = spark.createDataFrame([(y,) for y in known], "y int")
    got = {r.y: r.e for r in years.select("y", features.easter(F.col("y")).alias("e")).collect()}
    assert got == {y: date(y, m, d) for y, (m, d) in known.items()}
    cells = [(m, w, n) for m in (1, 2, 11) for w in range(1, 8) for n in (1, 4, 5, -1, -5)]
    row = years.filter("y = 2024").select(*[features.nth_weekday(F.col("y"), *c).alias(f"x{i}") for i, c in enumerate(cells)]).first()
    for value, (m, w, n) in zip(row, cells, strict=True):
        all_days = [date(2024, m, d) for d in range(1, calendar.monthrange(2024, m)[1] + 1) if (date(2024, m, d).weekday() + 1) % 7 + 1 == w]
        wanted = all_days[n - 1] if 0 < n <= len(all_days) else all_days[n] if n < 0 and -n <= len(all_days) else None
        assert value == wanted, (m, w, n)


def test_distance_to_holidays(spark):
    rng = random.Random(5)
    days = [date(2020, 1, 1) + timedelta(days=rng.randint(0, 700)) for _ in range(300)]
    rules = {"a": ("fixed", 12, 25), "b": ("easter", 1), "c": ("nth", 11, 5, 4), "d": ("fixed", 12, 25)}
    df = spark.createDataFrame([(d, 1) for d in days] + [(None, 2)], "order_date date, mark int")
    calendar_ = features.holidays_of_rules(df, "order_date", rules)
    holidays = {r.holiday for r in calendar_.collect()}
    assert {d.year for d in holidays} == {2019, 2020, 2021, 2022}
    rows = features.with_holiday_distance(df, calendar_).collect()
    assert len(rows) == 301
    for r in rows:
        if r.order_date is None:
            assert not r.is_holiday and r.days_to_holiday is None
        else:
            assert r.is_holiday == (r.order_date in holidays) and r.mark == 1
            assert r.days_since_holiday == min((r.order_date - h).days for h in holidays if h <= r.order_date)
            assert r.days_to_holiday == min((h - r.order_date).days for h in holidays if h >= r.order_date)
    alone = features.with_holiday_distance(df, calendar_.limit(0)).filter("days_since_holiday is not null or days_to_holiday is not null")
    assert alone.count() == 0
