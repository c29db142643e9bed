"""Monthly panels, decomposition, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.functions.dates import month_label
from saleslake.operators import forecast as fc
from saleslake.operators import panel as panels
from saleslake.operators.arima import arma_coefficients, arma_fits, arma_forecast
from saleslake.operators.smoothing import BOUNDS, GRID, PRIME
from saleslake.plans import upkeep
from saleslake.plans.registry import LINES, query
from saleslake.sources import published
from saleslake.sources.order_lines import lines_sql, order_lines
from saleslake.sources.shared import fresh_path, written

_MONTH = "cast(date_trunc('month', order_date) as date)"


def _panel(spark, folder, keys, measures, whole_months=False):
    return panels.monthly(order_lines(spark, folder, "order_date", *keys, *measures), keys, measures, whole_months)


def _named(panel, measures):
    return panel.withColumns({f"total_{m}": F.col(m).cast("double") for m in measures}).drop(*measures)


def _panel_query(name: str, keys: list[str], measures: list[str]) -> None:
    sums = ", ".join(f"cast(sum({m}) as double) as total_{m}" for m in measures)
    by = "".join(f", {k}" for k in keys)

    @query(name, f"{LINES} select {_MONTH} as month{by}, {sums} from lines group by {_MONTH}{by}")
    def run(spark, folder):
        panel = _panel(spark, folder, keys, measures)
        return _named(panel, measures).orderBy("month", *keys)


SUBCATEGORY = ["category", "sub_category"]
SEGMENT = ["segment", *SUBCATEGORY]
COUNTRY = [*SEGMENT, "country"]
REGION_COUNTRY = [*SEGMENT, "region", "country"]
STATE = [*SEGMENT, "country", "state"]
REGION_STATE = [*SEGMENT, "region", "country", "state"]
CITY_PRODUCT = [*SEGMENT, "region", "country", "city", "product_name"]

_panel_query("panel_category", ["category"], ["sales"])
_panel_query("panel_subcategory", SUBCATEGORY, ["sales"])
_panel_query("panel_segment", SEGMENT, ["sales"])
_panel_query("panel_country", COUNTRY, ["sales"])
_panel_query("panel_region_country", REGION_COUNTRY, ["sales", "profit"])
_panel_query("panel_state", STATE, ["sales"])
_panel_query("panel_region_state", REGION_STATE, ["sales"])
_panel_query("panel_city_product", CITY_PRODUCT, ["sales", "profit", "quantity"])

_GRAINS = [[], ["category"], SUBCATEGORY, SEGMENT, COUNTRY, REGION_COUNTRY, STATE, REGION_STATE]
_ALL_KEYS = list(dict.fromkeys(k for g in _GRAINS for k in g))


@query(
    "panel_grouping_sets",
    f"{LINES} "
    + " union all ".join(
        f"select cast({i} as integer) as grain, {_MONTH} as month, "
        + ", ".join(k if k in g else f"null as {k}" for k in _ALL_KEYS)
        + f", cast(sum(sales) as double) as total_sales from lines group by {', '.join([_MONTH, *g])}"
        for i, g in enumerate(_GRAINS)
    ),
)
def panel_grouping_sets(spark, folder):
    lines = order_lines(spark, folder, "order_date", *_ALL_KEYS, "sales")
    return _named(panels.monthly_grains(lines, _GRAINS, ["sales"]), ["sales"])


@query(
    "monthly_sales",
    f"""{LINES} select strftime(order_date, '%Y-%m') as year_month, {_MONTH} as month, cast(sum(sales) as double)
    as total_sales from lines group by all""",
)
def monthly_sales(spark, folder):
    panel = _named(_panel(spark, folder, [], ["sales"]), ["sales"])
    return panel.withColumn("year_month", month_label("month")).orderBy("month")


@query(
    "monthly_first15",
    f"""{LINES} select {_MONTH} as month, cast(sum(sales) as double) as total_sales from lines group by 1
    order by 1 limit 15""",
)
def monthly_first15(spark, folder):
    return _named(_panel(spark, folder, [], ["sales"]), ["sales"]).orderBy("month").limit(15)


@query("daily_sales", f"{LINES} select order_date, cast(sum(sales) as double) as total_sales from lines group by 1")
def daily_sales(spark, folder):
    return _named(panels.daily(order_lines(spark, folder, "order_date", "sales"), ["sales"]), ["sales"])


# In SQL: the start of the last month if it is still running, else that of the next.
_RUNNING = """(select case when max(order_date) < last_day(max(order_date)) then date_trunc('month', max(order_date))
    else date_trunc('month', max(order_date)) + interval 1 month end from lines)"""


# Oracle CTEs: the sums by month, and the span of all months.
def _panel_sql(keys: list[str], measures: list[str], whole_months: bool = False) -> str:
    by = "".join(f", {k}" for k in keys)
    sums = ", ".join(f"cast(sum({m}) as double) as {m}" for m in measures)
    return f"""{LINES}, panel as (select {_MONTH} as month{by}, {sums} from lines
    {f"where order_date < {_RUNNING}" if whole_months else ""} group by {_MONTH}{by}), span as (select min(month) as lo, max(month) as hi from panel),
    spine as (select cast(unnest(generate_series(lo, hi, interval 1 month)) as date) as month from span)"""


def _padded_sql(keys: list[str], measures: list[str], whole_months: bool = False) -> str:
    """Adds `ids` (one id per key) and `full` (id, position, month, measures), every key at every month."""
    names = ", ".join(keys)
    if not keys:
        ids, join = "select 1 as id", "on p.month = m.month"
    else:
        ids = f"select row_number() over () as id, {names} from (select distinct {names} from panel)"
        join = f"on p.month = m.month and {' and '.join(f'p.{k} = i.{k}' for k in keys)}"
    values = ", ".join(f"coalesce(p.{m}, 0.0::double) as {m}" for m in measures)
    return f"""{_panel_sql(keys, measures, whole_months)}, ids as materialized ({ids}),
    months as (select month, cast(row_number() over (order by month) as integer) as pos from spine),
    full_panel as materialized (select i.id, m.pos, m.month, {values} from ids i cross join months m
        left join panel p {join})"""


@query("month_spine", f"{_panel_sql([], ['sales'])} select month from spine")
def month_spine(spark, folder):
    return panels.spine(_panel(spark, folder, [], ["sales"]))


@query(
    "series_stats",
    f"""{_panel_sql([], ['sales'])} select round(avg(sales), 4) as mean, round(var_samp(sales), 0) as variance,
    round(stddev_samp(sales), 4) as sd from panel""",
)
def series_stats(spark, folder):
    y = F.col("sales").cast("double")
    return _panel(spark, folder, [], ["sales"]).agg(
        F.round(F.avg(y), 4).alias("mean"), F.round(F.var_samp(y), 0).alias("variance"),
        F.round(F.stddev_samp(y), 4).alias("sd"),
    )


_PAIR = ", ".join(SUBCATEGORY)


@query(
    "panel_padded",
    f"""{_padded_sql(COUNTRY, ['sales'])} select month, {', '.join(COUNTRY)}, sales as total_sales
    from full_panel join ids using (id)""",
)
def panel_padded(spark, folder):
    full = panels.padded(_panel(spark, folder, COUNTRY, ["sales"]), COUNTRY, ["sales"])
    return full.withColumnRenamed("sales", "total_sales")


@query(
    "feat_lag_rolling",
    f"""{_padded_sql(SUBCATEGORY, ['sales'])} select month, {_PAIR}, sales,
    lag(sales) over w as sales_lag_1, round(avg(sales) over (w rows between 2 preceding and current row), 6)
    as sales_rolling_avg_3m from full_panel join ids using (id) window w as (partition by id order by pos)""",
)
def feat_lag_rolling(spark, folder):
    full = panels.padded(_panel(spark, folder, SUBCATEGORY, ["sales"]), SUBCATEGORY, ["sales"])
    featured = panels.lag_and_rolling(full, SUBCATEGORY, "sales")
    return featured.withColumn("sales_rolling_avg_3m", F.round("sales_rolling_avg_3m", 6))


@query(
    "ts_split",
    f"""{_padded_sql(['category'], ['sales'])} select month, category, sales,
    case when pos <= 36 then 'train' else 'test' end as part from full_panel join ids using (id)""",
)
def ts_split(spark, folder):
    full = panels.padded(_panel(spark, folder, ["category"], ["sales"]), ["category"], ["sales"])
    return panels.split_by_position(full, ["category"], 36)


def _decompose_sql(keys: list[str]) -> str:
    """Sums stay decimals up to the one division, on a panel with every month of every key."""
    by = "".join(f", {k}" for k in keys)
    part = "partition by " + ", ".join(keys) if keys else ""
    on = " and ".join(["u.month = m.month", *[f"u.{k} = i.{k}" for k in keys]])
    return f"""{LINES}, u as (select {_MONTH} as month{by}, sum(sales) as y from lines group by {_MONTH}{by}),
    months as (select cast(unnest(generate_series(min(month), max(month), interval 1 month)) as date) as month from u),
    i as (select distinct {', '.join(keys) if keys else '1 as one'} from u),
    p as (select m.month{"".join(f", i.{k}" for k in keys)}, coalesce(y, 0) as y from i cross join months m left join u on {on}),
    t as (select *, cast(2 * sum(y) over (w rows between 5 preceding and 5 following) + lag(y, 6) over w + lead(y, 6) over w
        as double) / 24.0::double as trend from p window w as ({part} order by month)),
    r as (select *, month(month) as pos, cast(y as double) / nullif(trend, 0) as ratio from t),
    m as (select pos{by}, avg(ratio) as raw from r group by pos{by}),
    s as (select *, raw / nullif(avg(raw) over ({part}), 0) as seasonal from m)
    select month{by}, cast(y as double) as sales, trend, round(seasonal, 8) as seasonal,
    round(cast(y as double) / nullif(trend * seasonal, 0), 8) as resid from r join s using (pos{by})"""


def _decompose_query(name: str, keys: list[str]) -> None:
    @query(name, _decompose_sql(keys))
    def run(spark, folder):
        full = panels.padded(_panel(spark, folder, keys, ["sales"]), keys, ["sales"], exact=True)
        parts = panels.decompose(full, keys, "sales")
        return parts.withColumns({c: F.round(c, 8) for c in ("seasonal", "resid")})


_decompose_query("ts_decompose", [])
_decompose_query("ts_decompose_category", ["category"])
# few lines a key, so with months without any
_decompose_query("ts_decompose_sparse", ["city", "category"])


# Holt-Winters in SQL: one row per series, measure and parameter set, walked month by month.
def _walk_sql(keys, measures, grid=GRID, multiplicative=False, train=None, whole_months=False) -> str:
    """Ends in CTE `fit(id, measure, a, b, g, e, l, tr, s, n)`: the best parameter set of each series."""
    sets = ", ".join(f"({i}, {a}::double, {b}::double, {g}::double)" for i, (a, b, g) in enumerate(grid))
    stacked = " union all ".join(f"select id, pos, '{m}' as measure, {m} as y from full_panel" for m in measures)
    limit = f"where pos <= {train}" if train else ""
    first, second = (
        "(" + " + ".join(f"ys[{i}]" for i in range(lo, lo + 12)) + ") / 12.0::double" for lo in (1, 13)
    )
    if multiplicative:
        trend = "pow(m2 / m1, 1.0::double / 12)"
        season, begin = "x / (m1 * pow(b0, i - 6.5::double))", "m1 * pow(b0, 5.5::double)"
        level = "a * y / s[1] + (1.0::double - a) * (l * tr)"
        slope = "b * nl / l + (1.0::double - b) * tr"
        turn = "g * y / (l * tr) + (1.0::double - g) * s[1]"
        miss = "(y - (l * tr) * s[1])"
        usable = "where list_min(ys) > 0"
    else:
        trend = "(m2 - m1) / 12.0::double"
        season, begin = "x - (m1 + b0 * (i - 6.5::double))", "m1 + b0 * 5.5::double"
        level = "a * (y - s[1]) + (1.0::double - a) * (l + tr)"
        slope = "b * (nl - l) + (1.0::double - b) * tr"
        turn = "g * (y - l - tr) + (1.0::double - g) * s[1]"
        miss = "(y - l - tr - s[1])"
        usable = ""
    return f"""{_padded_sql(keys, measures, whole_months)}, grid(p, a, b, g) as (values {sets}),
    stacked as ({stacked}),
    listed as materialized (select id, measure, list(y order by pos) as ys, count(*) as n
        from stacked {limit} group by id, measure),
    means as (select *, {first} as m1, {second} as m2, {trend} as b0 from listed {usable}),
    walk(id, measure, p, t, l, tr, s, e) as (
        select id, measure, p, 13, {begin}, b0, list_transform(ys[1:12], lambda x, i: {season}), 0.0::double
        from means cross join grid
        union all
        select id, measure, p, t + 1, nl, {slope}, list_append(s[2:12], {turn}), e + {miss} * {miss}
        from (select w.*, ys[t] as y, a, b, g, {level} as nl from walk w join listed using (id, measure)
              join grid using (p) where t <= n)),
    fit as (select f.*, a, b, g from (select w.*, n, row_number() over (partition by w.id, w.measure order by e, w.p) as rn
        from walk w join listed using (id, measure) where t = n + 1) f join grid using (p) where rn = 1)"""


def _ahead_sql(keys, measures, digits=None, multiplicative=False, **settings) -> str:
    value = "l * g12 * s[(h - 1) % 12 + 1]" if multiplicative else "l + h * tr + s[(h - 1) % 12 + 1]"
    if multiplicative:
        power = "(select list_reduce(list_transform(generate_series(1, h), lambda i: tr), lambda x, y: x * y))"
        value = value.replace("g12", power)
    if digits is not None:
        value = f"round({value}, {digits})"
    columns = ", ".join(f"max(v) filter (measure = '{m}') as forecasted_{m}" for m in measures)
    by = "".join(f", {k}" for k in keys)
    return f"""{_walk_sql(keys, measures, multiplicative=multiplicative, **settings)},
    ahead as (select id, measure, h, {value} as v from (select *, unnest(generate_series(1, 12)) as h from fit))
    select cast((select hi from span) + to_months(cast(h as integer)) as date) as month{by}, {columns}
    from ahead join ids using (id) group by id, h{by}"""


def _forecast_query(name: str, keys: list[str], measures: list[str], whole_months=False, with_sql=True) -> None:
    @query(name, _ahead_sql(keys, measures, whole_months=whole_months) if with_sql else None)
    def run(spark, folder):
        return fc.forecast(_panel(spark, folder, keys, measures, whole_months), keys, measures)


_forecast_query("fc_total", [], ["sales"])
_forecast_query("fc_category", ["category"], ["sales"])
_forecast_query("fc_subcategory", SUBCATEGORY, ["sales"])
_forecast_query("fc_segment", SEGMENT, ["sales"])
_forecast_query("fc_country", COUNTRY, ["sales"])
_forecast_query("fc_region_country", REGION_COUNTRY, ["sales"])
_forecast_query("fc_sales_profit", REGION_COUNTRY, ["sales", "profit"])
_forecast_query("fc_state", STATE, ["sales"])
_forecast_query("fc_region_state", REGION_STATE, ["sales"])
_forecast_query("fc_category_whole_months", ["category"], ["sales"], whole_months=True)
# SQL takes minutes for these many series; the tests compare this one on a small table
CITY_PRODUCT_MEASURES = ["sales", "profit", "quantity"]
_forecast_query("fc_city_product", CITY_PRODUCT, CITY_PRODUCT_MEASURES, with_sql=False)
CITY_PRODUCT_SQL = _ahead_sql(CITY_PRODUCT, CITY_PRODUCT_MEASURES)
_ONE_PLACE = "country = 'CHINA' and segment = 'BUILDING'"


@query(
    "fc_city_product_part",
    CITY_PRODUCT_SQL.replace(LINES, f"with recursive all_lines as ({lines_sql()}), lines as (select * from all_lines where {_ONE_PLACE})"),
)
def fc_city_product_part(spark, folder):
    """The finest grain, three measures, for one country and segment."""
    lines = order_lines(spark, folder, "order_date", *CITY_PRODUCT, *CITY_PRODUCT_MEASURES).filter(_ONE_PLACE)
    panel = panels.monthly(lines, CITY_PRODUCT, CITY_PRODUCT_MEASURES)
    return fc.forecast(panel, CITY_PRODUCT, CITY_PRODUCT_MEASURES)




@query(
    "hw_fit_additive",
    f"""{_walk_sql(SUBCATEGORY, ['sales'])} select {_PAIR}, 'ok' as status, a as alpha, b as beta, g as gamma, e as sse,
    l as level, tr as trend from fit join ids using (id)""",
)
def hw_fit_additive(spark, folder):
    fitted = fc.fits(_panel(spark, folder, SUBCATEGORY, ["sales"]), SUBCATEGORY, ["sales"])
    return fitted.select(*SUBCATEGORY, "fit_sales.*").drop("steps", "forecast")


@query(
    "hw_fit_multiplicative",
    f"""{_walk_sql(['segment'], ['sales'], multiplicative=True)} select segment,
    case when l is null then 'nonpositive' else 'ok' end as status, a as alpha, b as beta,
    g as gamma, round(e / 1e6, 2) as sse_millions, round(l, 2) as level, round(tr, 8) as trend
    from ids left join fit using (id)""",
)
def hw_fit_multiplicative(spark, folder):
    fitted = fc.fits(_panel(spark, folder, ["segment"], ["sales"]), ["segment"], ["sales"], multiplicative=True)
    return fitted.select("segment", "fit_sales.*").select(
        "segment", "status", "alpha", "beta", "gamma", F.round(F.col("sse") / F.lit(1e6), 2).alias("sse_millions"),
        F.round("level", 2).alias("level"), F.round("trend", 8).alias("trend"),
    )


_STEPS = 200  # of the search for smoothing parameters


def _refined_query(name: str, keys: list[str], multiplicative: bool) -> None:
    by = ", ".join(keys)
    scale = "1e6" if multiplicative else "1.0"

    @query(
        name,
        f"""{_walk_sql(keys, ['sales'], multiplicative=multiplicative)} select {by}, round(e / {scale}::double, 2) as grid_sse,
        true as never_above, true as within_bounds from fit join ids using (id)""",
    )
    def run(spark, folder):
        """The error of the best set of the grid, and whether the refined parameters have no larger one."""
        panel = _panel(spark, folder, keys, ["sales"])
        grid = fc.fits(panel, keys, ["sales"], multiplicative=multiplicative).select(*keys, F.col("fit_sales").alias("g"))
        fine = fc.fits(panel, keys, ["sales"], multiplicative=multiplicative, refine=_STEPS).select(*keys, F.col("fit_sales").alias("f"))
        inside = F.least("f.alpha", "f.beta", "f.gamma") >= BOUNDS[0]
        both = grid.filter("g.status = 'ok'").join(fine, keys, "left")
        return both.select(
            *keys, F.round(F.col("g.sse") / F.lit(float(scale)), 2).alias("grid_sse"),
            F.coalesce(F.col("f.sse") <= F.col("g.sse"), F.lit(False)).alias("never_above"),
            F.coalesce(inside & (F.greatest("f.alpha", "f.beta", "f.gamma") <= BOUNDS[1]), F.lit(False)).alias("within_bounds"),
        )


_refined_query("hw_refined_additive", COUNTRY, False)
_refined_query("hw_refined_multiplicative", ["segment"], True)


@query("fc_total_mul", _ahead_sql([], ["sales"], digits=2, multiplicative=True))
def fc_total_mul(spark, folder):
    result = fc.forecast(_panel(spark, folder, [], ["sales"]), [], ["sales"], multiplicative=True)
    return result.withColumn("forecasted_sales", F.round("forecasted_sales", 2))


@query(
    "fc_status",
    f"""{_padded_sql(COUNTRY, ['sales'])} select {', '.join(COUNTRY)},
    case when min(sales) > 0 then 'ok' else 'nonpositive' end as status
    from full_panel join ids using (id) group by {', '.join(COUNTRY)}""",
)
def fc_status(spark, folder):
    """Which series cannot take a multiplicative fit."""
    return fc.fit_status(_panel(spark, folder, COUNTRY, ["sales"]), COUNTRY, "sales", multiplicative=True)


@query(
    "hw_holdout_accuracy",
    f"""{_walk_sql([], ['sales'], multiplicative=True, train=36)},
    ahead as (select h, l * (select list_reduce(list_transform(generate_series(1, h), lambda i: tr), lambda x, y: x * y))
        * s[(h - 1) % 12 + 1] as v from (select *, unnest(generate_series(1, (select max(pos) from full_panel) - 36)) as h from fit)),
    pairs as (select sales as a, v from full_panel join ahead on pos = 36 + h)
    select round(sqrt(avg((a - v) * (a - v))), 2) as rmse,
    round(1.0::double - avg((a - v) * (a - v)) / var_pop(a), 6) as r2,
    round(avg(abs(a - v) / abs(a)) * 100.0::double, 6) as mape from pairs""",
)
def hw_holdout_accuracy(spark, folder):
    panel = _panel(spark, folder, [], ["sales"])
    pairs = fc.holdout(panel, [], "sales", train=36, multiplicative=True)
    return fc.accuracy(pairs, []).select(
        F.round("rmse", 2).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("mape", 6).alias("mape")
    )


@query(
    "fc_interval",
    f"""{_walk_sql(['category'], ['sales'])},
    ahead as (select category, h, l + h * tr + s[h] as v, 1.96::double * sqrt(e / cast(n - 12 as double) * (1.0::double + coalesce(
        list_sum(list_transform(generate_series(1, h - 1), lambda j: (a * (1.0::double + b * j)) * (a * (1.0::double + b * j)))), 0)))
        as half from (select *, unnest(generate_series(1, 12)) as h from fit) join ids using (id))
    select cast((select hi from span) + to_months(cast(h as integer)) as date) as month, category, v as forecasted_sales,
    round(v - half, 2) as lower, round(v + half, 2) as upper from ahead""",
)
def fc_interval(spark, folder):
    result = fc.with_interval(_panel(spark, folder, ["category"], ["sales"]), ["category"], "sales")
    return result.withColumns({c: F.round(c, 2) for c in ("lower", "upper")})


@query(
    "fc_seasonal_ar",
    f"""{_padded_sql(SUBCATEGORY, ['sales'])},
    d as (select id, pos, sales, sales - lag(sales, 12) over (partition by id order by pos) as w from full_panel),
    e as (select *, lag(w) over (partition by id order by pos) as w1 from d),
    f as (select id, sum(w * w1) / sum(w1 * w1) as phi, max(pos) as n from e where w1 is not null group by id),
    z as (select f.*, w as w_last from f join d on d.id = f.id and d.pos = f.n)
    select cast((select hi from span) + to_months(d.pos + 12 - n) as date) as month, {_PAIR},
    round(phi, 8) as phi, round(d.sales + pow(phi, d.pos + 12 - n) * w_last, 2) as forecasted_sales
    from z join d on d.id = z.id and d.pos > n - 12 join ids on ids.id = z.id""",
)
def fc_seasonal_ar(spark, folder):
    result = fc.seasonal_regression(_panel(spark, folder, SUBCATEGORY, ["sales"]), SUBCATEGORY, "sales")
    return result.withColumns({"phi": F.round("phi", 8), "forecasted_sales": F.round("forecasted_sales", 2)})


# --- intervals from simulated paths ---

_PATHS, _SEED = 200, 7


def _draw_sql(series: str, path: str, step: str) -> str:
    """The random number of `smoothing.draws`, as nested integer expressions."""
    k = f"(((({_SEED} + {series}) % {PRIME}) * 48271 + 11) % {PRIME})"
    k = f"((({k} + {path}) % {PRIME} * 69621 + 7) % {PRIME})"
    k = f"((({k} + {step}) % {PRIME} * 48271 + 3) % {PRIME})"
    k = f"((xor({k}, {k} >> 15) * 16807 + 5) % {PRIME})"
    return f"((xor({k}, {k} >> 13) * 48271) % {PRIME})"


def _simulated_sql(multiplicative: bool) -> str:
    if multiplicative:
        miss = "(listed.ys[w.t] - w.l * w.tr * w.s[1]) / (w.l * w.tr * w.s[1])"
        value, season = "l * tr * s[1] * (1 + miss)", "g * y / (l * tr) + (1 - g) * s[1]"
        level, trend = "a * y / s[1] + (1 - a) * (l * tr)", "b * nl / l + (1 - b) * tr"
    else:
        miss = "listed.ys[w.t] - w.l - w.tr - w.s[1]"
        value, season = "l + tr + s[1] + miss", "g * (y - l - tr) + (1 - g) * s[1]"
        level, trend = "a * (y - s[1]) + (1 - a) * (l + tr)", "b * (nl - l) + (1 - b) * tr"
    at = [int(q * (_PATHS - 1)) + 1 for q in (0.025, 0.5, 0.975)]
    return f"""{_walk_sql(['segment'], ['sales'], multiplicative=multiplicative)},
    errors as (select w.id, list({miss} order by w.t) as misses
        from walk w join fit f on f.id = w.id and f.p = w.p join listed on listed.id = w.id where w.t <= listed.n group by w.id),
    chosen as (select id, segment, a, b, g, l, tr, s, misses, cast('0x' || substr(md5(segment), 1, 6) as bigint) as number
        from fit join errors using (id) join ids using (id)),
    future(id, path, h, l, tr, s, y) as (
        select id, path, 0, l, tr, s, 0.0::double from chosen cross join (select unnest(generate_series(0, {_PATHS - 1})) as path)
        union all
        select id, path, h + 1, nl, {trend}, list_append(s[2:12], {season}), y from (select *, {level} as nl from (select *, {value} as y from
            (select f.id, f.path, f.h, f.l, f.tr, f.s, a, b, g, misses[{_draw_sql('number', 'path', 'h')} % len(misses) + 1] as miss
             from future f join chosen c using (id) where h < 12)))),
    ranked as (select id, h, list_sort(list(y)) as ys from future where h > 0 group by id, h)
    select cast((select hi from span) + to_months(cast(h as integer)) as date) as month, segment, round(ys[{at[0]}], 2) as lower,
    round(ys[{at[1]}], 2) as middle, round(ys[{at[2]}], 2) as upper from ranked join ids using (id)"""


def _simulated_query(name: str, multiplicative: bool) -> None:
    @query(name, _simulated_sql(multiplicative))
    def run(spark, folder):
        panel = _panel(spark, folder, ["segment"], ["sales"])
        found = fc.with_simulated_interval(panel, ["segment"], "sales", multiplicative=multiplicative, paths=_PATHS, seed=_SEED)
        return found.withColumns({c: F.round(c, 2) for c in ("lower", "middle", "upper")})


_simulated_query("fc_interval_simulated", False)
_simulated_query("fc_interval_simulated_mul", True)


# --- ARMA of the difference to the year before ---

_DIFFERENCED = f"""{_padded_sql(SUBCATEGORY, ['sales'])},
    d as (select id, pos, sales - lag(sales, 12) over (partition by id order by pos) as w from full_panel),
    past as (select *, lag(w) over by_time as w1, lag(w, 2) over by_time as w2 from d where w is not null
        window by_time as (partition by id order by pos))"""


@query(
    "ts_arma_conditional",
    f"""{_DIFFERENCED},
    long as (select id, sum(w1 * w1) as a, sum(w1 * w2) as b, sum(w2 * w2) as c, sum(w * w1) as m, sum(w * w2) as n from past
        where w2 is not null group by id),
    shocks as (select id, pos, w, w1, w - (m * c - n * b) / (a * c - b * b) * w1 - (a * n - b * m) / (a * c - b * b) * w2 as e
        from past join long using (id) where w2 is not null),
    pairs as (select *, lag(e) over (partition by id order by pos) as e1 from shocks),
    short as (select id, sum(w1 * w1) as a, sum(w1 * e1) as b, sum(e1 * e1) as c, sum(w * w1) as m, sum(w * e1) as n from pairs
        where e1 is not null group by id)
    select {_PAIR}, round((m * c - n * b) / (a * c - b * b), 6) as phi, round((a * n - b * m) / (a * c - b * b), 6) as theta
    from short join ids using (id)""",
)
def ts_arma_conditional(spark, folder):
    """Coefficients of an ARMA(1, 1) by two regressions, the innovations from two past values."""
    series = panels.series(_panel(spark, folder, SUBCATEGORY, ["sales"]), SUBCATEGORY, ["sales"])
    fitted = series.select(*SUBCATEGORY, arma_coefficients(1, 1, long=2)(panels.dense("sales")).alias("f"))
    return fitted.select(*SUBCATEGORY, F.round(F.get("f.phi", 0), 6).alias("phi"), F.round(F.get("f.theta", 0), 6).alias("theta"))


@query(
    "ts_arma_order",
    f"""{_DIFFERENCED},
    sums as (select id, count(*) as n, sum(w * w) as s0, sum(w * w1) / sum(w1 * w1) as phi, first(w order by pos) as w0 from past group by id),
    misses as (select id, sum((w - phi * w1) * (w - phi * w1)) as s1 from past join sums using (id) where w1 is not null group by id),
    fits as (select *, -0.5::double * n * (ln(2 * pi() * s0 / n) + 1) as l0, -0.5::double * n * (ln(2 * pi() * ((1 - phi * phi) * w0 * w0 + s1) / n) + 1)
        + 0.5::double * ln(1 - phi * phi) as l1 from sums join misses using (id)),
    best as (select *, abs(phi) <= 0.999 and 4 - 2 * l1 < 2 - 2 * l0 as one from fits)
    select {_PAIR}, case when one then 1 else 0 end as p, round(case when one then phi end, 6) as phi,
    round(case when one then l1 else l0 end, 4) as log_likelihood, round(case when one then 4 - 2 * l1 else 2 - 2 * l0 end, 4) as aic
    from best join ids using (id)""",
)
def ts_arma_order(spark, folder):
    """White noise or one autoregressive term, by the exact likelihood, which SQL can state for these two."""
    fits = arma_fits(_panel(spark, folder, SUBCATEGORY, ["sales"]), SUBCATEGORY, "sales", most=(1, 0))
    return fits.select(
        *SUBCATEGORY, "p", F.round(F.get("phi", 0), 6).alias("phi"), F.round("log_likelihood", 4).alias("log_likelihood"), F.round("aic", 4).alias("aic"),
    )


@query("fc_arima")
def fc_arima(spark, folder):
    """Forecasts with up to two autoregressive and two moving-average terms, each series with the order that suits it best."""
    return arma_forecast(_panel(spark, folder, SUBCATEGORY, ["sales"]), SUBCATEGORY, "sales")


@query(
    "history_plus_forecast",
    f"""{_walk_sql(['category'], ['sales'])}
    select month, category, sales, 'history' as kind from panel union all
    select cast((select hi from span) + to_months(cast(h as integer)) as date), category, l + h * tr + s[h], 'forecast'
    from (select *, unnest(generate_series(1, 12)) as h from fit) join ids using (id)""",
)
def history_plus_forecast(spark, folder):
    panel = _panel(spark, folder, ["category"], ["sales"])
    history = panel.select("month", "category", F.col("sales").cast("double").alias("sales"), F.lit("history").alias("kind"))
    future = fc.forecast(panel, ["category"], ["sales"]).select(
        "month", "category", F.col("forecasted_sales").alias("sales"), F.lit("forecast").alias("kind")
    )
    return history.unionByName(future)


# --- panels kept up to date ---

# Lines that come with the second run: those of two months of 1996, and a few that were late.
_LATE = "order_date >= date '1996-03-01' and order_date < date '1996-05-01' or order_id % 40 = 0 and order_date < date '1993-01-01'"


def _kept_up(spark, folder) -> tuple[str, list[upkeep.Upkeep]]:
    root = fresh_path(spark, "upkeep")
    # written once: each of the runs passes over its lines several times
    lines = written(order_lines(spark, folder, "order_id", "order_date", *SUBCATEGORY, "sales"), "upkeep-lines")
    first = lines.filter(~F.coalesce(F.expr(_LATE), F.lit(False)))
    return root, [upkeep.update(part, root, SUBCATEGORY, ["sales"]) for part in (first, lines, lines)]


@query("panel_upkept", f"{LINES} select {_MONTH} as month, {_PAIR}, cast(sum(sales) as double) as total_sales from lines group by all")
def panel_upkept(spark, folder):
    """The panel after a second load, in which only the months that had changed were summed."""
    root, _ = _kept_up(spark, folder)
    return _named(published.read_published(spark, root, "panel"), ["sales"])


@query("fc_upkept", _ahead_sql(SUBCATEGORY, ["sales"]))
def fc_upkept(spark, folder):
    """Forecasts after a second load: those of all lines, though series without a changed month were not fitted again."""
    root, _ = _kept_up(spark, folder)
    return published.read_published(spark, root, "forecast")


@query(
    "panel_upkeep_runs",
    f"""{LINES}, early as (select * from lines where not coalesce({_LATE}, false)), late as (select * from lines where {_LATE}),
    counts as (select (select count(distinct {_MONTH}) from early) as m1, (select count(distinct {_MONTH}) from lines) as m2,
        (select count(distinct {_MONTH}) from late) as changed, (select count(*) from (select distinct {_PAIR} from early)) as s1,
        (select count(*) from (select distinct {_PAIR} from lines)) as s2, (select count(*) from (select distinct {_PAIR} from lines
        where {_MONTH} in (select {_MONTH} from late))) as touched)
    select 1 as run, m1 as months, m1 as months_summed, s1 as series, s1 as series_fitted from counts
    union all select 2, m2, changed, s2, touched from counts union all select 3, m2, 0, s2, 0 from counts""",
)
def panel_upkeep_runs(spark, folder):
    """What each of three runs summed and fitted; the third finds nothing changed."""
    _, runs = _kept_up(spark, folder)
    rows = [(i, r.months, r.months_summed, r.series, r.series_fitted) for i, r in enumerate(runs, 1)]
    return spark.createDataFrame(rows, "run int, months bigint, months_summed bigint, series bigint, series_fitted bigint")
