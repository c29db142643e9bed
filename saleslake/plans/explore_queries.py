"""Sales questions: totals, shares, margins, top lists, demand."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.functions.measures import ratio, total
from saleslake.operators import explore, keys
from saleslake.plans.registry import LINES, query
from saleslake.sources.order_lines import order_lines, table


def _totals_query(name: str, by: list[str], measures: list[str]) -> None:
    """Totals by key, largest first measure first."""
    sums = ", ".join(f"cast(sum({m}) as double) as total_{m}" for m in measures)
    group = ", ".join(by)

    @query(name, f"{LINES} select {group}, {sums} from lines group by {group}")
    def run(spark, folder):
        lines = order_lines(spark, folder, *by, *measures)
        return explore.totals(lines, by, measures).orderBy(F.desc(f"total_{measures[0]}"), *by)


_totals_query("sales_by_category", ["category"], ["sales"])
_totals_query("profit_by_category", ["category"], ["profit"])
_totals_query("sales_segment_category", ["segment", "category"], ["sales"])
_totals_query("segment_money", ["segment"], ["sales", "quantity", "discount", "profit", "shipping_cost"])


@query(
    "segment_totals",
    f"""{LINES} select segment, cast(sum(line_no) as bigint) as total_line_no, cast(sum(sales) as double) as total_sales,
    cast(sum(quantity) as double) as total_quantity, cast(sum(discount) as double) as total_discount,
    cast(sum(profit) as double) as total_profit, cast(sum(shipping_cost) as double) as total_shipping_cost,
    cast(sum(year(order_date)) as bigint) as total_sales_year, cast(min(year(order_date)) as integer) as sales_year
    from lines group by segment""",
)
def segment_totals(spark, folder):
    lines = order_lines(
        spark, folder, "segment", "line_no", "sales", "quantity", "discount", "profit", "shipping_cost", "order_date"
    )
    year = F.year("order_date")
    return lines.groupBy("segment").agg(
        F.sum("line_no").alias("total_line_no"),
        *[total(m) for m in ("sales", "quantity", "discount", "profit", "shipping_cost")],
        F.sum(year).alias("total_sales_year"),
        F.min(year).alias("sales_year"),
    )


def _by_year(name: str, measures: list[str]) -> None:
    sums = ", ".join(f"cast(sum({m}) as double) as total_{m}" for m in measures)

    @query(name, f"{LINES} select cast(year(order_date) as integer) as order_year, {sums} from lines group by 1")
    def run(spark, folder):
        lines = order_lines(spark, folder, "order_date", *measures)
        return explore.totals(lines.withColumn("order_year", F.year("order_date")), ["order_year"], measures)


_by_year("sales_by_year", ["sales"])
_by_year("profit_by_year", ["profit"])
_by_year("sales_profit_by_year", ["sales", "profit"])


@query(
    "orders_by_year",
    f"{LINES} select cast(year(order_date) as integer) as order_year, count(*) as line_count from lines group by 1",
)
def orders_by_year(spark, folder):
    lines = order_lines(spark, folder, "order_date").withColumn("order_year", F.year("order_date"))
    return explore.line_counts(lines, "order_year")


def _margin_by(name: str, by: list[str]) -> None:
    group = ", ".join(by)

    @query(
        name,
        f"""{LINES} select {group}, cast(sum(sales) as double) as total_sales, cast(sum(profit) as double) as total_profit,
        cast(sum(profit) as double) / nullif(cast(sum(sales) as double), 0) as profit_margin from lines group by {group}""",
    )
    def run(spark, folder):
        grouped = explore.totals(order_lines(spark, folder, *by, "sales", "profit"), by, ["sales", "profit"])
        return explore.with_margin(grouped).orderBy(F.desc("profit_margin"), *by)


_margin_by("margin_by_subcategory", ["category", "sub_category"])
_margin_by("margin_by_segment", ["segment"])


# Fixed value: the sub-category looked into.
STUDIED = "Brand#11"


@query(
    "product_margin_one_subcat",
    f"""{LINES} select product_name, cast(sum(profit) as double) as total_profit, cast(sum(sales) as double) as total_sales,
    cast(sum(profit) as double) / cast(sum(sales) as double) as profit_margin from lines
    where sub_category = '{STUDIED}' group by product_name having sum(sales) <> 0""",
)
def product_margin_one_subcat(spark, folder):
    lines = order_lines(spark, folder, "sub_category", "product_name", "profit", "sales")
    grouped = explore.totals(lines.filter(F.col("sub_category") == STUDIED), ["product_name"], ["profit", "sales"])
    return explore.with_margin(grouped.filter("total_sales <> 0"))


@query(
    "items_above_mean_margin",
    f"""{LINES}, items as (select product_id, sum(profit) as p, sum(sales) as s from lines group by product_id),
    mean as (select cast(sum(p) as double) / cast(sum(s) as double) as m from items)
    select count(*) filter (cast(p as double) / cast(s as double) > (select m from mean)) as items_above,
    count(*) as items from items where s <> 0""",
)
def items_above_mean_margin(spark, folder):
    return explore.above_mean_margin(order_lines(spark, folder, "product_id", "profit", "sales"), ["product_id"])


@query(
    "product_totals",
    f"""{LINES} select product_name, postal_code, cast(sum(line_no) as bigint) as sum_line_no,
    cast(sum(sales) as double) as sum_sales, cast(sum(quantity) as double) as sum_quantity,
    cast(sum(discount) as double) as sum_discount, cast(sum(profit) as double) as sum_profit,
    cast(sum(shipping_cost) as double) as sum_shipping_cost,
    cast(sum(profit) as double) / nullif(cast(sum(sales) as double), 0) as profit_margin
    from lines group by product_name, postal_code""",
)
def product_totals(spark, folder):
    lines = order_lines(
        spark, folder, "product_name", "postal_code", "line_no", "sales", "quantity", "discount", "profit", "shipping_cost"
    )
    summed = explore.sum_numeric(lines, ["product_name", "postal_code"])
    return explore.with_margin(summed, "sum_profit", "sum_sales")


def _line_share(name: str, by: str, limit: int | None = None, largest: bool = True, factor: float = 100.0) -> None:
    """Share of the order lines by one key, optionally only the largest or smallest."""
    way = "desc" if largest else "asc"
    cut = f"order by line_count {way}, {by} limit {limit}" if limit else ""

    @query(
        name,
        f"""{LINES}, g as (select {by}, count(*) as line_count from lines group by {by})
        select {by}, line_count, cast(line_count as double) / cast((select sum(line_count) from g) as double) * {factor}
        as pct_lines from g {cut}""",
    )
    def run(spark, folder):
        shares = explore.share_of_total(
            explore.line_counts(order_lines(spark, folder, by), by), "line_count", "pct_lines", factor
        )
        return explore.top(shares, limit, "line_count", [by], largest) if limit else shares


_line_share("share_city_top10", "city", 10)
_line_share("share_country_top10", "country", 10)
_line_share("share_region", "region")
_line_share("share_market", "market")
_line_share("share_market_fraction", "market", factor=1.0)
_line_share("share_ship_mode", "ship_mode")
_line_share("region_bottom10", "region", 10, largest=False)


def _money_share(name: str, by: str, measure: str, limit: int | None = None) -> None:
    """Share of a money total by one key, largest first."""
    cut = f"order by {measure}_sum desc, {by} limit {limit}" if limit else ""

    @query(
        name,
        f"""{LINES}, g as (select {by}, sum({measure}) as {measure}_sum from lines group by {by})
        select {by}, cast({measure}_sum as double) as total_{measure},
        cast({measure}_sum as double) / cast((select sum({measure}_sum) from g) as double) * 100.0 as pct_{measure}
        from g {cut}""",
    )
    def run(spark, folder):
        grouped = order_lines(spark, folder, by, measure).groupBy(by).agg(F.sum(measure).alias(f"total_{measure}"))
        shares = explore.share_of_total(grouped, f"total_{measure}", f"pct_{measure}")
        if limit:
            shares = explore.top(shares, limit, f"total_{measure}", [by])
        return shares.withColumn(f"total_{measure}", F.col(f"total_{measure}").cast("double"))


_money_share("sales_country_top10", "country", "sales", 10)
_money_share("profit_share_country_top10", "country", "profit", 10)
_money_share("profit_share_market", "market", "profit")
_money_share("share_sales_category", "category", "sales")
_money_share("share_profit_category", "category", "profit")
_money_share("share_sales_segment", "segment", "sales")


@query(
    "topn_share_sum",
    f"""{LINES}, g as (select city, count(*) as line_count from lines group by city),
    t as (select line_count from g order by line_count desc, city limit 10)
    select cast(sum(line_count) as double) / cast((select sum(line_count) from g) as double) * 100.0 as pct_top from t""",
)
def topn_share_sum(spark, folder):
    cities = explore.line_counts(order_lines(spark, folder, "city"), "city")
    whole = cities.agg(F.sum("line_count")).scalar()
    first = explore.top(cities, 10, "line_count", ["city"]).agg({"line_count": "sum"})
    return first.select((ratio(F.col("sum(line_count)"), whole) * F.lit(100.0)).alias("pct_top"))


@query(
    "top_ship_mode",
    f"""{LINES}, g as (select ship_mode, count(*) as line_count from lines group by ship_mode)
    select ship_mode, line_count from g order by line_count desc, ship_mode limit 1""",
)
def top_ship_mode(spark, folder):
    modes = explore.line_counts(order_lines(spark, folder, "ship_mode"), "ship_mode")
    # of equal counts the first label wins: smallest (-count, label)
    return modes.agg(F.min(F.struct((-F.col("line_count")).alias("n"), "ship_mode")).alias("best")).select(
        "best.ship_mode", (-F.col("best.n")).alias("line_count")
    )


@query(
    "top_products",
    f"""{LINES} select product_id, product_name, cast(sum(sales) as double) as total_sales,
    cast(sum(quantity) as double) as total_quantity from lines group by product_id, product_name
    order by sum(sales) desc, product_id limit 10""",
)
def top_products(spark, folder):
    lines = order_lines(spark, folder, "product_id", "product_name", "sales", "quantity")
    grouped = explore.totals(lines, ["product_id", "product_name"], ["sales", "quantity"])
    return explore.top(grouped, 10, "total_sales", ["product_id"])


@query(
    "customers_top1pct",
    f"""{LINES}, g as (select customer_id, sum(sales) as s, sum(quantity) as q from lines group by customer_id),
    r as (select *, row_number() over (order by s desc, customer_id) as rn, count(*) over () as n from g)
    select customer_id, cast(s as double) as total_sales, cast(q as double) as total_quantity from r where rn <= n // 100""",
)
def customers_top1pct(spark, folder):
    lines = order_lines(spark, folder, "customer_id", "sales", "quantity")
    customers = lines.groupBy("customer_id").agg(F.sum("sales").alias("s"), total("quantity"))
    ranked = keys.numbered(customers, [F.desc("s"), F.asc("customer_id")], "place")
    count = ranked.agg(F.count(F.lit(1))).scalar()
    return ranked.filter(F.col("place") <= F.floor(count / F.lit(100))).select(
        "customer_id", F.col("s").cast("double").alias("total_sales"), "total_quantity"
    )


@query(
    "demand_per_1000",
    f"""{LINES} select country, count(customer_id) as line_count, count(distinct customer_id) as customer_count,
    cast(count(customer_id) as double) / cast(count(distinct customer_id) as double) * 1000.0 as demand
    from lines group by country order by demand desc, country limit 10""",
)
def demand_per_1000(spark, folder):
    demand = explore.demand_per_1000(order_lines(spark, folder, "country", "customer_id"), "country")
    return explore.top(demand, 10, "demand", ["country"])


@query(
    "join_left_countries",
    f"""{LINES}, o as (select country, count(customer_id) as line_count from lines group by country)
    select n_name as country, coalesce(line_count, 0) as line_count from nation left join o on n_name = country""",
)
def join_left_countries(spark, folder):
    """Every country with its line count, also those without lines."""
    countries = table(spark, folder, "nation").select(F.col("n_name").alias("country"))
    counted = order_lines(spark, folder, "country", "customer_id").groupBy("country").agg(
        F.count("customer_id").alias("line_count")
    )
    return countries.join(counted, "country", "left").na.fill(0, ["line_count"])
