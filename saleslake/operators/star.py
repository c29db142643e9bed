"""Star schema: five dimensions with dense keys, the fact table, its read-back, and the normalised entities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.functions.labels import priority_label, priority_rank
from saleslake.operators.keys import beside, first_per_key, numbered
from saleslake.schema import GOLD
from saleslake.sources.order_lines import LINE_KEY
from saleslake.sources.shared import side_by_side, written


def _within_order(line_key: list[str]):
    """The order of the lines of one order; `line_key` are the columns that tell lines apart."""
    return F.struct(*[c for c in line_key if c != "order_id"])


def keyed_distinct(lines: DataFrame, columns: list[str], key: str, order: list[str] | None = None) -> DataFrame:
    """Distinct rows of `columns` numbered in `order` (then by the other columns)."""
    first = order or columns
    full = first + [c for c in columns if c not in first]
    return numbered(lines.select(*columns).dropDuplicates(), full, key).select(key, *columns)


def dim_product(lines: DataFrame) -> DataFrame:
    """One row per product id; of several names the first in order wins."""
    single = first_per_key(lines, "product_id", ["product_name", "category", "sub_category"])
    return numbered(single, ["product_id"], "product_key").select(*GOLD["dim_product"])


def dim_customer(lines: DataFrame) -> DataFrame:
    return keyed_distinct(lines, ["customer_id", "customer_name", "segment"], "customer_key")


def dim_location(lines: DataFrame) -> DataFrame:
    return keyed_distinct(lines, ["country", "state", "region", "market", "city"], "location_key")


def dim_date(lines: DataFrame) -> DataFrame:
    """Every date on which a line was ordered or shipped, so that no line loses a date key."""
    dates = lines.select(F.explode(F.array("order_date", "ship_date")).alias("order_date"))
    dates = dates.filter("order_date is not null").dropDuplicates()
    return numbered(dates, ["order_date"], "date_key").select(
        "date_key",
        "order_date",
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
        F.date_format("order_date", "MMMM").alias("order_month_name"),
        F.quarter("order_date").alias("order_quarter"),
        F.dayofmonth("order_date").alias("order_day"),
        F.date_format("order_date", "EEEE").alias("order_weekday"),
    )


def consolidated_orders(lines: DataFrame, line_key: list[str] = LINE_KEY) -> DataFrame:
    """One row per order: earliest ship date, most urgent priority, ship mode of the first line."""
    return lines.groupBy("order_id").agg(
        F.min("ship_date").alias("ship_date"),
        F.min_by("ship_mode", _within_order(line_key)).alias("ship_mode"),
        F.min(priority_rank(F.col("order_priority"))).alias("rank"),
    )


def dim_order(lines: DataFrame, line_key: list[str] = LINE_KEY) -> DataFrame:
    orders = consolidated_orders(lines, line_key).withColumn("order_priority", priority_label(F.col("rank"))).drop("rank")
    return numbered(orders, ["order_id"], "order_key").select(*GOLD["dim_order"])


def build_dims(lines: DataFrame | Callable[..., DataFrame], line_key: list[str] = LINE_KEY) -> dict[str, DataFrame]:
    """All dimensions. They do not depend on each other, so their jobs share the cluster at the same time.

    `lines` may be a function from column names to the lines with these columns: then a dimension does not read what it has no use for.
    """
    return _side_by_side(_dim_jobs(_by_columns(lines), line_key))


HOT_ORDER = 1_000_000  # lines of an order that one task may number


def build_star(
    lines: DataFrame | Callable[..., DataFrame], line_key: list[str] = LINE_KEY, keyed: Callable[[dict], Callable] | None = None,
    where: str | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The fact table and all dimensions; `lines` as in `build_dims`.

    Where the line key begins with the order, a line's number is the lines of all earlier orders and its place in its own: the orders, which are
    fewer, are numbered over the cluster, and the lines are moved to their orders and not once more, nor written. Lines of other
    keys, or with an order of more than `HOT_ORDER` lines, meet the dimensions first and are numbered over the cluster then.

    `keyed` makes of the dimensions a function like `lines`, whose lines may be asked for `product_key` and `customer_key` as well.
    With `where`, a condition on `order_key`, the fact table has only the lines of these orders (that have an id), with the numbers they have among all.
    """
    of = _by_columns(lines)
    jobs = _dim_jobs(of, line_key)

    def last(narrow: DataFrame) -> DataFrame:
        fact = build_fact(_numbered_last(narrow, dims, line_key), dims)
        if not where:
            return fact
        few = written(dims["dim_order"].filter("order_id is not null").filter(where).select("order_key"), "few-orders")
        return fact.join(few, "order_key", "left_semi").select(*GOLD["fact_sales"])

    if line_key[0] != "order_id" or len(line_key) == 1:
        dims = _side_by_side(jobs)
        return last(_narrow(of, line_key)), dims
    dims = _side_by_side({**jobs, "dim_order": lambda: _orders(of, line_key)})
    orders, dims["dim_order"] = dims["dim_order"], dims["dim_order"].select(*GOLD["dim_order"])
    narrow = _narrow(keyed(dims), line_key, ["product_key", "customer_key"]) if keyed else _narrow(of, line_key)
    if keyed:
        for name in ("dim_product", "dim_customer"):
            narrow = _with_null_key(narrow, dims[name], name)
    if (orders.agg(F.max("_lines")).first()[0] or 0) > HOT_ORDER:
        return last(narrow), dims
    if where:
        # the orders first: their lines alone meet what else there is, and are numbered as among all
        few = written(orders.filter(where).select("order_id"), "few-orders")
        ends = few.agg(F.min("order_id"), F.max("order_id")).first()
        narrow = narrow.filter(F.col("order_id").between(*ends)).join(few, "order_id", "left_semi")
    return build_fact(_numbered_in_orders(narrow, orders, line_key), dims), dims


def _orders(of: Callable[..., DataFrame], line_key: list[str]) -> DataFrame:
    """The order dimension with the number of lines of each order, `_lines`, and of all earlier ones, `before`.

    What the lines say is summed before they meet the orders. The lines are counted as the fact table will have them, after all joins.
    """
    columns = dict.fromkeys(["order_id", *line_key, "ship_date", "ship_mode"])
    shipped = of(*columns).groupBy("order_id").agg(F.min("ship_date").alias("ship_date"), F.min_by("ship_mode", _within_order(line_key)).alias("ship_mode"))
    ranks = of(*dict.fromkeys(["order_id", "order_priority", *_columns(line_key)])).groupBy(F.col("order_id").alias("_id")).agg(
        F.min(priority_rank(F.col("order_priority"))).alias("rank"), F.count(F.lit(1)).alias("_lines")
    )
    orders = shipped.join(ranks.hint("merge"), F.expr("order_id <=> _id")).select(
        "order_id", "ship_date", "ship_mode", priority_label(F.col("rank")).alias("order_priority"), "_lines"
    )
    return numbered(orders, ["order_id"], "order_key", "_lines")


def _numbered_in_orders(lines: DataFrame, orders: DataFrame, line_key: list[str]) -> DataFrame:
    """Lines with their order and fact keys; `orders` as `_orders` makes them."""
    places = orders.select(F.col("order_id").alias("_order"), F.col("order_key").alias("_key"), "before")
    of_null = places.filter("_order is null").agg(F.first("_key")).scalar()
    joined = lines.join(beside(places), F.col("order_id") == F.col("_order"), "left")
    place = F.row_number().over(Window.partitionBy("order_id").orderBy(*[c for c in line_key if c != "order_id"]))
    return joined.withColumns({
        # orders without an id come first
        "fact_key": F.coalesce("before", F.lit(0)) + place,
        "order_key": F.when(F.col("order_id").isNull(), of_null).otherwise(F.col("_key")),
    }).drop("_order", "_key", "before")


def _numbered_last(narrow: DataFrame, dims: dict[str, DataFrame], line_key: list[str]) -> DataFrame:
    """Lines with all keys, numbered when they have met the dimensions, as the keys are less to move and to write than hashes.

    Keys of the dimensions stand for their natural keys there: they are dense in the same order.
    """
    joined = with_keys(narrow, dims)
    by_natural = {column: key for key, column in _SINGLE.values()}
    order = [by_natural.get(c, c) for c in line_key]
    kept = dict.fromkeys([*order, "order_date", "ship_date", "customer_key", "product_key", "order_key", "location_key", *_MEASURES])
    return numbered(joined.select(*kept), order, "fact_key")


def _with_null_key(lines: DataFrame, dim: DataFrame, name: str) -> DataFrame:
    """The key of the row without any value, for lines that met no source row with a key."""
    key, columns = _TUPLES.get(name) or (_SINGLE[name][0], [_SINGLE[name][1]])
    empty = dim.filter(" and ".join(f"{c} is null" for c in columns)).agg(F.first(key)).scalar()
    return lines.withColumn(key, F.coalesce(key, empty))


def _by_columns(lines: DataFrame | Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    return lines if callable(lines) else lambda *columns: lines.select(*columns)


def _dim_jobs(of: Callable[..., DataFrame], line_key: list[str]) -> dict:
    ordered = dict.fromkeys(["order_id", *line_key, "ship_date", "ship_mode", "order_priority"])
    return {
        "dim_product": lambda: dim_product(of("product_id", "product_name", "category", "sub_category")),
        "dim_customer": lambda: dim_customer(of(*_TUPLES["dim_customer"][1])),
        "dim_location": lambda: dim_location(of(*_TUPLES["dim_location"][1])),
        "dim_date": lambda: dim_date(of("order_date", "ship_date")),
        "dim_order": lambda: dim_order(of(*ordered), line_key),
    }


def _side_by_side(jobs: dict) -> dict:
    return dict(zip(jobs, side_by_side(jobs.values()), strict=True))


# Columns that tell the rows of a dimension apart; those of more than one column are compared by hash.
_TUPLES = {
    "dim_location": ("location_key", ["country", "state", "region", "market", "city"]),
    "dim_customer": ("customer_key", ["customer_id", "customer_name", "segment"]),
}
_SINGLE = {"dim_product": ("product_key", "product_id"), "dim_order": ("order_key", "order_id")}
_MEASURES = ["sales", "quantity", "discount", "profit", "shipping_cost"]


def _hashes(name: str) -> list[Column]:
    """128 bits of the tuple of a dimension, as two columns; NULL is a value like any other, in each place another one."""
    parts = [x for c in _TUPLES[name][1] for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*parts).alias(f"_{name}_low"), F.xxhash64(F.lit(1), *parts).alias(f"_{name}_high")]


def _hash_names(name: str) -> list[str]:
    return [f"_{name}_low", f"_{name}_high"]


def number_lines(lines: DataFrame, line_key: list[str] = LINE_KEY) -> DataFrame:
    """Lines with the dense fact key, in line order. Done before the joins, which then run only once."""
    return numbered(lines, line_key, "fact_key")


def _columns(line_key: list[str], given: list[str] = ()) -> list[str]:
    """Columns of the lines that the fact table is made of; `given` keys spare the tuples behind them."""
    plain = dict.fromkeys([*line_key, *[c for _, c in _SINGLE.values()], "order_date", "ship_date", *_MEASURES, *given])
    return list(dict.fromkeys([*plain, *[c for key, columns in _TUPLES.values() if key not in given for c in columns]]))


def _narrow(of: Callable[..., DataFrame], line_key: list[str], given: list[str] = ()) -> DataFrame:
    """What the fact table needs of each line: keys, dates and measures, and hashes in place of wide tuples."""
    tuples = [name for name, (key, _) in _TUPLES.items() if key not in given]
    wide = {c for name in tuples for c in _TUPLES[name][1]} - set(line_key)
    columns = _columns(line_key, given)
    return of(*columns).select(*[c for c in columns if c not in wide], *[h for name in tuples for h in _hashes(name)])


def with_date_keys(lines: DataFrame, dates: DataFrame) -> DataFrame:
    """The date dimension in its two roles."""
    ordered = dates.select(
        F.col("order_date").alias("_ordered"), F.col("date_key").alias("order_date_key"), "order_year", "order_month"
    )
    shipped = dates.select(F.col("order_date").alias("_shipped"), F.col("date_key").alias("ship_date_key"))
    return (
        lines.drop("order_year", "order_month")
        .join(ordered, F.expr("order_date = _ordered"), "left")
        .join(shipped, F.expr("ship_date = _shipped"), "left")
        .drop("_ordered", "_shipped")
    )


def _with_single_key(lines: DataFrame, dim: DataFrame, column: str, key: str) -> DataFrame:
    """The key of the dimension row with the same natural key, where NULL equals NULL."""
    plain = dim.select(key, F.col(column).alias("_natural"))
    of_null = plain.filter("_natural is null").agg(F.first(key)).scalar()
    joined = lines.join(beside(plain.withColumnRenamed(key, "_key")), F.col(column) == F.col("_natural"), "left")
    return joined.withColumn(key, F.when(F.col(column).isNull(), of_null).otherwise(F.col("_key"))).drop("_natural", "_key")


def _with_tuple_key(lines: DataFrame, dim: DataFrame, name: str, more: list[str]) -> DataFrame:
    """The key, and `more` columns, of the dimension row with the same tuple, found by its hash.

    Every line's tuple is in the dimension, so it is enough to check there that no two tuples share a hash.
    """
    keyed = dim.select(_TUPLES[name][0], *_hashes(name), *more)
    rows, tuples = keyed.agg(F.count(F.lit(1)), F.count_distinct(*_hash_names(name))).first()
    if rows != tuples:
        raise ValueError(f"two rows of {name} are alike, or share a hash of 128 bits")
    if not set(_hash_names(name)) <= set(lines.columns):
        lines = lines.select("*", *_hashes(name))
    return lines.drop(*more).join(beside(keyed), _hash_names(name), "left").drop(*_hash_names(name))


def with_keys(lines: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Lines with the keys of all dimensions but the dates, those they lack; the orders first, as lines often come in the partitions of their orders."""
    joined = lines
    if "order_key" not in lines.columns:
        joined = _with_single_key(joined, dims["dim_order"], *reversed(_SINGLE["dim_order"]))
    for name, (key, _) in _TUPLES.items():
        if key not in lines.columns:
            joined = _with_tuple_key(joined, dims[name], name, ["region", "market"] if name == "dim_location" else [])
        elif name == "dim_location" and "region" not in lines.columns:
            joined = joined.join(beside(dims[name].select(key, "region", "market")), key)
    if "product_key" not in lines.columns:
        joined = _with_single_key(joined, dims["dim_product"], *reversed(_SINGLE["dim_product"]))
    return joined


def build_fact(lines: DataFrame, dims: dict[str, DataFrame], extra: list[str] | None = None) -> DataFrame:
    """Numbered lines (see number_lines and build_star) with the keys of all dimensions, and the `extra` columns of the lines.

    A line meets a dimension on all columns that make its rows distinct (customers: id, name and segment), and NULL is
    a value like any other there. So each line finds one row of each dimension and occurs once in the fact; only a NULL
    date has a NULL date key. Tuples travel as hashes of 64 bits, and region and market come from the place. The dimensions are
    read from written files: the planner knows their sizes and broadcasts only those below its threshold.
    """
    return with_date_keys(with_keys(lines, dims), dims["dim_date"]).select(*GOLD["fact_sales"], *(extra or []))


def fact_data(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The fact table with readable values in place of its keys."""
    dates = dims["dim_date"]
    return (
        fact.join(beside(dims["dim_order"].select("order_key", "order_id")), "order_key")
        .join(beside(dims["dim_customer"]), "customer_key")
        .join(beside(dims["dim_product"]), "product_key")
        .join(beside(dims["dim_location"].select("location_key", "country", "state", "city")), "location_key")
        .join(
            dates.select(F.col("date_key").alias("order_date_key"), F.col("order_date").alias("order_date_value")),
            "order_date_key",
            "left",
        )
        .join(
            dates.select(F.col("date_key").alias("ship_date_key"), F.col("order_date").alias("ship_date_value")),
            "ship_date_key",
            "left",
        )
        .select(*GOLD["fact_data"])
    )


def reconcile(lines: DataFrame, fact: DataFrame) -> DataFrame:
    """Source lines, fact rows and distinct fact keys, side by side; all equal if no line is lost or multiplied."""
    source = lines.agg(F.count(F.lit(1))).scalar()
    rows = fact.groupBy("fact_key").count()
    return rows.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("fact_rows"), F.count(F.lit(1)).alias("distinct_fact_rows")
    ).select(source.alias("source_rows"), "fact_rows", "distinct_fact_rows")


def normalised_orders(lines: DataFrame, line_key: list[str] = LINE_KEY) -> DataFrame:
    return lines.groupBy("order_id").agg(
        F.min("order_date").alias("order_date"),
        F.min("ship_date").alias("ship_date"),
        F.min_by("ship_mode", _within_order(line_key)).alias("ship_mode"),
        F.min("customer_id").alias("customer_id"),
    )


def normalised_details(lines: DataFrame) -> DataFrame:
    """Lines summed to their primary key (order, product)."""
    measures = ("quantity", "discount", "sales", "profit", "shipping_cost")
    return lines.groupBy("order_id", "product_id").agg(*[F.sum(c).cast("double").alias(c) for c in measures])


def normalised_locations(lines: DataFrame, line_key: list[str] = LINE_KEY) -> DataFrame:
    """One place per order, as the unique order reference asks: the place of its first line."""
    place = F.struct("city", "state", "country", "region", "customer_id")
    places = lines.groupBy("order_id").agg(F.min_by(place, _within_order(line_key)).alias("p"))
    return numbered(places.select("order_id", "p.*"), ["order_id"], "location_id")


def normalised(lines: DataFrame, line_key: list[str] = LINE_KEY) -> dict[str, DataFrame]:
    """The flat lines as entities, each with one row per primary key."""
    return {
        "customers": first_per_key(lines, "customer_id", ["customer_name", "segment"]),
        "orders": normalised_orders(lines, line_key),
        "products": first_per_key(lines, "product_id", ["product_name", "category", "sub_category"]),
        "order_details": normalised_details(lines),
        "locations": normalised_locations(lines, line_key),
    }
