"""Sources, sinks, cleaning, separation of bad rows, profiles and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.functions import dates
from saleslake.functions.labels import priority_rank
from saleslake.operators import clean, explore, profiles, quality, star
from saleslake.plans import medallion
from saleslake.plans.registry import LINES, query
from saleslake.sources import layers, rescue
from saleslake.sources.order_lines import LINE_COLUMNS, LINE_KEY, order_lines, table
from saleslake.sources.shared import fresh_path, scratch, written

DECIMALS = ["list_price", "sales", "quantity", "discount", "profit", "shipping_cost"]
NUMBERS = [*DECIMALS, "order_id", "line_no", "supplier_id", "customer_id", "product_id"]


def as_doubles(df, *columns):
    """Decimals as doubles, for the comparison of values."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# The bronze headers, all 24, and the number of a line within its order.
BRONZE_HEADERS = {
    "Row ID": "row_id",
    "Order ID": "order_id",
    "Line No": "line_no",
    "Order Date": "order_date",
    "Ship Date": "ship_date",
    "Ship Mode": "ship_mode",
    "Customer ID": "customer_id",
    "Customer Name": "customer_name",
    "Segment": "segment",
    "City": "city",
    "State": "state",
    "Country": "country",
    "Region": "region",
    "Market": "market",
    "Product ID": "product_id",
    "Postal Code": "postal_code",
    "Product Name": "product_name",
    "Category": "category",
    "Sub-Category": "sub_category",
    "Sales": "sales",
    "Quantity": "quantity",
    "Discount": "discount",
    "Profit": "profit",
    "Shipping Cost": "shipping_cost",
    "Order Priority": "order_priority",
}


# The lines have no number of their own.
_ROW_ID = "order_id * 8 + line_no"


def _bronze(spark, folder):
    """The order lines as bronze text: spaced headers, day-first dates."""
    lines = order_lines(spark, folder, *[c for c in BRONZE_HEADERS.values() if c != "row_id"])
    return lines.withColumn("row_id", F.expr(_ROW_ID)).select(
        *[
            (
                F.date_format(column, dates.BRONZE_FORMAT)
                if column in ("order_date", "ship_date")
                else F.col(column).cast("int" if column == "quantity" else "string").cast("string")
            ).alias(header)
            for header, column in BRONZE_HEADERS.items()
        ]
    )


_SILVER_SQL = """select cast({row_id} as integer) as row_id, customer_name, segment, city, state, country, region, market,
    product_name, cast(order_id as varchar) as order_id, cast(line_no as varchar) as line_no, order_date, ship_date,
    ship_mode, cast(customer_id as varchar) as customer_id, cast(product_id as varchar) as product_id,
    {postal} as postal_code, category, sub_category, cast(sales as double) as sales, cast(quantity as integer) as quantity,
    cast(discount as double) as discount, cast(profit as double) as profit,
    cast(shipping_cost as double) as shipping_cost, order_priority{more} from lines"""

_CALENDAR_SQL = "".join(
    f", cast({part}({role}_date) as integer) as {role}_{part}"
    for role in ("order", "ship")
    for part in ("year", "month", "day", "quarter")
) + ", cast(year(order_date) as integer) as sales_year"


@query("scan_csv_bronze", f"{LINES} {_SILVER_SQL.format(row_id=_ROW_ID, postal='postal_code', more='')}")
def scan_csv_bronze(spark, folder):
    """Lines through CSV files: written as bronze, read as text, renamed, typed."""
    path = fresh_path(spark, "bronze")
    layers.write_bronze(_bronze(spark, folder), path, "gzip")
    read = layers.read_bronze(spark, path, list(BRONZE_HEADERS))
    silver = clean.typed(clean.snake_case_names(read)).withColumnRenamed("sub-category", "sub_category")
    return as_doubles(silver, "sales", "discount", "profit", "shipping_cost")


_FILLED = "coalesce(postal_code, 'Unknown')"


@query("clean_lines", f"{LINES} {_SILVER_SQL.format(row_id=_ROW_ID, postal=_FILLED, more=_CALENDAR_SQL)}")
def clean_lines(spark, folder):
    silver = clean.clean_lines(_bronze(spark, folder)).withColumnRenamed("sub-category", "sub_category")
    return as_doubles(silver, "sales", "discount", "profit", "shipping_cost")


@query(
    "scan_parquet",
    f"""{LINES} select cast(year(order_date) as integer) as order_year, count(*) as line_count,
    cast(sum(sales) as double) as total_sales from lines group by 1""",
)
def scan_parquet(spark, folder):
    """Silver written by year and read back whole."""
    return _by_year(_silver_by_year(spark, folder))


@query(
    "scan_parquet_pruned",
    f"""{LINES} select cast(year(order_date) as integer) as order_year, count(*) as line_count,
    cast(sum(sales) as double) as total_sales from lines where order_date >= date '1997-01-01' group by 1""",
)
def scan_parquet_pruned(spark, folder):
    """The later years only: the filter reaches no other folders."""
    return _by_year(_silver_by_year(spark, folder).filter("order_year >= 1997"))


def _silver_by_year(spark, folder):
    path = fresh_path(spark, "silver")
    lines = order_lines(spark, folder, "order_date", "sales").withColumn("order_year", F.year("order_date"))
    layers.write_silver(lines, path, partition_by=["order_year"])
    return layers.read_silver(spark, path)


def _by_year(silver):
    return silver.groupBy("order_year").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("sales").cast("double").alias("total_sales")
    )


_DIM_CUSTOMER_SQL = """select row_number() over (order by customer_id, customer_name, segment) as customer_key, *
    from (select distinct customer_id, customer_name, segment from lines)"""


@query("gold_roundtrip", f"{LINES} {_DIM_CUSTOMER_SQL}")
def gold_roundtrip(spark, folder):
    path = fresh_path(spark, "gold")
    layers.write_gold(star.dim_customer(order_lines(spark, folder, "customer_id", "customer_name", "segment")), path)
    return layers.read_gold(spark, path)


def _gold_database(spark) -> str:
    layers.create_database(spark, "gold_layer", fresh_path(spark, "gold_layer"))
    return "gold_layer"


@query("catalog_table_scan", f"{LINES} {_DIM_CUSTOMER_SQL}")
def catalog_table_scan(spark, folder):
    """A managed table is saved, then replaced with another schema, then scanned."""
    name = f"{_gold_database(spark)}.dim_customer"
    lines = order_lines(spark, folder, "customer_id", "customer_name", "segment")
    layers.save_table(lines.select("customer_id").distinct(), name)
    layers.save_table(star.dim_customer(lines), name)
    return layers.read_table(spark, name)


@query(
    "gold_view",
    f"{LINES} select segment, category, cast(sum(sales) as double) as total_sales from lines group by segment, category",
)
def gold_view(spark, folder):
    """A view with readable names over a gold table."""
    database = _gold_database(spark)
    layers.save_table(order_lines(spark, folder, "segment", "category", "sales"), f"{database}.sales_lines")
    layers.create_view(
        spark,
        f"{database}.sales_by_segment_category",
        f"SELECT segment, category, cast(sum(sales) AS double) AS total_sales FROM {database}.sales_lines GROUP BY ALL",
    )
    return layers.read_table(spark, f"{database}.sales_by_segment_category")


@query(
    "priority_rank",
    f"""{LINES} select order_priority, cast(case order_priority when 'Critical' then 1 when 'High' then 2
    when 'Medium' then 3 when 'Low' then 4 else 5 end as integer) as priority_rank, count(*) as line_count
    from lines group by order_priority""",
)
def priority_rank_counts(spark, folder):
    lines = explore.line_counts(order_lines(spark, folder, "order_priority"), "order_priority")
    return lines.withColumn("priority_rank", priority_rank(F.col("order_priority")))


@query(
    "date_parts",
    f"{LINES} select order_date, ship_date{_CALENDAR_SQL}, count(*) as line_count from lines group by order_date, ship_date",
)
def date_parts(spark, folder):
    return clean.with_calendar(explore.line_counts(order_lines(spark, folder, "order_date", "ship_date"), "order_date", "ship_date"))


@query(
    "shipment_days",
    f"""{LINES} select cast(ship_date - order_date as integer) as shipment_days, count(*) as line_count
    from lines group by 1""",
)
def shipment_days(spark, folder):
    lines = order_lines(spark, folder, "order_date", "ship_date")
    return explore.line_counts(lines.withColumn("shipment_days", dates.shipment_days()), "shipment_days")


RULES = clean.RULES
_RULE_COLUMNS = LINE_KEY + ["order_date", "order_priority", "sales"]
_BAD = " or ".join(f"coalesce({p}, false)" for p in RULES.values())
_REASONS = "concat_ws(',', " + ", ".join(f"case when {p} then '{n}' end" for n, p in RULES.items()) + ")"
_KEPT = """order_id, line_no, product_id, supplier_id, ship_date, cast(list_price as double) as list_price, order_date,
    order_priority, cast(sales as double) as sales"""


@query("quarantine_good", f"{LINES} select {_KEPT} from lines where not ({_BAD})")
def quarantine_good(spark, folder):
    return as_doubles(clean.good_rows(order_lines(spark, folder, *_RULE_COLUMNS), RULES), "list_price", "sales")


@query("quarantine_bad", f"{LINES} select {_KEPT}, {_REASONS} as bad_reasons from lines where {_BAD}")
def quarantine_bad(spark, folder):
    bad = clean.bad_rows(order_lines(spark, folder, *_RULE_COLUMNS), RULES)
    return as_doubles(bad, "list_price", "sales").withColumn("bad_reasons", F.array_join("bad_reasons", ","))


# Text as it might come: some values of four columns are damaged, by arithmetic on the ids.
_DAMAGED = {
    "Sales": ("sales", "order_id % 7 = 0", "'n/a'"),
    "Quantity": ("quantity", "order_id % 11 = 0", "'two'"),
    "Discount": ("discount", "order_id % 13 = 0", "'10 %'"),
    "Ship Date": ("ship_date", "order_id % 17 = 0", "'31-02-2020'"),
}
_TEXT_REASONS = [f"case when {when} then 'unreadable_{c}' end" for c, when, _ in _DAMAGED.values()]
_LEFT_READABLE = {
    "order_priority": "order_priority is null",
    "ship": "order_id % 17 <> 0 and ship_date < order_date",
    "sales": "order_id % 7 = 0 or sales <= 0",
}


@query(
    "quarantine_text",
    f"""{LINES}, reasons as (select cast(order_id as varchar) as order_id, cast(line_no as varchar) as line_no,
    cast(product_id as varchar) as product_id, cast(list_price as double) as list_price,
    case when {_DAMAGED['Quantity'][1]} then 'two' else cast(cast(quantity as integer) as varchar) end as quantity,
    concat_ws(',', {', '.join(_TEXT_REASONS)}, case when {_LEFT_READABLE['ship']} then 'ship_before_order' end,
        case when {_LEFT_READABLE['order_priority']} then 'no_priority' end,
        case when {_LEFT_READABLE['sales']} then 'no_sales' end) as bad_reasons from lines)
    select * from reasons where bad_reasons <> ''""",
)
def quarantine_text(spark, folder):
    """Bad lines keep the text they came with, and a reason for each value that could not be read."""
    lines = order_lines(spark, folder, *LINE_KEY, "quantity", "order_date", "order_priority", "sales", "discount")
    bronze = lines.select(
        *[F.col(c).cast("string").alias(c.replace("_", " ").title()) for c in ("order_id", "line_no", "product_id")],
        F.col("list_price").cast("double").alias("List Price"),
        F.date_format("order_date", dates.BRONZE_FORMAT).alias("Order Date"),
        F.col("order_priority").alias("Order Priority"),
        F.lit(None).cast("string").alias("Postal Code"),
        *[
            F.when(F.expr(when), F.expr(text)).otherwise(
                F.date_format(c, dates.BRONZE_FORMAT)
                if c == "ship_date"
                else F.col(c).cast("int" if c == "quantity" else "string").cast("string")
            ).alias(header)
            for header, (c, when, text) in _DAMAGED.items()
        ],
    )
    bad = clean.checked(bronze, RULES).filter(F.size("bad_reasons") > 0)
    return bad.select(
        "raw.order_id", "raw.line_no", "raw.product_id", "raw.list_price", "raw.quantity",
        F.array_join("bad_reasons", ",").alias("bad_reasons"),
    )


# Lines as a careless export writes them: names with commas and quotes, surplus and lost fields, quotes that do not close, files with
# their columns in another order, and files with another header; all by arithmetic on the ids.
_FIELDS = {
    "Row ID": f"cast({_ROW_ID} as string)", "Order ID": "cast(order_id as string)", "Line No": "cast(line_no as string)",
    "Product Name": """'"' || replace(full_name, '"', '""') || '"'""", "Quantity": "cast(cast(quantity as integer) as string)",
    "Order Date": "{order_date}", "Ship Date": "{ship_date}", "Sales": "cast(sales as string)",
}
_FOREIGN = ["Nr", "Order", "Line", "Article", "Pieces", "Ordered", "Shipped", "Value"]
_FILE = "case when order_id % 50 = 7 then 'foreign' when order_id % 2 = 1 then 'turned' else 'plain' end"
_WHY = """case when order_id % 50 = 7 then 'wrong_header' when order_id % 10 in (1, 2) then 'field_count'
    when order_id % 10 = 3 then 'open_quote' end"""


def _line_sql(**dates_as_text: str) -> str:
    """The text of a line; `fields`, its parts in order, may lack one or have one too many."""
    fields = [f.format(**dates_as_text) if f.startswith("{") else f for f in _FIELDS.values()]
    opened = [f"""'"' || full_name""" if "full_name" in f else f for f in fields]
    glue = " || ',' || "
    return f"""case when order_id % 50 = 7 then {glue.join(fields)} when order_id % 10 = 1 then {glue.join(fields[::-1])} || ',surplus'
        when order_id % 10 = 2 then {glue.join(fields[:-1])} when order_id % 10 = 3 then {glue.join(opened[::-1])}
        when order_id % 2 = 1 then {glue.join(fields[::-1])} else {glue.join(fields)} end"""


_FULL_NAME = """product_name || case when order_id % 10 = 4 then ', 3" wide' else '' end"""
_DUCK_DATES = {c: f"strftime({c}, '%d-%m-%Y')" for c in ("order_date", "ship_date")}
_EXPORTED = f"""{LINES}, named as (select *, {_FULL_NAME} as full_name from lines),
    exported as (select *, cast({_ROW_ID} as integer) as row_id, {_line_sql(**_DUCK_DATES)} as line, {_WHY} as why from named)"""


def _exported(spark, folder):
    lines = order_lines(spark, folder, "order_id", "line_no", "product_name", "quantity", "order_date", "ship_date", "sales")
    named = lines.withColumn("full_name", F.expr(_FULL_NAME))
    as_text = {c: f"date_format({c}, '{dates.BRONZE_FORMAT}')" for c in ("order_date", "ship_date")}
    return named.select("*", F.expr(_line_sql(**as_text)).alias("line"), F.expr(_FILE).alias("file"))


def _export(lines) -> str:
    """The exported lines as files of three kinds; the writer of a single column puts the header on top of each."""
    path = fresh_path(lines.sparkSession, "export")
    as_is = {"header": True, "compression": "gzip", "quote": "", "sep": "\x01", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for kind, header in (("plain", list(_FIELDS)), ("turned", list(_FIELDS)[::-1]), ("foreign", _FOREIGN)):
        text = lines.filter(F.col("file") == kind).select(F.col("line").alias(",".join(header)))
        text.write.options(**as_is).csv(f"{path}/{kind}")
    return f"{path}/*"


_EXPORT_RULES = {"no_order_date": "order_date is null", "no_sales": "sales is null or sales <= 0"}


@query("quarantine_malformed", f"{_EXPORTED} select line as raw_line, 'malformed_' || why as bad_reasons from exported where why is not null")
def quarantine_malformed(spark, folder):
    """Lines that cannot be cut into fields, as the text they came with, and why."""
    exported = written(_exported(spark, folder).select("line", "file"), "exported", "zstd")
    read = rescue.read_rescued(spark, _export(exported), list(_FIELDS))
    bad = clean.checked(read, _EXPORT_RULES).filter(F.size("bad_reasons") > 0)
    return bad.select("raw_line", F.array_join("bad_reasons", ",").alias("bad_reasons"))


@query(
    "quarantine_replay",
    f"""{_EXPORTED}, whole as (select * from exported where why is null),
    good as (select * from whole where row_id not in (select row_id from whole group by row_id having count(*) > 1)),
    mended as (select * from exported where why is not null and order_id % 3 <> 0),
    good_now as (select * from mended where row_id not in (select row_id from mended group by row_id having count(*) > 1)
        and row_id not in (select row_id from good))
    select row_id, cast(order_id as string) as order_id, full_name as product_name, cast(quantity as integer) as quantity, order_date,
    cast(sales as double) as sales from (select * from good union all select * from good_now)""",
)
def quarantine_replay(spark, folder):
    """Silver after two thirds of the malformed lines were repaired and sent through the rules again."""
    silver, bad = fresh_path(spark, "silver"), fresh_path(spark, "bad")
    with scratch(spark):
        # joined once, for the files and for the repairs
        exported = written(_exported(spark, folder), "exported", "zstd")
        medallion.to_silver(spark, _export(exported), silver, bad, _EXPORT_RULES, header=list(_FIELDS))
        truth = exported.filter("order_id % 3 <> 0").withColumn("row_id", F.expr(_ROW_ID))
        texts = truth.select(
            F.col("line").alias("raw_line"), *[F.col(c).cast("string").alias(c) for c in ("row_id", "order_id", "line_no")],
            F.col("full_name").alias("product_name"), F.col("quantity").cast("int").cast("string").alias("quantity"),
            *[F.date_format(c, dates.BRONZE_FORMAT).alias(c) for c in ("order_date", "ship_date")], F.col("sales").cast("string").alias("sales"),
        )
        waiting = clean.line_ids(layers.read_silver(spark, bad)).filter("raw_line is not null").select("line_id", "raw_line")
        repairs = waiting.join(texts, "raw_line").drop("raw_line").dropDuplicates(["line_id"])
        medallion.replay(spark, silver, bad, written(repairs, "repairs"), _EXPORT_RULES)
    lines = layers.read_silver(spark, silver)
    return lines.select("row_id", "order_id", "product_name", "quantity", "order_date", F.col("sales").cast("double").alias("sales"))


@query(
    "outliers_iqr",
    f"""{LINES}, f as (select sub_category, round(quantile_cont(cast(profit as double), 0.25), 6) as q1,
    round(quantile_cont(cast(profit as double), 0.75), 6) as q3 from lines group by sub_category)
    select sub_category, order_id, line_no, product_id, supplier_id, ship_date, cast(list_price as double) as list_price,
    cast(profit as double) as profit, q1, q3 from lines join f using (sub_category)
    where cast(profit as double) < q1 - 1.5 * (q3 - q1) or cast(profit as double) > q3 + 1.5 * (q3 - q1)""",
)
def outliers_iqr(spark, folder):
    lines = order_lines(spark, folder, "sub_category", "profit", *LINE_KEY)
    return as_doubles(quality.outliers(lines, "sub_category", "profit"), "list_price", "profit")


@query(
    "quartiles_by_category",
    f"""{LINES} select category, round(quantile_cont(cast(sales as double), 0.25), 6) as q1,
    round(quantile_cont(cast(sales as double), 0.75), 6) as q3 from lines group by category""",
)
def quartiles_by_category(spark, folder):
    points = quality.quartiles(order_lines(spark, folder, "category", "sales"), "category", "sales")
    return points.select("category", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"))


@query(
    "null_profile",
    f"{LINES} "
    + " union all ".join(
        f"select '{c}' as column_name, count(*) filter ({c} is null) as null_count from lines" for c in LINE_COLUMNS
    ),
)
def null_profile(spark, folder):
    return quality.null_profile(order_lines(spark, folder))


@query(
    "numeric_profile",
    f"{LINES} "
    + " union all ".join(
        f"""select '{c}' as column_name, count({c}) as n, round(avg(cast({c} as double)), 4) as mean,
        round(stddev_samp(cast({c} as double)), 4) as stddev, cast(min({c}) as double) as min,
        cast(max({c}) as double) as max from lines"""
        for c in NUMBERS
    ),
)
def numeric_profile(spark, folder):
    profile = quality.numeric_profile(order_lines(spark, folder, *NUMBERS), NUMBERS)
    return profile.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


_TEXTS = [c for c in LINE_COLUMNS if c not in NUMBERS]  # the dates too, as text


@query(
    "text_profile",
    f"{LINES} "
    + " union all ".join(
        f"""select '{c}' as column_name, count({c}) as n, cast(min({c}) as varchar) as min, cast(max({c}) as varchar) as max
        from lines"""
        for c in _TEXTS
    ),
)
def text_profile(spark, folder):
    lines = order_lines(spark, folder, *_TEXTS)
    return quality.text_profile(lines.select(*[F.col(c).cast("string").alias(c) for c in _TEXTS]), _TEXTS)


@query("table_shape", f"{LINES} select count(*) as row_count, {len(LINE_COLUMNS)} as column_count from lines")
def table_shape(spark, folder):
    lines = order_lines(spark, folder)
    return lines.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(lines.columns)).alias("column_count"))


@query(
    "duplicate_rows",
    f"""{LINES}, g as (select count(*) as n from lines group by {', '.join(LINE_COLUMNS)} having count(*) > 1)
    select cast(coalesce(sum(n - 1), 0) as bigint) as total_duplicates from g""",
)
def duplicate_rows(spark, folder):
    return quality.surplus_duplicates(order_lines(spark, folder))


@query(
    "duplicate_line_numbers",
    """with g as (select count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
    select cast(coalesce(sum(n - 1), 0) as bigint) as total_duplicates from g""",
)
def duplicate_line_numbers(spark, folder):
    return quality.surplus_duplicates(order_lines(spark, folder, "order_id", "line_no"))


@query(
    "repeated_line_keys",
    """select l_orderkey as order_id, l_linenumber as line_no, count(*) as frequency from lineitem
    group by 1, 2 having count(*) > 1""",
)
def repeated_line_keys(spark, folder):
    return quality.repeated_keys(order_lines(spark, folder, "order_id", "line_no"), "order_id", "line_no")


# Key constraints of the source tables: table, key columns.
_KEYS = [
    ("region", ["r_regionkey"]),
    ("nation", ["n_nationkey"]),
    ("nation", ["n_name"]),
    ("customer", ["c_custkey"]),
    ("part", ["p_partkey"]),
    ("part", ["p_name"]),
    ("orders", ["o_orderkey"]),
    ("lineitem", ["l_orderkey", "l_linenumber"]),
]


@query(
    "dq_pk",
    " union all ".join(
        f"""select '{t}({", ".join(k)})' as constraint_name, cast(coalesce(sum(n), 0) as bigint) as row_count,
        count(*) as key_count, count(*) filter (n > 1) as repeated_keys
        from (select count(*) as n from {t} group by {", ".join(k)})"""
        for t, k in _KEYS
    ),
)
def dq_pk(spark, folder):
    result = None
    for name, key in _KEYS:
        checked = quality.uniqueness(table(spark, folder, name).select(*key), f"{name}({', '.join(key)})", *key)
        result = checked if result is None else result.unionByName(checked)
    return result


# Reference constraints: child table, column, parent table, column.
_REFERENCES = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("labels", "doc_id", "orders", "o_orderkey"),
]


@query(
    "dq_fk",
    " union all ".join(
        f"""select '{c}.{k} -> {p}.{q}' as constraint_name, count(*) as orphan_rows, count(distinct {k}) as orphan_keys
        from {c} where {k} is not null and {k} not in (select {q} from {p})"""
        for c, k, p, q in _REFERENCES
    ),
)
def dq_fk(spark, folder):
    """The last pair is no true reference: it shows that orphans are found."""
    result = None
    for child, key, parent, target in _REFERENCES:
        checked = quality.orphans(
            table(spark, folder, child).select(key), key, table(spark, folder, parent), target,
            f"{child}.{key} -> {parent}.{target}",
        )
        result = checked if result is None else result.unionByName(checked)
    return result


@query(
    "order_date_range",
    f"{LINES} select min(order_date) as first_order_date, max(order_date) as last_order_date from lines",
)
def order_date_range(spark, folder):
    return order_lines(spark, folder, "order_date").agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")
    )


_COUNTED = ["country", "city", "customer_id", "product_id", "order_id", "order_date"]


@query(
    "distinct_counts",
    f"{LINES} select {', '.join(f'count(distinct {c}) as {c}_count' for c in _COUNTED)} from lines",
)
def distinct_counts(spark, folder):
    """Each column is counted from the tables behind it alone, so no line is multiplied by the number of columns."""
    counts = [order_lines(spark, folder, c).agg(F.count_distinct(c).alias(f"{c}_count")) for c in _COUNTED]
    others = [c.scalar().alias(c.columns[0]) for c in counts[1:]]
    return counts[0].select("*", *others)


@query("distinct_priorities", f"{LINES} select distinct order_priority from lines")
def distinct_priorities(spark, folder):
    return order_lines(spark, folder, "order_priority").distinct()


# --- profiles that can be merged ---

_SKETCHED = ["customer_id", "product_id", "order_id", "city"]
_RANKED = ["sales", "profit"]
_POINTS = [0.05, 0.25, 0.5, 0.75, 0.95]
_SPANS = {"all": "true", "1995": "month >= date '1995-01-01' and month < date '1996-01-01'"}
_SPAN_SQL = {"all": "true", "1995": "order_date >= date '1995-01-01' and order_date < date '1996-01-01'"}


def _stored_sketches(spark, folder, columns):
    # written once: beside the sketches, exact counts of each span and column pass over the lines
    lines = written(order_lines(spark, folder, "order_date", *columns, *_RANKED), "profiled-lines")
    return lines, written(profiles.monthly_sketches(lines, columns, _RANKED), "sketches")


@query(
    "profile_distinct_sketches",
    f"{LINES} "
    + " union all ".join(
        f"select '{span}' as months, '{c}' as column_name, count(distinct {c}) as exact_count, true as within_bound from lines where {where}"
        for span, where in _SPAN_SQL.items()
        for c in _SKETCHED
    ),
)
def profile_distinct_sketches(spark, folder):
    """Distinct values from stored states of the months, and whether they lie within three standard errors of the exact numbers."""
    lines, stored = _stored_sketches(spark, folder, _SKETCHED)
    out = None
    for span, where in _SPANS.items():
        guess = profiles.distinct_estimates(profiles.merged(stored.filter(where)), _SKETCHED)
        exact = lines.filter(_SPAN_SQL[span]).agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED])
        each = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("exact_count")) for c in _SKETCHED])))
        near = F.abs(F.col("estimate") - F.col("exact_count")) <= 3 * 1.04 / 2 ** (profiles.LG_K / 2) * F.col("exact_count") + 1
        rows = each.join(guess, "column_name").select(F.lit(span).alias("months"), "column_name", "exact_count", near.alias("within_bound"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "profile_quantile_sketches",
    f"{LINES} "
    + " union all ".join(
        f"""select '{span}' as months, '{c}' as column_name, cast({q} as double) as quantile, count({c}) as row_count,
        true as within_bound from lines where {where}"""
        for span, where in _SPAN_SQL.items()
        for c in _RANKED
        for q in _POINTS
    ),
)
def profile_quantile_sketches(spark, folder):
    """Quantiles from stored states of the months, and whether their true ranks are as far off as promised at most."""
    lines, stored = _stored_sketches(spark, folder, [])
    out = None
    for span, where in _SPANS.items():
        guess = written(profiles.quantile_estimates(profiles.merged(stored.filter(where)), _RANKED, _POINTS), "quantiles")
        some = lines.filter(_SPAN_SQL[span])
        for c in _RANKED:
            # one row per asked quantile
            asked = {r["quantile"]: r["estimate"] for r in guess.filter(F.col("column_name") == c).collect()}
            value = F.col(c).cast("double")
            counts = [F.struct(F.count_if(value < asked[q]).alias("below"), F.count_if(value <= asked[q]).alias("upto")).alias(f"q{i}") for i, q in enumerate(_POINTS)]
            ranks = some.agg(F.count(c).alias("n"), *counts)
            cells = [
                F.struct(
                    F.lit(q).alias("quantile"),
                    ((F.col(f"q{i}.below") <= (q + 0.01) * F.col("n") + 1) & (F.col(f"q{i}.upto") >= (q - 0.01) * F.col("n") - 1)).alias("within_bound"),
                )
                for i, q in enumerate(_POINTS)
            ]
            rows = ranks.select(F.lit(span).alias("months"), F.lit(c).alias("column_name"), F.col("n").alias("row_count"), F.inline(F.array(*cells)))
            out = rows if out is None else out.unionByName(rows)
    return out
