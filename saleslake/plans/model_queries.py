"""Features, splits, models and their scores."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from saleslake.functions.measures import log_target, log_target_inverse
from saleslake.operators import explore, features, models
from saleslake.operators.boosting import Boosted, BoostedMedian, library_boosting
from saleslake.plans.registry import LINES, query
from saleslake.sources.order_lines import LINE_KEY, order_lines
from saleslake.sources.shared import written

_FEATURE_COLUMNS = ["sales", "profit", "quantity", "discount", "order_date", *features.CATEGORIES]
_KEY_TEXT = "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '')" for c in LINE_KEY) + ")"
_TRAIN = f"(cast('0x' || substr(md5({_KEY_TEXT}), 1, 8) as bigint) % 100 < 80)"


def _features(spark, folder):
    lines = order_lines(spark, folder, *dict.fromkeys([*_FEATURE_COLUMNS, *LINE_KEY]))
    return features.base_table(lines, extra=LINE_KEY)


@query(
    "features_base",
    f"""{LINES} select cast(sales as double) as sales, cast(profit as double) as profit, cast(quantity as double) as quantity,
    cast(discount as double) as discount, cast(ship_date - order_date as double) as shipment_days,
    {', '.join(features.CATEGORIES)} from lines""",
)
def features_base(spark, folder):
    return features.base_table(order_lines(spark, folder, *_FEATURE_COLUMNS, "ship_date"))


@query(
    "feat_string_index",
    f"{LINES}, "
    + ", ".join(
        f"""i_{c} as (select {c}, cast(row_number() over (order by count(*) desc, {c}) - 1 as double) as {c}_idx
        from lines group by {c})"""
        for c in features.CATEGORIES
    )
    + f" select {', '.join(f'{c}, {c}_idx' for c in features.CATEGORIES)}, count(*) as line_count from lines "
    + " ".join(f"join i_{c} using ({c})" for c in features.CATEGORIES)
    + " group by all",
)
def feat_string_index(spark, folder):
    lines = order_lines(spark, folder, *features.CATEGORIES)
    indexed = features.string_indexer().fit(lines).transform(lines)
    return explore.line_counts(indexed, *[n for c in features.CATEGORIES for n in (c, f"{c}_idx")])


@query(
    "train_test_split",
    f"""{LINES} select case when {_TRAIN} then 'train' else 'test' end as part, count(*) as line_count,
    cast(sum(sales) as double) as total_sales from lines group by 1""",
)
def train_test_split(spark, folder):
    lines = order_lines(spark, folder, *LINE_KEY, "sales")
    part = F.when(features.is_train(LINE_KEY), "train").otherwise("test").alias("part")
    return lines.groupBy(part).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("sales").cast("double").alias("total_sales")
    )


@query(
    "log_sales",
    f"""{LINES} select order_id, line_no, product_id, cast(list_price as double) as list_price,
    round(ln(cast(sales as double) + 1), 6) as log_sales,
    round(exp(ln(cast(sales as double) + 1)) - 1, 4) as sales_again from lines""",
)
def log_sales(spark, folder):
    lines = order_lines(spark, folder, "order_id", "line_no", "product_id", "list_price", "sales")
    logged = lines.withColumn("l", log_target("sales"))
    return logged.select(
        "order_id", "line_no", "product_id", F.col("list_price").cast("double").alias("list_price"),
        F.round("l", 6).alias("log_sales"), F.round(log_target_inverse("l"), 4).alias("sales_again"),
    )


@query(
    "feat_rfm",
    f"""{LINES}, c as (select customer_id, cast((select max(order_date) from lines) - max(order_date) as integer)
    as recency_days, count(distinct order_id) as frequency, sum(sales) as m from lines group by customer_id),
    s as (select customer_id, recency_days, frequency, cast(m as double) as money,
    cast(ntile(5) over (order by recency_days desc, customer_id) as integer) as recency_score,
    cast(ntile(5) over (order by frequency, customer_id) as integer) as frequency_score,
    cast(ntile(5) over (order by m, customer_id) as integer) as money_score from c)
    select *, recency_score + frequency_score + money_score as rfm_score from s""",
)
def feat_rfm(spark, folder):
    return features.rfm(order_lines(spark, folder, "customer_id", "order_id", "order_date", "sales"))


# Fixed values: (month, day) of the holidays used in the queries; callers bring their own calendar.
HOLIDAYS = [(1, 1), (5, 1), (12, 25), (12, 26)]


@query(
    "feat_holiday",
    f"""{LINES} select order_date, (month(order_date), day(order_date)) in ({', '.join(map(str, HOLIDAYS))}) as is_holiday,
    count(*) as line_count from lines group by order_date""",
)
def feat_holiday(spark, folder):
    days = explore.line_counts(order_lines(spark, folder, "order_date"), "order_date")
    return features.with_holiday(days, features.yearly_holidays(days, "order_date", HOLIDAYS))


# Holidays that move with Easter or with the weekdays, beside fixed ones; callers bring their own.
HOLIDAY_RULES = {
    "New Year": ("fixed", 1, 1),
    "Good Friday": ("easter", -2),
    "Easter Monday": ("easter", 1),
    "Last Monday of May": ("nth", 5, 2, -1),
    "First Monday of September": ("nth", 9, 2, 1),
    "Fourth Thursday of November": ("nth", 11, 5, 4),
    "Christmas": ("fixed", 12, 25),
}


def _rule_sql(kind: str, *of: int) -> str:
    if kind == "fixed":
        return f"make_date(y, {of[0]}, {of[1]})"
    if kind == "easter":
        return f"easter + {of[0]}"
    month, weekday, n = of  # Sunday is 0 there
    first = f"make_date(y, {month}, 1)"
    if n > 0:
        return f"{first} + cast(({weekday - 1} - dayofweek({first}) + 7) % 7 + {7 * (n - 1)} as integer)"
    return f"last_day({first}) - cast((dayofweek(last_day({first})) - {weekday - 1} + 7) % 7 + {7 * (-n - 1)} as integer)"


@query(
    "feat_holiday_moving",
    f"""{LINES}, days as (select order_date, count(*) as line_count from lines group by order_date),
    years as (select distinct unnest([year(order_date) - 1, year(order_date), year(order_date) + 1]) as y from days where order_date is not null),
    moon as (select y, y % 19 as a, y // 100 as b, y % 100 as c,
        (19 * (y % 19) + y // 100 - (y // 100) // 4 - (y // 100 - (y // 100 + 8) // 25 + 1) // 3 + 15) % 30 as h from years),
    week as (select *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 as l from moon),
    sunday as (select *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 as n from week),
    easters as (select y, make_date(y, n // 31, n % 31 + 1) as easter from sunday),
    holidays as (select distinct cast(unnest([{', '.join(_rule_sql(*rule) for rule in HOLIDAY_RULES.values())}]) as date) as holiday from easters)
    select order_date, line_count, order_date in (select holiday from holidays) as is_holiday,
    cast(order_date - (select max(holiday) from holidays where holiday <= order_date) as integer) as days_since_holiday,
    cast((select min(holiday) from holidays where holiday >= order_date) - order_date as integer) as days_to_holiday from days""",
)
def feat_holiday_moving(spark, folder):
    """Days of orders with the distance to the holidays around them."""
    days = explore.line_counts(order_lines(spark, folder, "order_date"), "order_date")
    return features.with_holiday_distance(days, features.holidays_of_rules(days, "order_date", HOLIDAY_RULES))


_INDEXED = f"{LINES}, " + ", ".join(
    f"""i_{c} as (select {c}, cast(row_number() over (order by count(*) desc, {c}) - 1 as double) as {c}_idx
    from lines group by {c})"""
    for c in features.CATEGORIES
)
_INPUTS = [*[c for c in features.NUMERIC if c != "sales"], *[f"{c}_idx" for c in features.CATEGORIES]]


@query(
    "ml_feature_vectors",
    f"""{_INDEXED} select order_id, line_no, cast(sales as double) as sales, cast(profit as double) as profit,
    cast(quantity as double) as quantity, cast(discount as double) as discount, cast(ship_date - order_date as double)
    as shipment_days, {', '.join(f'{c}_idx' for c in features.CATEGORIES)} from lines """
    + " ".join(f"join i_{c} using ({c})" for c in features.CATEGORIES),
)
def ml_feature_vectors(spark, folder):
    """The fitted stages applied to all lines: the ten inputs, taken from the vector."""
    base = _features(spark, folder)
    vectors = features.vector_pipeline().fit(base).transform(base).withColumn("v", vector_to_array("features"))
    return vectors.select("order_id", "line_no", "sales", *[F.get("v", i).alias(name) for i, name in enumerate(_INPUTS)])


def _model_query(name: str, make) -> None:
    @query(name)
    def run(spark, folder):
        train, test = models.vectors(_features(spark, folder), LINE_KEY)
        result = written(models.score(models.fitted(make(), train).transform(test), name), name)
        train.unpersist()
        test.unpersist()
        return result


_model_query("ml_rf", models.random_forest)
_model_query("ml_linear", models.linear)
_model_query("ml_tree", models.tree)

_CODED = [*[c for c in features.NUMERIC if c != "sales"], *[f"{c}_idx" for c in features.CATEGORIES]]


def _coded(base):
    """Train and test lines with their categories as codes by falling frequency, and the number of codes of each."""
    table = written(base.withColumn("_train", features.is_train(LINE_KEY)), "features", "zstd")
    train, test = table.filter("_train"), table.filter("not _train")
    coder = features.string_indexer().fit(train)
    coded = [coder.transform(part).select("sales", *_CODED) for part in (train, test)]
    return *coded, {f"{c}_idx": len(labels) for c, labels in zip(features.CATEGORIES, coder.labelsArray, strict=True)}


def _boosting_score(base, name: str, make):
    train, test, categories = _coded(base)
    model = make(_CODED, categories=categories, label="sales").fit(train)
    return models.score(model.transform(test).withColumnRenamed("sales", "label"), name)


def _library_query(name: str, make, **settings) -> None:
    @query(name)
    def run(spark, folder):
        return written(_boosting_score(_features(spark, folder), name, lambda *a, **k: make(*a, **k, **settings)), name)


# depth and rate of the library; then 100 rounds of depth 6, and of the library's depth
_library_query("ml_gbt", library_boosting)
_library_query("ml_gbt_deep", library_boosting, rounds=100, depth=6)
_library_query("ml_gbt_plain", library_boosting, rounds=100, depth=5)
_library_query("ml_adaboost", BoostedMedian)


@query("ml_rf_log")
def ml_rf_log(spark, folder):
    train, test = models.vectors(_features(spark, folder), LINE_KEY)
    result = written(models.score(models.fit_log_target(models.random_forest(), train, test), "ml_rf_log"), "ml_rf_log")
    train.unpersist()
    test.unpersist()
    return result


@query(
    "ml_linear_one_feature",
    f"""{LINES} select round(regr_slope(cast(sales as double), cast(profit as double)), 6) as slope,
    round(regr_intercept(cast(sales as double), cast(profit as double)), 4) as intercept from lines""",
)
def ml_linear_one_feature(spark, folder):
    """One input: the fit must equal the closed form."""
    base = order_lines(spark, folder, "sales", "profit").select(
        F.col("sales").cast("double").alias("label"), F.col("profit").cast("double").alias("profit")
    )
    model = models.linear().fit(models.VectorAssembler(inputCols=["profit"], outputCol="features").transform(base))
    return base.agg(
        F.round(F.lit(float(model.coefficients[0])), 6).alias("slope"),
        F.round(F.lit(float(model.intercept)), 4).alias("intercept"),
    )


_STUMPS = ["tree", "forest of one tree", "one round of boosting"]


@query(
    "ml_stump",
    f"""{LINES}, g as (select cast(discount as double) as discount, count(*) as n, cast(sum(sales) as double) as s
        from lines group by 1),
    cuts as (select l.discount as cut, sum(r.n) filter (r.discount <= l.discount) as nl,
        sum(r.s) filter (r.discount <= l.discount) as sl, sum(r.n) filter (r.discount > l.discount) as nr,
        sum(r.s) filter (r.discount > l.discount) as sr from g l cross join g r group by 1 having nr > 0),
    best as (select * from cuts order by sl * sl / nl + sr * sr / nr desc limit 1)
    select model, discount, round(case when discount <= cut then sl / nl else sr / nr end, 4) as prediction
    from g cross join best cross join (select unnest({_STUMPS}) as model)""",
)
def ml_stump(spark, folder):
    """Trees of depth one on one input: all of them have to find the split of least variance."""
    base = order_lines(spark, folder, "sales", "discount").select(
        F.col("sales").cast("double").alias("label"), F.col("discount").cast("double").alias("discount")
    )
    frame = written(models.VectorAssembler(inputCols=["discount"], outputCol="features").transform(base), "stump")
    values = frame.select("discount", "features").dropDuplicates(["discount"])
    alike = {
        "tree": models.tree(maxDepth=1),
        "forest of one tree": models.random_forest(maxDepth=1, numTrees=1, bootstrap=False, featureSubsetStrategy="all"),
        "one round of boosting": models.gradient_boosting(maxDepth=1, maxIter=1),
    }
    out = None
    for name in _STUMPS:
        predicted = alike[name].fit(frame).transform(values)
        rows = predicted.select(F.lit(name).alias("model"), "discount", F.round("prediction", 4).alias("prediction"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "ml_linear_two_features",
    f"""{LINES}, d as (select cast(sales as double) as y, cast(profit as double) as a, cast(quantity as double) as b from lines),
    c as (select covar_pop(a, a) as aa, covar_pop(b, b) as bb, covar_pop(a, b) as ab, covar_pop(a, y) as ay,
        covar_pop(b, y) as yb, avg(a) as ma, avg(b) as mb, avg(y) as my from d),
    w as (select (ay * bb - yb * ab) / (aa * bb - ab * ab) as wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) as wb, * from c)
    select round(wa, 6) as profit_weight, round(wb, 4) as quantity_weight, round(my - wa * ma - wb * mb, 2) as intercept from w""",
)
def ml_linear_two_features(spark, folder):
    """Two inputs: the fit must equal the normal equations."""
    base = order_lines(spark, folder, "sales", "profit", "quantity").select(
        F.col("sales").cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in ("profit", "quantity")]
    )
    model = models.linear().fit(models.VectorAssembler(inputCols=["profit", "quantity"], outputCol="features").transform(base))
    profit, quantity = map(float, model.coefficients)
    return base.agg(
        F.round(F.lit(profit), 6).alias("profit_weight"),
        F.round(F.lit(quantity), 4).alias("quantity_weight"),
        F.round(F.lit(float(model.intercept)), 2).alias("intercept"),
    )


# --- trees of depth one by SQL: with weights, on logarithms, over folds ---


def _stump_frame(spark, folder, *more):
    base = order_lines(spark, folder, "sales", "discount", *more).select(
        *more, F.col("sales").cast("double").alias("label"), F.col("discount").cast("double").alias("discount")
    )
    return models.VectorAssembler(inputCols=["discount"], outputCol="features").transform(base)


def _stump_sql(name: str, rows: str, by: str = "") -> str:
    """CTEs of the split of least weighted variance of `rows` (discount, label, w) per group; `name` has (discount, prediction)."""
    keys, using = (f"{by}, ", f"l.{by} = r.{by} and ") if by else ("", "")
    part = f"partition by {by} " if by else ""
    return f"""{name}_groups as (select {keys}discount, sum(w) as w, sum(w * label) as s from {rows} group by {keys}discount),
    {name}_cuts as (select {f'l.{by}, ' if by else ''}l.discount as cut, sum(r.w) filter (r.discount <= l.discount) as wl,
        sum(r.s) filter (r.discount <= l.discount) as sl, sum(r.w) filter (r.discount > l.discount) as wr,
        sum(r.s) filter (r.discount > l.discount) as sr from {name}_groups l join {name}_groups r on {using}true group by all having wr > 0),
    {name}_best as (select * from {name}_cuts qualify row_number() over ({part}order by sl * sl / wl + sr * sr / wr desc) = 1),
    {name} as (select {f'g.{by}, ' if by else ''}g.discount, case when g.discount <= cut then sl / wl else sr / wr end as prediction
        from (select distinct {keys}discount from {name}_groups) g join {name}_best b on {f'g.{by} = b.{by}' if by else 'true'})"""


def _reweighted_sql(name: str, rows: str, stump: str) -> str:
    """The rows with the weights of the next round, and its confidence (Drucker's linear loss)."""
    return f"""{name}_missed as (select r.*, abs(label - prediction) as miss from {rows} r join {stump} using (discount)),
    {name}_round as (select *, loss / (1 - loss) as beta from (select max(miss) as largest, sum(w) as mass,
        sum(w * miss) / max(miss) / sum(w) as loss from {name}_missed)),
    {name} as (select discount, label, w / mass * pow(beta, 1 - miss / largest) as w from {name}_missed cross join {name}_round)"""


@query(
    "ml_adaboost_rounds",
    f"""{LINES}, start as (select cast(discount as double) as discount, cast(sales as double) as label, 1.0::double as w from lines),
    {_stump_sql('one', 'start')}, {_reweighted_sql('again', 'start', 'one')}, {_stump_sql('two', 'again')}, {_reweighted_sql('last', 'again', 'two')},
    pair as (select discount, a.prediction as p1, b.prediction as p2, ln(1 / r.beta) as a1, ln(1 / s.beta) as a2
        from one a join two b using (discount) cross join again_round r cross join last_round s)
    select discount, round(a1, 6) as first_confidence, round(a2, 6) as second_confidence, round(case
        when (case when p1 <= p2 then a1 else a2 end) >= (a1 + a2) / 2 then least(p1, p2) else greatest(p1, p2) end, 4) as prediction from pair""",
)
def ml_adaboost_rounds(spark, folder):
    """Two rounds of weighted trees of depth one: confidences, and the weighted median of both."""
    frame = written(_stump_frame(spark, folder).drop("features"), "stump")
    model = BoostedMedian(["discount"], rounds=2, depth=1).fit(frame)
    first, second = (weight for _, weight in model.members)
    values = frame.select("discount").dropDuplicates(["discount"])
    return model.transform(values).select(
        "discount", F.round(F.lit(first), 6).alias("first_confidence"), F.round(F.lit(second), 6).alias("second_confidence"),
        F.round("prediction", 4).alias("prediction"),
    )


@query(
    "ml_log_stump",
    f"""{LINES}, start as (select cast(discount as double) as discount, ln(1 + cast(sales as double)) as label, 1.0::double as w from lines),
    {_stump_sql('one', 'start')} select discount, round(exp(prediction) - 1, 4) as prediction from one""",
)
def ml_log_stump(spark, folder):
    """A tree of depth one on the logarithm, its predictions on the scale of the sales."""
    frame = written(_stump_frame(spark, folder), "stump")
    values = frame.select("discount", "features", "label").dropDuplicates(["discount"])
    predicted = models.fit_log_target(models.tree(maxDepth=1), frame, values)
    return predicted.select("discount", F.round("prediction", 4).alias("prediction"))


_FOLDS = 3
_FOLD_SQL = f"cast('0x' || substr(md5({_KEY_TEXT}), 1, 8) as bigint) % {_FOLDS}"


@query(
    "ml_cv_folds",
    f"""{LINES}, marked as (select cast(discount as double) as discount, cast(sales as double) as label, {_FOLD_SQL} as own from lines),
    start as (select f.fold, discount, label, 1.0::double as w from marked cross join (select unnest(range({_FOLDS})) as fold) f where own <> fold),
    {_stump_sql('one', 'start', 'fold')}, means as (select fold, avg(label) as m from start group by fold),
    errors as (select own, sqrt(avg((label - m) * (label - m))) as e0, sqrt(avg((label - prediction) * (label - prediction))) as e1
        from marked join means on means.fold = own join one on one.fold = own and one.discount = marked.discount group by own)
    select cast(unnest([0, 1]) as integer) as depth, round(unnest([avg(e0), avg(e1)]), 3) as rmse from errors""",
)
def ml_cv_folds(spark, folder):
    """The search over folds, which here follow from a hash of the line: the mean, and a tree of depth one."""
    number = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LINE_KEY])), 1, 8), 16, 10)
    lines = order_lines(spark, folder, *dict.fromkeys([*LINE_KEY, "sales", "discount"]))
    base = lines.select(F.col("sales").cast("double").alias("label"), F.col("discount").cast("double").alias("discount"), (number.cast("bigint") % _FOLDS).cast("int").alias("fold"))
    frame = written(models.VectorAssembler(inputCols=["discount"], outputCol="features").transform(base), "folds")
    found = models.search_over_folds(models.tree(), frame, "fold", _FOLDS, {"maxDepth": [0, 1]})
    cells = [F.struct(F.lit(values["maxDepth"]).alias("depth"), F.lit(float(error)).alias("rmse")) for values, error in found]
    return frame.agg(F.count(F.lit(1))).select(F.inline(F.array(*cells))).withColumn("rmse", F.round("rmse", 3))


# --- second-order boosting ---

def _boosted_query(name: str, **settings) -> None:
    @query(name)
    def run(spark, folder):
        # categories as numbers, by falling frequency; the bins of many rare ones merge
        return written(_boosting_score(_features(spark, folder), name, lambda inputs, label, **_: Boosted(inputs, label=label, **settings)), name)


# the depth of `ml_gbt_deep`, and best leaf first with as many leaves as the library it stands for takes; a fifth of the rounds at three times the rate
_boosted_query("ml_boost_deep", rounds=20, depth=6, rate=0.3)
_boosted_query("ml_boost_leafwise", rounds=20, depth=12, leaves=31, rate=0.3)

# Values of these are cut points themselves, so that SQL has the same bins.
_EXACT = {"discount": [i / 100 for i in range(11)], "quantity": list(range(1, 51)), "line_no": list(range(1, 8))}
_L2, _RATE = 1.0, 0.3


def _split_sql(rows: str, name: str, only_best: bool) -> str:
    """CTEs that split every node of `rows` (node, g, x0, x1, x2) once, or only the node with the largest gain; end in `name`."""
    one = "where gain > 0 qualify row_number() over (partition by node order by gain desc, input, cut) = 1"
    pick = f"select * from {name}_best order by gain desc, node limit 1" if only_best else f"select * from {name}_best"
    return f"""{name}_hist as (select node, input, cut, sum(g) as g, count(*) as n from
        (select node, unnest([0, 1, 2]) as input, unnest([x0, x1, x2]) as cut, g from {rows}) group by node, input, cut),
    {name}_cuts as (select node, input, cut, sum(g) over w as gl, sum(n) over w as nl, sum(g) over (partition by node, input) as gt,
        sum(n) over (partition by node, input) as nt from {name}_hist window w as (partition by node, input order by cut)),
    {name}_best as (select * from (select node, input, cut, gl * gl / (nl + {_L2}::double) + (gt - gl) * (gt - gl) / (nt - nl + {_L2}::double)
        - gt * gt / (nt + {_L2}::double) as gain from {name}_cuts where nl < nt) {one}),
    {name}_pick as ({pick}),
    {name} as (select r.* replace (case when p.node is null then r.node else 2 * r.node + cast(
        (case input when 0 then x0 when 1 then x1 else x2 end) > cut as integer) end as node)
        from {rows} r left join {name}_pick p on p.node = r.node)"""


def _tree_sql(rows: str, name: str, splits: int, only_best: bool) -> str:
    """CTEs of one tree over `rows` (y, score, x0, x1, x2); end in `name`, the rows with the score after the tree."""
    parts = [f"{name}_0 as (select *, 1 as node, score - y as g from {rows})"]
    parts += [_split_sql(f"{name}_{k}", f"{name}_{k + 1}", only_best) for k in range(splits)]
    value = f"-{_RATE}::double * sum(g) / (count(*) + {_L2}::double)"
    parts.append(f"{name}_leaf as (select node, {value} as v from {name}_{splits} group by node)")
    parts.append(f"{name} as (select y, score + v as score, x0, x1, x2 from {name}_{splits} join {name}_leaf using (node))")
    return ", ".join(parts)


_EXACT_ROWS = f"""{LINES}, d as (select cast(sales as double) as y, cast(discount as double) as x0, cast(quantity as double) as x1,
    cast(line_no as double) as x2 from lines),
    start as (select y, (select avg(y) from d) as score, x0, x1, x2 from d)"""
_EXACT_RESULT = """select x0 as discount, x1 as quantity, x2 as line_no, count(*) as line_count, round(avg(score), 4) as prediction
    from {} group by all"""


def _exact_query(name: str, sql: str, **settings) -> None:
    @query(name, f"{_EXACT_ROWS}, {sql}")
    def run(spark, folder):
        """Boosting whose trees SQL can grow as well, on three inputs with a bin for every value."""
        lines = order_lines(spark, folder, "sales", *_EXACT).select(*[F.col(c).cast("double").alias(c) for c in ("sales", *_EXACT)])
        model = Boosted(list(_EXACT), label="sales", rate=_RATE, l2=_L2, edges=_EXACT, **settings).fit(lines)
        groups = explore.line_counts(lines, *_EXACT)
        return model.transform(groups).withColumn("prediction", F.round("prediction", 4))


_exact_query(
    "ml_boost_two_rounds",
    f"{_tree_sql('start', 'one', 2, False)}, {_tree_sql('one', 'two', 2, False)} {_EXACT_RESULT.format('two')}",
    rounds=2, depth=2,
)
_exact_query(
    "ml_boost_four_leaves", f"{_tree_sql('start', 'one', 3, True)} {_EXACT_RESULT.format('one')}", rounds=1, depth=3, leaves=4,
)


_NUMERIC_PLANNED = [
    "order_month", "order_year", "quantity_n", "sales_lag_1", "sales_rolling_avg_3m", "is_holiday", "rfm_score",
]


@query("ml_cv_grid")
def ml_cv_grid(spark, folder):
    """Average error of each parameter pair over three folds, for forests on the planned features."""
    lines = order_lines(
        spark, folder, *LINE_KEY, "order_date", "customer_id", "category", "quantity", "sales"
    )
    planned = features.planned_features(
        lines, features.yearly_holidays(lines.select("order_date"), "order_date", HOLIDAYS)
    ).select(
        *LINE_KEY, "category", F.col("quantity").cast("double").alias("quantity_n"),
        *[c for c in _NUMERIC_PLANNED if c != "quantity_n"], log_target("sales").alias("log_sales"),
    )
    train, _ = features.split(written(planned, "planned"), LINE_KEY)
    cells = [
        F.struct(*[F.lit(v).alias(name) for name, v in sorted(params.items())], F.lit(float(error)).alias("rmse"))
        for params, error in models.grid_search(train, _NUMERIC_PLANNED, "category", "log_sales")
    ]
    return train.agg(F.count(F.lit(1)).alias("train_lines")).select("train_lines", F.inline(F.array(*cells)))


# The baseline predictions as oracle CTEs: mean of the training lines of a group.
_BASELINE = f"""{LINES}, marked as (select *, {_TRAIN} as in_train from lines),
    by_category as (select category, cast(sum(sales) as double) / count(sales) as p from marked where in_train group by 1),
    by_sub as (select sub_category, cast(sum(sales) as double) / count(sales) as p from marked where in_train group by 1),
    overall as (select cast(sum(sales) as double) / count(sales) as p from marked where in_train),
    test as (select m.*, cast(sales as double) as y, c.p as pc, s.p as ps, o.p as po from marked m
        join by_category c using (category) join by_sub s using (sub_category) cross join overall o where not in_train)"""


def _score_sql(name: str, p: str, digits: tuple[int, int, int]) -> str:
    return f"""select '{name}' as model, round(sqrt(avg((y - {p}) * (y - {p}))), {digits[0]}) as rmse,
    round(1.0::double - avg((y - {p}) * (y - {p})) / var_pop(y), {digits[1]}) as r2,
    round(avg(abs(y - {p}) / abs(y)) * 100.0::double, {digits[2]}) as mape from test"""


def _baseline(spark, folder, keys):
    lines = order_lines(spark, folder, *dict.fromkeys([*LINE_KEY, *keys, "sales"]))
    train, test = features.split(lines, LINE_KEY)
    return models.group_mean(train, test, keys, "sales")


@query(
    "prediction_errors",
    f"""{_BASELINE} select order_id, line_no, product_id, supplier_id, category, y as label, pc as prediction,
    abs(y - pc) as absolute_error, abs(y - pc) / y * 100.0::double as percentage_error from test""",
)
def prediction_errors(spark, folder):
    predicted = _baseline(spark, folder, ["category"])
    return models.errors(predicted, "label", "prediction").select(
        "order_id", "line_no", "product_id", "supplier_id", "category", "label", "prediction", "absolute_error",
        "percentage_error",
    )


@query("regression_metrics", f"{_BASELINE} {_score_sql('category mean', 'pc', (4, 8, 6))}")
def regression_metrics(spark, folder):
    scored = models.score(_baseline(spark, folder, ["category"]), "category mean")
    return scored.select(
        "model", F.round("rmse", 4).alias("rmse"), F.round("r2", 8).alias("r2"), F.round("mape", 6).alias("mape")
    )


_TWO = (2, 2, 2)


@query(
    "model_comparison",
    f"""{_BASELINE} {_score_sql('overall mean', 'po', _TWO)} union all {_score_sql('category mean', 'pc', _TWO)}
    union all {_score_sql('sub-category mean', 'ps', _TWO)}""",
)
def model_comparison(spark, folder):
    """All baselines from one written table: means of the training lines, then one pass over the test lines."""
    lines = order_lines(spark, folder, *dict.fromkeys([*LINE_KEY, "category", "sub_category", "sales"]))
    held = written(lines.select("category", "sub_category", "sales", features.is_train(LINE_KEY).alias("in_train")), "baselines")
    return models.compare(models.baseline_scores(held, "in_train", "sales", {
        "overall mean": [], "category mean": ["category"], "sub-category mean": ["sub_category"],
    }))


@query("ml_model_comparison")
def ml_model_comparison(spark, folder):
    """Forest, boosting, line and tree on the same split, as one rounded table."""
    base = written(_features(spark, folder), "features", "zstd")
    train, test = models.vectors(base, LINE_KEY)
    makers = {"random forest": models.random_forest, "linear": models.linear, "decision tree": models.tree}
    scores = [models.score(models.fitted(make(), train).transform(test), name) for name, make in makers.items()]
    # written while the frames are there; boosting works on its own table
    found = written(models.compare(scores), "comparison")
    train.unpersist()
    test.unpersist()
    return written(found.unionByName(models.compare([_boosting_score(base, "boosted trees", library_boosting)])), "comparison")
