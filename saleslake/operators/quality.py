"""Profiles, duplicate counts, key and reference checks, exact quartiles and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslake.sources.shared import written

_ACCURACY = 10_000  # of quantile sketches


def _unpivoted(one_row: DataFrame, columns: list[str], fields: list[str]) -> DataFrame:
    """One row with columns <name>__<field> to one row per name."""
    structs = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}__{f}`").alias(f) for f in fields]) for c in columns
    ]
    return one_row.select(F.inline(F.array(*structs)))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, in one pass."""
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}__null_count") for c in df.columns]
    return _unpivoted(df.agg(*counts), df.columns, ["null_count"])


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum of numeric columns, in one pass."""
    stats = []
    for c in columns:
        value = F.col(c).cast("double")
        stats += [
            F.count(c).alias(f"{c}__n"),
            F.avg(value).alias(f"{c}__mean"),
            F.stddev_samp(value).alias(f"{c}__stddev"),
            F.min(value).alias(f"{c}__min"),
            F.max(value).alias(f"{c}__max"),
        ]
    return _unpivoted(df.agg(*stats), columns, ["n", "mean", "stddev", "min", "max"])


def text_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, minimum and maximum of text columns."""
    stats = []
    for c in columns:
        stats += [F.count(c).alias(f"{c}__n"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    return _unpivoted(df.agg(*stats), columns, ["n", "min", "max"])


def surplus_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows: the sum of (count - 1), 0 if there are none.

    Only 64-bit hashes of the rows are shuffled first. Whole rows are compared where a hash repeats; these hashes are
    written, so that the planner knows how few they are and leaves all other rows where they are. Where none repeats, no two rows are
    equal, and the rows aren't read a second time.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashes = df.select(F.xxhash64(*columns).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    repeated = written(hashes.filter("n > 1").select("_hash"), "repeated-hashes")
    if repeated.isEmpty():
        return repeated.agg(F.count(F.lit(1)).alias("total_duplicates"))
    return (
        df.withColumn("_hash", F.xxhash64(*columns))
        .join(repeated, "_hash", "left_semi")
        .groupBy(*columns)
        .count()
        .filter("count > 1")
        .selectExpr("coalesce(sum(count - 1), 0) as total_duplicates")
    )


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their frequency."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("frequency")).filter("frequency > 1")


def uniqueness(df: DataFrame, constraint: str, *key: str) -> DataFrame:
    """One row: rows, distinct keys, and keys that occur more than once."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count(F.lit(1)).alias("key_count"),
            F.count_if(F.col("n") > 1).alias("repeated_keys"),
        )
        .select(F.lit(constraint).alias("constraint_name"), "*")
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, constraint: str) -> DataFrame:
    """One row: child rows whose non-null key has no parent.

    Children are counted by key before the shuffle, and meet the parents in one aggregate over both: each key crosses the shuffle once per
    task, and no table of keys is sent to the driver or to every executor, however small its file is.
    """
    children = child.filter(F.col(child_key).isNotNull()).select(F.col(child_key).alias("k"), F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("known"))
    parents = parent.filter(F.col(parent_key).isNotNull()).select(F.col(parent_key).alias("k"), F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("known"))
    met = children.union(parents).groupBy("k").agg(F.sum("n").alias("n"), F.bool_or("known").alias("known"))
    return met.filter(~F.col("known")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys")
    ).select(F.lit(constraint).alias("constraint_name"), "*")


def _brackets(values: DataFrame, points: dict[str, float], reach: int) -> DataFrame:
    """Per group `n` and for each point the bounds `<point>_from` and `<point>_to`, from one mergeable sketch of its values.

    A sketch's answer is at most n / `_ACCURACY` ranks off, so bounds asked for `reach` times that to either side hold the point.
    """
    width = reach / _ACCURACY
    asked = [min(1.0, max(0.0, q + side * width)) for q in points.values() for side in (-1, 1)]
    found = values.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", asked, _ACCURACY).alias("b"))
    bounds = [F.get("b", 2 * i + k).alias(f"{p}_{end}") for i, p in enumerate(points) for k, end in enumerate(("from", "to"))]
    return found.select("g", "n", *bounds)


def quantiles(df: DataFrame, group: str, value: str, points: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles of `value` per group, as doubles named by `points`; groups without a value are left out.

    No row is sorted or moved but a few: a first pass sketches each group, which brackets every point, and a second one counts the rows below
    a bracket and the values in it. Those values, each once with its number, are all that is ordered. Brackets that fail
    to hold their point, which the counts tell, are made wider.
    """
    values = written(df.filter(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).alias("v")), "quantile-values")
    done, reach = None, 2
    rest = values
    while True:
        wide = reach > _ACCURACY
        brackets = written(_brackets(rest, points, reach), "quantile-brackets")
        each = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"), F.col(f"{p}_from").alias("from"), F.col(f"{p}_to").alias("to")) for p, q in points.items()])
        placed = rest.join(brackets.withColumnRenamed("g", "bg"), F.col("g").eqNullSafe(F.col("bg"))).drop("bg")
        placed = placed.select("g", "n", "v", F.inline(each))
        inside = F.lit(True) if wide else F.col("v").between(F.col("from"), F.col("to"))
        # below the bracket a count is enough
        counted = placed.filter((F.col("v") <= F.col("to")) | F.lit(wide)).groupBy("g", "n", "p", "q", F.when(inside, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("k"))
        in_order = Window.partitionBy("g", "p").orderBy(F.asc_nulls_first("v"))
        steps = counted.withColumn("upto", F.sum("k").over(in_order)).withColumn("before", F.col("upto") - F.col("k")).filter("v is not null")
        at = F.col("q") * (F.col("n") - 1)
        low, high = F.floor(at), F.ceil(at)
        holds = lambda place: (F.col("before") <= place) & (place < F.col("upto"))
        found = steps.groupBy("g", "p").agg(
            F.max(F.when(holds(low), F.col("v").cast("double"))).alias("low"), F.max(F.when(holds(high), F.col("v").cast("double"))).alias("high"),
            F.max(at - low).alias("part"),
        )
        found = written(found, "quantile-points")
        missing = found.filter("low is null or high is null").select("g").distinct()
        whole = found.join(missing.withColumnRenamed("g", "mg"), F.col("g").eqNullSafe(F.col("mg")), "left_anti")
        done = whole if done is None else done.union(whole)
        missing = written(missing, "quantile-missing")
        if not missing.limit(1).count():
            break
        rest = rest.join(missing.withColumnRenamed("g", "mg"), F.col("g").eqNullSafe(F.col("mg")), "left_semi")
        reach *= 100
    value_of = F.col("low") + F.col("part") * (F.col("high") - F.col("low"))
    return done.groupBy(F.col("g").alias(group)).agg(*[F.max(F.when(F.col("p") == p, value_of)).alias(p) for p in points])


def quartiles(df: DataFrame, group: str, value: str, tie: list[str] | None = None) -> DataFrame:
    """The 25 % and 75 % points of `value` per group, see `quantiles`. Equal values need no order among them, so `tie` has no effect."""
    return quantiles(df, group, value, {"q1": 0.25, "q3": 0.75})


def outliers(df: DataFrame, group: str, value: str, tie: list[str] | None = None, reach: float = 1.5, digits: int = 6) -> DataFrame:
    """Rows outside [q1 - reach * iqr, q3 + reach * iqr] of their group, with the quartiles."""
    fences = quartiles(df, group, value).select(
        group, F.round("q1", digits).alias("q1"), F.round("q3", digits).alias("q3")
    )
    fences = written(fences, "fences")
    width = F.col("q3") - F.col("q1")
    number = F.col(value).cast("double")
    outside = (number < F.col("q1") - F.lit(reach) * width) | (number > F.col("q3") + F.lit(reach) * width)
    return df.join(fences, group).filter(outside)
