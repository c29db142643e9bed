"""Dense numbering 1..n of a whole table in a given order, without gathering the table in one task.

The rows are range-partitioned on the complete order key and sorted within each partition, then written
once with their partition and position. The number of a row is its position plus the rows of all earlier
partitions. Because the range bounds are cut on the complete key, which is unique, a hot leading column is split
like any other; because the rows are written before they are counted, counts and rows cannot disagree.
"""

from __future__ import annotations

import sys

import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.sources.shared import written

# the function below travels inside the jobs, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_POSITION_BITS = 33  # layout of monotonically_increasing_id: partition above, position below


def numbered(df: DataFrame, order: list[str | Column], name: str, counts: str | None = None) -> DataFrame:
    """Add `name` = 1..n in `order`. The order columns must be unique together.

    With `counts`, a column of whole numbers, `before` is added too: the sum of that column over all earlier rows.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _POSITION_BITS).cast("int"))
        .withColumn("_at", F.col("_at").bitwiseAND((1 << _POSITION_BITS) - 1))
    )
    if counts:
        placed = placed.select("*", F.col(counts).cast("bigint").alias("_sum")).mapInArrow(_running, f"{_ddl(placed)}, _sum bigint")
    table = written(placed, f"numbered-{name}")
    # one row per range partition, so the window and the broadcast stay small whatever the table size
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"_before": F.count(F.lit(1)), **({"_sum_before": F.sum(counts)} if counts else {})}
    offsets = (
        table.groupBy("_part")
        .agg(*[total.alias(c) for c, total in sums.items()])
        .select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in sums])
    )
    out = table.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_at") + 1)
    if counts:
        out = out.withColumn("before", F.col("_sum_before") + F.col("_sum"))
    return out.drop("_part", "_at", "_before", "_sum", "_sum_before")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def _running(batches):
    """The column `_sum` as the sum over the earlier rows of the partition."""
    total = 0
    for batch in batches:
        if batch.num_rows:
            sums = pc.add(pc.cumulative_sum(batch["_sum"]), total)
            yield batch.set_column(batch.schema.get_field_index("_sum"), "_sum", pc.subtract(sums, batch["_sum"]))
            total = sums[-1].as_py()


BROADCAST_ROWS = 50_000


def beside(dim: DataFrame) -> DataFrame:
    """A written table as the right side of a join: merged if it has more than `BROADCAST_ROWS` rows.

    The planner goes by the size of the files. Dense keys take next to nothing there and fifty times that as a table in the driver, so
    tables of a million rows would still be broadcast.
    """
    return dim.hint("merge") if dim.count() > BROADCAST_ROWS else dim


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the first in `order`, which names all columns besides the key.

    Repeated rows go first, in a hash aggregate that is combined before the shuffle; only the few distinct ones meet
    the `min` over ordered columns, which Spark has to sort for. No window, so a hot key gathers nothing in one task.
    """
    distinct = df.select(key, *order).dropDuplicates()
    return distinct.groupBy(key).agg(F.min(F.struct(*order)).alias("_first")).select(key, "_first.*")
