"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Every row gets its number 0..n-1 in the order of a key. A keyed permutation of 0..n-1 maps that number to a position, and
the position gives shard and slot by division. So the shuffle is reproducible from (seed, n), the place of any row can be
computed without reading the data, and the permutation can be inverted to find the row of a shard and slot.

The permutation is a balanced Feistel network over the smallest even number of bits that holds n - 1. Its domain has fewer
than 4 n values; positions from n upwards are permuted again until they fall below n, which keeps it a bijection of 0..n-1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import query, table
from saleslake.operators.keys import numbered

ROUNDS = 6
SHARDS = 24
SEED = 20240229


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words, used as the round function."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> np.ndarray:
    return _mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _network(x: np.ndarray, half: int, keys: np.ndarray, back: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for key in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (_mixed(left + key) & mask), left
        else:
            left, right = right, left ^ (_mixed(right + key) & mask)
    return (left << shift) | right


def permuted(x, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """The positions of row numbers `x` among 0..n-1; with `back`, the row numbers at positions `x`."""
    x = np.asarray(x, dtype=np.uint64)
    if n <= 1:
        return np.zeros_like(x)
    half, keys = (max(1, (n - 1).bit_length()) + 1) // 2, _keys(seed)
    with np.errstate(over="ignore"):
        out = _network(x, half, keys, back)
        while (outside := out >= np.uint64(n)).any():
            out[outside] = _network(out[outside], half, keys, back)
    return out


def place(row: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of a row number, without reading any data."""
    position = int(permuted([row], n, seed)[0])
    return position % shards, position // shards


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number at a shard and slot."""
    return int(permuted([slot * shards + shard], n, seed, back=True)[0])


def sharded(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Add `row_number` (0..n-1 in `order`, nulls first), `shard` (0..shards-1) and `slot` (0.. without gap per shard).

    Shards differ by at most one row. The frame is written once, range-partitioned by `order`, so it should hold the
    columns that are needed and no whole texts: join those by key afterwards. Rows that agree in all of `order` are
    numbered in an arbitrary order, so name enough columns to tell rows apart. An empty frame stays empty. Columns
    of these three names in `df` are replaced.
    """
    rows = numbered(df.drop("row_number", "shard", "slot"), order, "row_number")
    # the numbers are dense, so the largest is the count; a single value of a frame that is already written
    n = int(rows.agg(F.max("row_number")).first()[0] or 0)

    @F.arrow_udf("bigint")
    def position(row: pa.Array) -> pa.Array:
        return pa.array(permuted(row.to_numpy(zero_copy_only=False), n, seed).astype(np.int64))

    rows = rows.withColumn("row_number", F.col("row_number") - 1).withColumn("_position", position("row_number"))
    return rows.withColumns(
        {"shard": (F.col("_position") % shards).cast("int"), "slot": F.floor(F.col("_position") / F.lit(shards)).cast("bigint")}
    ).drop("_position")


@query("op10_feistel_shards")
def op10_feistel_shards(spark, folder):
    """All documents in 24 shards of nearly equal row counts. A null text has no bytes and the checksum of an empty one.

    Rows are numbered by doc_id (nulls first), then checksum, then size, so the result does not depend on file order.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharded(narrow, ["doc_id", "text_crc32", "size"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
