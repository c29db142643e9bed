"""What the operators of this subpackage share: their registry, the scan of a table, and bounded slices of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, folder) -> DataFrame function, with its SQL where SQL can say it."""

    def register(run):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def worker_memory(owner: str) -> dict:
    """What a Python worker remembers from task to task for one operator; another operator's memory goes first.

    Functions travel by value, so their module's own variables are new in each task; this dictionary is not.
    """
    import sys
    import types

    held = sys.modules.setdefault("_saleslake_worker_memory", types.ModuleType("memory"))
    if getattr(held, "owner", None) != owner:
        held.owner, held.memory = owner, {}
        pa.default_memory_pool().release_unused()
    return held.memory


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bucket_of(key: str, buckets: int) -> Column:
    """crc32 of the key as text, modulo `buckets`; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % buckets


def slices(texts: pa.Array, limit: int = 2 << 20) -> Iterator[pa.Array]:
    """Consecutive pieces of a text array of about `limit` bytes each; a longer text is a piece of its own.

    Whole batches may hold many megabytes, and the numpy work needs a multiple of that.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(lengths) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for start, stop in zip(cuts, cuts[1:], strict=False):
        yield texts.slice(start, stop - start)


def strings(texts: pa.Array) -> list[str]:
    """The texts as Python strings; null is the empty text."""
    return [t or "" for t in texts.to_pylist()]


def list_array(values: pa.Array, lengths: Iterable[int]) -> pa.ListArray:
    """One list per row over consecutive `values`."""
    offsets = np.concatenate([[0], np.cumsum(np.asarray(list(lengths), dtype=np.int64))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def joined(pieces: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(pieces) if pieces else pa.array([], kind)
