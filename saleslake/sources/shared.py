"""Written intermediate tables in the shared folder of the cluster, and their removal.

A written table cuts the lineage, survives the loss of executors, and gives the planner true file sizes
for its join choices. The folder is `spark.checkpoint.dir`; only where the session names none and all work is done in
one process (a test) a folder below the session's own scratch folder is taken.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder which all executors can reach")
    return f"{context.getConf().get('spark.local.dir', '/tmp')}/saleslake-{context.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in _scopes.get()[-1:]:
        scope.append(path)
    return path


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write `df` once as parquet and return the scan of what was written. `compression` suits tables as large as the input."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(jobs: Iterable[Callable]) -> list:
    """Run functions that do not depend on each other at the same time; what they write belongs to the caller's scope."""
    jobs = list(jobs)
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        started = [pool.submit(copy_context().run, job) for job in jobs]
        return [job.result() for job in started]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end all that `fresh_path` and `written` have named inside, and in functions run `side_by_side` there.

    Frames that were made inside may read those tables, so use or write the results before the end. Scopes nest; the
    innermost owns a path. Scopes of different threads do not see each other.
    """
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
