"""Documents to token ids: toxic texts go, one of each group of near copies stays, leaked benchmarks go, personal data is
masked, texts become ids.

Each stage works on what its predecessor has kept. All but the last return the columns of `documents`; the last returns
doc_id, n_tokens, ids and the text decoded from them. Empty tables pass as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.llm import decontaminate, personal, pieces, simhash, toxicity
from saleslake.llm.common import query, table
from saleslake.sources.shared import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. The labels' texts are those of the documents at hand."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, and n_chars follows the new text."""
    masked = personal.redacted(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pieces.Pieces(spark, pieces.model_path())
    coded = docs.select("doc_id", model.coded("text").alias("coded"))
    return coded.select("doc_id", F.size("coded.ids").cast("bigint").alias("n_tokens"), "coded.ids", "coded.decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("benchmark_leaks", drop_leaks),
    ("personal_data", mask_personal),
    ("piece_ids", encode),
]

# The learnt model, the similarity groups and the encoder have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
