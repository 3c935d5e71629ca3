"""Corpus preparation: five stages over ``documents``, each one of the operators.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and returns a DataFrame; ``run`` writes it as Parquet to the shared folder
and rereads it as the next stage's input.  All but the last return the columns of
``documents``; the last returns the mix, a document as often as it is taken.

Texts go to Python in Arrow batches counted in rows.  The stages set the session's batch
to ``BATCH_ROWS`` rows at most, so that a run of long texts stays within an executor's
memory beside what earlier stages left in reused Python workers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netzero.llm.common import stored, table
from netzero.llm.op2_exact_dedup import drop_exact_copies
from netzero.llm.op4_toxicity import drop_toxic
from netzero.llm.op6_mixing import mixed_documents
from netzero.llm.op7_decontaminate import drop_contaminated
from netzero.llm.op9_simhash import drop_near_copies


#: Rows of an Arrow batch, of texts of any length.
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    rows = int(spark.conf.get(_ROWS, "0"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(_ROWS, str(BATCH_ROWS))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    bounded_batches(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    bounded_batches(spark)
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links."""
    bounded_batches(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    bounded_batches(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents repeated by their rounded rates."""
    bounded_batches(spark)
    return mixed_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: A trained classifier, SimHash components and an alignment have no SQL form;
#: the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
