"""A corpus pipeline on ``documents``: every stage works on all that its predecessor kept.

Language identification drops documents whose language isn't sure; of near-duplicates one stays; personal data is replaced
in the texts; sources are mixed to their target weights, by repeating documents or leaving some out; the rest is
tokenized and packed into sequences. Missing texts are rejected by the first stage; empty tables pass through.
"""

from __future__ import annotations

import gc
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from campaignlens.llm import langid, mixing, packing, pii, shingles
from campaignlens.llm.common import Workspace, in_fold, read_table

#: Scratch of stages that are called one by one; a stage's result must have been written before the next one starts.
_LOOSE: list[Workspace] = []
#: Scratch of the stages of one call of :func:`run`.
_SCRATCH: ContextVar[list[Workspace] | None] = ContextVar("scratch", default=None)


def _clear(scratch: list[Workspace], spark: SparkSession) -> None:
    """Delete the workspaces of finished stages, and let go of their plans: Spark removes shuffle files that nothing refers to any more."""
    finished = [w for w in scratch if w.spark is spark]
    for earlier in finished:
        scratch.remove(earlier)
        earlier.drop()
    if finished:
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def _workspace(spark: SparkSession) -> Workspace:
    """A new workspace for a stage; those of earlier stages go, as their results have been written and read again."""
    scratch = _SCRATCH.get()
    scratch = _LOOSE if scratch is None else scratch
    _clear(scratch, spark)
    scratch.append(Workspace(spark))
    return scratch[-1]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure, with that language in ``lang``."""
    _workspace(spark)
    training = docs.filter(F.col("doc_id").isNotNull() & ~in_fold(F.col("doc_id"), 4, 2))
    dictionaries = langid.train(training.select("doc_id", "text", "lang"))
    return langid.kept_documents(docs, dictionaries)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): the one with the smallest id."""
    return shingles.one_per_group(docs, _workspace(spark))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redacted_documents(docs, _workspace(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents once per pass over their source, and cut ones at the ends of a partial pass."""
    return mixing.mixed_documents(docs, _workspace(spark))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all pieces with their sequence and offset."""
    return packing.packed(docs, keep_ids=True, workspace=_workspace(spark))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't state these methods; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written as Parquet and read again as the next one's documents.

    The last result is written too, so it stays readable whatever runs afterwards; earlier ones and all scratch are deleted.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    scratch = _SCRATCH.set([])
    try:
        for name, stage in STAGES:
            results = Workspace(spark)
            docs = results.table(stage(spark, docs, sf_dir), name)
            if before is not None:
                before.drop()
            before = results
        return docs
    finally:
        _clear(_SCRATCH.get(), spark)
        _SCRATCH.reset(scratch)
