"""From raw documents to packed training sequences.

Each stage reads what the stage before it kept, as Parquet in the shared folder:

1. toxicity: documents that the clause grammar scores as toxic go;
2. line_dedup: lines that at least three documents hold stay in the largest doc_id only;
3. ngram_jaccard: one document of each group of near duplicates stays;
4. decontamination: documents in which a benchmark item stands go;
5. packing: what is left is cut into pieces and packed into sequences.

All stages but the last return the columns of ``documents`` as they are named there. No stage is one
SQL statement, so there is no SQL for the whole; the tests compare with a plain version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmill.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from eventmill.llm.common import bound_batches, documents
from eventmill.session import prepare, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _prepared(stage: Stage) -> Stage:
    def apply(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(prepare(spark))
        return stage(spark, docs, sf_dir)

    apply.__name__ = stage.__name__
    apply.__doc__ = stage.__doc__
    return apply


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _prepared(toxicity.toxicity_stage)),
    ("line_dedup", _prepared(line_dedup.dedup_stage)),
    ("ngram_jaccard", _prepared(ngram_join.ngram_join_stage)),
    ("decontamination", _prepared(decontamination.decontamination_stage)),
    ("packing", _prepared(packing.packing_stage)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents of ``sf_dir`` that every stage keeps."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
