"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmill.llm.common import bound_batches
from eventmill.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _modules():
    from eventmill.llm import (
        conversation_repair,
        decontamination,
        hard_negatives,
        language_id,
        license_scan,
        line_dedup,
        ngram_join,
        packing,
        pii,
        secret_scan,
        sharding,
        spot_signatures,
        toxicity,
    )

    return [
        license_scan,
        secret_scan,
        packing,
        decontamination,
        pii,
        toxicity,
        line_dedup,
        sharding,
        spot_signatures,
        ngram_join,
        hard_negatives,
        language_id,
        conversation_repair,
    ]


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bound_batches(prepare(spark))
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def all_queries() -> dict[str, Query]:
    return {
        name: _prepared(query) for module in _modules() for name, query in module.QUERIES.items()
    }


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _modules() for name, sql in module.ORACLE.items()}
