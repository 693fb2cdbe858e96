"""Registered queries on the given tables, each with the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmill.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _modules():
    from eventmill.plans import analytics, checks, decoding, extras, reliability, saga, streams

    return [analytics, decoding, saga, reliability, checks, extras, streams]


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def all_queries() -> dict[str, Query]:
    return {
        name: _prepared(query) for module in _modules() for name, query in module.QUERIES.items()
    }


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _modules() for name, sql in module.ORACLE.items()}
