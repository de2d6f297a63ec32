"""Registered queries: name to a function of (spark, sf_dir), and the DuckDB SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from provena.plans.driver import ALL

    return {f.__name__: f for f in ALL}


def oracle_sql() -> dict[str, str]:
    from provena.plans.oracles import SQL

    return dict(SQL)
