"""Query registry: name -> (Spark callable, oracle SQL).

Every callable takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` (through the bronze bindings) and returns a DataFrame whose
decimals are cast to double for comparison. Registration order is
dependency order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.plans.warehouse import Warehouse, to_output, warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# the same queries as functions of a Warehouse (e.g. one read from written layers)
BY_WAREHOUSE: dict[str, Callable[[Warehouse], DataFrame]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_output(fn(warehouse(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        BY_WAREHOUSE[name] = lambda w: to_output(fn(w))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
