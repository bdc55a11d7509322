"""All queries of the engine by name, with the SQL that must agree with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagecraft.plans import fold_oracle, more, oracle
from pagecraft.plans import queries as q

#: Queries whose folds SQL does not express; tests compare them with brute force instead.
FOLDS = (q.vector_dedup, q.archetypes, q.select_topk, q.library_violations)
ORACLE_SQL: dict[str, str] = oracle.SQL | more.SQL | fold_oracle.SQL
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: getattr(more if name in more.SQL else q, name) for name in ORACLE_SQL} | {f.__name__: f for f in FOLDS}
