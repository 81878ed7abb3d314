"""Registered queries over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import box_queries, corpus_queries, ink_queries, text_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = text_queries.QUERIES | box_queries.QUERIES | corpus_queries.QUERIES | ink_queries.QUERIES
ORACLE_SQL: dict[str, str] = text_queries.ORACLE_SQL | box_queries.ORACLE_SQL | corpus_queries.ORACLE_SQL | ink_queries.ORACLE_SQL
