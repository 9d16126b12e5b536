"""Query registry: Spark queries and their DuckDB oracle SQL, by SURVEY §2 key."""

from strata.registry.spark_queries import QUERIES
from strata.registry.sql_queries import SQL

__all__ = ["QUERIES", "SQL"]
