"""DuckDB SQL for each registered query, written independently of the Spark plans."""

from oracle.logs import LOG_QUERIES
from oracle.retail import RETAIL_QUERIES
from oracle.tables import with_tables


def oracle_queries() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in {**RETAIL_QUERIES, **LOG_QUERIES}.items()}
