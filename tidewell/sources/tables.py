"""Where plans get their tables from.

A plan takes a mapping from table name (``silver_store_sales``,
``gold_monthly_trends``, ``database_logs`` …) to DataFrame. It may be a plain
dict, the catalog, or frames that are declared only when a plan asks for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession


class DeclaredTables(Mapping):
    """Names mapped to builders; each frame is declared once, on first use."""

    def __init__(self, builders: Mapping[str, Callable[["DeclaredTables"], DataFrame]]):
        self._builders = dict(builders)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._builders[name](self)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def extended(self, builders: Mapping[str, Callable[["DeclaredTables"], DataFrame]]) -> "DeclaredTables":
        return DeclaredTables({**self._builders, **builders})


class CatalogTables(Mapping):
    """Tables registered in a catalog database (see ``lake.register_layer``)."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        self._spark = spark
        self._prefix = f"{database}." if database else ""
        self._database = database

    def __getitem__(self, name: str) -> DataFrame:
        if not self._spark.catalog.tableExists(self._prefix + name):
            raise KeyError(name)
        return self._spark.table(self._prefix + name)

    def __iter__(self) -> Iterator[str]:
        return iter(table.name for table in self._spark.catalog.listTables(self._database))

    def __len__(self) -> int:
        return len(self._spark.catalog.listTables(self._database))
