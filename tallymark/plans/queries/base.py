"""Registry of queries: a Spark builder and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, TimestampType

from tallymark.plans.workspace import Workspace, workspace


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Workspace], DataFrame]
    sql: str | None
    faulty: bool

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(self.build(workspace(spark, sf_dir, self.faulty)))


REGISTRY: dict[str, Query] = {}


def register(
    name: str,
    build: Callable[[Workspace], DataFrame],
    sql: str | None = None,
    faulty: bool = False,
) -> None:
    if name in REGISTRY:
        raise ValueError(f"{name} is registered twice")
    REGISTRY[name] = Query(name, build, sql, faulty)


def present(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: dates as text, times as epoch seconds."""
    columns = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, TimestampType):
            col = F.unix_timestamp(col)
        elif isinstance(field.dataType, IntegerType):
            col = col.cast("bigint")
        columns.append(col.alias(field.name))
    return df.select(*columns)
