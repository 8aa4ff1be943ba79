"""Scans: Parquet, JDBC by predicates or by range, split points, typed empty relations, samples."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Catalog:
    """Names of tables and the folders they lie in; a run writes under its own id."""

    root: str
    run_id: str = "run"
    paths: dict[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return self.paths.get(name, f"{self.root}/{name}.parquet")

    def temporary(self, name: str) -> str:
        return f"{self.root}/{self.run_id}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))


def parts(spark: SparkSession, pattern: str) -> DataFrame:
    """All folders that a glob pattern names, as one relation."""
    return spark.read.parquet(pattern)


def table_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table, or no rows of ``schema`` where it does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def numbers(spark: SparkSession, n: int, name: str = "n") -> DataFrame:
    return spark.range(n).withColumnRenamed("id", name)


def sample(df: DataFrame, rows: int, seed: int = 1) -> DataFrame:
    """About ``rows`` rows, those of the smallest hashes of all columns: the same ones however the rows are partitioned."""
    total = df.count()
    share = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 40))
    return df if total <= rows else df.where(share < int((1 << 40) * rows / total))


def split_points(df: DataFrame, key: str, parts: int) -> list:
    """Approximate quantiles that cut ``key`` into ``parts`` ranges of about equal rows."""
    found = df.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    return sorted(set(found or []))


def _literal(value) -> str:
    """A value as an SQL literal."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def range_predicates(key: str, points: list) -> list[str]:
    """Half-open ranges that cover every row once; nulls go with the lowest. Points may be numbers, texts, dates or times."""
    if not points:
        return ["1 = 1"]
    points = [_literal(p) for p in points]
    first, last = f"{key} < {points[0]} OR {key} IS NULL", f"{key} >= {points[-1]}"
    return [first, *(f"{key} >= {a} AND {key} < {b}" for a, b in zip(points, points[1:], strict=False)), last]


def jdbc_by_predicates(spark: SparkSession, url: str, query: str, predicates: list[str], properties: dict[str, str]) -> DataFrame:
    """One partition for each predicate; ``query`` is a table or a subquery with an alias."""
    return spark.read.jdbc(url, query, predicates=predicates, properties=properties)


def jdbc_by_range(spark: SparkSession, url: str, query: str, column: str, low: int, high: int, partitions: int, properties: dict[str, str], fetch: int = 10_000) -> DataFrame:
    options = {"url": url, "dbtable": query, "partitionColumn": column, "lowerBound": low, "upperBound": high, "numPartitions": partitions, "fetchsize": fetch, **properties}
    return spark.read.format("jdbc").options(**options).load()


def warehouse_table(spark: SparkSession, kind: str, options: dict[str, str]) -> DataFrame:
    """A table of any connector on the class path, by its format's name and options."""
    return spark.read.format(kind).options(**options).load()


def jdbc_table(spark: SparkSession, url: str, query: str, properties: dict[str, str]) -> DataFrame:
    return spark.read.jdbc(url, query, properties=properties)
