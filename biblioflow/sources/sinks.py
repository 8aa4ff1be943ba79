"""Sinks: Parquet, JDBC, stage-and-swap upserts, batched row updates, run statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import Row


def parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None, spread: bool = False) -> None:
    """Write Parquet; ``files`` compacts to so many files at most, without a shuffle, or with ``spread`` deals rows over so many."""
    if files:
        df = df.repartition(files) if spread else df.coalesce(files)
    df.write.mode(mode).parquet(path)


def jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append", keep_definition: bool = True, connections: int = 8) -> None:
    """Append or overwrite; an overwrite keeps the table's definition (truncates) unless told otherwise."""
    df.write.option("truncate", keep_definition).option("numPartitions", connections).jdbc(url, table, mode, properties)


def staged_upsert(df: DataFrame, url: str, stage: str, properties: dict[str, str], statements: list[str], run: Callable[[list[str]], None]) -> None:
    """Fill a staging table, then apply it by set-based statements in one transaction, which ``run`` executes.

    A retry fills the staging table anew, so the whole is idempotent if the statements are.
    """
    jdbc(df, url, stage, properties, "overwrite")
    run(statements)


def transaction(spark: SparkSession, url: str, properties: dict[str, str], statements: list[str | tuple[str, int]]) -> list[int]:
    """Run set-based statements in one transaction over one connection of the driver; the number of rows that each changed.

    Any failure undoes them all; so does a statement given with a number of rows that changes another number.
    """
    jvm = spark.sparkContext._jvm
    login = jvm.java.util.Properties()
    for k, v in properties.items():
        login.setProperty(k, v)
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"], True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    connection = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        changed = []
        for given in statements:
            sql, expected = given if isinstance(given, tuple) else (given, None)
            statement.execute(sql)
            changed.append(statement.getUpdateCount())
            if expected not in (None, changed[-1]):
                raise RuntimeError(f"{changed[-1]} rows in place of {expected}: {sql}")
        connection.commit()
        return changed
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def batched_updates(df: DataFrame, apply: Callable[[list[Row]], None], batch: int = 200) -> None:
    """Hand rows to ``apply`` in batches, on the executors; it must be idempotent, as tasks may be retried."""

    def each(rows: Iterator[Row]) -> None:
        held: list[Row] = []
        for row in rows:
            held.append(row)
            if len(held) == batch:
                apply(held)
                held = []
        if held:
            apply(held)

    df.foreachPartition(each)


def statistics(df: DataFrame, **counts: Column) -> DataFrame:
    """(name, value) of counted conditions and of all rows, in one pass."""
    one = df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(name) for name, c in counts.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in ("rows", *counts)])
    return one.select(F.inline(pairs))


def require_equal(a: DataFrame, b: DataFrame, what: str) -> None:
    """Stop the run where two tables that must match in size do not."""
    n, m = a.count(), b.count()
    if n != m:
        raise ValueError(f"{what}: {n} rows against {m}")
