"""A work queue in a database table: rows are leased, handled on Spark and finished in the transaction that holds their effect.

The queue has ``id, rand, started, finished, owner``; the ledger ``batch, finished``. A batch goes through four steps: lease rows for its
token, compute, fill a staging table, and one transaction that applies the staged rows, finishes the leased ones and enters the token
in the ledger. A worker may die between any two steps: started again with its token it finds its own rows, or the ledger's
entry; if it never is, its lease runs out and another worker takes the rows. So every effect happens once.

Times are parameters. Only set-based statements run on the driver; rows are read and written by the executors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioflow.sources import sinks, tables


@dataclass(frozen=True)
class Queue:
    """Names of a queue's tables, and how the database is reached."""

    spark: SparkSession
    url: str
    properties: dict[str, str]
    name: str
    connections: int = 8

    @property
    def ledger(self) -> str:
        return f"{self.name}_ledger"

    @property
    def inbox(self) -> str:
        return f"{self.name}_inbox"

    def run(self, *statements: str | tuple[str, int]) -> list[int]:
        return sinks.transaction(self.spark, self.url, self.properties, list(statements))

    def read(self, query: str, predicates: list[str] | None = None) -> DataFrame:
        return tables.jdbc_by_predicates(self.spark, self.url, query, predicates, self.properties) if predicates else tables.jdbc_table(self.spark, self.url, query, self.properties)


def _time(t: datetime) -> str:
    return f"CAST('{t:%Y-%m-%d %H:%M:%S.%f}' AS TIMESTAMP)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def create(queue: Queue) -> None:
    """The tables of a new queue."""
    queue.run(
        f'CREATE TABLE {queue.name} ("id" BIGINT NOT NULL PRIMARY KEY, "rand" DOUBLE PRECISION NOT NULL, "started" TIMESTAMP, "finished" TIMESTAMP, "owner" VARCHAR(200))',
        f'CREATE TABLE {queue.ledger} ("batch" VARCHAR(200) NOT NULL PRIMARY KEY, "finished" TIMESTAMP NOT NULL)',
    )


def priority(key: Column | str) -> Column:
    """A number below one that is spread like chance, but the same on every try."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))


def add(queue: Queue, ids: DataFrame, key: str = "id") -> int:
    """Queue the ids that are not queued, null ones aside; how many were new. A retry adds nothing."""
    new = ids.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id")).distinct().withColumn("rand", priority("id"))
    sinks.jdbc(new, queue.url, queue.inbox, queue.properties, "overwrite", connections=queue.connections)
    missing = f'NOT EXISTS (SELECT 1 FROM {queue.name} q WHERE q."id" = i."id")'
    return queue.run(f'INSERT INTO {queue.name} ("id", "rand") SELECT i."id", i."rand" FROM {queue.inbox} i WHERE {missing}')[0]


def entered(queue: Queue, batch: str) -> bool:
    """Whether the ledger has this batch."""
    return not queue.read(f'(SELECT "batch" FROM {queue.ledger} WHERE "batch" = {_text(batch)}) l').isEmpty()


def lease(queue: Queue, token: str, now: datetime, rows: int, lasts: timedelta) -> int:
    """Give ``rows`` waiting rows, those of the lowest priority number first, to ``token``; how many it holds.

    Rows whose lease has run out are waiting again. A token that holds rows gets no others: it is a worker come back, and its lease
    begins anew.
    """
    own = f'"owner" = {_text(token)} AND "finished" IS NULL'
    held = queue.run(f'UPDATE {queue.name} SET "started" = {_time(now)} WHERE {own}')[0]
    if held:
        return held
    # The condition stands twice, so that a row which another worker took meanwhile is left to it.
    waits = f'"finished" IS NULL AND ("started" IS NULL OR "started" <= {_time(now - lasts)})'
    first = f'SELECT "id" FROM {queue.name} WHERE {waits} ORDER BY "rand", "id" FETCH FIRST {rows} ROWS ONLY'
    return queue.run(f'UPDATE {queue.name} SET "started" = {_time(now)}, "owner" = {_text(token)} WHERE {waits} AND "id" IN ({first})')[0]


def leased(queue: Queue, token: str) -> DataFrame:
    """(id) that ``token`` holds, read over several connections by the id's remainder."""
    own = f'"owner" = {_text(token)} AND "finished" IS NULL'
    parts = [f'ABS(MOD("id", {queue.connections})) = {k}' for k in range(queue.connections)]
    return queue.read(f'(SELECT "id" FROM {queue.name} WHERE {own}) h', parts)


def consume(
    queue: Queue,
    token: str,
    now: datetime,
    handle: Callable[[DataFrame], DataFrame],
    stage: str,
    statements: list[str],
    rows: int = 100_000,
    lasts: timedelta = timedelta(hours=1),
    at: Callable[[str], None] = lambda step: None,
) -> int:
    """Handle one batch of waiting ids; how many it finished: 0 where none waits, or where the ledger has the token.

    ``handle`` makes, of the leased ids, the rows for the table ``stage``, which belongs to this token; ``statements`` apply that table.
    They need not be idempotent. Where the lease ran out and another worker took rows of it, nothing is applied and RuntimeError raised.
    ``at`` is called with the name of each step when it is done.
    """
    if entered(queue, token):
        return 0
    held = lease(queue, token, now, rows, lasts)
    at("leased")
    if not held:
        return 0
    sinks.jdbc(handle(leased(queue, token)), queue.url, stage, queue.properties, "overwrite", connections=queue.connections)
    at("staged")
    done = f'UPDATE {queue.name} SET "finished" = {_time(now)} WHERE "owner" = {_text(token)} AND "finished" IS NULL'
    queue.run((done, held), *statements, _entry(queue, token, now))
    at("committed")
    return held


def _entry(queue: Queue, batch: str, now: datetime) -> str:
    return f'INSERT INTO {queue.ledger} ("batch", "finished") VALUES ({_text(batch)}, {_time(now)})'


def each_once(queue: Queue, name: str, clock: Callable[[], datetime], stage: str, statements: list[str], at: Callable[[str], None] = lambda step: None) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that applies every micro-batch once, however often the stream hands it over.

    A batch is staged and applied by ``statements`` in the transaction that enters ``name`` and its number in the ledger. A stream with
    a checkpoint of its own needs a name of its own.
    """

    def apply(df: DataFrame, number: int) -> None:
        batch = f"{name}-{number}"
        if entered(queue, batch):
            return
        sinks.jdbc(df, queue.url, stage, queue.properties, "overwrite", connections=queue.connections)
        at("staged")
        queue.run(*statements, _entry(queue, batch, clock()))
        at("committed")

    return apply


def states(rows: DataFrame, now: Column, lasts: Column) -> DataFrame:
    """(state, n, oldest): how many rows of a queue wait, are leased, have run out or are finished, and the first start of each.

    rows: started, finished; ``lasts`` is an interval. A finished row is finished whenever it was started.
    """
    state = F.when(F.col("finished").isNotNull(), "finished").when(F.col("started").isNull(), "waiting").when(F.col("started") <= now - lasts, "expired").otherwise("leased")
    return rows.groupBy(state.alias("state")).agg(F.count("*").alias("n"), F.min("started").alias("oldest"))
