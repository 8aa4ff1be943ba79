"""The work queue on Derby: workers that die at any step, leases that run out, streams that start again."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from biblioflow.operators import diff
from biblioflow.sources import queue, sinks

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
NOW, HOUR = datetime(2025, 1, 1, 12), timedelta(hours=1)
#: Not idempotent: a batch applied twice shows.
COUNT = ['UPDATE effect SET "n" = "n" + 1 WHERE "id" IN (SELECT "id" FROM stage_a)']


class Killed(Exception):
    pass


def dies(step):
    def at(done):
        if done == step:
            raise Killed(step)

    return at


@pytest.fixture
def q(spark, tmp_path):
    own = queue.Queue(spark, f"jdbc:derby:{tmp_path}/db;create=true", DRIVER, "todo", connections=3)
    queue.create(own)
    sinks.jdbc(spark.range(-5, 25).select("id", F.lit(0).alias("n")), own.url, "effect", DRIVER, "overwrite")
    return own


def effect(q):
    return {r["id"]: r["n"] for r in q.read("effect").collect()}


def finished(q):
    return {r["id"] for r in q.read("todo").where("finished is not null").collect()}


def same(df):
    return df.select("id")


def test_ids_are_queued_once(spark, q):
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,), (-3,)], "id long")
    assert queue.add(q, ids) == 3 and queue.add(q, ids) == 0 and queue.add(q, spark.range(1, 5)) == 2
    rows = {r["id"]: r["rand"] for r in q.read("todo").collect()}
    assert set(rows) == {1, 2, 3, 4, -3} and all(0 <= v < 1 for v in rows.values())
    none = spark.createDataFrame([], "id long")
    assert rows == {r["id"]: r["rand"] for r in diff.queue_inserts(ids.union(spark.range(1, 5)).where("id is not null"), none).collect()}


def test_batches_go_by_priority_until_none_waits(spark, q):
    queue.add(q, spark.range(-5, 25))
    order = [r["id"] for r in q.read("todo").orderBy("rand", "id").collect()]
    sizes = []
    while n := queue.consume(q, f"b{len(sizes)}", NOW, same, "stage_a", COUNT, rows=12):
        sizes.append(n)
        assert finished(q) == set(order[: sum(sizes)])
    assert sizes == [12, 12, 6] and set(effect(q).values()) == {1}
    assert queue.consume(q, "b0", NOW, same, "stage_a", COUNT) == 0


@pytest.mark.parametrize("step", ["leased", "staged", "committed"])
@pytest.mark.parametrize("back", [True, False])
def test_a_worker_dies_at_a_step(spark, q, step, back):
    """It comes back with its token, or its lease runs out and others do the work: each id is handled once."""
    queue.add(q, spark.range(0, 20))
    with pytest.raises(Killed):
        queue.consume(q, "it's a", NOW, same, "stage_a", COUNT, rows=8, lasts=HOUR, at=dies(step))
    applied = 8 if step == "committed" else 0
    assert sum(effect(q).values()) == applied == len(finished(q))
    soon = NOW + timedelta(minutes=5)
    other = queue.consume(q, "b", soon, same, "stage_a", COUNT, rows=100, lasts=HOUR)
    assert other == 12  # the leased rows are not for others yet
    late = soon if back else NOW + HOUR
    assert queue.consume(q, "it's a" if back else "c", late, same, "stage_a", COUNT, rows=100, lasts=HOUR) == 8 - applied
    assert finished(q) == set(range(20)) and {i: n for i, n in effect(q).items() if n} == dict.fromkeys(range(20), 1)


def test_a_worker_whose_lease_was_taken_applies_nothing(spark, q):
    queue.add(q, spark.range(0, 20))

    def slow(df):
        if not finished(q):
            queue.consume(q, "fast", NOW + HOUR, same, "stage_b", [COUNT[0].replace("stage_a", "stage_b")], rows=5, lasts=HOUR)
        return same(df)

    with pytest.raises(Exception, match="in place of 10"):
        queue.consume(q, "slow", NOW, slow, "stage_a", COUNT, rows=10, lasts=HOUR)
    assert len(finished(q)) == 5 == sum(effect(q).values())
    assert queue.consume(q, "slow", NOW, same, "stage_a", COUNT, rows=10, lasts=HOUR) == 5
    assert len(finished(q)) == 10 == sum(effect(q).values())


def test_a_failing_statement_undoes_the_batch(spark, q):
    queue.add(q, spark.range(0, 6))
    with pytest.raises(Exception, match="NOWHERE"):
        queue.consume(q, "a", NOW, same, "stage_a", [*COUNT, "DELETE FROM nowhere"])
    assert not finished(q) and not sum(effect(q).values()) and not queue.entered(q, "a")
    assert queue.consume(q, "a", NOW, same, "stage_a", COUNT) == 6 and queue.entered(q, "a")


def test_nothing_waits(q):
    assert queue.consume(q, "a", NOW, same, "stage_a", COUNT) == 0 and not queue.entered(q, "a")


@pytest.mark.parametrize("step", ["staged", "committed"])
def test_a_stream_that_is_killed_starts_again(spark, q, tmp_path, step):
    """The stream hands the batch over again, which the ledger knows if its transaction was done."""
    for k in range(3):
        sinks.parquet(spark.range(5 * k, 5 * k + 5), f"{tmp_path}/in/{k}", files=1)
    for k in range(3):
        next((tmp_path / f"in/{k}").glob("*.parquet")).rename(tmp_path / f"in/{k}.parquet")

    def run(at=lambda step: None):
        rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*.parquet")
        each = queue.each_once(q, "changes", lambda: NOW, "stage_a", COUNT, at)
        stream = rows.writeStream.foreachBatch(each).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        try:
            stream.awaitTermination(120)
        finally:
            stream.stop()

    with pytest.raises(Exception, match="Killed"):
        run(dies(step))
    assert sum(effect(q).values()) == (5 if step == "committed" else 0)
    run()
    run()
    assert {i: n for i, n in effect(q).items() if n} == dict.fromkeys(range(15), 1)
    assert q.read("todo_ledger").count() == 3


def test_states(spark):
    t = datetime(2025, 1, 1, 10)
    rows = spark.createDataFrame([(1, None, None), (2, t, None), (3, NOW, None), (4, t, NOW), (5, NOW - HOUR, None)], "id long, started timestamp, finished timestamp")
    got = {r["state"]: (r["n"], r["oldest"]) for r in queue.states(rows, F.lit(NOW), F.expr("INTERVAL 1 HOUR")).collect()}
    assert got == {"waiting": (1, None), "expired": (2, t), "leased": (1, NOW), "finished": (1, t)}
