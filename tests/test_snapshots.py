"""File tables replaced behind a pointer: a writer that dies between any two steps leaves the old table whole."""

from __future__ import annotations

import pytest

from biblioflow.sources import snapshots


class Killed(Exception):
    pass


def ids(df) -> list[int]:
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("step", ["written", "pointed", "replaced"])
def test_a_killed_writer_leaves_one_whole_table(spark, tmp_path, step):
    table = str(tmp_path / "t")
    first = snapshots.replace(spark.range(5), table)

    def die(done: str) -> None:
        if done == step:
            raise Killed

    with pytest.raises(Killed):
        snapshots.replace(spark.range(3), table, at=die)
    assert ids(snapshots.read(spark, table)) == (list(range(3)) if step == "replaced" else list(range(5)))
    again = snapshots.replace(spark.range(3), table)  # the retry
    assert ids(snapshots.read(spark, table)) == list(range(3)) and snapshots.current(spark, table) == again
    gone = snapshots.clean(spark, table)
    assert len(gone) == 2 and first in gone and ids(snapshots.read(spark, table)) == list(range(3))
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.endswith(".crc")) == ["_current", "data"]


def test_a_writer_that_fails_halfway(spark, tmp_path):
    table = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, table)
    assert snapshots.clean(spark, table) == []
    snapshots.replace(spark.range(2), table)
    bad = spark.range(100).selectExpr("id", "CASE WHEN id = 99 THEN raise_error('no') END AS x")
    with pytest.raises(Exception, match="no"):
        snapshots.replace(bad, table)
    assert ids(snapshots.read(spark, table)) == [0, 1] and len(snapshots.clean(spark, table)) == 1


def test_readers_and_writers_side_by_side(spark, tmp_path):
    table = str(tmp_path / "t")
    first = snapshots.replace(spark.range(4), table)
    old = snapshots.read(spark, table)
    second = snapshots.replace(old.selectExpr("id + 10 AS id"), table, expected=first)  # made from the table itself
    assert ids(old) == [0, 1, 2, 3] and ids(snapshots.read(spark, table)) == [10, 11, 12, 13]
    with pytest.raises(snapshots.Conflict):
        snapshots.replace(spark.range(1), table, expected=first)
    assert snapshots.current(spark, table) == second and len(snapshots.clean(spark, table, keep=(first,))) == 1 and ids(old) == [0, 1, 2, 3]
