import os
import threading

import pytest
from pyspark.sql import functions as F

from tripmart.session import in_parallel
from tripmart.sources import versions
from tripmart.sources.versions import ConcurrentCommit, VersionedTable


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "x int, service string, month int")


def rows(table, **more):
    return sorted(tuple(r) for r in table.read(**more).select("x", "service", "month").collect())


@pytest.fixture
def table(spark, folder):
    return VersionedTable(spark, f"{folder}/t", ("service", "month"))


def test_only_the_partitions_of_a_version_are_replaced(spark, table):
    assert not table.exists() and table.current() == {}
    table.publish(frame(spark, (1, "a", 1), (2, "a", 2), (3, "b", 1)))
    table.publish(frame(spark, (9, "a", 2), (8, "a", 2)))
    assert rows(table) == [(1, "a", 1), (3, "b", 1), (8, "a", 2), (9, "a", 2)]
    assert rows(table, as_of=1) == [(1, "a", 1), (2, "a", 2), (3, "b", 1)]
    table.commit(None, ["service=b/month=1"])
    assert rows(table) == [(1, "a", 1), (8, "a", 2), (9, "a", 2)]


def test_filters_leave_partitions_unread(spark, table):
    table.publish(frame(spark, (1, "a", 1), (2, "a", 2), (3, "b", 1)))
    plan = table.read().where("service = 'a' and month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service" in plan


@pytest.mark.parametrize("step", ["staged", "parts", "records", "created", "committed"])
def test_a_failure_between_any_two_steps_shows_old_or_new(spark, table, monkeypatch, step):
    old = [(1, "a", 1), (2, "a", 2)]
    new = [(5, "a", 1), (6, "a", 2), (7, "b", 3)]
    table.publish(frame(spark, *old))

    class Stop(Exception):
        pass

    def stop(*_, **__):
        raise Stop

    def after(function):
        def run(*args, **more):
            function(*args, **more)
            raise Stop

        return run

    if step == "staged":
        monkeypatch.setattr(table, "stage", after(table.stage))
    elif step == "parts":
        monkeypatch.setattr(table, "parts_of", stop)
    elif step == "records":
        monkeypatch.setattr(table, "_records", stop)
        monkeypatch.setattr(table, "head", lambda: 1)
    elif step == "created":
        # The text was written aside, the rename did not happen.
        monkeypatch.setattr(table._log, "create_once", stop)
    else:
        monkeypatch.setattr(table._log, "create_once", after(table._log.create_once))
    with pytest.raises(Stop):
        table.publish(frame(spark, *new), since=0 if step == "records" else 1)
    seen = rows(VersionedTable(spark, table.root, table.partitions))
    assert seen == (new if step == "committed" else old)
    # Running the same write again completes it.
    again = VersionedTable(spark, table.root, table.partitions)
    again.publish(frame(spark, *new))
    assert rows(again) == new


def test_writers_of_the_same_partition_conflict_others_do_not(spark, table):
    table.publish(frame(spark, (1, "a", 1), (2, "b", 1)))
    base = table.head()
    one, two, three = (table.stage(frame(spark, r)) for r in ((5, "a", 1), (6, "a", 1), (7, "b", 1)))
    table.commit(one, table.parts_of(one), since=base)
    with pytest.raises(ConcurrentCommit, match="service=a/month=1"):
        table.commit(two, table.parts_of(two), since=base)
    table.commit(three, table.parts_of(three), since=base)
    assert rows(table) == [(5, "a", 1), (7, "b", 1)]


def test_parallel_writers_lose_no_commit(spark, table):
    def write(i):
        VersionedTable(spark, table.root, table.partitions).publish(frame(spark, (i, "a", i)))

    in_parallel(spark, write, range(8), 4)
    assert rows(table) == [(i, "a", i) for i in range(8)]
    assert table.head() == 8


def test_a_reader_keeps_its_version_while_others_commit(spark, table):
    table.publish(frame(spark, (1, "a", 1)))
    reader = table.read()
    table.publish(frame(spark, (2, "a", 1)))
    assert [r["x"] for r in reader.collect()] == [1]
    assert table.vacuum() == []  # young ones stay
    assert [r["x"] for r in reader.collect()] == [1]
    assert len(table.vacuum(keep_seconds=-1)) == 1
    assert rows(table) == [(2, "a", 1)]


def test_concurrent_readers_of_a_switched_table_see_whole_versions(spark, folder):
    """A mart is replaced ten times while others read it: each sees one build, never none."""
    mart = VersionedTable(spark, f"{folder}/mart")
    build = lambda i: spark.range(20).select(F.lit(i).alias("build"))
    mart.publish(build(0))
    seen, stop, errors = set(), threading.Event(), []

    def look():
        while not stop.is_set():
            try:
                found = [tuple(r) for r in VersionedTable(spark, mart.root).read().groupBy("build").count().collect()]
                assert len(found) == 1 and found[0][1] == 20
                seen.add(found[0][0])
            except Exception as error:
                errors.append(error)
                return

    readers = [threading.Thread(target=look) for _ in range(2)]
    for r in readers:
        r.start()
    for i in range(1, 6):
        mart.publish(build(i))
    stop.set()
    for r in readers:
        r.join()
    assert not errors and seen <= set(range(6))
    assert mart.read().first()["build"] == 5


def test_compacted_log_gives_the_same_state(spark, table):
    for i in range(4):
        table.publish(frame(spark, (i, "a", 1), (i, "b", i)))
    before, state = rows(table), table.current()
    table.compact_log(keep_seconds=-1)
    names = sorted(n for n in os.listdir(f"{table.root}/_log") if not n.startswith("."))
    assert names == ["00000000000000000004.json", "00000000000000000004.snapshot.json"]
    assert rows(table) == before and table.current() == state and table.head() == 4
    table.publish(frame(spark, (9, "a", 1)))
    assert rows(table) == sorted([r for r in before if r[1:] != ("a", 1)] + [(9, "a", 1)])
    table.compact_log(keep_seconds=-1)
    assert table.head() == 5 and len(table.current()) == len(state)


def test_log_numbers_do_not_repeat(spark, table, monkeypatch):
    table.publish(frame(spark, (1, "a", 1)))
    assert not table._log.create_once("00000000000000000001.json", "x")
    assert rows(table) == [(1, "a", 1)]
    assert [n for n in os.listdir(f"{table.root}/_log") if "1.json." in n and not n.endswith(".crc")] == []
    assert versions.WHOLE == ""
