"""Loads that stop, overlap and go on."""

import pytest
from pyspark.sql import functions as F

from pitchflow import sources as S

WORK = "league long, season string"


def load_of(spark, tmp_path):
    load = S.LedgerLoad(str(tmp_path / "load"), ("league", "season"))
    work = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, None), (1, "a")], WORK)

    def fetch(items):
        # the item (2, a) has no rows, the others two each
        found = items.filter("league <> 2").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
        return found.withColumn("attempt_note", F.lit("x"))

    return load, work, fetch


def found(load, spark):
    return sorted(((r.league, r.season, r.n) for r in load.read(spark).collect()), key=str)


EVERY = sorted([(1, "a", 1), (1, "a", 2), (1, "b", 1), (1, "b", 2), (3, None, 1), (3, None, 2)], key=str)


def test_a_load_that_stops_resumes_without_loss_or_repeat(spark, tmp_path):
    load, work, fetch = load_of(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        load.read(spark)
    assert load.pending(work).count() == 4
    load.write(fetch(work.distinct()), "stopped")  # no commit
    with pytest.raises(FileNotFoundError):
        load.read(spark)

    def until_second(items):
        until_second.calls += 1
        if until_second.calls == 2:
            raise InterruptedError
        return fetch(items)

    until_second.calls = 0
    with pytest.raises(InterruptedError):
        load.run(load.pending(work), until_second, 3)
    left = load.pending(work).count()
    assert 0 < left <= 4
    load.run(load.pending(work), fetch, 2)
    assert found(load, spark) == EVERY
    assert load.pending(work).count() == 0
    load.run(work, fetch)  # all once more: they count once
    assert found(load, spark) == EVERY
    assert load.clear_stopped(spark) == ["stopped"] and found(load, spark) == EVERY


def test_two_loads_of_the_same_items(spark, tmp_path):
    load, work, fetch = load_of(spark, tmp_path)
    first, second = load.pending(work), load.pending(work)
    load.run(first, fetch, 2)
    load.run(second, lambda items: fetch(items).withColumn("n", F.col("n") + 100), 1)
    assert found(load, spark) == EVERY
    assert load.done(spark).count() == 4


def test_work_is_expanded_by_lists(spark, tmp_path):
    load = S.LedgerLoad(str(tmp_path / "load"), ("league", "season"))
    leagues = spark.createDataFrame([(1,), (2,)], "league long")
    lists = {"season": ["a", "b"]}
    load.run(load.pending(leagues, lists).filter("season = 'a'"), lambda items: items)
    assert sorted(map(tuple, load.pending(leagues, lists).collect())) == [(1, "b"), (2, "b")]
