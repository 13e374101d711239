"""Conditional commits: of writers that race for one version exactly one wins, the others read again."""

from __future__ import annotations

import os
import threading

import pytest

from granary.session import path_of
from granary.sources import commits
from granary.sources import progress as prog

PROGRESS = "inventory string, submitted_count long, total_count long"


def race(n, work):
    """Results of ``n`` threads that start together."""
    out, gate = [None] * n, threading.Barrier(n)

    def run(k):
        gate.wait()
        try:
            out[k] = work(k)
        except Exception as error:  # noqa: BLE001
            out[k] = error

    threads = [threading.Thread(target=run, args=(k,)) for k in range(n)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out


def test_exactly_one_writer_wins_each_version(spark, scratch):
    for version in range(5):
        won = race(8, lambda k, v=version: commits.commit(spark, scratch, v, {"writer": k}))
        assert sorted(won) == [False] * 7 + [True]
        assert commits.latest(spark, scratch) == (version, {"writer": won.index(True)})
    assert commits.versions(spark, scratch) == [0, 1, 2, 3, 4]
    assert [n for n in os.listdir(f"{scratch}/_commits") if n[0] == "." and not n.endswith(".crc")] == []


def test_rename_refuses_an_existing_target(spark, scratch):
    def draft(name):
        files, path = path_of(spark, f"{scratch}/{name}")
        stream = files.create(path, False)
        stream.write(name.encode())
        stream.close()
        return path

    _, target = path_of(spark, f"{scratch}/target")
    assert commits._rename(spark, draft("one"), target) is True
    assert commits._rename(spark, draft("two"), target) is False
    with open(f"{scratch}/target") as f:
        assert f.read() == "one"


def test_two_creators_and_two_updaters(spark, scratch):
    def records(k):
        return spark.createDataFrame([("a", k, 10)], PROGRESS)

    created = race(2, lambda k: prog.create_progress(spark, scratch, records(k)))
    assert sorted(map(str, created))[0] == "0" and sum(isinstance(c, prog.ProgressConflictError) for c in created) == 1
    updated = race(2, lambda k: prog.update_progress(spark, scratch, records(5 + k), 0))
    assert sum(u == 1 for u in updated) == 1 and sum(isinstance(u, prog.ProgressConflictError) for u in updated) == 1
    rows, version = prog.read_progress(spark, scratch)
    assert version == 1 and rows.first().submitted_count == 5 + updated.index(1)
    # the losers' folders are gone
    assert len([n for n in os.listdir(scratch) if n.startswith("records-")]) == 2


def test_losers_try_again_on_what_the_winner_stored(spark, scratch):
    prog.create_progress(spark, scratch, spark.createDataFrame([("a", 0, 100)], PROGRESS))

    def add(k):
        def step(records):
            row = records.first()
            return spark.createDataFrame([("a", row.submitted_count + 1, 100)], PROGRESS)

        return prog.change_progress(spark, scratch, step)

    versions = race(4, add)
    assert sorted(versions) == [1, 2, 3, 4]
    assert prog.read_progress(spark, scratch)[0].first().submitted_count == 4


def test_change_undoes_lost_tries(spark, scratch):
    lost = []

    def step(version, before):
        if version == 0:  # another writer comes in between
            commits.commit(spark, scratch, 0, {"n": 1})
        return {"n": (before or {"n": 0})["n"] + 10}

    assert commits.change(spark, scratch, step, undo=lost.append) == 1
    assert lost == [{"n": 10}] and commits.latest(spark, scratch) == (1, {"n": 11})
    assert commits.change(spark, scratch, lambda version, before: None) == 1
    with pytest.raises(commits.CommitConflictError):
        commits.change(spark, scratch, lambda version, before: commits.commit(spark, scratch, version, {}) and {})
