"""Outcome log: success-supersedes replay, history, lookup, key build/parse (reference logger cases + brute force)."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.functions import paths as pth
from granary.operators import replay

SCHEMA = "granule_id string, attempt int, job_outcome string, seq long"


def replay_by_hand(events):
    """Step-by-step application of the log rules: {(granule, outcome, attempt): seq of the content written last}."""
    store = {}
    for gid, attempt, job_outcome, seq in sorted(events, key=lambda e: (e[0], e[3])):
        outcome = "success" if job_outcome == "SUCCESS" else "failure"
        store[(gid, outcome, attempt)] = seq
        if outcome == "success":
            for (g, o, a), s in list(store.items()):
                if g == gid and o == "failure":
                    store[(g, "success", a)] = s
                    del store[(g, o, a)]
    return store


def current(spark, events, block_size=replay.DEFAULT_BLOCK):
    df = spark.createDataFrame(events, SCHEMA)
    rows = replay.current_job_logs(df, block_size=block_size).collect()
    return {(r.granule_id, r.outcome, r.attempt): r.seq for r in rows}


G = "HLS.S30.T61XYZ.2021045T030405.v2.0"


def test_fail_fail_success_then_fail(spark):
    e = [(G, 0, "FAILURE_RETRYABLE", 1), (G, 1, "FAILURE_NONRETRYABLE", 2)]
    assert current(spark, e) == {(G, "failure", 0): 1, (G, "failure", 1): 2}
    e.append((G, 2, "SUCCESS", 3))
    assert current(spark, e) == {(G, "success", 0): 1, (G, "success", 1): 2, (G, "success", 2): 3}
    e.append((G, 3, "FAILURE_NONRETRYABLE", 4))  # a failure after the success stays a failure
    assert current(spark, e) == {(G, "success", 0): 1, (G, "success", 1): 2, (G, "success", 2): 3,
                                 (G, "failure", 3): 4}


def test_superseded_failure_overwrites_success_of_same_attempt(spark):
    # re-drive: attempt 1 fails, then attempt 1 succeeds; the failure is copied over the success log
    e = [(G, 1, "FAILURE_NONRETRYABLE", 1), (G, 1, "SUCCESS", 2)]
    assert current(spark, e) == {(G, "success", 1): 1}


def test_history_and_lookup(spark):
    e = [(G, 0, "FAILURE_RETRYABLE", 1), (G, 1, "FAILURE_NONRETRYABLE", 2), (G, 2, "SUCCESS", 3),
         (G, 3, "FAILURE_NONRETRYABLE", 4)]
    logs = replay.current_job_logs(spark.createDataFrame(e, SCHEMA))
    hist = {r.outcome: r.attempts for r in replay.attempt_history(logs).collect()}
    assert hist == {"success": [0, 1, 2], "failure": [3]}
    req = spark.createDataFrame([(G, 1), (G, 3), (G, 9)], "granule_id string, attempt int")
    found = {r.attempt: (r.found, r.outcome, r.job_outcome) for r in replay.lookup_events(req, logs).collect()}
    assert found == {1: (True, "success", "FAILURE_NONRETRYABLE"), 3: (True, "failure", "FAILURE_NONRETRYABLE"),
                     9: (False, None, None)}
    assert [r.attempt for r in replay.missing_events(req, logs).collect()] == [9]


def test_hot_granule_across_many_blocks_matches_brute_force(spark):
    rng = random.Random(7)
    events = []
    for g in ["hot"] * 3000 + [f"g{i}" for i in range(300)]:
        events.append(g)
    counters = {}
    rows = []
    for g in events:
        counters[g] = counters.get(g, 0) + 1
        rows.append((g, rng.randrange(4), rng.choice(["SUCCESS", "FAILURE_RETRYABLE", "FAILURE_NONRETRYABLE"]),
                     counters[g]))
    assert current(spark, rows, block_size=64) == replay_by_hand(rows)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 3),
                          st.sampled_from(["SUCCESS", "FAILURE_RETRYABLE", "FAILURE_NONRETRYABLE"])),
                min_size=1, max_size=40))
def test_replay_property(spark, raw):
    counters = {}
    rows = []
    for g, a, o in raw:
        counters[g] = counters.get(g, 0) + 1
        rows.append((g, a, o, counters[g]))
    assert current(spark, rows, block_size=3) == replay_by_hand(rows)


def test_log_key_roundtrip(spark):
    df = spark.createDataFrame([("HLS.L30.T62XYZ.2024061T050607.v2.0", 2, "failure")],
                               "granule_id string, attempt int, outcome string")
    key = df.select(pth.log_key("logs/", "outcome", "granule_id", "attempt").alias("k")).first().k
    assert key == ("logs/outcome=failure/platform=L30/acquisition_date=2024-03-01/"
                   "granule_id=HLS.L30.T62XYZ.2024061T050607.v2.0/attempt=2.json")
    back = spark.createDataFrame([(key,)], "k string").select(pth.parse_log_key("k", "logs").alias("p")).first().p
    assert (back.outcome, back.platform, back.granule_id, back.attempt) == (
        "failure", "L30", "HLS.L30.T62XYZ.2024061T050607.v2.0", 2)


def test_strict_parse_rejects_bad_key(spark):
    df = spark.createDataFrame([("logs/manifest.json",)], "k string")
    with pytest.raises(Exception, match="Cannot parse log key"):
        df.select(pth.parse_log_key("k", "logs")).collect()
    assert df.select(pth.parse_log_key("k", "logs", strict=False).alias("p")).first().p is None


def test_attempt_file_name_and_lenient_view_columns(spark):
    df = spark.createDataFrame([("a/attempt=3.json",), ("a/attempt=3.json.bak",), ("a/other.json",)], "k string")
    assert [r.ok for r in df.select(pth.is_attempt_file("k").alias("ok")).collect()] == [True, False, False]
    miss = spark.createDataFrame([("logs/manifest.json",)], "key string").select(*pth.view_columns("key")).first()
    assert all(v is None for v in miss)  # null on a miss, never '' or a cast error


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3),
                          st.sampled_from(["SUCCESS", "FAILURE_RETRYABLE", "FAILURE_NONRETRYABLE"])),
                min_size=1, max_size=30))
def test_latest_from_events_equals_latest_over_log_state(spark, raw):
    from pyspark.sql import functions as F

    from granary.operators import reporting

    counters = {}
    rows = []
    for g, a, o in raw:
        counters[g] = counters.get(g, 0) + 1
        rows.append((g, a, o, counters[g]))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("platform", F.lit("S30")).withColumn(
        "acquisition_date", F.lit("2024-01-01").cast("timestamp"))
    direct = {(r.granule_id, r.outcome) for r in reporting.latest_from_events(df).collect()}
    via_state = {(r.granule_id, r.outcome) for r in reporting.latest_attempts(replay.current_job_logs(df)).collect()}
    assert direct == via_state


def test_history_for_one_granule_and_outcome(spark):
    e = [(G, 0, "FAILURE_RETRYABLE", 1), (G, 1, "SUCCESS", 2), (G, 2, "FAILURE_NONRETRYABLE", 3),
         ("other", 0, "FAILURE_NONRETRYABLE", 1)]
    logs = replay.current_job_logs(spark.createDataFrame(e, SCHEMA))
    assert {r.outcome: r.attempts for r in replay.history_for(logs, G).collect()} == {"success": [0, 1], "failure": [2]}
    assert [r.attempts for r in replay.history_for(logs, G, "failure").collect()] == [[2]]
