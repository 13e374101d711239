"""Job facts, outcome classification, routing and requeue (reference job / monitor / requeuer cases)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from granary.functions import events as ev
from granary.operators import routing
from granary.schemas import STATE_CHANGE_SCHEMA

QUEUE = "arn:queue/main"
DEFINITION = "ProcessingJobDef"


def detail(exit_code, reason, n_attempts, max_attempts, granule="HLS.S30.T61XYZ.2021045T030405.v2.0", attempt=0,
           extra_env=()):
    tries = [
        {"container": {"exitCode": exit_code, "logStreamName": f"stream/{i}", "networkInterfaces": []},
         "startedAt": 1_600_000_000_111 + i, "stoppedAt": 1_600_000_300_222 + i, "statusReason": reason}
        for i in range(n_attempts)
    ]
    container = {"environment": [{"name": "GRANULE_ID", "value": granule}, {"name": "ATTEMPT", "value": str(attempt)},
                                 *extra_env], "vcpus": 1, "memory": 512}
    if exit_code is not None:
        container["exitCode"] = exit_code
    d = {"jobId": "job-1", "jobQueue": QUEUE, "status": "FAILED" if exit_code != 0 else "SUCCEEDED",
         "attempts": tries, "statusReason": reason, "jobDefinition": f"arn:job-definition/{DEFINITION}:3",
         "parameters": {}, "container": container}
    if max_attempts is not None:
        d["retryStrategy"] = {"attempts": max_attempts, "evaluateOnExit": [{"onStatusReason": "Host EC2*", "action": "retry"}]}
    return d


def envelope(d, source="aws.batch", event_id="e1"):
    return json.dumps({"version": "0", "id": event_id, "detail-type": "Batch Job State Change", "source": source,
                       "account": "1", "time": "2020-09-13T12:31:40Z", "region": "us-west-2", "resources": [],
                       "detail": d})


def events_df(spark, docs):
    raw = spark.createDataFrame([(d,) for d in docs], "doc string")
    return raw.select(F.from_json("doc", STATE_CHANGE_SCHEMA).alias("e")).select("e.*")


CASES = {
    "error": (detail(1, "container ended", 1, 3), "FAILURE_NONRETRYABLE", 1, 3, 1),
    "success": (detail(0, "container ended", 1, 3), "SUCCESS", 1, 3, 0),
    "spot": (detail(None, "Host EC2 gone (i-test)", 3, 3), "FAILURE_RETRYABLE", 3, 3, None),
    "cancelled": (detail(None, "cancelled by hand", 1, 3), "FAILURE_NONRETRYABLE", 1, 3, None),
}


def test_job_facts_and_outcome(spark):
    docs = [envelope(d, event_id=name) for name, (d, *_rest) in CASES.items()]
    got = {r.id: r for r in routing.classify(events_df(spark, docs)).collect()}
    for name, (_d, outcome, attempts, max_attempts, code) in CASES.items():
        r = got[name]
        assert (r.job_outcome, r.job_attempts, r.max_attempts, r.exit_code) == (outcome, attempts, max_attempts, code)
        assert r.granule_id == "HLS.S30.T61XYZ.2021045T030405.v2.0" and r.attempt == 0 and r.job_id == "job-1"


def test_defaults_without_attempts_or_retry_strategy(spark):
    d = detail(None, "", 0, None)
    del d["attempts"]
    del d["statusReason"]
    r = routing.classify(events_df(spark, [envelope(d)])).first()
    assert (r.job_attempts, r.max_attempts, r.status_reason, r.job_outcome) == (0, 1, "", "FAILURE_NONRETRYABLE")


def test_routing_cases(spark):
    docs = [
        envelope(detail(1, "container ended", 1, 3), event_id="exit1"),
        envelope(detail(None, "Host EC2 (instance i-0) terminated.", 3, 3), event_id="spot-last"),
        envelope(detail(None, "Host EC2 (instance i-0) terminated.", 1, 3), event_id="spot-early"),
        envelope(detail(0, "container ended", 1, 3), event_id="ok"),
    ]
    c = routing.classify(events_df(spark, docs))
    got = {r.id: (r.outcome, r.route) for r in c.collect()}
    assert got == {"exit1": ("failure", "failure"), "spot-last": ("failure", "retry"),
                   "spot-early": ("failure", "none"), "ok": ("success", "none")}
    retry = routing.queue_rows(c, "retry").collect()
    failure = routing.queue_rows(c, "failure").collect()
    assert [(r.message_id, r.failure_type) for r in retry] == [("spot-last", "RETRYABLE")]
    assert [(r.message_id, r.failure_type) for r in failure] == [("exit1", "NONRETRYABLE")]
    assert json.loads(retry[0].body) == {"granule_id": "HLS.S30.T61XYZ.2021045T030405.v2.0", "attempt": 0,
                                         "debug_bucket": None}


def test_debug_bucket_dropped_on_the_job_path(spark):
    d = detail(None, "Host EC2 x", 3, 3, extra_env=({"name": "DEBUG_BUCKET", "value": "dbg"},))
    c = routing.classify(events_df(spark, [envelope(d)]))
    assert json.loads(routing.queue_rows(c, "retry").first().body)["debug_bucket"] is None


def test_duplicate_env_names_last_wins(spark):
    d = detail(0, "", 1, 3, attempt=1, extra_env=({"name": "ATTEMPT", "value": "7"},))
    assert routing.classify(events_df(spark, [envelope(d)])).first().attempt == 7


def test_terminal_event_filter(spark):
    ok = detail(1, "x", 1, 3)
    other_queue = dict(ok, jobQueue="arn:queue/other")
    other_def = dict(ok, jobDefinition="arn:job-definition/Other:1")
    running = dict(ok, status="RUNNING")
    docs = [envelope(ok, event_id="a"), envelope(other_queue, event_id="b"), envelope(other_def, event_id="c"),
            envelope(running, event_id="d"), envelope(ok, source="aws.ecs", event_id="e")]
    kept = routing.terminal_events(events_df(spark, docs), QUEUE, DEFINITION)
    assert [r.id for r in kept.collect()] == ["a"]


def test_requeue_three_messages(spark):
    msgs = spark.createDataFrame(
        [(f"m{i}", json.dumps({"granule_id": "HLS.S30.T01GEL.2019059T213751.v2.0", "attempt": i}), "RETRYABLE")
         for i in range(3)] + [("bad", "not json", "RETRYABLE")],
        "message_id string, body string, failure_type string",
    )
    events, bad = routing.requeue(msgs)
    assert sorted(r.attempt for r in events.collect()) == [1, 2, 3]
    assert [r.message_id for r in bad.collect()] == ["bad"]


def test_redrive_queue_moves_first_n(spark):
    failures = spark.createDataFrame([(f"m{i}", "{}", "NONRETRYABLE") for i in range(5)],
                                     "message_id string, body string, failure_type string")
    moved, remaining = routing.redrive_queue(failures, 2)
    assert [r.message_id for r in moved.collect()] == ["m0", "m1"]
    assert sorted(r.message_id for r in remaining.collect()) == ["m2", "m3", "m4"]
    moved, remaining = routing.redrive_queue(failures)
    assert moved.count() == 5 and remaining.count() == 0


def test_event_json_and_env_roundtrip(spark):
    df = spark.createDataFrame([("foo", 42, "foo"), ("foo", 42, None)], "granule_id string, attempt int, debug_bucket string")
    out = df.select(
        ev.event_from_json(ev.event_to_json("granule_id", "attempt", "debug_bucket")).alias("j"),
        ev.env_to_event(ev.event_to_env("granule_id", "attempt", "debug_bucket")).alias("e"),
        ev.event_to_env("granule_id", "attempt", "debug_bucket").alias("env"),
    ).collect()
    for r, want_debug in zip(out, ["foo", None]):
        assert (r.j.granule_id, r.j.attempt, r.j.debug_bucket) == ("foo", 42, want_debug)
        assert (r.e.granule_id, r.e.attempt, r.e.debug_bucket) == ("foo", 42, want_debug)
    assert [e.name for e in out[1].env] == ["GRANULE_ID", "ATTEMPT"]
    nxt = df.select(ev.next_attempt(ev.event_from_json(ev.event_to_json("granule_id", "attempt"))).alias("n")).first()
    assert nxt.n.attempt == 43
