"""Streams: units of work of bounded size, retention beside producers, the state form under ties and micro-batches."""

from __future__ import annotations

import random
from collections import Counter

from granary.sources import queues
from granary.streaming import replay_state, requeue
from tests.test_logs import replay_by_hand

MESSAGES = "message_id string, body string, failure_type string"


def test_one_large_file_makes_units_of_at_most_100(spark, scratch):
    body = '{"granule_id":"HLS.S30.T01FBE.2022224T215909.v2.0","attempt":0,"debug_bucket":null}'
    rows = spark.createDataFrame([(f"m{i}", body if i % 10 else "no json", "RETRYABLE") for i in range(1000)], MESSAGES)
    rows.coalesce(1).write.parquet(f"{scratch}/retry")
    stream = requeue.read_retry_stream(spark, f"{scratch}/retry")
    requeue.start_requeue(stream, f"{scratch}/requests", f"{scratch}/failure", f"{scratch}/ckpt", "out", available_now=True).awaitTermination()
    requests = spark.read.parquet(f"{scratch}/requests").collect()
    sizes = Counter(r["unit"] for r in requests)
    assert len(requests) == 900 and len({r["message_id"] for r in requests}) == 900
    assert len(sizes) >= 10 and max(sizes.values()) <= 100
    assert queues.read_queue(spark, f"{scratch}/failure").count() == 100


def test_units_do_not_mix_partitions(spark):
    rows = spark.range(0, 1000, 1, 7).selectExpr("cast(id as string) message_id")
    units = requeue.units(rows, 30).groupBy("unit").count().collect()
    assert sum(u["count"] for u in units) == 1000 and max(u["count"] for u in units) <= 30


def test_expiry_leaves_new_and_unfinished_batches(spark, scratch):
    rows = spark.createDataFrame([("m", "b", "RETRYABLE")], MESSAGES)
    for batch, at in enumerate((100, 200, 300)):
        queues.append_batch(rows, scratch, "monitor", batch, at_ms=at)
    rows.write.parquet(queues.batch_folder(scratch, "other", 0))  # in the making: no time yet
    assert queues.expire_batches(spark, scratch, 200) == [("monitor", 0)]
    assert queues.batches(spark, scratch) == [("monitor", 1), ("monitor", 2), ("other", 0)]
    queues.append_batch(rows, scratch, "monitor", 1, at_ms=900)  # written again: counts anew
    assert queues.expire_batches(spark, scratch, 400) == [("monitor", 2)]
    assert queues.batch_times(spark, scratch) == {("monitor", 1): 900}
    assert queues.read_queue(spark, scratch).count() == 2


def test_state_is_the_replay_however_events_are_batched():
    rng = random.Random(2)
    for _ in range(200):
        events = [("g", rng.randrange(3), rng.choice(["SUCCESS", "FAILURE_RETRYABLE"]), t) for t in range(rng.randrange(1, 12))]
        store, last = {}, None
        cut = rng.randrange(len(events) + 1)
        for part in (events[:cut], events[cut:]):
            last = replay_state.applied(store, last, [(t, o == "SUCCESS", f"e{t:02d}", a, o) for _, a, o, t in part][::-1])
        assert {("g", *k): w[2] for k, w in store.items()} == replay_by_hand(events)


def test_equal_arrivals_give_one_state_in_any_order():
    events = [(5, True, "a", 0, "SUCCESS"), (5, False, "b", 0, "FAILURE_RETRYABLE"), (5, False, "c", 1, "FAILURE_RETRYABLE")]
    seen = set()
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        for cut in range(4):
            store, last = {}, None
            for part in (order[:cut], order[cut:]):
                last = replay_state.applied(store, last, [events[k] for k in part])
            seen.add(tuple(sorted((k, w[3]) for k, w in store.items())))
    assert seen == {((("success", 0), "b"), (("success", 1), "c"))}
