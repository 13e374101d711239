"""Incremental log state (T7, stateful form): the current log objects of each granule kept as streaming state.

The default form of the current log state is a view (``replay.current_job_logs``) over the append-only event table.
This form keeps, for each granule, its current log objects ``(outcome, attempt)`` with the write order and job outcome of the
event that wrote each, and the arrival of its last success. It applies the rules of the replay as events arrive: a
success supersedes every failure that arrived no later than itself, also one of the same arrival that comes in a later
micro-batch; an object keeps the content of the largest write order ``(written, superseded, arrival, id)``. State per granule is bounded by its
attempt numbers, not by its number of events. Granules are dealt to a fixed number of buckets by their hash, and one state
entry holds the granules of a bucket: a call into Python, which costs some milliseconds however few rows it gets, then
serves many granules, and a micro-batch makes no more calls than there are buckets. The number of buckets is part of the
state, so a checkpoint keeps the one it began with (and one of the form with an entry a granule can't be continued).

In update mode each micro-batch emits the full current state of the
granules it touched; the newest emission per granule is the current state. Arrivals must not
go back from one micro-batch to the next (equal ones may; within a batch any order will do). State lies in RocksDB on the
executors' disks, within a fixed share of their memory; in Spark's other store, all entries and those of the version before
are objects on the heap. A checkpoint that began with another store goes on with it. The events of one granule within one micro-batch are applied by one task, so for bulk
backfills (history loaded at once) the view form, which splits hot granules into blocks, is the one to use; this form
suits the steady trickle of state changes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from granary.functions.keys import HASH_COL, key_hash
from granary.session import settings
from granary.sources.queues import append_batch

PRODUCER = "state-replay"
BUCKETS = 1 << 13
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",  # for all stores of an executor together
}

# one element a granule in the first three, one a log object in the others, in order of the granules
STATE_SCHEMA = (
    "granules array<string>, last_successes array<bigint>, sizes array<int>, outcomes array<string>, attempts array<int>, written array<bigint>, superseded array<boolean>, arrivals array<bigint>, "
    "ids array<string>, job_outcomes array<string>"
)
OUTPUT_SCHEMA = "granule_id string, outcome string, attempt int, job_outcome string, arrival bigint"

Write = tuple[int, bool, int, str, str]  # written at, superseded, arrival, event id, job outcome


def applied(store: dict[tuple[str, int], Write], last_success: int | None, events: list[tuple[int, bool, str, int, str]]) -> int | None:
    """Put events ``(arrival, is a success, id, attempt, job outcome)`` into the log objects; returns the last success.

    Failures go before the successes that arrive with them.
    """
    for arrival, success, event_id, attempt, job_outcome in sorted(events):
        late = not success and last_success is not None and arrival <= last_success
        write = (last_success if late else arrival, late, arrival, event_id, job_outcome)
        key = ("success" if success or late else "failure", attempt)
        store[key] = max(store[key], write) if key in store else write
        if success:
            last_success = arrival
            for failed in [k for k in store if k[0] == "failure"]:
                _, _, at, failed_id, name = store.pop(failed)
                moved = (arrival, True, at, failed_id, name)
                key = ("success", failed[1])
                store[key] = max(store[key], moved) if key in store else moved
    return last_success


def apply_events(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Advance the log objects of a bucket's granules by the events of this micro-batch; the touched ones are emitted."""
    stores: dict[str | None, dict[tuple[str, int], Write]] = {}
    last_success: dict[str | None, int | None] = {}
    if state.exists:
        granules, lasts, sizes, *columns = state.get
        objects = zip(*columns, strict=True)
        for granule_id, last, size in zip(granules, lasts, sizes, strict=True):
            stores[granule_id] = {(outcome, attempt): tuple(write) for outcome, attempt, *write in islice(objects, size)}
            last_success[granule_id] = last
    events: dict[str | None, list[tuple[int, bool, str, int, str]]] = {}
    for frame in batches:
        rows = zip(*(frame[c].tolist() for c in ("granule_id", "attempt", "job_outcome", "arrival", "id")), strict=True)
        for granule_id, attempt, job_outcome, arrival, event_id in rows:
            events.setdefault(granule_id, []).append((int(arrival), job_outcome == "SUCCESS", event_id or "", int(attempt), job_outcome))
    for granule_id, own in events.items():
        last_success[granule_id] = applied(stores.setdefault(granule_id, {}), last_success.get(granule_id), own)
    objects = [(*k, *write) for store in stores.values() for k, write in store.items()]
    state.update((list(stores), [last_success[g] for g in stores], [len(store) for store in stores.values()], *map(list, zip(*objects, strict=True))))
    emitted = [(granule_id, *k, stores[granule_id][k][4], stores[granule_id][k][2]) for granule_id in events for k in sorted(stores[granule_id])]
    yield pd.DataFrame(emitted, columns=["granule_id", "outcome", "attempt", "job_outcome", "arrival"]).astype({"attempt": "int32", "arrival": "int64"})


def start_state_replay(events: DataFrame, sink: str, checkpoint: str, available_now: bool = False, buckets: int = BUCKETS) -> StreamingQuery:
    """Stream ``granule_id, attempt, job_outcome, arrival, id`` rows into the state of their granules; emissions go to ``sink``.

    ``buckets`` is fixed for a checkpoint; more of them write less state again in a small micro-batch, and cost more calls in a large one.
    """
    bucket = F.pmod(key_hash("granule_id"), F.lit(buckets)).alias("bucket")
    updates = events.select(bucket, "granule_id", "attempt", "job_outcome", "arrival", "id").groupBy("bucket").applyInPandasWithState(
        apply_events, OUTPUT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout
    )
    writer = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, bid: append_batch(df, sink, PRODUCER, bid)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    with settings(events.sparkSession, STORE):  # the query keeps them
        return writer.start()


def current_from_emissions(emissions: DataFrame) -> DataFrame:
    """Current log objects: per granule, the rows of its newest emission (``batch_id`` column of the sink)."""
    h = HASH_COL
    tagged = emissions.withColumn(h, key_hash("granule_id"))
    newest = tagged.groupBy(h, "granule_id").agg(F.max("batch_id").alias("batch_id"))
    return tagged.join(newest, [h, "granule_id", "batch_id"], "left_semi").drop(h, "batch_id")
