"""The state form deals granules to buckets: calls into Python are bounded by the buckets, and granules stay apart."""

from __future__ import annotations

import random

import pandas as pd

from granary.streaming import replay_state
from tests.test_logs import replay_by_hand

COLUMNS = ["granule_id", "attempt", "job_outcome", "arrival", "id"]


class State:
    """Holds one entry, as a group's state does."""

    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_granules_of_a_bucket_stay_apart():
    rng = random.Random(5)
    for _ in range(60):
        events = [(f"g{rng.randrange(4)}", rng.randrange(3), rng.choice(["SUCCESS", "FAILURE_RETRYABLE"]), t) for t in range(rng.randrange(2, 30))]
        rows = [(g, a, o, t, f"e{t:02d}") for g, a, o, t in events]
        cut, state, newest = rng.randrange(1, len(rows)), State(), {}
        for part in (rows[:cut], rows[cut:]):
            (out,) = replay_state.apply_events((0,), iter([pd.DataFrame(part, columns=COLUMNS)]), state)
            assert set(out["granule_id"]) == {r[0] for r in part}  # others of the bucket are kept, not emitted again
            newest |= {g: {(g, r.outcome, r.attempt): r.arrival for r in rows.itertuples()} for g, rows in out.groupby("granule_id")}
        assert {k: v for found in newest.values() for k, v in found.items()} == replay_by_hand(events)


def test_a_micro_batch_has_no_more_state_entries_than_buckets(spark, scratch):
    schema = "granule_id string, attempt int, job_outcome string, arrival bigint, id string"
    for k, outcome in enumerate(("FAILURE_RETRYABLE", "SUCCESS")):
        rows = [(f"g{g}", k, outcome, k, f"e{g}-{k}") for g in range(200) if k == 0 or g % 2]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(schema).parquet(f"{scratch}/in")
        query = replay_state.start_state_replay(stream, f"{scratch}/out", f"{scratch}/ckpt", available_now=True, buckets=8)
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8
    current = replay_state.current_from_emissions(spark.read.parquet(f"{scratch}/out").drop("producer")).collect()
    expected = {(f"g{g}", "failure", 0) for g in range(0, 200, 2)} | {(f"g{g}", "success", a) for g in range(1, 200, 2) for a in (0, 1)}
    assert {(r["granule_id"], r["outcome"], r["attempt"]) for r in current} == expected and len(current) == 300
