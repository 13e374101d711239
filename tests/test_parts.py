"""Daily log folders, and jobs that work in parts so that their disk stays bounded."""

from __future__ import annotations

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from granary.functions.granules import acquisition_date
from granary.operators import replay, routing
from granary.plans import catalog, fixtures, jobs
from granary.session import released_shuffles
from granary.sources import joblogs, logtable, queues, snapshot
from granary.streaming import monitor, replay_state

ORDERS = "o_orderkey bigint, o_orderstatus string, o_orderdate timestamp_ntz"
LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def _tables(spark, folder: str, orders: int = 24, lines: int = 4) -> str:
    """Orders of twelve days, each with some lines: outcomes and simultaneous events of all kinds."""
    day = dt.datetime(1996, 1, 5)
    rows = [(k, "F", day + dt.timedelta(days=k % 12)) for k in range(orders)]
    spark.createDataFrame(rows, ORDERS).write.parquet(f"{folder}/orders.parquet")
    items = [
        (k, 10 * k + n, 1 + (k + n) % 4, n + 1, 1.0, 2.0, 0.0, 0.0, "NAR"[(k * 5 + n * 2) % 3], "F", day + dt.timedelta(days=(k * 7 + n * 3) % 30))
        for k in range(orders)
        for n in range(lines)
    ]
    spark.createDataFrame(items, LINES).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def _folders(path: str) -> set[str]:
    return {d.rsplit("acquisition_date=", 1)[1] for d, _, names in os.walk(path.removeprefix("file:")) if any(n.startswith("part-") for n in names)}


def test_job_log_files_lie_in_the_folder_of_their_day(spark, scratch):
    rows = catalog.QUERIES["job_log_files"](spark, _tables(spark, scratch)).collect()
    of_id = {(r["granule_id"].split(".")[3][:7], r["acquisition_date"]) for r in rows}
    assert {dt.datetime.strptime(doy, "%Y%j").strftime("%Y-%m-%d") for doy, _ in of_id} == {day for _, day in of_id}
    assert len(of_id) == 12 and all(r["folder"].endswith(f"/acquisition_date={r['acquisition_date']}") for r in rows)


COLUMNS = ["granule_id", "outcome", "attempt", "job_outcome", "arrival", "id"]


def _logged(spark, folder):
    """Logged attempts of twelve days; some granules have no day."""
    rows = routing.log_rows(catalog._routed(spark, _tables(spark, folder)), order="seq").withColumnRenamed("seq", "arrival")
    rows = rows.withColumn("id", F.col("job_info.jobId"))
    nameless = rows.filter("attempt = 1").withColumn("granule_id", F.concat(F.lit("x"), F.split_part("granule_id", F.lit("T"), F.lit(2))))
    nameless = nameless.withColumns({"platform": F.lit(None).cast("string"), "acquisition_date": acquisition_date("granule_id")})
    return rows.unionByName(nameless)


def test_days_are_put_together_up_to_a_number_of_rows():
    sizes = {("b",): 3, ("a",): 2, (None,): 1, ("d",): 9, ("c",): 1}
    assert replay.day_parts(sizes, 4) == [[(None,), ("a",)], [("b",), ("c",)], [("d",)]]
    assert replay.day_parts({}, 4) == [] and replay.day_parts(sizes) == [[(None,), ("a",), ("b",), ("c",), ("d",)]]


def test_a_replay_in_parts_is_a_replay_of_everything(spark, scratch):
    events = _logged(spark, scratch).drop("platform").cache()
    options = {"order": "arrival", "tie": "id"}
    whole = replay.current_job_logs(events.drop("acquisition_date"), **options)
    parts = replay.current_in_parts(events, "acquisition_date", rows=10, **options)
    assert len(parts) >= 5 and max(p.count() for p in parts) <= 20
    assert sorted(map(str, (r for p in parts for r in p.select(*COLUMNS).collect()))) == sorted(map(str, whole.select(*COLUMNS).collect()))
    assert replay.current_in_parts(events.filter("false"), "acquisition_date", **options)[0].count() == 0


def test_a_log_of_several_parts_is_one_version(spark, scratch):
    events = _logged(spark, scratch).drop("platform").cache()
    parts = replay.current_in_parts(events, "acquisition_date", rows=20, order="arrival", tie="id")
    seen = []
    for version in range(2):
        seen.append(joblogs.rewrite_job_logs([routing.log_rows(p) for p in parts], f"{scratch}/logs"))
        assert joblogs.versions(spark, f"{scratch}/logs") == seen
    expected = replay.current_job_logs(events.drop("acquisition_date"), order="arrival", tie="id").count()
    assert joblogs.read_job_logs(spark, f"{scratch}/logs").count() == expected
    joblogs.write_job_logs(routing.log_rows(parts[0]), f"{scratch}/logs/version=2", complete=False)
    assert joblogs.versions(spark, f"{scratch}/logs") == seen  # a part alone is no version


def test_a_log_from_an_empty_event_table_is_empty(spark, scratch):
    queues.append_batch(_logged(spark, scratch).filter("attempt < 0"), f"{scratch}/events", "history", 0)
    jobs.materialize_current_logs(spark, f"{scratch}/events", f"{scratch}/logs")
    assert joblogs.versions(spark, f"{scratch}/logs") == [0] and joblogs.read_job_logs(spark, f"{scratch}/logs").count() == 0


def test_a_compaction_in_parts_equals_a_replay(spark, scratch):
    events = _logged(spark, scratch).cache()
    for batch, part in enumerate(("arrival <= 2", "arrival > 2")):
        logtable.compact(events.filter(part), f"{scratch}/table", "history", batch, block_size=4096, part_rows=15)
    expected = replay.current_job_logs(events.drop("platform", "acquisition_date"), order="arrival", tie="id")
    columns = ["granule_id", "outcome", "attempt", "job_outcome", "job_info.jobId"]
    assert sorted(map(str, logtable.read(spark, f"{scratch}/table").select(*columns).collect())) == sorted(map(str, expected.select(*columns).collect()))


def _shuffled(spark) -> set[str]:
    """Shuffle files in the local folders of this session."""
    top = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {n for d in top for _, _, names in os.walk(d) for n in names if n.startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    for _ in range(50):  # files go a moment after the write
        if not (left := _shuffled(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_listings_are_stored_in_order_of_their_keys(spark, scratch):
    rows = spark.range(20_000, numPartitions=1).select(
        F.lit("2025-06-01-01-00").alias("dt"), F.concat(F.lit("logs/granule_id="), F.hex(F.xxhash64("id")), F.lit("/attempt=0.json")).alias("key"),
        *(F.lit(None).cast("string").alias(c) for c in ("bucket", "version_id")), F.lit(True).alias("is_latest"), F.lit(False).alias("is_delete_marker"),
        F.lit(None).cast("timestamp").alias("last_modified_date"),
    )
    snapshot.write_snapshot(rows, f"{scratch}/listing")
    keys = [r["key"] for r in snapshot.read_snapshot(spark, f"{scratch}/listing").collect()]
    assert keys == sorted(keys) and len(keys) == 20_000
    assert all(n.endswith(".zstd.parquet") for _, _, names in os.walk(f"{scratch}/listing") for n in names if n.startswith("part-"))


def test_the_listing_in_parts_has_the_keys_of_the_log(spark, scratch, monkeypatch):
    tables = _tables(spark, scratch)
    monkeypatch.setattr(fixtures, "current_in_parts", lambda *a, **o: replay.current_in_parts(*a, rows=20, **o))
    listed = [r["key"] for r in fixtures.log_snapshot(spark, tables).filter("dt = '2025-06-02-01-00' and key not like '%manifest.json'").collect()]
    logs = routing.with_log_key(fixtures.current_logs(spark, tables, extra=["k"]).filter("k % 97 <> 0"), "logs")
    assert sorted(listed) == sorted(r["key"] for r in logs.select("key").collect())


def test_read_documents_are_deleted_once_they_are_in(spark, scratch):
    tables = _tables(spark, scratch)
    catalog._events(spark, tables).repartition(6).write.json(f"{scratch}/in")
    largest = max(os.path.getsize(f"{scratch}/in/{f}") for f in os.listdir(f"{scratch}/in") if f.startswith("part-"))
    sinks = monitor.MonitorSinks(*(f"{scratch}/{n}" for n in ("log", "retry", "failure", "rejects")))
    stream = monitor.read_state_changes(spark, f"{scratch}/in", max_bytes_per_trigger=largest + 1, delete_read=True)
    monitor.start_monitor(stream, sinks, f"{scratch}/ckpt", fixtures.MAIN_QUEUE, catalog.JOB_DEFINITION, available_now=True).awaitTermination()
    for _ in range(50):
        if (left := sum(f.startswith("part-") for f in os.listdir(f"{scratch}/in"))) < 3:
            break
        time.sleep(0.2)
    assert left < 3  # those of the last micro-batch may stay
    expected = sorted(r[0] for r in catalog._routed(spark, tables).select("id").collect())
    assert sorted(r[0] for r in spark.read.parquet(sinks.log_events).select("id").collect()) == expected


def test_state_lies_in_rocksdb(spark, scratch):
    schema = "granule_id string, attempt int, job_outcome string, arrival bigint, id string"
    spark.createDataFrame([("g", 0, "SUCCESS", 1, "e")], schema).write.parquet(f"{scratch}/in")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    query = replay_state.start_state_replay(spark.readStream.schema(schema).parquet(f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ckpt", available_now=True)
    query.awaitTermination()
    assert any(name.startswith("rocksdb") for name in query.lastProgress["stateOperators"][0]["customMetrics"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_a_write_leaves_no_shuffle_files(spark, scratch):
    before = _shuffled(spark)
    with released_shuffles(spark):
        spark.range(1000).repartition(7, "id").write.parquet(f"{scratch}/out")
    assert not _left(spark, before)
    queues.append_batch(spark.range(1000).repartition(7, "id"), f"{scratch}/queue", "p", 0)
    assert not _left(spark, before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
