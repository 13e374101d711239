"""Registered queries: each builds a DataFrame with the library over the fixture views of the driver tables.

``QUERIES[name](spark, sf_dir)`` is the Spark job; ``ORACLE[name]`` is an independent DuckDB formulation over the
same tables (``fixtures.DUCK_VIEWS``, optionally more CTEs, then a final SELECT). Column names and types are aligned
on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import events as ev
from granary.functions import granules as gr
from granary.functions import paths as pth
from granary.operators import feed, inventory, replay, reporting, routing
from granary.plans import fixtures as fx
from granary.plans import jobs
from granary.session import configure, released_shuffles, scratch_path
from granary.sources import inventory as inv_src
from granary.sources import joblogs, logtable, queues, snapshot
from granary.sources import progress as prog
from granary.streaming import monitor
from granary.streaming import replay_state
from granary.streaming import requeue as requeue_stream

FEED_N = 50
REDRIVE_LIMIT = 500
MAX_ATTEMPTS = 3
OUTPUT_BUCKET = "output-bucket"
GATE_THRESHOLDS = (200, 1_000_000)
JOB_DEFINITION = fx.PROCESSING_DEFINITION
MAIN_QUEUE = fx.MAIN_QUEUE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = fx.DUCK_VIEWS + oracle
        return run

    return wrap


def env_text(env: str = "environment"):
    """Environment pairs as ``NAME=value;...`` text (compared as a string by the oracle)."""
    return F.array_join(F.transform(F.col(env), lambda e: F.concat(e["name"], F.lit("="), e["value"])), ";")


# DuckDB fragments shared by several oracles ---------------------------------------------------------------------------
_LATEST = """
 select max_by(outcome, attempt * 10 + case outcome when 'success' then 1 else 0 end) outcome,
  min(platform) platform, date_trunc('year', min(acquisition_date)) as year
 from current_logs group by granule_id
"""
_REPORT = f"""
, report as (select platform, outcome, year, count(*) granule_count from ({_LATEST}) t group by platform, outcome, year)
"""
_PARSED_INVENTORY = r"""
, parsed as (
 select inventory,
  regexp_extract(value, '^(\S+)\s(.*)\s(\S+)\s(t|f)$', 1) granule_id,
  regexp_extract(value, '^(\S+)\s(.*)\s(\S+)\s(t|f)$', 2) raw_dt,
  regexp_extract(value, '^(\S+)\s(.*)\s(\S+)\s(t|f)$', 3) status,
  regexp_extract(value, '^(\S+)\s(.*)\s(\S+)\s(t|f)$', 4) = 't' published
 from raw_inventory),
typed as (
 select inventory, granule_id,
  case when raw_dt = chr(92)||'N' then null
   else cast(replace(replace(raw_dt, chr(92)||' ', ' '), '+00', '') as timestamp) end start_datetime,
  status, published
 from parsed),
conv as (
 select *, row_number() over (partition by inventory order by start_datetime desc nulls last, granule_id) - 1 inventory_seq
 from typed where status = 'completed'),
counts as (select inventory, count(*) total_count from conv group by inventory),
prog as (
 select inventory,
  case when inventory like 'a-%' then total_count when inventory like 'b-%' then total_count // 2 else 0 end submitted_count,
  total_count
 from counts),
chosen as (select * from prog where submitted_count <> total_count order by inventory limit 1)
"""
_CLASSIFIED = """
, terminal as (
 select * from job_details
 where source = 'aws.batch' and job_queue = 'queue/main' and job_definition like '%processing%'
   and status in ('FAILED', 'SUCCEEDED')),
classified as (
 select t.*,
  case when exit_code = 0 then 'SUCCESS'
       when exit_code is null and status_reason like 'Host EC2%' then 'FAILURE_RETRYABLE'
       else 'FAILURE_NONRETRYABLE' end job_outcome2,
  cast(n_attempts as integer) job_attempts, cast(coalesce(retry_attempts, 1) as integer) max_attempts
 from terminal t),
routed as (
 select c.*,
  case when job_outcome2 = 'SUCCESS' then 'success' else 'failure' end outcome,
  case when job_outcome2 = 'FAILURE_RETRYABLE' and job_attempts = max_attempts then 'retry'
       when job_outcome2 = 'FAILURE_NONRETRYABLE' then 'failure' else 'none' end route,
  '{"granule_id":"' || granule_id || '","attempt":' || cast(attempt as varchar) || ',"debug_bucket":null}' body
 from classified c),
queue_msgs as (
 select id message_id, body, case route when 'retry' then 'RETRYABLE' else 'NONRETRYABLE' end failure_type, route,
  stopped_ms, seq, k, granule_id
 from routed where route in ('retry', 'failure')),
r_replay as (
 select *, min(case when job_outcome2 = 'SUCCESS' then seq end)
   over (partition by granule_id order by seq rows between current row and unbounded following) nsucc
 from routed),
r_ranked as (
 select r.*, case when nsucc is not null then 'success' else 'failure' end cur_outcome,
  row_number() over (partition by granule_id, nsucc is not null, attempt
   order by case when job_outcome2 <> 'SUCCESS' and nsucc is not null then nsucc else seq end desc,
            case when job_outcome2 <> 'SUCCESS' and nsucc is not null then 1 else 0 end desc, seq desc) rn
 from r_replay r),
r_current as (select * from r_ranked where rn = 1),
failures_pick as (
 select granule_id, min(platform) platform, min(strptime(ymd, '%Y-%m-%d')) acquisition_date,
  arg_max({'attempt': attempt, 'exit_code': exit_code, 'started_ms': started_ms, 'stopped_ms': stopped_ms,
           'status_reason': status_reason, 'id': id, 'ymd': ymd, 'platform': platform}, attempt) n
 from r_current where cur_outcome = 'failure' group by granule_id),
failures as (
 select 'failure' outcome, platform, acquisition_date, granule_id, n.attempt attempt, n.exit_code exit_code,
  make_timestamp((n.started_ms // 1000) * 1000000) started_at, make_timestamp((n.stopped_ms // 1000) * 1000000) stopped_at,
  n.status_reason status_reason, 'processing/default/' || n.id logstream_name,
  'logs/outcome=failure/platform=' || n.platform || '/acquisition_date=' || n.ymd || '/granule_id=' || granule_id
   || '/attempt=' || cast(n.attempt as varchar) || '.json' key
 from failures_pick),
retry_input as (
 select message_id,
  case when k % 13 = 0 then 'not-json ' || granule_id else body end body, failure_type
 from queue_msgs where route = 'retry')
"""


# ---------------------------------------------------------------------------------------------------------------------
# Log replay and reports


def _report_events(spark: SparkSession, sf_dir: str, with_date: bool = True) -> DataFrame:
    cols = ["granule_id", "attempt", "job_outcome", "seq", "platform"] + (["acquisition_date"] if with_date else [])
    return fx.job_events(spark, sf_dir).select(*cols)


@register("progress_by_year", f"""
select platform, outcome, year, count(*) granule_count from ({_LATEST}) t
group by platform, outcome, year order by year desc, platform, outcome desc
""")
def progress_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: granule count per platform, latest outcome and acquisition year, from the attempt history."""
    return reporting.progress_by_year_from_events(_report_events(spark, sf_dir))


@register("progress_by_year_replayed", f"""
select platform, outcome, year, count(*) granule_count from ({_LATEST}) t
group by platform, outcome, year order by year desc, platform, outcome desc
""")
def progress_by_year_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly report over the replayed log state (W1 -> A3 -> A5), the form used on stored log objects."""
    return reporting.progress_by_year(fx.current_logs(spark, sf_dir, extra=["platform", "acquisition_date"]))


@register("overall_status", f"""
select platform, outcome, count(*) granule_count from ({_LATEST}) t group by platform, outcome
""")
def overall_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.overall_status_from_events(_report_events(spark, sf_dir, with_date=False))


@register("current_job_logs", """
select granule_id, outcome, attempt, job_outcome, seq, nsucc, platform from current_logs
""")
def current_job_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = fx.current_logs(spark, sf_dir, extra=["platform"])
    return logs.select("granule_id", "outcome", "attempt", "job_outcome", "seq", "nsucc", "platform")


@register("attempt_history", """
select granule_id, outcome, string_agg(cast(attempt as varchar), ',' order by attempt) attempts
from current_logs group by granule_id, outcome
""")
def attempt_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = replay.attempt_history(fx.current_logs(spark, sf_dir))
    as_text = F.array_join(F.transform("attempts", lambda a: a.cast("string")), ",")
    return h.select("granule_id", "outcome", as_text.alias("attempts"))


@register("event_lookup", """
, req as (select granule_id, seq, attempt + case when seq % 5 = 0 then 1 else 0 end attempt from job_events),
best as (
 select granule_id, attempt,
  arg_max(outcome, case when outcome = 'success' then 1 else 0 end) outcome,
  arg_max(job_outcome, case when outcome = 'success' then 1 else 0 end) job_outcome
 from current_logs group by granule_id, attempt)
select r.granule_id, r.seq, r.attempt, b.outcome, b.job_outcome, b.outcome is not null found
from req r left join best b on r.granule_id = b.granule_id and r.attempt = b.attempt
""")
def event_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look up (granule, attempt) requests in the log: success first, then failure; ``found`` false if neither."""
    events = fx.job_events(spark, sf_dir)
    requests = events.select(
        "granule_id", "seq", (F.col("attempt") + F.when(F.col("seq") % 5 == 0, 1).otherwise(0)).alias("attempt")
    )
    return replay.lookup_events(requests, fx.current_logs(spark, sf_dir)).select(
        "granule_id", "seq", "attempt", "outcome", "job_outcome", "found"
    )


@register("report_grid", f"""
{_REPORT},
bounds as (select min(year) lo, max(year) hi from report),
years as (select unnest(generate_series(lo, hi, interval 1 year)) as year from bounds),
grid as (select year, platform, outcome from years, (values ('L30'), ('S30')) p(platform),
         (values ('success'), ('failure')) o(outcome))
select g.year, g.platform, g.outcome, r.granule_count
from grid g left join report r on g.year = r.year and g.platform = r.platform and g.outcome = r.outcome
""")
def report_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense (year x platform x outcome) grid of the yearly report; missing cells are null."""
    report = reporting.progress_by_year_from_events(_report_events(spark, sf_dir))
    return reporting.report_grid(report)


@register("report_pivot", f"""
{_REPORT},
bounds as (select min(year) lo, max(year) hi from report),
years as (select unnest(generate_series(lo, hi, interval 1 year)) as year from bounds)
select y.year, cast(coalesce(sum(case when platform = 'L30' then granule_count end), 0) as bigint) "L30",
 cast(coalesce(sum(case when platform = 'S30' then granule_count end), 0) as bigint) "S30"
from years y left join report r on r.year = y.year and r.outcome = 'success' group by y.year
""")
def report_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Success counts per year, one column per platform (chart data); every year from the first to the last one."""
    report = reporting.progress_by_year_from_events(_report_events(spark, sf_dir))
    return reporting.report_pivot(reporting.report_grid(report))


@register("report_year_bounds", f"""
{_REPORT}
select min(year) min_year, max(year) max_year from report
""")
def report_year_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.year_bounds(reporting.progress_by_year_from_events(_report_events(spark, sf_dir)))


# ---------------------------------------------------------------------------------------------------------------------
# Granule IDs and log keys


@register("granule_parts", """
, p as (select granule_id, string_split(granule_id, '.') s from granule_ids)
select granule_id, s[1] product, s[2] platform, s[3] tile, strptime(s[4], '%Y%jT%H%M%S') begin_datetime,
 s[5] || '.' || s[6] version, strftime(strptime(s[4], '%Y%jT%H%M%S'), '%Y-%m-%d') acquisition_date
from p
""")
def granule_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = fx.granule_ids(spark, sf_dir).select("granule_id")
    parts = gr.granule_parts("granule_id")
    return g.select(
        "granule_id",
        parts.getField("product").alias("product"),
        parts.getField("platform").alias("platform"),
        parts.getField("tile").alias("tile"),
        parts.getField("begin_datetime").alias("begin_datetime"),
        parts.getField("version").alias("version"),
        gr.acquisition_date("granule_id").alias("acquisition_date"),
    )


@register("granule_roundtrip", """
, p as (select granule_id, string_split(granule_id, '.') s from granule_ids),
r as (select granule_id, s[1] || '.' || s[2] || '.' || s[3] || '.' ||
   strftime(strptime(s[4], '%Y%jT%H%M%S'), '%Y%jT%H%M%S') || '.' || s[5] || '.' || s[6] recomposed from p)
select granule_id, recomposed, recomposed = granule_id same from r
""")
def granule_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = fx.granule_ids(spark, sf_dir).select("granule_id", gr.granule_parts("granule_id").alias("p"))
    recomposed = gr.compose_granule_id("p.product", "p.platform", "p.tile", "p.begin_datetime", "p.version")
    return g.select("granule_id", recomposed.alias("recomposed")).withColumn(
        "same", F.col("recomposed") == F.col("granule_id")
    )


@register("log_paths", """
select granule_id, outcome, attempt,
 'logs/outcome=' || outcome || '/platform=' || platform || '/acquisition_date=' || ymd || '/granule_id=' || granule_id
 || '/attempt=' || cast(attempt as varchar) || '.json' key
from current_logs
""")
def log_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = fx.current_logs(spark, sf_dir).select("granule_id", "outcome", "attempt")
    return routing.with_log_key(logs, "logs")


@register("parse_log_paths_strict", """
select 'logs/outcome=' || outcome || '/platform=' || platform || '/acquisition_date=' || ymd || '/granule_id=' || granule_id
  || '/attempt=' || cast(attempt as varchar) || '.json' key,
 outcome, platform, ymd acquisition_date, granule_id, attempt
from current_logs
""")
def parse_log_paths_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the log taken apart again; a key that does not match fails the query."""
    keys = routing.with_log_key(fx.current_logs(spark, sf_dir).select("granule_id", "outcome", "attempt"), "logs").select("key")
    return keys.select("key", pth.parse_log_key("key", prefix="logs", strict=True).alias("p")).select("key", "p.*")


@register("parse_log_paths", r"""
, keys as (select distinct key from log_snapshot where dt = (select max(dt) from log_snapshot)),
m as (select key, regexp_matches(substr(key, 6), '^outcome=(\w+)/platform=(\w+)/acquisition_date=([\d-]+)/granule_id=([\w\.]+)/attempt=([0-9]+)\.json$') ok,
      regexp_extract(substr(key, 6), '^outcome=(\w+)/platform=(\w+)/acquisition_date=([\d-]+)/granule_id=([\w\.]+)/attempt=([0-9]+)\.json$', ['o','p','a','g','t']) x
      from keys)
select key,
 case when ok then x.o end outcome, case when ok then x.p end platform, case when ok then x.a end acquisition_date,
 case when ok then x.g end granule_id, case when ok then try_cast(x.t as integer) end attempt,
 regexp_matches(string_split(key, '/')[-1], '^attempt=[0-9]+\.json$') is_attempt_file
from m
""")
def parse_log_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict key parser in quarantine mode (null on a miss) over the distinct keys of the newest listing."""
    snap = fx.log_snapshot(spark, sf_dir)
    newest = snap.select(F.max("dt")).scalar()
    keys = snap.filter(F.col("dt") == newest).select("key").distinct()
    parsed = pth.parse_log_key("key", prefix="logs", strict=False)
    return keys.select(
        "key",
        *[parsed.getField(f).alias(f) for f in ("outcome", "platform", "acquisition_date", "granule_id", "attempt")],
        pth.is_attempt_file("key").alias("is_attempt_file"),
    )


_VIEW_SQL = r"""
, v as (
 select nullif(regexp_extract(key, 'outcome=(\w+)', 1), '') outcome,
  nullif(regexp_extract(key, 'platform=(\w+)', 1), '') platform,
  strptime(nullif(regexp_extract(key, 'acquisition_date=([\d-]+)', 1), ''), '%Y-%m-%d') acquisition_date,
  nullif(regexp_extract(key, 'granule_id=([\w\.]+)', 1), '') granule_id,
  cast(nullif(regexp_extract(key, 'attempt=([0-9]+)', 1), '') as integer) attempt,
  last_modified_date, key
 from log_snapshot
 where dt = (select max(dt) from log_snapshot) and is_latest and not is_delete_marker)
"""


@register("processing_events_view", _VIEW_SQL + """
select * from v
""")
def processing_events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.processing_events_view(fx.log_snapshot(spark, sf_dir))


@register("status_from_snapshot", _VIEW_SQL + """
select platform, outcome, count(*) granule_count from (
 select max_by(outcome, attempt * 10 + case outcome when 'success' then 1 else 0 end) outcome, min(platform) platform
 from v group by granule_id) t group by platform, outcome
""")
def status_from_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overall status report over the listing view (the form the status report runs in production)."""
    view = reporting.processing_events_view(fx.log_snapshot(spark, sf_dir))
    return reporting.overall_status(view.drop("last_modified_date"))


# ---------------------------------------------------------------------------------------------------------------------
# Inventory conversion and feed


@register("inventory_parse", _PARSED_INVENTORY + """
select inventory, granule_id, start_datetime, status, published from typed
""")
def inventory_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.parse_inventory(fx.raw_inventory(spark, sf_dir))


@register("inventory_convert", _PARSED_INVENTORY + """
select inventory, granule_id, start_datetime, status, published, inventory_seq from conv
""")
def inventory_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(spark, sf_dir)


def _converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.convert_inventory(fx.raw_inventory(spark, sf_dir))


@register("inventory_monthly", _PARSED_INVENTORY + """
select inventory, cast(year(start_datetime) as smallint) "year", cast(month(start_datetime) as smallint) "month",
 count(*) granule_count, min(inventory_seq) first_seq, max(inventory_seq) last_seq
from conv group by all
""")
def inventory_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = inventory.monthly_layout(_converted(spark, sf_dir))
    return staged.groupBy("inventory", "year", "month").agg(
        F.count(F.lit(1)).alias("granule_count"), F.min("inventory_seq").alias("first_seq"),
        F.max("inventory_seq").alias("last_seq"),
    )


@register("inventory_counts", _PARSED_INVENTORY + """
select inventory, cast(0 as bigint) submitted_count, total_count from counts
""")
def inventory_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory_counts(_converted(spark, sf_dir))


def _progress(spark: SparkSession, sf_dir: str, converted: DataFrame) -> DataFrame:
    """Progress fixture: listing a done, b half way, c not started."""
    counts = inventory.inventory_counts(converted)
    t = F.col("total_count")
    submitted = (
        F.when(F.col("inventory").startswith("a-"), t).when(F.col("inventory").startswith("b-"), F.expr("total_count div 2"))
        .otherwise(F.lit(0).cast("bigint"))
    )
    return counts.select("inventory", submitted.alias("submitted_count"), "total_count")


@register("next_batch", _PARSED_INVENTORY + f"""
select c.granule_id, 0 attempt, c.inventory, c.inventory_seq
from conv c join chosen p on c.inventory = p.inventory
where c.inventory_seq >= p.submitted_count and c.inventory_seq < least(p.submitted_count + {FEED_N}, p.total_count)
  and c.status = 'completed'
""")
def next_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = _converted(spark, sf_dir)
    events, _ = feed.next_batch(conv, _progress(spark, sf_dir, conv), FEED_N)
    return events


@register("feed_progress", _PARSED_INVENTORY + f"""
select p.inventory,
 case when p.inventory = c.inventory then least(p.submitted_count + {FEED_N}, p.total_count) else p.submitted_count end
   submitted_count,
 p.total_count,
 (case when p.inventory = c.inventory then least(p.submitted_count + {FEED_N}, p.total_count) else p.submitted_count end)
   = p.total_count is_complete
from prog p left join chosen c on p.inventory = c.inventory
""")
def feed_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = _converted(spark, sf_dir)
    _, advanced = feed.next_batch(conv, _progress(spark, sf_dir, conv), FEED_N)
    return feed.is_complete(advanced)


@register("feed_plan", _PARSED_INVENTORY + f"""
, rows_left as (
 select c.inventory, c.inventory_seq, c.status, p.submitted_count, p.total_count,
  (c.inventory_seq - p.submitted_count) // {FEED_N} batch_no
 from conv c join prog p on c.inventory = p.inventory where c.inventory_seq >= p.submitted_count),
batches as (
 select inventory, batch_no, min(submitted_count) + batch_no * {FEED_N} first_seq,
  least(min(submitted_count) + (batch_no + 1) * {FEED_N}, min(total_count)) end_seq,
  count(*) filter (where status = 'completed') n_granules
 from rows_left group by inventory, batch_no),
runs as (
 select inventory, coalesce(sum(cast(ceil((total_count - submitted_count) / {FEED_N}.0) as bigint))
   over (order by inventory rows between unbounded preceding and 1 preceding), 0) run0 from prog)
select b.inventory, b.batch_no, cast(r.run0 + b.batch_no as bigint) run_no, b.first_seq, b.end_seq, b.n_granules
from batches b join runs r on b.inventory = r.inventory
""")
def feed_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = _converted(spark, sf_dir)
    return feed.feed_plan(conv, _progress(spark, sf_dir, conv), FEED_N)


@register("feed_all_complete", _PARSED_INVENTORY + """
select coalesce(bool_and(submitted_count = total_count), true) all_complete from prog
""")
def feed_all_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = _converted(spark, sf_dir)
    return feed.all_complete(_progress(spark, sf_dir, conv))


@register("backpressure_gate", "\n union all ".join(
    f"""select {t} threshold, cast(least(count(*), {t}) as bigint) active_seen, least(count(*), {t}) < {t} below_threshold
 from job_details where status in ('SUBMITTED', 'PENDING', 'RUNNABLE', 'STARTING', 'RUNNING')"""
    for t in GATE_THRESHOLDS
).replace("select", "\nselect", 1))
def backpressure_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    summaries = fx.job_details_flat(spark, sf_dir).select(F.col("id").alias("job_id"), "status")
    gates = [feed.active_jobs_below(summaries, t) for t in GATE_THRESHOLDS]
    out = gates[0]
    for g in gates[1:]:
        out = out.unionByName(g)
    return out


@register("work_requests", _PARSED_INVENTORY + f"""
select c.granule_id, 0 attempt, replace(c.granule_id, '.', '-') || '_0' job_name, '{OUTPUT_BUCKET}' target_bucket,
 'OUTPUT_BUCKET={OUTPUT_BUCKET};GRANULE_ID=' || c.granule_id || ';ATTEMPT=0' env
from conv c join chosen p on c.inventory = p.inventory
where c.inventory_seq >= p.submitted_count and c.inventory_seq < least(p.submitted_count + {FEED_N}, p.total_count)
  and c.status = 'completed'
""")
def work_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed run (gate open): requests for the next slice, attempt 0, written to the output bucket."""
    conv = _converted(spark, sf_dir)
    summaries = fx.job_details_flat(spark, sf_dir).select(F.col("id").alias("job_id"), "status")
    requests, _ = feed.feed_run(conv, _progress(spark, sf_dir, conv), summaries, FEED_N, GATE_THRESHOLDS[-1],
                                OUTPUT_BUCKET)
    return requests.select("granule_id", "attempt", "job_name", "target_bucket", env_text().alias("env"))


# ---------------------------------------------------------------------------------------------------------------------
# Job outcomes, routing, failure view, re-drive and requeue


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.state_change_events(spark, sf_dir)


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.classify(routing.terminal_events(_events(spark, sf_dir), MAIN_QUEUE, JOB_DEFINITION))


@register("job_outcomes", """
select id, granule_id, attempt, cast(n_attempts as integer) job_attempts, cast(coalesce(retry_attempts, 1) as integer) max_attempts,
 exit_code, status_reason,
 case when exit_code = 0 then 'SUCCESS' when exit_code is null and status_reason like 'Host EC2%' then 'FAILURE_RETRYABLE'
      else 'FAILURE_NONRETRYABLE' end job_outcome,
 case when exit_code = 0 then 'success' else 'failure' end outcome
from job_details
""")
def job_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = routing.classify(_events(spark, sf_dir))
    return c.select("id", "granule_id", "attempt", "job_attempts", "max_attempts", "exit_code", "status_reason",
                    "job_outcome", "outcome")


@register("routed_events", _CLASSIFIED + """
select id, granule_id, attempt, job_outcome2 job_outcome, outcome, route from routed
""")
def routed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select("id", "granule_id", "attempt", "job_outcome", "outcome", "route")


@register("queue_messages", _CLASSIFIED + """
select message_id, body, failure_type from queue_msgs
""")
def queue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry and failure table rows the monitor writes for the terminal events."""
    routed = _routed(spark, sf_dir)
    return routing.queue_rows(routed, "retry", "failure")


def _job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current outcome log of the monitored events, in the log table layout (with object keys).

    Only the last try of each job document is carried through the replay's shuffles: it is all the failure view
    reads, and the full document (arrays of nested structs) would dominate the shuffled bytes.
    """
    logs = routing.log_rows(_routed(spark, sf_dir), order="seq")
    last_try = F.struct(F.slice(F.col("job_info.attempts"), -1, 1).alias("attempts"))
    logs = logs.withColumn("job_info", last_try)
    current = replay.current_job_logs(logs, order="seq", of_key=["platform", "acquisition_date"], fetch=False)
    return routing.with_log_key(current, "logs")


@register("failures_view", _CLASSIFIED + """
select * from failures
""")
def failures_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.failures_view(_job_log(spark, sf_dir))


@register("redrive_queue", _CLASSIFIED + f"""
select message_id, body, failure_type from queue_msgs where route = 'failure' order by message_id limit {REDRIVE_LIMIT}
""")
def redrive_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure-table messages moved to the retry table by a re-drive with a limit."""
    failures = routing.queue_rows(_routed(spark, sf_dir), "failure")
    moved, _ = routing.redrive_queue(failures, REDRIVE_LIMIT)
    return moved


@register("redrive_remaining", _CLASSIFIED + f"""
, moved as (select message_id from queue_msgs where route = 'failure' order by message_id limit {REDRIVE_LIMIT})
select message_id, body, failure_type from queue_msgs
where route = 'failure' and message_id not in (select message_id from moved)
""")
def redrive_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = routing.queue_rows(_routed(spark, sf_dir), "failure")
    _, remaining = routing.redrive_queue(failures, REDRIVE_LIMIT)
    return remaining


@register("redrive_logs", _CLASSIFIED + f"""
select granule_id, attempt,
 '{{"granule_id":"' || granule_id || '","attempt":' || cast(attempt as varchar) || ',"debug_bucket":null}}' body,
 'NONRETRYABLE' failure_type
from failures where attempt < {MAX_ATTEMPTS}
""")
def redrive_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-drive from the failure view: newest failed attempt below the attempt cap, attempt unchanged."""
    return routing.redrive_logs(reporting.failures_view(_job_log(spark, sf_dir)), MAX_ATTEMPTS)


def _retry_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry-table messages, some of them unreadable (not JSON) to exercise the reject path."""
    retry = _routed(spark, sf_dir).filter(F.col("route") == "retry")
    body = F.when(F.col("k") % 13 == 0, F.concat(F.lit("not-json "), F.col("granule_id"))).otherwise(
        ev.event_to_json("granule_id", "attempt")
    )
    return retry.select(F.col("id").alias("message_id"), body.alias("body"), F.lit("RETRYABLE").alias("failure_type"))


_REQUEUE_SQL = f"""
, good as (
 select message_id, json_extract_string(body, '$.granule_id') granule_id,
  cast(json_extract(body, '$.attempt') as integer) + 1 attempt
 from retry_input where json_valid(body) and body like '{{%')
select message_id, granule_id, attempt, replace(granule_id, '.', '-') || '_' || cast(attempt as varchar) job_name,
 '{OUTPUT_BUCKET}' target_bucket,
 'OUTPUT_BUCKET={OUTPUT_BUCKET};GRANULE_ID=' || granule_id || ';ATTEMPT=' || cast(attempt as varchar) env
from good
"""
_REJECTS_SQL = """
select message_id, body, failure_type from retry_input where not (json_valid(body) and body like '{%')
"""


@register("requeue", _CLASSIFIED + _REQUEUE_SQL)
def requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, _ = routing.requeue(_retry_input(spark, sf_dir))
    req = feed.work_requests(events, OUTPUT_BUCKET, keep=["message_id"])
    return req.select("message_id", "granule_id", "attempt", "job_name", "target_bucket", env_text().alias("env"))


@register("requeue_rejects", _CLASSIFIED + _REJECTS_SQL)
def requeue_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = routing.requeue(_retry_input(spark, sf_dir))
    return bad.select("message_id", "body", "failure_type")


@register("retention", _CLASSIFIED + """
, q as (select message_id, failure_type, make_timestamp((stopped_ms // 1000) * 1000000) enqueued_at from queue_msgs)
select * from q where enqueued_at >= (select max(enqueued_at) from q) - interval 14 days
""")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue rows kept by the 14-day retention, relative to the newest row."""
    routed = _routed(spark, sf_dir)
    q = routed.filter(F.col("route").isin("retry", "failure")).select(
        F.col("id").alias("message_id"),
        F.when(F.col("route") == "retry", "RETRYABLE").otherwise("NONRETRYABLE").alias("failure_type"),
        F.timestamp_seconds(F.expr("job_info.stoppedAt div 1000")).alias("enqueued_at"),
    )
    newest = q.select(F.max("enqueued_at")).scalar()
    return reporting.retention(q, "enqueued_at", 14, as_of=newest)


# ---------------------------------------------------------------------------------------------------------------------
# Event encodings and object URIs


def _debug_bucket():
    return F.when(F.col("k") % 3 == 0, F.concat(F.lit("debug-"), F.lower("platform")))


@register("event_env_roundtrip", """
, e as (select k, seq, granule_id, attempt, case when k % 3 = 0 then 'debug-' || lower(platform) end debug_bucket
        from job_events)
select k, seq, granule_id, attempt, debug_bucket,
 'GRANULE_ID=' || granule_id || ';ATTEMPT=' || cast(attempt as varchar)
   || coalesce(';DEBUG_BUCKET=' || debug_bucket, '') env,
 granule_id rt_granule_id, attempt rt_attempt, debug_bucket rt_debug_bucket
from e
""")
def event_env_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.job_events(spark, sf_dir).select("k", "seq", "granule_id", "attempt", _debug_bucket().alias("debug_bucket"))
    with_env = e.withColumn("environment", ev.event_to_env("granule_id", "attempt", "debug_bucket"))
    back = ev.env_to_event("environment")
    return with_env.select(
        "k", "seq", "granule_id", "attempt", "debug_bucket", env_text().alias("env"),
        back.getField("granule_id").alias("rt_granule_id"), back.getField("attempt").alias("rt_attempt"),
        back.getField("debug_bucket").alias("rt_debug_bucket"),
    )


@register("event_json_roundtrip", """
, e as (select k, seq, granule_id, attempt, case when k % 3 = 0 then 'debug-' || lower(platform) end debug_bucket
        from job_events)
select k, seq,
 '{"granule_id":"' || granule_id || '","attempt":' || cast(attempt as varchar) || ',"debug_bucket":'
   || coalesce('"' || debug_bucket || '"', 'null') || '}' body,
 granule_id rt_granule_id, attempt + 1 next_attempt, debug_bucket rt_debug_bucket
from e
""")
def event_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.job_events(spark, sf_dir).select("k", "seq", "granule_id", "attempt", _debug_bucket().alias("debug_bucket"))
    with_body = e.withColumn("body", ev.event_to_json("granule_id", "attempt", "debug_bucket"))
    back = ev.event_from_json("body")
    nxt = ev.next_attempt(back)
    return with_body.select(
        "k", "seq", "body", back.getField("granule_id").alias("rt_granule_id"),
        nxt.getField("attempt").alias("next_attempt"), back.getField("debug_bucket").alias("rt_debug_bucket"),
    )


@register("object_uri_parts", r"""
, u as (select case when k % 50 = 0 then 'file:///local/' || granule_id || '.txt'
   else 's3://data-' || lower(platform) || '/inventories/' || ymd || '/' || granule_id || '.txt' end uri from granule_ids)
select uri, nullif(regexp_extract(uri, '^s3://([^/]+)/(.*)$', 1), '') bucket,
 case when regexp_matches(uri, '^s3://([^/]+)/(.*)$') then regexp_extract(uri, '^s3://([^/]+)/(.*)$', 2) end key,
 string_split(uri, '/')[-1] identifier
from u
""")
def object_uri_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = fx.granule_ids(spark, sf_dir)
    uri = F.when(F.col("k") % 50 == 0, F.concat(F.lit("file:///local/"), "granule_id", F.lit(".txt"))).otherwise(
        F.concat(F.lit("s3://data-"), F.lower("platform"), F.lit("/inventories/"), "ymd", F.lit("/"), "granule_id",
                 F.lit(".txt"))
    )
    u = g.select(uri.alias("uri"))
    return u.select("uri", pth.uri_bucket("uri").alias("bucket"), pth.uri_key("uri").alias("key"),
                    pth.inventory_identifier("uri").alias("identifier"))


# ---------------------------------------------------------------------------------------------------------------------
# Streams (S9-S11, T1-T4, T7): fixture events land as files in a scratch folder of the shared checkpoint directory,
# the stream drains them (availableNow), and the query reads what the sinks hold.


# documents land compressed, some MB a file, and a micro-batch takes many such files
_LANDED = {"compression": "gzip", "maxRecordsPerFile": 100_000}


def _run_monitor(spark: SparkSession, sf_dir: str) -> monitor.MonitorSinks:
    base = scratch_path(spark, "monitor")
    incoming = f"{base}/incoming"
    with released_shuffles(spark):
        _events(spark, sf_dir).write.options(**_LANDED).json(incoming)
    return _drain_monitor(spark, base, incoming)


def _drain_monitor(spark: SparkSession, base: str, incoming: str) -> monitor.MonitorSinks:
    sinks = monitor.MonitorSinks(f"{base}/log_events", f"{base}/retry", f"{base}/failure", f"{base}/rejects")
    stream = monitor.read_state_changes(spark, incoming, max_bytes_per_trigger=128 << 20, delete_read=True)
    q = monitor.start_monitor(stream, sinks, f"{base}/_checkpoint", MAIN_QUEUE, JOB_DEFINITION, available_now=True)
    q.awaitTermination()
    return sinks


@register("stream_monitor", _CLASSIFIED + """
select id, granule_id, attempt, job_outcome2 job_outcome, outcome, seq arrival from routed
""")
def stream_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitor stream: the append-only log events it wrote (one row per terminal event of our queue)."""
    sinks = _run_monitor(spark, sf_dir)
    logs = spark.read.parquet(sinks.log_events)
    return logs.select("id", "granule_id", "attempt", "job_outcome", "outcome", "arrival")


@register("stream_monitor_queues", _CLASSIFIED + """
select message_id, body, failure_type from queue_msgs
""")
def stream_monitor_queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitor stream: retry and failure table rows."""
    sinks = _run_monitor(spark, sf_dir)
    cols = ["message_id", "body", "failure_type"]
    return spark.read.parquet(sinks.retry).select(*cols).unionByName(spark.read.parquet(sinks.failure).select(*cols))


@register("stream_current_logs", _CLASSIFIED + """
select granule_id, cur_outcome outcome, attempt, job_outcome2 job_outcome, seq arrival, nsucc from r_current
""")
def stream_current_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current log state as a view over the stream's append-only event table (success supersedes, in arrival order)."""
    sinks = _run_monitor(spark, sf_dir)
    events = spark.read.parquet(sinks.log_events).select("granule_id", "attempt", "job_outcome", "arrival")
    current = replay.current_job_logs(events, order="arrival")
    return current.select("granule_id", "outcome", "attempt", "job_outcome", "arrival", "nsucc")


def _run_requeue(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    base = scratch_path(spark, "requeue")
    incoming = f"{base}/retry"
    _retry_input(spark, sf_dir).write.parquet(incoming)
    requests, rejects = f"{base}/requests", f"{base}/failure"
    stream = requeue_stream.read_retry_stream(spark, incoming)
    q = requeue_stream.start_requeue(stream, requests, rejects, f"{base}/_checkpoint", OUTPUT_BUCKET, available_now=True)
    q.awaitTermination()
    return requests, rejects


@register("stream_requeue", _CLASSIFIED + _REQUEUE_SQL)
def stream_requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requeue stream: next-attempt work requests written for readable retry messages."""
    requests, _ = _run_requeue(spark, sf_dir)
    req = spark.read.parquet(requests)
    return req.select("message_id", "granule_id", "attempt", "job_name", "target_bucket", env_text().alias("env"))


@register("stream_requeue_rejects", _CLASSIFIED + _REJECTS_SQL)
def stream_requeue_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requeue stream: unreadable messages set aside in the failure table."""
    _, rejects = _run_requeue(spark, sf_dir)
    return spark.read.parquet(rejects).select("message_id", "body", "failure_type")


@register("stream_state_replay", _CLASSIFIED + """
select granule_id, cur_outcome outcome, attempt, job_outcome2 job_outcome, seq arrival from r_current
""")
def stream_state_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log state kept as per-granule streaming state (T7, stateful form), from one ordered stream.

    The history lands once and one stream drains it; within a micro-batch a granule's events are applied in arrival
    order.
    """
    base = scratch_path(spark, "state-replay")
    incoming, sink = f"{base}/incoming", f"{base}/emissions"
    events = routing.log_rows(_routed(spark, sf_dir), order="seq")
    events.select("granule_id", "attempt", "job_outcome", F.col("seq").cast("bigint").alias("arrival"), F.col("job_info.jobId").alias("id")).write.parquet(incoming)
    stream = spark.readStream.schema("granule_id string, attempt int, job_outcome string, arrival bigint, id string").parquet(incoming)
    replay_state.start_state_replay(stream, sink, f"{base}/_checkpoint", available_now=True).awaitTermination()
    current = replay_state.current_from_emissions(spark.read.parquet(sink).drop("producer"))
    return current.select("granule_id", "outcome", "attempt", "job_outcome", "arrival")


# ---------------------------------------------------------------------------------------------------------------------
# Shared queue tables, log rewrites and rejects

_BODY = """'{"granule_id":"' || granule_id || '","attempt":' || cast(attempt as varchar) || ',"debug_bucket":null}'"""


@register("queue_shared", _CLASSIFIED + f"""
, rejects as (select message_id, body, failure_type from retry_input where not (json_valid(body) and body like '{{%')),
failed as (select message_id, body, failure_type from queue_msgs where route = 'failure' union all select * from rejects),
placed as (select *, row_number() over (order by message_id, body, failure_type) place from failed)
select 'retry' queue, message_id, body, failure_type from queue_msgs where route = 'retry'
union all select 'retry', message_id, body, failure_type from placed where place <= {REDRIVE_LIMIT}
union all select 'retry', 'redrive-1-' || granule_id, {_BODY}, 'NONRETRYABLE' from failures where attempt < {MAX_ATTEMPTS}
union all select 'failure', message_id, body, failure_type from placed where place > {REDRIVE_LIMIT}
""")
def queue_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitor, requeue rejects and both re-drives write the same two queue tables; every message is in one of them."""
    sinks = _run_monitor(spark, sf_dir)
    base = scratch_path(spark, "queue-shared")
    with released_shuffles(spark):
        _retry_input(spark, sf_dir).write.parquet(f"{base}/incoming")
    stream = requeue_stream.read_retry_stream(spark, f"{base}/incoming")
    requeue_stream.start_requeue(
        stream, f"{base}/requests", sinks.failure, f"{base}/_checkpoint", OUTPUT_BUCKET, available_now=True
    ).awaitTermination()
    _rewrite_logs(spark, sinks.log_events, f"{base}/logs")
    jobs.redrive_from_logs(spark, f"{base}/logs", sinks.retry, run_id=1, max_attempts=MAX_ATTEMPTS)
    jobs.redrive_from_queue(spark, sinks.failure, sinks.retry, run_id=1, limit=REDRIVE_LIMIT)
    cols = ["message_id", "body", "failure_type"]
    retry = queues.read_queue(spark, sinks.retry).select(F.lit("retry").alias("queue"), *cols)
    return retry.unionByName(queues.read_queue(spark, sinks.failure).select(F.lit("failure").alias("queue"), *cols))


def _by_month(logs: DataFrame) -> DataFrame:
    """Log rows under the first day of their month: the test tables have a few rows a day, so folders of single days would
    make the queries mostly create folders."""
    return logs.withColumn("acquisition_date", F.concat(F.substring("acquisition_date", 1, 8), F.lit("01")))


def _rewrite_logs(spark: SparkSession, events_path: str, logs_path: str) -> None:
    parts = jobs.current_parts(spark, events_path, block_size=replay.DEFAULT_BLOCK)
    joblogs.rewrite_job_logs([_by_month(routing.log_rows(part)) for part in parts], logs_path)


@register("log_rewrite", _CLASSIFIED + """
select granule_id, cur_outcome outcome, attempt, job_outcome2 job_outcome, platform, left(ymd, 8) || '01' acquisition_date
from r_current
""")
def log_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored log after two rewrites with successes in between, read back: superseded failures are gone."""
    base = scratch_path(spark, "log-rewrite")
    rows = routing.log_rows(_routed(spark, sf_dir), order="seq").withColumnRenamed("seq", "arrival")
    rows = rows.withColumn("id", F.col("job_info.jobId"))
    for batch, part in enumerate((F.col("arrival") <= 2, F.col("arrival") > 2)):
        queues.append_batch(rows.filter(part), f"{base}/events", "history", batch, order="acquisition_date")
        _rewrite_logs(spark, f"{base}/events", f"{base}/logs")
    logs = joblogs.read_job_logs(spark, f"{base}/logs")
    return logs.select("granule_id", "outcome", "attempt", "job_outcome", "platform", "acquisition_date")


@register("log_compaction", _CLASSIFIED + """
, batches as (
 select platform, ymd, max(case when seq <= 2 or ymd not like '1996%' then 0 when seq > 4 and ymd like '1996-01%' then 2 else 1 end) batch
 from routed group by platform, ymd)
select granule_id, cur_outcome outcome, attempt, job_outcome2 job_outcome, platform, ymd acquisition_date, cast(batch as bigint) "version"
from r_current join batches using (platform, ymd)
""")
def log_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after three batches with successes in between, each of which rewrites the days that it touches alone: equal to
    a replay of all events, and every document still in the version that last touched its day. The later batches bring
    attempts of one year, and of its first month."""
    base = scratch_path(spark, "log-compaction")
    rows = routing.log_rows(_routed(spark, sf_dir), order="seq").withColumnRenamed("seq", "arrival")
    rows = rows.withColumn("id", F.col("job_info.jobId"))
    seq, day = F.col("arrival"), F.col("acquisition_date")
    batch_of = F.when((seq <= 2) | ~day.startswith("1996"), 0).when((seq > 4) & day.startswith("1996-01"), 2).otherwise(1)
    for batch in range(3):
        queues.append_batch(rows.filter(batch_of == batch), f"{base}/events", "history", batch, order="acquisition_date")
        jobs.compact_logs(spark, f"{base}/events", f"{base}/logs", block_size=replay.DEFAULT_BLOCK, keep=1 if batch == 2 else None)
    logs = logtable.read(spark, f"{base}/logs")
    number = F.split_part("version", F.lit("-"), F.lit(1)).cast("long").alias("version")
    return logs.select("granule_id", "outcome", "attempt", "job_outcome", "platform", "acquisition_date", number)


@register("job_log_files", _CLASSIFIED + """
select granule_id, cur_outcome outcome, attempt, platform, ymd acquisition_date, job_outcome2 job_outcome,
 'outcome=' || cur_outcome || '/platform=' || platform || '/acquisition_date=' || ymd folder
from r_current
""")
def job_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log documents written to their folders and read back, with the folder from each document's path."""
    path = scratch_path(spark, "job-log-files")
    joblogs.write_job_logs(_job_log(spark, sf_dir).drop("key"), path)
    logs = joblogs.read_job_logs(spark, path)
    folder = F.regexp_extract("key", "(outcome=.*)/[^/]+$", 1).alias("folder")
    return logs.select("granule_id", "outcome", "attempt", "platform", "acquisition_date", "job_outcome", folder)


@register("history_of_one", """
select outcome, string_agg(cast(attempt as varchar), ',' order by attempt) attempts
from current_logs where granule_id = (select min(granule_id) from current_logs) group by outcome
""")
def history_of_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempt history of one granule, the first by name."""
    logs = fx.current_logs(spark, sf_dir)
    first = fx.granule_ids(spark, sf_dir).join(fx.job_events(spark, sf_dir).select("k").distinct(), "k", "left_semi")
    history = replay.history_for(logs, first.agg(F.min("granule_id")).first()[0])
    return history.select("outcome", F.array_join(F.transform("attempts", lambda a: a.cast("string")), ",").alias("attempts"))


@register("stream_monitor_rejects", _CLASSIFIED + """
select case when k % 29 = 0 then 'no JSON document' else 'no granule or attempt' end reason, id from (
 select id, k, source, status, job_queue, job_definition from job_details) d
where k % 29 = 0 or (k % 31 = 0 and source = 'aws.batch' and job_queue = 'queue/main'
 and job_definition like '%processing%' and status in ('FAILED', 'SUCCEEDED'))
union all
select 'logged', id from routed where k % 29 <> 0 and k % 31 <> 0
""")
def stream_monitor_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitor stream over events of which some are cut off and some name no attempt: logged or rejected, none lost."""
    base = scratch_path(spark, "monitor-rejects")
    nameless = F.transform("detail.container.environment", lambda e: e.withField("name", F.concat(F.lit("X_"), e["name"])))
    container = F.when(F.col("k") % 31 == 0, F.col("detail.container").withField("environment", nameless)).otherwise(F.col("detail.container"))
    events = _events(spark, sf_dir).withColumn("detail", F.col("detail").withField("container", container))
    text = F.to_json(F.struct(*[c for c in events.columns if c != "k"]))
    cut = F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", "detail": {'))
    events.select(F.when(F.col("k") % 29 == 0, cut).otherwise(text).alias("value")).write.options(**_LANDED).text(f"{base}/incoming")
    sinks = _drain_monitor(spark, base, f"{base}/incoming")
    rejects = spark.read.schema("reason string, document string").parquet(sinks.rejects)
    rejects = rejects.select("reason", F.regexp_extract("document", r'"id": ?"([^"]+)"', 1).alias("id"))
    return rejects.unionByName(spark.read.parquet(sinks.log_events).select(F.lit("logged").alias("reason"), "id"))


@register("retention_queue", _CLASSIFIED + """
select message_id, body, failure_type, cast(k % 3 as bigint) batch from queue_msgs where k % 3 > 0
""")
def retention_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue table of batches of three ages after its retention of 14 days: the oldest one is gone."""
    path = scratch_path(spark, "retention-queue")
    incoming = scratch_path(spark, "retention-incoming")  # the messages are made once, for all batches
    k = F.split_part("message_id", F.lit("-"), F.lit(2)).cast("long")
    messages = routing.queue_rows(_routed(spark, sf_dir), "retry", "failure")
    messages.write.parquet(incoming)
    rows = spark.read.schema(messages.schema).parquet(incoming)
    now, day = 1_750_000_000_000, 86_400_000
    for batch, age in enumerate((15 * day, 14 * day, 0)):
        queues.append_batch(rows.filter(k % 3 == batch), path, "monitor", batch, at_ms=now - age)
    jobs.expire_queue(spark, path, keep_days=14, now_ms=now)
    return queues.read_queue(spark, path).select("message_id", "body", "failure_type", F.col("batch_id").alias("batch"))


@register("redrive_all", _CLASSIFIED + """
select message_id, body, failure_type from queue_msgs where route = 'failure'
""")
def redrive_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A re-drive without a limit moves every message."""
    moved, remaining = routing.redrive_queue(routing.queue_rows(_routed(spark, sf_dir), "failure"))
    return moved.unionByName(remaining)


@register("redrive_duplicates", _CLASSIFIED + f"""
, doubled as (select 'm-' || cast(k % 50 as varchar) message_id, body, failure_type from queue_msgs where route = 'failure'
 union all select 'm-' || cast(k % 50 as varchar), body, failure_type from queue_msgs where route = 'failure' and k % 3 = 0)
select message_id, body, failure_type,
 row_number() over (order by message_id, body, failure_type) <= {REDRIVE_LIMIT} moved
from doubled
""")
def redrive_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A re-drive with a limit over messages of which many share an id or are equal: moved and remaining are all."""
    failed = _routed(spark, sf_dir).filter(F.col("route") == "failure")
    body = ev.event_to_json("granule_id", "attempt").alias("body")
    rows = failed.select(F.concat(F.lit("m-"), (F.col("k") % 50).cast("string")).alias("message_id"), body, F.lit("NONRETRYABLE").alias("failure_type"), "k")
    doubled = rows.unionByName(rows.filter(F.col("k") % 3 == 0)).drop("k")
    moved, remaining = routing.redrive_queue(doubled, REDRIVE_LIMIT)
    return moved.withColumn("moved", F.lit(True)).unionByName(remaining.withColumn("moved", F.lit(False)))


@register("redrive_logs_limit", _CLASSIFIED + f"""
select granule_id, attempt from failures where attempt < {MAX_ATTEMPTS} order by granule_id limit {REDRIVE_LIMIT}
""")
def redrive_logs_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-drive from the failure view with a limit."""
    view = reporting.failures_view(_job_log(spark, sf_dir))
    return routing.redrive_logs(view, MAX_ATTEMPTS, REDRIVE_LIMIT).select("granule_id", "attempt")


# ---------------------------------------------------------------------------------------------------------------------
# Simultaneous events (W1, A3) and requests without a log

_TIES = """
, ties as (select *, (seq + 1) // 2 arrival, 'evt-' || cast(k as varchar) || '-' || cast(seq as varchar) id from job_events),
t_replay as (
 select *, min(case when job_outcome = 'SUCCESS' then arrival end) over (
  partition by granule_id order by arrival range between current row and unbounded following) t_succ from ties),
t_ranked as (
 select *, case when t_succ is not null then 'success' else 'failure' end outcome,
  row_number() over (partition by granule_id, t_succ is not null, attempt
   order by case when job_outcome <> 'SUCCESS' and t_succ is not null then t_succ else arrival end desc,
            case when job_outcome <> 'SUCCESS' and t_succ is not null then 1 else 0 end desc, arrival desc, id desc) place
 from t_replay),
t_current as (select * from t_ranked where place = 1)
"""


def _ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.job_events(spark, sf_dir)
    arrival = F.expr("(seq + 1) div 2").alias("arrival")
    id_ = F.concat(F.lit("evt-"), F.col("k").cast("string"), F.lit("-"), F.col("seq").cast("string")).alias("id")
    return e.select("granule_id", "attempt", "job_outcome", arrival, id_, "platform", "acquisition_date")


@register("replay_ties", _TIES + """
select granule_id, outcome, attempt, job_outcome, id from t_current
""")
def replay_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log state of events that arrive two at a time."""
    current = replay.current_job_logs(_ties(spark, sf_dir), order="arrival", tie="id")
    return current.select("granule_id", "outcome", "attempt", "job_outcome", "id")


@register("progress_ties", _TIES + """
, t_latest as (
 select max_by(outcome, attempt * 10 + case outcome when 'success' then 1 else 0 end) outcome,
  min(platform) platform, date_trunc('year', min(acquisition_date)) as year
 from t_current group by granule_id)
select platform, outcome, year, count(*) granule_count from t_latest group by platform, outcome, year
""")
def progress_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly report straight from events that arrive two at a time; equal to the one over their log state."""
    return reporting.progress_by_year_from_events(_ties(spark, sf_dir), order="arrival")


@register("missing_events", """
, req as (select granule_id, seq, attempt + case when seq % 5 = 0 then 1 else 0 end attempt from job_events)
select r.granule_id, r.seq, r.attempt from req r
where not exists (select 1 from current_logs c where c.granule_id = r.granule_id and c.attempt = r.attempt)
""")
def missing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests whose attempt is logged under neither outcome."""
    attempt = (F.col("attempt") + F.when(F.col("seq") % 5 == 0, 1).otherwise(0)).alias("attempt")
    requests = fx.job_events(spark, sf_dir).select("granule_id", "seq", attempt)
    return replay.missing_events(requests, fx.current_logs(spark, sf_dir)).select("granule_id", "seq", "attempt")


@register("stream_state_ties", _TIES + """
select granule_id, outcome, attempt, job_outcome, arrival from t_current
""")
def stream_state_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log state kept as streaming state over several micro-batches of events that arrive two at a time, also across
    micro-batches: equal to ``replay_ties``."""
    base = scratch_path(spark, "state-ties")
    columns = ["granule_id", "attempt", "job_outcome", F.col("arrival").cast("bigint").alias("arrival"), "id"]
    ties = _ties(spark, sf_dir).withColumn("seq", F.split_part("id", F.lit("-"), F.lit(3)).cast("int"))
    incoming, sink = f"{base}/incoming", f"{base}/emissions"
    schema = "granule_id string, attempt int, job_outcome string, arrival bigint, id string"
    for low, high in ((0, 1), (1, 4), (4, 99)):  # each lands after the stream has taken the one before
        ties.filter((F.col("seq") > low) & (F.col("seq") <= high)).select(*columns).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(schema).parquet(incoming)
        replay_state.start_state_replay(stream, sink, f"{base}/_checkpoint", available_now=True).awaitTermination()
    current = replay_state.current_from_emissions(spark.read.parquet(sink).drop("producer"))
    return current.select("granule_id", "outcome", "attempt", "job_outcome", "arrival")


# ---------------------------------------------------------------------------------------------------------------------
# Storage round trips: listings, inventories, discovery, listings of the log, progress and report files


def _listing_files(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> str:
    """Listing text files, one folder per inventory."""
    path = scratch_path(spark, "listing-files")
    rows = fx.raw_inventory(spark, sf_dir) if lines is None else lines
    rows.select("inventory", "value").write.partitionBy("inventory").text(path)
    return path


@register("inventory_files", _PARSED_INVENTORY + """
select inventory, granule_id, cast(start_datetime as date) start_datetime, status, published, inventory_seq from conv
""")
def inventory_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing files converted to inventory files by the job and read back."""
    out = scratch_path(spark, "inventory-files")
    jobs.convert_inventories(spark, [_listing_files(spark, sf_dir)], out)
    return inv_src.read_inventory(spark, out, ["inventory", "granule_id", "start_datetime", "status", "published", "inventory_seq"])


@register("inventory_counts_footer", _PARSED_INVENTORY + """
select inventory, cast(0 as bigint) submitted_count, cast(total_count as bigint) total_count from counts
""")
def inventory_counts_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress records of stored inventories, from the footers of their files."""
    out = scratch_path(spark, "inventory-counts")
    jobs.convert_inventories(spark, [_listing_files(spark, sf_dir)], out)
    counts = inv_src.catalog_counts(inv_src.read_catalog(spark, out))
    return counts.withColumn("inventory", inv_src.inventory_name(F.concat("inventory", F.lit("/part"))))


@register("feed_run_stored", _PARSED_INVENTORY + f"""
select c.granule_id, 0 attempt, replace(c.granule_id, '.', '-') || '_0' job_name, '{OUTPUT_BUCKET}' target_bucket,
 'OUTPUT_BUCKET={OUTPUT_BUCKET};GRANULE_ID=' || c.granule_id || ';ATTEMPT=0' env, cast(inventory_seq // {FEED_N} + 1 as bigint) run,
 least(2 * {FEED_N}, total_count) submitted_count
from conv c join counts using (inventory)
where inventory = (select min(inventory) from conv) and inventory_seq < 2 * {FEED_N}
""")
def feed_run_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feed runs over stored inventories: requests of the first two slices, and the progress after them."""
    base = scratch_path(spark, "feed-run")
    inventories, progress, requests = f"{base}/inventories", f"{base}/progress", f"{base}/requests"
    jobs.convert_inventories(spark, [_listing_files(spark, sf_dir)], inventories)
    summaries = fx.job_details_flat(spark, sf_dir).select(F.col("id").alias("job_id"), "status")
    for run in (1, 2):
        jobs.run_feed(spark, inventories, progress, summaries, requests, run, FEED_N, GATE_THRESHOLDS[-1], OUTPUT_BUCKET)
    done = prog.read_progress(spark, progress)[0].agg(F.sum("submitted_count").alias("submitted_count"))
    submitted = F.lit(done.first()["submitted_count"])
    rows = spark.read.parquet(requests)
    return rows.select("granule_id", "attempt", "job_name", "target_bucket", env_text().alias("env"), F.col("batch_id").cast("long").alias("run"), submitted.alias("submitted_count"))


@register("inventory_quarantine", _PARSED_INVENTORY + """
, spoilt as (
 select inventory, replace(replace(value, ' failed f', ' failed x'), ':07:', ':xx:') line, r.value from raw_inventory r)
select inventory, line like '% failed x' or line like '%:xx:%' is_bad, line from spoilt
""")
def inventory_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing files with bad flags and bad times: good rows and bad lines are all lines."""
    line = F.regexp_replace(F.regexp_replace("value", " failed f", " failed x"), ":07:", ":xx:")
    path = _listing_files(spark, sf_dir, fx.raw_inventory(spark, sf_dir).withColumn("value", line))
    parsed = inventory.parse_inventory(inv_src.read_inventory_text(spark, path), strict=False)
    good, bad = inventory.quarantine(parsed)
    # the line of a good row again, from its columns
    start = F.when(F.col("start_datetime").isNull(), F.lit("\\N")).otherwise(
        F.concat(F.date_format("start_datetime", "yyyy-MM-dd'\\ 'HH:mm:ss"), F.when(F.date_format("start_datetime", "SSS") != "000", F.concat(F.lit("."), F.date_format("start_datetime", "SSS"))).otherwise(F.lit("")), F.lit("+00"))
    )
    again = F.concat_ws(" ", "granule_id", start, "status", F.when(F.col("published"), "t").otherwise("f"))
    good = good.select("inventory", F.lit(False).alias("is_bad"), again.alias("line"))
    return good.unionByName(bad.select("inventory", F.lit(True).alias("is_bad"), F.col("value").alias("line")))


@register("inventory_rejects", _PARSED_INVENTORY + """
, lines as (select inventory, replace(replace(value, ' failed f', ' failed x'), ':07:', ':xx:') line from raw_inventory),
bad as (select inventory, line from lines where line like '% failed x' or line like '%:xx:%'),
good as (
 select inventory, granule_id, row_number() over (partition by inventory order by start_datetime desc nulls last, granule_id) - 1 inventory_seq
 from conv where coalesce(minute(start_datetime), 0) <> 7)
select inventory, granule_id, inventory_seq, null line from good
union all
select inventory, null, null, line from bad
""")
def inventory_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spoilt listings through the conversion job with a reject folder: the inventory's rows and the bad lines."""
    line = F.regexp_replace(F.regexp_replace("value", " failed f", " failed x"), ":07:", ":xx:")
    listings = _listing_files(spark, sf_dir, fx.raw_inventory(spark, sf_dir).withColumn("value", line))
    base = scratch_path(spark, "inventory-rejects")
    jobs.convert_inventories(spark, [listings], f"{base}/good", rejects=f"{base}/bad")
    good = inv_src.read_inventory(spark, f"{base}/good").select("inventory", "granule_id", "inventory_seq", F.lit(None).cast("string").alias("line"))
    bad = spark.read.parquet(f"{base}/bad")
    return good.unionByName(bad.select("inventory", F.lit(None).cast("string").alias("granule_id"), F.lit(None).cast("long").alias("inventory_seq"), F.col("value").alias("line")))


@register("inventory_strict", _PARSED_INVENTORY + """
select inventory, granule_id, start_datetime, status, published from typed
""")
def inventory_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the listing files; a line that is none fails the query."""
    lines = inv_src.read_inventory_text(spark, _listing_files(spark, sf_dir))
    return inventory.parse_inventory(lines, strict=True).select("inventory", "granule_id", "start_datetime", "status", "published")


@register("inventory_monthly_files", _PARSED_INVENTORY + """
select inventory, cast(year(start_datetime) as integer) "year", cast(month(start_datetime) as integer) "month", count(*) granule_count
from conv group by all
""")
def inventory_monthly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging layout written by year and month, and read back."""
    path = scratch_path(spark, "monthly")
    inv_src.write_monthly(inventory.monthly_layout(_converted(spark, sf_dir)), path)
    rows = spark.read.parquet(path).groupBy("inventory", "year", "month").agg(F.count(F.lit(1)).alias("granule_count"))
    return rows.select("inventory", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), "granule_count")


@register("feed_from_discovery", _PARSED_INVENTORY + f"""
, every as (select *, row_number() over (partition by inventory order by start_datetime desc nulls last, granule_id) - 1 place from typed)
select granule_id, 0 attempt, inventory, place inventory_seq from every
where inventory = (select min(inventory) from every) and place < {REDRIVE_LIMIT} and status = 'completed'
""")
def feed_from_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventories with rows of every status are written, discovered, counted, tracked and fed from."""
    base = scratch_path(spark, "feed-from-discovery")
    rows = inventory.parse_inventory(fx.raw_inventory(spark, sf_dir))
    numbered = inventory.number_rows(rows, inventory.inventory_order(), group=["inventory"])
    inv_src.write_inventory(numbered, f"{base}/inventories")
    progress = inv_src.count_rows(inv_src.discover_inventories(spark, f"{base}/inventories"))
    events, _ = feed.next_batch(inv_src.discover_inventories(spark, f"{base}/inventories"), progress, REDRIVE_LIMIT)
    return events.select("granule_id", "attempt", inv_src.inventory_name(F.concat("inventory", F.lit("/part"))).alias("inventory"), "inventory_seq")


@register("snapshot_manifests", """
select key, is_latest, is_delete_marker, last_modified_date from log_snapshot where dt = (select max(dt) from log_snapshot)
""")
def snapshot_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing named by manifests, one per day; the newest day is read."""
    base = scratch_path(spark, "snapshot-manifests")
    snapshot.write_snapshot(fx.log_snapshot(spark, sf_dir).withColumn("bucket", F.lit("b")), f"{base}/data")
    files = snapshot.read_snapshot(spark, f"{base}/data").select("dt", F.col("_metadata.file_path").alias("value")).distinct()
    for day in fx.SNAPSHOT_DTS:  # the fixture's three days
        files.filter(F.col("dt") == day).select("value").write.text(f"{base}/manifests/dt={day}/symlink.txt")
    listing = snapshot.read_snapshot_manifests(spark, f"{base}/manifests")
    return listing.select("key", "is_latest", "is_delete_marker", "last_modified_date")


@register("progress_versions", _PARSED_INVENTORY + f"""
select inventory, case when inventory = (select min(inventory) from counts) then least(3 * {FEED_N}, total_count) else 0 end submitted_count,
 total_count, cast(3 as bigint) "version"
from counts
""")
def progress_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress table after three feed runs: created, and moved on by three versions."""
    path = scratch_path(spark, "progress-versions")
    conv = _converted(spark, sf_dir)
    prog.create_progress(spark, path, inventory.inventory_counts(conv))
    for _ in range(3):
        progress, version = prog.read_progress(spark, path)
        prog.update_progress(spark, path, feed.next_batch(conv, progress, FEED_N)[1], version)
    progress, version = prog.read_progress(spark, path)
    return progress.withColumn("version", F.lit(version).cast("bigint"))


@register("report_csv", f"""
select platform, outcome, year, count(*) granule_count from ({_LATEST}) t group by platform, outcome, year
""")
def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly report as one CSV file, read back."""
    path = scratch_path(spark, "report-csv")
    queues.write_report_csv(reporting.progress_by_year_from_events(_report_events(spark, sf_dir)), path)
    schema = "platform string, outcome string, year timestamp, granule_count bigint"
    return spark.read.schema(schema).option("header", "true").csv(path)
