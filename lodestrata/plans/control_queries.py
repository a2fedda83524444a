"""Loads and jobs: completeness, supersession, vetoes, versions, retries, outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import control
from ..sources.tables import table
from . import adaptor
from .adaptor import SIGNALS_SQL, shown
from .base import query


@query(
    SIGNALS_SQL
    + """
select version, array_to_string(list_sort(list(distinct signal)), ',') as signals, count(distinct signal) = 4 as complete
from signals where event_id % 23 = 0 group by version"""
)
def latch_complete(spark, folder):
    some = adaptor.signals(spark, folder).where("event_id % 23 = 0")
    return control.completeness(some).select("version", F.array_join("signals", ",").alias("signals"), "complete")


@query(
    SIGNALS_SQL
    + """
select version, array_to_string(list_sort(list(distinct signal)), ',') as signals, count(distinct signal) = 4 as complete
from signals group by version"""
)
def latch_all_signals(spark, folder):
    """Every signal of the table, whereas ``latch_complete`` merges a part of them."""
    return control.completeness(adaptor.signals(spark, folder)).select("version", F.array_join("signals", ",").alias("signals"), "complete")


@query(SIGNALS_SQL + ", l as (select version, min(ts) as created_at from signals group by version) select version, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at, created_at < (select max(created_at) from l) as superseded from l")
def latch_superseded(spark, folder):
    latches = adaptor.signals(spark, folder).groupBy("version").agg(F.min("ts").alias("created_at"))
    return control.superseded(latches).select("version", shown("created_at").alias("created_at"), "superseded")


@query(
    SIGNALS_SQL
    + """
, l as (select signal as entity, version, count_if(event_id % 29 = 0) > 0 as signalled, count_if(event_id % 31 = 0) > 0 as vetoed from signals group by all),
ends as (select entity, max(version) as ended_at from l where signalled and not vetoed group by entity)
select l.entity, count_if(vetoed and (ended_at is null or version > ended_at)) as run from l left join ends using (entity) group by l.entity"""
)
def veto_runs(spark, folder):
    rows = adaptor.signals(spark, folder).groupBy(F.col("signal").alias("entity"), "version")
    return control.veto_runs(rows.agg((F.count_if(F.col("event_id") % 29 == 0) > 0).alias("signalled"), (F.count_if(F.col("event_id") % 31 == 0) > 0).alias("vetoed")))


SPELLED = "case event_id % 4 when 0 then strftime(ts, '%Y%m%d') when 1 then strftime(ts, '%Y-%m-%d') when 2 then '2024023' || (event_id % 10)::varchar else strftime(ts, '%Y%m') || '31' end"


@query(
    f"""
with v as (select distinct {SPELLED} as version from events)
select version, case when regexp_full_match(version, '[0-9]{{8}}') and try_strptime(version, '%Y%m%d') is not null then version end as ordered from v"""
)
def ordered_version(spark, folder):
    e = table(spark, folder, "events")
    k = F.col("event_id") % 4
    spelled = (
        F.when(k == 0, F.date_format("ts", "yyyyMMdd"))
        .when(k == 1, F.date_format("ts", "yyyy-MM-dd"))
        .when(k == 2, F.concat(F.lit("2024023"), (F.col("event_id") % 10).cast("string")))
        .otherwise(F.concat(F.date_format("ts", "yyyyMM"), F.lit("31")))
    )
    return e.select(spelled.alias("version")).distinct().select("version", text.ordered_version(F.col("version")).alias("ordered"))


JOBS_SQL = """
with jobs as (
  select strftime(min(ts), '%Y%m%d') as version, day(min(ts))::bigint as generation, min(ts) as created_at,
    case day(min(ts)) % 5 when 0 then 'pending' when 1 then 'leased' when 2 then 'retry' when 3 then 'completed' else 'superseded' end as state,
    min(ts) + interval 20 day as due_at, min(ts) + interval 3 day as lease_until
  from events group by date_trunc('day', ts)
)
"""


def _jobs(spark, folder):
    days = table(spark, folder, "events").groupBy(F.date_trunc("day", "ts").alias("d")).agg(F.min(F.col("ts").cast("timestamp_ntz")).alias("created_at"))
    day = F.dayofmonth("created_at")
    state = F.when(day % 5 == 0, "pending").when(day % 5 == 1, "leased").when(day % 5 == 2, "retry").when(day % 5 == 3, "completed").otherwise("superseded")
    return days.select(
        F.date_format("created_at", "yyyyMMdd").alias("version"), day.cast("long").alias("generation"), "created_at", state.alias("state"),
        (F.col("created_at") + F.expr("interval 20 day")).alias("due_at"), (F.col("created_at") + F.expr("interval 3 day")).alias("lease_until"),
    )


@query(
    JOBS_SQL
    + """
select version, generation, state from jobs
where (state in ('pending', 'retry') and due_at <= timestamp '2024-02-01') or (state = 'leased' and lease_until < timestamp '2024-02-01')
order by generation desc limit 1"""
)
def job_pick(spark, folder):
    return control.due_job(_jobs(spark, folder), adaptor.now()).select("version", "generation", "state")


@query(
    JOBS_SQL
    + """
select max_by(version, generation) filter (state = 'completed') as completed, count_if(state in ('pending', 'retry')) as waiting, count_if(state = 'leased') as active,
  count_if(state = 'superseded') as superseded, max(date_sub('second', created_at, timestamp '2024-02-01')) filter (state in ('pending', 'retry')) as oldest_waiting_s
from jobs"""
)
def job_health(spark, folder):
    return control.job_health(_jobs(spark, folder), adaptor.now())


REJECTS_SQL = SIGNALS_SQL + """
, loads as (select signal as entity, version, min(event_id) as marker, count_if(event_id % 37 = 0) as rejected from signals group by all),
kept as (select entity, version, marker, sum(rejected) over (partition by entity order by marker) as waiting from loads)
"""


@query(REJECTS_SQL + "select entity, version, waiting::bigint as waiting, case when waiting > 0 then 'dead_letters' else 'none' end as veto from kept")
def purge_veto(spark, folder):
    """Dead letters of a load veto its purge, and those of all later loads until they are settled."""
    loads = adaptor.signals(spark, folder).groupBy(F.col("signal").alias("entity"), "version").agg(F.min("event_id").alias("marker"), F.count_if(F.col("event_id") % 37 == 0).alias("rejected"))
    return control.vetoes(loads).select("entity", "version", "waiting", F.coalesce("veto", F.lit("none")).alias("veto"))


@query("select distinct event_id % 12 as attempts, least(300, pow(2, least(event_id % 12, 8))::bigint) as delay_s from events")
def retry_backoff(spark, folder):
    attempts = table(spark, folder, "events").select((F.col("event_id") % 12).alias("attempts")).distinct()
    return attempts.select("attempts", text.retry_delay(F.col("attempts")).alias("delay_s"))


@query("select event_type as entity, case event_id % 4 when 0 then 'failed' when 1 then 'skipped' else 'processed' end as outcome, count(*) as n from events group by all")
def outcome_counts(spark, folder):
    k = F.col("event_id") % 4
    rows = table(spark, folder, "events").select(F.col("event_type").alias("entity"), F.when(k == 0, "failed").when(k == 1, "skipped").otherwise("processed").alias("outcome"))
    return control.outcome_counts(rows)


@query("select case event_id % 5 when 0 then 'undecodable' when 1 then 'unknown_entity' when 2 then 'no_id' else 'accepted' end as reason, count(*) as n from events group by all")
def dead_letter_reasons(spark, folder):
    from ..streaming.ingest import decode

    k = F.col("event_id") % 5
    value = F.when(k == 0, "{not json").when(k == 2, F.lit('{"id": ""}')).otherwise(F.concat(F.lit('{"id": "'), F.col("user_id").cast("string"), F.lit('x"}')))
    rows = table(spark, folder, "events").select(F.when(k == 1, "planets").otherwise("artists").alias("entity"), value.alias("value"), F.col("event_id").alias("seq"))
    return decode(rows).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))
