"""Streaming queries: the whole table arrives as a stream, is drained, and the result is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from metframe import schemas
from metframe.functions.expr import time_text
from metframe.operators.blend import flatten_a
from metframe.operators.quality import decode_messages
from metframe.plans import views
from metframe.plans.catalog.feeds import DAILY, RAW_A_SQL, daily, shown_a
from metframe.plans.catalog.registry import EV, query, r, rounded, text
from metframe.session import scratch_path
from metframe.sources import readers, writers
from metframe.streaming import feeds


def event_stream(spark, sf):
    schema = views.table(spark, sf, "events").schema
    return views.with_reading(feeds.read_parquet_stream(spark, sf, schema, "events.parquet"))


@query("stream_land", RAW_A_SQL)
def stream_land(spark, sf):
    """Messages of provider A decoded as they come and landed as Parquet."""
    topic, path = scratch_path(spark, "topic-a"), scratch_path(spark, "landed")
    schema = schemas.struct(event_id=schemas.L, **{f.name: f.dataType for f in schemas.PROVIDER_A})
    writers.publish(writers.to_messages(views.raw_a(spark, sf), "name"), topic)
    records, _ = decode_messages(feeds.read_message_stream(spark, topic), schema)
    feeds.drain(feeds.append_stream(records, path, scratch_path(spark, "checkpoint")))
    return shown_a(flatten_a(readers.read_raw(spark, path, schema), ["event_id"]))


@query("stream_dedupe", "select event_id, user_id, event_type, value from events")
def stream_dedupe(spark, sf):
    """Every message arrives twice and is kept once."""
    path = scratch_path(spark, "deduped")
    twice = event_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = feeds.drop_replays(twice, ["station", "ts"], "ts")
    feeds.drain(feeds.append_stream(
        once.select("event_id", "user_id", "event_type", "value"), path, scratch_path(spark, "checkpoint")
    ))
    return readers.read_table(spark, path)


DELAY = 86_400 * 3  # seconds that a message may be late

LATE_SQL = f"""
with {EV}, span as (
  select epoch_ms(min(ts)) as lo, epoch_ms(max(ts)) as hi from ev),
due as (
  select event_id, epoch_ms(ts) as ms, cast(3 * (epoch_ms(ts) - lo) // (hi - lo + 1) as bigint) as third,
         {r('value')} as value from ev, span),
arrivals as (
  select event_id, ms, value, third + case when event_id % 10 = 0 then 1 else 0 end as batch from due
  union all
  select event_id, ms, value, third + case when event_id % 10 = 0 then 1 else 0 end + event_id % 3 from due
  where event_id % 7 = 0),
latest as (
  select batch + 1 as batch, max(max(ms)) over (order by batch) - {DELAY * 1000} as passed from arrivals group by batch)
select event_id, value, case when ms <= passed then 'late' when nth > 1 then 'replay' else 'first' end as kind, count(*) as n
from (select *, row_number() over (partition by event_id order by batch) as nth from arrivals)
left join latest using (batch)
group by all"""


@query("stream_late", LATE_SQL)
def stream_late(spark, sf):
    """The events in several micro-batches. Each comes with its third of the time, every tenth one batch
    later; every seventh comes again, in the same batch or one or two later. First, replayed and late ones are all kept,
    told apart by state and watermark."""
    ev = views.events(spark, sf)
    ms = F.unix_millis("ts")
    span = ev.agg(F.min(ms).alias("lo"), F.max(ms).alias("hi"))
    due = ev.crossJoin(F.broadcast(span)).withColumn("batch", F.expr("3 * (unix_millis(ts) - lo) div (hi - lo + 1)") + (F.col("event_id") % 10 == 0).cast("int"))
    again = due.where("event_id % 7 = 0").withColumn("batch", F.col("batch") + F.col("event_id") % 3)
    arrivals = due.unionByName(again).select("batch", "station", "ts", "event_id", "value")
    topic, path, checkpoint = (scratch_path(spark, n) for n in ("arrivals", "told", "checkpoint"))
    schema = schemas.struct(station=schemas.S, ts=schemas.TS, event_id=schemas.L, value=schemas.D)
    for batch in range(6):  # at most: the third, one later, two later again
        writers.publish(writers.to_messages(arrivals.where(F.col("batch") == batch).drop("batch"), "station"), topic)
        records, _ = decode_messages(feeds.read_message_stream(spark, topic), schema)
        told = feeds.mark_replays(records.select(*schema.fieldNames()), ["station", "ts"], "ts", DELAY)
        with feeds.keyed_state(spark):
            feeds.drain(feeds.append_stream(told, path, checkpoint, ["kind"]))
    return rounded(readers.read_table(spark, path), ["value"]).groupBy("event_id", "value", "kind").agg(F.count("*").alias("n"))


@query("stream_blend", f"""
with {EV}
select a.event_id as event_a, b.event_id as event_b, a.station as station, {r('(a.value + b.value) / 2')} as blended
from ev a join ev b on a.station = b.station and b.ts between a.ts - interval 600 second and a.ts + interval 600 second
where a.event_type in ('view', 'click', 'signup') and b.event_type in ('purchase', 'error')""")
def stream_blend(spark, sf):
    """Readings of two feeds that are at most ten minutes apart."""
    path = scratch_path(spark, "pairs")
    a = event_stream(spark, sf).where(F.col("event_type").isin(views.TYPES_A)).select(
        "station", F.col("event_id").alias("event_a"), F.col("ts").alias("time_a"), F.col("value").alias("value_a")
    )
    b = event_stream(spark, sf).where(F.col("event_type").isin(views.TYPES_B)).select(
        "station", F.col("event_id").alias("event_b"), F.col("ts").alias("time_b"), F.col("value").alias("value_b")
    )
    pairs = feeds.blend_streams(a, b, "station", "time_a", "time_b", 600).select(
        "event_a", "event_b", "station", ((F.col("value_a") + F.col("value_b")) / 2).alias("blended")
    )
    feeds.drain(feeds.append_stream(pairs, path, scratch_path(spark, "checkpoint")))
    return rounded(readers.read_table(spark, path), ["blended"])


@query("stream_upsert", f"""
with {EV}, ranked as (
  select *, row_number() over (partition by station, date_trunc('day', ts) order by event_id desc) as rn from ev)
select station as city_name, {text("date_trunc('day', ts)")} as time, event_id,
       {r("case when event_type <> 'error' then value end")} as temp
from ranked where rn = 1""")
def stream_upsert(spark, sf):
    """Each micro-batch upserted into the table, the last write of a key winning."""
    path = scratch_path(spark, "stream-table")
    feeds.drain(feeds.upsert_stream(
        daily(event_stream(spark, sf)), path, schemas.OBSERVATION_KEY, ["event_id"], DAILY,
        scratch_path(spark, "checkpoint"),
    ))
    rows = readers.read_table(spark, path).select(*DAILY.fieldNames())
    return rounded(rows.withColumn("time", time_text("time")), ["temp"])
