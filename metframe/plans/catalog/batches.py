"""The whole order of stages over two micro-batches, one of which fails and is run again."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from metframe.functions.expr import time_text
from metframe.operators.shape import to_long
from metframe.plans import views
from metframe.plans.catalog.forecasting import STATE_SQL, VARIABLES, ahead_sql, stored_models
from metframe.plans.catalog.registry import AB, EV, query, r, rounded, text
from metframe.plans.pipeline import Places, run_batch, run_stream
from metframe.session import scratch_path
from metframe.sources import readers, writers
from metframe.streaming import feeds

DAY = 86_400


def long_sql(kind, source):
    return " union all ".join(
        f"select '{kind}' as kind, city_name, {text('time')} as time, '{v}' as variable, {r(f'{v}::double', 4)} as value, "
        f"cast(null as varchar) as time_of_prediction from {source}" for v in VARIABLES)


BATCHES_SQL = f"""
with {STATE_SQL}, {AB.removeprefix(EV + ', ')},
cut as (
  select make_timestamp(cast(floor((epoch(min(ts)) + epoch(max(ts))) / 2 / {DAY}) * {DAY} as bigint) * 1000000) as midnight
  from events),
slotted as (
  select *, floor(epoch(strptime(time, '%Y-%m-%dT%H:%M')) / 600) as slot from b),
firsts as (
  select *, row_number() over (partition by city_name, slot order by time desc) as rn from slotted),
kept as (
  select name as city_name, a.time as time, (humidity + relative_humidity_2m) / 2 as humidity, a.pressure as pressure,
         a.sea_level as sea_level, a.temp as temp, a.visibility as visibility, a.wind_speed as wind_speed
  from a join firsts on name = city_name and floor(epoch(a.time) / 600) = slot and rn = 1),
taken as (
  select kept.* from kept, cut where time < midnight order by time desc, city_name limit 37)
{long_sql('table', 'kept')}
union all {long_sql('snapshot', 'taken')}
union all
select 'prediction', n.city_name, {text('n.time')}, v.variable,
       {r(f"case when t.phi is not null then {ahead_sql('1', 't')} end", 4)},
       {text("case when t.phi is not null then n.time + interval 10 minute end")}
from taken n cross join (select unnest({VARIABLES!r}) as variable) v
left join state t on t.city_name = n.city_name and t.variable = v.variable and t.variable <> 'visibility'"""


@query("batch_stream", BATCHES_SQL)
def batch_stream(spark, sf):
    """The feeds as a stream of two micro-batches, cut at a midnight, through every stage. The
    second fails once it has merged, before that is entered, and is run again; then it is run once more by hand. Table,
    snapshot and predictions are those of one run: the snapshot, and so the predictions, saw the first batch only."""
    places = Places(*[scratch_path(spark, n) for n in ("a", "b", "table", "snapshot", "predictions", "models", "ledger")])
    topics, checkpoint = [scratch_path(spark, n) for n in ("topic-a", "topic-b")], scratch_path(spark, "checkpoint")
    writers.write_models(stored_models(spark, sf).where(F.col("variable") != "visibility"), places.models)
    seconds = F.unix_seconds("ts")
    middle = (F.min(seconds) + F.max(seconds)) / 2
    cut = views.events(spark, sf).agg((F.floor(middle / DAY) * DAY).alias("midnight")).scalar()
    feeds_ = [(views.raw_a(spark, sf), "name"), (views.raw_b(spark, sf), "city_name")]
    failures = ["merge"]

    def fail_once(stage):
        if second and stage in failures:
            failures.remove(stage)
            raise RuntimeError("lost on purpose")

    def drain():
        streams = [feeds.read_message_stream(spark, topic) for topic in topics]
        feeds.drain(run_stream(*streams, places, checkpoint, after=fail_once))

    for second in (False, True):
        for (raw, key), topic in zip(feeds_, topics):
            part = raw.where((seconds >= cut) if second else (seconds < cut))
            writers.publish(writers.to_messages(part, key), topic)
        try:
            drain()
        except StreamingQueryException:
            drain()
    again = [readers.read_messages(spark, topic) for topic in topics]
    run_batch(spark, *again, places, batch=1)
    ids = ["city_name", "time"]
    found = to_long(readers.read_table(spark, places.table), ids, VARIABLES).withColumn("kind", F.lit("table"))
    found = found.unionByName(
        to_long(readers.read_history(spark, places.snapshot), ids, VARIABLES).withColumn("kind", F.lit("snapshot")))
    found = found.withColumn("time_of_prediction", F.lit(None).cast("timestamp"))
    predicted, _ = readers.read_predictions(spark, places.predictions)
    found = found.unionByName(predicted.withColumnRenamed("predicted_value", "value").withColumn("kind", F.lit("prediction")))
    return rounded(found.withColumns({c: time_text(c) for c in ("time", "time_of_prediction")}), ["value"], 4)
