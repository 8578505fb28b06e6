"""Sources, sinks and quality rules over the whole feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from metframe import schemas
from metframe.functions.expr import time_text
from metframe.operators.blend import flatten_a, flatten_b, table_columns
from metframe.operators.quality import conform, decode_messages
from metframe.operators.shape import flatten
from metframe.operators.skew import lookup_join
from metframe.operators.stations import only_keys
from metframe.operators.summary import row_count
from metframe.plans import views
from metframe.plans.catalog.registry import A, AB, B, EV, fixed, query, r, rounded, text
from metframe.plans.pipeline import Places, run_batch, snapshot
from metframe.session import scratch_path
from metframe.sources import readers, writers

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


@query("messages_encode", """
select cast(user_id as varchar) as key,
       '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' as value
from events""")
def messages_encode(spark, sf):
    """Rows as keyed JSON messages."""
    return writers.to_messages(views.table(spark, sf, "events").select(*EVENT_COLUMNS[:3]), "user_id")


@query("messages_decode", f"""
with {EV}
select event_type, count(*) as n, sum(k)::bigint as sum_k, {r('avg(value)')} as mean_value
from ev group by event_type""")
def messages_decode(spark, sf):
    """Publish, read back from the earliest message on, decode with an explicit schema."""
    path = scratch_path(spark, "topic")
    writers.publish(writers.to_messages(views.table(spark, sf, "events").select(*EVENT_COLUMNS, "props"), "user_id"), path)
    schema = schemas.struct(event_type=schemas.S, value=schemas.D, props=schemas.S)
    records, _ = decode_messages(readers.read_messages(spark, path), schema)
    return (
        records.withColumn("k", F.from_json("props", "k long")["k"]).groupBy("event_type")
        .agg(F.count("*").alias("n"), F.sum("k").alias("sum_k"), fixed(F.avg("value")).alias("mean_value"))
    )


@query("bounded_consume", """
select event_id, user_id, event_type from events order by ts, event_id limit 37""")
def bounded_consume(spark, sf):
    """The first 37 messages of a topic; the bound is the feature."""
    return readers.take_messages(views.table(spark, sf, "events"), ["ts", "event_id"], 37).select(*EVENT_COLUMNS[:3])


RAW_A_SQL = f"""
with {A}
select event_id, name as city_name, {r('latitude')} as latitude, {r('longitude')} as longitude,
       weather_description, {r('temp')} as temp, {r('feels_like')} as feels_like, humidity, pressure, sea_level,
       grnd_level, visibility, {r('wind_speed')} as wind_speed, wind_deg, clouds_all, country,
       {text('sunrise')} as sunrise, {text('sunset')} as sunset, {text('time')} as time
from a"""


def shown_a(flat):
    flat = flat.withColumns({c: time_text(c) for c in ("time", "sunrise", "sunset")})
    flat = flat.withColumn("weather_description", F.array_join("weather_description", ","))
    return rounded(flat, ["latitude", "longitude", "temp", "feels_like", "wind_speed"])


@query("flatten_a", RAW_A_SQL)
def flatten_provider_a(spark, sf):
    """Nested record of provider A to flat columns."""
    return shown_a(flatten_a(views.raw_a(spark, sf), ["event_id"]))


@query("read_raw_a", RAW_A_SQL)
def read_raw_a(spark, sf):
    """S3: Parquet with other columns in it, read with the narrow nested schema."""
    path = scratch_path(spark, "raw-a")
    writers.write_replace(views.raw_a(spark, sf), path)
    schema = schemas.struct(event_id=schemas.L, **{f.name: f.dataType for f in schemas.PROVIDER_A})
    return shown_a(flatten_a(readers.read_raw(spark, path, schema), ["event_id"]))


COLUMNS_B = ["apparent_temperature", "rain", "precipitation", "showers", "snowfall", "temperature_2m",
             "pressure_msl", "surface_pressure", "elevation"]
RAW_B_SQL = f"""
with {B}
select event_id, city_name, is_day::bigint as is_day, relative_humidity_2m,
       {', '.join(f'{r(c)} as {c}' for c in COLUMNS_B)}
from b"""


@query("flatten_b", RAW_B_SQL)
def flatten_provider_b(spark, sf):
    """Nested record of provider B to flat columns."""
    return rounded(flatten_b(views.raw_b(spark, sf), ["event_id"]), COLUMNS_B)


@query("read_raw_b", RAW_B_SQL)
def read_raw_b(spark, sf):
    """As above for provider B, from JSON messages landed as Parquet (whole numbers included)."""
    topic, path = scratch_path(spark, "topic-b"), scratch_path(spark, "raw-b")
    schema = schemas.struct(event_id=schemas.L, **{f.name: f.dataType for f in schemas.PROVIDER_B})
    writers.publish(writers.to_messages(views.raw_b(spark, sf), "city_name"), topic)
    records, _ = decode_messages(readers.read_messages(spark, topic), schema)
    writers.write_replace(records, path)
    return rounded(flatten_b(readers.read_raw(spark, path, schema), ["event_id"]), COLUMNS_B)


@query("flatten_json", f"""
with {EV} select event_type, count(*) as n, sum(k)::bigint as sum_k, min(k) as min_k, max(k) as max_k
from ev group by event_type""")
def flatten_json(spark, sf):
    """A JSON text column to a struct to flat columns."""
    parsed = views.table(spark, sf, "events").withColumn("p", F.from_json("props", "k long"))
    return flatten(parsed, {"k": "p.k"}, ["event_type"]).groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("k").alias("sum_k"), F.min("k").alias("min_k"), F.max("k").alias("max_k")
    )


@query("csv_history", """
select city_name, count(*) as n, """ + ", ".join(
    f"count({v}) as n_{v}, {r(f'avg({v})')} as mean_{v}" for v in schemas.FORECAST_VARIABLES
) + """, strftime(max(time), '%Y-%m-%d %H:%M:%S') as last_time
from (select 'S' || user_id as city_name, ts as time,
        case when event_type <> 'error' then k end as humidity, 1000 + k % 40 as pressure,
        case when event_type <> 'signup' then 1010 + k % 7 end as sea_level, value / 10 - 10 as temp,
        10000 - k * 50 as visibility, k / 10 as wind_speed
      from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events))
group by city_name""")
def csv_history(spark, sf):
    """CSV with header and typed time, written and read back."""
    path = scratch_path(spark, "history")
    writers.write_csv(views.history(spark, sf), path)
    means = [x for v in schemas.FORECAST_VARIABLES
             for x in (F.count(v).alias(f"n_{v}"), fixed(F.avg(v)).alias(f"mean_{v}"))]
    return readers.read_history(spark, path).groupBy("city_name").agg(
        F.count("*").alias("n"), *means, time_text(F.max("time")).alias("last_time")
    )


@query("read_or_empty", """
select 'missing' as part, 0::bigint as n, 5 as width union all
select 'present', count(*), 5 from lineitem""")
def read_or_empty(spark, sf):
    """Data that is there, and data that is not, with the same columns."""
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    schema = views.table(spark, sf, "lineitem").select(*names).schema
    parts = [
        readers.read_or_empty(spark, f"{sf}/{file}", schema)
        for file in ("lineitem.parquet", "no_such_table.parquet")
    ]
    counted = [
        row_count(p, "n").select(F.lit(name).alias("part"), "n", F.lit(len(p.columns)).alias("width"))
        for name, p in zip(("present", "missing"), parts)
    ]
    return counted[0].unionByName(counted[1])


@query("point_lookup", """
select event_id, event_type, value from events
where user_id = (select user_id from events order by event_id limit 1)
  and ts = (select ts from events order by event_id limit 1)""")
def point_lookup(spark, sf):
    """One row by its full key, here that of the first event."""
    events = views.table(spark, sf, "events")
    first = events.orderBy("event_id").select("user_id", "ts").first()
    return readers.lookup(events, first.asDict()).select("event_id", "event_type", "value")


@query("lookup_many", """
select l_orderkey, l_linenumber, l_quantity from lineitem
where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT')""")
def lookup_many(spark, sf):
    """S11 in bulk: rows whose key is among many wanted ones."""
    wanted = views.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    lines = views.table(spark, sf, "lineitem")
    return readers.lookup_many(
        lines, wanted.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"]
    ).select("l_orderkey", "l_linenumber", "l_quantity")


COUNTED = ["customer", "events", "lineitem", "orders", "part", "supplier"]


@query("row_count", " union all ".join(f"select '{t}' as name, count(*) as n from {t}" for t in COUNTED))
def count_rows(spark, sf):
    """S12."""
    parts = [
        row_count(views.table(spark, sf, t), "n").select(F.lit(t).alias("name"), "n") for t in COUNTED
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("cities_dimension", f"""
select n_name as city, {r('24 + n_nationkey * 0.5')} as latitude, {r('n_nationkey - 12.25')} as longitude,
       count(*) as n_customers
from customer join nation on c_nationkey = n_nationkey group by n_name, n_nationkey""")
def cities_dimension(spark, sf):
    """The city list as CSV, joined with its rows by a name key that forgives spelling."""
    path = scratch_path(spark, "cities")
    key = F.col("n_nationkey")
    nations = views.table(spark, sf, "nation")
    writers.write_csv(
        nations.select(F.col("n_name").alias("City"), (key * 0.5 + 24).alias("Latitude"), (key - 12.25).alias("Longitude")),
        path,
    )
    cities = readers.read_cities(spark, path).withColumn("_key", readers.city_key("city"))
    customers = views.table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    counts = customers.groupBy("n_nationkey").agg(F.count("*").alias("n_customers"))
    named = lookup_join(counts, nations, ["n_nationkey"]).select(
        readers.city_key(F.lower("n_name")).alias("_key"), "n_customers"
    )
    return rounded(named.join(cities, "_key").drop("_key"), ["latitude", "longitude"])


@query("write_replace", """
select l_returnflag, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem
where l_linestatus = 'F' group by l_returnflag""")
def write_replace(spark, sf):
    """The second write replaces the first, an empty third one leaves it alone."""
    path, lines = scratch_path(spark, "replace"), views.table(spark, sf, "lineitem")
    writers.write_replace(lines, path)
    writers.write_replace(lines.where("l_linestatus = 'F'"), path)
    writers.write_replace(lines.where("l_linestatus is null"), path)
    return readers.read_table(spark, path).groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query("csv_snapshot", f"""
with {EV}
select 'S' || user_id as city_name, {text("ts")} as time, {r('value / 10 - 10')} as temp, k / 10 as wind_speed
from ev order by ts desc, 'S' || user_id limit 37""")
def csv_snapshot(spark, sf):
    """The 37 newest rows, replaced as CSV with header, read back."""
    path = scratch_path(spark, "snapshot")
    writers.write_csv(snapshot(views.history(spark, sf)), path)
    rows = readers.read_history(spark, path).select("city_name", time_text("time").alias("time"), "temp", "wind_speed")
    return rounded(rows, ["temp"])


@query("csv_predictions", f"""
with {EV}, sent as (
  select user_id, event_type, ts, case when event_type <> 'view' then value end as value, case when event_type <> 'click' then ts end as made from ev)
select 'S' || user_id as city_name, event_type as variable, {text("min_by(ts, ts)")} as time,
       {r('min_by(value, ts) filter (value is not null)')} as predicted_value, {text("min(made) + interval 10 minute")} as time_of_prediction
from sent group by user_id, event_type""")
def csv_predictions(spark, sf):
    """All part files of a prediction folder by the header of each, first per city and variable. The parts of
    purchases have their columns in another order and one more, those of views no value, those of clicks no time of prediction."""
    path, ev = scratch_path(spark, "predictions"), views.events(spark, sf)
    rows = ev.select(
        F.col("station").alias("city_name"), F.col("ts").alias("time"), F.col("event_type").alias("variable"),
        F.col("value").alias("predicted_value"), (F.col("ts") + F.expr("INTERVAL 10 MINUTES")).alias("time_of_prediction"))
    kind = F.col("variable")
    writers.write_csv(rows.where(~kind.isin("purchase", "view", "click")), path)
    for part in (
        rows.where(kind == "purchase").select("variable", "time_of_prediction", F.lit('a "name", quoted').alias("note"), "predicted_value", "time", "city_name"),
        rows.where(kind == "view").drop("predicted_value"), rows.where(kind == "click").select("predicted_value", "variable", "city_name", "time"),
    ):
        part.write.mode("append").option("header", True).csv(path)
    good, _ = readers.read_predictions(spark, path)
    first = readers.first_predictions(good)
    return rounded(
        first.withColumns({c: time_text(c) for c in ("time", "time_of_prediction")}), ["predicted_value"]
    )


@query("upsert_older", f"""
with {EV}, ranked as (
  select *, row_number() over (partition by station, date_trunc('day', ts) order by event_id desc) as rn from ev)
select station as city_name, {text("date_trunc('day', ts)")} as time, event_id,
       {r("case when event_type <> 'error' then value end")} as temp
from ranked where rn = 1""")
def upsert_older(spark, sf):
    """K5: newer versions first, older ones after them in several calls; the newest stays."""
    path, ev = scratch_path(spark, "table"), views.events(spark, sf)
    for part in ("event_id % 3 = 0", "event_id % 3 = 2", "event_id % 3 = 1"):
        writers.upsert(spark, path, daily(ev.where(part)), schemas.OBSERVATION_KEY, ["event_id"], DAILY)
    rows = readers.read_table(spark, path).select(*DAILY.fieldNames())
    return rounded(rows.withColumn("time", time_text("time")), ["temp"])


UPSERT_SQL = f"""
with {EV}, ranked as (
  select station as city_name, date_trunc('day', ts) as time, event_id, value, event_type,
         row_number() over (partition by station, date_trunc('day', ts)
           order by event_id desc) as rn
  from ev)
select city_name, {text('time')} as time, event_id,
       {r("case when event_type <> 'error' then value end")} as temp
from ranked where rn = 1"""


def daily(ev):
    """Rows keyed by station and day; an error carries a null reading."""
    return ev.select(
        F.col("station").alias("city_name"), F.date_trunc("day", "ts").alias("time"), "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("temp"),
    )


DAILY = schemas.struct(city_name=schemas.S, time=schemas.TS, event_id=schemas.L, temp=schemas.D)


def upsert_twice(spark, sf, times):
    path, ev = scratch_path(spark, "table"), views.events(spark, sf)
    later = F.col("event_type").isin(views.TYPES_B)
    seq = ["event_id"]
    writers.upsert(spark, path, daily(ev.where(~later)), schemas.OBSERVATION_KEY, seq, DAILY)
    for _ in range(times):
        writers.upsert(spark, path, daily(ev.where(later)), schemas.OBSERVATION_KEY, seq, DAILY)
    rows = readers.read_table(spark, path).select(*DAILY.fieldNames())
    return rounded(rows.withColumn("time", time_text("time")), ["temp"])


@query("upsert_lww", UPSERT_SQL)
def upsert_lww(spark, sf):
    """K5: base and updates by key, last write wins on the whole row, nulls included."""
    return upsert_twice(spark, sf, 1)


@query("upsert_again", UPSERT_SQL)
def upsert_again(spark, sf):
    """The same updates once more change nothing."""
    return upsert_twice(spark, sf, 2)


@query("table_columns", f"""
with {AB}, pa as (select *, row_number() over (partition by name, date_trunc('day', ts)
                    order by ts desc, event_id desc) as rn from a),
     pb as (select *, row_number() over (partition by city_name, date_trunc('day', ts)
                    order by ts desc, event_id desc) as rn from b)
select pa.name as city_name, {text('pa.time')} as time, {r('(pa.temp + pb.temperature_2m) / 2')} as temperature_2m,
       {r('(pb.relative_humidity_2m + pa.humidity) / 2')} as humidity, pa.pressure::double as pressure,
       pa.wind_deg::double as wind_deg, pb.is_day::integer as is_day, {text('pa.sunrise')} as sunrise, 28 as width
from pa join pb on pa.name = pb.city_name and date_trunc('day', pa.ts) = date_trunc('day', pb.ts)
where pa.rn = 1 and pb.rn = 1""")
def stored_columns(spark, sf):
    """K6, K7: the 28 stored columns of the blended rows, cast to the types of the table."""
    from metframe.plans.catalog.blending import blended

    rows, _ = conform(table_columns(blended(spark, sf)), schemas.OBSERVATIONS)
    out = rows.select(
        "city_name", time_text("time").alias("time"), "temperature_2m", "humidity", "pressure", "wind_deg",
        "is_day", time_text("sunrise").alias("sunrise"), F.lit(len(rows.columns)).alias("width"),
    )
    return rounded(out, ["temperature_2m", "humidity"])


@query("conform_rejects", """
select l_returnflag, count(*) as n, count(*) filter (where try_cast(l_comment as bigint) is null) as n_rejected
from (select *, case when l_linenumber = 7 then l_returnflag || l_linenumber
             else cast(l_partkey as varchar) end as l_comment from lineitem)
group by l_returnflag""")
def conform_rejects(spark, sf):
    """K7, Q2: rows that do not fit are set aside, the others go on."""
    lines = views.table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.when(F.col("l_linenumber") == 7, F.concat("l_returnflag", "l_linenumber"))
        .otherwise(F.col("l_partkey").cast("string")).alias("code"),
    )
    good, bad = conform(lines, schemas.struct(l_returnflag=schemas.S, code=schemas.L))
    marked = good.select("l_returnflag", F.lit(0).alias("bad")).unionByName(bad.select("l_returnflag", F.lit(1).alias("bad")))
    return marked.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count_if(F.col("bad") == 1).alias("n_rejected")
    )


@query("quarantine", """
select sum(case when event_type = 'error' then 0 else 1 end)::bigint as n_records,
       sum(case when event_type = 'error' then 1 else 0 end)::bigint as n_bad,
       sum(case when event_type = 'error' then 0 else event_id end)::bigint as sum_ids
from events""")
def quarantine(spark, sf):
    """Q1: messages that are no JSON are set aside; here those of errors arrive cut short."""
    sent = writers.to_messages(views.table(spark, sf, "events").select(*EVENT_COLUMNS), "user_id")
    broken = F.col("value").contains('"event_type":"error"')
    sent = sent.withColumn("value", F.when(broken, F.expr("left(value, 20)")).otherwise(F.col("value")))
    schema = schemas.struct(event_id=schemas.L, event_type=schemas.S)
    records, bad = decode_messages(sent, schema)
    return records.agg(
        F.count("*").alias("n_records"), F.sum("event_id").alias("sum_ids")
    ).select("n_records", bad.agg(F.count("*")).scalar().alias("n_bad"), "sum_ids")


@query("corrupt_csv", """
select count(*) filter (where event_type not in ('error', 'view')) as n_good,
       count(*) filter (where event_type = 'error') as n_bad, 2::bigint as n_unread,
       round(sum(value) filter (where event_type not in ('error', 'view')), 2) as total from events""")
def corrupt_csv(spark, sf):
    """Lines that do not parse, a part that is no text, one without the key columns (the views) and an empty one do
    not stop the scan; the first two are listed."""
    path, ev = scratch_path(spark, "parts"), views.events(spark, sf)
    is_bad = F.col("event_type") == "error"
    ev.where("event_type <> 'view'").select(
        F.col("station").alias("city_name"), F.col("ts").alias("time"), F.col("event_type").alias("variable"),
        F.when(is_bad, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("predicted_value"),
        F.col("ts").alias("time_of_prediction"),
    ).write.option("header", True).csv(path)
    ev.where("event_type = 'view'").select("station", "value").coalesce(1).write.mode("append").option("header", True).csv(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, content in (("broken.csv", bytes(range(128, 256)) * 9), ("empty.csv", b"")):
        out = fs.create(hadoop(f"{path}/{name}"))
        out.write(bytearray(content))
        out.close()
    good, bad = readers.read_predictions(spark, path)
    return good.agg(F.count("*").alias("n_good"), F.round(F.sum("predicted_value"), 2).alias("total")).select(
        "n_good", bad.agg(F.count("*")).scalar().alias("n_bad"), readers.unread_parts(spark, path).agg(F.count("*")).scalar().alias("n_unread"), "total"
    )


@query("configured_keys", """
select event_type, count(*) as n, round(sum(value), 2) as total from events
where user_id in (select c_custkey from customer where c_mktsegment in ('BUILDING', 'MACHINERY'))
group by event_type""")
def configured_keys(spark, sf):
    """rows whose key is on a list."""
    listed = views.table(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    rows = only_keys(
        views.table(spark, sf, "events"), listed.select(F.col("c_custkey").alias("user_id")), ["user_id"]
    )
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("batch_run", f"""
with {AB}
, placed as (
  select *, floor(epoch(strptime(time, '%Y-%m-%dT%H:%M')) / 600) as slot from b),
newest as (
  select *, row_number() over (partition by city_name, slot order by time desc) as rn from placed)
select name as city_name, {text('a.time')} as time, {r('temp')} as temp, {r('wind_speed')} as wind_speed, country,
       {r('(temp + newest.temperature_2m) / 2')} as temperature_2m, {r('(humidity + relative_humidity_2m) / 2')} as humidity,
       {r('elevation')} as elevation
from a join newest on name = city_name and floor(epoch(a.time) / 600) = slot and rn = 1""")
def batch_run(spark, sf):
    """The whole feeds as one batch through every stage, then the table."""
    places = Places(*[scratch_path(spark, n) for n in ("a", "b", "table", "snapshot", "predictions", "models")])
    topics = scratch_path(spark, "topic-a"), scratch_path(spark, "topic-b")
    writers.publish(writers.to_messages(views.raw_a(spark, sf), "name"), topics[0])
    writers.publish(writers.to_messages(views.raw_b(spark, sf), "city_name"), topics[1])
    run_batch(spark, *topics, places)
    table = readers.read_table(spark, places.table)
    names = ["temp", "wind_speed", "temperature_2m", "humidity", "elevation"]
    return rounded(table.select("city_name", time_text("time").alias("time"), "country", *names), names)
