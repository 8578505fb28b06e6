"""Shape, joins, means, bins and set operations over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from metframe.functions.expr import (
    abs_error, bin_index, cut, mean2, or_infinity, parse_time, root_mean_square, shift_time, slot, time_text,
)
from metframe.operators.bins import bin_counts, histogram
from metframe.operators.blend import BLENDS, blend_sources, flatten_a, flatten_b
from metframe.operators.series import in_time_order, latest_per, preview
from metframe.operators.shape import (
    drop_columns, keep_columns, rename, split_struct, suffix_except, tag, to_long, to_wide,
)
from metframe.operators.skew import lookup_join
from metframe.operators.stations import label_by_position, missing_keys, nearest_station
from metframe.operators.summary import compare_sources, mean_by, rmse
from metframe.plans import views
from metframe.plans.catalog.registry import AB, EV, fixed, query, r, rounded, text


@query("array_field", """
select doc_id, array_to_string([length(x) for x in string_split(text, chr(10))], ',') as line_lengths
from documents""")
def array_field(spark, sf):
    """One field of an array of structs as an array, here of the lines of a text."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), F.length(x).alias("n")))
    docs = views.table(spark, sf, "documents").select("doc_id", lines.alias("lines"))
    return docs.select("doc_id", F.array_join(F.col("lines.n").cast("array<string>"), ",").alias("line_lengths"))


@query("null_parents", f"""
with {AB}
select event_id, temp_max::double is null as no_main, {r('temp_max')} as temp_max, clouds_all as clouds from a""")
def null_parents(spark, sf):
    """A field below a missing parent is null, its neighbours are kept."""
    raw = views.raw_a(spark, sf)
    return raw.select(
        "event_id", F.col("main").isNull().alias("no_main"), fixed("main.temp_max").alias("temp_max"),
        F.col("clouds.all").alias("clouds"),
    )


@query("column_edits", """
select o_orderkey as order_id, o_totalprice as total_reel, o_orderstatus as status_reel, 'orders' as source
from orders""")
def column_edits(spark, sf):
    """Select, drop (absent names too), rename, suffix all but the key, tag."""
    rows = drop_columns(views.table(spark, sf, "orders"), ["o_orderdate", "o_orderpriority", "no_such_column"])
    rows = rename(rows, {"o_orderkey": "order_id", "o_totalprice": "total", "o_orderstatus": "status"})
    rows = keep_columns(rows, ["order_id", "total", "status"])
    return tag(suffix_except(rows, ["order_id"], "_reel"), "source", "orders")


@query("struct_split", f"""
with {EV} select event_id, {r('value * 2')} as predicted_value, {text('ts + interval 10 minute')} as time_of_prediction
from ev""")
def struct_split(spark, sf):
    """A struct result as columns; time plus ten minutes."""
    ev = views.events(spark, sf)
    pair = F.struct((F.col("value") * 2).alias("predicted_value"), shift_time("ts").alias("time_of_prediction"))
    out = split_struct(ev.select("event_id", pair.alias("p")), "p")
    return rounded(out.withColumn("time_of_prediction", time_text("time_of_prediction")), ["predicted_value"])


@query("scalar_expressions", f"""
with {EV}
select event_id, {r('(value + k) / 2')} as both_mean, {r('abs(value - k)')} as error, value::double as as_double,
       cast(floor(epoch_us(ts) / 600000000.0) as bigint) as slot,
       case when event_type = 'error' then cast('infinity' as double) else value end as score,
       {text("case when event_type <> 'error' then ts end")} as parsed
from ev""")
def scalar_expressions(spark, sf):
    """E1, E6, E10, E11, E16 and the time slot."""
    ev = views.events(spark, sf)
    shown = F.when(F.col("event_type") == "error", F.lit("no time")).otherwise(time_text("ts"))
    return ev.select(
        "event_id", fixed(mean2("value", "k")).alias("both_mean"), fixed(abs_error("value", "k")).alias("error"),
        F.col("value").cast("double").alias("as_double"), slot("ts", 600).alias("slot"),
        or_infinity(F.when(F.col("event_type") != "error", F.col("value"))).alias("score"),
        time_text(parse_time(shown)).alias("parsed"),
    )


BLEND_SQL = f"""
select n_name, {r('a.m')} as customers, {r('b.m')} as suppliers, {r('(a.m + b.m) / 2')} as blended
from (select c_nationkey as k, avg(c_acctbal) as m from customer group by 1) a
join (select s_nationkey as k, avg(s_acctbal) as m from supplier group by 1) b using (k)
join nation on n_nationkey = k"""


@query("blend_join", BLEND_SQL)
def blend_join(spark, sf):
    """One row per key on each side, inner join, mean of both."""
    nation = views.table(spark, sf, "nation")
    a = mean_by(views.table(spark, sf, "customer"), ["c_nationkey"], {"customers": "c_acctbal"})
    b = mean_by(views.table(spark, sf, "supplier"), ["s_nationkey"], {"suppliers": "s_acctbal"})
    both = blend_sources(
        rename(a, {"c_nationkey": "n_nationkey"}), rename(b, {"s_nationkey": "n_nationkey"}), ["n_nationkey"],
        {"blended": ("customers", "suppliers")},
    )
    named = lookup_join(both, nation.select("n_nationkey", "n_name"), ["n_nationkey"])
    return rounded(named.select("n_name", "customers", "suppliers", "blended"), ["customers", "suppliers", "blended"])


def blended(spark, sf):
    """Newest reading per station and day of each provider, joined on station and day."""
    newest = [F.desc("ts"), F.desc("event_id")]
    ev = views.events(spark, sf)
    a = flatten_a(views.nested_a(ev), ["event_id", "ts"])
    b = flatten_b(views.nested_b(ev), ["event_id", "ts"])
    a, b = a.withColumn("_day", slot("ts", 86_400)), b.withColumn("_day", slot("ts", 86_400))
    a, b = (latest_per(x, ["city_name", "_day"], newest).drop("event_id", "ts") for x in (a, b))
    return blend_sources(a, b, ["city_name", "_day"], BLENDS)


@query("blend_observations", f"""
with {AB}, pa as (select *, row_number() over (partition by name, date_trunc('day', ts)
                    order by ts desc, event_id desc) as rn from a),
     pb as (select *, row_number() over (partition by city_name, date_trunc('day', ts)
                    order by ts desc, event_id desc) as rn from b)
select pa.name as city_name, {text('pa.time')} as time, pa.weather_description,
       {r('(pb.relative_humidity_2m + pa.humidity) / 2')} as humidity,
       {r('(pb.apparent_temperature + pa.feels_like) / 2')} as temperature_feels_like,
       {r('(pa.temp + pb.temperature_2m) / 2')} as temperature_2m, {r('pa.temp')} as temp, pb.relative_humidity_2m,
       {r('pb.elevation')} as elevation
from pa join pb on pa.name = pb.city_name and date_trunc('day', pa.ts) = date_trunc('day', pb.ts)
where pa.rn = 1 and pb.rn = 1""")
def blend_observations(spark, sf):
    """J1, E1 to E3, P12 on the two feeds: raw readings are kept where a blend has its own name."""
    out = blended(spark, sf).select(
        "city_name", time_text("time").alias("time"), F.array_join("weather_description", ",").alias("weather_description"),
        "humidity", "temperature_feels_like", "temperature_2m", "temp", "relative_humidity_2m", "elevation",
    )
    return rounded(out, ["humidity", "temperature_feels_like", "temperature_2m", "temp", "elevation"])


@query("blend_slots", f"""
with {AB}, pa as (select *, floor(epoch(ts) / 600) as slot, row_number() over (partition by name, time
                    order by ts desc, event_id desc) as rn from a),
     pb as (select *, floor(epoch(ts) / 600) as slot, row_number() over (partition by city_name, floor(epoch(ts) / 600)
                    order by ts desc, event_id desc) as rn from b)
select pa.name as city_name, {text('pa.time')} as time, pa.weather_description,
       {r('(pb.relative_humidity_2m + pa.humidity) / 2')} as humidity,
       {r('(pb.apparent_temperature + pa.feels_like) / 2')} as temperature_feels_like,
       {r('(pa.temp + pb.temperature_2m) / 2')} as temperature_2m, {r('pa.temp')} as temp, pb.relative_humidity_2m,
       {r('pb.elevation')} as elevation
from pa join pb on pa.name = pb.city_name and pa.slot = pb.slot
where pa.rn = 1 and pb.rn = 1""")
def blend_slots(spark, sf):
    """J1, E1 to E3, P12 on all readings: provider A's by city and time meet the newest of provider B in their slot."""
    newest = [F.desc("ts"), F.desc("event_id")]
    ev = views.events(spark, sf)
    a = latest_per(flatten_a(views.nested_a(ev), ["event_id", "ts"]), ["city_name", "time"], newest)
    a = a.withColumn("_slot", slot("ts", 600)).drop("event_id", "ts")
    b = flatten_b(views.nested_b(ev), ["event_id", "ts"]).withColumn("_slot", slot("ts", 600))
    b = latest_per(b, ["city_name", "_slot"], newest).drop("event_id", "ts")
    out = blend_sources(a, b, ["city_name", "_slot"], BLENDS).select(
        "city_name", time_text("time").alias("time"), F.array_join("weather_description", ",").alias("weather_description"),
        "humidity", "temperature_feels_like", "temperature_2m", "temp", "relative_humidity_2m", "elevation",
    )
    return rounded(out, ["humidity", "temperature_feels_like", "temperature_2m", "temp", "elevation"])


@query("mean_one", f"select event_type, {r('avg(value)')} as value from events group by event_type")
def mean_one(spark, sf):
    """A1."""
    return rounded(mean_by(views.table(spark, sf, "events"), ["event_type"], ["value"]), ["value"])


@query("mean_two", f"""
select l_returnflag, {r('avg(l_quantity)')} as l_quantity, {r('avg(l_discount)')} as l_discount
from lineitem group by l_returnflag""")
def mean_two(spark, sf):
    """A2."""
    means = mean_by(views.table(spark, sf, "lineitem"), ["l_returnflag"], ["l_quantity", "l_discount"])
    return rounded(means, ["l_quantity", "l_discount"])


@query("source_compare", f"""
select c_nationkey as nation, {r('avg(c_acctbal)')} as acctbal, 'customers' as source from customer group by 1
union all
select s_nationkey, {r('avg(s_acctbal)')}, 'suppliers' from supplier group by 1""")
def source_compare(spark, sf):
    """Mean per key of two tagged sources, stacked."""
    out = compare_sources(
        {"customers": (views.table(spark, sf, "customer"), "c_nationkey", "c_acctbal"),
         "suppliers": (views.table(spark, sf, "supplier"), "s_nationkey", "s_acctbal")},
        "nation", "acctbal",
    )
    return rounded(out, ["acctbal"])


def bins_sql(table, column, edges, labels, upper=False):
    rows = ", ".join(
        f"('{name}', {lo}, {hi}, {'true' if upper and i == len(labels) - 1 else 'false'})"
        for i, (name, lo, hi) in enumerate(zip(labels, edges, edges[1:]))
    )
    return f"""
select b.label as "range", count(t.x) as count
from (values {rows}) b(label, lo, hi, closed)
left join (select {column} as x from {table}) t on t.x >= b.lo and (t.x < b.hi or (b.closed and t.x = b.hi))
group by b.label"""


VALUE_EDGES, VALUE_LABELS = [0, 30, 60, 90, 100], ["<30", "30-60", "60-90", ">=90"]
BALANCE_EDGES = [-5000, -2000, 0, 2500, 5000, 9000]
BALANCE_LABELS = ["deep", "debt", "low", "middle", "high"]


@query("bin_counts", bins_sql("events", "value", VALUE_EDGES, VALUE_LABELS))
def bin_counts_values(spark, sf):
    """Left-closed bins, values beyond the last edge in none."""
    return bin_counts(views.table(spark, sf, "events"), "value", VALUE_EDGES, VALUE_LABELS)


@query("bin_counts_empty", bins_sql("customer", "c_acctbal", BALANCE_EDGES, BALANCE_LABELS))
def bin_counts_empty(spark, sf):
    """A bin without rows has a row with count 0."""
    return bin_counts(views.table(spark, sf, "customer"), "c_acctbal", BALANCE_EDGES, BALANCE_LABELS)


@query("bin_counts_upper", bins_sql("lineitem", "l_quantity", [1, 10, 25, 50], ["few", "some", "many"], True))
def bin_counts_upper(spark, sf):
    """E9 with the last bin closed."""
    return bin_counts(
        views.table(spark, sf, "lineitem"), "l_quantity", [1, 10, 25, 50], ["few", "some", "many"],
        include_upper=True,
    )


@query("bin_labels", """
select event_id, case when value >= 0 and value < 30 then '<30' when value >= 30 and value < 60 then '30-60'
  when value >= 60 and value < 90 then '60-90' when value >= 90 and value < 100 then '>=90' end as label,
  case when value >= 0 and value < 30 then 0 when value >= 30 and value < 60 then 1
  when value >= 60 and value < 90 then 2 when value >= 90 and value < 100 then 3 end::integer as number
from events""")
def bin_labels(spark, sf):
    """Label and number of the bin per row, null outside."""
    return views.table(spark, sf, "events").select(
        "event_id", cut("value", VALUE_EDGES, VALUE_LABELS).alias("label"),
        bin_index("value", VALUE_EDGES).alias("number"),
    )


@query("histogram30", """
with b as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem)
select least(floor((l_extendedprice - lo) / nullif((hi - lo) / 30, 0)), 29)::integer as bin, count(*) as count
from lineitem, b group by 1""")
def histogram30(spark, sf):
    """A9."""
    return histogram(views.table(spark, sf, "lineitem"), "l_extendedprice", 30)


LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("wide_to_long", " union all ".join(
    f"select l_orderkey, l_linenumber, l_partkey, '{m}' as variable, {m} as value from lineitem" for m in LINE_MEASURES
))
def wide_to_long(spark, sf):
    """One pass for all variables; one the table lacks is skipped."""
    return to_long(
        views.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], [*LINE_MEASURES, "l_no_such"]
    )


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("long_to_wide", "select user_id, " + ", ".join(
    f"min(value) filter (where event_type = '{t}') as {t}_predit" for t in EVENT_TYPES
) + " from events group by user_id")
def long_to_wide(spark, sf):
    """A8."""
    return to_wide(
        views.table(spark, sf, "events"), ["user_id"], EVENT_TYPES, "event_type", "value", "_predit"
    )


@query("missing_keys", """
select c_custkey, c_name from customer where not exists (select 1 from events where user_id = c_custkey)""")
def keys_without_rows(spark, sf):
    """listed keys without data."""
    seen = views.table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return missing_keys(views.table(spark, sf, "customer").select("c_custkey", "c_name"), seen, ["c_custkey"])


@query("series_filter", """
select event_id, value from events where event_type = 'purchase'""")
def series_filter(spark, sf):
    """equality on the series key, pushed into the scan."""
    return views.table(spark, sf, "events").where(F.col("event_type") == "purchase").select("event_id", "value")


NEAREST_SQL = """
with spot as (select c_custkey, -60 + (c_custkey * 7 % 120) as lat, -180 + (c_custkey * 13 % 360) as lon from customer),
     site as (select n_name, -50 + n_nationkey * 4 as slat, -170 + n_nationkey * 14 as slon from nation),
     d as (select c_custkey, n_name, 2 * 6371.0088 * asin(sqrt(least(
             pow(sin(radians(slat - lat) / 2), 2)
             + cos(radians(lat)) * cos(radians(slat)) * pow(sin(radians(slon - lon) / 2), 2), 1.0))) as km
           from spot, site)
select c_custkey, min_by(n_name, (round(km, 6), n_name)) as station, round(min(km), 3) as distance_km from d group by c_custkey"""


def spots_and_sites(spark, sf):
    key, nation = F.col("c_custkey"), F.col("n_nationkey")
    spots = views.table(spark, sf, "customer").select(
        "c_custkey", (key * 7 % 120 - 60).cast("double").alias("lat"), (key * 13 % 360 - 180).cast("double").alias("lon")
    )
    sites = views.table(spark, sf, "nation").select(
        "n_name", (nation * 4 - 50).cast("double").alias("slat"), (nation * 14 - 170).cast("double").alias("slon")
    )
    return spots, sites


@query("nearest_station", NEAREST_SQL)
def nearest(spark, sf):
    """Nearest listed station, the list searched as an array constant."""
    spots, sites = spots_and_sites(spark, sf)
    got = nearest_station(spots, sites, "lat", "lon", "n_name", "slat", "slon")
    return got.select("c_custkey", "station", F.round("distance_km", 3).alias("distance_km"))


@query("nearest_station_cells", NEAREST_SQL)
def nearest_by_grid(spark, sf):
    """J2 for a long list: the same through a tree of cells."""
    spots, sites = spots_and_sites(spark, sf)
    got = nearest_station(spots, sites, "lat", "lon", "n_name", "slat", "slon", inline=0)
    return got.select("c_custkey", "station", F.round("distance_km", 3).alias("distance_km"))


@query("positional_label", """
select event_id, n_name as label from (
  select event_id, row_number() over (partition by ts::date order by ts, event_id) as pos from events) e
join nation on n_nationkey + 1 = pos""")
def positional_label(spark, sf):
    """Per daily batch the i-th message gets the i-th name; later messages are not taken."""
    ev = views.events(spark, sf).withColumn("day", F.to_date("ts"))
    names = views.table(spark, sf, "nation").select((F.col("n_nationkey") + 1).alias("ordinal"), "n_name")
    return label_by_position(ev, ["day"], ["ts", "event_id"], names, "ordinal", "n_name", "label").select(
        "event_id", "label"
    )


@query("rmse_by_key", f"""
select l_returnflag, {r('sqrt(avg(pow(l_extendedprice - l_quantity * 1000, 2)))', 4)} as rmse
from lineitem group by l_returnflag""")
def rmse_by_key(spark, sf):
    """A10."""
    lines = views.table(spark, sf, "lineitem").withColumn("guess", F.col("l_quantity") * 1000)
    return rounded(rmse(lines, ["l_returnflag"], "l_extendedprice", "guess"), ["rmse"], 4)


@query("rmse_overall", f"select {r('sqrt(avg(pow(value - 50, 2)))', 4)} as rmse from events")
def rmse_overall(spark, sf):
    """A10 as an aggregate expression."""
    return views.table(spark, sf, "events").agg(fixed(root_mean_square(F.col("value") - 50), 4).alias("rmse"))


@query("time_order", f"""
with {EV} select {text('ts')} as time, event_id from ev order by ts, event_id""")
def time_order(spark, sf):
    """Sorted by a range shuffle."""
    ordered = in_time_order(views.events(spark, sf), ["ts", "event_id"])
    return ordered.select(time_text("ts").alias("time"), "event_id")


@query("preview_rows", "select event_id, event_type, value from events order by event_id limit 10")
def preview_rows(spark, sf):
    """The first rows of a sorted frame."""
    events = views.table(spark, sf, "events").orderBy("event_id")
    return preview(events, 10).select("event_id", "event_type", "value")
