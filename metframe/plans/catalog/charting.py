"""The chart queries over the feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from metframe import schemas
from metframe.functions.expr import time_text
from metframe.plans import charts, views
from metframe.plans.catalog.registry import A, AB, B, query, r, rounded, text


def bins_sql(cte, column, edges, labels, label):
    rows = ", ".join(f"({i}, '{n}', {lo}, {hi})" for i, (n, lo, hi) in enumerate(zip(labels, edges, edges[1:])))
    return f"""
with {cte[0]}
select b.label as "{label}", count(t.x) as "Count"
from (values {rows}) b(i, label, lo, hi) left join (select {column} as x from {cte[1]}) t
  on t.x >= b.lo and t.x < b.hi
group by b.i, b.label order by 2 desc, b.i"""


def histogram_sql(column):
    return f"""
with {A}, v as (select {column}::double as x from a where {column} is not null),
     m as (select min(x) as lo, max(x) as hi from v)
select least(coalesce(floor((x - lo) / nullif((hi - lo) / 30, 0)), 0), 29)::integer as bin, count(*) as count
from v, m group by 1"""


@query("chart_presentation_a", f"""
with {A}
select event_id, name as city, visibility, {r('temp')} as temperature, {r('temp_max')} as temperature_max,
       {r('temp_min')} as temperature_min, {r('feels_like')} as feels_like, humidity, sea_level, grnd_level,
       {r('wind_speed')} as wind_speed, wind_deg, clouds_all as clouds, country, {r('latitude')} as latitude,
       {r('longitude')} as longitude, {text('time')} as time
from a""")
def presentation_a(spark, sf):
    """C1."""
    out = charts.presentation_a(views.raw_a(spark, sf)).drop("ts").withColumn("time", time_text("time"))
    return rounded(out, ["temperature", "temperature_max", "temperature_min", "feels_like", "wind_speed",
                         "latitude", "longitude"])


MEASURES_B = ["apparent_temperature", "precipitation", "pressure_msl", "rain", "showers", "snowfall",
              "surface_pressure", "temperature_2m", "latitude", "longitude", "elevation"]


@query("chart_presentation_b", f"""
with {B}
select event_id, city_name as city, cloud_cover, relative_humidity_2m, time, weather_code,
       {', '.join(f'{r(m)} as {m}' for m in MEASURES_B)}
from b""")
def presentation_b(spark, sf):
    """C2."""
    return rounded(charts.presentation_b(views.raw_b(spark, sf)).drop("ts"), MEASURES_B)


@query("chart_humidity_by_temperature_a", f"with {A} select {r('temp')} as temperature, humidity from a")
def humidity_by_temperature_a(spark, sf):
    """C3."""
    return rounded(charts.humidity_by_temperature_a(views.raw_a(spark, sf)), ["temperature"])


@query("chart_humidity_by_temperature_b",
       f"with {B} select {r('temperature_2m')} as temperature_2m, relative_humidity_2m from b")
def humidity_by_temperature_b(spark, sf):
    """C3."""
    return rounded(charts.humidity_by_temperature_b(views.raw_b(spark, sf)), ["temperature_2m"])


@query("chart_temperature_histogram", histogram_sql("temp"))
def temperature_histogram(spark, sf):
    """C4, A9."""
    return charts.temperature_histogram(views.raw_a(spark, sf))


@query("chart_humidity_histogram", histogram_sql("humidity"))
def humidity_histogram(spark, sf):
    """C4, A9."""
    return charts.humidity_histogram(views.raw_a(spark, sf))


@query("chart_temperature_ranges_a", bins_sql((A, "a"), "temp", schemas.TEMPERATURE_EDGES,
                                              schemas.TEMPERATURE_LABELS, "Temperature Range"))
def temperature_ranges_a(spark, sf):
    """C5, E8, A6."""
    return charts.temperature_ranges(charts.expand_a(views.raw_a(spark, sf)), "temperature")


@query("chart_temperature_ranges_b", bins_sql((B, "b"), "temperature_2m", schemas.TEMPERATURE_EDGES,
                                              schemas.TEMPERATURE_LABELS, "Temperature Range"))
def temperature_ranges_b(spark, sf):
    """C5, E8, A6."""
    return charts.temperature_ranges(charts.expand_b(views.raw_b(spark, sf)), "temperature_2m")


@query("chart_clouds_over_time", f"with {A} select {text('time')} as time, clouds_all as clouds from a")
def clouds_over_time(spark, sf):
    """C6."""
    return charts.clouds_over_time(views.raw_a(spark, sf)).withColumn("time", time_text("time"))


@query("chart_visibility_per_city", f"with {A} select name, {r('avg(visibility)')} as visibility from a group by name")
def visibility_per_city(spark, sf):
    """C7, A1."""
    return rounded(charts.visibility_per_city(views.raw_a(spark, sf)), ["visibility"])


@query("chart_climate_per_city", f"""
with {A}
select name, 'temperature' as variable, {r('avg(temp)')} as value from a group by name
union all select name, 'humidity', {r('avg(humidity)')} from a group by name""")
def climate_per_city(spark, sf):
    """C8, A2, U6."""
    return rounded(charts.climate_per_city(views.raw_a(spark, sf)), ["value"])


def pair_sql(*pairs):
    return f"with {A} " + " union all ".join(
        f"select {text('time')} as time, '{name}' as variable, {r(column)} as value from a" for name, column in pairs
    )


@query("chart_temperature_and_felt", pair_sql(("temperature", "temp"), ("feels_like", "feels_like")))
def temperature_and_felt(spark, sf):
    """C9, U6."""
    out = charts.temperature_and_felt(views.raw_a(spark, sf)).withColumn("time", time_text("time"))
    return rounded(out, ["value"])


@query("chart_temperature_extremes", pair_sql(("temperature_min", "temp_min"), ("temperature_max", "temp_max")))
def temperature_extremes(spark, sf):
    """C9, U6."""
    out = charts.temperature_extremes(views.raw_a(spark, sf)).withColumn("time", time_text("time"))
    return rounded(out, ["value"])


@query("chart_felt_by_pressure", f"""
with {B} select {r('apparent_temperature')} as apparent_temperature, {r('pressure_msl')} as pressure_msl from b""")
def felt_by_pressure(spark, sf):
    """C10."""
    return rounded(charts.felt_by_pressure(views.raw_b(spark, sf)), ["apparent_temperature", "pressure_msl"])


@query("chart_humidity_ranges", bins_sql((B, "b"), "relative_humidity_2m", schemas.HUMIDITY_EDGES,
                                         schemas.HUMIDITY_LABELS, "Humidity Range"))
def humidity_ranges(spark, sf):
    """A humidity of exactly 100 is in no bin."""
    return charts.humidity_ranges(charts.expand_b(views.raw_b(spark, sf)), "relative_humidity_2m")


def comparison(measure, sql_a, sql_b):
    @query(f"chart_compare_{measure}", f"""
with {AB}
select name, {r(f'avg({sql_a})')} as {measure}, 'provider_a' as source from a group by name
union all select city_name, {r(f'avg({sql_b})')}, 'provider_b' from b group by city_name""")
    def compare(spark, sf):
        """C12, A3 to A5, P11, U1 to U3."""
        out = charts.provider_comparison(views.raw_a(spark, sf), views.raw_b(spark, sf), measure)
        return rounded(out, [measure])

    return compare


comparison("temperature", "temp", "temperature_2m")
comparison("humidity", "humidity", "relative_humidity_2m")
comparison("grnd_level", "grnd_level", "surface_pressure")
