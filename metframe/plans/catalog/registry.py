"""Registered queries and the SQL each must agree with."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metframe.functions.expr import as_col

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        @functools.wraps(fn)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = in_utc
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def fixed(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison. The small shift keeps exact halves from falling either way when two
    engines add in a different order."""
    return F.round(as_col(c) + F.lit(1e-9), digits)


def rounded(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: fixed(n, digits) for n in names})


def r(expr: str, digits: int = 6) -> str:
    """The same in SQL."""
    return f"round(({expr}) + 1e-9, {digits})"


# The weather-shaped feeds of ``views``, as common table expressions.
EV = """ev as (
  select event_id, ts, user_id, event_type, value, cast(json_extract_string(props, '$.k') as bigint) as k,
         'S' || user_id as station
  from events)"""

A = EV + """, a as (
  select event_id, ts, station as name, date_trunc('second', ts) as time, event_type, k,
         30 + (user_id % 50) / 10 as latitude, -10 + (user_id % 70) / 10 as longitude,
         case when k % 10 <> 9 then value / 10 - 10 end as temp,
         case when k % 10 <> 9 then value / 10 - 12 end as feels_like,
         case when k % 10 <> 9 then value / 10 - 13 end as temp_min,
         case when k % 10 <> 9 then value / 10 - 8 end as temp_max,
         case when k % 10 <> 9 then k end as humidity,
         case when k % 10 <> 9 then 1000 + k % 40 end as pressure,
         case when k % 10 <> 9 and event_type <> 'signup' then 1010 + k % 7 end as sea_level,
         case when k % 10 <> 9 then 950 + k % 50 end as grnd_level,
         10000 - k * 50 as visibility, k / 10 as wind_speed, k * 3 as wind_deg, k as clouds_all,
         'N' || (user_id % 25) as country,
         date_trunc('day', ts) + interval 6 hour as sunrise, date_trunc('day', ts) + interval 18 hour as sunset,
         event_type || ',k' || (k % 3) as weather_description
  from ev where event_type in ('view', 'click', 'signup'))"""

B_ONLY = """b as (
  select event_id, ts, station as city_name, 30.01 + (user_id % 50) / 10 as latitude,
         -9.99 + (user_id % 70) / 10 as longitude,
         strftime(ts, '%Y-%m-%dT%H:%M') as time, value / 10 - 11 as apparent_temperature,
         case when hour(ts) between 6 and 17 then 1 else 0 end as is_day,
         k / 100 as rain, k / 50 as precipitation, k / 200 as showers, cast(0 as double) as snowfall,
         value / 10 - 9 as temperature_2m, 100 - k as relative_humidity_2m,
         1000 + k / 4 as pressure_msl, 960 + k / 5 as surface_pressure, k as cloud_cover,
         k % 10 as weather_code, user_id * 1.5 as elevation
  from ev where event_type in ('purchase', 'error'))"""

B = EV + ", " + B_ONLY
AB = A + ", " + B_ONLY


def text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
