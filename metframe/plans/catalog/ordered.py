"""Ordered-series queries: one series per user, in time order."""

from __future__ import annotations

from pyspark.sql import functions as F

from metframe.functions.expr import time_text
from metframe.operators.series import (
    chrono_split, diff, ffill, first_per, latest_per, seasonal_diff, top_n,
)
from metframe.operators.skew import find_cuts
from metframe.plans import views
from metframe.plans.catalog.registry import EV, query, r, rounded, text

USER, ORDER = ["user_id"], ["ts", "event_id"]
# With so few rows to a piece every series of the test tables counts as hot.
SMALL_PIECE = 20


@query("top_n_latest", f"with {EV} select event_id, {text('ts')} as time, value from ev order by ts desc, event_id limit 37")
def top_n_latest(spark, sf):
    """Each task keeps 37 rows."""
    rows = top_n(views.events(spark, sf), 37, [F.desc("ts"), F.asc("event_id")])
    return rows.select("event_id", time_text("ts").alias("time"), "value")


@query("latest_per_key", f"""
with {EV} select user_id, event_id, event_type, value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from ev) where rn = 1""")
def latest_per_key(spark, sf):
    """W6."""
    rows = latest_per(views.table(spark, sf, "events"), USER, [F.desc("ts"), F.desc("event_id")])
    return rows.select("user_id", "event_id", "event_type", "value")


@query("first_nonnull", """
select user_id, event_type, arg_min(case when event_id % 3 <> 0 then value end, ts)
         filter (where event_id % 3 <> 0) as value,
       arg_min(case when event_id % 2 <> 0 then props end, ts) filter (where event_id % 2 <> 0) as props
from events group by user_id, event_type""")
def first_nonnull(spark, sf):
    """Each column's own first non-null value."""
    ev = views.events(spark, sf).select(
        "user_id", "event_type", "ts", "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 2 != 0, F.col("props")).alias("props"),
    )
    return first_per(ev, ["user_id", "event_type"], ["ts"], ["value", "props"])


FFILL_SQL = """
with g as (select event_id, user_id, ts, case when event_id % 3 <> 0 then value end as v,
             case when event_type = 'view' then event_type end as label from events)
select event_id, user_id,
       last_value(v ignore nulls) over w as value, last_value(label ignore nulls) over w as label
from g window w as (partition by user_id order by ts, event_id rows between unbounded preceding and current row)"""


def gaps(spark, sf):
    return views.events(spark, sf).select(
        "event_id", "user_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_type") == "view", F.col("event_type")).alias("label"),
    )


@query("ffill", FFILL_SQL)
def ffill_plain(spark, sf):
    """W1."""
    return ffill(gaps(spark, sf), USER, ORDER, ["value", "label"]).drop("ts")


@query("ffill_hot", FFILL_SQL)
def ffill_pieces(spark, sf):
    """W1 with the series cut into pieces, as for a key that holds too many rows for one task."""
    return ffill(gaps(spark, sf), USER, ORDER, ["value", "label"], SMALL_PIECE).drop("ts")


SPLIT_SQL = """
select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) as pos,
       count(*) over (partition by user_id) as n_rows,
       row_number() over (partition by user_id order by ts, event_id)
         <= count(*) over (partition by user_id)
            - ceil(0.2::double * count(*) over (partition by user_id)) as is_train
from events"""


def split(spark, sf, hot):
    ev = views.events(spark, sf).select("event_id", "user_id", "ts")
    return chrono_split(ev, USER, ORDER, 0.2, hot).drop("ts")


@query("chrono_split", SPLIT_SQL)
def split_plain(spark, sf):
    """W2, A13."""
    return split(spark, sf, 4_000_000)


@query("chrono_split_hot", SPLIT_SQL)
def split_pieces(spark, sf):
    """W2, A13 in pieces."""
    return split(spark, sf, SMALL_PIECE)


@query("series_sizes", """
select user_id, count(*) as n_rows, count(*) - ceil(0.2::double * count(*))::bigint as n_train from events group by user_id""")
def series_sizes(spark, sf):
    """A13."""
    rows = split(spark, sf, 4_000_000)
    return rows.groupBy("user_id").agg(F.count("*").alias("n_rows"), F.count_if("is_train").alias("n_train"))


DIFF_SQL = f"""
select event_id, {r('value - lag(value, 1) over w')} as diff,
       {r('(value - lag(value, 1) over w) - (lag(value, 12) over w - lag(value, 13) over w)')} as seasonal_diff
from events window w as (partition by user_id order by ts, event_id)"""


def diffs(spark, sf, hot):
    ev = views.events(spark, sf).select("event_id", "user_id", "ts", "value")
    cuts = find_cuts(ev, USER, ORDER, hot)  # once, on the table itself
    both = seasonal_diff(diff(ev, USER, ORDER, "value", hot=cuts), USER, ORDER, "value", hot=cuts)
    return rounded(both.select("event_id", "diff", "seasonal_diff"), ["diff", "seasonal_diff"])


@query("differences", DIFF_SQL)
def diffs_plain(spark, sf):
    """W3, W4."""
    return diffs(spark, sf, 4_000_000)


@query("differences_hot", DIFF_SQL)
def diffs_pieces(spark, sf):
    """W3, W4 in blocks that repeat the end of the block before them."""
    return diffs(spark, sf, SMALL_PIECE)
