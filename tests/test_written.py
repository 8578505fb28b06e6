"""Rows that several jobs read are found once: pieces, filled gaps and positions are not worked out again by each."""

import datetime as dt

import pytest

from metframe.operators import refine
from metframe.operators.forecast import arima_models, series_rows

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def history(spark):
    rows = [
        (None if c == 2 else f"c{c}", T0 + dt.timedelta(minutes=10 * i), None if (i + c) % 5 == 0 else float((i * i * (c + 3)) % 17))
        for c in range(4) for i in range(61 + c)
    ]
    return spark.createDataFrame(rows, "city_name string, time timestamp, temp double").repartition(3)


def shown(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("lags", [[], [1, 5]])
def test_pieces_are_looked_up_once(history, lags):
    hot = series_rows(history, ["city_name"], "time", ["temp"], hot=7)
    cold = series_rows(history, ["city_name"], "time", ["temp"])
    assert not cold.placed and hot.cuts.frame is not None
    assert hot.cuts.most < 70 and hot.cuts.longest == 64 and hot.cold
    got = hot.with_lags(lags)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "_cuts" not in plan and "Join" not in plan
    assert shown(got) == shown(cold.with_lags(lags)) == shown(cold.written().with_lags(lags))


def test_hot_models_are_the_cold_ones(history):
    found = []
    for hot in (7, 4_000_000):
        rows = series_rows(history, ["city_name"], "time", ["temp"], hot=hot)
        found.append(sorted((str(r.city_name), round(r.next_value, 6), round(r.rmse, 6)) for r in arima_models(rows).dropna(subset=["rmse"]).collect()))
    assert found[0] == found[1] and found[0]


def test_blocks_of_the_search_stay_apart(spark, history):
    """Small as they are, the blocks are not put into a partition or two."""
    rows = series_rows(history, ["city_name"], "time", ["temp"])
    blocks = refine.pack(rows, refine.ARIMA, 4)
    assert blocks.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert blocks.count() > 40
