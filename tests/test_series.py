"""Series operators, whole and cut into pieces, against pandas."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from metframe.operators import series
from metframe.operators.skew import count_not_after, find_cuts, hot_keys, lookup_join, series_layout
from metframe.operators.stations import label_by_position, missing_keys, nearest_by_cells, nearest_station, only_keys
from tests.compare import rows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k string, t timestamp, id int, x double, s string"


def make(spark, lengths, seed=1, gap=0.4):
    rng = np.random.default_rng(seed)
    data = []
    for k, n in lengths.items():
        for i in range(n):
            x = None if rng.random() < gap else float(rng.integers(0, 100))
            data.append((k, T0 + dt.timedelta(minutes=10 * i), len(data), x, None if rng.random() < gap else f"s{i}"))
    rng.shuffle(data)
    data = [(k, t, int(i), None if x is None else float(x), s) for k, t, i, x, s in data]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


LENGTHS = {"hot": 300, "warm": 60, "cold": 7, "one": 1, "two": 2, "five": 5}


def as_pandas(df):
    return df.toPandas().sort_values(["k", "t"]).reset_index(drop=True)


@pytest.mark.parametrize("hot", [10_000, 50, 9])
def test_ffill(spark, hot):
    df = make(spark, LENGTHS)
    got = as_pandas(series.ffill(df, ["k"], ["t"], ["x", "s"], hot))
    want = as_pandas(df)
    want[["x", "s"]] = want.groupby("k")[["x", "s"]].ffill()
    pd.testing.assert_frame_equal(got, want)


def test_ffill_all_null_series_and_null_key(spark):
    data = [("a", T0 + dt.timedelta(hours=i), i, None, None) for i in range(30)]
    data += [(None, T0 + dt.timedelta(hours=i), i, 1.0 if i == 3 else None, None) for i in range(30)]
    df = spark.createDataFrame(data, SCHEMA)
    for hot in (1_000, 5):
        got = series.ffill(df, ["k"], ["t"], ["x"], hot)
        assert got.where("k = 'a' and x is not null").count() == 0
        assert got.where("k is null and x = 1.0").count() == 27


@pytest.mark.parametrize("hot", [10_000, 40, 13, 5])
def test_position_and_lags(spark, hot):
    df = make(spark, LENGTHS)
    lags = {"l1": ("x", 1), "l12": ("x", 12), "l13": ("x", 13), "s2": ("s", 2)}
    got = as_pandas(series.with_lags(df, ["k"], ["t"], lags, hot=hot))
    want = as_pandas(df)
    groups = want.groupby("k")
    assert list(got["pos"]) == list(groups.cumcount() + 1)
    assert list(got["n_rows"]) == list(groups["id"].transform("size"))
    for name, (c, k) in lags.items():
        expected = [None if pd.isna(v) else v for v in groups[c].shift(k)]
        assert [None if pd.isna(v) else v for v in got[name]] == expected


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from("abc"), st.integers(1, 60), min_size=1), st.integers(2, 30), st.integers(0, 9))
def test_pieces_do_not_change_results(spark, lengths, hot, seed):
    df = make(spark, lengths, seed)
    for f in (
        lambda h: series.ffill(df, ["k"], ["t"], ["x"], h),
        lambda h: series.seasonal_diff(df, ["k"], ["t"], "x", 4, hot=h),
        lambda h: series.chrono_split(df, ["k"], ["t"], 0.2, h),
    ):
        assert rows(f(hot), "id") == rows(f(10_000), "id")


def test_uneven_times_are_cut_evenly(spark):
    """Most rows of the hot key lie in one minute."""
    data = [("a", T0 + dt.timedelta(microseconds=i), i, 1.0, None) for i in range(900)]
    data += [("a", T0 + dt.timedelta(days=i), i, 1.0, None) for i in range(1, 101)]
    lay = series_layout(spark.createDataFrame(data, SCHEMA), ["k"], ["t"], 100)
    sizes = [r["count"] for r in lay.df.groupBy("_piece").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 150


def test_equal_and_null_times_are_cut(spark):
    data = [("a", T0 if i % 2 else None, i, float(i), None) for i in range(4_000)]
    df = spark.createDataFrame(data, SCHEMA)
    lay = series_layout(df, ["k"], ["t"], 100)
    sizes = [r["count"] for r in lay.df.groupBy("_piece").count().collect()]
    assert sum(sizes) == 4_000 and max(sizes) <= 100
    got = series.with_position(df, ["k"], ["t"], hot=100)
    assert sorted(r["pos"] for r in got.collect()) == list(range(1, 4_001))
    assert got.where("t is null").agg(F.max("pos")).first()[0] == 2_000


def test_every_hot_key_is_cut(spark):
    """Thousands of keys, all alike."""
    df = spark.range(60_000).select(
        (F.col("id") % 3_000).cast("string").alias("k"), F.timestamp_seconds("id").alias("t"), "id", F.col("id").cast("double").alias("x"))
    lay = series_layout(df, ["k"], ["t"], 8)
    assert lay.df.groupBy("k", "_piece").count().agg(F.max("count")).first()[0] <= 8
    assert lay.cuts.frame.count() == 3_000
    assert rows(series.diff(df, ["k"], ["t"], "x", hot=8), "id") == rows(series.diff(df, ["k"], ["t"], "x"), "id")


def test_cuts_only_for_hot_keys(spark):
    df = make(spark, LENGTHS)
    assert find_cuts(df, ["k"], ["t"], 10_000).frame is None
    assert hot_keys(df, ["k"], 10_000) is None
    assert sorted(r["k"] for r in hot_keys(df, ["k"], 50).collect()) == ["hot", "warm"]
    assert sorted(r["k"] for r in find_cuts(df, ["k"], ["t"], 50).frame.collect()) == ["hot", "warm"]


def test_binary_search(spark):
    df = spark.createDataFrame([([1, 3, 3, 8], x) for x in range(10)], "c array<int>, x int")
    got = [r[0] for r in df.orderBy("x").select(count_not_after(F.col("c"), F.col("x"))).collect()]
    assert got == [0, 1, 1, 3, 3, 3, 3, 3, 4, 4]


@pytest.mark.parametrize("n", [1, 2, 5, 14, 15, 60])
def test_split_sizes(spark, n):
    got = series.chrono_split(make(spark, {"a": n}), ["k"], ["t"])
    test = got.where("not is_train").count()
    assert test == math.ceil(0.2 * n) and got.count() == n
    last_train = got.where("is_train").agg(F.max("t")).first()[0]
    first_test = got.where("not is_train").agg(F.min("t")).first()[0]
    assert last_train is None or last_train < first_test


def test_latest_top_and_first(spark):
    data = [("a", T0, 1, None, "p"), ("a", T0 + dt.timedelta(hours=1), 2, 5.0, None),
            ("b", T0 + dt.timedelta(hours=1), 3, 7.0, "q"), (None, T0, 4, 1.0, "r")]
    df = spark.createDataFrame(data, SCHEMA)
    assert sorted(r["id"] for r in series.latest_per(df, ["k"], [F.desc("t")]).collect()) == [2, 3, 4]
    top = series.top_n(df, 2, [F.desc("t"), F.asc("k")]).collect()
    assert [r["id"] for r in top] == [2, 3]  # equal times in order of the key
    first = series.first_per(df, ["k"], ["t"], ["x", "s"])
    assert rows(first, "k") == [("a", 5.0, "p"), ("b", 7.0, "q")]
    want = df.toPandas().sort_values("t").groupby("k")[["x", "s"]].first().reset_index()
    assert rows(first, "k") == [tuple(r) for r in want.itertuples(index=False)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_join(spark, how):
    facts = spark.createDataFrame(
        [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 7}", i % 5) for i in range(600)], "k string, v int"
    )
    table = spark.createDataFrame([("hot", 1.0), ("k1", 2.0), ("k2", 3.0), ("unused", 4.0)], "k string, w double")
    want = rows(facts.join(table, ["k"], how), "k", "v")
    assert rows(lookup_join(facts, table, ["k"], how, small=1, hot=20), "k", "v") == want
    assert rows(lookup_join(facts, table, ["k"], how, small=1), "k", "v") == want
    assert rows(lookup_join(facts, table, ["k"], how), "k", "v") == want


def test_keys(spark):
    dim = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("x", 3)], "k string, v int")
    assert rows(only_keys(df, dim, ["k"]), "v") == [("a", 1), ("a", 2)]
    assert rows(missing_keys(dim, df, ["k"]), "k") == [("b",), ("c",)]


@pytest.mark.parametrize("threshold", ["1000", "1"])
def test_label_by_position(spark, threshold):
    df = spark.createDataFrame([(b, i) for b in (1, 2) for i in (30, 10, 20, 40)], "batch int, at int")
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "ordinal int, name string")
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        got = rows(label_by_position(df, ["batch"], ["at"], dim, "ordinal", "name", "label"), "batch", "at")
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
    assert got == [(b, at, n) for b in (1, 2) for at, n in ((10, "x"), (20, "y"), (30, "z"))]


def brute_nearest(spots, sites):
    def km(a, b):
        la, lo, lb, lp = map(math.radians, (*a, *b))
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(h))
    return {i: min((km(p, q), n) for n, *q in sites) for i, *p in spots}


@pytest.mark.parametrize("inline", [512, 0])
def test_nearest_station(spark, inline):
    rng = np.random.default_rng(5)
    spots = [(i, float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180))) for i in range(60)]
    spots += [(60, 89.9, 10.0), (61, 0.0, 179.99), (62, 0.0, -179.99), (63, -90.0, 0.0)]
    # Stations crowd one region, so most spots are far from all of them.
    sites = [(f"s{i:02d}", float(rng.uniform(27, 36)), float(rng.uniform(-13, -1))) for i in range(30)]
    sites += [("pole", 88.0, -170.0), ("line", 0.0, 179.0)]
    obs = spark.createDataFrame([*spots, (99, None, 1.0)], "id int, lat double, lon double")
    dim = spark.createDataFrame(sites, "name string, a double, o double")
    got = {r["id"]: (r["distance_km"], r["station"])
           for r in nearest_station(obs, dim, "lat", "lon", "name", "a", "o", inline=inline).collect()}
    assert got.pop(99) == (None, None)
    want = brute_nearest(spots, sites)
    assert {i: n for i, (_, n) in got.items()} == {i: n for i, (_, n) in want.items()}
    assert all(math.isclose(got[i][0], want[i][0], abs_tol=1e-6) for i in want)


def test_a_spot_meets_few_of_many_stations(spark):
    """10,000 stations in crowds, copies among them; spots in the crowds, between them and on the other side of the globe."""
    rng = np.random.default_rng(9)
    crowds = [(48.0, 2.0, 0.2), (31.0, -7.0, 4.0), (-33.0, 151.0, 0.001), (0.0, 179.99, 0.05)]
    sites = []
    for i in range(10_000):
        lat, lon, wide = crowds[i % 4]
        sites.append((f"s{i:05d}", float(lat + rng.normal() * wide), float(lon + rng.normal() * wide)))
    sites += [("a copy", *sites[17][1:]), ("z copy", *sites[18][1:])]
    spots = [(float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180))) for _ in range(60)]
    spots += [(float(rng.normal(48, 0.3)), float(rng.normal(2, 0.3))) for _ in range(60)]
    spots += [sites[17][1:], sites[18][1:], (-48.0, -178.0), (90.0, 0.0), (-90.0, 0.0), (0.0, -179.99), (33.0, -29.0)]
    frame = spark.createDataFrame(spots, "_lat double, _lon double")
    listed = spark.createDataFrame(sites, "_name string, _slat double, _slon double")
    got = {(r["_lat"], r["_lon"]): r for r in nearest_by_cells(frame, listed).collect()}
    assert len(got) == len(spots)
    lat, lon = (np.radians([q[k] for q in sites]) for k in (1, 2))
    for spot, r in got.items():
        a, o = map(math.radians, spot)
        h = np.sin((lat - a) / 2) ** 2 + np.cos(a) * np.cos(lat) * np.sin((lon - o) / 2) ** 2
        km = 2 * 6371.0088 * np.arcsin(np.sqrt(np.minimum(h, 1)))
        assert math.isclose(r["_km"], km.min(), abs_tol=1e-5)
        assert r["_name"] in {sites[i][0] for i in np.flatnonzero(km <= km.min() + 1e-5)}
        assert r["_pairs"] < 1_000
    assert got[sites[17][1:]]["_name"] == "a copy" and got[sites[18][1:]]["_name"] == "s00018"
    assert sum(r["_pairs"] for r in got.values()) < 200 * len(got)
