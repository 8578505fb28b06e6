"""Forecasting against plain numpy recursions on small series."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from metframe import schemas
from metframe.operators import forecast as fc, refine, scan, seasonal
from tests.compare import rows

T0 = dt.datetime(2024, 1, 1)


def simulate(n, phi, theta, seed, seasonal_part=False):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + 50)
    w = np.zeros(n + 50)
    for t in range(1, n + 50):
        w[t] = phi * w[t - 1] + e[t] + theta * e[t - 1]
    y = 20 + np.cumsum(w[50:])
    return y + (5 * np.sin(np.arange(n) * 2 * np.pi / 12) if seasonal_part else 0)


def history(spark, series, extra=None):
    data = [
        (city, T0 + dt.timedelta(minutes=10 * i), *[None if v is None else float(v) for v in values])
        for city, columns in series.items() for i, values in enumerate(zip(*columns))
    ]
    names = ["temp", "humidity"][: len(next(iter(series.values())))]
    return spark.createDataFrame(data, "city_name string, time timestamp, " + ", ".join(f"{n} double" for n in names)).repartition(3)


@pytest.fixture(scope="module")
def sample():
    return {
        "A": (simulate(300, 0.6, -0.3, 1), simulate(300, -0.4, 0.2, 2)),
        "B": (simulate(120, 0.2, 0.5, 3), simulate(120, 0.5, 0.4, 4)),
        "short": (simulate(5, 0.5, 0.1, 5), simulate(5, 0.5, 0.1, 6)),
        "one": ([1.0], [2.0]),
        "flat": (np.full(60, 7.0), simulate(60, 0.3, 0.3, 7)),
    }


def train_part(y):
    return np.asarray(y, dtype=float)[: len(y) - math.ceil(0.2 * len(y))]


def numpy_fit(y):
    w = np.diff(train_part(y))
    x = np.stack([w[3 - k:len(w) - k] for k in range(4)])
    if x.shape[1] < 8:
        return None
    a = np.linalg.lstsq(np.stack([x[1], x[2]], 1), x[0], rcond=None)[0]
    e1 = x[1] - a[0] * x[2] - a[1] * x[3]
    b = np.linalg.lstsq(np.stack([x[1], e1], 1), x[0], rcond=None)[0]
    return np.clip(b, -0.99, 0.99)


def residuals(w, phi, theta):
    e = np.zeros(len(w))
    for t in range(1, len(w)):
        e[t] = w[t] - phi * w[t - 1] - theta * e[t - 1]
    return e


def numpy_forecast(y, phi, theta, steps):
    y = list(train_part(y))
    w = np.diff(y)
    e = residuals(w, phi, theta)[-1]
    step, out = w[-1], []
    for _ in range(steps):
        step = phi * step + theta * e
        e = 0.0
        y.append(y[-1] + step)
        out.append(y[-1])
    return np.array(out)


@pytest.mark.parametrize("hot", [10_000, 40])
def test_arima_models(spark, sample, hot):
    rows_ = fc.series_rows(history(spark, sample), ["city_name"], "time", ["temp", "humidity", "absent"], hot=hot)
    models = {(r["city_name"], r["variable"]): r for r in fc.arima_models(rows_).collect()}
    want = {(c, v): y for c, ys in sample.items() for v, y in zip(("temp", "humidity"), ys)}
    fitted = {k: numpy_fit(y) for k, y in want.items() if not (k[0] == "flat" and k[1] == "temp")}
    assert set(models) == {k for k, f in fitted.items() if f is not None}
    for key, m in models.items():
        phi, theta = fitted[key]
        y = np.asarray(want[key])
        assert math.isclose(m["coefs"]["phi"], phi, abs_tol=1e-8)
        assert math.isclose(m["coefs"]["theta"], theta, abs_tol=1e-8)
        steps = len(y) - len(train_part(y))
        ahead = numpy_forecast(y, phi, theta, steps)
        assert m["n_train"] == len(train_part(y))
        assert math.isclose(m["next_value"], ahead[0], abs_tol=1e-7)
        assert math.isclose(m["rmse"], math.sqrt(np.mean((y[-steps:] - ahead) ** 2)), abs_tol=1e-7)
        assert m["last_time"] == T0 + dt.timedelta(minutes=10 * (len(train_part(y)) - 1))


def test_steps_ahead(spark, sample):
    rows_ = fc.series_rows(history(spark, sample), ["city_name"], "time", ["temp"])
    got = fc.forecast(fc.arima_states(rows_), rows_.series, 5).where("city_name = 'A'").orderBy("h").collect()
    phi, theta = numpy_fit(sample["A"][0])
    assert np.allclose([r["forecast"] for r in got], numpy_forecast(sample["A"][0], phi, theta, 5))


def test_gaps_are_filled_forward_before_the_split(spark):
    y = simulate(80, 0.5, 0.2, 9)
    holes = [None if i % 9 == 4 else float(v) for i, v in enumerate(y)]
    filled = np.array(y)
    for i in range(80):
        if i % 9 == 4:
            filled[i] = filled[i - 1]
    data = [("A", T0 + dt.timedelta(minutes=10 * i), v) for i, v in enumerate(holes)]
    df = spark.createDataFrame(data, "city_name string, time timestamp, temp double")
    rows_ = fc.series_rows(df, ["city_name"], "time", ["temp"])
    got = fc.fit_arima(rows_.with_lags(range(5)), rows_.series).first()
    assert np.allclose([got["phi"], got["theta"]], numpy_fit(filled))


def test_selection(spark):
    data = [("a", "temp", "arima", 1.0), ("a", "temp", "sarimax", 2.0), ("b", "temp", "arima", 1.0),
            ("b", "temp", "sarimax", 1.0), ("c", "temp", "arima", None), ("c", "temp", "sarimax", 3.0),
            ("d", "temp", "arima", None), ("d", "temp", "sarimax", float("nan"))]
    df = spark.createDataFrame(data, "city_name string, variable string, model string, rmse double")
    series = ["city_name", "variable"]
    assert [(r[0], r[2]) for r in rows(fc.select_model(df, series), "city_name")] == [
        ("a", "arima"), ("b", "sarimax"), ("c", "sarimax"),  # equal scores: the seasonal one; both failed: none
    ]
    assert {r["model"] for r in fc.lookup_model(df, series).collect()} == {"arima"}


def test_predictions(spark):
    snapshot = spark.createDataFrame(
        [("a", T0, 1.0, 2.0), ("a", T0 + dt.timedelta(minutes=10), 1.5, 2.5), ("b", T0, 3.0, None)],
        "city_name string, time timestamp, temp double, humidity double",
    )
    models = spark.createDataFrame(
        [("a", "temp", 21.5), ("b", "humidity", None)], "city_name string, variable string, next_value double"
    )
    got = fc.predict(snapshot, models, ["city_name"], "time", ["temp", "humidity"])
    later = dt.timedelta(minutes=10)
    assert rows(got, "city_name", "time", "variable") == [
        ("a", T0, "humidity", None, None), ("a", T0, "temp", 21.5, T0 + later),
        ("a", T0 + later, "humidity", None, None), ("a", T0 + later, "temp", 21.5, T0 + 2 * later),
        ("b", T0, "humidity", None, T0 + later), ("b", T0, "temp", None, None),
    ]
    assert [f.name for f in got.schema] == schemas.PREDICTIONS.fieldNames()


def test_errors(spark):
    actual = spark.createDataFrame(
        [("a", 1.0, 5.0), ("a", 2.0, 6.0), ("x", 9.0, 9.0)], "city string, temp double, humidity double"
    )
    predicted = spark.createDataFrame(
        [("a", "temp", 4.0, T0), ("a", "temp", 8.0, T0 + dt.timedelta(hours=1)), ("a", "humidity", 5.5, T0),
         ("a", "wind_speed", 1.0, T0)],
        "city_name string, variable string, predicted_value double, time_of_prediction timestamp",
    )
    errors = fc.forecast_errors(actual, predicted, "city", ["temp", "humidity"])
    assert sorted((r["variable"], r["actual"], r["error"]) for r in errors.collect()) == [
        ("humidity", 5.0, 0.5), ("humidity", 6.0, 0.5), ("temp", 1.0, 3.0), ("temp", 2.0, 2.0),
    ]
    assert sorted((r["variable"], r["mean_error"]) for r in fc.error_trend(errors).collect()) == [
        ("humidity", 0.5), ("temp", 2.5),
    ]
    lines = fc.actual_and_predicted(errors, "city")
    assert lines.count() == 8 and {r["kind"] for r in lines.collect()} == {"actual", "predicted"}
    wide = fc.merge_predictions(actual, predicted, "city", ["temp", "humidity"])
    assert sorted((r["temp_reel"], r["temp_predit"], r["humidity_predit"]) for r in wide.collect()) == [
        (1.0, 4.0, 5.5), (2.0, 4.0, 5.5),
    ]


def test_errors_by_time_slot(spark):
    actual = spark.createDataFrame(
        [("a", T0 + dt.timedelta(minutes=3), 1.0), ("a", T0 + dt.timedelta(minutes=12), 2.0)],
        "city string, time timestamp, temp double",
    )
    predicted = spark.createDataFrame(
        [("a", "temp", 4.0, T0), ("a", "temp", 8.0, T0 + dt.timedelta(minutes=10))],
        "city_name string, variable string, predicted_value double, time_of_prediction timestamp",
    )
    got = fc.forecast_errors(actual, predicted, "city", ["temp"], time="time", seconds=600)
    assert sorted(r["error"] for r in got.collect()) == [3.0, 6.0]


def test_reanchor_moves_the_state_only(spark, sample):
    df = history(spark, {"A": sample["A"]})
    rows_ = fc.series_rows(df, ["city_name"], "time", ["temp"])
    model = fc.arima_models(rows_).first()
    models = spark.createDataFrame([model], fc.arima_models(rows_).schema)
    got = fc.reanchor(models, df, ["city_name"], "time", ["temp"]).first()
    y = np.asarray(sample["A"][0])
    phi, theta = model["coefs"]["phi"], model["coefs"]["theta"]
    w = np.diff(y)
    e = residuals(w, phi, theta)[-1]
    assert got["coefs"] == model["coefs"] and got["rmse"] == model["rmse"]
    assert math.isclose(got["next_value"], y[-1] + phi * w[-1] + theta * e, abs_tol=1e-7)


def test_undo_is_the_recursion():
    x = np.random.default_rng(0).normal(size=200)
    for coef, step in ((0.7, 1), (-0.95, 12), (0.0, 1)):
        y = x.copy()
        for t in range(step, 200):
            y[t] -= coef * y[t - step]
        assert np.allclose(scan.undo(x, coef, step), y)


def seasonal_recursion(y, phi, theta, sphi, stheta, steps):
    y = list(np.asarray(y, dtype=float))
    w = [(y[t] - y[t - 1]) - (y[t - 12] - y[t - 13]) for t in range(13, len(y))]
    e = [0.0] * len(w)
    for t in range(13, len(w)):
        e[t] = (w[t] - phi * w[t - 1] - sphi * w[t - 12] + phi * sphi * w[t - 13]
                - theta * e[t - 1] - stheta * e[t - 12] - theta * stheta * e[t - 13])
    out = []
    for _ in range(steps):
        nxt = (phi * w[-1] + sphi * w[-12] - phi * sphi * w[-13]
               + theta * e[-1] + stheta * e[-12] + theta * stheta * e[-13])
        w.append(nxt)
        e.append(0.0)
        y.append(nxt + y[-1] + y[-12] - y[-13])
        out.append(y[-1])
    return np.array(out)


def test_seasonal_state_steps_like_the_recursion():
    y = simulate(200, 0.3, 0.2, 11, True)
    c = (0.4, -0.3, 0.2, -0.6)
    want = seasonal_recursion(y, *c, 50)
    state, m = seasonal.state_of(y, *c), seasonal.step_matrix(*c)
    assert np.allclose(seasonal.walk(state, m, 50), want)
    assert np.allclose(seasonal.walk(seasonal.jump(state, m, 20), m, 30), want[20:])
    assert np.allclose(seasonal.ahead(np.array([state, state]), np.array([c, c]), 50), [want, want])
    assert seasonal.ahead(np.empty((0, len(state))), np.empty((0, 4)), 2).shape == (0, 2)
    assert seasonal.state_of(y[:20], *c) is None


@pytest.mark.parametrize("block", [4_096, 7])
def test_seasonal_models(spark, block, monkeypatch):
    ys = {"A": (simulate(240, 0.3, 0.2, 12, True),), "tiny": (simulate(30, 0.1, 0.1, 13),)}
    rows_ = fc.series_rows(history(spark, ys), ["city_name"], "time", ["temp"])
    coefs = spark.createDataFrame(
        [("A", "temp", 0.3, 0.1, 0.2, -0.5)],
        "city_name string, variable string, phi double, theta double, seasonal_phi double, seasonal_theta double",
    )
    plain = rows_.with_lags([])
    states = seasonal.end_state(plain, coefs, rows_.series)
    got = seasonal.score_sarima(plain, states, rows_.series, block).collect()
    want = seasonal_recursion(train_part(ys["A"][0]), 0.3, 0.1, 0.2, -0.5, 48)
    assert len(got) == 1 and math.isclose(got[0]["rmse"], math.sqrt(np.mean((ys["A"][0][-48:] - want) ** 2)), rel_tol=1e-6)
    both = seasonal.sarima_models(rows_).collect()
    assert [r["city_name"] for r in both] == ["A"] and both[0]["rmse"] > 0


def test_sarima_fit_finds_a_seasonal_process(spark):
    """The sums give the regression that numpy gets from the rows."""
    y = simulate(600, 0.5, 0.0, 21)
    rows_ = fc.series_rows(history(spark, {"A": (y,)}), ["city_name"], "time", ["temp"], share=0.0)
    sums = seasonal.lag_sums(rows_.with_lags(seasonal.Y_LAGS), rows_.series).first()
    w = np.array([(y[t] - y[t - 1]) - (y[t - 12] - y[t - 13]) for t in range(13, 600)])
    reach = max(seasonal.LAGS)
    x = np.stack([w[reach - k:len(w) - k] for k in seasonal.LAGS])
    assert sums["n_obs"] == x.shape[1]
    assert np.allclose(sums["sums"], (x @ x.T)[np.triu_indices(len(seasonal.LAGS))])
    together = seasonal.solve(np.array([np.zeros(45), sums["sums"]]))
    assert np.isnan(together[0]).all() and np.isfinite(together[1]).all()
    assert seasonal.solve(np.empty((0, 45))).shape == (0, 4)


def brute_css(w, theta):
    u = scan.undo(w, theta, 1)
    phi = np.clip(u[1:] @ u[:-1] / (u[:-1] @ u[:-1]), -0.99, 0.99)
    r = u[1:] - phi * u[:-1]
    return float(r @ r), phi


@pytest.mark.parametrize("block", [65_536, 200])
def test_css_arima(spark, block):
    y = simulate(1_000, 0.6, -0.4, 31)
    rows_ = fc.series_rows(history(spark, {"A": (y,), "flat": (np.full(40, 1.0),), "two": ([1.0, 2.0],)}),
                           ["city_name"], "time", ["temp"], share=0.0)
    got = {r["city_name"]: r for r in refine.fit_css(rows_, refine.ARIMA, block).collect()}
    assert set(got) == {"A"}
    w = np.diff(y)
    best = min((brute_css(w, t)[0], t) for t in np.linspace(-0.99, 0.99, 2_001))
    assert abs(got["A"]["theta"] - best[1]) < 0.01
    assert got["A"]["sse"] <= best[0] * 1.0005
    assert abs(got["A"]["phi"] - 0.6) < 0.12 and abs(got["A"]["theta"] + 0.4) < 0.15
    assert got["A"]["n"] == 998


def assert_same_fit(cut, whole):
    cut, whole = ({(r["city_name"], r["variable"]): r for r in f.collect()} for f in (cut, whole))
    assert set(cut) == set(whole) and cut
    for key, r in cut.items():
        for c in ("phi", "theta", "seasonal_phi", "seasonal_theta", "n"):
            assert math.isclose(r[c], whole[key][c], rel_tol=1e-7, abs_tol=1e-7), (key, c)
        assert math.isclose(r["sse"], whole[key]["sse"], rel_tol=1e-8)


@pytest.mark.parametrize("kind", [refine.ARIMA, refine.SARIMA], ids=["arima", "sarima"])
@pytest.mark.parametrize("block", [7, 64])
def test_css_blocks_do_not_change_the_fit(spark, kind, block, monkeypatch):
    """With groups of three blocks, so the scan goes through several rounds."""
    monkeypatch.setattr(scan, "FAN", 3)
    ys = {"A": (simulate(700, 0.3, 0.5, 41),), "B": (simulate(90, 0.3, 0.5, 42),), "gap": ([None] * 70 + list(simulate(90, 0.3, 0.5, 43)),)}
    rows_ = fc.series_rows(history(spark, ys), ["city_name"], "time", ["temp"])
    assert_same_fit(refine.fit_css(rows_, kind, block, 2), refine.fit_css(rows_, kind, levels=2))


def near_unit_root(n, seed=61, theta=0.9, stheta=-0.95):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 13)
    w = e[13:] + theta * e[12:-1] + stheta * e[1:-12] + theta * stheta * e[:-13]
    y = list(rng.normal(size=13))
    for x in w:
        y.append(x + y[-1] + y[-12] - y[-13])
    return np.array(y)


def test_a_long_seasonal_series_near_the_unit_root_is_exact(spark):
    """What lies 9,000 rows back still counts; blocks of 64 give what one pass gives."""
    y = near_unit_root(9_500)
    rows_ = fc.series_rows(history(spark, {"A": (y,)}), ["city_name"], "time", ["temp"], share=0.0)
    assert_same_fit(refine.fit_css(rows_, refine.SARIMA, 64, 1), refine.fit_css(rows_, refine.SARIMA, levels=1))
    c = (0.2, 0.9, 0.1, -0.95)
    coefs = spark.createDataFrame(
        [("A", "temp", *c)], "city_name string, variable string, phi double, theta double, seasonal_phi double, seasonal_theta double")
    plain = rows_.with_lags([])
    whole, want = (seasonal.end_state(plain, coefs, rows_.series, b).first()["state"] for b in (64, None)), seasonal.state_of(y, *c)
    for state in whole:
        assert np.allclose(state, want, rtol=1e-8, atol=1e-8)
    residuals, e = [], np.zeros(13)
    w = np.diff(y)[12:] - np.diff(y)[:-12]
    for t in range(13, len(w)):
        new = w[t] - c[0] * w[t - 1] - c[2] * w[t - 12] + c[0] * c[2] * w[t - 13] - c[1] * e[0] - c[3] * e[11] - c[1] * c[3] * e[12]
        e = np.concatenate([[new], e[:-1]])
    assert np.allclose(want[26:], e, rtol=1e-7, atol=1e-7)


@pytest.mark.parametrize("block", [3, 26, 40, 1000])
def test_end_states_of_blocks(spark, block, monkeypatch):
    monkeypatch.setattr(scan, "FAN", 2)
    ys = {"A": (simulate(240, 0.3, 0.2, 12, True),), "gap": ([None] * 33 + list(simulate(100, 0.3, 0.2, 14, True)),), "tiny": (simulate(30, 0.1, 0.1, 13),)}
    rows_ = fc.series_rows(history(spark, ys), ["city_name"], "time", ["temp"], share=0.0)
    c = (0.3, 0.8, 0.2, -0.9)
    coefs = spark.createDataFrame(
        [(k, "temp", *c) for k in ys], "city_name string, variable string, phi double, theta double, seasonal_phi double, seasonal_theta double")
    got = {r["city_name"]: r for r in seasonal.end_state(rows_.with_lags([]), coefs, rows_.series, block).collect()}
    assert set(got) == {"A", "gap"}
    for key, r in got.items():
        assert np.allclose(r["state"], seasonal.state_of(np.array(ys[key][0], float), *c), rtol=1e-8, atol=1e-8)
        assert r["n_train"] == len(ys[key][0])


def test_css_sarima(spark):
    rng = np.random.default_rng(51)
    n, theta, stheta = 900, -0.5, -0.6
    e = rng.normal(size=n + 13)
    w = e[13:] + theta * e[12:-1] + stheta * e[1:-12] + theta * stheta * e[:-13]
    y = list(rng.normal(size=13))
    for x in w:
        y.append(x + y[-1] + y[-12] - y[-13])
    rows_ = fc.series_rows(history(spark, {"A": (y,)}), ["city_name"], "time", ["temp"], share=0.0)
    got = refine.fit_css(rows_, refine.SARIMA).first()
    assert abs(got["theta"] - theta) < 0.15 and abs(got["seasonal_theta"] - stheta) < 0.15
    assert abs(got["phi"]) < 0.2 and abs(got["seasonal_phi"]) < 0.2
