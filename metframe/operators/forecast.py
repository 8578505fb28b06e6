"""ARIMA(1,1,1) for many series at once, scoring, model choice, prediction and its errors.

A series is fitted from sums alone. With w the first difference, one aggregate collects the sums
S_ij of w[t-i] * w[t-j] for i, j in 0..3. They hold both steps of the Hannan-Rissanen estimate: the
AR(2) regression that yields residuals, and the regression of w[t] on w[t-1] and the lagged
residual, since the latter is itself a combination of lags. So there is one shuffle on the series
key, partial sums before it, and no pass over rows per iteration.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from metframe import schemas
from metframe.functions.expr import abs_error, or_infinity, shift_time, slot
from metframe.operators.series import POS, SIZE, ffill, first_per, held_out, lags_of_placed, with_lags, with_position
from metframe.operators.shape import present, suffix_except, to_long, to_wide
from metframe.operators.skew import HOT_ROWS, Cuts, find_cuts, lookup_join
from metframe.session import cut_lineage

LIMIT = 0.99     # |phi| and |theta| stay inside the stationary and invertible region
MIN_OBS = 8      # complete lag rows a fit needs
NEAR_ZERO = 1e-9  # a determinant this small next to its diagonal is a failed fit
LAG_BLOCK = 65_536  # positions of a series that one window holds, once they are known
GRAM_LAGS = range(4)
STATE = ["phi", "theta", "last_value", "last_diff", "last_residual"]


@dataclass
class SeriesRows:
    """The series of a wide frame: one per key and variable, its last ``share`` held out.

    ``with_lags`` gives one row per (key, variable, time) with ``y``, the lags asked for as ``y_k``,
    pos, n_rows and n_train. All variables pass the windows side by side, in one shuffle on the
    key, and are stacked only afterwards, so key and time are not shuffled once per variable. Every
    call asks for the same shuffle, which Spark therefore runs once per query. Rows that several queries
    read are ``written`` once with their gaps filled and their positions, and dealt out in blocks of those.
    """

    df: DataFrame
    keys: list[str]
    variables: list[str]
    share: float
    cuts: Cuts
    placed: bool = False

    @property
    def series(self) -> list[str]:
        return [*self.keys, "variable"]

    @property
    def cold(self) -> bool:
        """Has no series more rows than a task may hold?"""
        return self.cuts.frame is None or (self.cuts.longest or math.inf) <= HOT_ROWS

    def written(self) -> SeriesRows:
        """The same rows from a table that holds their positions."""
        return self if self.placed else replace(
            self, df=cut_lineage(with_position(self.df, self.keys, ["time"], hot=self.cuts)), placed=True)

    def with_lags(self, lags: Sequence[int]) -> DataFrame:
        lags = [k for k in lags if k]
        wanted = {f"{v}__{k}": (v, k) for v in self.variables for k in lags}
        got = (
            lags_of_placed(self.df, self.keys, wanted, min(self.cuts.rows, LAG_BLOCK)) if self.placed
            else with_lags(self.df, self.keys, ["time"], wanted, hot=self.cuts)
        )
        rows = [
            ", ".join([f"'{v}' AS variable", f"`{v}` AS y", *[f"`{v}__{k}` AS y_{k}" for k in lags]])
            for v in self.variables
        ]
        stacked = F.expr(f"inline(array({', '.join(f'struct({r})' for r in rows)}))")
        return got.select(
            *self.keys, "time", POS, SIZE, (F.col(SIZE) - held_out(SIZE, self.share)).alias("n_train"), stacked,
        )


def series_rows(df: DataFrame, keys: Sequence[str], time: str, variables: Sequence[str],
                share: float = schemas.TEST_SHARE, fill: bool = True, hot: int | Cuts = HOT_ROWS) -> SeriesRows:
    """Pick the variables the frame has, fill their gaps forward, and find out once which keys are hot.

    Where there are such keys the rows are written, as finding a row's piece and what is carried into it takes several
    joins.
    """
    keys, variables = list(keys), present(df, variables)
    slim = df.select(*keys, F.col(time).alias("time"), *[F.col(v).cast("double").alias(v) for v in variables])
    cuts = hot if isinstance(hot, Cuts) else find_cuts(slim, keys, ["time"], hot)
    if fill:
        slim = ffill(slim, keys, ["time"], variables, cuts)
    rows = SeriesRows(slim, keys, variables, share, cuts)
    return rows if cuts.frame is None else rows.written()


def lag_col(k: int) -> Column:
    return F.col("y") if k == 0 else F.col(f"y_{k}")


def w_lag(k: int) -> Column:
    """First difference k steps back."""
    return lag_col(k) - lag_col(k + 1)


def lag_sums(long: DataFrame, series: Sequence[str]) -> DataFrame:
    """Per series: number of complete lag rows of the train part, and the sums s_ij."""
    values = ["y", *[f"y_{k}" for k in range(1, len(GRAM_LAGS) + 1)]]
    rows = long.where(F.col(POS) <= F.col("n_train")).dropna(subset=values).selectExpr(
        *series, *[f"{a} - {b} AS w{k}" for k, (a, b) in enumerate(zip(values, values[1:]))]
    )
    sums = [f"sum(w{i} * w{j}) AS s{i}{j}" for i in GRAM_LAGS for j in GRAM_LAGS if i <= j]
    return rows.groupBy(*series).agg(F.count("*").alias("n_obs"), *[F.expr(x) for x in sums])


def clamp(c: Column, limit: float = LIMIT) -> Column:
    """Greatest and least skip nulls, so a failed fit has to stay null by hand."""
    return F.when(c.isNotNull(), F.greatest(F.lit(-limit), F.least(F.lit(limit), c)))


def solve2(a: str, b: str, d: str, r1: str, r2: str) -> tuple[str, str]:
    """Solution of the symmetric system [a b; b d] x = [r1; r2] in SQL, null if (nearly) singular."""
    det = f"CASE WHEN abs({a} * {d} - {b} * {b}) > {NEAR_ZERO}D * abs({a} * {d}) THEN {a} * {d} - {b} * {b} END"
    return f"({r1} * {d} - {r2} * {b}) / ({det})", f"({r2} * {a} - {r1} * {b}) / ({det})"


def fit_from_sums(sums: DataFrame, series: Sequence[str]) -> DataFrame:
    """phi and theta of each series; null where the fit fails."""
    a1, a2 = solve2("s11", "s12", "s22", "s01", "s02")
    phi, theta = solve2("s11", "_we", "_ee", "s01", "_ye")
    second = sums.selectExpr("*", f"{a1} AS _a1", f"{a2} AS _a2").selectExpr(
        *series, "n_obs", "s11", "s01",
        "s11 - _a1 * s12 - _a2 * s13 AS _we",
        "s11 + _a1 * _a1 * s22 + _a2 * _a2 * s33 - 2D * _a1 * s12 - 2D * _a2 * s13 + 2D * _a1 * _a2 * s23 AS _ee",
        "s01 - _a1 * s02 - _a2 * s03 AS _ye",
    ).selectExpr(
        *series, "n_obs",
        f"CASE WHEN n_obs >= {MIN_OBS} THEN {phi} END AS phi",
        f"CASE WHEN n_obs >= {MIN_OBS} THEN {theta} END AS theta",
    )
    return second.withColumns({"phi": clamp(F.col("phi")), "theta": clamp(F.col("theta"))})


def fit_arima(long: DataFrame, series: Sequence[str]) -> DataFrame:
    return fit_from_sums(lag_sums(long, series), series)


def end_state(rows: SeriesRows, coefs: DataFrame, whole: bool = False) -> DataFrame:
    """State of each series at the end of its train part (or of all rows): last value, difference
    and residual, next to its coefficients.

    With e[t] = u[t] - theta * e[t-1] and u[t] = w[t] - phi * w[t-1], the last residual is the sum
    of (-theta)^(n-t) * u[t]: an aggregate, not a recursion.
    """
    long = rows.with_lags(range(3))
    end = F.col(SIZE) if whole else F.col("n_train")
    part = long.where(F.col(POS) <= end).select(
        *rows.series, "time", "y", w_lag(0).alias("w"), w_lag(1).alias("w1"), (end - F.col(POS)).alias("back"),
    )
    joined = lookup_join(part, coefs.select(*rows.series, "phi", "theta"), rows.series, cold=rows.cold)
    u = F.col("w") - F.col("phi") * F.col("w1")
    is_last = F.col("back") == 0
    return joined.groupBy(*rows.series).agg(
        F.first("phi").alias("phi"), F.first("theta").alias("theta"),
        F.count("*").alias("n_train"),
        F.max(F.when(is_last, F.col("time"))).alias("last_time"),
        F.max(F.when(is_last, F.col("y"))).alias("last_value"),
        F.max(F.when(is_last, F.col("w"))).alias("last_diff"),
        F.sum(F.pow(-F.col("theta"), F.col("back").cast("double")) * u).alias("last_residual"),
    )


def step_ahead(h: Column, phi: Column, theta: Column, last: Column, w: Column, e: Column) -> Column:
    """Forecast h steps ahead in closed form: the differences decay by phi from the first on."""
    w1 = phi * w + theta * e
    return last + w1 * (F.lit(1.0) - F.pow(phi, h.cast("double"))) / (F.lit(1.0) - phi)


def forecast(states: DataFrame, series: Sequence[str], steps: int) -> DataFrame:
    """The next ``steps`` values of each series."""
    out = step_ahead(F.col("h"), *[F.col(c) for c in STATE])
    return (
        states.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(steps))))
        .select(*series, "h", out.alias("forecast"))
    )


def score_arima(rows: SeriesRows, states: DataFrame) -> DataFrame:
    """RMSE of the forecasts from the end of the train part over the held-out rows."""
    test = rows.with_lags([]).where(F.col(POS) > F.col("n_train")).select(
        *rows.series, "y", (F.col(POS) - F.col("n_train")).alias("h")
    )
    joined = lookup_join(test, states.select(*rows.series, *STATE), rows.series, cold=rows.cold)
    error = F.col("y") - step_ahead(F.col("h"), *[F.col(c) for c in STATE])
    # A held-out row without a value makes the score fail, as it does for the metric itself.
    return joined.groupBy(*rows.series).agg(
        F.when(F.count("*") == F.count(error), F.sqrt(F.avg(error * error))).alias("rmse")
    )


def as_models(states: DataFrame, series: Sequence[str]) -> DataFrame:
    """Rows of the model table from states that also have their score."""
    return states.select(
        *series, F.lit("arima").alias("model"),
        F.create_map(F.lit("phi"), F.col("phi"), F.lit("theta"), F.col("theta")).alias("coefs"),
        "n_train", "last_time", F.array("last_value", "last_diff", "last_residual").alias("state"),
        step_ahead(F.lit(1), *[F.col(c) for c in STATE]).alias("next_value"), "rmse",
    )


def arima_states(rows: SeriesRows, coefs: DataFrame | None = None) -> DataFrame:
    """Coefficients and end state of every series that could be fitted.

    One row per series; written out, since scoring and prediction read it again.
    """
    if coefs is None:
        coefs = fit_arima(rows.with_lags(range(5)), rows.series)
        coefs = cut_lineage(coefs.where(F.col("phi").isNotNull() & F.col("theta").isNotNull()))
    return cut_lineage(end_state(rows, coefs))


def arima_models(rows: SeriesRows, coefs: DataFrame | None = None) -> DataFrame:
    """Model rows of kind ``arima``, from sums alone or from the given coefficients."""
    states = arima_states(rows, coefs)
    return as_models(states.join(score_arima(rows, states), rows.series, "left"), rows.series)


# Fixed value: on equal scores the seasonal model is taken.
PREFERENCE = ["sarimax", "arima"]


def select_model(candidates: DataFrame, series: Sequence[str], score: str = "rmse",
                 model: str = "model", preference: Sequence[str] = PREFERENCE) -> DataFrame:
    """Best candidate per series; a missing score counts as infinite and is never chosen."""
    rank = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col(model))
    w = Window.partitionBy(*series).orderBy("_score", rank)
    return (
        candidates.withColumn("_score", or_infinity(score)).where(F.col("_score") < float("inf"))
        .withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_score")
    )


def lookup_model(models: DataFrame, series: Sequence[str], model: str = "model",
                 preference: Sequence[str] = ("arima", "sarimax")) -> DataFrame:
    """One model per series by kind alone, where a table holds several."""
    rank = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col(model))
    w = Window.partitionBy(*series).orderBy(rank)
    return models.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def predict(snapshot: DataFrame, models: DataFrame, keys: Sequence[str], time: str,
            variables: Sequence[str], step: str = schemas.STEP) -> DataFrame:
    """One-step forecast for every row and variable of the snapshot.

    The value comes from the state the model was saved with; the row gives only the time it is
    labelled with. No model: null value and null time.
    """
    series = [*keys, "variable"]
    rows = to_long(snapshot, [*keys, time], variables).drop("value")
    joined = lookup_join(
        rows, models.select(*series, "next_value", F.lit(True).alias("_has")), series, "left"
    )
    return joined.select(
        *keys, F.col(time), "variable", F.col("next_value").alias("predicted_value"),
        F.when(F.col("_has"), shift_time(time, step)).alias("time_of_prediction"),
    )


def reanchor(models: DataFrame, history: DataFrame, keys: Sequence[str], time: str,
             variables: Sequence[str], hot: int | Cuts = HOT_ROWS) -> DataFrame:
    """ARIMA models with the same coefficients, their state moved to the newest observation."""
    rows = series_rows(history, keys, time, variables, 0.0, hot=hot)
    coefs = models.where(F.col("model") == "arima").select(
        *rows.series, F.col("coefs.phi").alias("phi"), F.col("coefs.theta").alias("theta"), "rmse",
    )
    moved = end_state(rows, coefs, whole=True)
    return as_models(moved.join(coefs.select(*rows.series, "rmse"), rows.series), rows.series)


def first_guesses(predictions: DataFrame, key: str, predicted_key: str, on: Sequence[str]) -> DataFrame:
    """The first prediction per key and variable (and slot), so that a join cannot multiply rows."""
    named = predictions.withColumnsRenamed({predicted_key: key, "predicted_value": "predicted"})
    return first_per(named, [*on], ["time_of_prediction"], ["predicted", "time_of_prediction"])


def forecast_errors(actual: DataFrame, predictions: DataFrame, key: str, variables: Sequence[str],
                    predicted_key: str = "city_name", time: str | None = None, seconds: int = 600) -> DataFrame:
    """Absolute error per observation and variable, both sides in long form.

    Each observation meets the first prediction of its key and variable. Given the ``time`` column
    of the observations, it meets the one made for its own time slot of ``seconds``.
    """
    ids = [c for c in actual.columns if c not in variables]
    rows = to_long(actual, ids, variables, value="actual")
    on = [key, "variable"]
    if time is not None:
        rows = rows.withColumn("_slot", slot(time, seconds))
        predictions = predictions.withColumn("_slot", slot("time_of_prediction", seconds))
        on.append("_slot")
    guesses = first_guesses(predictions, key, predicted_key, on)
    joined = lookup_join(rows, guesses, on)
    return joined.withColumn("error", abs_error("actual", "predicted")).drop("_slot")


def merge_predictions(actual: DataFrame, predictions: DataFrame, key: str, variables: Sequence[str],
                      predicted_key: str = "city_name") -> DataFrame:
    """Wide form: ``x_reel`` next to ``x_predit``, each observation with its key's predictions."""
    guesses = first_guesses(predictions, key, predicted_key, [key, "variable"])
    values = to_wide(guesses, [key], variables, value="predicted")
    times = guesses.groupBy(key).agg(F.max("time_of_prediction").alias("time_of_prediction"))
    right = suffix_except(values.join(times, key), [key], "_predit")
    return lookup_join(suffix_except(actual, [key], "_reel"), right, [key])


def error_trend(errors: DataFrame) -> DataFrame:
    return errors.groupBy("time_of_prediction", "variable").agg(F.avg("error").alias("mean_error"))


def actual_and_predicted(errors: DataFrame, key: str) -> DataFrame:
    """Line-chart form: one row per value, told apart by ``kind``."""
    sides: Mapping[str, str] = {"actual": "actual", "predicted": "predicted"}
    return errors.select(
        key, "variable", "time_of_prediction",
        F.inline(F.array(*[
            F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value")) for kind, c in sides.items()
        ])),
    )
