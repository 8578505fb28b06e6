"""SARIMA(1,1,1)(1,1,1,12) for many series at once.

Spark collects per series the sums of products of the twice-differenced values at the lags the
two regressions need (one aggregate), gets the state at the end of each train part from its blocks, whose maps are
composed (``scan``), and deals the held-out rows out in blocks of steps. Numpy solves the small systems of many
series at once and gets all steps of a block from a few products of the step matrix; a jump to the
start of a block is a power of it, so a long horizon is no sequence of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from metframe import schemas
from metframe.operators.forecast import SeriesRows, lag_col
from metframe.operators.scan import MAP, behind, undone, width
from metframe.operators.series import POS
from metframe.operators.skew import lookup_join
from metframe.session import cut_lineage

P = schemas.SEASON
LAGS = [0, 1, 2, P, P + 1, P + 2, 2 * P, 2 * P + 1, 2 * P + 2]
Y_LAGS = sorted({k + j for k in LAGS for j in (0, 1, P, P + 1)})
LIMIT = 0.95
MIN_OBS = 3 * P
BLOCK = 4_096      # held-out steps a task scores
PACKED = 65_536    # train values a task undoes
DEPTH = P + 1  # values of y, w and e the state keeps
LEAD = 2 * DEPTH  # values in front of a residual that its lags reach
COEFS = ["phi", "theta", "seasonal_phi", "seasonal_theta"]


def w_lag(k: int) -> Column:
    """First difference of the seasonal difference, k steps back."""
    return (lag_col(k) - lag_col(k + 1)) - (lag_col(k + P) - lag_col(k + P + 1))


def lag_sums(long: DataFrame, series: Sequence[str]) -> DataFrame:
    """Per series: complete rows of the train part, and the sums of products in row-major order of
    the upper triangle."""
    names = [f"w{k}" for k in LAGS]
    values = {k: f"y_{k}" if k else "y" for k in Y_LAGS}
    rows = long.where(F.col(POS) <= F.col("n_train")).dropna(subset=list(values.values())).selectExpr(*series, *[
        f"({values[k]} - {values[k + 1]}) - ({values[k + P]} - {values[k + P + 1]}) AS {n}"
        for k, n in zip(LAGS, names)
    ])
    products = ", ".join(f"sum({a} * {b})" for i, a in enumerate(names) for b in names[i:])
    return rows.groupBy(*series).agg(F.count("*").alias("n_obs"), F.expr(f"array({products})").alias("sums"))


def solve(sums: np.ndarray) -> np.ndarray:
    """Coefficients of many series from their sums, a row each; NaN where a system is singular."""
    n, many = len(LAGS), len(sums)
    gram = np.zeros((many, n, n))
    rows, columns = np.triu_indices(n)
    gram[:, rows, columns] = sums
    gram[:, columns, rows] = sums
    at = {k: i for i, k in enumerate(LAGS)}
    ar = [at[1], at[P], at[P + 1]]

    def solved(system: np.ndarray, right: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        usable = usable & np.isfinite(system).all(axis=(1, 2))
        usable[usable] = np.linalg.cond(system[usable]) <= 1e10
        out = np.full(right.shape, np.nan)
        out[usable] = np.linalg.solve(system[usable], right[usable][..., None])[..., 0]
        return out, usable

    a, usable = solved(gram[:, ar][:, :, ar], gram[:, ar, 0], gram[:, 0, 0] > 0)
    # The regressors as combinations of the lags: w and the residual, one step and one season back.
    # e[t-13] is left to the product term of the model; its own column would need longer lags.
    x = np.zeros((many, 4, n))
    for i, k in enumerate((1, P)):
        x[:, 2 * i, at[k]] = x[:, 2 * i + 1, at[k]] = 1.0
        for j, lag in enumerate((1, P, P + 1)):
            x[:, 2 * i + 1, at[k + lag]] -= a[:, j]
    xg = x @ gram
    coefs, _ = solved(xg @ x.transpose(0, 2, 1), xg[:, :, 0], usable)
    return np.clip(coefs, -LIMIT, LIMIT)


def fit_sarima(long: DataFrame, series: Sequence[str]) -> DataFrame:
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solved(sums: pd.Series) -> pd.Series:
        return pd.Series(list(solve(np.array(sums.to_list(), dtype=float).reshape(len(sums), -1))))

    fit = lag_sums(long, series).where(F.col("n_obs") >= MIN_OBS).select(
        *series, solved("sums").alias("c")
    )
    return fit.where(~F.isnan(F.col("c")[0])).select(
        *series, *[F.col("c")[i].alias(name) for i, name in enumerate(COEFS)]
    )


def step_matrix(phi: float, theta: float, sphi: float, stheta: float) -> np.ndarray:
    """One step of the state (y[t..t-12], w[t..t-12], e[t..t-12]) with no new shock."""
    d = DEPTH
    m = np.zeros((3 * d, 3 * d))
    y, w, e = 0, d, 2 * d
    for base in (y, w, e):
        for i in range(1, d):
            m[base + i, base + i - 1] = 1.0
    m[w, w], m[w, w + P - 1], m[w, w + P] = phi, sphi, -phi * sphi
    m[w, e], m[w, e + P - 1], m[w, e + P] = theta, stheta, theta * stheta
    m[y] = m[w]
    m[y, y] += 1.0
    m[y, y + P - 1] += 1.0
    m[y, y + P] -= 1.0
    return m


def last_ones(values: np.ndarray) -> np.ndarray:
    """The last ``DEPTH`` values, newest first; zeros where there are none."""
    return np.concatenate([np.zeros(DEPTH), values])[:-DEPTH - 1:-1]


def block_map(values: np.ndarray, phi: float, theta: float, sphi: float, stheta: float) -> tuple[int, np.ndarray, np.ndarray]:
    """From values in time order, the first ``LEAD`` of which only serve as lags: how many residuals there are, the state
    they give from zeros, and the last values of y and w."""
    y = values[~np.isnan(values)]
    d = np.diff(y)
    w = d[P:] - d[:-P]
    z = w[P + 1:] - phi * w[P:-1] - sphi * w[1:-P] + phi * sphi * w[:-P - 1]
    state = undone(z, theta, stheta, np.zeros(width(True)))[1] if len(z) else np.zeros(width(True))
    return len(z), state, np.concatenate([last_ones(y), last_ones(w)])


def state_of(values: np.ndarray, phi: float, theta: float, sphi: float, stheta: float) -> np.ndarray | None:
    """State at the end of a whole series; residuals before it count as zero."""
    y = np.asarray(values, dtype=float)
    if np.count_nonzero(~np.isnan(y)) < 3 * DEPTH:
        return None
    _, state, last = block_map(y, phi, theta, sphi, stheta)
    return np.concatenate([last, state[1:]])


def end_state(long: DataFrame, coefs: DataFrame, series: Sequence[str], block: int | None = None) -> DataFrame:
    """State of each series at the end of its train part.

    The rows are packed into blocks, each with the few values in front of it that its lags need; every block gives
    its map of the residuals' state, and the maps of a series are composed.
    """
    size = max(block or PACKED, LEAD)
    own = F.expr(f"({POS} - 1) div {size}")
    at_end = (F.col(POS) - 1) % size >= size - LEAD
    rows = long.where((F.col(POS) <= F.col("n_train")) & F.col("y").isNotNull()).withColumn("_own", own)
    dealt = rows.withColumn("_b", F.explode(F.when(at_end, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    mine = F.col("_own") == F.col("_b")
    packed = dealt.groupBy(*series, "_b").agg(
        F.sort_array(F.collect_list(F.struct(POS, "y"))).alias("_v"), F.count_if(mine).alias("_n"),
        F.max("n_train").alias("n_train"), F.max(F.when(mine, F.col("time"))).alias("_time"),
    ).where("_n > 0").select(*series, "_b", "_n", "n_train", "_time", F.col("_v.y").alias("y"))
    joined = lookup_join(packed, coefs.select(*series, *COEFS), series)
    extra = [
        T.StructField("_n", T.LongType()), T.StructField("n_train", T.LongType()), T.StructField("_time", long.schema["time"].dataType),
        T.StructField("_last", T.ArrayType(T.DoubleType())), *[T.StructField(c, T.DoubleType()) for c in COEFS],
    ]
    schema = T.StructType([*[long.schema[k] for k in series], *MAP, *extra])
    names, columns = list(series), schema.fieldNames()

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                c = [float(row[name]) for name in COEFS]
                n, state, last = block_map(np.asarray(row["y"], dtype=float), *c)
                out.append((*[row[k] for k in names], row["_b"], n, [c[1], c[3]], state, row["_n"], row["n_train"], row["_time"], last, *c))
            yield pd.DataFrame(out, columns=columns)

    blocks = cut_lineage(joined.mapInPandas(maps, schema))
    newest = F.max_by(F.struct("n_train", F.col("_time").alias("last_time"), *COEFS, "_last"), "_b")
    ends = blocks.groupBy(*series).agg(newest.alias("_e"), F.sum("_n").alias("_n")).where(F.col("_n") >= 3 * DEPTH)
    return ends.join(behind(blocks.select(*series, *[f.name for f in MAP]), series, True), list(series)).select(
        *series, "_e.n_train", "_e.last_time", *[f"_e.{c}" for c in COEFS], F.concat("_e._last", F.slice("c", 2, DEPTH)).alias("state"))


def jump(state: np.ndarray, matrix: np.ndarray, steps: int) -> np.ndarray:
    return np.linalg.matrix_power(matrix, steps) @ state if steps else state


def walk(state: np.ndarray, matrix: np.ndarray, steps: int) -> np.ndarray:
    """The next ``steps`` values of y: each product doubles the states that are known."""
    states, power = (matrix @ state)[:, None], matrix
    while states.shape[1] < steps:
        states = np.hstack([states, power @ states])
        power = power @ power
    return states[0, :steps]


def score_sarima(long: DataFrame, states: DataFrame, series: Sequence[str], block: int = BLOCK) -> DataFrame:
    """RMSE over the held-out rows, worked out in blocks of steps that are independent tasks."""
    test = long.where(F.col(POS) > F.col("n_train")).select(
        *series, "y", (F.col(POS) - F.col("n_train")).alias("h")
    ).withColumn("_block", F.floor((F.col("h") - 1) / block).cast("long"))
    blocks = test.groupBy(*series, "_block").agg(F.count("*").alias("_m")).drop("_m")
    starts = blocks.join(states.select(*series, "state", *COEFS), list(series))
    # Own key names: both sides of the cogroup come from the same rows.
    keys = [*series, "_block"]
    starts = starts.withColumnsRenamed({k: f"_start_{k}" for k in keys})
    schema = T.StructType([
        *[long.schema[k] for k in series], T.StructField("n", T.LongType()),
        T.StructField("n_bad", T.LongType()), T.StructField("sse", T.DoubleType()),
    ])

    columns = schema.fieldNames()

    def partial(key: tuple, rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or start.empty:
            return pd.DataFrame(columns=columns)
        *names, number = key
        m = step_matrix(*[float(start[c].iloc[0]) for c in COEFS])
        state = jump(np.asarray(start["state"].iloc[0], dtype=float), m, int(number) * block)
        h = rows["h"].to_numpy() - int(number) * block
        errors = rows["y"].to_numpy(dtype=float) - walk(state, m, int(h.max()))[h - 1]
        bad = int(np.isnan(errors).sum())
        return pd.DataFrame([(*names, len(h), bad, float(np.nansum(errors ** 2)))], columns=columns)

    parts = test.groupBy(*keys).cogroup(starts.groupBy(*[f"_start_{k}" for k in keys])).applyInPandas(partial, schema)
    return parts.groupBy(*series).agg(
        F.when(F.sum("n_bad") == 0, F.sqrt(F.sum("sse") / F.sum("n"))).alias("rmse")
    )


def ahead(states: np.ndarray, coefs: np.ndarray, steps: int) -> np.ndarray:
    """The next ``steps`` values of y of many series, one state and one row of coefficients each."""
    y, w, e = (states[:, i * DEPTH:(i + 1) * DEPTH] for i in range(3))
    phi, theta, sphi, stheta = coefs.T
    out = np.empty((len(states), steps))
    for i in range(steps):
        new = phi * w[:, 0] + sphi * w[:, P - 1] - phi * sphi * w[:, P]
        new = new + theta * e[:, 0] + stheta * e[:, P - 1] + theta * stheta * e[:, P]
        out[:, i] = new + y[:, 0] + y[:, P - 1] - y[:, P]
        y, w, e = (np.column_stack([x, old[:, :-1]]) for x, old in ((out[:, i], y), (new, w), (np.zeros(len(e)), e)))
    return out


def next_values(states: DataFrame, series: Sequence[str], steps: int) -> DataFrame:
    """The next ``steps`` values of each series as an array column ``next``."""
    schema = T.StructType([*states.schema.fields, T.StructField("next", T.ArrayType(T.DoubleType()))])

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            before = np.array(rows["state"].to_list(), dtype=float).reshape(len(rows), 3 * DEPTH)
            rows["next"] = list(ahead(before, rows[COEFS].to_numpy(dtype=float), steps))
            yield rows

    return states.mapInPandas(step, schema)


def sarima_models(rows: SeriesRows, coefs: DataFrame | None = None) -> DataFrame:
    """Model rows of kind ``sarimax``, from sums alone or from the given coefficients."""
    series, plain = rows.series, rows.with_lags([])
    if coefs is None:
        coefs = cut_lineage(fit_sarima(rows.with_lags(Y_LAGS), series))
    states = cut_lineage(end_state(plain, coefs, series))
    scores = score_sarima(plain, states, series)
    pairs = [x for c in COEFS for x in (F.lit(c), F.col(c))]
    return next_values(states, series, 1).join(scores, series, "left").select(
        *series, F.lit("sarimax").alias("model"), F.create_map(*pairs).alias("coefs"),
        "n_train", "last_time", "state", F.col("next")[0].alias("next_value"), "rmse",
    )
