"""Least-squares fit of the moving-average models, exact in the search grid, for series of any length.

The conditional sum of squares of an ARIMA model depends on its moving-average part in a nonlinear
way, but once that part is undone the rest is a regression on lags. So the fit is a search over the
moving-average coefficients only: a coarse grid, then finer ones around the best point.

A series is packed into blocks of values. A pass undoes every grid point on every block (numpy, vectorised along
the block) and gives sums of lag products; Spark adds them per series and grid point and keeps the point of the
smallest sum of squares. The blocks are written once. A series of one block starts from zeros; for the blocks of
longer ones a scan (``scan``) first gives the state in front of each, so the sums are those of one pass over the
whole series, wherever it is cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from metframe.operators import forecast, seasonal
from metframe.operators.forecast import SeriesRows
from metframe.operators.scan import MAP, P, entering, undo_from, undone, width
from metframe.operators.series import POS
from metframe.operators.skew import lookup_join
from metframe.session import cut_lineage

BLOCK = 65_536
LEVELS = 4       # the coarse grid and three finer ones
SHRINK = 2.5     # a finer grid has points this much closer
CENTRE = T.StructType([T.StructField("theta", T.DoubleType()), T.StructField("seasonal_theta", T.DoubleType())])


@dataclass(frozen=True)
class Kind:
    """What the search needs to know of a model."""

    difference: Callable[[int], Column]
    lags: tuple[int, ...]      # lags whose products are summed
    y_lags: tuple[int, ...]    # lags of the values that one difference needs
    limit: float
    points: int                # coarse grid points per coefficient
    seasonal: bool
    min_obs: int


ARIMA = Kind(forecast.w_lag, (0, 1), (0, 1), forecast.LIMIT, 41, False, forecast.MIN_OBS)
SARIMA = Kind(
    seasonal.w_lag, (0, 1, P, P + 1), (0, 1, P, P + 1), seasonal.LIMIT, 13, True, seasonal.MIN_OBS,
)


def axis(limit: float, points: int, level: int, centre: float | None) -> list[float]:
    """Values of one coefficient to try."""
    if centre is None:
        return list(np.linspace(-limit, limit, points))
    step = 2 * limit / (points - 1) / SHRINK ** level
    return list(np.unique(np.clip(centre + np.arange(-2, 3) * step, -limit, limit)))


def pack(rows: SeriesRows, kind: Kind, block: int) -> DataFrame:
    """One row per series and block of at most ``block`` values of its train part, in time order; ``many`` tells
    that the series may have more than one block. The search takes far longer than the bytes of a block suggest, so the
    blocks keep to as many partitions as a shuffle has; small ones are not put together."""
    values = rows.with_lags(kind.y_lags).where(F.col(POS) <= F.col("n_train")).select(
        *rows.series, POS, "n_train", kind.difference(0).alias("w"), F.floor((F.col(POS) - 1) / block).cast("long").alias("_b")
    ).dropna(subset=["w"])
    parts = int(rows.df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = values.repartition(parts, *rows.series, "_b").groupBy(*rows.series, "_b").agg(
        F.sort_array(F.collect_list(F.struct(POS, "w"))).alias("_v"), (F.max("n_train") > block).alias("many"))
    return packed.select(*rows.series, "_b", "many", F.col("_v.w").alias("w"))


def grid(kind: tuple[float, int, bool], level: int, centre: tuple) -> list[tuple[float, list[float]]]:
    """Each value of theta to try with its values of the seasonal theta."""
    limit, points, is_seasonal = kind
    outer = axis(limit, points, level, centre[1]) if is_seasonal else [0.0]
    return [(float(theta), [float(s) for s in outer]) for theta in axis(limit, points, level, centre[0])]


def with_states(work: DataFrame, series: Sequence[str], kind: Kind, level: int) -> DataFrame:
    """The blocks with the number of values ``before`` them and the ``state`` of every grid point there."""
    own = (kind.limit, kind.points, kind.seasonal)
    schema = T.StructType([*[work.schema[k] for k in series], *MAP])
    names, columns, seasonal_too = list(series), schema.fieldNames(), kind.seasonal

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                values, zero = np.asarray(row["w"], dtype=float), np.zeros(width(seasonal_too))
                points, states = [], []
                for theta, outer in grid(own, level, (row.get("theta"), row.get("seasonal_theta"))):
                    inner = undo_from(values, theta, 0.0)
                    for stheta in outer:
                        points += [theta, stheta]
                        states.append(undone(values, theta, stheta, zero, inner)[1])
                out.append((*[row[k] for k in names], row["_b"], len(values), points, np.concatenate(states)))
            yield pd.DataFrame(out, columns=columns)

    states = cut_lineage(entering(cut_lineage(work.mapInPandas(maps, schema)), series, kind.seasonal))
    return lookup_join(work, states, [*series, "_b"])


def grid_sums(blocks: DataFrame, series: Sequence[str], kind: Kind, level: int) -> DataFrame:
    """Per series and grid point: rows counted and sums of lag products."""
    pairs = [(a, b) for i, a in enumerate(kind.lags) for b in kind.lags[i:]]
    names = [f"s_{a}_{b}" for a, b in pairs]
    schema = T.StructType([
        *[blocks.schema[k] for k in series], *CENTRE.fields, T.StructField("n", T.LongType()),
        *[T.StructField(n, T.DoubleType()) for n in names],
    ])
    # Plain values only: what the function below holds is sent to the workers.
    lags, own, is_seasonal = kind.lags, (kind.limit, kind.points, kind.seasonal), kind.seasonal
    reach, names_of_key, columns = max(lags), list(series), schema.fieldNames()
    at = [(lags.index(a), lags.index(b)) for a, b in pairs]

    def block_sums(values: np.ndarray, before: int, states: np.ndarray | None, centre: tuple) -> Iterator[tuple]:
        first = max(0, reach - before)  # values in front of which the series has not all lags
        n, nth, zero = len(values) - first, 0, np.zeros(width(is_seasonal))
        if n <= 0:
            return
        for theta, outer in grid(own, level, centre):
            inner = undo_from(values, theta, 0.0 if states is None else states[nth, 0])
            for stheta in outer:
                u, _ = undone(values, theta, stheta, zero if states is None else states[nth], inner)
                nth += 1
                lagged = np.stack([u[reach + first - k:len(u) - k] for k in lags])
                gram = lagged @ lagged.T
                yield (theta, stheta, n, *[float(gram[i, j]) for i, j in at])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                key = tuple(row[k] for k in names_of_key)
                centre = (row.get("theta"), row.get("seasonal_theta"))
                states = None if row["state"] is None else np.reshape(row["state"], (-1, width(is_seasonal)))
                values = np.asarray(row["w"], dtype=float)
                found = [(*key, *s) for s in block_sums(values, 0 if states is None else int(row["before"]), states, centre)]
                yield pd.DataFrame(found, columns=columns)

    per_block = blocks.mapInPandas(sums, schema)
    return per_block.groupBy(*series, *CENTRE.fieldNames()).agg(
        F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names]
    )


def solve_arima(sums: DataFrame, kind: Kind) -> DataFrame:
    phi = forecast.clamp(F.try_divide("s_0_1", F.nullif("s_1_1", F.lit(0.0))), kind.limit)
    return sums.withColumns({"phi": phi, "seasonal_phi": F.lit(0.0)}).withColumn(
        "sse", F.col("s_0_0") - 2 * F.col("phi") * F.col("s_0_1") + F.col("phi") * F.col("phi") * F.col("s_1_1")
    )


def solve_sarima(sums: DataFrame, kind: Kind) -> DataFrame:
    """phi and seasonal phi by turns, each a division of sums; vectorised over the rows."""
    p, lags, limit = P, kind.lags, kind.limit
    out = T.StructType([T.StructField(c, T.DoubleType()) for c in ("phi", "seasonal_phi", "sse")])
    names = [f"s_{a}_{b}" for i, a in enumerate(lags) for b in lags[i:]]

    @F.pandas_udf(out)
    def solved(*columns: pd.Series) -> pd.DataFrame:
        s = {n: c.to_numpy(dtype=float) for n, c in zip(names, columns)}

        def g(a: int, b: int) -> np.ndarray:
            return s[f"s_{min(a, b)}_{max(a, b)}"]

        def ratio(top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
            safe = np.where(bottom > 0, bottom, 1.0)
            return np.clip(np.where(bottom > 0, top / safe, 0.0), -limit, limit)

        f = np.zeros_like(g(0, 0))
        q = np.zeros_like(f)
        for _ in range(25):
            f = ratio(
                g(0, 1) - q * g(0, p + 1) - q * g(1, p) + q * q * g(p, p + 1),
                g(1, 1) - 2 * q * g(1, p + 1) + q * q * g(p + 1, p + 1),
            )
            q = ratio(
                g(0, p) - f * g(0, p + 1) - f * g(1, p) + f * f * g(1, p + 1),
                g(p, p) - 2 * f * g(p, p + 1) + f * f * g(p + 1, p + 1),
            )
        weights = {0: np.ones_like(f), 1: -f, p: -q, p + 1: f * q}
        sse = sum(weights[a] * weights[b] * g(a, b) for a in lags for b in lags)
        return pd.DataFrame({"phi": f, "seasonal_phi": q, "sse": sse})

    return sums.withColumn("_s", solved(*names)).select("*", "_s.*").drop("_s")


def fit_css(rows: SeriesRows, kind: Kind, block: int | None = None, levels: int = LEVELS) -> DataFrame:
    """Coefficients of every series that is long enough and not constant."""
    series = rows.series
    blocks = cut_lineage(pack(rows, kind, block or BLOCK))
    any_many = not blocks.where("many").isEmpty()
    fresh = {"before": F.lit(None).cast("long"), "state": F.lit(None).cast("array<double>")}
    best = None
    for level in range(levels):
        work = blocks
        if best is not None:
            work = lookup_join(blocks, best.select(*series, *CENTRE.fieldNames()), series)
        ready = work.withColumns(fresh)
        if any_many:
            ready = work.where("not many").withColumns(fresh).unionByName(with_states(work.where("many"), series, kind, level))
        sums = grid_sums(ready, series, kind, level)
        solved = solve_sarima(sums, kind) if kind.seasonal else solve_arima(sums, kind)
        usable = solved.where((F.col("n") >= kind.min_obs) & (F.col("s_0_0") > 0) & F.col("sse").isNotNull())
        coefs = F.struct("phi", "theta", "seasonal_phi", "seasonal_theta", "sse", "n")
        # Equal sums of squares: the smaller coefficients.
        order = F.struct(
            "sse", F.abs("theta").alias("a"), F.abs("seasonal_theta").alias("b"), "theta", "seasonal_theta"
        )
        best = cut_lineage(
            usable.groupBy(*series).agg(F.min_by(coefs, order).alias("c")).select(*series, "c.*")
        )
    return best
