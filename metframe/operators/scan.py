"""Associative scan of a linear recursion over the blocks of many series.

A block of n values turns the state in front of it into ``M**n @ state + c``: M is one step of the recursion, c what
the block gives from a state of zeros. Two such maps one after the other are a map of the same form, so the
state in front of every block comes from maps composed in groups, the groups' maps composed in groups again,
and so on: a number of rounds that grows with the logarithm of the blocks, and no task holds more than a group.

The recursion undoes a moving average at lag 1, then one at lag ``P``; the state is the last value in between
and the last ``P + 1`` results, or just the last value where there is no second one. A row may carry many
points (coefficients of the two), its ``c`` has the state of each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from metframe import schemas
from metframe.session import cut_lineage

P = schemas.SEASON
FAN = 256  # blocks whose maps one task composes
DOUBLES = T.ArrayType(T.DoubleType())
MAP = [T.StructField("_b", T.LongType()), T.StructField("n", T.LongType()), T.StructField("points", DOUBLES), T.StructField("c", DOUBLES)]


def width(seasonal: bool) -> int:
    """Numbers in the state."""
    return P + 2 if seasonal else 1


def undo(x: np.ndarray, coef: float, step: int) -> np.ndarray:
    """y with y[t] + coef * y[t - step] = x[t], by doubling: 1/(1+q) = (1-q)(1+q^2)(1+q^4)..."""
    y, factor, lag = x.astype(float), -coef, step
    while lag < len(y) and factor:
        y[lag:] += factor * y[:-lag]
        factor, lag = factor * factor, lag * 2
    return y


def undone(values: np.ndarray, theta: float, seasonal_theta: float, state: np.ndarray, inner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The results of a block with the state in front of it: the last ones of that state, oldest first, then its
    own; and the state behind the block. ``inner`` are the values in between, if they are known."""
    if inner is None:
        inner = undo_from(values, theta, state[0])
    if len(state) == 1:
        return np.concatenate([state, inner]), inner[-1:]
    first = inner.copy()
    n = min(P, len(first))
    first[:n] -= seasonal_theta * state[P:P - n:-1]
    out = np.concatenate([state[:0:-1], undo(first, seasonal_theta, P)])
    return out, np.concatenate([inner[-1:], out[:-P - 2:-1]])


def undo_from(values: np.ndarray, theta: float, before: float) -> np.ndarray:
    """Lag 1 alone, after the value ``before``."""
    first = values.copy()
    first[:1] -= theta * before
    return undo(first, theta, 1)


def steps(points: np.ndarray, seasonal: bool) -> np.ndarray:
    """M for every point (theta, seasonal theta)."""
    d = width(seasonal)
    m = np.zeros((len(points), d, d))
    m[:, 0, 0] = -points[:, 0]
    if seasonal:
        m[:, 1, 0], m[:, 1, P] = -points[:, 0], -points[:, 1]
        m[:, np.arange(2, d), np.arange(1, d - 1)] = 1.0
    return m


class Maps:
    """Composes the maps of one series, whose points are the same in all blocks."""

    def __init__(self, points: Sequence[float], seasonal: bool):
        self.m, self.powers = steps(np.reshape(points, (-1, 2)), seasonal), {}

    def zero(self) -> np.ndarray:
        return np.zeros(self.m.shape[:2])

    def state(self, c: Sequence[float]) -> np.ndarray:
        return np.reshape(np.asarray(c, float), self.m.shape[:2])

    def after(self, state: np.ndarray, n: int, c: np.ndarray) -> np.ndarray:
        if n not in self.powers:
            self.powers = {n: np.linalg.matrix_power(self.m, n)}  # neighbouring blocks mostly have the same size
        return np.einsum("gij,gj->gi", self.powers[n], state) + c


def grouped(maps: DataFrame, series: Sequence[str], seasonal: bool, inner: bool) -> DataFrame:
    """Per group of ``FAN`` blocks the map of the whole group, with the group as ``_b``; with ``inner`` also the map from
    the start of the group to each block, with its number as ``_own``."""
    schema = T.StructType([*[maps.schema[k] for k in series], *MAP, T.StructField("_own", T.LongType())])
    names, columns = list(series), schema.fieldNames()

    def composed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_b")
        points = rows["points"].iloc[0]
        own = Maps(points, seasonal)
        c, n, out = own.zero(), 0, []
        for b, size, part in zip(rows["_b"], rows["n"], rows["c"]):
            if inner:
                out.append((*key[:-1], key[-1], n, points, c.ravel(), b))
            c, n = own.after(c, int(size), own.state(part)), n + int(size)
        out.append((*key[:-1], key[-1], n, points, c.ravel(), None))
        return pd.DataFrame(out, columns=columns).astype({"_own": "Int64"})

    return maps.withColumn("_g", F.expr(f"_b div {FAN}")).groupBy(*names, "_g").applyInPandas(composed, schema)


def entering(maps: DataFrame, series: Sequence[str], seasonal: bool) -> DataFrame:
    """(``series``, ``_b``, ``before``, ``state``): how many values lie in front of each block, and the states there.

    ``maps`` has a row (``series``, ``_b``, ``n``, ``points``, ``c``) for each block that has values.
    """
    inside = cut_lineage(grouped(maps, series, seasonal, True))
    groups = inside.where("_own is null").drop("_own")
    own = inside.where("_own is not null")
    if (maps.agg(F.max("_b")).first()[0] or 0) < FAN:
        return own.select(*series, F.col("_own").alias("_b"), F.col("n").alias("before"), F.col("c").alias("state"))
    front = entering(groups, series, seasonal)
    schema = T.StructType([*[maps.schema[k] for k in series], MAP[0], T.StructField("before", T.LongType()), T.StructField("state", DOUBLES)])
    names, columns = list(series), schema.fieldNames()

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for row in rows.to_dict("records"):
                m = Maps(row["points"], seasonal)
                state = m.after(m.state(row["state"]), int(row["n"]), m.state(row["c"]))
                out.append((*[row[k] for k in names], row["_own"], row["before"] + row["n"], state.ravel()))
            yield pd.DataFrame(out, columns=columns)

    return own.join(front, [*names, "_b"]).mapInPandas(placed, schema)


def behind(maps: DataFrame, series: Sequence[str], seasonal: bool) -> DataFrame:
    """(``series``, ``n``, ``c``): the values of each series and the states behind its last block."""
    last = maps.agg(F.max("_b")).first()[0] or 0
    while True:
        maps, last = grouped(maps, series, seasonal, False).drop("_own"), last // FAN
        if last == 0:
            return maps.select(*series, "n", "c")
        maps = cut_lineage(maps)
