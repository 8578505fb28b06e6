"""Putting two providers together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from metframe import schemas
from metframe.functions.expr import epoch_time, mean2
from metframe.operators.shape import flatten

# Blended column -> (provider B reading, provider A reading).
BLENDS = {
    "humidity": ("relative_humidity_2m", "humidity"),
    "temperature_feels_like": ("apparent_temperature", "feels_like"),
    "temperature_2m": ("temp", "temperature_2m"),
}


def flatten_a(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Provider A as flat columns, its epoch seconds as timestamps."""
    return flatten(raw, schemas.PATHS_A, keep).withColumns(
        {c: epoch_time(c) for c in ("time", "sunrise", "sunset")}
    )


def flatten_b(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return flatten(raw, schemas.PATHS_B, keep)


def blend_columns(joined: DataFrame, blends: Mapping[str, tuple[str, str]] = BLENDS,
                  keep_single: bool = False) -> DataFrame:
    """Mean of the readings both providers have. Blends read the joined row, so a blend may replace
    the column it is made from."""
    return joined.withColumns({out: mean2(x, y, keep_single) for out, (x, y) in blends.items()})


def blend_sources(a: DataFrame, b: DataFrame, on: Sequence[str],
                  blends: Mapping[str, tuple[str, str]] = BLENDS, keep_single: bool = False) -> DataFrame:
    """Inner equi-join of two providers, and the blends.

    ``on`` should single out one row per provider: the station, and with more than one batch in the
    frames also the time slot, which also spreads a busy station. A repeated key multiplies.
    """
    return blend_columns(a.join(b, list(on), "inner"), blends, keep_single)


def table_columns(df: DataFrame) -> DataFrame:
    """The columns the observation table stores, in its order."""
    return df.select(*schemas.OBSERVATIONS.fieldNames())


def merge_latest(target: DataFrame, updates: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Last write wins on the whole row, nulls included.

    The row with the highest ``seq`` columns wins, whether it is old or new; of equal ones an update. A
    target without these columns is older than any update that has them.
    """
    from metframe.operators.series import latest_per

    names = target.columns
    old = target.withColumn("_new", F.lit(False))
    both = old.unionByName(updates.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    order = [*[F.desc_nulls_last(s) for s in seq], F.desc("_new"), F.desc(F.xxhash64(*updates.columns))]
    return latest_per(both, keys, order).select(*names)
