"""Group means and provider comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from metframe.operators.shape import tag


def mean_by(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Mean of each measure per key, nulls skipped, null keys dropped, sorted by key."""
    named = measures if isinstance(measures, Mapping) else {m: m for m in measures}
    return (
        df.dropna(subset=list(keys)).groupBy(*keys)
        .agg(*[F.avg(c).alias(out) for out, c in named.items()])
        .orderBy(*keys)
    )


def compare_sources(sources: Mapping[str, tuple[DataFrame, str, str]], key: str, measure: str) -> DataFrame:
    """Mean of a measure per key and source, stacked; ``name: (frame, its key, its measure)``.

    The tag is a constant per branch, so a filter on ``source`` removes the other branches.
    """
    parts = [
        tag(
            df.dropna(subset=[k]).groupBy(F.col(k).alias(key)).agg(F.avg(m).alias(measure)),
            "source", name,
        )
        for name, (df, k, m) in sources.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    return df.agg(F.count("*").alias(out))


def rmse(df: DataFrame, keys: Sequence[str], actual: str, predicted: str, out: str = "rmse") -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return df.groupBy(*keys).agg(F.sqrt(F.avg(error * error)).alias(out))
