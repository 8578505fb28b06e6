"""Distributions: labelled bins and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from metframe.functions.expr import bin_index, cut


def with_range(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], out: str,
               include_upper: bool = False) -> DataFrame:
    return df.withColumn(out, cut(column, edges, labels, include_upper))


def bin_counts(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str],
               label: str = "range", count: str = "count", include_upper: bool = False) -> DataFrame:
    """Rows per bin, empty bins included, most rows first (then bin order).

    One conditional count per bin in a single aggregate: each task sends one row.
    """
    number = bin_index(column, edges, include_upper)
    counts = df.select(number.alias("_bin")).agg(*[
        F.count_if(F.col("_bin") == i).alias(f"_{i}") for i in range(len(labels))
    ])
    rows = F.array(*[
        F.struct(F.lit(i).alias("_bin"), F.lit(name).alias(label), F.col(f"_{i}").alias(count))
        for i, name in enumerate(labels)
    ])
    return (
        counts.select(F.inline(rows)).orderBy(F.desc(count), "_bin").drop("_bin")
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal-width bins from minimum to maximum, the last one closed.

    The two bounds come from a scalar subquery, so each is a constant when the counting pass runs.
    A constant column falls into bin 0.
    """
    values = df.select(F.col(column).cast("double").alias("_x")).where(
        F.col("_x").isNotNull() & ~F.isnan("_x")
    )
    bounds = values.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("b")).scalar()
    placed = values.select("_x", bounds.alias("_b"))
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    width = F.nullif((hi - lo) / bins, F.lit(0.0))
    number = F.least(F.coalesce(F.floor((F.col("_x") - lo) / width), F.lit(0)), F.lit(bins - 1))
    return (
        placed.groupBy(number.cast("int").alias("bin"))
        .agg(F.count("*").alias("count"))
        .orderBy("bin")
    )
