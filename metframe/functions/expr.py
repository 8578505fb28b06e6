"""Scalar expressions. All stay inside the JVM; none is a Python function."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

EARTH_KM = 6371.0088


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mean2(a: Column | str, b: Column | str, keep_single: bool = False) -> Column:
    """Mean of two readings; null if either is missing unless ``keep_single``."""
    a, b = as_col(a), as_col(b)
    both = (a + b) / F.lit(2.0)
    return F.coalesce(both, a.cast("double"), b.cast("double")) if keep_single else both


def epoch_time(seconds: Column | str) -> Column:
    return F.timestamp_seconds(as_col(seconds))


def parse_time(text: Column | str, pattern: str | None = None) -> Column:
    """Timestamp of a text, null where it cannot be read."""
    text = as_col(text)
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)


def shift_time(t: Column | str, step: str = "10 minutes") -> Column:
    return as_col(t) + F.expr(f"INTERVAL '{step}'")


def time_text(t: Column | str) -> Column:
    return F.date_format(as_col(t), "yyyy-MM-dd HH:mm:ss")


def slot(t: Column | str, seconds: int) -> Column:
    """Number of the fixed-width time slot a timestamp falls into."""
    return F.floor(F.unix_micros(as_col(t).cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def bin_index(x: Column | str, edges: Sequence[float], include_upper: bool = False) -> Column:
    """0-based number of the left-closed bin ``[edge, next edge)``, null outside all bins."""
    x = as_col(x)
    out = F.lit(None).cast("int")
    last = len(edges) - 2
    for i in range(last, -1, -1):
        below = x <= F.lit(edges[i + 1]) if include_upper and i == last else x < F.lit(edges[i + 1])
        out = F.when((x >= F.lit(edges[i])) & below, F.lit(i)).otherwise(out)
    # NaN sorts above every number in Spark, so no bin takes it.
    return out


def cut(x: Column | str, edges: Sequence[float], labels: Sequence[str], include_upper: bool = False) -> Column:
    """Label of the bin."""
    names = F.array(*[F.lit(label) for label in labels])
    return F.get(names, bin_index(x, edges, include_upper))


def abs_error(actual: Column | str, predicted: Column | str) -> Column:
    return F.abs(as_col(actual) - as_col(predicted))


def root_mean_square(errors: Column) -> Column:
    """Aggregate: root of the mean squared error."""
    return F.sqrt(F.avg(errors * errors))


def or_infinity(score: Column | str) -> Column:
    """A failed score ranks behind every real one."""
    score = as_col(score)
    return F.when(score.isNull() | F.isnan(score), F.lit(float("inf"))).otherwise(score)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def encode_json(*cols: str) -> Column:
    return F.to_json(F.struct(*cols))


def decode_json(text: Column | str, schema: T.StructType) -> Column:
    """Record of a JSON text; a text that is no JSON gives null fields, not a failure."""
    return F.from_json(as_col(text).cast("string"), schema)
