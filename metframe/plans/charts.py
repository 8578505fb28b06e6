"""The frames behind the dashboard charts. ``raw`` arguments are the nested provider records."""

from __future__ import annotations

from pyspark.sql import DataFrame

from metframe import schemas
from metframe.functions.expr import epoch_time
from metframe.operators.bins import bin_counts, histogram
from metframe.operators.shape import drop_columns, rename, to_long, with_fields
from metframe.operators.summary import compare_sources, mean_by


def expand_a(raw: DataFrame) -> DataFrame:
    """Nested record of provider A with its readings as flat columns beside it."""
    return with_fields(raw, schemas.PATHS_A_CHART).withColumn("time", epoch_time("dt"))


def expand_b(raw: DataFrame) -> DataFrame:
    return with_fields(raw, schemas.PATHS_B_CHART)


def presentation_a(raw: DataFrame) -> DataFrame:
    nested = ["main", "coord", "wind", "sys", "dt", "weather", "base"]
    return rename(drop_columns(expand_a(raw), nested), {"name": "city"})


def presentation_b(raw: DataFrame) -> DataFrame:
    return rename(drop_columns(expand_b(raw), ["current_units", "current", "utc_offset_seconds"]),
                  {"city_name": "city"})


def humidity_by_temperature_a(raw: DataFrame) -> DataFrame:
    return expand_a(raw).select("temperature", "humidity")


def humidity_by_temperature_b(raw: DataFrame) -> DataFrame:
    return expand_b(raw).select("temperature_2m", "relative_humidity_2m")


def temperature_histogram(raw: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(expand_a(raw), "temperature", bins)


def humidity_histogram(raw: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(expand_a(raw), "humidity", bins)


def temperature_ranges(expanded: DataFrame, column: str) -> DataFrame:
    return bin_counts(expanded, column, schemas.TEMPERATURE_EDGES, schemas.TEMPERATURE_LABELS,
                      "Temperature Range", "Count")


def humidity_ranges(expanded: DataFrame, column: str) -> DataFrame:
    return bin_counts(expanded, column, schemas.HUMIDITY_EDGES, schemas.HUMIDITY_LABELS,
                      "Humidity Range", "Count")


def clouds_over_time(raw: DataFrame) -> DataFrame:
    return expand_a(raw).select("time", "clouds")


def visibility_per_city(raw: DataFrame) -> DataFrame:
    return mean_by(expand_a(raw), ["name"], ["visibility"])


def climate_per_city(raw: DataFrame) -> DataFrame:
    """Mean temperature and humidity per city, one row per city and measure."""
    means = mean_by(expand_a(raw), ["name"], ["temperature", "humidity"])
    return to_long(means, ["name"], ["temperature", "humidity"])


def temperature_and_felt(raw: DataFrame) -> DataFrame:
    return to_long(expand_a(raw), ["time"], ["temperature", "feels_like"])


def temperature_extremes(raw: DataFrame) -> DataFrame:
    return to_long(expand_a(raw), ["time"], ["temperature_min", "temperature_max"])


def felt_by_pressure(raw: DataFrame) -> DataFrame:
    return expand_b(raw).select("apparent_temperature", "pressure_msl")


# Measure of the comparison -> column at provider A, at provider B.
COMPARED = {
    "temperature": ("temperature", "temperature_2m"),
    "humidity": ("humidity", "relative_humidity_2m"),
    "grnd_level": ("grnd_level", "surface_pressure"),
}


def provider_comparison(raw_a: DataFrame, raw_b: DataFrame, measure: str,
                        name_a: str = "provider_a", name_b: str = "provider_b") -> DataFrame:
    column_a, column_b = COMPARED[measure]
    return compare_sources(
        {name_a: (expand_a(raw_a), "name", column_a), name_b: (expand_b(raw_b), "city_name", column_b)},
        "name", measure,
    )


def compared_actuals(raw_a: DataFrame) -> DataFrame:
    """City and the four readings that are set against predictions."""
    return raw_a.select(
        raw_a["name"].alias("city"), *[raw_a["main"][v].alias(v) for v in schemas.COMPARED_VARIABLES]
    )
