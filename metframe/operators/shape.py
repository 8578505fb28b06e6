"""Reshaping: nested to flat, wide to long and back, renames and tags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def flatten(df: DataFrame, paths: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """One flat column per ``alias: path``. A null parent gives null.

    A path through an array of structs gives the array of that field. Only the leaves named here
    are read from a Parquet scan below.
    """
    return df.select(*keep, *[F.col(path).alias(alias) for alias, path in paths.items()])


def with_fields(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Add (or replace) flat columns next to the nested ones, all read from the input row."""
    return df.withColumns({alias: F.col(path) for alias, path in paths.items()})


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the columns that are there; the others are no error."""
    return df.drop(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def suffix_except(df: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    """Suffix every column but the keys."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in keys})


def tag(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def split_struct(df: DataFrame, name: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select(*[c for c in df.columns if c != name], f"{name}.*")


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The listed columns the frame really has."""
    return [n for n in names if n in df.columns]


def to_long(df: DataFrame, ids: Sequence[str], variables: Sequence[str],
            name: str = "variable", value: str = "value") -> DataFrame:
    """One row per (row, variable); variables the frame lacks are skipped. One pass, no union."""
    have = present(df, variables)
    if not have:
        raise ValueError(f"none of {list(variables)} among the columns")
    return df.select(*ids, *[F.col(v).cast("double").alias(v) for v in have]).unpivot(
        list(ids), have, name, value
    )


def to_wide(df: DataFrame, keys: Sequence[str], variables: Sequence[str],
            name: str = "variable", value: str = "value", suffix: str = "") -> DataFrame:
    """One column per listed variable, its smallest value if a key has several.

    The list of variables is given, so no job looks for them, and the partial aggregate leaves one
    row per key and task before the shuffle.
    """
    aggs = [F.min(F.when(F.col(name) == v, F.col(value))).alias(v + suffix) for v in variables]
    return df.groupBy(*keys).agg(*aggs)


def typed_empty(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def struct_of(*names: str) -> Column:
    return F.struct(*names)
