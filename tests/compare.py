"""Order-insensitive comparison of a Spark result with rows from elsewhere."""

import math


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return None if v is None else str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


def of_spark(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
