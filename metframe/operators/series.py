"""Operators on ordered series: one series per key, ordered by time.

Each takes the plain window over the key when no key is hot, and else works piece by piece
(see ``skew``) and carries what a piece needs from the ones before it in a small broadcast table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from metframe.functions.expr import as_col
from metframe.operators.skew import HOT_ROWS, PIECE, Cuts, Layout, series_layout

POS, SIZE = "pos", "n_rows"


def quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given (total) order.

    Spark puts a group limit below the shuffle, so a task sends one row per key, however hot.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def head_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, pos: str = POS) -> DataFrame:
    """The first ``n`` rows per key with their position 1..n; bounded like ``latest_per``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(pos, F.row_number().over(w)).where(F.col(pos) <= n)


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows overall; each task keeps its own ``n`` before they meet."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def in_time_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sorted output: a range shuffle, no single task."""
    return df.orderBy(*order)


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              columns: Sequence[str]) -> DataFrame:
    """First non-null value of each column per key, each column on its own; null keys dropped."""
    at = F.struct(*order)
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns]
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*firsts)


def ffill(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
          hot: int | Cuts = HOT_ROWS) -> DataFrame:
    """Fill nulls with the last value before them in the series; leading nulls stay."""
    lay = series_layout(df, keys, order, hot)
    so_far = Window.partitionBy(*lay.group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if lay.whole:
        return df.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})

    at = F.struct(*order)
    ends = lay.only_hot().groupBy(*lay.group).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_end_{c}") for c in columns
    ])
    before = Window.partitionBy(*lay.keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*lay.group, *[
        F.last(f"_end_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in columns
    ])
    local = lay.df.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})
    return lay.attach(local, carry, lay.group).select(*[
        F.coalesce(c, f"_carry_{c}").alias(c) if c in columns else F.col(c) for c in df.columns
    ])


def piece_offsets(lay: Layout) -> DataFrame:
    """Rows before each piece of a hot series, and rows of the series."""
    counts = lay.only_hot().groupBy(*lay.group).agg(F.count("*").alias("_m"))
    whole = Window.partitionBy(*lay.keys)
    before = whole.orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *lay.group,
        F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before"),
        F.sum("_m").over(whole).alias("_all"),
    )


def _positioned(lay: Layout, order: Sequence[str], pos: str, size: str) -> DataFrame:
    w = Window.partitionBy(*lay.group)
    local = lay.df.withColumns({
        pos: F.row_number().over(w.orderBy(*order)).cast("long"), size: F.count("*").over(w),
    })
    if lay.whole:
        return local
    offsets = piece_offsets(lay)
    return lay.attach(local, offsets, lay.group).select(
        *[c for c in local.columns if c not in (pos, size)],
        (F.col(pos) + F.coalesce("_before", F.lit(0))).alias(pos),
        F.coalesce("_all", size).alias(size),
        F.col("_before").isNotNull().alias("_hot"),
    )


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], pos: str = POS,
                  size: str = SIZE, hot: int | Cuts = HOT_ROWS) -> DataFrame:
    """Position 1..n of each row in its series, and n."""
    lay = series_layout(df, keys, order, hot)
    return _positioned(lay, order, pos, size).select(*df.columns, pos, size)


def with_lags(df: DataFrame, keys: Sequence[str], order: Sequence[str], lags: Mapping[str, tuple[str, int]],
              pos: str = POS, size: str = SIZE, hot: int | Cuts = HOT_ROWS) -> DataFrame:
    """Position and size as above, and ``name: (column, lag)`` values of earlier rows.

    A hot series is dealt out in blocks of exactly as many positions as a piece may hold rows; the last rows of a
    block are repeated at the head of the next one, as many as the longest lag reaches back.
    """
    lay = series_layout(df, keys, order, hot)
    placed = _positioned(lay, order, pos, size)
    names = [*df.columns, pos, size]
    if not lags:
        return placed.select(*names)
    if lay.whole:
        return _lagged(placed, lay.keys, order, lags).select(*names, *lags)
    return _lagged_by_block(placed, lay.keys, lags, pos, size, lay.cuts.rows, F.col("_hot")).select(*names, *lags)


def lags_of_placed(placed: DataFrame, keys: Sequence[str], lags: Mapping[str, tuple[str, int]], block: int,
                   pos: str = POS, size: str = SIZE) -> DataFrame:
    """``with_lags`` of rows that ``with_position`` has placed: all series are dealt out in blocks of ``block`` positions."""
    if not lags:
        return placed
    return _lagged_by_block(placed, list(keys), lags, pos, size, block, F.lit(True)).select(*placed.columns, *lags)


def _lagged(frame: DataFrame, group: Sequence[str], by: Sequence[str], lags: Mapping[str, tuple[str, int]]) -> DataFrame:
    over = f"OVER (PARTITION BY {quoted(group)} ORDER BY {quoted(by)})"
    return frame.selectExpr("*", *[
        f"lag({quoted([c])}, {k}) {over} AS {quoted([out])}" for out, (c, k) in lags.items()
    ])


def _lagged_by_block(placed: DataFrame, keys: Sequence[str], lags: Mapping[str, tuple[str, int]], pos: str, size: str,
                     rows: int, dealt_out: Column) -> DataFrame:
    reach = max(lag for _, lag in lags.values())
    block = max(rows, reach)
    own = F.when(dealt_out, F.floor((F.col(pos) - 1) / block)).otherwise(0).cast("long")
    in_block = (F.col(pos) - 1) % block + 1
    tail = dealt_out & (in_block > block - reach) & (own < F.floor((F.col(size) - 1) / block))
    dealt = placed.withColumn(
        "_b", F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own)))
    ).withColumn("_halo", F.col("_b") != own)
    return _lagged(dealt, [*keys, "_b"], [pos], lags).where(~F.col("_halo"))


def diff(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, out: str = "diff",
         hot: int | Cuts = HOT_ROWS) -> DataFrame:
    """First difference; null at the head of a series."""
    got = with_lags(df, keys, order, {"_l1": (column, 1)}, "_pos", "_n", hot)
    return got.select(*df.columns, (F.col(column) - F.col("_l1")).alias(out))


def seasonal_diff(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, period: int = 12,
                  out: str = "seasonal_diff", hot: int | Cuts = HOT_ROWS) -> DataFrame:
    """First difference of the seasonal difference."""
    lags = {"_l1": (column, 1), "_ls": (column, period), "_ls1": (column, period + 1)}
    got = with_lags(df, keys, order, lags, "_pos", "_n", hot)
    y, l1, ls, ls1 = (F.col(c) for c in (column, "_l1", "_ls", "_ls1"))
    return got.select(*df.columns, ((y - l1) - (ls - ls1)).alias(out))


def held_out(size: Column | str, share: float) -> Column:
    """Rows of the test part: the share, rounded up."""
    return F.ceil(F.lit(float(share)) * as_col(size)).cast("long")


def chrono_split(df: DataFrame, keys: Sequence[str], order: Sequence[str], share: float = 0.2,
                 hot: int | Cuts = HOT_ROWS) -> DataFrame:
    """Train on the head of each series, test on its last ``share``; adds pos, n_rows, is_train."""
    placed = with_position(df, keys, order, hot=hot)
    return placed.withColumn("is_train", F.col(POS) <= F.col(SIZE) - held_out(SIZE, share))
