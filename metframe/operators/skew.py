"""Ways around a key that holds a large share of all rows.

``hot_keys`` finds such keys with one map-side-combined count over the key columns alone; they stay a
table, however many there are. ``lookup_join`` joins facts with a table that has one row per key:
broadcast when the table's bytes are within a bound, else a shuffle join in which the rows of hot keys
are spread by a salt. ``series_layout`` cuts the series of hot keys into pieces in time order, so that a
window never has to hold a whole hot series in one task. The cuts only say where a series is divided; the
operators in ``series`` carry the state over the cuts, so results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from metframe.session import cut_lineage

HOT_ROWS = 4_000_000          # rows of one key that one task may hold
SMALL_BYTES = 16 << 20        # a table of at most that many bytes may go to every executor
BROADCAST_PIECES = 100_000    # and so may that many pieces of hot series
NULL_SALTS = 4_096            # tasks that share the rows without a key

PIECE = "_piece"


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``rows`` rows and their count ``_n``, as a written table; None if there are none."""
    found = cut_lineage(df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > rows))
    return None if found.isEmpty() else found


def is_small(df: DataFrame, size: int = SMALL_BYTES) -> bool:
    """Does Spark's own estimate, which for derived frames is an upper one, put the frame within ``size`` bytes?"""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= size


def attach(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left", rows: int = 0) -> DataFrame:
    """Join a frame of at most ``rows`` rows to every row, nulls in the keys being equal. Up to
    ``BROADCAST_PIECES`` rows are broadcast; more are shuffled."""
    renamed = small.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    sent = F.broadcast(renamed) if rows <= BROADCAST_PIECES else renamed
    return big.join(sent, cond, how).drop(*[f"_key_{k}" for k in keys])


def lookup_join(facts: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner",
                small: int = SMALL_BYTES, hot: int = HOT_ROWS, cold: bool = False) -> DataFrame:
    """Join facts with a table that has at most one row per key.

    ``cold`` says that the caller has already found no key to be hot.
    """
    on = list(on)
    if is_small(table, small):
        return facts.join(F.broadcast(table), on, how)
    keys = None if cold else hot_keys(facts, on, hot)
    if keys is None:
        return facts.join(table, on, how)
    # A hot key gets as many salts as it needs to leave about ``hot`` rows on each; the one row it
    # has in the table is repeated for each salt. All other keys keep salt 0. Rows without a key
    # match nothing and may go anywhere. The salt comes from the row and its input partition, so a
    # task that runs again deals its rows out as before.
    salts = keys.dropna(subset=on).select(*on, F.ceil(F.col("_n") / hot).cast("int").alias("_salts"))
    spread = F.broadcast(salts) if is_small(salts) else salts
    dice = F.xxhash64(*facts.columns, F.spark_partition_id())
    no_key = F.lit(False)
    for k in on:
        no_key = no_key | F.col(k).isNull()
    salted = facts.join(spread, on, "left").withColumn(
        "_salt",
        F.when(no_key, -1 - F.pmod(dice, F.lit(NULL_SALTS)))
        .when(F.col("_salts").isNotNull(), F.pmod(dice, F.col("_salts")))
        .otherwise(0).cast("int"),
    ).drop("_salts")
    copies = table.join(spread, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    ).drop("_salts")
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


@dataclass
class Cuts:
    """Where the series of hot keys are divided.

    ``frame`` has a row per hot key with the sorted order tuples ``_cuts`` at which its later pieces start,
    ``pieces`` counts all pieces, ``most`` is the greatest number of cuts of one key, ``longest`` that of its rows. The
    frame is None when no key has more than ``rows`` rows.
    """

    rows: int
    frame: DataFrame | None
    order: list[str] = field(default_factory=list)
    pieces: int = 0
    most: int = (1 << 30) - 1
    longest: int | None = None


@dataclass
class Layout:
    """Rows with the column ``_piece`` where there are cuts; ``group`` bounds a window partition."""

    df: DataFrame
    keys: list[str]
    group: list[str]
    cuts: Cuts

    @property
    def whole(self) -> bool:
        return self.cuts.frame is None

    def only_hot(self) -> DataFrame:
        mark = self.cuts.frame.select(*self.keys, F.lit(True).alias("_is_hot"))
        return self.attach(self.df, mark, self.keys, "inner").drop("_is_hot")

    def attach(self, big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
        """Join a frame with at most a row per piece."""
        return attach(big, small, keys, how, self.cuts.pieces)


def count_not_after(cuts: Column, at: Column, most: int = (1 << 30) - 1) -> Column:
    """How many entries of a sorted array of at most ``most`` are <= ``at``: binary search inside one expression."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, most.bit_length())))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda pos, step: F.when(F.get(cuts, pos + step - 1) <= at, pos + step).otherwise(pos),
    )


def order_tuple(df: DataFrame, order: Sequence[str]) -> Column:
    """The order columns, then a hash of the row, so that rows of equal or null order values can be divided too."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return F.struct(*[F.col(c).alias(c) for c in order], F.xxhash64(*hashed).alias("_tie"))


def find_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = HOT_ROWS) -> Cuts:
    """Cut the series of hot keys so that no piece has more than ``rows`` rows.

    The order tuples of the hot rows are sorted by range; every ``rows``-th row of a range starts a piece.
    Only rows that are equal in all columns have to stay together.
    """
    keys, order = list(keys), list(order)
    hot = hot_keys(df, keys, rows)
    if hot is None:
        return Cuts(rows, None, order)
    many, longest = hot.agg(F.count("*"), F.max("_n")).first()
    slim = attach(df.select(*keys, order_tuple(df, order).alias("_at")), hot, keys, "inner", many).drop("_n")
    ranged = slim.repartitionByRange(*keys, "_at").sortWithinPartitions(*keys, "_at")
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    starts = ranged.withColumn("_number", number).where(F.col("_number") % rows == 0)
    frame = cut_lineage(starts.groupBy(*keys).agg(F.sort_array(F.collect_set("_at")).alias("_cuts")))
    pieces, most = (x or 0 for x in frame.agg(F.sum(F.size("_cuts") + 1), F.max(F.size("_cuts"))).first())
    return Cuts(rows, frame, order, pieces, most, longest)


def series_layout(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: int | Cuts = HOT_ROWS) -> Layout:
    """The rows with the number of their piece, given the cuts or the rows a piece may hold."""
    keys = list(keys)
    cuts = hot if isinstance(hot, Cuts) else find_cuts(df, keys, order, hot)
    if cuts.frame is None:
        return Layout(df, keys, keys, cuts)
    piece = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(count_not_after(F.col("_cuts"), F.col("_at"), cuts.most))
    cut = attach(df.withColumn("_at", order_tuple(df, cuts.order)), cuts.frame, keys, rows=cuts.pieces)
    return Layout(cut.withColumn(PIECE, piece).drop("_cuts", "_at"), keys, [*keys, PIECE], cuts)
