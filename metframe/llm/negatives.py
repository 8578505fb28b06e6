"""Hard negatives by threshold joins of integer vectors.

Rows are dealt out in blocks, anchors in chunks, and each task joins one chunk with one block. The inverted index of
a block has the entries of its rows by dimension, heaviest dimensions first, but for those that a bound covers: from
some dimension on the norm of the rest of a row times that of an anchor is below every threshold, so a pair must
have met before. Partial scores grow along the index, a row is dropped once the norms of what remains cannot lift it
to the threshold of any anchor, and rows that are left get the rest of their score. Thresholds start high and fall until
an anchor's windows are full or its floor is reached, so what a task returns is exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from metframe.session import cut_lineage

BLOCK, LEAST, SPREAD = 1 << 16, 1 << 12, 64  # most rows of a block; blocks are not smaller than LEAST to have SPREAD of them
CHUNK = 1 << 14   # anchors that a task joins with a block
TOGETHER = 64     # anchors that are searched side by side
SLAB = 1 << 13    # rows of a block that are indexed together
STEP = 16         # dimensions between two prunings
FALL = 0.8        # by which a threshold falls
SCALE = 256.0
SLACK = 1 + 1e-9  # of bounds, for the rounding of norms
EXACT = 2.0**53   # sums of products below it are exact in doubles
LONGEST = 2**63 - 1


def vectors(df: DataFrame, vec_id: str, embedding: str, label: Column) -> DataFrame:
    """(vec_id, label, embedding, key) of the rows that take part, repeated ones once."""
    values = F.col(f"`{embedding}`").cast("array<double>")
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), values.alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))
    return rows.distinct().withColumn("key", F.xxhash64("vec_id", "label", "embedding"))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """The scaled components, rounded down, a row for each vector; what a shorter vector lacks is 0."""
    sizes = pc.list_value_length(column).to_numpy().astype(np.int64)
    own = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(sizes), width))
    out[own, np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.floor(SCALE * pc.list_flatten(column).to_numpy())
    return out


def rests(rows: np.ndarray) -> np.ndarray:
    """The norm of every row from each dimension on; the last column is 0."""
    out = np.zeros((len(rows), rows.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum(np.square(rows[:, ::-1]), axis=1)[:, ::-1])
    return out


class Index:
    """Rows of a slab by dimension, the heaviest dimensions first."""

    def __init__(self, rows: np.ndarray):
        self.order = np.argsort(-np.square(rows).sum(0), kind="stable")
        self.rows = rows[:, self.order]
        self.rest, self.width = rests(self.rows), rows.shape[1]

    def reaching(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row and score of all pairs whose score is at least the anchor's threshold."""
        anchors = anchors[:, self.order]
        own = rests(anchors)
        # Scores are whole numbers, and none is below the least of these.
        thresholds = np.maximum(np.ceil(thresholds), -np.ceil(own[:, 0] * self.rest[:, 0].max(initial=0.0) * SLACK) - 1)
        tops = own.max(0) * SLACK
        # Dimensions up to ``listed`` are in the index; the rest of a row is below every threshold by itself.
        listed = np.minimum((self.rest * tops >= thresholds.min()).sum(1), self.width)
        rows = np.flatnonzero(listed > 0)
        above = np.repeat(-thresholds[:, None], len(rows), 1)  # partial scores less the threshold
        # First along the index, then, for the rows that are left, what was kept out of it.
        for of_index in (True, False):
            for start in range(0, self.width, STEP):
                stop = min(start + STEP, self.width)
                entries = self.rows[rows, start:stop]
                entries[(np.arange(start, stop) < listed[rows, None]) != of_index] = 0
                above += anchors[:, start:stop] @ entries.T
                seen = np.minimum(listed[rows], stop) if of_index else np.maximum(listed[rows], stop)
                alive = above.max(0) + tops[seen] * self.rest[rows, seen] >= 0
                if len(alive) and alive.mean() < 0.7:
                    rows, above = rows[alive], above[:, alive]
            if not len(rows) or listed[rows].min() == self.width:
                break
        a, at = np.nonzero(above >= 0)
        return a, rows[at], above[a, at] + thresholds[a]


@dataclass
class Found:
    """The best rows of windows so far, those of a window by falling score, then by id and key."""

    window: np.ndarray
    score: np.ndarray
    vec_id: np.ndarray
    key: np.ndarray

    @staticmethod
    def none() -> Found:
        return Found(*(np.empty(0, t) for t in (np.int64,) * 4))

    def of(self, rows: np.ndarray) -> Found:
        return Found(self.window[rows], self.score[rows], self.vec_id[rows], self.key[rows])

    def best(self, other: Found, size: int) -> Found:
        """The first ``size`` rows of each window, of both."""
        both = Found(*(np.concatenate(x) for x in zip(self.parts(), other.parts())))
        order = np.lexsort((both.key, both.vec_id, -both.score, both.window))
        windows = both.window[order]
        starts = np.flatnonzero(np.diff(windows, prepend=-1))
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        return both.of(order[rank < size])

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.window, self.score, self.vec_id, self.key

    def last(self, n_windows: int, size: int, low: np.ndarray) -> np.ndarray:
        """The score from which on a row may still enter each window: that of the last one if it is full, else ``low``."""
        out, n = low.copy(), np.bincount(self.window, minlength=n_windows)
        stops = np.cumsum(n)
        full = n >= size
        out[full] = self.score[stops[full] - 1]
        return out


class Seekers:
    """Anchors and their windows: scores ``low`` to ``high``, of rows with the same label or with another one."""

    def __init__(self, anchors: np.ndarray, label: np.ndarray, key: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, size: int):
        self.anchors, self.label, self.key = anchors, label, key
        self.owner, self.low, self.high, self.same, self.size = owner, low, high, same, size
        self.first = np.searchsorted(owner, np.arange(len(key)))
        self.count = np.bincount(owner, minlength=len(key))

    def into_windows(self, a: np.ndarray, r: np.ndarray, scores: np.ndarray, slab: Slab) -> Found:
        """The pairs in each window of their anchors that they fit."""
        fits = (self.label[a] == slab.label[r]) == self.same
        fits &= self.key[a] != slab.key[r]
        a, r, scores = a[fits], r[fits], scores[fits]
        n = self.count[a]
        pair = np.repeat(np.arange(len(a)), n)
        window = np.repeat(self.first[a], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        inside = (scores[pair] >= self.low[window]) & (scores[pair] <= self.high[window])
        pair, window = pair[inside], window[inside]
        return Found(window, scores[pair], slab.vec_id[r[pair]], slab.key[r[pair]])

    def searched(self, found: Found, slab: Slab) -> Found:
        """The best rows of every window, of those found and those of the slab."""
        n = len(self.owner)
        floors = np.full(len(self.key), math.inf)
        np.minimum.at(floors, self.owner, found.last(n, self.size, self.low))
        floors[floors <= -float(LONGEST)] = -math.inf
        tops = np.full(len(self.key), -math.inf)
        np.maximum.at(tops, self.owner, self.high)
        reach = rests(self.anchors)[:, 0] * slab.index.rest[:, 0].max(initial=0.0)
        level = np.maximum(np.minimum(reach * FALL, tops), floors) if slab.exact else floors
        open_, done = np.flatnonzero(self.count > 0), []
        while len(open_):
            more = []
            open_ = open_[np.argsort(level[open_], kind="stable")]
            for part in np.split(open_, range(TOGETHER, len(open_), TOGETHER)):
                a, r, scores = slab.reaching(self.anchors[part], level[part])
                more.append(self.into_windows(part[a], r, scores, slab))
            met = more[0]
            for m in more[1:]:
                met = Found(*(np.concatenate(x) for x in zip(met.parts(), m.parts())))
            is_open = np.isin(self.owner, open_)
            now = found.of(np.flatnonzero(is_open[found.window])).best(met, self.size)
            # Full down to the threshold, or the threshold is at the floor: the anchor is through.
            last = now.last(n, self.size, np.full(n, -LONGEST))
            full = np.ones(len(self.key), bool)
            np.logical_and.at(full, self.owner, last >= level[self.owner])
            through = np.zeros(len(self.key), bool)
            through[open_] = full[open_] | (level[open_] <= floors[open_])
            done.append(now.of(np.flatnonzero(through[self.owner[now.window]])))
            open_ = open_[~through[open_]]
            lower = np.where(level > 0.05 * reach, level * FALL, -math.inf)
            level = np.maximum(lower, floors)
        out = Found.none()
        for d in done:
            out = out.best(d, self.size)
        return out


class Slab:
    """Rows of a block and their index."""

    def __init__(self, rows: np.ndarray, vec_id: np.ndarray, label: np.ndarray, key: np.ndarray, exact: bool):
        self.vec_id, self.label, self.key, self.exact = vec_id, label, key, exact
        self.rows, self.index = rows, Index(rows)

    def reaching(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.exact:
            a, r, scores = self.index.reaching(anchors, thresholds)
            return a, r, scores.astype(np.int64)
        # Components too large for sums of doubles: all pairs, in whole numbers of any size.
        scores = np.clip(whole(anchors) @ whole(self.rows).T, -LONGEST, LONGEST).astype(np.int64)
        a, r = (x.ravel() for x in np.indices(scores.shape))
        return a, r, scores.ravel()


def whole(rows: np.ndarray) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(rows.astype(object))


def joiner(width: int, same: bool, size: int):
    def join(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        vec_id, label, key = (rows[c].to_numpy() for c in ("vec_id", "label", "key"))
        values, seeking = matrix(rows["embedding"], width), matrix(anchors["embedding"], width)
        windows = anchors["windows"].combine_chunks()
        owner = np.repeat(np.arange(len(anchors)), pc.list_value_length(windows).to_numpy())
        flat, wanted = windows.flatten(), anchors["label"].to_numpy()
        low, high = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("low", "high"))
        exact = np.abs(values).max(initial=0.0) * np.abs(seeking).max(initial=0.0) * max(width, 1) < EXACT
        out = Found.none()
        # Anchors that look for their own label meet only its rows.
        for one in np.unique(wanted).tolist() if same else [None]:
            mine, theirs = (np.flatnonzero(x == one) if same else np.arange(len(x)) for x in (wanted, label))
            own = np.flatnonzero(np.isin(owner, mine))
            seekers = Seekers(seeking[mine], wanted[mine], anchors["key"].to_numpy()[mine], np.searchsorted(mine, owner[own]), low[own], high[own], same, size)
            found = Found.none()
            for start in range(0, len(theirs) if len(own) else 0, SLAB):
                part = theirs[start:start + SLAB]
                found = seekers.searched(found, Slab(values[part], vec_id[part], label[part], key[part], exact))
            found.window = own[found.window]
            out = Found(*(np.concatenate(x) for x in zip(out.parts(), found.parts())))
        named = pc.take(flat, pa.array(out.window))
        return pa.table({
            "anchor_key": anchors["key"].to_numpy()[owner[out.window]], "anchor_id": anchors["vec_id"].to_numpy()[owner[out.window]],
            "positive_id": named.field("vec_id"), "positive_key": named.field("key"), "positive_score": named.field("score"),
            "vec_id": out.vec_id, "key": out.key, "score": out.score,
        })

    return join


FOUND = "anchor_key long, anchor_id long, positive_id long, positive_key long, positive_score long, vec_id long, key long, score long"


def best_of(rows: DataFrame, anchors: DataFrame, n_blocks: int, n_chunks: int, width: int, same: bool, size: int) -> DataFrame:
    """The first ``size`` rows of every window of the anchors, with their ``rank``."""
    dealt = rows.withColumn("block", F.pmod("key", F.lit(n_blocks)).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    seeking = anchors.withColumn("chunk", F.pmod(F.shiftright("key", 24), F.lit(n_chunks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    found = dealt.groupBy("block", "chunk").cogroup(seeking.groupBy("block", "chunk")).applyInArrow(joiner(width, same, size), FOUND)
    order = Window.partitionBy("anchor_key", "anchor_id", "positive_key", "positive_id").orderBy(F.desc("score"), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def mined(
    df: DataFrame, is_anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: Column | str = "label",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block: int = BLOCK, chunk: int = CHUNK,
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``).

    Anchors are the rows that ``is_anchor``, a condition on ``vec_id`` and ``label``, names. An anchor's positives are
    its first other rows of the same label; the negatives of a positive are the first rows of another label whose
    score is ``low`` to ``high`` hundredths of the positive's. A score is the inner product of the components, scaled
    and rounded down; equal scores go by id, then by content. Without positives, or with an empty window, an anchor has no rows.

    Rows with a null id, label, vector or component, or one that is not finite, take no part. Rows equal in id,
    label and vector count once; different rows of one id are rows of their own. Missing components of shorter
    vectors are 0; scores beyond a long are cut to its range. Other columns do not matter.
    """
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = cut_lineage(vectors(df, vec_id, embedding, label))
    n, width, n_anchors = rows.agg(F.count("*"), F.max(F.size("embedding")), F.count_if(is_anchor)).first()
    n_blocks = max(1, math.ceil(n / block), min(SPREAD, math.ceil(n / min(LEAST, block))))
    sizes = n_blocks, max(1, math.ceil(n_anchors / chunk)), width or 0
    anchors = rows.where(is_anchor).toDF(*rows.columns)
    window = "array<struct<vec_id:long,key:long,score:long,low:long,high:long>>"
    whole = F.array(F.struct(*[F.lit(None).cast("long").alias(c) for c in ("vec_id", "key", "score")], F.lit(-LONGEST).alias("low"), F.lit(LONGEST).alias("high")))
    near = cut_lineage(best_of(rows, anchors.withColumn("windows", whole.cast(window)), *sizes, True, positives))
    share = f"coalesce(try_cast({{}}(cast(score as decimal(20)) * {{}} / 100) as bigint), {LONGEST})"
    bounds = F.struct("vec_id", "key", "score", F.expr(share.format("ceil", low)).alias("low"), F.expr(share.format("floor", high)).alias("high"))
    windows = near.where("score >= 0").groupBy(F.col("anchor_key").alias("key"), F.col("anchor_id").alias("vec_id")).agg(F.collect_list(bounds).cast(window).alias("windows"))
    out = best_of(rows, anchors.join(windows, ["key", "vec_id"]), *sizes, False, negatives)
    return out.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
