"""Repeated byte strings, by longest-previous-factor arrays over suffixes.

The arrays are built where repeats can be. Of every 200-byte window the smallest hash among its 50-byte
grams is its anchor; equal windows have equal anchors at equal places, so a window whose anchor stands
nowhere else in the corpus repeats nowhere. Anchors in equal surroundings repeat whole. For the others the
suffixes that begin in their surroundings are sorted, anchor by anchor, and the previous and next smaller
positions in suffix order tell which window has an earlier (or any other) match of full length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from metframe.llm.text import U64, byte_codes, corpus, mix, powers, prefix_sums, row_key, span_hashes
from metframe.session import cut_lineage

SPAN = 200
GRAM = 50
CHUNK = 1 << 20  # windows of a long text that are looked at together
LIGHT = 8192  # surroundings of one anchor that one task sorts; more are dealt out by window
FLUSH = 150_000  # windows that are sorted together


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, k = x, 1
    while 2 * k <= width:
        out = np.minimum(out[:-k], out[k:])
        k *= 2
    n = len(x) - width + 1
    return np.minimum(out[:n], out[width - k: width - k + n])


def anchors(data: np.ndarray, span: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, surroundings, at, low, high) by chunk: an anchor at ``at`` for the windows low to high, and a
    hash of all bytes of these windows."""
    low_bits = U64((1 << 24) - 1)
    for c in range(0, len(data) - span + 1, CHUNK):
        part = data[c: c + CHUNK + span - 1]
        sums = prefix_sums(part, byte_codes())
        n = len(part) - gram + 1
        hashes = mix((sums[gram:] - sums[:-gram]) * powers(n)[1] + U64(gram))
        # The place in the low bits makes the leftmost of equal grams the anchor.
        least = sliding_min(hashes & ~low_bits | np.arange(n, dtype=U64), span - gram + 1)
        at = (least & low_bits).astype(np.int64)
        ends = np.append(np.flatnonzero(np.diff(at)), len(at) - 1)
        starts = np.append(0, ends[:-1] + 1)
        at = at[starts]
        around = mix(span_hashes(sums, starts, ends + span) + (at - starts).astype(U64) * U64(0x9E3779B97F4A7C15))
        yield hashes[at], around, at + c, starts + c, ends + c


def packed(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place and reach of an anchor in one number."""
    return at << 32 | (at - low) << 16 | at - high


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = place >> 32
    return at, at - (place >> 16 & 0xFFFF), at - (place & 0xFFFF)


def anchor_rows(span: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for i, text in enumerate(batch["text"].to_pylist()):
                data = np.frombuffer(text.encode(), np.uint8)
                for hashes, around, at, low, high in anchors(data, span, gram):
                    found.append((hashes, around, packed(at, low, high).astype(np.int64)))
                    owner.append(np.full(len(at), i))
            if not found:
                continue
            hashes, around, place = (np.concatenate(x) for x in zip(*found))
            own = pa.array(np.concatenate(owner))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(around.view(np.int64)), batch["doc_id"].take(own), batch["row_key"].take(own), pa.array(place)],
                names=["anchor", "around", "doc_id", "row_key", "place"],
            )

    return rows


ANCHORS = "anchor long, around long, doc_id long, row_key long, place long"
NAMED = "anchor long, around long, doc_id long, row_key long, place long, grams binary"
RANGES = "anchor long, around long, first int, last int, earlier boolean"


def surroundings(span: int):
    """The bytes of the windows of each anchor asked for."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc_id, key, text, asked in zip(*(batch[n].to_pylist() for n in ("doc_id", "row_key", "text", "asked"))):
                data = text.encode()
                for a in asked:
                    _, low, high = unpacked(a["place"])
                    for column, value in zip(out, (a["anchor"], a["around"], doc_id, key, a["place"], data[low: high + span])):
                        column.append(value)
            types = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["anchor", "around", "doc_id", "row_key", "place", "grams"])

    return rows


def smaller_before(position: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller position, -1 if there is none."""
    found = np.arange(-1, len(position) - 1)
    open_ = np.flatnonzero((found >= 0) & (position[found] > position))
    while len(open_):
        # What lies between a place and its current find is larger than the find itself.
        found[open_] = found[found[open_]]
        open_ = open_[(found[open_] >= 0) & (position[found[open_]] > position[open_])]
    return found


def previous_factors(windows: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each window (a row of bytes, all of one length) whether it has an earlier match of full length, and
    whether it has any. Positions are different numbers."""
    length = windows.shape[1]
    order = np.argsort(np.ascontiguousarray(windows).view(f"S{length}").ravel(), kind="stable")
    sorted_, where = windows[order], position[order]
    # Neighbours in suffix order with a common prefix of full length are in one run.
    run = np.concatenate([[0], np.cumsum((sorted_[1:] != sorted_[:-1]).any(axis=1))])
    before = smaller_before(where)
    after = len(where) - 1 - smaller_before(where[::-1])[::-1]
    has = np.zeros(len(where), bool)
    for found in (before, after):
        ok = (found >= 0) & (found < len(where))
        has[ok] |= run[found[ok]] == run[ok]
    many = np.bincount(run)[run] > 1
    earlier, any_ = np.empty(len(where), bool), np.empty(len(where), bool)
    earlier[order], any_[order] = has, many
    return earlier, any_


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def matched(rows: list[tuple], span: int, gram: int) -> Iterator[tuple]:
    """(anchor, around, first, last, earlier): windows, counted from the anchor, that repeat among the rows."""
    half, kept = (span - gram) // 2, {}
    for row in rows:
        kept.setdefault(row[:2], row)  # rows of equal id and text name the same surroundings
    buckets: dict[tuple, list] = {}
    for row in kept.values():
        place = row[4]
        back, near = (place >> 16) & 0xFFFF, place & 0xFFFF
        data = row[5]
        # A window holds either the half before the anchor or the half after it; equal windows hold equal ones.
        if back >= half:
            buckets.setdefault((row[0], 0, data[back - half: back]), []).append((row, -back, min(-near, -half)))
        if near < half:
            start = back + gram
            buckets.setdefault((row[0], 1, data[start: start + half]), []).append((row, max(-back, 1 - half), -near))
    for chosen in buckets.values():
        if len(chosen) < 2:
            continue
        order = {id(row): i for i, (row, _, _) in enumerate(sorted(chosen, key=lambda c: tuple((v is not None, v) for v in c[0][2:5])))}
        windows, position = [], []
        for row, first, last in chosen:
            begin = first + ((row[4] >> 16) & 0xFFFF)
            view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(row[5], np.uint8), span)
            windows.append(view[begin: begin + last - first + 1])
            position.append(order[id(row)] * (2 * span) + np.arange(last - first + 1))
        for lot in lots(windows, position, [c[1] for c in chosen], span, gram):
            earlier, any_ = previous_factors(np.concatenate([w[a:b] for w, a, b in lot[0]]), np.concatenate(lot[1]))
            at = 0
            for (_, a, b), i in zip(lot[0], lot[2]):
                row, first, _ = chosen[i]
                for flags, is_earlier in ((earlier[at: at + b - a], True), (any_[at: at + b - a], False)):
                    for s, e in runs_of(flags):
                        yield row[0], row[1], first + a + s, first + a + e, is_earlier
                at += b - a


def lots(windows: list[np.ndarray], position: list[np.ndarray], firsts: list[int], span: int, gram: int):
    """Windows of one bucket in lots that fit in memory: a lot takes, from every row, the windows at some
    distances from the anchor, which are all that windows at these distances can be equal to."""
    low, high = min(firsts), max(f + len(w) for f, w in zip(firsts, windows))
    step = max(1, FLUSH // len(windows))
    for d in range(low, high, step):
        parts, places, rows = [], [], []
        for i, (w, p, f) in enumerate(zip(windows, position, firsts)):
            a, b = max(0, d - f), min(len(w), d + step - f)
            if a < b:
                parts.append((w, a, b))
                places.append(p[a:b])
                rows.append(i)
        if parts:
            yield parts, places, rows


def sorter(span: int, gram: int):
    """Over rows sorted by anchor: all anchors but the last seen are complete."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows: list[tuple]) -> pa.RecordBatch:
            found = list(matched(rows, span, gram))
            columns = list(zip(*found)) if found else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["anchor", "around", "first", "last", "earlier"])

        waiting: list[tuple] = []
        for batch in batches:
            rows = list(zip(*(batch[n].to_pylist() for n in ("anchor", "around", "doc_id", "row_key", "place", "grams"))))
            if not rows:
                continue
            whole = next((i for i in range(len(rows) - 1, -1, -1) if rows[i][0] != rows[-1][0]), -1) + 1
            if whole:
                yield told(waiting + rows[:whole])
                waiting = rows[whole:]
            elif waiting and waiting[-1][0] != rows[0][0]:
                yield told(waiting)
                waiting = rows
            else:
                waiting += rows
        if waiting:
            yield told(waiting)

    return run


def window_rows(span: int):
    """Every window of the surroundings as a hash of its bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (place, data) in enumerate(zip(batch["place"].to_pylist(), batch["grams"].to_pylist())):
                sums = prefix_sums(np.frombuffer(data, np.uint8), byte_codes(2))
                starts = np.arange(len(data) - span + 1)
                one = pa.array(np.full(len(starts), i))
                columns = [batch[n].take(one) for n in ("anchor", "around", "doc_id", "row_key", "place")]
                columns += [pa.array(span_hashes(sums, starts, starts + span).view(np.int64)), pa.array((starts - (place >> 16 & 0xFFFF)).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "around", "doc_id", "row_key", "place", "window", "distance"])

    return rows


def dealt_windows(heavy: DataFrame, span: int) -> DataFrame:
    """The same ranges for anchors with too many surroundings for one task: equal windows meet by their hash,
    counted before they are shuffled."""
    windows = heavy.mapInArrow(window_rows(span), ANCHORS + ", window long, distance int").distinct()
    order = F.struct("doc_id", "row_key", "place")
    groups = windows.groupBy("anchor", "window").agg(F.count("*").alias("n"), F.min(order).alias("least")).where("n > 1")
    met = windows.join(groups, ["anchor", "window"])
    both = F.explode(F.when(order.eqNullSafe(F.col("least")), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))
    return met.select("anchor", "around", F.col("distance").alias("first"), F.col("distance").alias("last"), both.alias("earlier"))


def at_of(place: Column) -> Column:
    return F.shiftright(place, 32)


def ranges(base: DataFrame, span: int, gram: int, keep_first: bool) -> DataFrame:
    """(doc_id, row_key, ranges): the windows of each document that repeat, as structs of first and last start."""
    rows = base.mapInArrow(anchor_rows(span, gram), ANCHORS)
    # Written, so that the join below reads both sides from a shuffle and a frequent anchor's rows can be split.
    shared = cut_lineage(rows.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    met = cut_lineage(rows.join(shared, "anchor"))
    order = F.struct("doc_id", "row_key", "place")
    sets = cut_lineage(met.groupBy("anchor", "around").agg(F.count("*").alias("n"), F.min(order).alias("least")))
    kinds = sets.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed = cut_lineage(sets.join(kinds, "anchor").select("anchor", "around", "least", (F.col("kinds") > LIGHT).alias("heavy")))

    def texts_of(chosen: DataFrame) -> DataFrame:
        asked = chosen.groupBy(F.col("least.doc_id").alias("id"), F.col("least.row_key").alias("key")).agg(
            F.collect_list(F.struct("anchor", "around", "least.place")).alias("asked"))
        found = base.join(asked, (F.col("row_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("doc_id", "row_key", "text", "asked")
        return found.mapInArrow(surroundings(span), NAMED)

    near = texts_of(mixed.where("not heavy")).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sorter(span, gram), RANGES)
    if not mixed.where("heavy").isEmpty():
        near = near.union(dealt_windows(texts_of(mixed.where("heavy")), span))
    near = near.where("earlier" if keep_first else "not earlier").select("anchor", "around", "first", "last")
    # Surroundings found elsewhere repeat whole; of the others, and of a first one, what was found in them.
    told = met.join(sets, ["anchor", "around"])
    whole = ~order.eqNullSafe(F.col("least")) if keep_first else F.col("n") > 1
    at, low, high = at_of(F.col("place")), F.shiftright("place", 16).bitwiseAND(0xFFFF), F.col("place").bitwiseAND(0xFFFF)
    settled = told.where(whole).select("doc_id", "row_key", (at - low).alias("low"), (at - high).alias("high"))
    partly = told.where(~whole).select("anchor", "around", "doc_id", "row_key", at.alias("at")).join(near, ["anchor", "around"])
    partly = partly.select("doc_id", "row_key", (F.col("at") + F.col("first")).alias("low"), (F.col("at") + F.col("last")).alias("high"))
    return settled.union(partly).groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))


def cutter(span: int, with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, found in zip(batch["text"].to_pylist(), batch["ranges"].to_pylist()):
                data = text.encode()
                spans, kept = [], data
                if found:
                    depth = np.zeros(len(data) + 1, np.int32)
                    np.add.at(depth, [r["low"] for r in found], 1)
                    np.add.at(depth, [r["high"] + span for r in found], -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    spans = runs_of(gone)
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                for column, value in zip(out, (len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(value)
            columns = [batch["doc_id"], *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                columns, names = [*columns, pa.array(out[4], pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM, keep_first: bool = True, with_bytes: bool = True
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_sha256`` and, if asked for, ``kept``, the bytes that stay.

    A byte goes if a string of ``span`` bytes that covers it also starts earlier in the corpus, in order of
    doc_id and then of place; without ``keep_first`` if it also starts anywhere else. Strings are those of the
    input and never cross documents. Null texts are empty; shorter texts than ``span`` stay as they are.
    Rows of equal id and text are different documents without ``keep_first``; with it nothing tells them
    apart, so they stay together.
    """
    base = corpus(docs, doc_id, text).withColumn("row_key", row_key())
    found = ranges(base, span, gram, keep_first).select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), "ranges")
    rows = base.join(found, (F.col("row_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id")), "left").select("doc_id", "text", "ranges")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")
    return rows.mapInArrow(cutter(span, with_bytes), schema)
