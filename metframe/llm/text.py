"""Rows of a corpus, and numpy helpers over the bytes of one text."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metframe.session import cut_lineage

SMALL_BYTES = 32 << 20  # the most that is ever broadcast
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS = {}


class Sent:
    """A value for the workers. It travels with the code of its classes, so workers need no copy of the package;
    a plain broadcast would look the classes up there by name."""

    def __init__(self, spark: SparkSession, value: object):
        self.data, self.loaded = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self) -> dict:
        return {"data": self.data, "loaded": None}

    @property
    def value(self) -> object:
        if self.loaded is None:
            self.loaded = cloudpickle.loads(self.data.value)
        return self.loaded

    def unpersist(self) -> None:
        self.data.unpersist()


def corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, a null text as an empty one. Other columns of any name are left out."""
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )


def row_key(doc_id: str | Column = "doc_id", text: str | Column = "text") -> Column:
    """A 64-bit key of a row. Ids may be null or repeated, so an id alone does not name a row; rows with
    equal id and text share all that is found about them."""
    return F.xxhash64(doc_id, text)


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return (left["row_key"] == right["row_key"]) & left["doc_id"].eqNullSafe(right["doc_id"])


def small(df: DataFrame, row_bytes: int | Column, bound: int = SMALL_BYTES) -> DataFrame:
    """A written table, marked for broadcast if its bytes, counted first, are within the bound; a larger one
    is left to a shuffle join."""
    row_bytes = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    return F.broadcast(df) if (df.agg(F.sum(row_bytes)).first()[0] or 0) <= bound else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns, and the row key under a name of its own."""
    return docs.withColumn(name, row_key(F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))))


def meets(docs: DataFrame, key: str, found: DataFrame, doc_id: str = "doc_id") -> Column:
    """Rows of (doc_id, row_key) tables that belong to a keyed table's rows."""
    return (docs[f"`{key}`"] == found["row_key"]) & docs[f"`{doc_id}`"].eqNullSafe(found["doc_id"])


def without(docs: DataFrame, gone: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents but those that ``gone`` names by (doc_id, row_key), with all their columns."""
    names, key = small(cut_lineage(gone.select("doc_id", "row_key").distinct()), 64), fresh(docs, "row_key")
    whole = keyed(docs, key, doc_id, text)
    return whole.join(names, meets(whole, key, names, doc_id), "left_anti").drop(key)


def pieces_of(batches: Iterator[pa.RecordBatch], size: int = 2 << 20, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, at least a row each. What is held of the
    rows before is given back after each batch, as workers stay for later stages."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        ends = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1 + col.offset)[col.offset:] if len(col) and pa.types.is_string(col.type) else None
        if ends is None:
            yield batch
            continue
        start = 0
        while start < len(col):
            stop = int(np.searchsorted(ends, int(ends[start]) + size, side="right")) - 1
            stop = min(max(stop, start + 1), len(col))
            yield batch.slice(start, stop - start)
            start = stop
        del batch, col, ends
        give_back()
    give_back()


def give_back() -> None:
    """Return the free memory of Arrow and of the C library, which keeps that of arrays else, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    have = _POWERS.get("n", 0)
    if have < n:
        size = max(n, 1 << 16, have * 2)
        for name, base in (("up", BASE), ("down", _inverse(BASE))):
            table = np.full(size, base, U64)
            table[0] = 1
            _POWERS[name] = np.multiply.accumulate(table)
        _POWERS["n"] = size
    return _POWERS["up"][:n], _POWERS["down"][:n]


def byte_codes(seed: int = 1) -> np.ndarray:
    """A 64-bit number for every byte."""
    return mix(np.arange(1, 257, dtype=U64) * U64(BASE) + U64(seed))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def prefix_sums(data: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 from which ``span_hashes`` gets the hash of any span."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(codes[data] * powers(len(data) + 1)[0][:-1], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of each span; equal bytes have equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts] + (ends - starts).astype(U64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of every run of bytes other than blanks; ``offsets`` tells where texts begin."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (edge[:-1] | ~np.concatenate([[False], solid])[:-1]))
    ends = np.flatnonzero(solid & (edge[1:] | ~np.concatenate([solid, [False]])[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def plain_words(text: str) -> bytes:
    """Lower-cased words with one blank between them."""
    return " ".join(text.lower().split()).encode()


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """A hash for every run of ``size`` words, in order of the text; of a shorter text, one for all its words."""
    data = np.frombuffer(plain_words(text), np.uint8)
    if not len(data):
        return np.empty(0, U64)
    gaps = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(data)]])
    size = min(size, len(starts))
    return span_hashes(prefix_sums(data, byte_codes()), starts[: len(starts) - size + 1], ends[size - 1:])
