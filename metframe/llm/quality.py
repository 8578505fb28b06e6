"""Quality by importance resampling: the ratio of two hashed n-gram models, one of target text and one of
the raw corpus, sampled by Gumbel top-k."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metframe.llm.text import byte_codes, corpus, pieces_of, prefix_sums, row_key, span_hashes, word_spans
from metframe.session import cut_lineage

BUCKETS = 1 << 14  # of byte trigrams
TARGET_ROWS = 20_000  # labelled good documents that the target model is learned from, at most
TEMPERATURE = 0.05  # of the sampling: log weights are divided by it before noise is added
PRIOR, SHRINK = 5.0, 0.4  # of the log ratios, see there
SPAN = 40.0  # log weights beyond +- this are one bin when the size of the sample is chosen
BINS = 1600
PIECE = 512 << 10  # bytes of text at once in a worker, whose arrays take many times as much
# Two more outcomes: whether a word repeats the one before it.
FEATURES = BUCKETS + 2


def text_bytes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the batch's texts, and where each text begins (and the last one ends)."""
    texts = [t.encode() for t in batch["text"].to_pylist()]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the trigram at each place, and whether it lies within one text."""
    if len(data) < 3:
        return np.empty(0, np.int64), np.empty(0, bool)
    wide = data.astype(np.uint32)
    codes = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    buckets = (codes * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    inside = np.ones(len(buckets), bool)
    for back in (1, 2):
        at = offsets[1:-1] - back
        inside[at[(at >= 0) & (at < len(inside))]] = False
    return buckets, inside


def repeats(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every word but a text's first, the text it is in and whether it repeats the word before."""
    starts, ends, doc = word_spans(data, offsets)
    hashes = span_hashes(prefix_sums(data, byte_codes()), starts, ends)
    return doc[1:][doc[1:] == doc[:-1]], (hashes[1:] == hashes[:-1])[doc[1:] == doc[:-1]]


def counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all features in the rows of a task: in all texts, and in target texts."""
    counts = np.zeros((2, FEATURES), np.int64)
    for batch in pieces_of(batches, PIECE):
        data, offsets = text_bytes(batch)
        if not len(data):
            continue
        target = np.array(batch["target"].to_pylist(), bool)
        buckets, inside = trigrams(data, offsets)
        of_target = np.repeat(target, np.diff(offsets))
        doc, same = repeats(data, offsets)
        for k, chosen in enumerate((inside, inside & of_target[: len(inside)])):
            counts[k, :BUCKETS] += np.bincount(buckets[chosen], minlength=BUCKETS)
        for k, chosen in enumerate((same, same[target[doc]])):
            counts[k, BUCKETS:] += np.bincount(chosen.astype(np.int64), minlength=2)
    some = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])], names=["feature", "raw", "target"])


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """log p(feature | target) - log p(feature | raw), shrunk towards 0.

    Both models get PRIOR counts in proportion to the raw text, and the first SHRINK of each ratio is
    taken off: ratios near 1 only tell by how much the languages of the labelled documents happen to be
    over- or under-represented, which over thousands of n-grams would outweigh everything else.
    """
    out = np.zeros(FEATURES)
    for part in (slice(0, BUCKETS), slice(BUCKETS, FEATURES)):
        raw, target = counts[0, part], counts[1, part]
        expected = raw * (target.sum() / max(1, raw.sum()))
        ratio = np.log((target + PRIOR) / (expected + PRIOR))
        out[part] = np.sign(ratio) * np.maximum(np.abs(ratio) - SHRINK, 0)
    return out


def scorer(ratios: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, PIECE):
            data, offsets = text_bytes(batch)
            weights, grams = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64)
            if len(data):
                buckets, inside = trigrams(data, offsets)
                doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(buckets)]
                weights += np.bincount(doc, np.where(inside, ratios[buckets], 0.0), len(weights))
                grams += np.bincount(doc[inside], minlength=len(weights))
                doc, same = repeats(data, offsets)
                weights += np.bincount(doc, ratios[BUCKETS + same.astype(np.int64)], len(weights))
                grams += np.bincount(doc, minlength=len(weights))
                weights /= np.sqrt(np.maximum(1, grams))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["row_key"], pa.array(grams), pa.array(weights, mask=grams == 0)],
                names=["doc_id", "row_key", "n_grams", "log_weight"],
            )

    return score


def kth_largest(df: DataFrame, name: str, k: int, bins: int = 1024, few: int = 4096) -> float:
    """The k-th largest value of a column without nulls, by ever narrower histograms."""
    low, high, n = df.agg(F.min(name), F.max(name), F.count("*")).first()
    above = 0  # values over the interval
    while True:
        inside, width = df.where(F.col(name).between(low, high)), (high - low) / bins
        if n <= few:
            return sorted((r[0] for r in inside.select(name).collect()), reverse=True)[k - above - 1]
        # An interval as narrow as this has at most some thousand different numbers.
        narrow = low + width == low
        place = F.col(name) if narrow else F.least(F.floor((F.col(name) - low) / width), F.lit(bins - 1))
        sizes = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high"))
        for row in sizes.sort(F.desc("bin")).collect():
            if above + row.n >= k:
                low, high, n = row.low, row.high, row.n
                break
            above += row.n
        if narrow:
            return high


def sample_size(scored: DataFrame, labels: DataFrame) -> int:
    """How many documents to draw: those whose weight is at least the cut that tells the labelled good from
    the labelled bad with the fewest mistakes, as shares of each class."""
    place = F.greatest(F.lit(0), F.least(F.lit(BINS), F.floor((F.col("log_weight") + SPAN) * (BINS / (2 * SPAN)))))
    weighed = scored.where("log_weight is not null").select("doc_id", place.cast("int").alias("bin"))
    sizes = weighed.groupBy("bin").count().collect()
    marked = weighed.join(labels, "doc_id").groupBy("bin", "good").count().collect()
    n, good, bad = np.zeros((3, BINS + 1))
    for bin_, count in sizes:
        n[bin_] = count
    for bin_, is_good, count in marked:
        (good if is_good else bad)[bin_] = count
    if not good.sum() or not bad.sum():
        return int(n.sum())
    lost, kept = np.cumsum(good) - good, np.cumsum(bad[::-1])[::-1]
    errors = lost / good.sum() + kept / bad.sum()
    return int(n[int(np.flatnonzero(errors == errors.min())[0]):].sum())


def resampled(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    target_rows: int = TARGET_ROWS, temperature: float = TEMPERATURE, seed: int = 7,
) -> DataFrame:
    """One row per document: ``doc_id``, ``row_key``, ``n_grams``, ``log_weight`` (log of the importance weight: how much
    likelier the text is as target than as raw text, over the square root of ``n_grams``, so that the chance
    part of it is as large for long texts as for short ones), ``sampled_by`` (weight by temperature plus Gumbel noise)
    and ``kept``, true for the k documents that come first by it.

    ``labels`` has ``doc_id`` and ``label`` (1 good, 0 bad). The target model is learned from at most
    ``target_rows`` good documents, chosen by a hash of their id; the raw model and all weights from whole
    texts of all documents; k from all labelled documents. Without good or bad labels all are kept. A text
    too short to have an n-gram has no weight and is not kept. Ties at the k-th place are all kept. Null
    ids have no label; repeated rows share their noise and so their fate.
    """
    spark = docs.sparkSession
    marks = labels.select(F.col("doc_id"), F.col(f"`{label}`").cast("int").alias("good")).dropna()
    marks = marks.groupBy("doc_id").agg(F.max("good").alias("good"))
    target = marks.where("good = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows).select("doc_id", F.lit(True).alias("target"))
    base = corpus(docs, doc_id, text)
    rows = base.join(F.broadcast(target), "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    found = rows.mapInArrow(counter, "feature long, raw long, target long").groupBy("feature").agg(F.sum("raw"), F.sum("target")).collect()
    counts = np.zeros((2, FEATURES), np.int64)
    for feature, raw, chosen in found:
        counts[:, feature] = raw, chosen
    ratios = log_ratios(counts) if counts[1].sum() else np.zeros(FEATURES)
    keyed = base.select("doc_id", row_key().alias("row_key"), "text")
    scored = keyed.mapInArrow(scorer(ratios), "doc_id long, row_key long, n_grams long, log_weight double")
    uniform = (F.shiftrightunsigned(F.xxhash64("row_key", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    scored = cut_lineage(scored.withColumn("sampled_by", F.col("log_weight") / temperature - F.log(-F.log(uniform))))
    k = sample_size(scored, marks)
    least = kth_largest(scored.where("sampled_by is not null"), "sampled_by", k) if k else math.inf
    return scored.withColumn("kept", F.coalesce(F.col("sampled_by") >= least, F.lit(False)))
