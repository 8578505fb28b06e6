"""Alignment of two tokenizers' tokens over the bytes of the same text.

Byte offsets at which tokens of both sides end are shared cuts. They are found by divide and conquer: take a
common end near the middle of an interval, looked up by bisection in the other side's ends, and go on in both
halves; an interval without a shared cut inside is a group. All intervals of a batch take each step together.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from metframe.llm.bpe import byte_letters
from metframe.llm.text import corpus, pieces_of
from metframe.session import cut_lineage

HELD = 1 << 20      # pairs a worker counts before it passes them on
SENT = 1 << 20      # most frequent pairs whose counts may go to every task, 16 bytes each
SLICE = 512         # rows whose pairs are looked at together
SEPARATORS = ",|;"  # after a token, after the first side's tokens of a group, after a group

# Fixed value: how the byte-level vocabulary splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 100_000  # characters of a text from which the slower library, which has no trouble with endless runs, encodes it

#: A side of the alignment: the token ids of texts, and the bytes of every token.
Side = tuple[Callable[[list[str]], list[np.ndarray]], list[bytes]]


def byte_level(file: bytes) -> Side:
    """A byte-level vocabulary; the texts are encoded after a blank, special tokens' strings as plain text.

    Where ids follow the order of the merges, they are ranks, by which a faster library gives the same ids.
    """
    tokenizer = Tokenizer.from_buffer(file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    byte_of = {letter: bytes([b]) for b, letter in enumerate(byte_letters())}
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    tokens = [b"".join(byte_of.get(c, c.encode()) for c in name) for name in names]

    def slow(text: str) -> np.ndarray:
        return np.array(tokenizer.encode(" " + text, add_special_tokens=False).ids, np.int64)

    model = json.loads(file)["model"]
    made = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if made != sorted(made) or len(set(made)) < len(made):
        return lambda texts: [slow(t) for t in texts], tokens
    special = {t["content"] for t in json.loads(file)["added_tokens"]}
    ranks = {tokens[i]: i for name, i in model["vocab"].items() if name not in special}
    ranked = tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [slow(t) if len(t) > LONG else ranked.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) for t in texts], tokens


def pieces(file: bytes) -> Side:
    """A piece vocabulary with byte fallback, which puts a blank before the text itself."""
    processor = sentencepiece.SentencePieceProcessor(model_proto=file)
    names = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    tokens = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace("▁", " ").encode() for n in names]
    return lambda texts: [np.array(ids, np.int64) for ids in processor.encode(texts, num_threads=1)], tokens


def ranges(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges, one after the other, and the range of each."""
    n = np.maximum(stops - starts, 0)
    own = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + starts[own], own


def near_middle(ends: np.ndarray, other: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each interval [low, high) of ``ends`` the place nearest to its middle whose value is in ``other``
    too, found by bisection there; -1 if there is none. The look goes outwards in widths that double."""
    middle, found, near, far = (low + high) // 2, np.full(len(low), -1), 0, 1
    left = np.arange(len(low))

    def shared(at: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = ends[at]
        hit = other[np.minimum(np.searchsorted(other, wanted), len(other) - 1)] == wanted
        return at[hit], own[hit]

    while len(left):
        lo, hi, mid = low[left], high[left], middle[left]
        before, a = shared(*ranges(np.maximum(lo, mid - far + 1), np.minimum(hi, mid - near + 1)))
        after, b = shared(*ranges(np.maximum(lo, mid + max(near, 1)), np.minimum(hi, mid + far)))
        down, up = np.full(len(left), -1), np.full(len(left), -1)
        down[a] = before  # the last of each interval stays
        up[b[::-1]] = after[::-1]  # the first
        best = np.where((down < 0) | (up >= 0) & (up - mid < mid - down), up, down)
        found[left] = best
        left = left[(best < 0) & ((mid - far >= lo) | (mid + far < hi))]
        near, far = far, far * 2
    return found


def shared_cuts(ends: np.ndarray, other: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places in ``ends`` whose value is in ``other`` too, in order. ``last`` has the last place of each text,
    which is shared as both sides cover the whole text. Intervals stay in the order of the text, so that neighbouring
    looks fall on neighbouring places."""
    low, high = np.concatenate([[0], last[:-1] + 1]), last
    cuts = [last]
    while len(low):
        inner = low < high
        low, high = low[inner], high[inner]
        at = near_middle(ends, other, low, high)
        cut = at >= 0
        low, high, at = low[cut], high[cut], at[cut]
        cuts.append(at)
        low, high = np.stack([low, at + 1], axis=1).ravel(), np.stack([at, high], axis=1).ravel()
    return np.sort(np.concatenate(cuts))


def numerals(size: int) -> np.ndarray:
    """Every id below ``size`` in decimal with each of the separators after it, as rows of bytes."""
    names = np.array([f"{i}{s}" for s in SEPARATORS for i in range(size)], "S")
    return names.view(np.uint8).reshape(len(SEPARATORS), size, -1)


def written(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, group_last: np.ndarray, table: np.ndarray) -> list[bytes]:
    """The groups of each text as ``a1,a2|b1;a3|b2,b3``. ``a_ends`` and ``b_ends`` have the place after the last
    token of each group, ``group_last`` the place after the last group of each text."""
    a_size, b_size = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    ids, mark = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int8)
    of_a = np.arange(len(a)) + np.repeat(b_ends - b_size, a_size)
    of_b = np.arange(len(b)) + np.repeat(a_ends, b_size)
    ids[of_a], ids[of_b] = a, b
    mark[of_a[a_ends - 1]], mark[of_b[b_ends - 1]] = 1, 2
    out = table[mark, ids]
    solid = out != 0
    stops = np.concatenate([[0], np.cumsum(solid.sum(1))])[(a_ends + b_ends)[group_last - 1]]
    flat, starts = out[solid].tobytes(), np.concatenate([[0], stops[:-1]])
    return [flat[s:e - 1] for s, e in zip(starts.tolist(), stops.tolist())]


def tokens_of(side: Side, texts: list[str], whole: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """The ids of each text, and whether their bytes are the whole text."""
    encode, tokens = side
    ids = encode(texts) if texts else []
    return ids, np.array([b"".join(map(tokens.__getitem__, i.tolist())) == w for i, w in zip(ids, whole)], bool)


def overlaps(ends: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of either side that overlap: between two neighbouring ends lies the overlap of one pair."""
    order = np.argsort(np.concatenate([ends, other]), kind="stable")
    marks, first = np.concatenate([ends, other])[order], order < len(ends)
    final = np.append(marks[1:] != marks[:-1], True)
    both = np.diff(np.flatnonzero(final), prepend=-1) == 2
    passed, at = np.cumsum(first)[final], np.flatnonzero(final)
    return passed - (first[final] | both), at + 1 - passed - (~first[final] | both)


def packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted pairs by their differences, and how often each occurs."""
    return zstandard.ZstdCompressor(1).compress(np.diff(pairs, prepend=0).tobytes() + times.astype(np.int32).tobytes())


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair and times of all pairs of a batch."""
    opened, sizes = zstandard.ZstdDecompressor(), batch["n_pairs"].to_numpy()
    data = [opened.decompress(p) for p in batch["pairs"].to_pylist()]
    if not data:
        return (np.empty(0, np.int64),) * 3
    pairs = [np.cumsum(np.frombuffer(d, np.int64, n)) for d, n in zip(data, sizes.tolist())]
    times = [np.frombuffer(d, np.int32, n, 8 * n) for d, n in zip(data, sizes.tolist())]
    return np.repeat(np.arange(len(data)), sizes), np.concatenate(pairs), np.concatenate(times).astype(np.int64)


class Aligner:
    """What a task does with a batch of texts."""

    def __init__(self, first: Side, second: Side, with_groups: bool):
        self.sides, self.with_groups = (first, second), with_groups
        self.lengths = [np.array([len(t) for t in tokens], np.int64) for _, tokens in self.sides]
        self.table = numerals(max(len(tokens) for _, tokens in self.sides))

    def rows(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch["text"].to_pylist()
        whole = [b" " + t.encode() for t in texts]
        n, some = len(texts), [i for i, t in enumerate(texts) if t]
        given, exact = zip(*(tokens_of(s, [texts[i] for i in some], [whole[i] for i in some]) for s in self.sides))
        fit = np.flatnonzero(exact[0] & exact[1])
        at = np.array(some, np.int64)[fit]
        counts = np.zeros((5, n), np.int64)  # tokens of both sides, groups, links, distinct pairs
        digests, groups, pairs = [""] * n, [""] * n, [packed(*np.empty((2, 0), np.int64))] * n
        if len(fit):
            sizes = [np.array([len(ids[i]) for i in fit]) for ids in given]
            a, b = (np.concatenate([ids[i] for i in fit]) for ids in given)
            ends = [np.cumsum(lengths[ids]) for lengths, ids in zip(self.lengths, (a, b))]
            last = [np.cumsum(size) - 1 for size in sizes]
            cuts = shared_cuts(*ends, last[0])
            group_last = np.searchsorted(cuts, last[0]) + 1
            for i, text in zip(at.tolist(), written(a, b, cuts + 1, np.searchsorted(ends[1], ends[0][cuts]) + 1, group_last, self.table)):
                digests[i], groups[i] = hashlib.sha256(text).hexdigest(), text.decode()
            of_a, of_b = overlaps(*ends)
            own = np.repeat(np.arange(len(at)), sizes[0])[of_a]
            width = len(self.lengths[1])
            space = len(self.lengths[0]) * width
            keys, times = np.unique(own * space + a[of_a] * width + b[of_b], return_counts=True)
            distinct = np.bincount(keys // space, minlength=len(at))
            stops = np.cumsum(distinct)
            for i, start, stop in zip(at.tolist(), (stops - distinct).tolist(), stops.tolist()):
                pairs[i] = packed(keys[start:stop] % space, times[start:stop])
            counts[:, at] = [*sizes, np.diff(group_last, prepend=0), np.bincount(own, minlength=len(at)), distinct]
        return pa.RecordBatch.from_arrays([
            batch["doc_id"], *map(pa.array, counts), pa.array(digests, pa.string()), pa.array(groups if self.with_groups else [None] * n, pa.string()),
            pa.array(pairs, pa.binary()),
        ], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_pairs", "groups_sha256", "groups", "pairs"])


ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_pairs long, groups_sha256 string, groups string, pairs binary"


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few hundred rows at a time, as each has the pairs of a whole text."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows hold each pair, added up as far as a worker may hold them."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

    held, size = [], 0
    for batch in slices(batches):
        held.append(np.unique(unpacked(batch)[1], return_counts=True))
        size += len(held[-1][0])
        if size > 4 * HELD:
            held = [merged(held)]
            size = len(held[0][0])
            if size > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["pair", "n"])
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(held)], names=["pair", "n"])


def frequent(counts: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` pairs reach with their count; 1 if all of them may be sent."""
    tally = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().orderBy(F.desc("power")).collect()
    cut, seen = 1 << (tally[0].power + 1) if tally else 1, 0
    for row in tally:
        seen += row["count"]
        if seen > most:
            return cut
        cut = 1 << row.power
    return 1


def aligned(
    docs: DataFrame, byte_file: str, piece_file: str, doc_id: str = "doc_id", text: str = "text", with_groups: bool = True, sent: int = SENT
) -> DataFrame:
    """One row per document: ``doc_id``, the tokens of both sides ``n_a`` and ``n_b``, ``n_groups``, ``n_links``
    (pairs of tokens that share bytes), ``n_best`` (links whose pair is in the most documents of all pairs with its first id),
    ``count_sum`` (documents of each link's pair, added up), ``groups_sha256`` and, if asked for, the ``groups``
    as ``a1,a2|b1;a3|b2,b3``.

    Texts that are null, empty or not given back exactly by both vocabularies have no tokens: zeros and an empty
    ``groups_sha256``. Every row counts as a document, repeated rows and null ids too; other columns do not matter.
    The counts of at most ``sent`` pairs, those in the most documents, go to every task; the others, none of them
    frequent, are joined.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast([open(f, "rb").read() for f in (byte_file, piece_file)])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_level(files.value[0]), pieces(files.value[1]), with_groups)
        for batch in pieces_of(batches):
            yield aligner.rows(batch)

    width = len(pieces(files.value[1])[1])
    rows = cut_lineage(corpus(docs, doc_id, text).mapInArrow(align, ROWS).withColumn("row", F.monotonically_increasing_id()))
    counts = rows.select("pairs", "n_pairs").mapInArrow(pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # The pairs of one first id are at most as many as the second vocabulary has tokens.
    most = F.max("n").over(Window.partitionBy(F.expr(f"pair div {width}")))
    counts = cut_lineage(counts.select("pair", "n", (F.col("n") == most).alias("best")))
    cut = frequent(counts, sent)
    known = counts.where(F.col("n") >= cut).toArrow().sort_by("pair")
    table = spark.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("pair", "n", "best")))

    def looked_up(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, pair and times of all pairs of a batch, whether each is known, and its place in the table."""
        keys, (own, pair, times) = table.value[0], unpacked(batch)
        place = np.searchsorted(keys, pair)
        hit = place < len(keys)
        hit[hit] = keys[place[hit]] == pair[hit]
        return own, pair, times, hit, place

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, n, best = table.value
        for batch in slices(batches):
            own, _, times, hit, place = looked_up(batch)
            own, times, place = own[hit], times[hit], place[hit]
            added = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for out, value in zip(added, (best[place], n[place])):
                np.add.at(out, own, times * value)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in KEPT), *map(pa.array, added)], names=[*KEPT, "n_best", "count_sum"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own, pair, times, hit, _ = looked_up(batch)
            yield pa.RecordBatch.from_arrays([pa.array(batch["row"].to_numpy()[own[~hit]]), pa.array(pair[~hit]), pa.array(times[~hit])], names=["row", "pair", "times"])

    out = rows.mapInArrow(sums, KEPT_ROWS)
    if cut > 1:
        rare = rows.select("row", "pairs", "n_pairs").mapInArrow(others, "row long, pair long, times long").join(counts, "pair").groupBy("row").agg(
            F.sum(F.col("times") * F.col("best").cast("int")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
        added = {c: F.col(c) + F.coalesce(F.col(m), F.lit(0)) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))}
        out = out.join(rare, "row", "left").withColumns(added).drop("more_best", "more_sum")
    return out.drop("row") if with_groups else out.drop("row", "groups")


KEPT = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]
KEPT_ROWS = "row long, " + ", ".join(c for c in ROWS.split(", ") if c.split()[0] in KEPT) + ", n_best long, count_sum long"
