"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Every word that was counted has a learned class, and there are the more classes the more words there are.
The most frequent words are classes of their own; the others are clustered by the words they stand between.
The model predicts the class of a token from those of the two tokens before it; which word of its class it
is follows from how often it was seen. Class trigrams stay a table, and each pass of the training adds its
gradients over the partitions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from metframe.llm.text import Sent, byte_codes, corpus, pieces_of, prefix_sums, span_hashes, word_spans
from metframe.session import cut_lineage, scratch_path

CLASSES = 192  # at least, with the end and the unseen
GROWTH = 5  # classes for each unit of the cube root of the number of words, so that the tables of the model stay small
FREQUENT = 200_000  # words whose counts and classes are sent to every task, at most; those of the rest are joined
WIDTH = 32
SIDE = 12  # numbers that tell a word's neighbours on either side
CLUSTERING = 6  # passes
NOISE = 10.0  # noise tokens for each true one
EPOCHS = 8
LOTS = 12  # passes of an epoch, each over its share of the contexts
RATE = 0.05
PIECE = 2 << 20
BITS = 21  # of a sum, three of which share a number
HELD = (1 << BITS) - 1  # tokens that a task gathers before it passes on their sums, at most
TOKENS = 1 << 20  # of coded texts that a task looks at together, about
BLOCK = 1 << 16  # words in a row of the table that is clustered
SLICE = 1 << 13  # words compared with all centres together
CONTEXTS = 1 << 14  # of a lot in one task, about
END_HASH = np.uint64(1)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LOG10 = math.log(10.0)


def class_number(words: int) -> tuple[int, int]:
    """(classes, words that are one of their own) for so many words."""
    n = max(CLASSES, int(GROWTH * words ** (1 / 3)))
    return n, words if words <= n - 2 else (n - 2) // 2


def tokens_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, an end after each, and the number of tokens of each text. Words are
    runs of bytes between blanks, A-Z in lower case."""
    data = [t.encode().translate(LOWER) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    joined = np.frombuffer(b"".join(data), np.uint8)
    starts, ends, doc = word_spans(joined, offsets)
    sizes = np.bincount(doc, minlength=len(texts)) + 1
    out = np.full(len(starts) + len(texts), END_HASH)
    hashes = span_hashes(prefix_sums(joined, byte_codes(3)), starts, ends)
    out[np.arange(len(starts)) + doc] = np.where(hashes == END_HASH, np.uint64(2), hashes)
    return out, sizes


def word_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each token stands in the texts of a task."""
    words, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for batch in pieces_of(batches, PIECE):
        fresh, n = np.unique(tokens_of(batch["text"].to_pylist())[0], return_counts=True)
        both, at = np.unique(np.concatenate([words, fresh]), return_inverse=True)
        words, counts = both, np.bincount(at, np.concatenate([counts, n])).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])


def look_up(hashes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each hash among sorted keys, -1 if it is none."""
    if not len(keys):
        return np.full(len(hashes), -1)
    distinct, at = np.unique(hashes, return_inverse=True)
    place = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
    return np.where(keys[place] == distinct, place, -1)[at]


class Classes:
    """Numbers of classes: 0 is the end, 1 any word that is not among these."""

    def __init__(self, words: np.ndarray, classes: np.ndarray | None = None):
        order = np.argsort(words.astype(np.uint64))
        self.words = words.astype(np.uint64)[order]
        self.classes = order + 2 if classes is None else classes[order]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        place = look_up(hashes, self.words)
        known = self.classes[place] if len(self.words) else 1
        return np.where(hashes == END_HASH, 0, np.where(place >= 0, known, 1))


def trigrams(classes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two classes before each token, ends standing before a text."""
    begins = np.cumsum(sizes) - sizes
    one, two = np.concatenate([[0], classes[:-1]]), np.concatenate([[0, 0], classes[:-2]])[: len(classes)]
    one[begins] = 0
    two[begins] = 0
    two[begins[sizes > 1] + 1] = 0
    return two, one


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, their first bytes in front of their second ones and so on, which packs small ones better."""
    return zstandard.ZstdCompressor(1).compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return planes.T.copy().view(kind).ravel()


def narrow(sums: np.ndarray, most: int) -> np.ndarray:
    """Columns of sums from 0 to ``most`` as rows of bytes: bits, halves of bytes, bytes, or whole numbers."""
    if most == 1:
        return np.packbits(sums.astype(np.uint8), axis=0).T
    if most <= 15:
        return (sums[::2] | sums[1::2] << 4).astype(np.uint8).T
    return sums.T.astype(np.uint8 if most <= 255 else np.int64, order="C").view(np.uint8)


def widened(rows: np.ndarray) -> np.ndarray:
    """The columns of sums that ``narrow`` made rows of, by the width of these."""
    columns, width = rows.T, rows.shape[1]
    if width == SIDE // 4:
        return np.unpackbits(columns, axis=0)
    if width == SIDE:
        return np.stack([columns & 15, columns >> 4], axis=1).reshape(2 * SIDE, -1)
    return columns if width == 2 * SIDE else np.ascontiguousarray(rows).view(np.int64).T


def neighbours(parts):
    """(word, n, ups) of the words without a class of their own: how often random signs of the classes on either
    side are positive, in as few bytes as n asks for."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, sides = parts.value
        # Three sums to a number, as no more than HELD are added.
        fields = np.where(sides > 0, 1, 0).reshape(2, -1, SIDE // 3, 3) @ (1 << BITS * np.arange(3))
        held, size = [], 0

        def told() -> Iterator[pa.RecordBatch]:
            hashes, left, right = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(hashes)
            hashes, near = hashes[order], (left[order], right[order])
            begins = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            words, n = hashes[begins].view(np.int64), np.diff(begins, append=len(hashes))
            sums = np.stack([np.add.reduceat(column[at], begins) for side, at in zip(fields, near) for column in side.T])
            least = 0
            for most in (1, 15, 255, HELD):
                at = np.flatnonzero((n > least) & (n <= most))
                least = most
                ups = sums[:, at]
                rows = narrow(np.stack([ups >> BITS * i & (1 << BITS) - 1 for i in range(3)], axis=1).reshape(2 * SIDE, -1), most)
                ends = np.arange(len(at) + 1, dtype=np.int32) * rows.shape[1]
                data = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(words[at]), pa.array(n[at]), data], names=["word", "n", "ups"])

        for batch in pieces_of(batches, PIECE):
            hashes, _ = tokens_of(batch["text"].to_pylist())
            own = classes.of(hashes).astype(np.int32)
            at = np.flatnonzero(own == 1)  # never the end, so the next token is of the same text
            for some in np.array_split(at, len(at) // HELD + 1):
                if size + len(some) > HELD:
                    yield from told()
                    size = 0
                held.append((hashes[some], np.where(some > 0, own[some - 1], 0), own[some + 1]))
                size += len(some)
        if size:
            yield from told()

    return gather


def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(words, n, signs) of many words in a row, packed: the sums of signs of each word, whose parts come one after
    the other."""

    def added(words: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        return words[begins], np.add.reduceat(sums, begins, axis=1)

    def told(words: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        signs = (2 * sums[1:] - sums[0]).astype(np.int32 if sums[0].max() < 1 << 31 else np.int64)
        columns = [packed(words), packed(sums[0]), packed(signs.ravel())]
        return pa.RecordBatch.from_arrays([pa.array([len(words)]), *(pa.array([c]) for c in columns)], names=["size", "words", "n", "signs"])

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        words, data = batch["word"].to_numpy(), batch["ups"]
        sums = np.empty((2 * SIDE + 1, len(words)), np.int64)
        sums[0] = batch["n"].to_numpy()
        ends = np.frombuffer(data.buffers()[1], np.int32, len(data) + 1 + data.offset)[data.offset:]
        flat, widths = np.frombuffer(data.buffers()[2], np.uint8), np.diff(ends)
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            sums[1:, at] = widened(flat[ends[at][:, None] + np.arange(width)])
        words, sums = added(words, sums)
        if held and held[-1][0][-1] == words[0]:
            held[-1][1][:, -1] += sums[:, 0]
            words, sums = words[1:], sums[:, 1:]
        if size > BLOCK and len(words):  # the last word before is complete
            yield told(np.concatenate([w for w, _ in held]), np.concatenate([s for _, s in held], axis=1))
            held, size = [], 0
        if len(words):
            held.append((words, sums))
            size += len(words)
    if held:
        yield told(np.concatenate([w for w, _ in held]), np.concatenate([s for _, s in held], axis=1))


WORDS = "size long, words binary, n binary, signs binary"


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words, how often each was seen, and its sums of signs, some thousands at a time."""
    for batch in batches:
        for row in range(batch.num_rows):
            size, words, n, signs = (batch[c][row].as_py() for c in ("size", "words", "n", "signs"))
            words, n = unpacked(words, np.int64), unpacked(n, np.int64)
            signs = unpacked(signs, np.int32 if n.max() < 1 << 31 else np.int64).reshape(2 * SIDE, size)
            for start in range(0, size, SLICE):
                part = slice(start, start + SLICE)
                yield words[part], n[part], signs[:, part].T


def directions(n: np.ndarray, signs: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """How the neighbours of each word differ from those of all, as unit vectors."""
    x = signs - n[:, None] * mean
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x.astype(np.float32) @ centres.T.astype(np.float32)).argmax(axis=1)


def all_and_most(clusters: int):
    """The sums over all words of a task, and the words seen most."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words, n, signs = np.zeros(2 * SIDE + 1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 2 * SIDE), np.int64)
        for more_words, more_n, more_signs in blocks(batches):
            total += np.concatenate([[more_n.sum()], more_signs.sum(axis=0, dtype=np.int64)])
            words, n, signs = (np.concatenate(x) for x in ((words, more_words), (n, more_n), (signs, more_signs)))
            first = np.lexsort((words, -n))[:clusters]
            words, n, signs = words[first], n[first], signs[first]
        rows = [None, *words.tolist()], [int(total[0]), *n.tolist()], [total[1:].tolist(), *signs.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.list_(pa.int64()))], names=["word", "n", "signs"])

    return tell


def cluster_sums(parts):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, centres = parts.value
        sums = np.zeros(centres.shape)
        for _, n, signs in blocks(batches):
            x = directions(n, signs, mean)
            at, n = nearest(x, centres), np.log1p(n)
            sums += np.stack([np.bincount(at, n * column, len(centres)) for column in x.T], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()])], names=["sums"])

    return add


def cluster_of(parts, first: int):
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, centres = parts.value
        for words, n, signs in blocks(batches):
            at = nearest(directions(n, signs, mean), centres) + first
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n), pa.array(at.astype(np.int32))], names=["word", "n", "class"])

    return tell


def clustered(training: DataFrame, own: Classes, clusters: int) -> DataFrame:
    """(word, n, class) of all words without a class of their own, by spherical k-means over the neighbours."""
    spark = training.sparkSession
    first = len(own.words) + 2
    rng = np.random.default_rng(3)
    sent = Sent(spark, (own, rng.choice([-1, 1], (2, first, SIDE))))
    met = training.mapInArrow(neighbours(sent), "word long, n long, ups binary")
    table = cut_lineage(met.repartition("word").sortWithinPartitions("word").mapInArrow(sums_of, WORDS))
    told = table.mapInArrow(all_and_most(clusters), "word long, n long, signs array<long>")
    total = np.sum([[r.n, *r.signs] for r in told.where("word is null").collect()] or [[0] * (2 * SIDE + 1)], axis=0)
    mean = total[1:] / max(1, total[0])
    start = told.where("word is not null").orderBy(F.desc("n"), "word").limit(clusters).collect()
    centres = directions(np.array([r.n for r in start], float), np.array([r.signs for r in start], float).reshape(-1, 2 * SIDE), mean)
    for _ in range(CLUSTERING if len(centres) else 0):
        parts = spark.sparkContext.broadcast((mean, centres))
        new = sum(np.frombuffer(r.sums).reshape(centres.shape) for r in table.mapInArrow(cluster_sums(parts), "sums binary").collect())
        size = np.linalg.norm(new, axis=1, keepdims=True)
        centres = np.where(size > 0, new / np.maximum(size, 1e-9), centres)
    parts = spark.sparkContext.broadcast((mean, centres))
    return cut_lineage(table.mapInArrow(cluster_of(parts, first), "word long, n long, class int"))


def lists_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some rows of coded texts at a time, their classes one after the other, and how many each has."""
    for whole in batches:
        ends, start = np.cumsum(whole["n_tokens"].to_numpy()), 0
        while start < whole.num_rows:
            before = ends[start - 1] if start else 0
            batch = whole.slice(start, max(1, int(np.searchsorted(ends, before + TOKENS)) - start))
            start += batch.num_rows
            lists = [unpacked(c, np.int32) for c in batch["classes"].to_pylist()]
            yield batch, np.concatenate(lists), np.array([len(x) for x in lists], np.int64)


def grams_packed(codes: np.ndarray, counts: np.ndarray) -> bytes:
    return packed(np.concatenate([np.diff(codes, prepend=0), counts]))


def grams_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes and their counts."""
    both = unpacked(data, np.int64)
    return np.cumsum(both[: len(both) // 2]), both[len(both) // 2:]


def gram_counter(n_classes: int, cells):
    """The class trigrams of coded texts and how often each occurs: (cell, grams), a row for each cell of contexts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell_of, held, size = cells.value, [], 0

        def told() -> pa.RecordBatch:
            codes, counts = np.unique(np.concatenate(held), return_counts=True)
            cell = cell_of[codes // n_classes]
            order = np.argsort(cell, kind="stable")
            codes, counts, cell = codes[order], counts[order], cell[order]
            begins = np.flatnonzero(np.diff(cell, prepend=-1))
            rows = [grams_packed(*x) for x in zip(np.split(codes, begins[1:]), np.split(counts, begins[1:]))]
            return pa.RecordBatch.from_arrays([pa.array(cell[begins]), pa.array(rows, pa.binary())], names=["cell", "grams"])

        for _, own, sizes in lists_of(batches):
            two, one = trigrams(own.astype(np.int64), sizes)
            held.append((two * n_classes + one) * n_classes + own)
            size += len(own)
            if size > HELD:
                yield told()
                held, size = [], 0
        if size:
            yield told()

    return count


def gram_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each cell; its parts come one after the other."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        return codes, np.bincount(where, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([grams_packed(*merged(held))], pa.binary())], names=["cell", "grams"])

    cell, held, size = None, [], 0
    for batch in batches:
        for row in range(batch.num_rows):
            if (own := batch["cell"][row].as_py()) != cell:
                if held:
                    yield told()
                cell, held, size = own, [], 0
            held.append(grams_of(batch["grams"][row].as_py()))
            size += len(held[-1][0])
            if size > HELD + len(held[0][0]):  # as much as is held already
                held = [merged(held)]
                size = len(held[0][0])
    if held:
        yield told()


class LogBilinear:
    """Score of a class after two others: the inner product of its vector and a weighted sum of theirs, plus a
    bias. After training the scores are normalised exactly, for every pair of classes before."""

    def __init__(self, classes: int, width: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.before = rng.normal(0, 0.1, (classes, width))
        self.after = rng.normal(0, 0.1, (classes, width))
        self.far, self.near = np.ones(width), np.ones(width)
        self.bias = np.zeros(classes)

    def parameters(self) -> list[np.ndarray]:
        return [self.before, self.after, self.far, self.near, self.bias]

    def gradient(self, codes: np.ndarray, counts: np.ndarray, unigram: np.ndarray, noise: float) -> list[np.ndarray]:
        """Sums over the counted trigrams, sorted by code, all those of a context among them. The expectation
        over the noise is taken exactly, context by context."""
        n = len(self.bias)
        context, word = codes // n, codes % n
        begin = np.flatnonzero(np.diff(context, prepend=-1))
        contexts, ends = context[begin], np.append(begin[1:], len(codes))
        shift = self.bias - np.log(noise * unigram)
        chance = (noise * unigram).astype(np.float32)
        after = self.after.astype(np.float32)
        out = [np.zeros_like(p) for p in self.parameters()]
        for lot in np.array_split(np.arange(len(contexts)), max(1, len(contexts) // 1024)):
            two, one = contexts[lot] // n, contexts[lot] % n
            hidden = self.far * self.before[two] + self.near * self.before[one]
            sure = hidden.astype(np.float32) @ after.T
            sure += shift.astype(np.float32)
            np.clip(sure, -30, 30, out=sure)
            np.negative(sure, out=sure)
            np.exp(sure, out=sure)
            sure += 1
            np.reciprocal(sure, out=sure)
            at = np.arange(begin[lot[0]], ends[lot[-1]]) if len(lot) else np.arange(0)
            place, seen = (np.repeat(np.arange(len(lot)), ends[lot] - begin[lot]), word[at]), counts[at].astype(np.float32)
            missed = seen * (1 - sure[place])
            own = np.bincount(place[0], seen, len(lot)).astype(np.float32)
            slope = sure
            slope *= chance
            slope *= own[:, None]
            slope[place] -= missed
            inner = slope @ after
            for side, weight in ((two, self.far), (one, self.near)):
                columns = side[:, None] * len(weight) + np.arange(len(weight))
                out[0] += np.bincount(columns.ravel(), (inner * weight).ravel(), out[0].size).reshape(out[0].shape)
            for total, more in zip(out[1:], [slope.T @ hidden.astype(np.float32), (inner * self.before[two]).sum(axis=0), (inner * self.before[one]).sum(axis=0), slope.sum(axis=0)]):
                total += more
        return out

    def learn(self, gradients: Sequence[Callable[[], list[np.ndarray]]], total: float, epochs: int, rate: float) -> "LogBilinear":
        """One step after each lot's gradient, all lots in each epoch."""
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        step = 0
        for epoch in range(epochs):
            pace = rate * (1 - epoch / epochs) + 1e-4
            for of_lot in gradients:
                step += 1
                for p, g, (first, second) in zip(self.parameters(), of_lot(), moments):
                    g = g * (len(gradients) / total)
                    first += 0.1 * (g - first)
                    second += 0.01 * (g * g - second)
                    p -= pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        return self

    def train(self, codes: np.ndarray, counts: np.ndarray, epochs: int, rate: float, noise: float) -> "LogBilinear":
        """Noise-contrastive estimation: tell the counted trigrams from ones whose last class is drawn from the
        unigram distribution. Here of trigrams in memory."""
        n = len(self.bias)
        unigram = unigram_of(np.bincount(codes % n, counts, n))
        self.bias = np.log(unigram)
        lot = np.random.default_rng(2).permutation(n * n)[codes // n] % max(1, len(np.unique(codes // n)) // 1024)
        parts = [lot == i for i in range(lot.max() + 1)]
        return self.learn([lambda i=i: self.gradient(codes[i], counts[i], unigram, noise) for i in parts], counts.sum(), epochs, rate)

    def norms(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        """The logarithms of the sums over all classes, for rows of ``far`` and all of ``near``."""
        out = np.empty((len(far), len(near)))
        for a in range(len(far)):
            scores = near + far[a]
            top = scores.max(axis=1, keepdims=True)
            out[a] = np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]
        return out

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        return (self.far * self.before) @ self.after.T, (self.near * self.before) @ self.after.T + self.bias

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(far, near, norm): log probability of w after a, b is far[a, w] + near[b, w] - norm[a, b]."""
        far, near = self.sides()
        return far, near, self.norms(far, near)


def unigram_of(counts: np.ndarray) -> np.ndarray:
    return (counts + 0.1) / (counts + 0.1).sum()


def fitted(coded: DataFrame, n_classes: int, class_counts: np.ndarray, epochs: int) -> LogBilinear:
    """The model trained on the trigrams of coded texts, whose counts are written by lots of contexts and read again in
    each pass, those of a cell of contexts in one row."""
    spark = coded.sparkSession
    model, unigram, total = LogBilinear(n_classes, WIDTH), unigram_of(class_counts), class_counts.sum()
    model.bias = np.log(unigram)
    parts = max(2, n_classes * n_classes // (LOTS * CONTEXTS))
    hashed = F.xxhash64("id")
    cell = F.pmod(hashed, F.lit(LOTS)) * parts + F.pmod(F.shiftright(hashed, 20), F.lit(parts))
    cells = spark.sparkContext.broadcast(spark.range(n_classes * n_classes).orderBy("id").select(cell.cast("int").alias("cell")).toArrow()["cell"].to_numpy())
    grams = coded.select("n_tokens", "classes").mapInArrow(gram_counter(n_classes, cells), "cell int, grams binary")
    path = scratch_path(spark, "grams")
    dealt = grams.repartition(LOTS * parts, "cell").sortWithinPartitions("cell").mapInArrow(gram_sums, "cell int, grams binary")
    dealt.withColumn("lot", F.expr(f"cast(cell div {parts} as int)")).write.partitionBy("lot").parquet(path)
    table = spark.read.schema("cell int, grams binary, lot int").parquet(path).select("lot", "grams") if total else None

    def of_lot(lot: int) -> list[np.ndarray]:
        sent = Sent(spark, (model, unigram))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, share = sent.value
            out = [np.zeros_like(p) for p in own.parameters()]
            for batch in batches:
                for data in batch["grams"]:
                    for sums, more in zip(out, own.gradient(*grams_of(data.as_py()), share, NOISE)):
                        sums += more
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in out], names=NAMES)

        rows = table.where(F.col("lot") == lot).select("grams").mapInArrow(add, ", ".join(f"{x} binary" for x in NAMES)).collect()
        sent.unpersist()
        return [sum((np.frombuffer(r[x]) for r in rows), np.zeros(p.size)).reshape(p.shape) for x, p in zip(NAMES, model.parameters())]

    lots = range(LOTS) if total else []
    return model.learn([lambda i=i: of_lot(i) for i in lots], total, epochs, RATE) if lots else model


NAMES = ["before", "after", "far", "near", "bias"]


def tables_of(spark, model: LogBilinear) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tables of the model, their sums made side by side."""
    far, near = model.sides()
    sent = Sent(spark, (model, far, near))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, a, b = sent.value
        for batch in batches:
            at = batch["id"].to_numpy()
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array([x.tobytes() for x in own.norms(a[at], b)])], names=["id", "norm"])

    rows = spark.range(0, len(far), 1, max(1, len(far) // 64)).mapInArrow(some, "id long, norm binary").collect()
    norm = np.empty_like(far)
    for r in rows:
        norm[r.id] = np.frombuffer(r.norm)
    return far, near, norm


def coder(parts, n_classes: int):
    """Of each text the classes of its tokens, packed, and its words that were not sent, each once. Such a word's tokens
    have the number of classes and its place among these."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, classes, inner = parts.value
        for batch in pieces_of(batches, PIECE):
            hashes, sizes = tokens_of(batch["text"].to_pylist())
            n = len(sizes)
            doc = np.repeat(np.arange(n), sizes)
            place = look_up(hashes, keys)
            hit = place >= 0
            at = place[hit]
            own = np.zeros(len(hashes), np.int32)
            own[hit] = classes[at]
            # The end is always told, also where nothing was counted.
            rare = np.flatnonzero(~hit & (hashes != END_HASH))
            rare = rare[np.lexsort((hashes[rare], doc[rare]))]
            word, of = hashes[rare], doc[rare]
            new = np.ones(len(rare), bool)
            new[1:] = (word[1:] != word[:-1]) | (of[1:] != of[:-1])
            ends = np.searchsorted(of[new], np.arange(n + 1))
            own[rare] = n_classes + np.cumsum(new) - 1 - ends[of]
            logs = np.bincount(doc[hit], np.log(counts[at] + 1.0), n)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            columns = [
                batch["doc_id"], pa.array(sizes.astype(np.int64)), pa.array(np.bincount(doc[hit], minlength=n)), pa.array(np.asarray(logs, np.float64)),
                pa.array(np.asarray(np.bincount(doc[hit], inner[at], n), np.float64)), pa.array([packed(own[s:e]) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary()),
                pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(word[new].view(np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_hit", "logs", "inner", "classes", "n_rare", "rare"])

    return code


CODED = "doc_id long, n_tokens long, n_hit long, logs double, inner double, classes binary, n_rare long, rare array<long>"
FILLED = "doc_id long, n_tokens long, n_known long, logs double, inner double, classes binary"


def filled(parts, n_classes: int):
    """The coded texts with the classes and sums of the joined words; words that were never seen have class 1."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, words = parts.value  # of each class
        for batch, own, sizes in lists_of(batches):
            rows = len(sizes)
            doc, n_rare = np.repeat(np.arange(rows), sizes), batch["n_rare"].to_numpy()
            begins = np.cumsum(n_rare) - n_rare
            found = batch["found"]
            of_row = np.repeat(np.arange(rows), [0 if x is None else x for x in pc.list_value_length(found).to_pylist()])
            at, n, classes = (found.flatten().field(c).to_numpy() for c in ("at", "n", "class"))
            place = begins[of_row] + at
            known = np.ones(n_rare.sum(), np.int32)
            known[place] = classes
            rare = np.flatnonzero(own >= n_classes)
            token = begins[doc[rare]] + own[rare] - n_classes
            own[rare] = known[token]
            times = np.bincount(token, minlength=len(known))[place]
            logs = np.log(n + 1.0)
            inner = logs - np.log(np.where(words[classes] > 1, tokens[classes] + words[classes], n + 1.0))
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], batch["n_tokens"], pa.array(batch["n_hit"].to_numpy() + np.bincount(of_row, times, rows).astype(np.int64)),
                *(pa.array(batch[c].to_numpy() + np.bincount(of_row, times * x, rows)) for c, x in (("logs", logs), ("inner", inner))),
                pa.array([packed(own[s:e]) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary()),
            ], names=[c.split()[0] for c in FILLED.split(", ")])

    return fill


def scorer(parts):
    """The log probability of each text's classes."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (far, near, norm), unseen = parts.value
        for batch, own, sizes in lists_of(batches):
            two, one = trigrams(own, sizes)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            logs = np.where(own == 1, math.log(unseen), far[two, own] + near[one, own] - norm[two, one] + math.log1p(-unseen))
            model = np.bincount(doc, logs, len(sizes))
            names = [c for c in batch.schema.names if c != "classes"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(model)], names=[*names, "model"])

    return score


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def scored(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT, epochs: int = EPOCHS
) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out`` (its crc32 modulo 7 is 2: nothing is learned from it),
    ``n_tokens`` (words and one end), ``n_known`` (tokens seen in training), ``train_tokens``,
    ``base_score`` (log10 of the add-one unigram probability) and ``score`` (log10 of the model's).

    A null or empty text is its end alone. Null ids are not held out; repeated rows are kept, each counted
    and scored. Counts cover all words; only how a count reaches a text depends on how frequent it is: the
    ``frequent`` most frequent words' are sent to every task, the others' are joined.
    """
    spark = docs.sparkSession
    base = corpus(docs, doc_id, text)
    training = base.where(~held_out()).select("text")
    counts = cut_lineage(training.mapInArrow(word_counter, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total, distinct = (x or 0 for x in counts.agg(F.sum("n"), F.count("*")).first())
    n_classes, n_own = class_number(max(0, distinct - 1))
    top = counts.where(F.col("word") != int(END_HASH)).orderBy(F.desc("n"), "word").limit(n_own).select("word").collect()
    own = Classes(np.array([r.word for r in top], np.int64).view(np.uint64))
    # Every counted word with its class.
    single = spark.createDataFrame([(int(END_HASH), 0), *((int(w), int(c)) for w, c in zip(own.words.view(np.int64), own.classes))], "word long, class int")
    words = counts.join(F.broadcast(single), "word")
    if n_own < distinct - 1:
        words = words.unionByName(clustered(training, own, n_classes - 2 - n_own))
    of_class = words.groupBy("class").agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).collect()
    class_counts, class_words = np.zeros(n_classes), np.zeros(n_classes)
    for r in of_class:
        class_counts[r["class"]], class_words[r["class"]] = r.tokens, r.words
    sizes = spark.createDataFrame(of_class, "class int, tokens long, words long")
    inner = F.log(F.col("n") + 1.0) - F.log(F.when(F.col("words") > 1, F.col("tokens") + F.col("words")).otherwise(F.col("n") + 1.0))
    words = cut_lineage(words.join(F.broadcast(sizes), "class").select("word", "n", "class", inner.alias("inner")))
    # The least count that a word must have for no more than so many words to have it.
    steps = counts.groupBy("n").agg(F.count("*").alias("words"))
    upto = F.sum("words").over(Window.orderBy(F.desc("n")))
    least = steps.withColumn("upto", upto).where(F.col("upto") <= frequent).agg(F.min("n")).first()[0]
    is_sent = F.col("class") < n_own + 2
    is_sent = is_sent if least is None else is_sent | (F.col("n") >= least)
    sent = words.where(is_sent).toPandas()
    sent = sent.iloc[np.argsort(sent["word"].to_numpy(np.int64).view(np.uint64))]
    parts = spark.sparkContext.broadcast((
        sent["word"].to_numpy(np.int64).view(np.uint64), sent["n"].to_numpy(np.int64), sent["class"].to_numpy(np.int32), sent["inner"].to_numpy(np.float64)))
    rows = cut_lineage(base.mapInArrow(coder(parts, n_classes), CODED).withColumn("row", F.monotonically_increasing_id()))
    # Infrequent words: none of them is in many rows, so no key of this join is hot.
    rest = words.where(~is_sent).select("word", "n", "class")
    met = rows.select("row", F.posexplode("rare").alias("at", "word")).join(rest, "word")
    more = met.groupBy("row").agg(F.collect_list(F.struct("at", "n", "class")).alias("found"))
    joined = rows.drop("rare").join(more, "row", "left").drop("row")
    of_classes = spark.sparkContext.broadcast((class_counts, class_words))
    coded = cut_lineage(joined.mapInArrow(filled(of_classes, n_classes), FILLED))
    base_norm = math.log(total + distinct + 1)
    model = fitted(coded.where(~held_out()), n_classes, class_counts, epochs)
    # Words never seen have the base's probability after any others; the classes that were seen share the rest.
    model.before[1], model.after[1], model.bias[1] = 0, 0, -1e9
    tables = spark.sparkContext.broadcast((tables_of(spark, model), 1 / (total + distinct + 1)))
    done = coded.mapInArrow(scorer(tables), "doc_id long, n_tokens long, n_known long, logs double, inner double, model double")
    return done.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        ((F.col("logs") - F.col("n_tokens") * base_norm) / LOG10).alias("base_score"), ((F.col("model") + F.col("inner")) / LOG10).alias("score"),
    )
