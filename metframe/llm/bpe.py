"""Byte-pair encoding with word ends, and its decoding.

Long unsplit text is encoded by tree concatenation: its halves are encoded side by side, then a window
around each join is encoded anew and widened until its first and last tokens are those of the two sides.
An encoding in which every two neighbours are the encoding of their own text is the encoding of the
whole, so agreement on both sides makes the result exact.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from metframe.llm.text import corpus, pieces_of

LEAF = 48  # symbols that are encoded in one go; longer words go through the tree
PIECE = 1 << 20  # bytes of text whose symbols a worker holds at once
WINDOW = 4  # tokens on either side of a join that the first window takes

# How the vocabulary splits words, and its white space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
LATIN, LATIN_SPLIT = r"[\t-\r -~\u00c0-\u024f]*", r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|(?:[^\s\w]|_)+"


@dataclass(frozen=True)
class Vocabulary:
    """What the workers need of a tokenizer file."""

    pieces: list[str]  # token texts by id
    first: np.ndarray  # ids of the 256 bytes inside a word
    last: np.ndarray  # ids of the 256 bytes at the end of a word
    specials: dict[str, int]
    slots: np.ndarray  # open-addressing table of merge keys
    ranks: np.ndarray
    merged: np.ndarray
    bits: int
    widths: np.ndarray  # letters of each token, the end-of-word mark not counted


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabularies of this kind: printable Latin-1
    bytes are their own letters, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}
    return [rest.get(b, chr(b)) for b in range(256)]


def spread(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def read_vocabulary(path: str) -> Vocabulary:
    """From a file of the tokenizers library with a BPE model and an end-of-word suffix."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, end = told["model"], told["model"]["end_of_word_suffix"]
    vocab, letters = model["vocab"], byte_letters()
    specials = {t["content"]: t["id"] for t in told["added_tokens"]}
    pieces = [""] * (max([*vocab.values(), *specials.values()]) + 1)
    for text, i in [*vocab.items(), *specials.items()]:
        pieces[i] = text
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    bits = max(4, (4 * len(merges)).bit_length())
    slots, ranks, merged = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
    keys = np.array([(vocab[a] + 1) << 32 | vocab[b] for a, b in merges], np.uint64)
    for rank, (slot, key) in enumerate(zip(spread(keys, bits).tolist(), keys.tolist())):
        while slots[slot] and slots[slot] != key:
            slot = (slot + 1) & ((1 << bits) - 1)
        if not slots[slot]:
            slots[slot], ranks[slot], merged[slot] = key, rank, vocab["".join(merges[rank])]
    widths = np.array([len(p.removesuffix(end)) if len(p) > len(end) else len(p) for p in pieces], np.int64)
    return Vocabulary(
        pieces, np.array([vocab[c] for c in letters], np.int64), np.array([vocab[c + end] for c in letters], np.int64),
        specials, slots, ranks, merged, bits, widths,
    )


NONE = np.int64(1) << 40


def look_up(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank, merged token) of pairs; the rank is NONE where nothing merges them."""
    keys = ((left + 1).astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
    slot = spread(keys, v.bits)
    there = v.slots[slot]
    open_ = np.flatnonzero((there != keys) & (there != 0))
    while len(open_):
        slot[open_] = (slot[open_] + 1) & ((1 << v.bits) - 1)
        there[open_] = v.slots[slot[open_]]
        open_ = open_[(there[open_] != keys[open_]) & (there[open_] != 0)]
    hit = there == keys
    return np.where(hit, v.ranks[slot], NONE), v.merged[slot].astype(np.int64)


def encode_rows(v: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of many short symbol sequences, laid end to end, and how many each has.

    Every round merges, in each sequence, all places of its lowest-ranked pair, from the left. No merge
    makes a pair of a lower rank, so rounds are the same as merging place by place.
    """
    tokens, row = symbols.astype(np.int64), np.repeat(np.arange(len(lengths)), lengths)
    done_tokens, done_rows = [], []
    rank, to = pair_ranks(v, tokens, row)
    while len(tokens):
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        best = np.minimum.reduceat(rank, starts)
        spans = np.diff(np.append(starts, len(tokens)))
        whole = np.repeat(best, spans)
        live = whole < NONE
        if not live.all():
            done_tokens.append(tokens[~live])
            done_rows.append(row[~live])
            tokens, row, rank, to, whole = tokens[live], row[live], rank[live], to[live], whole[live]
            if not len(tokens):
                break
        hit = rank == whole
        # Of a run of overlapping places (a a a) every second one merges, counted from the left.
        at = np.flatnonzero(hit)
        begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        order = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
        at = at[order % 2 == 0]
        tokens[at] = to[at]
        keep = np.ones(len(tokens), bool)
        keep[at + 1] = False
        changed = np.zeros(len(tokens), bool)
        changed[at] = True
        changed[at[at > 0] - 1] = True
        tokens, row, rank, to, changed = tokens[keep], row[keep], rank[keep], to[keep], changed[keep]
        renew = np.flatnonzero(changed)
        nxt = np.minimum(renew + 1, len(tokens) - 1)
        rank[renew], to[renew] = look_up(v, tokens[renew], tokens[nxt])
        rank[renew[(nxt == renew) | (row[nxt] != row[renew])]] = NONE
    if not done_tokens:
        return np.empty(0, np.int64), np.zeros(len(lengths), np.int64)
    tokens, row = np.concatenate(done_tokens), np.concatenate(done_rows)
    order = np.argsort(row, kind="stable")
    return tokens[order], np.bincount(row, minlength=len(lengths))


def pair_ranks(v: Vocabulary, tokens: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rank, to = np.full(len(tokens), NONE), np.zeros(len(tokens), np.int64)
    if len(tokens) > 1:
        inside = np.flatnonzero(row[1:] == row[:-1])
        rank[inside], to[inside] = look_up(v, tokens[inside], tokens[inside + 1])
    return rank, to


def split_at(flat: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []


def encode_many(v: Vocabulary, rows: Sequence[np.ndarray]) -> list[np.ndarray]:
    lengths = np.array([len(r) for r in rows], np.int64)
    flat, counts = encode_rows(v, np.concatenate(rows) if len(rows) else np.empty(0, np.int64), lengths)
    return split_at(flat, counts)


def join_halves(v: Vocabulary, symbols: np.ndarray, halves: list[tuple[int, np.ndarray]]) -> list[tuple[int, np.ndarray]]:
    """Neighbouring (start, tokens) joined two by two."""
    widths = v.widths
    pairs = [(halves[i], halves[i + 1]) for i in range(0, len(halves) - 1, 2)]
    joined: list[tuple[int, np.ndarray] | None] = [None] * len(pairs)
    open_ = {i: WINDOW for i in range(len(pairs))}
    while open_:
        windows, cuts = [], []
        for i, k in open_.items():
            (start, a), (middle, b) = pairs[i]
            left, right = min(k, len(a)), min(k, len(b))
            windows.append(symbols[middle - int(widths[a[len(a) - left:]].sum()): middle + int(widths[b[:right]].sum())])
            cuts.append((i, left, right))
        for (i, left, right), got in zip(cuts, encode_many(v, windows)):
            (start, a), (_, b) = pairs[i]
            if (left == len(a) or got[0] == a[len(a) - left]) and (right == len(b) or got[-1] == b[right - 1]):
                joined[i] = (start, np.concatenate([a[: len(a) - left], got, b[right:]]))
                del open_[i]
            else:
                open_[i] *= 2
    return [*joined, *halves[len(pairs) * 2:]]


def encode_long(v: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """Tokens of one long symbol sequence by tree concatenation."""
    starts = list(range(0, len(symbols), LEAF))
    halves = list(zip(starts, encode_many(v, [symbols[i: i + LEAF] for i in starts])))
    while len(halves) > 1:
        halves = join_halves(v, symbols, halves)
    return halves[0][1]


def encode_words(v: Vocabulary, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of distinct words, laid end to end, and how many each has."""
    lengths = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    symbols = v.first[data]
    ends = np.cumsum(lengths)
    symbols[ends - 1] = v.last[data[ends - 1]]
    long = lengths > LEAF
    short_tokens, short_counts = encode_rows(v, symbols[np.repeat(~long, lengths)], lengths[~long])
    if not long.any():
        return short_tokens, short_counts
    counts = np.zeros(len(words), np.int64)
    counts[~long] = short_counts
    slow = {i: encode_long(v, symbols[ends[i] - lengths[i]: ends[i]]) for i in np.flatnonzero(long).tolist()}
    for i, tokens in slow.items():
        counts[i] = len(tokens)
    out = np.empty(counts.sum(), np.int64)
    is_long = np.repeat(long, counts)
    out[~is_long] = short_tokens
    out[is_long] = np.concatenate(list(slow.values()))
    return out, counts


def normal(text: str) -> str:
    """NFC, then each character in lower case by itself (a final sigma is no special case)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


SPLITTERS = {}  # a cache that workers get with the code; functools.cache would be looked up by the package's name


def splitters(specials: tuple[str, ...]):
    if specials not in SPLITTERS:
        marks = "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
        # The same split for texts of blanks, ASCII and accented Latin letters alone, by the faster engine.
        SPLITTERS[specials] = regex.compile(SPLIT), re.compile(LATIN_SPLIT), re.compile(LATIN), re.compile(f"({marks})") if marks else None
    return SPLITTERS[specials]


def words_of(v: Vocabulary, text: str) -> list[str | int]:
    """The words that are encoded each by itself. A special token, which is sought before any change of
    case, stands there as its id."""
    split, latin_split, latin, special = splitters(tuple(v.specials))

    def plain(part: str) -> list[str]:
        part = normal(part)
        return (latin_split if latin.fullmatch(part) else split).findall(part)

    if special is None or not any(s in text for s in v.specials):
        return plain(text)
    out = []
    for part in special.split(text):
        out += [v.specials[part]] if part in v.specials else plain(part)
    return out


def encode_distinct(v: Vocabulary, words: list[str | int]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of distinct words, laid end to end, and how many each has."""
    plain = np.array([isinstance(w, str) for w in words], bool)
    flat, counts = encode_words(v, [w.encode() for w in words if isinstance(w, str)])
    if plain.all():
        return flat, counts
    sizes = np.ones(len(words), np.int64)
    sizes[plain] = counts
    out = np.empty(sizes.sum(), np.int64)
    is_plain = np.repeat(plain, sizes)
    out[is_plain] = flat
    out[~is_plain] = [w for w in words if not isinstance(w, str)]
    return out, sizes


def encode_texts(v: Vocabulary, texts: Sequence[str]) -> tuple[list[np.ndarray], list[bytes]]:
    """Ids of each text, and its tokens joined by blanks. Each distinct word is encoded once."""
    number = defaultdict(itertools.count().__next__)
    split = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in (words_of(v, t) for t in texts)]
    if not number:
        return [np.empty(0, "<u4") for _ in texts], [b"" for _ in texts]
    flat, sizes = encode_distinct(v, list(number))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    names = [v.pieces[i] for i in flat.tolist()]
    named = [" ".join(names[i:j]).encode() for i, j in zip(begins.tolist(), ends.tolist())]
    flat = flat.astype("<u4")
    ids, decoded = [], []
    for own in split:
        n = sizes[own]
        upto = np.cumsum(n)
        ids.append(flat[np.repeat(begins[own] - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)])
        decoded.append(b" ".join([named[c] for c in own.tolist()]))
    return ids, decoded


def encoder(vocabulary: Vocabulary, with_ids: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, PIECE):
            ids, decoded = encode_texts(vocabulary, batch["text"].to_pylist())
            columns = [
                batch["doc_id"], pa.array([len(i) for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())), pa.array([d.decode() for d in decoded], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return encode


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encoded(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, digests of ids and decoded text and, if asked for,
    ``ids`` and ``decoded``. ``vocabulary`` is the path of a tokenizer file.

    A null or empty text has no tokens and decodes to an empty text. Each row is encoded for itself:
    null ids, repeated rows and other columns do not matter.
    """
    # As plain values, which a worker keeps for all its tasks.
    v = docs.sparkSession.sparkContext.broadcast(tuple(vars(read_vocabulary(vocabulary)).values()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoder(Vocabulary(*v.value), with_ids)(batches)

    return corpus(docs, doc_id, text).mapInArrow(encode, DIGESTS + (", ids array<int>, decoded string" if with_ids else ""))


def decode(ids: Sequence[int], vocabulary: Vocabulary) -> str:
    """The tokens' texts with a blank between them, special tokens included."""
    return " ".join(vocabulary.pieces[i] for i in ids)
