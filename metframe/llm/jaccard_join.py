"""Documents whose word n-grams agree to a Jaccard similarity of 0.8 or more: MinHash banding, verified
on full n-gram sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from metframe.llm.components import became, components
from metframe.llm.text import U64, corpus, fresh, keyed, meets, mix, pieces_of, row_key, same_row, shingle_hashes, small, without
from metframe.session import cut_lineage

WORDS = 5
SIMILARITY = (4, 5)  # 0.8 as a fraction, so that the test has no rounding
RECALL = 0.9999  # of a pair that is just similar enough
ROWS = 5  # of a band at least: fewer let too many unlike pairs through
BLOCK = 1 << 20  # n-grams that one side of a verification holds


def bands_for(similarity: float, recall: float, least_rows: int = ROWS) -> tuple[int, int]:
    """(bands, rows): the fewest hash functions with ``least_rows`` or more rows by which a pair of just
    that similarity shares a band with probability ``recall``."""
    choices = []
    for rows in range(least_rows, least_rows + 6):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        choices.append((bands * rows, bands, rows))
    return min(choices)[1:]


def minhash(shingles: np.ndarray, n: int, step: int = 2048) -> np.ndarray:
    """The least values of n hash functions over the shingles."""
    seeds = mix(np.arange(1, n + 1, dtype=U64))
    factors, shifts = (seeds >> U64(32)).astype(np.uint32) | np.uint32(1), seeds.astype(np.uint32)
    short = (shingles >> U64(16)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(short), step):
        hashed = factors[:, None] * short[None, i: i + step]
        hashed += shifts[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def band_hashes(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    grid = least.reshape(bands, rows).astype(U64)
    out = np.arange(1, bands + 1, dtype=U64)
    for k in range(rows):
        out = mix(out * U64(0x9E3779B97F4A7C15) + grid[:, k])
    return out.view(np.int64)


def sketcher(words: int, bands: int, rows: int):
    """Of every document the digest of its n-gram set, the size of the set and its band hashes."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            digests, sizes, marks = [], [], []
            for text in batch["text"].to_pylist():
                grams = np.unique(shingle_hashes(text, words))
                digests.append(xxhash.xxh3_128_hexdigest(grams.tobytes()) if len(grams) else None)
                sizes.append(len(grams))
                marks.append(band_hashes(minhash(grams, bands * rows), bands, rows) if len(grams) else [])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["row_key"], pa.array(digests, pa.string()), pa.array(sizes, pa.int64()),
                 pa.array(marks, pa.list_(pa.int64()))],
                names=["doc_id", "row_key", "set_id", "n_grams", "bands"],
            )

    return sketch


def set_reader(words: int):
    """The n-gram set of every document as bytes, beside the columns that name it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            # Repeated rows name one set many times; what is left of them goes in the verification.
            once = pd.Series(batch["set_id"].to_pylist()).drop_duplicates().index
            batch = batch.take(pa.array(once, pa.int64()))
            sets = [np.unique(shingle_hashes(t, words)).tobytes() for t in batch["text"].to_pylist()]
            names = ["set_id", "group", "copies", "blocks"]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(sets, pa.binary())], names=[*names, "grams"])

    return read


def verifier(similarity: tuple[int, int]):
    """For one pair of blocks: how many documents each set is linked to, and a spanning forest of the links."""

    def verify(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        _, first, second = key
        part = part.drop_duplicates("set_id").sort_values("set_id", ignore_index=True)
        sets = [np.frombuffer(g, U64) for g in part["grams"]]
        sizes = np.array([len(s) for s in sets])
        order = np.argsort(sizes, kind="stable")
        sets, sizes, part = [sets[i] for i in order], sizes[order], part.iloc[order].reset_index(drop=True)
        copies, block = part["copies"].to_numpy(), part["block"].to_numpy()
        ids, offsets = np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])
        codes = np.unique(ids, return_inverse=True)[1]
        marked = np.zeros(codes.max() + 1, np.int32)
        links, root = np.zeros(len(sets), np.int64), np.arange(len(sets))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        num, den = similarity
        for i in range(len(sets)):
            # Sets are in order of size, and only sets up to size / similarity can be similar.
            stop = int(np.searchsorted(sizes, sizes[i] * den // num, side="right"))
            if stop <= i + 1:
                continue
            own = codes[offsets[i]: offsets[i + 1]]
            marked[own] = 1
            span = codes[offsets[i + 1]: offsets[stop]]
            shared = np.add.reduceat(marked[span], offsets[i + 1: stop] - offsets[i + 1])
            marked[own] = 0
            ok = shared.astype(np.int64) * den >= (sizes[i] + sizes[i + 1: stop] - shared) * num
            if first != second:
                ok &= block[i + 1: stop] != block[i]
            near = np.flatnonzero(ok) + i + 1
            links[i] += copies[near].sum()
            links[near] += copies[i]
            for j in np.unique([top(j) for j in near]):
                root[max(j, top(i))] = min(j, top(i))
        names = part["set_id"].to_numpy()
        return pd.DataFrame({"a": names, "b": names[[top(i) for i in range(len(sets))]], "links": links})

    return verify


def similar_sets(named: DataFrame, sizes: DataFrame, docs: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """(a, b, links) for the sets of each group of candidates, verified block by block."""
    weights = sizes.groupBy("group").agg(F.sum("n_grams").alias("weight"))
    # A group goes to as many blocks as its n-grams fill, and each pair of blocks is a task of its own.
    members = sizes.join(weights, "group").select(
        "doc_id", "row_key", "set_id", "group", "copies", F.ceil(F.col("weight") / BLOCK).cast("int").alias("blocks")
    )
    rows = docs.withColumn("row_key", row_key())
    found = rows.join(members, same_row(rows, members)).select("set_id", "group", "copies", "blocks", "text")
    sets = found.mapInArrow(set_reader(words), "set_id string, group string, copies long, blocks int, grams binary")
    placed = sets.withColumn("block", F.pmod(F.xxhash64("set_id"), "blocks").cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")})
    return spread.select("set_id", "group", "copies", "grams", "block", "one", "two").groupBy("group", "one", "two").applyInPandas(
        verifier(similarity), "a string, b string, links long"
    )


def near_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
    similarity: tuple[int, int] = SIMILARITY, recall: float = RECALL,
) -> DataFrame:
    """One row per document: ``doc_id``, ``row_key``, ``n_grams`` (distinct), ``class`` (a key of all that
    chains of links lead to), ``class_id`` (the least doc_id there), ``n_copies`` (documents with the same n-grams, itself included) and ``n_links`` (other
    documents at the similarity or above, copies included).

    Documents with one n-gram set are one node, so copies never meet each other. Band hashes give
    candidate groups; every pair within such a group is then compared on its full sets, in blocks whose
    pairs never leave the task. So a pair is lost only if it shares no band and no chain of shared bands.
    A text under ``words`` words is one n-gram; a text without words has no links, its class is its own id.
    Null ids and repeated rows are kept, each in a row.
    """
    bands, rows = bands_for(similarity[0] / similarity[1], recall)
    base = corpus(docs, doc_id, text)
    sketched = cut_lineage(base.withColumn("row_key", row_key()).select("doc_id", "row_key", "text").mapInArrow(
        sketcher(words, bands, rows), "doc_id long, row_key long, set_id string, n_grams long, bands array<long>"
    ))
    # Any row of a set stands for it; struct order makes the choice the same in every run.
    nodes = cut_lineage(sketched.where("set_id is not null").groupBy("set_id").agg(
        F.min(F.struct("doc_id", "row_key")).alias("at"), F.min("doc_id").alias("least_id"), F.count("*").alias("copies"),
        F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"),
    ))
    marks = nodes.select("set_id", F.posexplode("bands").alias("band", "mark"))
    shared = marks.groupBy("band", "mark").agg(F.count("*").alias("n"), F.min("set_id").alias("a")).where("n > 1")
    # A set goes to the first of those that lead its bands; only the leaders are linked with each other.
    led = cut_lineage(marks.join(shared, ["band", "mark"]).groupBy("set_id").agg(F.collect_set("a").alias("leaders")))
    led = led.select("set_id", F.array_min("leaders").alias("group"), "leaders")
    leaders = components(led.select(F.col("group").alias("a"), F.explode("leaders").alias("b")))
    groups = became(led.drop("leaders"), leaders, "group")
    members = nodes.join(groups, "set_id").select(
        "at.doc_id", "at.row_key", "set_id", "n_grams", "copies", "group"
    )
    checked = cut_lineage(similar_sets(nodes, cut_lineage(members), base, words, similarity))
    links = checked.groupBy(F.col("a").alias("set_id")).agg(F.sum("links").alias("links"))
    classes = components(checked.select("a", "b")).select(F.col("node").alias("set_id"), "root")
    rooted = nodes.select("set_id", "least_id", "copies").join(classes, "set_id", "left").join(links, "set_id", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "set_id"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("class_id"))
    told = rooted.join(least, "root").select("set_id", "root", "class_id", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    return sketched.join(told, "set_id", "left").select(
        "doc_id", "row_key", "n_grams", F.coalesce("root", F.concat(F.lit("row "), F.col("row_key"))).alias("class"), F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"), F.coalesce("links", F.lit(0)).alias("n_links"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents but for near duplicates: of each class the row of the least id stays, with all its
    columns. Of rows with that id and equal text one stays. Texts without words are no duplicates."""
    rows = cut_lineage(near_classes(docs, doc_id, text, **options).where("n_grams > 0").groupBy("class", "doc_id", "row_key").agg(F.count("*").alias("same")))
    first = rows.groupBy("class").agg(F.min(F.struct("doc_id", "row_key")).alias("first"))
    placed = rows.join(first, "class").withColumn("stays", F.struct("doc_id", "row_key").eqNullSafe(F.col("first")))
    placed = cut_lineage(placed.select("doc_id", "row_key", "same", "stays"))
    left = without(docs, placed.where("not stays"), doc_id, text)
    # A row that stays may be there several times; only those rows are compared with each other.
    repeated = cut_lineage(placed.where("stays and same > 1").select("doc_id", "row_key"))
    if repeated.isEmpty():
        return left
    names, key = small(repeated, 64), fresh(docs, "row_key")
    whole = keyed(left, key, doc_id, text)
    met = meets(whole, key, names, doc_id)
    once = whole.join(names, met, "left_semi").dropDuplicates([key])
    return whole.join(names, met, "left_anti").unionByName(once).drop(key)
