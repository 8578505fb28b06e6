"""Benchmark decontamination: test items that stand inside documents, however long these are.

Only DataFrame functions. Items are partitioned by size; each keeps as MinHash sketch the smallest hashes
of its shingles, just so many that a document with the required share of the item's shingles cannot miss
them all. Documents with a sketch hash are candidates, which exact shingle containment then decides on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from metframe.llm.text import corpus, row_key, small
from metframe.session import cut_lineage

WORDS = 5
CONTAINMENT = 0.8
BLANKS = "[ \\t\\n\\x0B\\f\\r]+"


def words_of(text: str | Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BLANKS), "")


def places(words: Column, size: int) -> Column:
    """The places, from 1 on, where a shingle begins; none if there are too few words."""
    n = F.size(words) - (size - 1)
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words: Column, size: int) -> Column:
    return F.transform(places(words, size), lambda i: F.xxhash64(F.slice(words, i, size)))


def shingle_texts(words: Column, size: int) -> Column:
    return F.transform(places(words, size), lambda i: F.array_join(F.slice(words, i, size), " "))


def item_shingles(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(item_id, shingle, n_shingles) of every distinct shingle of every item. Items of one id are one item."""
    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).dropna(subset=["item_id"])
    each = rows.select("item_id", F.explode(shingle_texts(words_of("text"), size)).alias("shingle")).distinct()
    sizes = each.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    return each.join(sizes, "item_id")


def sketches(shingles: DataFrame, containment: float) -> DataFrame:
    """(item_id, hash): the smallest hashes of each item, as many as its size class asks for."""
    # Class c holds items of 2^c up to 2^(c+1) - 1 shingles; a document may lack (1 - containment) of the most.
    top = F.pow(F.lit(2.0), F.floor(F.log2("n_shingles")) + 1) - 1
    wanted = F.floor(top * (1 - containment) + 1e-9) + 1
    hashed = shingles.withColumn("hash", F.xxhash64(F.split("shingle", " ")))
    order = Window.partitionBy("item_id").orderBy(F.xxhash64("hash", F.lit(1)), "shingle")
    return hashed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted).select("item_id", "hash").distinct()


def contained(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", words: int = WORDS, containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per document and item it holds: ``doc_id``, ``row_key``, ``item_id``, ``n_shingles`` (distinct, of
    the item), ``n_found`` (of them in the document) and ``containment``, at least the one asked for.

    Whole texts are searched. Items under ``words`` words have no shingle and are never found, nor are null
    items or items with a null id. Null texts are empty. Rows of equal id and text give one row.
    """
    shingles = cut_lineage(item_shingles(items, item_id, item_text, words))
    sketch = cut_lineage(sketches(shingles, containment))
    base = corpus(docs, doc_id, text).withColumn("row_key", row_key())
    split = base.select("doc_id", "row_key", words_of("text").alias("words"))
    hashes = split.select("doc_id", "row_key", F.explode(shingle_hashes(F.col("words"), words)).alias("hash"))
    found = hashes.join(small(sketch, 32), "hash").select("doc_id", "row_key", "item_id").distinct()
    candidates = cut_lineage(found)
    named = small(candidates.select(F.col("doc_id").alias("id"), F.col("row_key").alias("key")).distinct(), 48)
    # Exact: the distinct shingles of a candidate document that are shingles of the item, as texts.
    again = split.join(named, (F.col("row_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    texts = again.select("doc_id", "row_key", F.explode(shingle_texts(F.col("words"), words)).alias("shingle"))
    shared = texts.join(small(shingles, 160), "shingle").select("doc_id", "row_key", "item_id", "n_shingles", "shingle").distinct()
    counts = shared.groupBy("doc_id", "row_key", "item_id", "n_shingles").agg(F.count("*").alias("n_found"))
    pairs = candidates.select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), F.col("item_id").alias("item"))
    kept = counts.join(
        pairs, (F.col("row_key") == F.col("key")) & (F.col("item_id") == F.col("item")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_semi"
    )
    share = F.col("n_found") / F.col("n_shingles")
    return kept.where(share >= containment).select("doc_id", "row_key", "item_id", "n_shingles", "n_found", share.alias("containment"))
