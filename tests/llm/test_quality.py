import math
import random

import numpy as np
import pyarrow as pa

from metframe.llm import quality

SF = "/root/testdata/sf0.01"


def test_features_are_those_of_a_plain_count():
    texts = ["ab ab cd", "", "é x x  x", "zz", "ab"]
    data, offsets = quality.text_bytes(pa.RecordBatch.from_pydict({"text": texts}))
    buckets, inside = quality.trigrams(data, offsets)
    places = [(i, t.encode()[i: i + 3]) for t in texts for i in range(max(0, len(t.encode()) - 2))]
    assert inside.sum() == len(places)
    one, two = quality.trigrams(np.frombuffer(b"b a", np.uint8), np.array([0, 3]))[0], buckets[1]
    assert one[0] == two
    doc, same = quality.repeats(data, offsets)
    assert [(d, bool(s)) for d, s in zip(doc, same)] == [(0, True), (0, False), (2, False), (2, True), (2, True)]


def test_kth_largest(spark):
    rng = random.Random(3)
    values = [rng.choice([rng.gauss(0, 1), 5.0, 1e9]) for _ in range(3000)] + [7.0] * 500
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 900, 1500, 2500, 3500):
        assert quality.kth_largest(df, "x", k, bins=7, few=20) == sorted(values, reverse=True)[k - 1]


def test_junk_goes_and_clean_text_stays(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.resampled(docs, labels).select("doc_id", "kept").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    counts = {(r.quality, r.kept): r["count"] for r in got}
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True]
    assert counts.get((0, True), 0) <= 0.1 * counts[0, False]


def test_held_out_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet".replace("0.01", "0.1")) for n in ("documents", "labels"))
    seen = quality.resampled(docs, labels.where("doc_id % 2 = 0")).select("doc_id", "kept")
    rows = seen.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.99


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(6, 1), (8, 0), (None, 1), (6, 1), (7, None)], "doc_id long, quality long")
    rows = quality.resampled(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all((r.log_weight is None) == (r.n_grams == 0) for r in rows)
    assert not any(r.kept for r in rows if r.doc_id in (1, 2))
    assert quality.resampled(empty, labels).count() == 0
    all_kept = quality.resampled(odd, labels.where("false")).collect()
    assert all(r.kept == (r.log_weight is not None) for r in all_kept)
    assert not any(math.isnan(r.log_weight) for r in all_kept if r.log_weight is not None)
