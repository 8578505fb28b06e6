import zlib

import numpy as np

from metframe.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.scored(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    out = [r for r in rows if r.held_out]
    hits = sum(r.predicted and r.toxic for r in out)
    assert hits >= 0.85 * sum(r.toxic for r in out)
    assert sum(r.predicted and not r.toxic for r in out) <= 0.005 * len(out)


def test_held_out_labels_do_not_matter(spark, documents):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    marks = [(i, int("idiot" in t or "scum" in t)) for i, t in documents]
    turned = [(i, y if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - y) for i, y in marks]
    one, two = (
        sorted(tuple(r) for r in toxicity.scored(docs, spark.createDataFrame(m, "doc_id long, toxic int")).collect()) for m in (marks, turned))
    assert one == two


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    rates = [(0.9, 0.05), (0.7, 0.1), (0.6, 0.3)]
    votes = np.array([np.where(truth, rng.random(4000) < a, rng.random(4000) < b) for a, b in rates]).T
    votes = np.column_stack([votes, votes[:, 2], votes[:, 2]])
    noisy = np.where(rng.random(4000) < 0.05, ~truth, truth).astype(int)
    model = toxicity.LabelModel(votes, noisy, 25)
    assert np.allclose(model.on[:3], [a for a, _ in rates], atol=0.06)
    assert np.allclose(model.off[:3], [b for _, b in rates], atol=0.06)
    assert model.share[:2].min() > 0.9 and model.share[2:].max() < 0.5
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.9


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(6, 1), (8, 0), (None, 1), (6, 1), (7, None)], "doc_id long, toxic long")
    rows = toxicity.scored(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.scored(empty, labels).count() == 0
    assert toxicity.scored(odd, labels.where("false")).count() == odd.count()
