import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from metframe.llm import pii, quality
from tests.llm import test_decontaminate, test_jaccard_join, test_pii

SF = "/root/testdata/sf0.001"


def test_run_is_the_plain_stages(spark):
    tables = [spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels", "benchmark")]
    kept = {r.doc_id for r in quality.resampled(*tables[:2]).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in tables[0].collect() if r.doc_id in kept]
    classes = {i: c for i, _, c, _, _ in test_jaccard_join.brute(rows)}
    rows = [(i, t) for i, t in rows if classes[i] == i]
    leaks = {i for i, *_ in test_decontaminate.brute(rows, [tuple(r) for r in tables[2].select("item_id", "text").collect()])}
    rows = [(i, pii.mask(t, test_pii.joined(test_pii.plain(t)))) for i, t in rows if i not in leaks]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((i, hashlib.sha256(np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()) for i, t in rows)
    assert sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()) == want
    assert 0 < len(want) < len(kept)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.simpleString() == docs.schema.simpleString()
