"""What a worker of the quality model holds does not grow with the batch it gets."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from metframe.llm import quality


def batch():
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["one", "two", "three", "four"], 400)) for _ in range(2_000)]
    ids = pa.array(range(len(texts)))
    return pa.RecordBatch.from_arrays([ids, ids, pa.array(texts), pa.array([i % 3 == 0 for i in range(len(texts))])], names=["doc_id", "row_key", "text", "target"])


def ran(work, rows):
    tracemalloc.start()
    out = [b.to_pydict() for b in work(iter([rows]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return {name: [x for b in out for x in b[name]] for name in out[0]}, peak


@pytest.mark.parametrize("work", [quality.counter, quality.scorer(np.linspace(-1, 1, quality.FEATURES))])
def test_pieces(monkeypatch, work):
    rows = batch()
    small, held = ran(work, rows)
    monkeypatch.setattr(quality, "PIECE", 2 << 20)
    large, before = ran(work, rows)
    assert small == large
    assert held < 40_000_000 < before
