import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from metframe.llm import lm


def words_of(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def plain(rows):
    counts = Counter()
    for i, t in rows:
        if not is_held_out(i):
            counts.update([*words_of(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*words_of(t), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((str(i), is_held_out(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 5)))
    return sorted(out)


def told(rows):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)


@pytest.mark.parametrize("frequent", [1_000_000, 300, 0])
def test_documents(spark, documents, frequent):
    rows = lm.scored(spark.createDataFrame(documents, "doc_id long, text string"), frequent=frequent, epochs=20).collect()
    assert told(rows) == plain(documents)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    if frequent:
        out = [r for r in rows if r.held_out]
        assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_odd_rows(odd, empty):
    from tests.llm.conftest import ODD

    assert told(lm.scored(odd, epochs=2).collect()) == plain(ODD)
    assert lm.scored(empty, epochs=2).count() == 0


def test_model_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    true = rng.dirichlet(np.full(8, 0.3), (8, 8))
    counts = np.round(true * 2000).astype(np.int64).ravel()
    codes = np.flatnonzero(counts)
    model = lm.LogBilinear(8, 16).train(codes, counts[codes], 200, 0.05, 10.0)
    far, near, norm = model.tables()
    logp = far[:, None, :] + near[None, :, :] - norm[:, :, None]
    assert np.allclose(np.exp(logp).sum(axis=2), 1)
    unigram = counts.reshape(8, 8, 8).sum(axis=(0, 1)) / counts.sum()
    weight = counts.reshape(8, 8, 8)
    assert (weight * logp).sum() > (weight * np.log(unigram)).sum()


def test_class_contexts():
    two, one = lm.trigrams(np.array([5, 6, 0, 0, 7, 0]), np.array([3, 1, 2]))
    assert list(zip(two.tolist(), one.tolist())) == [(0, 0), (0, 5), (5, 6), (0, 0), (0, 0), (0, 7)]


def test_infrequent_words_are_scored_in_context(spark):
    rng = np.random.default_rng(5)
    fillers = " ".join(f"filler{i}" for i in range(200))
    rows = [(i, fillers) for i in range(100)]
    kinds = [[f"{k}{i}" for i in range(400)] for k in "ab"]
    rows += [(1000 + i, " ".join(w for pair in zip(*(rng.choice(k, 20) for k in kinds)) for w in pair)) for i in range(400)]
    one, two = (rng.choice(k, 20) for k in kinds)
    ids = [i for i in range(9000, 9100) if is_held_out(i)][:2]
    rows += [(ids[0], " ".join(w for pair in zip(one, two) for w in pair)), (ids[1], " ".join([*one, *two]))]
    got = {r.doc_id: r for r in lm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert abs(got[ids[0]].base_score - got[ids[1]].base_score) < 1e-6
    assert got[ids[0]].score > got[ids[1]].score + 5


def test_classes_grow_with_the_words():
    assert lm.class_number(100) == (lm.CLASSES, 100)
    assert lm.CLASSES < lm.class_number(369_033)[0] < lm.class_number(3_690_330)[0]


class Given:
    def __init__(self, value):
        self.value = value


def batches_of(texts, size=7):
    return (pa.RecordBatch.from_pydict({"text": texts[i:i + size]}) for i in range(0, len(texts), size))


@pytest.mark.parametrize("held", [lm.HELD, 500])
def test_sums_of_neighbours_are_exact_and_take_few_bytes(monkeypatch, held):
    monkeypatch.setattr(lm, "HELD", held)
    monkeypatch.setattr(lm, "BLOCK", 16)
    rng = np.random.default_rng(4)
    often = {"once": 1, "w15": 15, "w16": 16, "w255": 255, "w256": 256} | {f"r{i}": i % 4 + 1 for i in range(60)}
    words = rng.permutation([w for w, n in often.items() for _ in range(n)] + ["own", "two"] * 200).tolist()
    texts = [" ".join(words[i:i + 9]) for i in range(0, len(words), 9)] + ["", "once"]
    often["once"] += 1
    own = lm.Classes(lm.tokens_of(["own two"])[0][:2])
    sides = rng.choice([-1, 1], (2, 4, lm.SIDE))
    want = {}
    for text in texts:
        tokens = lm.tokens_of([text])[0]
        classes = np.concatenate([[0], own.of(tokens)])
        for i in np.flatnonzero(classes[1:] == 1):
            sums = want.setdefault(int(tokens[i].view(np.int64)), np.zeros(2 * lm.SIDE + 1, np.int64))
            sums += np.concatenate([[1], sides[0][classes[i]], sides[1][classes[i + 2]]])
    parts = pa.Table.from_batches(lm.neighbours(Given((own, sides)))(batches_of(texts)))
    least = dict(zip(parts["n"].to_pylist(), map(len, parts["ups"].to_pylist())))
    assert least[1] == 3 and max(n for n, size in least.items() if size <= 2 * lm.SIDE) > 15
    got = {}
    for w, n, signs in lm.blocks(lm.sums_of(iter(parts.sort_by("word").to_batches(10)))):
        assert not set(w.tolist()) & set(got)
        got |= {int(a): [int(b), *c.tolist()] for a, b, c in zip(w, n, signs)}
    assert got == {w: sums.tolist() for w, sums in want.items()}
    assert sorted(x[0] for x in got.values()) == sorted(often.values())


def test_grams_are_counted_in_one_row_a_cell(monkeypatch):
    monkeypatch.setattr(lm, "HELD", 300)
    monkeypatch.setattr(lm, "TOKENS", 50)
    rng = np.random.default_rng(6)
    lists = [rng.integers(0, 9, rng.integers(1, 40)).astype(np.int32) for _ in range(200)]
    rows = pa.RecordBatch.from_pydict({"n_tokens": [len(x) for x in lists], "classes": [lm.packed(x) for x in lists]})
    cells = rng.integers(0, 5, 81).astype(np.int32)
    parts = [b for half in (rows.slice(0, 90), rows.slice(90)) for b in lm.gram_counter(9, Given(cells))(iter([half]))]
    out = pa.Table.from_batches(lm.gram_sums(iter(pa.Table.from_batches(parts).sort_by("cell").to_batches(4))))
    assert out["cell"].to_pylist() == sorted(set(cells.tolist()))
    want = Counter()
    for x in lists:
        own = [0, 0, *x.tolist()]
        want.update(zip(own, own[1:], own[2:]))
    got = {}
    for cell, data in zip(out["cell"].to_pylist(), out["grams"].to_pylist()):
        codes, counts = lm.grams_of(data)
        assert (np.diff(codes) > 0).all() and (cells[codes // 9] == cell).all()
        got |= {(c // 81, c // 9 % 9, c % 9): n for c, n in zip(codes.tolist(), counts.tolist())}
    assert got == want
