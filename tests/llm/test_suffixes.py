import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from metframe.llm import suffixes

SCHEMA = "doc_id long, text string"


def brute(rows, span=200, keep_first=False):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0], rows[i][1]))
    data = {i: (rows[i][1] or "").encode() for i in order}
    places = defaultdict(list)
    for i in order:
        for p in range(len(data[i]) - span + 1):
            places[data[i][p: p + span]].append((i, p))
    gone = {i: np.zeros(len(data[i]), bool) for i in order}
    for met in places.values():
        for i, p in met[1:] if keep_first else met if len(met) > 1 else []:
            gone[i][p: p + span] = True
    out = []
    for i in order:
        kept = bytes(b for b, g in zip(data[i], gone[i]) if not g)
        runs = int((np.diff(np.concatenate([[0], gone[i].astype(int)])) == 1).sum())
        out.append((rows[i][0], len(data[i]), int(gone[i].sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df, **options):
    return sorted((tuple(r) for r in suffixes.without_repeats(df, with_bytes=False, **options).collect()), key=str)


def planted(documents):
    rng = random.Random(5)
    rows = [(i, t) for i, t in documents if len(t) < 4000][:60]
    passage = documents[0][1][:700]
    for i in range(40):
        a = rng.randrange(300)
        rows.append((1000 + i, f"{rng.random()} " + passage[a: a + rng.randrange(150, 400)] + f" {rng.random()}" * rng.randrange(1, 9)))
    rows += [(2000, "ab" * 400), (2001, "x" * 900 + "y"), (2002, "é" * 150), (2003, passage[:199]), (2004, passage[100:300]), (2005, "same " * 100 + passage)]
    return rows


@pytest.mark.parametrize(("keep_first", "light", "chunk"), [(False, 8192, 1 << 20), (True, 8192, 300), (False, 3, 1 << 20), (True, 3, 1 << 20)])
def test_against_all_windows(spark, documents, monkeypatch, keep_first, light, chunk):
    rows = planted(documents)
    monkeypatch.setattr(suffixes, "LIGHT", light)
    monkeypatch.setattr(suffixes, "CHUNK", chunk)
    monkeypatch.setattr(suffixes, "FLUSH", 500)
    got = result(spark.createDataFrame(rows, SCHEMA), keep_first=keep_first)
    assert got == brute(rows, keep_first=keep_first)
    assert sum(r[2] for r in got) > 10_000


def test_odd_rows(odd, empty):
    from tests.llm.conftest import ODD

    assert result(odd, keep_first=False) == brute(ODD)
    assert result(empty, keep_first=False) == []


def test_repeated_rows_remove_each_other(spark):
    text = " ".join(str(i) for i in range(200))
    got = result(spark.createDataFrame([(1, text), (1, text), (None, text)], SCHEMA), keep_first=False)
    assert [r[2] for r in got] == [len(text)] * 3


def test_previous_factors():
    rng = random.Random(1)
    for _ in range(50):
        windows = np.array([[rng.choice(b"ab\0") for _ in range(3)] for _ in range(rng.randrange(1, 40))], np.uint8)
        position = np.array(rng.sample(range(100), len(windows)))
        earlier, any_ = suffixes.previous_factors(windows, position)
        rows = [tuple(w) for w in windows]
        assert [bool(x) for x in any_] == [rows.count(r) > 1 for r in rows]
        assert [bool(x) for x in earlier] == [any(s == r and q < p for s, q in zip(rows, position)) for r, p in zip(rows, position)]
