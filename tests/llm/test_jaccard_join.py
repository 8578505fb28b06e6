import random

import numpy as np

from metframe.llm import jaccard_join


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = {i: [j for j in range(len(rows)) if j != i and sets[i] and sets[j]
                 and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(rows))}
    out = []
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids) if ids else None, sum(sets[i] == s for s in sets) if sets[i] else 1, len(links[i])))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in jaccard_join.near_classes(df).drop("row_key", "class").collect()), key=str)


def test_against_all_pairs(spark, documents):
    rng = random.Random(1)
    rows = list(documents)
    for i, (_, t) in enumerate(documents[:60]):
        words = t.split()
        for k in range(3):
            for _ in range(1 + len(words) // 60):
                words[rng.randrange(len(words))] = f"new{k}"
            rows.append((1000 + 3 * i + k, " ".join(words)))
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_blocks_do_not_matter(spark, documents, monkeypatch):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(i, base.replace("w50", f"z{i}")) for i in range(40)] + documents[:20]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard_join, "BLOCK", 500)
    assert result(df) == brute(rows)


def test_odd_rows(odd, empty):
    from tests.llm.conftest import ODD

    assert result(odd) == brute(ODD)
    assert result(empty) == []


def test_bands_meet_the_recall():
    bands, rows = jaccard_join.bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999


def test_minhash_estimates_similarity():
    grams = np.arange(1, 4001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    one, two = (jaccard_join.minhash(x, 512) for x in (grams[:3000], grams[1000:]))
    assert abs((one == two).mean() - 0.5) < 0.1


def test_one_of_each_class_stays(spark, documents, odd):
    rows = documents + [(None, documents[0][1]), (0, documents[0][1]), (0, documents[0][1])]
    kept = jaccard_join.one_of_each(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, `class` int")).collect()
    classes = {}
    for i, _, c, _, _ in brute(rows):
        classes.setdefault(c, []).append(i)
    assert len(kept) == len(classes)
    assert {r.doc_id for r in kept} == {i if 0 not in m else None for i, m in classes.items()}
    assert sorted(map(str, (r.doc_id for r in jaccard_join.one_of_each(odd).collect()))) == ["1", "2", "3", "4", "5", "7", "8", "None"]
