import random

import pytest

from metframe.llm.components import components


def classes(pairs):
    return sorted(sorted(x) for x in pairs)


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(300)], [(i + 1, i) for i in range(0, 90, 2)], [(0, i) for i in range(200)] + [(500, 501)],
    [(random.Random(i).randrange(120), random.Random(i + 999).randrange(120)) for i in range(90)], [(3, 3)], [],
])
def test_components(spark, edges):
    root = {n: n for e in edges for n in e}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        root[top(a)] = top(b)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    want, got = {}, {}
    for n in linked:
        want.setdefault(top(n), set()).add(n)
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    for r in rows:
        got.setdefault(r.root, set()).add(r.node)
    assert len(rows) == len(linked) and classes(got.values()) == classes(want.values())
    assert all(root in members for root, members in got.items())
