import functools
import re

import pytest

from metframe.llm import decontaminate, text


def shingles(said):
    words = [w for w in re.split("[ \t\n\x0b\f\r]+", (said or "").lower()) if w]
    return {tuple(words[i: i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    out = set()
    for i, t in docs:
        own = shingles(t)
        for j, u in items:
            asked = shingles(u)
            if asked and j is not None and len(asked & own) / len(asked) >= 0.8:
                out.add((i, j, len(asked), len(asked & own)))
    return out


def result(docs, items):
    rows = decontaminate.contained(docs, items).collect()
    assert len({(r.row_key, r.doc_id, r.item_id) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in rows}


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_against_all_pairs(spark, documents, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "small", functools.partial(text.small, bound=bound))
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    docs = list(documents)
    long = " ".join(t for _, t in documents[:30])
    for i, (_, t) in enumerate(items):
        words = t.split()
        docs.append((1000 + i, f"{long} {t} {long}"))
        # About at the threshold: the tail is cut off, a word in the middle is another.
        docs.append((2000 + i, "start " + " ".join(words[: len(words) - len(words) // 6]) + " end"))
        docs.append((3000 + i, " ".join("other" if k == len(words) // 2 else w.upper() for k, w in enumerate(words))))
    docs.append((5000, long + "".join(t + "\n" for _, t in items)))
    got = result(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert got == want
    assert len(want) > len(items)


def test_odd_rows(spark, odd, empty):
    from tests.llm.conftest import ODD

    items = [(1, "a null id with seven words here"), (2, None), (3, ""), (4, "one"), (None, "a null id with seven words"), (5, "wide blanks and more\x00zero \U0001f600 end"), (5, "wide blanks and more\x00zero \U0001f600 end")]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, row_key int")
    assert result(odd, table) == brute(ODD, items) != set()
    assert result(empty, table) == set()
    assert result(odd, table.where("false")) == set()


def test_no_python_on_the_main_path(spark, capsys):
    tables = [spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "benchmark")]
    decontaminate.contained(*tables).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
