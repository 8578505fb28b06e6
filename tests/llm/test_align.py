import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from metframe.llm import align

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    return [make(open(f, "rb").read()) for make, f in zip((align.byte_level, align.pieces), FILES)]


def plain(texts, sides):
    """Rows by token loops: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    rows, held = [], Counter()
    for text in texts:
        ids = [encode([text])[0] if text else [] for encode, _ in sides]
        whole = " " + (text or "")
        if not text or any(b"".join(tokens[i] for i in own) != whole.encode() for own, (_, tokens) in zip(ids, sides)):
            rows.append((0, 0, 0, [], ""))
            continue
        spans = []
        for own, (_, tokens) in zip(ids, sides):
            ends = np.cumsum([len(tokens[i]) for i in own]).tolist()
            spans.append(list(zip(own, [0, *ends[:-1]], ends)))
        links = [(a, b) for a, s, e in spans[0] for b, t, f in spans[1] if s < f and t < e]
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in spans))
            start = cut
        rows.append((*map(len, ids), len(cuts), links, ";".join(groups)))
        held.update(set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return [(*r[:3], len(r[3]), sum(held[p] == most[p[0]] for p in r[3]), sum(held[p] for p in r[3]), r[4]) for r in rows]


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_all_common_ends(seed):
    rng = random.Random(seed)
    ends, other, last, base = [], [], [], 0
    for _ in range(rng.randrange(1, 8)):
        size = rng.randrange(1, 400)
        for side in (ends, other):
            side += sorted({base + i for i in range(1, size) if rng.random() < (0.1, 0.5, 0.9)[seed % 3]} | {base + size})
        base += size
        last.append(len(ends) - 1)
    ends, other = np.array(ends), np.array(other)
    assert align.shared_cuts(ends, other, np.array(last)).tolist() == np.flatnonzero(np.isin(ends, other)).tolist()


def test_looks_go_along_the_text(monkeypatch):
    """Every look into the other side's ends asks for ascending places, so that it stays near the last one."""
    rng, asked, look = np.random.default_rng(2), [], np.searchsorted
    ends, other = (np.unique(np.append(rng.integers(1, 9000, 4000), 9000)) for _ in range(2))
    monkeypatch.setattr(align.np, "searchsorted", lambda a, v, *rest, **more: asked.append(np.asarray(v)) or look(a, v, *rest, **more))
    cuts = align.shared_cuts(ends, other, np.array([len(ends) - 1]))
    assert ends[cuts].tolist() == np.intersect1d(ends, other).tolist()
    assert asked and all((np.diff(v) > 0).all() for v in asked)


TEXTS = [
    None, "", " ", "one", "one", "  two  blanks ", "tab\tand\nline", "<|endoftext|> </s> <s>", "▁ mark", "\x00 zero", "é combined Å", "日本語 の 文",
    "\U0001f600\U0001f601", "x" * 3000, "ab " * 2000, "Thntblere of then, edtioner",
]


@pytest.mark.parametrize("sent", [align.SENT, 40, 0])
def test_rows_are_those_of_token_loops(spark, documents, sides, sent):
    texts = TEXTS + [t for _, t in documents[:60] if len(t or "") < 1500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in align.aligned(df, *FILES, sent=sent).collect()}
    for i, want in enumerate(plain(texts, sides)):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == want, texts[i]
        assert r.groups_sha256 == (hashlib.sha256(want[-1].encode()).hexdigest() if want[-1] else "")


def test_odd_rows(odd, empty, sides):
    rows = align.aligned(odd, *FILES, with_groups=False).collect()
    assert len(rows) == odd.count() and "groups" not in rows[0].asDict()
    want = plain([r.text for r in odd.collect()], sides)
    assert sorted((r.n_a, r.n_links, r.n_best, r.count_sum) for r in rows) == sorted((w[0], w[3], w[4], w[5]) for w in want)
    assert align.aligned(empty, *FILES).count() == 0


def test_ranks_give_the_ids_of_the_file(sides):
    """Every code point at the start, inside and at the end of words, numbers, marks and blanks; endless runs."""
    file = open(FILES[0], "rb").read()
    tokenizer = Tokenizer.from_buffer(file)
    tokenizer.encode_special_tokens = True
    code_points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}b 1{c}2 {c} !{c}{c} " for c in code_points[i:i + 64]) for i in range(0, len(code_points), 64)]
    texts += [c * n for c in ("x", " ", "\n", "1", "é", "a b") for n in (5000, align.LONG + 1)]
    want = tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert all(i.tolist() == w.ids for i, w in zip(sides[0][0](texts), want))
