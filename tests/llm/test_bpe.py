import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from metframe.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def check(vocabulary, library, texts):
    ids, decoded = bpe.encode_texts(vocabulary, texts)
    for text, i, d, e in zip(texts, ids, decoded, library.encode_batch(texts, add_special_tokens=False)):
        assert i.tolist() == e.ids, text[:200]
        assert d.decode() == library.decode(e.ids, skip_special_tokens=False)


def test_documents(vocabulary, library, documents):
    check(vocabulary, library, [t or "" for _, t in documents])


def test_odd_texts(vocabulary, library):
    check(vocabulary, library, [
        "", " \n", "ΑΣ ΣΑΣ Σ", "İstanbul ǅ ß ẞ", "<|startoftext|>a<|endoftext|>b <|ENDOFTEXT|>", "it's I'LL 's ''s don't",
        "é ﬁ ẛ̣", "a\x1cb\x85c d\xa0e​f", "\x00\x00<| <|endoftext", "١٢٣ ½ Ⅷ 12345", "\U0001f600\U0001f468‍\U0001f469",
    ])


def test_long_unsplit_text(vocabulary, library):
    rng = random.Random(4)
    texts = ["a" * n for n in (47, 48, 49, 97, 1000, 5003)] + ["!" * 3000, "ab" * 2001, "=-" * 700, "é" * 999]
    texts += ["".join(rng.choice("theraningo") for _ in range(n)) for n in (100, 1000, 20_000)]
    texts += ["".join(rng.choice("etaoinshrdluéß") for _ in range(3000)) for _ in range(5)]
    check(vocabulary, library, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aeinrst'!?.,%&| \nÉ1Σ"), max_size=300), max_size=4))
def test_any_text(texts):
    check(VOCABULARY, LIBRARY, texts)


VOCABULARY, LIBRARY = bpe.read_vocabulary(PATH), Tokenizer.from_file(PATH)


def test_leaves_and_windows_do_not_matter(vocabulary, monkeypatch):
    rng = random.Random(2)
    for _ in range(40):
        word = "".join(rng.choice("theanrio!") for _ in range(rng.randrange(2, 200))).encode()
        whole = bpe.encode_words(vocabulary, [word])[0]
        with monkeypatch.context() as m:
            m.setattr(bpe, "LEAF", rng.randrange(1, 9))
            m.setattr(bpe, "WINDOW", 1)
            assert np.array_equal(bpe.encode_words(vocabulary, [word])[0], whole)


def test_rows(spark, odd, empty, library):
    got = bpe.encoded(odd, PATH).collect()
    want = sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    assert sorted(str(r.doc_id) for r in got) == [w[0] for w in want]
    digests = sorted(
        (i, hashlib.sha256(np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()) for i, t in want
    )
    assert sorted((str(r.doc_id), r.ids_sha256) for r in got) == digests
    assert all(bpe.decode(r.ids, VOCABULARY) == r.decoded for r in got)
    assert bpe.encoded(empty, PATH).count() == 0
