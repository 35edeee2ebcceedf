import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lucrum.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Bpe(f.read())


def _same(own, library, texts):
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text[:80])
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_equals_library_on_hard_texts(own, library):
    r = random.Random(1)
    hard = ["a  b   c\n\n  d \n e\t", "x \nfoo", "x  \nb  ", "don't I'll 've 'S", "a\x85b\xa0\xa0c 　d \x1c\x1d", "ab" * 3000 + "\n" * 99,
            "ſ'S   ​ ﻿ \xbd\xb2\xb3", "<|endoftext|>x <|endoftext|><|endoftext|>", "1234567890" * 50]
    hard += ["".join(r.choice(" \n\t  abc\xe9日1'.<|endoftext|>sтд") for _ in range(r.randint(0, 80))) for _ in range(1500)]
    _same(own, library, hard)


def test_exact_merging_of_long_runs_equals_library(own, library):
    r = random.Random(2)
    _same(own, library, ["".join(r.choice("aehnst") for _ in range(n)) for n in (5, 33, 63, 64, 65, 66, 200, 3000)])


def test_failing_words_are_those_whose_greedy_cut_differs(own):
    words = [w.encode() for w in (" ththanereed", " nonsenseword", " the", "Unbelievabletokenization")]
    assert own.encode_words(words) == [own.exact(w) for w in words]


def test_operator_on_odd_rows(spark, make_docs, odd_rows, library):
    docs = make_docs(odd_rows)
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert {"doc_id", "source", "n_tokens", "ids", "decoded"} <= set(out.columns) and "text" not in out.columns
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.decoded, r.n_tokens, bytes(r.ids)) for r in out.collect()))
    want = []
    for key, text in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((key is None, key or 0, text or "", len(ids), np.array(ids, "<u4").tobytes()))
    assert got == sorted(want)
    assert bpe.encode(make_docs([]), PATH).count() == 0
