import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus import none, odd
from docstruct.llm import bpe

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return bpe.Counter(bpe.Model(PATH))


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ["", " ", "hello", "don't I'LL we've", "<|endoftext|>a<|startoftext|> b<|EndOfText|>", "ΑΣ ΣΑΣ İ ǅ ﬁ", "a\x1cb\x1d c\x85d e", "12345 ½²", "日本語 🙂🙂", "x" * 3000, "'S 's'tx !!'s", "é ́"])
def test_counts_are_the_librarys(library, counter, text):
    assert counter.count(text) == expected(library, text)


def test_any_text(library, counter):
    @settings(max_examples=200, deadline=None)
    @given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"]), max_size=60))
    def check(text):
        assert counter.count(text) == expected(library, text)

    check()


def test_heap_agrees_with_plain_merging():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("ab", "c"): 2, ("c", "c"): 3, ("a", "bc"): 4, ("abc", "abc"): 5}

    def plain(symbols):
        while pairs := [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]:
            _, i = min(pairs)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return len(symbols)

    for text in ("abcabc", "aabbcc", "abab", "ccc", "cccc", "abcc", "a", "bcbcbc"):
        assert bpe.merged(list(text), ranks) == plain(list(text))


def test_query_shape(spark, library):
    rows = odd(spark)
    out = bpe.token_counts(rows, PATH)
    assert set(out.columns) == set(rows.columns)
    for r in out.collect():
        assert r["n_tokens"] == expected(library, r["text"])
    assert bpe.token_counts(none(spark), PATH).count() == 0
    assert os.path.exists(PATH)
