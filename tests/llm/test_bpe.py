from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def same(text):
    packed = bpe.vocabulary(PATH).encode(text)
    wanted = LIBRARY.encode(text, add_special_tokens=False).ids
    assert list(array("I", packed)) == wanted
    assert bpe.vocabulary(PATH).decode(packed) == LIBRARY.decode(wanted, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b", "a\n\n b", "x<|endoftext|> y  <|endoftext|>", "日本語 é 🙂🙂", "'s it's 12ab", "ab" * 4000])
def test_matches_library(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"abthe é1's\n\t!🙂", "<|endoftext|>", "  "]), max_size=40))
def test_matches_library_on_any_text(parts):
    same("".join(parts))


def test_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "a b", None)], "doc_id long, text string, ids string")
    rows = bpe.decode(bpe.encode(df, PATH), PATH).select("doc_id", "ids", "decoded", bpe.n_ids().alias("n")).collect()
    assert sorted((r.doc_id, bytes(r.ids) == b"", r.decoded, r.n) for r in rows) == [(1, True, "", 0), (2, False, "a b", 2), (2, True, "", 0)]
    assert bpe.encode(df.limit(0), PATH).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text("ab é\n", max_size=60))
def test_wide_words_merge_alike(text):
    v = bpe.vocabulary(PATH)
    ids = [v.of_byte[b] for b in text.encode()]
    assert v._merge_wide(list(ids)) == v.merge(list(ids))


@pytest.mark.parametrize("text", [" " * 200_000, "\n" * 100_000 + "x", "ab" * 100_000, "a  " * 50_000])
def test_long_texts(text):
    same(text)
