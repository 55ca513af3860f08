import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pactframe.llm.token_counts import MergeCounter, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, OURS = Tokenizer.from_file(PATH), MergeCounter(PATH)


def library(text: str) -> int:
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


ODD = [
    "", " ", "a", "aaaaaaaaaaaaaaa", "Don't we'll I'M 'S", "tab\tx\x0by\r\nz\x85q r\x1cs", "ΟΔΥΣΣΕΥΣ σίσυφος Σ",
    "<|endoftext|>a<|startoftext|><|endoftext|>B", "x<|endoftext|", "é ́a i̇ İ ﬁ", "日本語テキスト 12345", "👍🏽👍👍👍",
    "a​b c　d", "%%%%%%%%***###", "1234567890 ½ ² ٣", "naïvë 힣",
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert OURS.count([text]) == [library(text)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]), max_size=60))
def test_any_text(text):
    assert OURS.count([text]) == [library(text)]


def test_table(spark, sf, frame, rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = rows(token_counts(docs, PATH))
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_tokens"], r["n_bytes"]) == (library(texts[r["doc_id"]]), len(texts[r["doc_id"]].encode()))
        assert r["over_limit"] == (r["n_tokens"] > 2048)


def test_edges(frame, rows):
    dice = random.Random(1)
    long = " ".join("".join(dice.choice("abcdefgh") for _ in range(dice.randint(1, 400))) for _ in range(20_000))
    docs = [(1, None), (None, "no id"), (3, long), (3, long), (4, "a" * 50_000)]
    got = rows(token_counts(frame(docs, extra=True), PATH))
    assert [r["n_tokens"] for r in got] == [library("no id"), 0, library(long), library(long), library("a" * 50_000)]
    assert token_counts(frame([]), PATH).collect() == []
