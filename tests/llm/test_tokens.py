import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabwright.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _library_count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark, sf, library, text_rows):
    rng = random.Random(5)
    odd = ["<|endoftext|> a<|startoftext|>b <|endof", "ΑΣ ΟΔΟΣ σ", "İstanbul İ", "é café", "it's we'll 'S", "12345 ٣", "a\x1cb\x85c\xa0d e",
           "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ababababab", "!!!! ### ?!?!"]
    alphabet = "abcdeé ß'ñ1.,!?\n\tΣ漢字😀Ａ<|>İ́"
    odd += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(500)]
    docs = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts = [*text_rows, *odd, *docs]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in tokens.count_tokens(df, PATH).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i]["n_tokens"] == _library_count(library, text), repr(text)[:200]
        assert got[i]["n_bytes"] == len((text or "").encode())


def test_random_merges(library):
    with open(PATH, encoding="utf-8") as f:
        bpe = tokens.WordBpe(json.load(f))
    rng = random.Random(1)
    words = ["".join(rng.choice("abnstheinou") for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    assert bpe.counts([w.encode() for w in words]).tolist() == [_library_count(library, w) for w in words]


def test_long_text_is_cut_before_spaces(library, monkeypatch):
    text = "alpha beta  gamma " * 50 + "x" * 500
    parts = tokens.pieces(text, 40)
    assert "".join(parts) == text and len(parts) > 10
    assert sum(_library_count(library, p) for p in parts) == _library_count(library, text)


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_tokens string")
    assert tokens.count_tokens(df, PATH).count() == 0
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (None, None, None)], "doc_id long, text string, n_tokens string")
    assert sorted(r["n_tokens"] for r in tokens.count_tokens(df, PATH).collect()) == [0, 1, 1]
