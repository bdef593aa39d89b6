import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabsieve.llm import tokencount

from corpus_fixtures import make_docs  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = tokencount.Counter(PATH)
CASES = ["", None, "Hello world's <|endoftext|>end<|endoftext|>", " \n\n  x\t\ty ", "naïve ñandú ß 漢字 \U0001f600",
         "aaaa" * 700, "the " * 90000, "x\x1c\x85  y", "<|endoftext", "''''s don't I'LL 12345 1½"]


def count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_equals_library(spark, make_docs):
    rows = [*enumerate(CASES), (None, "no id"), (2, "again"), (2, "again")]
    got = tokencount.token_counts(make_docs(rows).withColumn("n_tokens", F.lit("clash")), PATH, limit=100).collect()
    want = sorted(map(str, ((i, len((t or "").encode()), count(t), count(t) > 100) for i, t in rows)))
    assert sorted(str(tuple(r)) for r in got) == want
    assert tokencount.token_counts(make_docs([]), PATH).count() == 0


def test_equals_library_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = tokencount.token_counts(docs, PATH).collect()
    assert len(got) == len(text) and all(r.n_tokens == count(text[r.doc_id]) for r in got)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab the'\n \t1é漢<|>"), st.characters(exclude_categories=["Cs"]))))
def test_any_text(text):
    assert COUNTER(text) == count(text)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=40))
def test_heap_equals_rescanning(piece):
    ranks, symbols = COUNTER.merges.ranks, list(piece)
    while True:  # brute force: look for the lowest rank among all pairs, every time
        found = [(ranks[p][0], i, ranks[p][1]) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not found:
            break
        _, i, merged = min(found)
        symbols[i:i + 2] = [merged]
    assert COUNTER.merges.count(piece) == len(symbols)


def test_cache_turnover(monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE_PIECES", 3)
    monkeypatch.setattr(tokencount, "SLICE", 2)
    c, text = tokencount.Counter(PATH), "one two three four five six " * 5
    assert c(text) == count(text) and c(text) == count(text)


def test_missing_file():
    with pytest.raises(FileNotFoundError):
        tokencount.Counter("/nowhere.json")
