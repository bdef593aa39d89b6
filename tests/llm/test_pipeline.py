"""Each stage of corpus_pipeline against a plain version of its decision, on its own input."""
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as cp
from tabsieve.llm import decontam, mixing, quality

from corpus_fixtures import make_docs  # noqa: F401
from test_decontam import greedy, tokens
from test_quality import brute
from test_simhash import brute_print, brute_roots

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, f) in enumerate(cp.STAGES):
        f(spark, docs, SF).write.parquet(f"{base}/{k}")
        result = spark.read.parquet(f"{base}/{k}")
        out.append((docs, result))
        docs = result
    return [([tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()], a, b) for a, b in out]


def test_documents_keep_their_columns(stages):
    for before, after, a, b in stages[:-1]:
        assert a.dtypes == b.dtypes and set(after) <= set(before) and after


def test_quality(stages, spark):
    before, after, a, _ = stages[0]
    rules = quality.learn(a, spark.read.parquet(f"{SF}/labels.parquet"))
    def kept(text):
        words, chars, symbols, dups, repeated = brute(text)
        if words < 50 or 100 * repeated > 50 * words:
            return False
        value = {"n_words": words, "mean_word": chars / words, "symbol_share": symbols / words,
                 "line_share": dups / words, "repeat_share": repeated / words}
        return not any(all(value[f] >= v if op == ">=" else value[f] <= v for f, op, v in r.terms) for r in rules)
    assert sorted(after) == sorted(r for r in before if kept(r[1]))


def test_near_dedup(stages):
    before, after, *_ = stages[1]
    rows = sorted(before)
    prints = [brute_print(r[1]) for r in rows]
    roots = brute_roots(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    assert sorted(after) == [r for i, r in enumerate(rows) if roots[i] == i]


def test_decontamination(stages, spark):
    before, after, *_ = stages[2]
    items = [tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    def bad(text):
        t = tokens(text)
        grams = {tuple(t[i:i + 5]) for i in range(len(t) - 4)}
        return any(sum(x[2] for x in greedy(i, t, 5)) >= decontam.COVERAGE * len(i) for i in items
                   if any(tuple(i[j:j + 5]) in grams for j in range(len(i) - 4)))
    assert sorted(after) == sorted(r for r in before if not bad(r[1]))


def test_mixing(stages):
    before, after, a, _ = stages[3]
    con = duckdb.connect()
    con.register("documents", a.toPandas())
    taken = {r[0]: r[4] for r in con.execute(mixing.SQL).fetchall()}
    copies = Counter(r[0] for r in after)
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in before}
    assert all(copies[i] * size[i] == taken[i] for i in size)


def test_token_output(stages):
    before, after, *_ = stages[4]
    t, at, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for r in sorted(before, key=lambda r: r[0]):
        ids = np.array(t.encode(r[1], add_special_tokens=False).ids + [2], "<u4")
        want.append((r[0], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(after) == want


def test_registered():
    names = {k.split("_")[0] for k in __spark_entry__.queries() if re.match(r"op\d+_", k)}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_rows_without_id_or_of_one_id(spark, make_docs):
    """Near-dedup and decontamination decide on rows: ids may be NULL or equal."""
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = next(t for t in items if len(tokens(t)) >= 20)
    clean = [" ".join(f"w{k}x{i * i}" for i in range(60)) for k in range(4)]
    rows = [(None, clean[0]), (None, clean[0]), (None, clean[1]), (5, clean[2]), (5, clean[3]), (5, clean[3]), (6, clean[2]),
            (None, clean[2]), (5, bad), (None, bad), (None, "\n" + bad)]
    docs = make_docs(rows).withColumn("__mine", F.lit(1))
    got = cp.near_dedup(spark, docs, SF)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(
        [(None, clean[0]), (None, clean[1]), (5, clean[2]), (5, clean[3]), (5, bad)])
    left = cp.decontaminate(spark, docs, SF)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(r for r in rows if bad not in r[1])
