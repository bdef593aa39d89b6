import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabsieve.llm import quality

from corpus_fixtures import make_docs  # noqa: F401

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams, covered, seen, dup = Counter(zip(w, w[1:], w[2:])), set(), set(), 0
    for i in range(len(w) - 2):
        if grams[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


CASES = ["", None, " \n\t ", "one", "a b", "a b c", "a b c a b c", "a a a a", "a b c d a b c x b c d",
         "#*$%&|<> x\n\nx\nx \nx", "ünï cödé \U0001f600 " * 9, "l1\nl2\nl1\n\nl2\r\n", "w w w w",
         "the same words again and " * 5000, " ".join(map(str, range(60000)))]


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, quality.learn(docs, labels)


def test_statistics_equal_brute_force(spark, make_docs, learned):
    docs = make_docs(list(enumerate(CASES))).withColumn("s", F.lit("clash")).withColumn("n_words", F.lit(1))
    for d, rules in ((docs, []), (learned[0], learned[2])):
        want = {r.doc_id: brute(r.text) for r in d.select("doc_id", "text").collect()}
        for r in quality.judge(d, rules).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert rules or r.kept != r.base_failed


def test_held_out_accuracy(spark, learned):
    docs, labels, _ = learned
    part = F.xxhash64("doc_id", F.lit("held")) % 4 == 0
    rules = quality.learn(docs, labels.filter(~part), min_support=5)
    got = quality.judge(docs, rules).join(labels.filter(part), "doc_id").filter("not base_failed").collect()
    bad, good = [r for r in got if r.quality == 0], [r for r in got if r.quality == 1]
    assert sum(not r.kept for r in bad) >= 0.7 * len(bad) and sum(r.kept for r in good) >= 0.98 * len(good)


def test_list_is_repeatable_and_bounded(spark, learned):
    docs, labels, rules = learned
    assert rules and rules == quality.learn(docs.repartition(5), labels.orderBy(F.rand(3)))
    assert quality.labelled(docs, labels, limit=50).count() <= 50


def test_nothing_to_learn_from(spark, make_docs, learned):
    empty = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    text = " ".join(f"w{i}" for i in range(80))
    docs = make_docs([(1, text), (1, text), (None, text), (2, None)])
    assert quality.learn(docs, empty) == []
    assert sorted(r.kept for r in quality.judge(docs, []).collect()) == [False, True, True, True]
    assert quality.keep(docs, []).columns == docs.columns and quality.keep(docs, []).count() == 3
    assert quality.judge(make_docs([]), learned[2]).count() == 0


def test_no_python_in_the_plan(learned):
    docs, _, rules = learned
    plan = quality.judge(docs, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
