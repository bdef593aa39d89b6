"""Quality rules: text statistics and a learned decision list, in DataFrame
expressions only.

The statistics of a text are computed by array functions inside its row: no
explode, no shuffle, any text length.  :func:`learn` fits an ordered list of
threshold conjunctions to labelled documents by sequential covering; the list
is a chain of Spark ``when`` expressions (:func:`verdict`), so applying it is
part of the scan.

Learning uses at most ``MAX_LABELLED`` labelled documents, chosen by a hash of
their ids: their statistics (seven numbers each) go to the driver.  Everything
else covers all rows.

Defined cases: NULL or blank text has zero words and every count 0, and fails
the base rule; labels that are NULL or whose document is missing are not used;
of several labels for a document the lowest quality counts; without any
low-quality label the list is empty and keeps everything the base rule keeps;
other columns are ignored or passed through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, SPACES, let

SYMBOLS = "#*$%&|<>"
MAX_LABELLED = 20_000
FEATURES = ["n_words", "mean_word", "symbol_share", "line_share", "repeat_share"]


def _repeated(grams: Column) -> Column:
    """Words covered by a window whose hash occurs at least twice; ``grams``
    are the hashes of the windows of 3 words, in order."""
    def covered(s: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return ((k > 0) & (F.get(s, k - 1)["g"] == x["g"])) | \
                F.coalesce(F.get(s, k + 1)["g"] == x["g"], F.lit(False))

        def union(at: Column) -> Column:  # a window covers 3 words, less what the next one covers too
            return F.aggregate(at, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), lambda a, i: F.struct(
                i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")))["n"]

        return union(F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"])))

    return let(F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))), covered)


def statistics(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)."""
    t = F.coalesce(text, F.lit(""))
    bare = F.btrim(t, F.lit(SPACES))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        grams = F.transform(F.slice(w, 1, F.greatest(n - 2, F.lit(0))),
                            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.struct(n.cast("long").alias("n_words"),
                        F.when(n >= 4, _repeated(grams)).otherwise(0).cast("long").alias("n_repeat_words"))

    w = let(F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN)), of_words)
    lines = let(F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
                lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return let(w, lambda r: F.struct(
        r["n_words"].alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.cast("long").alias("n_dup_lines"), r["n_repeat_words"].alias("n_repeat_words")))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def feature(s: Column, name: str) -> Column:
    n = F.greatest(s["n_words"], F.lit(1))
    return {"n_words": s["n_words"].cast("double"), "mean_word": s["word_chars"] / n,
            "symbol_share": s["n_symbols"] / n, "line_share": s["n_dup_lines"] / n,
            "repeat_share": s["n_repeat_words"] / n}[name]


def _thresholds(x: np.ndarray, bad: np.ndarray) -> list[tuple[str, float]]:
    """Candidate tests of one feature: at quantiles of all documents and of the
    low-quality ones, each moved half way to the next value outside."""
    values = np.unique(x)
    at = np.unique(np.concatenate([np.quantile(v, np.linspace(0, 1, 129), method="nearest")
                                   for v in (x, x[bad]) if len(v)]))
    k = np.searchsorted(values, at)
    low = (at + values[np.maximum(k - 1, 0)]) / 2
    high = (at + values[np.minimum(k + 1, len(values) - 1)]) / 2
    return [(">=", float(v)) for v in low] + [("<=", float(v)) for v in high]


@dataclass
class Rule:
    """A conjunction of (feature, ">=" or "<=", threshold) that rejects."""
    terms: list[tuple[str, str, float]] = field(default_factory=list)
    rejected: int = 0  # labelled documents it covered: of low quality, of high quality
    lost: int = 0


def labelled(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Features, quality and base verdict of at most ``limit`` labelled
    documents (by hash of id).  Nothing filters by the statistics here: Spark
    would move the filter below the join and compute them for all documents."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col("quality").alias("__q")).dropna() \
        .groupBy("__id").agg(F.min("__q").alias("__q"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(limit)
    found = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")) \
        .join(F.broadcast(known), "__id")  # at most ``limit`` rows of two numbers
    found = found.select("__id", "__q", statistics(F.col("__t")).alias("s"))
    return found.select(
        F.col("__q").alias("quality"), base_failed(F.col("s")).alias("base_failed"), (F.xxhash64("__id", F.lit("fold")) % 3 == 0).alias("prune"),
        *[feature(F.col("s"), f).alias(f) for f in FEATURES])


def learn(docs: DataFrame, labels: DataFrame, min_precision: float = 0.95, min_support: int = 10,
          max_rules: int = 12, max_terms: int = 4, **kw) -> list[Rule]:
    """Sequential covering.  Two thirds of the labelled documents grow a rule
    term by term by FOIL's information gain over threshold candidates
    (quantiles of the values); the last third prunes it from the end by
    (rejected - lost) / covered.  A rule stays if at least ``min_support``
    documents are rejected and ``min_precision`` of those it covers are of low
    quality; what it covers is removed and the next rule is grown."""
    rows = [r for r in labelled(docs, labels, **kw).collect() if not r["base_failed"]]  # at most MAX_LABELLED
    if not rows:
        return []
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    bad = np.array([r["quality"] == 0 for r in rows])
    prune = np.array([r["prune"] for r in rows])
    order = np.lexsort((*x.T, bad, prune))  # the same list whatever order the rows came in
    x, bad, prune = x[order], bad[order], prune[order]
    tests = [(f, op, v) for j, f in enumerate(FEATURES) for op, v in _thresholds(x[:, j], bad)]
    masks = {t: (x[:, FEATURES.index(t[0])] >= t[2]) if t[1] == ">=" else (x[:, FEATURES.index(t[0])] <= t[2])
             for t in tests}

    def grow(live: np.ndarray) -> list:
        cover, terms = live & ~prune, []
        while len(terms) < max_terms and (cover & ~bad).any():
            p0, n0 = (cover & bad).sum(), (cover & ~bad).sum()
            best = (0.0, None)
            for t in tests:
                p, n = (cover & masks[t] & bad).sum(), (cover & masks[t] & ~bad).sum()
                if p:
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                    if gain > best[0] + 1e-9:
                        best = (gain, t)
            if best[1] is None:
                break
            terms.append(best[1])
            cover &= masks[best[1]]
        return terms

    def cover(terms: list, live: np.ndarray) -> np.ndarray:
        out = live.copy()
        for t in terms:
            out &= masks[t]
        return out

    def worth(terms: list, live: np.ndarray) -> float:
        c = cover(terms, live & prune)
        return ((c & bad).sum() - (c & ~bad).sum()) / max(c.sum(), 1)

    rules, live = [], np.ones(len(bad), bool)
    while len(rules) < max_rules and (live & bad & ~prune).any():
        terms = grow(live)
        while len(terms) > 1 and worth(terms[:-1], live) >= worth(terms, live):
            terms = terms[:-1]
        c = cover(terms, live)
        hit, lost = int((c & bad).sum()), int((c & ~bad).sum())
        if not terms or hit < min_support or hit < min_precision * (hit + lost) or worth(terms, live) <= 0:
            break
        rules.append(Rule(terms, hit, lost))
        live &= ~c
    return rules


def verdict(s: Column, rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: false as soon as the
    base rule or a learned conjunction holds, else true."""
    out = F.when(base_failed(s), F.lit(False))
    for r in rules:
        terms = [(feature(s, f) >= v) if op == ">=" else (feature(s, f) <= v) for f, op, v in r.terms]
        cond = terms[0]
        for t in terms[1:]:
            cond = cond & t
        out = out.when(cond, F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, base_failed and kept per document."""
    s = F.col("s")
    out = docs.select(F.col(id_col).alias("doc_id"), statistics(F.col(text_col)).alias("s"))
    return out.select("doc_id", "s.*", base_failed(s).alias("base_failed"), verdict(s, rules).alias("kept"))


def keep(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The documents that the list keeps, with all their columns."""
    return docs.filter(let(statistics(F.col(text_col)), lambda s: verdict(s, rules)))
