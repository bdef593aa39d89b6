"""URL filter: path rules, then a character language-model ratio.

**Rules** fix verdicts by host and path prefix: a rule ``host/path`` fits its
host and all subdomains if the URL's path starts with the rule's; the longest
fitting rule wins.

**Method** for the rest: two smoothed variable-order Markov models over the
bytes of URLs, one of the accepted URLs (allowed by a rule), one of the
rejected ones (blocked by a rule).  The probability of a byte after its context
is interpolated from order 0 to ``ORDER``: each order adds its counts to
``TRUST`` times the next shorter order's probability, so a context is trusted
as far as it has been seen, and an unseen one falls back to shorter ones.  A
URL's score is the difference of its log likelihoods per byte; the
threshold is calibrated on labelled URLs that the models have not seen (one in
``HELD_OUT``, by hash) as the score with the least mean error of both classes.

Counts cover every labelled URL and are exact: a byte with its ``ORDER`` bytes of
context is one long (no hashing), counted in a Spark table that grows with the
input.  What a byte adds to a score depends on that long only, so the weights
are computed once per distinct one (:func:`weights`), from order 0 up: every
gram has at most 256 longer ones and every context 256 next bytes, so no group
of these joins and windows is larger.  A URL's score is the sum of its
weights: the grams that make up more than 1/``HOT`` of the bytes to score (at
most ``HOT``) go out to the tasks, the others are joined by gram and summed per
URL.  Weights are summed as multiples of 1/``SCALE``, so in any order alike.
Sums and at most ``HOT`` weights and ``2 * (BINS + 1)`` numbers go to the driver.

:func:`count` and :class:`Model` are the same models in tables of fixed size,
which mix what shares a slot: for few URLs in one process; :func:`judge` does
not use them.

Defined cases: a NULL URL or one without ``://`` has an empty host and path,
fits no rule and scores 0 (as does any empty rest), so the threshold decides;
without labelled URLs of both classes every URL scores 0 against threshold 0
and is allowed; repeated rows are judged alike (and count each); NULL ids are
kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# fixed values: the rules of the contract, (host, path prefix) and verdict
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
ORDER, SLOT_BITS, HELD_OUT, BINS = 5, 18, 8, 4096
SLOTS = 1 << SLOT_BITS
TRUST = 2.0
HOT, SCALE = 1 << 16, 1 << 30
SPAN = 8.0  # scores beyond +-SPAN nats a byte share the last bins
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct rule (like ``com/fr/``), verdict; NULL where no rule fits."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def judged(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, text (what the models read: all after ``://``, host lower-cased),
    host, path, rule, ruled (its verdict)."""
    host, path = split_url(F.col(url_col))
    r = rule_of(F.col("host"), F.col("path"), rules)
    rest = F.substring(F.col(url_col), F.instr(url_col, "://") + 3, F.length(url_col))
    out = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.when(
        F.instr(url_col, "://") > 0, F.concat(host, F.substring(rest, F.length(host) + 1, F.length(rest))))
        .otherwise("").alias("text"))
    return out.select("page_id", F.coalesce("text", F.lit("")).alias("text"), "host", "path",
                      r["rule"].alias("rule"), r["verdict"].alias("ruled"))


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, gram, owner): hashed slots of shape (order + 1, bytes) of each
    byte's contexts of 0 .. ``order`` bytes (padded by zero bytes at the start)
    and of context plus byte; owner is the text's number."""
    size = np.array([len(t) for t in texts], np.int64)
    pad = b"\0" * order
    b = np.frombuffer(b"".join(pad + t for t in texts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), size)
    at = np.arange(len(owner)) + order * (owner + 1)
    h, context, gram = np.zeros(len(at), np.uint64), [], []
    top = np.uint64(64 - SLOT_BITS)
    for k in range(order + 1):
        if k:
            h = (h + b[at - k] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        context.append((h * np.uint64(0xBF58476D1CE4E5B9)) >> top)
        gram.append(((h ^ (b[at] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0x94D049BB133111EB)) >> top)
    return np.stack(context).astype(np.int64), np.stack(gram).astype(np.int64), owner


@dataclass
class Model:
    """Counts of grams and of contexts, (2, ORDER + 1, SLOTS): rejected, accepted."""
    gram: np.ndarray
    total: np.ndarray

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Log likelihood accepted minus rejected, per byte."""
        if not any(texts):
            return np.zeros(len(texts))
        context, gram, owner = grams(texts)
        logs = []
        for c in (0, 1):
            p = np.full(len(owner), 1 / 256)
            for k in range(ORDER + 1):
                n = self.total[c, k, context[k]]
                p = (np.minimum(self.gram[c, k, gram[k]], n) + TRUST * p) / (n + TRUST)
            logs.append(np.log(p))
        out = np.bincount(owner, logs[1] - logs[0], len(texts))
        return out / np.maximum([len(t) for t in texts], 1)


def _held(text: Column) -> Column:
    return F.pmod(F.xxhash64(text, F.lit("held")), F.lit(HELD_OUT)) == 0


def count(labelled: DataFrame) -> DataFrame:
    """(text, accepted) -> accepted, kind, slot, n: kind 0 counts grams, kind 1
    context bytes; slot is order * SLOTS + hashed slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[np.zeros((ORDER + 1) * SLOTS, np.int32) for _ in range(2)] for _ in range(2)]
        base = (np.arange(ORDER + 1) * SLOTS)[:, None]
        for b in batches:
            accepted = np.asarray(b["accepted"].to_numpy(zero_copy_only=False), bool)
            texts = [t.as_py().encode("utf-8", "replace") for t in b["text"]]
            for c in (0, 1):
                mine = [t for t, a in zip(texts, accepted) if a == c]
                for at in range(0, len(mine), 2000):
                    context, gram, _ = grams(mine[at:at + 2000])
                    for kind, slots in ((0, gram), (1, context)):
                        found, n = np.unique((slots + base).ravel(), return_counts=True)
                        sums[c][kind][found] += n.astype(np.int32)
        for c in (0, 1):
            for kind in (0, 1):
                at = np.flatnonzero(sums[c][kind])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), c, np.int32)), pa.array(np.full(len(at), kind, np.int32)),
                    pa.array(at.astype(np.int32)), pa.array(sums[c][kind][at].astype(np.int64))],
                    ["accepted", "kind", "slot", "n"])

    rows = labelled.mapInArrow(run, "accepted int, kind int, slot int, n long")
    return rows.groupBy("accepted", "kind", "slot").agg(F.sum("n").alias("n"))


@dataclass
class Exact:
    """Counts of the labelled URLs' bytes in context: key, n0 (rejected), n1 (accepted)."""
    counts: DataFrame
    threshold: float = 0.0


def keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(key, end): every byte of the texts with the ``ORDER`` bytes before it
    (zero bytes before the start) as one number, the byte lowest; the numbers
    of text i end at ``end[i]``."""
    size = np.array([len(t) for t in texts], np.int64)
    pad = b"\0" * ORDER
    b = np.frombuffer(b"".join(pad + t for t in texts), np.uint8).astype(np.int64)
    at = np.arange(size.sum()) + ORDER * (np.repeat(np.arange(len(texts)), size) + 1)
    key = np.zeros(len(at), np.int64)
    for k in range(ORDER + 1):
        key |= b[at - k] << 8 * k
    return key, np.cumsum(size)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of a bounded number of bytes at a time."""
    texts, first, size = batch["text"].cast(pa.binary()).to_pylist(), 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > 1 << 20 or i == len(texts) - 1:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0


def key_counts(rows: DataFrame) -> DataFrame:
    """(text) -> key, n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in _pieces(b):
                key, n = np.unique(keys(texts)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

    return rows.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def weights(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, n and w of the ``wanted`` (key, n): the log likelihood, accepted
    minus rejected, of the byte after its context, in 1/``SCALE``."""
    none = F.lit(0).cast("long")
    base = cut_lineage(counts.select("key", "n0", "n1", none.alias("n"))
                       .unionAll(wanted.select("key", none.alias("n0"), none.alias("n1"), "n"))
                       .groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "n")]))
    shorter = None
    for k in range(ORDER + 1):  # grams of k bytes of context, their sums, and the next shorter gram's probability
        level = base if k == ORDER else base.groupBy(F.col("key").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("key")) \
            .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("n").alias("n"))
        same = Window.partitionBy(F.shiftright("key", 8))
        level = level.withColumns({f"t{c}": F.sum(f"n{c}").over(same) for c in (0, 1)}).filter("n > 0")
        if shorter is None:
            level = level.withColumns({f"p{c}": F.lit(1 / 256) for c in (0, 1)})
        else:
            level = level.withColumn("tail", F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1))).join(shorter, "tail")
        out = [((F.col(f"n{c}") + TRUST * F.col(f"p{c}")) / (F.col(f"t{c}") + TRUST)).alias(f"p{c}") for c in (0, 1)]
        shorter = level.select(F.col("key").alias("tail"), "n", *out) if k == ORDER else \
            level.select(F.col("key").alias("tail"), *out)
    return shorter.select(F.col("tail").alias("key"), "n",
                          F.round((F.log("p1") - F.log("p0")) * SCALE).cast("long").alias("w"))


def fit(rows: DataFrame) -> Exact | None:
    """Models and threshold from :func:`judged` rows; None without both classes."""
    labelled = rows.filter("ruled IS NOT NULL").select("text", (F.col("ruled") == "allow").alias("accepted"))
    seen = labelled.filter(~_held(F.col("text")))
    none = F.lit(0).cast("long")
    counts = cut_lineage(
        key_counts(seen.filter("NOT accepted")).select("key", F.col("n").alias("n0"), none.alias("n1")).unionAll(
            key_counts(seen.filter("accepted")).select("key", none.alias("n0"), F.col("n").alias("n1")))
        .groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    total = counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    if not total.n0 or not total.n1:
        return None
    model = Exact(counts)
    held = labelled.filter(_held(F.col("text")))
    bins = _scored(held.select("text", "accepted"), model, "accepted").select(
        "accepted", F.floor((F.greatest(F.least("score", F.lit(SPAN)), F.lit(-SPAN)) + SPAN) / (2 * SPAN) * BINS)
        .cast("int").alias("bin")).groupBy("accepted", "bin").count().collect()  # at most 2 * (BINS + 1) rows
    hist = np.zeros((2, BINS + 1))
    for r in bins:
        hist[int(r.accepted), r.bin] += r["count"]
    if hist[0].any() and hist[1].any():
        wrong_bad = 1 - np.concatenate([[0], np.cumsum(hist[0])]) / hist[0].sum()  # at or over the edge
        wrong_good = np.concatenate([[0], np.cumsum(hist[1])]) / hist[1].sum()  # under it
        error = wrong_bad + wrong_good
        best = np.flatnonzero(error <= error.min() + 1e-12)
        model.threshold = float((best[0] + best[-1]) / 2 / BINS * 2 * SPAN - SPAN)
    return model


def _scored(rows: DataFrame, model: Exact, *keep: str) -> DataFrame:
    """``rows`` (text and ``keep``) with a double ``score`` instead of the text."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    # written, so that a row has the same number whenever it is read
    rows = cut_lineage(rows.select("text", *keep).withColumn("__row", F.monotonically_increasing_id()))
    known = cut_lineage(weights(model.counts, key_counts(rows)))
    total = known.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > total / HOT
    found = known.filter(often).select("key", "w").toArrow().sort_by("key")  # less than HOT rows
    hot, value = found["key"].to_numpy(), found["w"].to_numpy()

    def look_up(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(hot, key), max(len(hot) - 1, 0))
        return at, hot[at] == key if len(hot) else np.zeros(len(key), bool)

    def often_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, texts in _pieces(b):
                key, end = keys(texts)
                at, is_hot = look_up(key)
                add = np.zeros(len(key), np.int64)
                add[is_hot] = value[at[is_hot]]
                sums.append(np.diff(np.concatenate([[0], np.cumsum(add)])[np.concatenate([[0], end])]))
                size.append(np.diff(end, prepend=0))
            yield pa.RecordBatch.from_arrays([*(b[k] for k in keep), b["__row"], pa.array(np.concatenate(sums)),
                                              pa.array(np.concatenate(size))], [*keep, "__row", "__sum", "__size"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number = b["__row"].to_numpy()
            for first, texts in _pieces(b):
                key, end = keys(texts)
                rest = ~look_up(key)[1]
                owner = np.repeat(number[first:first + len(texts)], np.diff(end, prepend=0))
                yield pa.RecordBatch.from_arrays([pa.array(owner[rest]), pa.array(key[rest])], ["__row", "key"])

    kept = "".join(f"{k} {types[k]}, " for k in keep)
    sums = rows.mapInArrow(often_sums, kept + "__row long, __sum long, __size long")
    more = rows.select("text", "__row").mapInArrow(others, "__row long, key long") \
        .join(known.filter(~often).select("key", "w"), "key").groupBy("__row").agg(F.sum("w").alias("__more"))
    score = (F.col("__sum") + F.coalesce("__more", F.lit(0))) / F.lit(float(SCALE)) / F.greatest("__size", F.lit(1))
    return sums.join(more, "__row", "left").select(*keep, score.alias("score"))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block: the rule's, else the
    method's) and score per URL; a URL that a rule decides has no score."""
    rows = judged(pages, rules, id_col, url_col)
    model = fit(rows)
    ruled = rows.filter("ruled IS NOT NULL").select(
        "page_id", "host", "path", "rule", F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("score"))
    rest = rows.filter("ruled IS NULL")
    if model is None:
        scored, threshold = rest.withColumn("score", F.lit(0.0)), 0.0
    else:
        scored, threshold = _scored(rest, model, "page_id", "host", "path"), model.threshold
    return ruled.unionByName(scored.select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
        F.when(F.col("score") >= threshold, "allow").otherwise("block").alias("verdict"), "score"))


def allowed(pages: DataFrame, id_col: str = "page_id", **kw) -> DataFrame:
    """The pages whose URL is allowed, with all their columns (and those without id)."""
    bad = judge(pages, id_col=id_col, **kw).filter("verdict = 'block'").select(F.col("page_id").alias("__bad"))
    return pages.join(bad.distinct(), F.col(id_col) == F.col("__bad"), "left_anti")
