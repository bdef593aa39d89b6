import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsieve.llm import runindex as ri

from corpus_fixtures import make_docs  # noqa: F401


def brute(rows, length=ri.LENGTH):
    seen, out = set(), []
    for doc_id, text in rows:  # in corpus order
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = True
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_index_marks_earlier_windows(seed):
    rnd, length = random.Random(seed), 20
    parts = ["".join(rnd.choices("ab\0\xff"[:rnd.choice([2, 4])], k=40)) for _ in range(4)]
    strings, seen, want = [], set(), []
    for _ in range(rnd.randint(1, 25)):
        p = list(rnd.choice(parts))
        for _ in range(rnd.randint(0, 2)):
            p[rnd.randrange(len(p))] = "c"
        strings.append("".join(p)[:rnd.randint(20, 40)].encode("latin-1"))
    for s in strings:
        mine = [s[i:i + length] for i in range(len(s) - length + 1)]
        want.append([w in seen or w in mine[:i] for i, w in enumerate(mine)])
        seen |= set(mine)
    index = ri.RunIndex(strings, length)
    assert [m.tolist() for m in index.marked()] == want
    text = b"\0".join(strings) + b"\0"
    for s, o in zip(strings, index.offset):  # the sampled positions locate each window
        for i in range(len(s) - length + 1):
            at = index.found[o + i]
            assert text[at:at + length] == s[i:i + length]


def test_index_is_run_compressed():
    rnd = random.Random(0)
    base = bytes(rnd.choices(range(256), k=150))
    strings = [base[:i] + b"\x01" + base[i + 1:] for i in range(100)]
    index = ri.RunIndex(strings)
    assert len(index.run_start) < len(index.text) / 8


@pytest.mark.parametrize("piece", [1 << 20, 150, 7])
def test_stretches_cover_every_window(monkeypatch, piece):
    monkeypatch.setattr(ri, "PIECE", piece)
    rnd = random.Random(3)
    text = bytes(rnd.choices(b"abc", k=900)) + b"x" * 300 + b"Ndan " * 100
    other = [b"", b"z" * 99, text[:100], text[50:700]]
    h, first, end = ri.stretches([text, *other])
    whole = ri.stretches([text])
    alone = first < len(text) - 99
    assert all((x[alone] - o == y).all() for x, y, o in zip((h, first, end), whole, (0, 0, 0)))
    last = first >= len(text) + 199  # the same stretches wherever a text lies
    assert all((x == y).all() for x, y in zip(
        (h[last], first[last] - len(text) - 199, end[last] - len(text) - 199), ri.stretches([text[50:700]])))
    assert end[~alone].tolist()[0] == len(text) + 99 + 1 and end[-1] == len(text) + 99 + 100 + 650 - 99
    h, first, end = h[alone], first[alone], end[alone]
    assert first[0] == 0 and end[-1] == len(text) - 99 and (first[1:] == end[:-1]).all()
    assert (end - first).max() <= ri.LENGTH - ri.K + 1
    anchor = {}
    for a, f, e in zip(h, first, end):
        for i in range(f, e):  # equal windows have equal anchors
            assert anchor.setdefault(text[i:i + 100], a) == a
    assert ri.stretches([b"x" * 99])[0].size == 0 and ri.stretches([])[0].size == 0 and ri.stretches([b""])[0].size == 0


def corpus(rnd):
    vocab = ["".join(rnd.choices("abcdefghij ", k=rnd.randint(2, 9))) for _ in range(200)]
    def prose(n):
        return " ".join(rnd.choices(vocab, k=n))
    shared, line = [prose(40) for _ in range(4)], prose(30)
    texts = [None, "", "x" * 99, "x" * 100, "x" * 450, "Ndan " * 200, "Ndan " * 90 + "end", "é" * 300]
    for i in range(50):
        t = prose(rnd.randint(0, 80)) + (f" {i} {line} {i * 7} " if i % 3 == 0 else "") + prose(rnd.randint(0, 60))
        for s in rnd.sample(shared, rnd.randint(0, 2)):
            at = rnd.randint(0, len(t))
            t = t[:at] + s[rnd.randint(0, 60):] + t[at:]
        texts.append(t)
    for _ in range(12):  # near copies
        t = list(rnd.choice(texts[8:58]))
        for _ in range(2):
            t[rnd.randrange(len(t))] = "Q"
        texts.append("".join(t))
    texts += [texts[20], texts[30], texts[20]]
    return [(3 * i - 20, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("crowded,combined,chunk", [(20_000, 100_000, 1 << 20), (5, 40, 2000)])
def test_equals_brute_force(make_docs, monkeypatch, crowded, combined, chunk):
    rows = corpus(random.Random(crowded))
    docs = make_docs(rows[::-1]).withColumn("id", F.lit("clash")).withColumn("row", F.lit(0))
    monkeypatch.setattr(ri, "CROWDED", crowded)
    monkeypatch.setattr(ri, "COMBINED", combined)
    monkeypatch.setattr(ri, "CHUNK", chunk)
    got = {r.doc_id: r for r in ri.report(docs).collect()}
    for want in brute(rows):
        r = got.pop(want[0])
        assert (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want
    assert not got


def test_nulls_repeats_empty(make_docs):
    t = "".join(random.Random(1).choices("abcdef", k=400))
    got = ri.report(make_docs([(None, t), (4, t), (4, t), (9, "y" + t), (None, None)])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("4", 400), ("4", 400), ("9", 400), ("None", 0), ("None", 0)]
    assert ri.report(make_docs([])).count() == 0
