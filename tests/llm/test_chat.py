import random

import duckdb
from pyspark.sql import functions as F

from tabsieve.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def twin(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(map(str, con.execute(chat.SQL).fetchall()))


def ours(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("clash")).withColumn("pos", F.lit(1)).repartition(3)
    return sorted(str(tuple(r)) for r in chat.collapse(df).collect())


def test_snapshots(spark):
    rnd = random.Random(2)
    rows = []
    for c in range(40):
        turns = [(["user", "assistant"][t % 2], rnd.choice(["hi", "yes", f"text {c} {t}"])) for t in range(rnd.randint(1, 9))]
        for k in range(rnd.randint(1, 4)):  # growing snapshots, some of them twice
            n = rnd.randint(1, len(turns))
            rows += [(1000 - 10 * c - k, t, r, x) for t, (r, x) in enumerate(turns[:n])]
    got = ours(spark, rows)
    assert got == twin(rows) and len(got) < 80
    assert ours(spark, rows + rows[::3]) == got  # repeated rows count once


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 1, None, None), (1, None, "system", ""), (2, 0, "user", "a"), (2, 0, "user", "b"),
            (3, 5, "user", "a"), (4, 7, "user", "a"), (4, 9, "assistant", "x" * 100000), (5, 0, "user", None),
            (6, 0, "user", ""), (7, 0, None, "a")]
    assert ours(spark, rows) == twin(rows)
    assert ours(spark, []) == []


def test_null_conversation_and_blocks(spark):
    rows = [(None, t, "user", f"t{t}") for t in range(3)] + [(8, t, "user", f"t{t}") for t in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.conv_id, r.n_turns, r.part): r.rendered for r in chat.collapse(df).collect()}
    assert set(got) == {(8, 3000, 0), (8, 3000, 1), (8, 3000, 2)}  # the NULL one is a prefix of 8
    assert "".join(got[8, 3000, p] for p in range(3)) == "".join(
        f"<|im_start|>user\nt{t}<|im_end|>\n" for t in range(3000))
    alone = chat.collapse(df.filter("conv_id IS NULL")).collect()
    assert [(r.conv_id, r.n_turns) for r in alone] == [(None, 3)]


def test_few_turn_numbers_are_spread(spark):
    """Rows without conversation id, of few or NULL turn numbers, are dealt over many blocks, in order."""
    rnd = random.Random(7)
    rows = [(None, rnd.choice([None, 1, 2, 3]), rnd.choice([None, "user", "assistant"]),
             "".join(rnd.choices("aZ\u00e9\u4e2d \U0001f600", k=rnd.randint(0, 12))) + str(i)) for i in range(6000)]
    rows += [(c, t, "user", f"c{c} t{t}") for c in range(1000) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows_of = [(r.turn, r.role, r.text, r.block) for r in chat.blocks(df).filter("conv_id IS NULL").collect()]
        biggest = max(sum(r[3] == b for r in rows_of) for b in {r[3] for r in rows_of})
        assert len(rows_of) == 6000 and biggest < 2500, biggest
        rows_of.sort(key=lambda r: [(x is not None, x.encode() if isinstance(x, str) else x or 0) for x in r[:3]])
        assert [r[3] for r in rows_of] == sorted(r[3] for r in rows_of)
        assert ours(spark, rows) == twin(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
