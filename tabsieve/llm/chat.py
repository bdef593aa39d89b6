"""Chat formatting: logged snapshots collapse to maximal conversations, which
are then rendered.

Chat logs often hold a conversation again and again as it grows.  Every turn
gets the rolling hash of the conversation up to it: the sum, over the turns so
far, of a hash of (position, role, text), in two lanes of 60 bits.  A
conversation whose hash at its last turn is some other conversation's hash at
an inner turn is a prefix of it; two anti joins, on (length, hash), keep

* of equal conversations the one of the least id, and
* of those only the ones that no longer conversation continues.

Sums, unlike chained digests, can be formed in pieces: the turns, in the order
of conversation, turn, role and first ``PREFIX`` characters of the text, are
dealt into as many ranges of about equal size as Spark has shuffle partitions,
and a conversation is summed range by range.  So one with a third of all turns
is spread over tasks, also if its turn numbers are few or NULL; only different
texts of one conversation, turn and role that start with the same ``PREFIX``
characters are in one range.  Rendering gives parts of ``PART`` turns for the same
reason.  Prefix hashes are de-duplicated map-side before the anti join: a
first turn that a third of the conversations share is one row per task.

Defined cases: rows equal in conversation, turn, role and text count once;
turns are ordered by (turn, role, text), NULL first; NULL ids are one
conversation; NULL roles and texts differ from empty ones, and render as
"user" and as empty; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import sorted_prefix
from ..session import cut_lineage
from .common import written

PREFIX, PART = 64, 1024
COLUMNS = ["conv_id", "turn", "role", "text"]


def _lane(n: int) -> Column:
    """60 bits of a hash of (position, role, text)."""
    digest = F.md5(F.to_json(F.struct("pos", "role", "text")))
    return F.conv(F.substring(digest, 15 * n + 1, 15), 16, 10).cast("decimal(20,0)")


def blocks(turns: DataFrame) -> DataFrame:
    """The distinct turns with ``at`` (turn, least where NULL) and ``block``, the
    number of their range: it does not fall in the order of (at, role, text)."""
    t = turns.select(*COLUMNS).dropDuplicates()
    t = t.withColumn("at", F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))))
    # written, so that a row has the same number whenever it is read
    return written(t.repartitionByRange("conv_id", "at", "role", F.substring("text", 1, PREFIX))
                   .withColumn("block", F.spark_partition_id()))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, role, text, n (1-based position) and the prefix hash (h0, h1) per turn."""
    t, block = blocks(turns), F.col("block")
    t = sorted_prefix(t, "conv_id", "at", {"pos": F.lit(1)}, tie_cols=["role", "text"], bucket=block)
    t = t.withColumn("l0", _lane(0)).withColumn("l1", _lane(1))
    t = sorted_prefix(t, "conv_id", "at", {"b0": "l0", "b1": "l1"}, tie_cols=["role", "text"], bucket=block)
    return t.select("conv_id", "role", "text", (F.col("pos") + 1).cast("long").alias("n"),
                    *[(F.col(f"b{k}") + F.col(f"l{k}")).cast("decimal(38,0)").alias(f"h{k}") for k in (0, 1)])


def maximal(rows: DataFrame) -> DataFrame:
    """conv_id, n (turns), n_copies (equal conversations) of the conversations
    kept, from the rows of :func:`prefixes`."""
    ends = rows.groupBy("conv_id").agg(F.max("n").alias("n")) \
        .select(F.col("conv_id").alias("c"), F.col("n").alias("last"))
    at_end = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("n") == F.col("last"))
    whole = rows.select("conv_id", "n", "h0", "h1").join(ends, at_end, "left_semi") \
        .groupBy("n", "h0", "h1").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = rows.select("conv_id", "n", "h0", "h1").join(ends, at_end, "left_anti") \
        .select("n", "h0", "h1").distinct()
    return whole.join(inner, ["n", "h0", "h1"], "left_anti").select("conv_id", "n", "n_copies")


def render(rows: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, role, text, n) -> conv_id, part, rendered: ChatML text of
    every ``part`` consecutive turns."""
    turn = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("user")), F.lit("\n"),
                    F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))
    parts = rows.select("conv_id", F.floor((F.col("n") - 1) / part).cast("long").alias("part"),
                        F.struct("n", turn.alias("s")).alias("t"))
    return parts.groupBy("conv_id", "part").agg(F.array_join(
        F.transform(F.sort_array(F.collect_list("t")), lambda t: t["s"]), "").alias("rendered"))


def collapse(turns: DataFrame) -> DataFrame:
    """The maximal conversations, rendered: conv_id, n_turns, n_copies, part, rendered."""
    rows = cut_lineage(prefixes(turns))
    kept = cut_lineage(maximal(rows)).select(F.col("conv_id").alias("c"), F.col("n").alias("n_turns"), "n_copies")
    mine = rows.select("conv_id", "role", "text", "n").join(
        kept.select("c"), F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    return render(mine).join(kept, F.col("conv_id").eqNullSafe(F.col("c"))) \
        .select("conv_id", "n_turns", "n_copies", "part", "rendered")


SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
s AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS s
      FROM t GROUP BY conv_id),
kept AS (SELECT a.* FROM s a WHERE NOT EXISTS (
           SELECT 1 FROM s o WHERE o.s[1] = a.s[1] AND (
             (len(o.s) > len(a.s) AND o.s[1:len(a.s)] = a.s) OR (o.s = a.s AND o.conv_id < a.conv_id)))),
copies AS (SELECT s, count(*) AS n FROM s GROUP BY s),
turns AS (SELECT conv_id, s, unnest(s) AS x, generate_subscripts(s, 1) AS i FROM kept)
SELECT conv_id, len(any_value(turns.s))::BIGINT AS n_turns, any_value(copies.n) AS n_copies,
       ((i - 1) // {PART})::BIGINT AS part,
       string_agg('<|im_start|>' || coalesce(x.r, 'user') || chr(10) || coalesce(x.t, '') || '<|im_end|>' || chr(10),
                  '' ORDER BY i) AS rendered
FROM turns JOIN copies ON turns.s = copies.s GROUP BY conv_id, (i - 1) // {PART}"""
