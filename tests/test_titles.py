"""Keys made of titles and ids: white space of any kind at the ends does not count."""

from tabsieve.functions import scalar as S
from tabsieve.operators import joins


def test_white_space_at_the_ends(spark):
    rows = [("The Film",), ("  The Film\t",), ("\nThe Film\r\n",), (" The Film\x0b",), ("The  Film",), (" \t",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    assert [r[0] for r in df.select(joins.title_key("t")).collect()] == ["the film"] * 4 + ["the  film", "", None]
    assert [r[0] for r in df.select(S.title_norm("t")).collect()] == ["film"] * 4 + [" film", "", ""]


def test_ids_with_line_ends(spark):
    df = spark.createDataFrame([("12\n",), ("\ttt0000012",), (" 12.0\r\n",), ("1 2",)], "t string")
    assert [r[0] for r in df.select(S.canonical_id("t")).collect()] == ["tt0000012"] * 3 + [None]


def test_public_names_exist():
    assert all(hasattr(joins, n) for n in joins.__all__)
