"""Text fold: repair UTF-8-read-as-Latin-1 damage, lower, strip, NFKD, drop
combining marks.  Spark has no NFKD, so this is one Arrow-batched pandas UDF;
everything around it stays native."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Signatures of UTF-8 text decoded as a single-byte code page.
MOJIBAKE_MARKERS = ["Ã", "â€", "Â"]


def repair_mojibake(s: str) -> str:
    """Undo one round of UTF-8 bytes decoded as cp1252 / latin-1.  Strict:
    if the round trip fails or changes nothing readable, keep the input."""
    if not any(m in s for m in MOJIBAKE_MARKERS):
        return s
    for enc in ("cp1252", "latin-1"):
        try:
            fixed = s.encode(enc, errors="strict").decode("utf-8", errors="strict")
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if fixed != s:
            return fixed
    return s


def fold_text(s: str | None) -> str | None:
    if s is None:
        return None
    t = repair_mojibake(str(s)).lower().strip()
    t = unicodedata.normalize("NFKD", t)
    return "".join(ch for ch in t if not unicodedata.combining(ch))


@F.pandas_udf(T.StringType())
def _fold_unicode(s: pd.Series) -> pd.Series:
    return s.map(fold_text, na_action="ignore")


def text_fold(c: Column | str) -> Column:
    """:func:`fold_text` of a column; plain ASCII, most text, never leaves the JVM."""
    x = (F.col(c) if isinstance(c, str) else c).cast("string")
    other = x.rlike(r"[^\x00-\x7F]")
    # Python's strip also takes the separators \x1c-\x1f
    plain = F.btrim(F.lower(x), F.lit(" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"))
    return F.when(other, _fold_unicode(F.when(other, x))).otherwise(plain)


@F.pandas_udf(T.BooleanType())
def mojibake_repaired_udf(s: pd.Series) -> pd.Series:
    """True where the strict round trip changed the text."""
    return s.map(lambda v: v is not None and repair_mojibake(v) != v).astype(bool)


def has_mojibake(col):
    c = F.col(col) if isinstance(col, str) else col
    cond = None
    for m in MOJIBAKE_MARKERS:
        h = c.contains(m)
        cond = h if cond is None else cond | h
    return F.coalesce(cond, F.lit(False))
