"""Scalar Column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
# Leading articles stripped from titles, tried in this order, first match only:
TITLE_ARTICLES = ["the", "a", "an", "le", "la", "les", "il", "lo", "die"]
# Strings read as a true flag (compared after lower-casing):
TRUTHY = ["true", "1", "yes"]
# Missing-value sentinel of the raw CSV files:
NULL_SENTINEL = "\\N"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_int(x: Column | str, sentinel: str | None = NULL_SENTINEL) -> Column:
    """Sentinel -> NULL, then a safe cast to INT that rounds decimals half-even
    ('12.7' -> 13) like a lenient SQL cast; junk -> NULL."""
    s = _c(x).cast("string")
    if sentinel is not None:
        s = F.nullif(s, F.lit(sentinel))
    return F.rint(s.try_cast("double")).try_cast("int")


def parse_double(x: Column | str, sentinel: str | None = NULL_SENTINEL) -> Column:
    s = _c(x).cast("string")
    if sentinel is not None:
        s = F.nullif(s, F.lit(sentinel))
    return s.try_cast("double")


def winsorize(x: Column | str, lo: float | None, hi: float | None,
              null_policy: str = "keep") -> Column:
    """Clamp to [lo, hi].  ``null_policy='keep'`` leaves NULL as NULL (the
    intended reading); ``'floor'`` reproduces LEAST(GREATEST(NULL, lo), hi) = lo,
    because LEAST/GREATEST skip NULLs."""
    c = _c(x)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if null_policy == "keep":
        return F.when(c.isNull(), F.lit(None)).otherwise(out)
    if null_policy == "floor":
        return out
    raise ValueError(null_policy)


def time_bucket(year: Column | str, width: int, compat: bool = False) -> Column:
    """Bucket start of ``year``.  ``compat=True`` is ``year / width * width``
    with float division, i.e. the exact year."""
    y = _c(year)
    if compat:
        return y / F.lit(width) * F.lit(width)
    return (F.floor(y / F.lit(width)) * F.lit(width)).cast("int")


def round_half_even_int(x: Column | str) -> Column:
    """DOUBLE -> INT rounding half to even (94.5 -> 94, 95.5 -> 96)."""
    return F.rint(_c(x)).try_cast("int")


def safe_ratio(num: Column | str, den: Column | str, floor: float = 1.0) -> Column:
    return _c(num) / F.greatest(_c(den), F.lit(floor))


def age_from_year(year: Column | str, ref_year: int, compat: bool = False) -> Column:
    """GREATEST(ref - year, 1); NULL year stays NULL unless ``compat``."""
    y = _c(year)
    out = F.greatest(F.lit(ref_year) - y, F.lit(1))
    return out if compat else F.when(y.isNull(), F.lit(None)).otherwise(out)


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN 1 ELSE 0 END (NULL condition -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def differs_flag(a: Column | str, b: Column | str) -> Column:
    a, b = _c(a), _c(b)
    return flag(a.isNotNull() & (a != F.lit("")) & (a != b))


WHITE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"


def strip(x: Column | str) -> Column:
    """Text without white space at its ends: line ends, tabs and no-break spaces too."""
    return F.btrim(_c(x).cast("string"), F.lit(WHITE))


def canonical_id(x: Column | str, prefix: str = "tt", width: int = 7) -> Column:
    """Digits, an integer, a whole number written with a decimal point, or an
    id that has the prefix already -> ``tt%07d``; anything else, or NULL, ->
    NULL.  Ids longer than the width keep all digits."""
    s = strip(x)
    digits = F.regexp_extract(s, rf"^(?i:{prefix})?([0-9]+)(?:\.0*)?$", 1)
    n = F.when(digits != "", digits.try_cast("long"))
    return F.when(n.isNotNull(), F.format_string(f"{prefix}%0{width}d", n))


def label_int(x: Column | str) -> Column:
    """Boolean or 'True'/'False' string label -> 0/1."""
    return flag(F.lower(_c(x).cast("string")) == F.lit("true"))


def truthy(x: Column | str) -> Column:
    return F.lower(_c(x).cast("string")).isin(TRUTHY)


def title_norm(x: Column | str) -> Column:
    """lower, :func:`strip`, drop one leading article (first in list order); NULL -> ''."""
    pattern = "^(" + "|".join(TITLE_ARTICLES) + ") "
    return F.coalesce(F.regexp_replace(strip(F.lower(_c(x))), pattern, ""), F.lit(""))


# Blanks and hyphens become underscores, parentheses go.
SLUG_FROM, SLUG_TO = " -()", "__"
SLUG_TABLE = {ord(c): SLUG_TO[i] if i < len(SLUG_TO) else None for i, c in enumerate(SLUG_FROM)}


def slug(x: Column | str, prefix: str = "") -> Column:
    """'oscar (best picture)' -> 'oscar_best_picture', 'feel-good' -> 'feel_good'."""
    s = F.translate(F.lower(_c(x)), SLUG_FROM, SLUG_TO)
    return F.concat(F.lit(prefix), s) if prefix else s


def slug_name(name: str, prefix: str = "") -> str:
    """:func:`slug` of a Python string, for naming columns."""
    return prefix + name.lower().translate(SLUG_TABLE)


def null_out(cols: list[str], cond: Column) -> list[Column]:
    """Set ``cols`` to NULL where ``cond`` is true; a NULL condition keeps values."""
    return [F.when(cond, F.lit(None)).otherwise(F.col(c)).alias(c) for c in cols]


def multi_hot(x: Column | str, values: list[str], prefix: str = "genre_",
              sep: str = "|", mode: str = "token") -> list[Column]:
    """One 0/1 column per value.  ``mode='token'`` matches whole items of the
    delimited string; ``'contains'`` matches substrings (case-sensitive)."""
    c = _c(x)
    items = F.split(c, "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep)
    out = []
    for v in values:
        hit = F.array_contains(items, v) if mode == "token" else c.contains(v)
        out.append(F.coalesce(hit.cast("int"), F.lit(0)).alias(slug_name(v, prefix)))
    return out


def item_count(x: Column | str, sep: str = "|") -> Column:
    """Number of delimited items; NULL -> 0."""
    pat = "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep
    return F.coalesce(F.regexp_count(_c(x), F.lit(pat)) + F.lit(1), F.lit(0)).cast("int")


def year_of(x: Column | str) -> Column:
    """Year of a date string (or date/timestamp); unparsable -> NULL."""
    c = _c(x)
    return F.year(F.try_to_timestamp(c.cast("string"))).cast("int")
