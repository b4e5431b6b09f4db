"""Search predicates over graph properties (Q5-Q9), as Column expressions.

Exact-match and range predicates are plain comparisons that Catalyst pushes into the Parquet scan.
Text predicates follow the usual full-text index conventions: a text value is tokenised by
lower-casing and splitting on anything that is not a letter or a digit; ``text_contains*`` test
single tokens, ``text_prefix`` / ``text_regex`` test the whole (untokenised) value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: token separator of the text index (anything but a letter or a digit).
TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(col: Column | str) -> Column:
    """Lower-cased tokens of a text value (empty tokens removed)."""
    parts = F.split(F.lower(_c(col)), TOKEN_SEPARATOR, -1)
    return F.filter(parts, lambda t: t != "")


def text_contains(col: Column | str, word: str, is_set: bool = False) -> Column:
    """Some token equals ``word`` (case-insensitive)."""
    w = word.lower()
    if is_set:
        return F.exists(_c(col), lambda v: F.array_contains(tokens(v), w))
    return F.array_contains(tokens(col), w)


def text_contains_prefix(col: Column | str, prefix: str, is_set: bool = False) -> Column:
    """Some token starts with ``prefix`` (case-insensitive)."""
    p = prefix.lower()
    if is_set:
        return F.exists(_c(col), lambda v: F.exists(tokens(v), lambda t: t.startswith(p)))
    return F.exists(tokens(col), lambda t: t.startswith(p))


def text_contains_regex(col: Column | str, pattern: str, is_set: bool = False) -> Column:
    """Some token fully matches ``pattern``."""
    anchored = rf"\A(?:{pattern})\z"
    if is_set:
        return F.exists(_c(col), lambda v: F.exists(tokens(v), lambda t: t.rlike(anchored)))
    return F.exists(tokens(col), lambda t: t.rlike(anchored))


def _some(col: Column | str, test, is_set: bool) -> Column:
    return F.exists(_c(col), test) if is_set else test(_c(col))


def text_prefix(col: Column | str, prefix: str, is_set: bool = False) -> Column:
    """The whole value starts with ``prefix`` (case-sensitive)."""
    return _some(col, lambda v: v.startswith(prefix), is_set)


def text_regex(col: Column | str, pattern: str, is_set: bool = False) -> Column:
    """The whole value fully matches ``pattern``."""
    return _some(col, lambda v: v.rlike(rf"\A(?:{pattern})\z"), is_set)


def text_substring(col: Column | str, text: str, is_set: bool = False) -> Column:
    """The value holds ``text`` (case-sensitive)."""
    return _some(col, lambda v: v.contains(text), is_set)


def _lit(value, dtype) -> Column:
    """A literal of the property's type: a float property compared with 8.7 must meet the float
    nearest to 8.7, not the double."""
    return F.lit(value) if dtype is None else F.lit(value).cast(dtype)


def equal(col: Column | str, value, dtype=None) -> Column:
    return _c(col) == _lit(value, dtype)


def between(col: Column | str, low, high, dtype=None) -> Column:
    """Inclusive lower bound, exclusive upper bound (``low <= x < high``)."""
    c = _c(col)
    return (c >= _lit(low, dtype)) & (c < _lit(high, dtype))


def inside(col: Column | str, low, high, dtype=None) -> Column:
    c = _c(col)
    return (c > _lit(low, dtype)) & (c < _lit(high, dtype))


def outside(col: Column | str, low, high, dtype=None) -> Column:
    c = _c(col)
    return (c < _lit(low, dtype)) | (c > _lit(high, dtype))


def within(col: Column | str, values: Iterable, dtype=None) -> Column:
    return _c(col).isin([_lit(v, dtype) for v in values])


def without(col: Column | str, values: Iterable, dtype=None) -> Column:
    return ~within(col, values, dtype)


def set_contains(col: Column | str, value) -> Column:
    """Q3: a SET property holds ``value``."""
    return F.array_contains(_c(col), value)
