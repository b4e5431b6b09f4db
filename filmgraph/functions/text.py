"""Column-level parsers for titles, genre lists, credit lists and ids.

All of these are plain Column -> Column expressions (JVM-side, whole-stage codegen); none uses a
Python UDF. The splitting and trimming rules follow the JVM string methods the input format was
defined with:

* ``trim`` strips every character up to and including U+0020 from both ends, not only the space;
* splitting on one character drops trailing empty items (inner and leading ones stay), and an
  input made only of separators gives an empty list, while an empty input gives one empty item.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a JVM String.trim removes (U+0000 through U+0020).
JVM_TRIM_CHARS = "".join(chr(code) for code in range(0x00, 0x21))

# Fixed value: a title ends with a year in parentheses, e.g. "Toy Story (1995)".
TITLE_YEAR_PATTERN = r"\A(.*)\s+\((\d{4})\)\z"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _regex_literal(char: str) -> str:
    if len(char) != 1:
        raise ValueError("separator must be a single character")
    return char if char.isalnum() else "\\" + char


def jvm_trim(col: Column | str) -> Column:
    """Strip control characters and spaces from both ends."""
    return F.btrim(_c(col), F.lit(JVM_TRIM_CHARS))


def to_int(col: Column | str) -> Column:
    """Optional sign and ASCII digits to int; anything else (or overflow) to null."""
    c = _c(col)
    return F.when(c.rlike(r"\A[+-]?[0-9]+\z"), c.try_cast("int"))


def split_on(col: Column | str, sep: str) -> Column:
    """Split on one character with trailing empty items removed (no trimming)."""
    c = _c(col)
    q = _regex_literal(sep)
    only_separators = c.rlike(rf"\A(?:{q})+\z")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(c, rf"(?:{q})+\z", ""), q, -1))


def split_and_trim(col: Column | str, sep: str = ",") -> Column:
    """Split on ``sep`` then trim every item. A null input stays null."""
    return F.transform(split_on(col, sep), jvm_trim)


def parse_genres(col: Column | str) -> Column:
    """``"Adventure|Animation| Children "`` -> ``["Adventure", "Animation", "Children"]``.

    Duplicates are kept (each one is its own CATEGORIZED_AS edge); ``(no genres listed)`` is an
    ordinary genre name.
    """
    return split_and_trim(col, "|")


def parse_comma_list(col: Column | str, sep: str = ",") -> Column:
    """P5: comma list of credits/languages/countries. Commas inside parentheses split too."""
    return split_and_trim(col, sep)


def parse_title_and_year(col: Column | str) -> tuple[Column, Column]:
    """Trimmed raw title -> (title, year).

    The whole trimmed text must match ``<title><blanks>(<4 digits>)``; the title part is greedy,
    so ``"X (1990) (1995)"`` gives ``("X (1990)", 1995)`` and only one blank before the year is
    consumed. Without a match the trimmed text is the title and the year is null.
    """
    t = jvm_trim(col)
    # With both ends anchored there is at most one match: the replacement returns group 1 when
    # the title carries a year and the trimmed text unchanged otherwise.
    title = F.regexp_replace(t, TITLE_YEAR_PATTERN, "$1")
    year = to_int(F.regexp_extract(t, TITLE_YEAR_PATTERN, 2))
    return title, year


def name_parts(col: Column | str) -> Column:
    """The trimmed parts of a credit: every ``)`` dropped, split on ``(``."""
    return F.transform(split_on(F.replace(_c(col), F.lit(")"), F.lit("")), "("), jvm_trim)


def name_from_parts(item: Column, parts: Column) -> tuple[Column, Column]:
    """(name, notes) from a credit and its :func:`name_parts`."""
    n = F.size(parts)
    name = F.when((n == 1) | (n == 2), F.get(parts, 0)).otherwise(item)
    notes = F.when(n == 2, F.get(parts, 1))
    return name, notes


def parse_name_with_notes(col: Column | str) -> tuple[Column, Column]:
    """``"Name (notes)"`` -> (name, notes).

    Every ``)`` is dropped and the text split on ``(`` then trimmed: two parts give
    (name, notes), one part gives (name, null), none or more than two give the text unchanged
    and null notes.
    """
    return name_from_parts(_c(col), name_parts(col))


def imdb_ref(col: Column | str) -> Column:
    """The API's id form, ``"tt" + imdbId``."""
    return F.concat(F.lit("tt"), _c(col))


def to_float(col: Column | str) -> Column:
    """Narrow a double property to the graph's float type."""
    return _c(col).cast("float")
