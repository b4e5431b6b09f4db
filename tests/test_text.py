"""Parsers as column expressions, with the reference's unit cases and the edge cases."""

import pytest
from pyspark.sql import functions as F

from filmgraph.functions import text


def one(spark, col_fn, value, schema="s string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col_fn(F.col("s")).alias("r")).first()["r"]


def title_year(spark, value):
    df = spark.createDataFrame([(value,)], "s string")
    t, y = text.parse_title_and_year("s")
    r = df.select(t.alias("t"), y.alias("y")).first()
    return r["t"], r["y"]


def test_title_reference_case(spark):
    assert title_year(spark, " Toy Story (1995) ") == ("Toy Story", 1995)


@pytest.mark.parametrize("raw,expected", [
    ("X (1990) (1995)", ("X (1990)", 1995)),        # greedy title
    ("A   (1995)", ("A  ", 1995)),                  # only one blank consumed
    ("(1995)", ("(1995)", None)),                   # blank before the year is required
    ("Foo (2006-2007)", ("Foo (2006-2007)", None)), # year range is not a year
    ("Foo (95)", ("Foo (95)", None)),
    ("Foo\n (1995)", ("Foo", 1995)),                # \s matches the newline
    ("Fo\no (1995)", ("Fo\no (1995)", None)),       # . does not cross a newline
    ("\t\x01 Heat (1995)\x1f ", ("Heat", 1995)),    # JVM trim strips control characters
    ("Heat", ("Heat", None)),
])
def test_title_edge_cases(spark, raw, expected):
    assert title_year(spark, raw) == expected


def test_genres_reference_case(spark):
    got = one(spark, text.parse_genres, " Adventure|  Animation|Children |Comedy|Fantasy    ")
    assert got == ["Adventure", "Animation", "Children", "Comedy", "Fantasy"]


@pytest.mark.parametrize("raw,expected", [
    ("a||", ["a"]),                 # trailing empties dropped
    ("a||b", ["a", "", "b"]),       # inner empty kept
    ("|a", ["", "a"]),              # leading empty kept
    ("a| |", ["a", ""]),            # drop happens before trim
    ("|||", []),                    # only separators
    ("", [""]),                     # empty input: one empty item
    ("Drama|Drama", ["Drama", "Drama"]),
    ("(no genres listed)", ["(no genres listed)"]),
])
def test_genres_edge_cases(spark, raw, expected):
    assert one(spark, text.parse_genres, raw) == expected


def test_null_genres_stay_null(spark):
    assert one(spark, text.parse_genres, None) is None


def test_comma_list_splits_inside_parentheses(spark):
    got = one(spark, text.parse_comma_list, "A (story, screenplay), B")
    assert got == ["A (story", "screenplay)", "B"]
    assert one(spark, text.parse_comma_list, "N/A") == ["N/A"]


def name_notes(spark, value):
    df = spark.createDataFrame([(value,)], "s string")
    n, t = text.parse_name_with_notes("s")
    r = df.select(n.alias("n"), t.alias("t")).first()
    return r["n"], r["t"]


@pytest.mark.parametrize("raw,expected", [
    ("John Lasseter (original story by)", ("John Lasseter", "original story by")),
    ("Tom Hanks", ("Tom Hanks", None)),
    ("(foo)", ("", "foo")),
    ("A (", ("A", None)),
    ("()", ("()", None)),
    ("A (b) (c)", ("A (b) (c)", None)),
    ("A ( ", ("A", "")),
    ("", ("", None)),
])
def test_name_with_notes(spark, raw, expected):
    assert name_notes(spark, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("1995", 1995), ("+7", 7), ("-3", -3), (" 7", None), ("1.0", None), ("", None),
    ("99999999999", None), ("abc", None),
])
def test_to_int(spark, raw, expected):
    assert one(spark, text.to_int, raw) == expected


def test_jvm_trim_and_imdb_ref(spark):
    assert one(spark, text.jvm_trim, "\x00\t a b \n\x20") == "a b"
    assert one(spark, text.jvm_trim, " x ") == " x "   # NBSP is not trimmed
    assert one(spark, text.imdb_ref, "0114709") == "tt0114709"


def test_to_float_narrows(spark):
    df = spark.createDataFrame([(3.5,), (0.1,)], "x double")
    got = [r[0] for r in df.select(text.to_float("x")).collect()]
    assert got[0] == 3.5 and abs(got[1] - 0.1) < 1e-7
    assert dict(df.select(text.to_float("x").alias("f")).dtypes)["f"] == "float"
