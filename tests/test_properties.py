"""Property tests: the column parsers agree with a direct model of the JVM string rules
(``String.split(char)`` dropping trailing empty items, ``String.trim`` stripping chars <= U+0020,
``Pattern.matches`` for titles) on random text. Each example is a batch of strings, one Spark job.
"""

import re

from hypothesis import given, settings
from pyspark.sql import functions as F
from hypothesis import strategies as st

from filmgraph.functions import text

ALPHABET = st.sampled_from(list("ab |,()\t\n\x01 9") + ["19", "(1999)", " (2001)", "\r"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=50, max_size=50)


def jvm_trim(s):
    i, j = 0, len(s)
    while i < j and s[i] <= " ":
        i += 1
    while j > i and s[j - 1] <= " ":
        j -= 1
    return s[i:j]


def jvm_split(s, sep):
    if sep not in s:
        return [s]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model_list(s, sep):
    return [jvm_trim(p) for p in jvm_split(s, sep)]


def model_name_notes(item):
    parts = [jvm_trim(p) for p in jvm_split(item.replace(")", ""), "(")]
    if len(parts) == 2:
        return parts[0], parts[1]
    if len(parts) == 1:
        return parts[0], None
    return item, None


# Java: '.' excludes line terminators, '\s' is [ \t\n\x0B\f\r], '\d' is [0-9]
_TITLE = re.compile(r"([^\n\r\u0085  ]*)[ \t\n\x0b\f\r]+\(([0-9]{4})\)")


def model_title(raw):
    t = jvm_trim(raw)
    m = _TITLE.fullmatch(t)
    return (m.group(1), int(m.group(2))) if m else (t, None)


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


@settings(max_examples=6, deadline=None)
@given(TEXTS)
def test_lists_match_the_jvm_model(spark, values):
    df = frame(spark, values).select("i", "s", text.parse_genres("s").alias("g"),
                                     text.parse_comma_list("s").alias("c"))
    for r in df.collect():
        assert r["g"] == model_list(r["s"], "|"), r["s"]
        assert r["c"] == model_list(r["s"], ","), r["s"]


@settings(max_examples=6, deadline=None)
@given(TEXTS)
def test_credits_match_the_jvm_model(spark, values):
    name, notes = text.parse_name_with_notes("s")
    df = frame(spark, values).select("s", name.alias("n"), notes.alias("o"))
    for r in df.collect():
        assert (r["n"], r["o"]) == model_name_notes(r["s"]), r["s"]


@settings(max_examples=6, deadline=None)
@given(TEXTS)
def test_titles_match_the_jvm_model(spark, values):
    title, year = text.parse_title_and_year("s")
    df = frame(spark, values).select("s", title.alias("t"), year.alias("y"))
    for r in df.collect():
        assert (r["t"], r["y"]) == model_title(r["s"]), repr(r["s"])


def test_model_sanity():
    assert jvm_split("a||", "|") == ["a"] and jvm_split("|||", "|") == []
    assert jvm_split("", "|") == [""] and model_title(" Toy Story (1995) ") == ("Toy Story", 1995)


# ---------------------------------------------------------------- numbers in API answers

import math  # noqa: E402

import numpy as np  # noqa: E402

from filmgraph.functions import omdb as J  # noqa: E402

NUM_UNITS = st.sampled_from(list("0123456789.,$ eE+-fd") + ["NaN", "Infinity", "nan", "inf",
                                                               "N/A", "12", "3.5"])
NUM_TEXTS = st.lists(st.lists(NUM_UNITS, max_size=6).map("".join), min_size=60, max_size=60)
_JVM_DECIMAL = re.compile(r"[+-]?(?:NaN|Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)"
                          r"(?:[eE][+-]?[0-9]+)?[fFdD]?)")


def model_parse_float(s):
    t = jvm_trim(s)
    if not _JVM_DECIMAL.fullmatch(t):
        return None
    t = t.rstrip("fFdD") if not t.endswith(("NaN", "Infinity")) else t
    with np.errstate(over="ignore"):
        return float(np.float32(float(t.replace("Infinity", "inf"))))


def model_money(s):
    return model_parse_float(re.sub(r"[^0-9.]+", "", s))


def model_count(s):
    d = re.sub(r"[^0-9.]+", "", s)
    if not re.fullmatch(r"[0-9]+", d) or int(d) > 2**63 - 1:
        return None
    return int(d)


def same(a, b):
    if a is None or b is None:
        return a is b
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return a == b


@settings(max_examples=6, deadline=None)
@given(NUM_TEXTS)
def test_number_fields_match_the_jvm_model(spark, values):
    df = frame(spark, values).select(
        "s", J.money(F.col("s")).alias("m"), J.count(F.col("s")).alias("c"),
        J.jvm_float(F.col("s")).alias("f"))
    for r in df.collect():
        assert same(r["m"], model_money(r["s"])), repr(r["s"])
        assert r["c"] == model_count(r["s"]), repr(r["s"])
        assert same(r["f"], model_parse_float(r["s"])), repr(r["s"])
