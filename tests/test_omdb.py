"""API answers -> parsed records."""

import json

import pytest

from filmgraph.operators import responses
from filmgraph.operators.edges import credit_items

# One answer whose parsed fields are known.
FIXED_FIELDS = {
    "Rated": "G",
    "Director": "John Lasseter",
    "Writer": "John Lasseter (original story by), Pete Docter (original story by), "
              "Andrew Stanton (original story by), Joe Ranft (original story by), "
              "Joss Whedon (screenplay by), Andrew Stanton (screenplay by), "
              "Joel Cohen (screenplay by), Alec Sokolow (screenplay by)",
    "Actors": "Tom Hanks, Tim Allen, Don Rickles, Jim Varney",
    "Language": "English", "Country": "USA", "BoxOffice": "N/A", "Metascore": "95",
    "imdbRating": "8.3", "imdbVotes": "860,790", "Response": "True"}
# What an answer holds besides is not read: any other fields will do.
REFERENCE_ANSWER = json.dumps({"Title": "A title", "Plot": "Some \"quoted\" plot.",
                               "Ratings": [{"Source": "x", "Value": "1/10"}], **FIXED_FIELDS})


def classify(spark, *answers):
    rows = [(str(i + 1), f"{i + 1:07d}", a) for i, a in enumerate(answers)]
    df = spark.createDataFrame(rows, "movieId string, imdbId string, response string")
    return responses.classify(df)


def test_reference_answer(spark):
    r = responses.records(classify(spark, REFERENCE_ANSWER)).first()
    assert r["rated"] == "G"
    assert r["directors"] == ["John Lasseter"]
    assert r["writers"] == [
        "John Lasseter (original story by)", "Pete Docter (original story by)",
        "Andrew Stanton (original story by)", "Joe Ranft (original story by)",
        "Joss Whedon (screenplay by)", "Andrew Stanton (screenplay by)",
        "Joel Cohen (screenplay by)", "Alec Sokolow (screenplay by)"]
    assert r["actors"] == ["Tom Hanks", "Tim Allen", "Don Rickles", "Jim Varney"]
    assert r["languages"] == ["English"] and r["countries"] == ["USA"]
    assert r["boxOffice"] is None
    assert r["metascore"] == 95.0
    assert r["imdbScore"] == pytest.approx(8.3, abs=1e-6)
    assert r["imdbVotes"] == 860790
    assert r["movieId"] == 1 and r["imdbId"] == "0000001"


def test_failure_answer_has_no_fields(spark):
    r = classify(spark, '{"Response":"False"}').first()
    assert r["status"] == "failure"
    for f in ("rated", "directors", "writers", "actors", "languages", "countries",
              "boxOffice", "metascore", "imdbScore", "imdbVotes"):
        assert r[f] is None
    assert responses.records(classify(spark, '{"Response":"False"}')).count() == 0


@pytest.mark.parametrize("answer,status", [
    (None, "unfetched"),
    ("{bad", "malformed"),
    ("[1, 2]", "malformed"),
    ('"text"', "malformed"),
    ("{}", "malformed"),                                   # no Response key
    ('{"Title":"x"}', "malformed"),
    ('{"Response":false}', "ok"),                          # boolean false is not a failure
    ('{"Response":null}', "ok"),                           # present, JSON null
    ('{"Response":"False","Error":"Incorrect IMDb ID."}', "failure"),
    ('{"Response":"True"}', "ok"),
])
def test_status(spark, answer, status):
    assert classify(spark, answer).first()["status"] == status


def field(spark, answer, name):
    return responses.records(classify(spark, answer)).first()[name]


@pytest.mark.parametrize("value,expected", [
    ('5', None), ('"PG-13"', "PG-13"), ('true', None), ('null', None), ('"N/A"', "N/A"),
])
def test_rated_must_be_a_json_string(spark, value, expected):
    assert field(spark, '{"Rated":%s,"Response":"True"}' % value, "rated") == expected


@pytest.mark.parametrize("value,expected", [
    ("$1,234,567", 1234567.0), ("N/A", None), ("", None), ("$.5M", 0.5), ("1.2.3", None),
    ("EUR 3", 3.0),
])
def test_box_office(spark, value, expected):
    got = field(spark, json.dumps({"BoxOffice": value, "Response": "True"}), "boxOffice")
    assert got == (pytest.approx(expected) if expected is not None else None)


@pytest.mark.parametrize("value,expected", [
    ("95", 95.0), ("8.3f", 8.3), (" 7 ", 7.0), ("N/A", None), ("NaN", "nan"), ("nan", None),
    ("Infinity", float("inf")), ("inf", None), ("1e2", 100.0), (".5", 0.5), ("5.", 5.0),
])
def test_metascore_follows_jvm_float_parsing(spark, value, expected):
    got = field(spark, json.dumps({"Metascore": value, "Response": "True"}), "metascore")
    if expected == "nan":
        assert got != got
    elif expected is None:
        assert got is None
    else:
        assert got == pytest.approx(expected, rel=1e-6)


@pytest.mark.parametrize("value,expected", [
    ("860,790", 860790), ("1.5", None), ("N/A", None), ("12 345", 12345),
    ("99999999999999999999", None),
])
def test_votes(spark, value, expected):
    assert field(spark, json.dumps({"imdbVotes": value, "Response": "True"}),
                 "imdbVotes") == expected


def test_numbers_in_string_fields_are_ignored(spark):
    r = responses.records(classify(
        spark, '{"Metascore":95,"imdbVotes":1000,"Director":7,"Response":"True"}')).first()
    assert r["metascore"] is None and r["imdbVotes"] is None and r["directors"] is None


def test_duplicate_keys_last_wins(spark):
    assert field(spark, '{"Rated":"G","Rated":"R","Response":"True"}', "rated") == "R"


def test_bad_movie_id_is_malformed(spark):
    df = spark.createDataFrame([("x1", "0000001", '{"Response":"True"}')],
                               "movieId string, imdbId string, response string")
    assert responses.classify(df).first()["status"] == "malformed"


def test_counters_and_entity_counts(spark):
    c = classify(spark, REFERENCE_ANSWER, '{"Response":"False"}', None, "{bad")
    counts = {r["metric"]: r["n"] for r in responses.status_counts(c).collect()}
    assert counts == {"parse_successes": 1, "parse_failures": 1, "unfetched": 1, "malformed": 1}
    observed, obs = responses.observe_counts(c)
    observed.count()
    assert obs.get == {"parse_successes": 1, "parse_failures": 1, "malformed": 1, "unfetched": 1}
    ents = {r["kind"]: (r["n_raw"], r["n_names"])
            for r in responses.entity_counts(credit_items(responses.records(c))).collect()}
    # 8 distinct raw writer credits naming 7 distinct people (one wrote story and screenplay)
    assert ents["writers"] == (8, 7)
    assert ents["directors"] == (1, 1) and ents["actors"] == (4, 4)


def test_approximate_entity_counts(spark):
    c = classify(spark, REFERENCE_ANSWER)
    approx = {r["kind"]: (r["n_raw"], r["n_names"]) for r in responses.entity_counts(
        credit_items(responses.records(c)), approximate=True).collect()}
    assert approx["writers"] == (8, 7) and approx["actors"] == (4, 4)


def test_parsing_does_not_depend_on_ansi_mode(spark):
    answer = json.dumps({"BoxOffice": "$1,234", "Metascore": "nan", "imdbVotes": "1.5",
                         "imdbRating": "8.3f", "Response": "True"})
    results = []
    previous = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            r = responses.records(classify(spark, answer, "{bad")).first()
            results.append((r["boxOffice"], r["metascore"], r["imdbVotes"], r["imdbScore"]))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", previous)
    assert results[0] == results[1]
    assert results[0][:3] == (1234.0, None, None)
