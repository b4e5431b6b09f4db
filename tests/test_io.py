"""Dataset readers, CSV dialect, declared schemas, bad-row modes, JSON sink."""

import os

import pytest
from pyspark.errors import AnalysisException

from filmgraph.sources import dataset as io


def write_file(root, name, text):
    path = os.path.join(root, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_doubled_quotes_stay_in_the_title(spark, tmp_root):
    write_file(tmp_root, "movies.csv",
               'movieId,title,genres\n'
               '1,"Foo, ""Bar"", The (1999)",Comedy|Drama\n'
               '2,  Padded (2001)  ,Action\n')
    rows = {r["movieId"]: r for r in io.read_movies(spark, tmp_root).collect()}
    assert rows[1]["title"] == 'Foo, "Bar", The (1999)'
    assert rows[1]["genres"] == "Comedy|Drama"
    assert rows[2]["title"] == "  Padded (2001)  "       # blanks are data
    assert dict(io.read_movies(spark, tmp_root).dtypes)["movieId"] == "bigint"


def test_columns_are_matched_by_header_name(spark, tmp_root):
    write_file(tmp_root, "ratings.csv",
               "timestamp,rating,movieId,userId\n1112486027,3.5,2,1\n")
    r = io.read_ratings(spark, tmp_root).first()
    assert (r["userId"], r["movieId"], r["rating"], r["timestamp"]) == (1, 2, 3.5, 1112486027)


def test_links_keep_leading_zeros_and_optional_tmdb(spark, tmp_root):
    write_file(tmp_root, "links.csv", "movieId,imdbId,tmdbId\n1,0114709,862\n2,0113497,\n")
    rows = {r["movieId"]: r for r in io.read_links(spark, tmp_root).collect()}
    assert rows["1"]["imdbId"] == "0114709" and rows["1"]["tmdbId"] == "862"
    assert rows["2"]["tmdbId"] is None


def test_missing_column_is_an_error(spark, tmp_root):
    write_file(tmp_root, "genome-tags.csv", "tagId,name\n1,007\n")
    with pytest.raises(ValueError, match="tag"):
        io.read_genome_tags(spark, tmp_root)


def test_fail_mode_stops_on_bad_value(spark, tmp_root):
    write_file(tmp_root, "ratings.csv", "userId,movieId,rating,timestamp\n1,2,x,5\n")
    with pytest.raises(Exception, match="bad rating"):
        io.read_ratings(spark, tmp_root).collect()


def test_fail_mode_stops_on_null_title(spark, tmp_root):
    write_file(tmp_root, "movies.csv", "movieId,title,genres\n1,,Drama\n")
    with pytest.raises(Exception, match="missing title"):
        io.read_movies(spark, tmp_root).collect()


def test_quarantine_mode_keeps_bad_rows_aside(spark, tmp_root):
    write_file(tmp_root, "ratings.csv",
               "userId,movieId,rating,timestamp\n1,2,4.0,5\n1,x,3.0,6\n,3,2.0,7\n")
    df = io.read_ratings(spark, tmp_root, mode="quarantine")
    assert [tuple(r) for r in io.accepted(df).collect()] == [(1, 2, 4.0, 5)]
    errors = sorted(r["_error"] for r in io.rejected(df).collect())
    assert errors == ["bad movieId", "missing userId"]


def test_json_answers_with_declared_schema(spark, tmp_root):
    # Every answer null: the JSON writer drops the field, the declared schema keeps it.
    df = spark.createDataFrame([("1", "0000001", None)],
                               "movieId string, imdbId string, response string")
    io.write_omdb_responses(df, io.dataset_path(tmp_root, "omdb"))
    back = io.read_omdb_responses(spark, tmp_root)
    assert back.columns == ["movieId", "imdbId", "response"]
    assert back.first()["response"] is None


def test_json_sink_refuses_existing_path(spark, tmp_root):
    df = spark.createDataFrame([("1", "0000001", "{}")],
                               "movieId string, imdbId string, response string")
    path = io.dataset_path(tmp_root, "omdb")
    io.write_omdb_responses(df, path)
    with pytest.raises(AnalysisException):
        io.write_omdb_responses(df, path)


def test_dataset_layout_paths():
    assert io.dataset_path("s3a://b/ml/", "genome_scores") == "s3a://b/ml/genome-scores.csv"
    assert io.dataset_path("/data/ml", "omdb") == "/data/ml/omdb-json"


def test_csv_writer_round_trip_keeps_blanks_and_quotes(spark, tmp_root):
    df = spark.createDataFrame([(1, '  A "quoted", title (1990)  ', " x | y|")],
                               "movieId int, title string, genres string")
    io.write_csv(df, io.dataset_path(tmp_root, "movies"))
    r = io.read_movies(spark, tmp_root).first()
    assert r["title"] == '  A "quoted", title (1990)  ' and r["genres"] == " x | y|"
