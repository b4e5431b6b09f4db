"""Planted faults end to end: the load jobs in ``fail`` and ``quarantine`` mode."""

import os
import tempfile

import pytest

from filmgraph.operators.integrity import IntegrityError
from filmgraph.plans import load
from filmgraph.sources import graphstore as G

GOOD_ANSWER = ('{"Rated":"PG","Director":"Ann Lee",'
               '"Writer":"Bo Kim (story by), Bo Kim (screenplay)",'
               '"Actors":"Cy Day, Di Fox","Language":"English","Country":"France",'
               '"BoxOffice":"$1,000","Metascore":"70","imdbRating":"7.5","imdbVotes":"1,234",'
               '"Response":"True"}')

FILES = {
    "movies.csv": [
        "movieId,title,genres",
        "1,Toy Story (1995),Adventure|Animation",
        '2,"Foo, ""Bar"", The (1999)",Comedy',        # doubled quotes: a valid title
        "3,,Drama",                                  # null title
        "4,Heat (1995),Action|Crime",
        "4,Heat again (1995),Action",                # movie id twice
        "5,Up (2009),Animation",
    ],
    "ratings.csv": [
        "userId,movieId,rating,timestamp",
        "10,1,4.0,100", "10,2,3.5,101", "11,5,5.0,102",
        "12,999,1.0,103",                            # rating of an absent movie
        "13,1,x,104",                                # unreadable rating
    ],
    "genome-tags.csv": ["tagId,tag", "1,007", "1,bond", "2,noir"],   # tag id twice
    "genome-scores.csv": ["movieId,tagId,relevance", "1,1,0.5", "2,2,0.25", "5,2,0.75"],
    "links.csv": ["movieId,imdbId,tmdbId", "1,0114709,862", "2,0000002,", "5,0000005,14160"],
}

ANSWERS = [
    '{"movieId":"1","imdbId":"0114709","response":%s}' % __import__("json").dumps(GOOD_ANSWER),
    '{"movieId":"2","imdbId":"0000002","response":"{\\"Response\\":\\"False\\"}"}',
    '{"movieId":"5","imdbId":"0000005","response":"{not json"}',          # malformed JSON
    '{"movieId":"4","imdbId":"0000004","response":"{\\"Title\\":\\"x\\"}"}',  # no Response
    '{"movieId":"3","imdbId":"0000003"}',                                 # never fetched
]


def make_dataset():
    root = tempfile.mkdtemp(prefix="filmgraph-faults-")
    for name, lines in FILES.items():
        with open(os.path.join(root, name), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    os.makedirs(os.path.join(root, "omdb-json"))
    with open(os.path.join(root, "omdb-json", "part-0.json"), "w") as fh:
        fh.write("\n".join(ANSWERS) + "\n")
    return root


def quarantined(spark, graph, name):
    return spark.read.parquet(load.quarantine_path(graph, name)).collect()


def test_quarantine_mode_loads_the_rest(spark):
    ds, graph = make_dataset(), tempfile.mkdtemp(prefix="filmgraph-faults-graph-")
    report = load.load_all(spark, ds, graph, mode="quarantine")
    g = G.read_graph(spark, graph)
    movies = {r["movieId"]: r for r in g.V("MOVIE").collect()}
    assert sorted(movies) == [1, 2, 5]
    assert movies[2]["movieTitle"] == 'Foo, "Bar", The'
    assert [r["_error"] for r in quarantined(spark, graph, "movies")] == ["missing title"]
    assert sorted(r["movieId"] for r in quarantined(spark, graph, "MOVIE")) == [4, 4]
    # ratings: the absent movie's edge and the unreadable row are set aside
    assert g.E("RATED_AS").count() == 3
    assert [r["dst"] for r in quarantined(spark, graph, "RATED_AS")] == [999]
    assert [r["_error"] for r in quarantined(spark, graph, "ratings")] == ["bad rating"]
    # tags: both rows of the repeated id are rejected, and the score pointing at it
    assert [r["tagId"] for r in g.V("TAG").collect()] == [2]
    assert [(r["src"], r["dst"]) for r in quarantined(spark, graph, "ESTIMATED_AT")] == [(1, 1)]
    # answers: one parsed, one failure, two malformed, one never fetched
    assert report.counters["parse_successes"] == 1 and report.counters["parse_failures"] == 1
    assert report.counters["malformed"] == 2 and report.counters["unfetched"] == 1
    assert sorted(r["movieId"] for r in quarantined(spark, graph, "omdb_malformed")) == [4, 5]
    assert movies[1]["movieRated"] == "PG" and movies[1]["movieImdbVotes"] == 1234
    assert movies[5]["movieTmdbId"] == 14160 and movies[5]["movieRated"] is None
    writers = {(r["src"], r["dst"], r["notes"]) for r in g.E("WRITTEN_BY").collect()}
    assert writers == {(1, "Bo Kim", "story by"), (1, "Bo Kim", "screenplay")}
    assert [r["writerName"] for r in g.V("WRITER").collect()] == ["Bo Kim"]


def test_fail_mode_stops_at_the_first_fault(spark):
    ds, graph = make_dataset(), tempfile.mkdtemp(prefix="filmgraph-faults-graph-")
    with pytest.raises(Exception, match="missing title"):
        load.load_movies(spark, ds, graph)


def test_fail_mode_names_the_absent_movie(spark):
    ds, graph = make_dataset(), tempfile.mkdtemp(prefix="filmgraph-faults-graph-")
    load.load_movies(spark, ds, graph, mode="quarantine")
    # the unreadable rating stops the ratings load first
    with pytest.raises(Exception, match="bad rating"):
        load.load_ratings(spark, ds, graph)
    with pytest.raises(IntegrityError, match="TAG.tagId is not unique"):
        load.load_genome(spark, ds, graph)
    with pytest.raises(IntegrityError, match="malformed API answers"):
        load.load_omdb(spark, ds, graph)
