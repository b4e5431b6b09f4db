"""Loads that must not lose, double or swap anything: headers, links, reloads, versions, streams."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from filmgraph import session
from filmgraph.operators.integrity import IntegrityError
from filmgraph.plans import build, load
from filmgraph.plans import search as Q
from filmgraph.sources import dataset as io
from filmgraph.sources import graphstore as G
from filmgraph.streaming import start_ratings_stream

MOVIES = ["movieId,title,genres", "1,A (1990),x", "2,B (1991),y", "3,C (1992),x|y"]


def write(root, name, lines):
    os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
    with open(os.path.join(root, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def graph_of(spark, ratings=("10,1,4.0,1", "10,2,3.0,2", "11,3,5.0,3")):
    ds, graph = tempfile.mkdtemp(prefix="filmgraph-ds-"), tempfile.mkdtemp(prefix="filmgraph-g-")
    write(ds, "movies.csv", MOVIES)
    write(ds, "ratings.csv", ["userId,movieId,rating,timestamp", *ratings])
    load.load_movies(spark, ds, graph)
    load.load_ratings(spark, ds, graph)
    return ds, graph


# ---------------------------------------------------------------- headers and lines

def test_files_of_a_folder_with_swapped_columns_stop_the_read(spark, tmp_root):
    write(tmp_root, "ratings.csv/a.csv", ["userId,movieId,rating,timestamp", "10,1,4.0,1"])
    write(tmp_root, "ratings.csv/b.csv", ["movieId,userId,rating,timestamp", "2,11,4.0,1"])
    for mode in ("fail", "quarantine"):
        with pytest.raises(Exception, match="(?i)header|schema"):
            io.read_ratings(spark, tmp_root, mode).collect()


def test_columns_are_matched_by_name(spark, tmp_root):
    write(tmp_root, "ratings.csv", ["movieId,timestamp,userId,rating", "2,7,11,4.0"])
    for mode in ("fail", "quarantine"):
        r = io.read_ratings(spark, tmp_root, mode).first()
        assert (r["userId"], r["movieId"], r["rating"], r["timestamp"]) == (11, 2, 4.0, 7)


def test_broken_lines_are_set_aside_whole(spark, tmp_root):
    write(tmp_root, "movies.csv", ["movieId,title,genres", "1,Foo (1990),x",
                                   "2,Bar, The (1991),Comedy", "3,short", "x,Baz (1992),y"])
    rows = io.read_movies(spark, tmp_root, "quarantine")
    assert [r["movieId"] for r in io.accepted(rows).collect()] == [1]
    bad = {r["_error"]: r["_raw"] for r in io.rejected(rows).collect()}
    assert set(bad) == {"malformed line", "bad movieId"}
    assert '"movieId":"x"' in bad["bad movieId"]
    raw = {r["_raw"] for r in io.rejected(rows).collect()}
    assert "2,Bar, The (1991),Comedy" in raw and "3,short" in raw
    with pytest.raises(Exception):
        io.read_movies(spark, tmp_root).collect()


def test_stream_file_with_another_header_stops_the_stream(spark):
    _, graph = graph_of(spark)
    landing = tempfile.mkdtemp(prefix="filmgraph-landing-")
    write(landing, "a.csv", ["movieId,userId,rating,timestamp", "3,12,4.0,1"])
    q = start_ratings_stream(spark, landing, graph,
                             checkpoint=tempfile.mkdtemp(prefix="filmgraph-ckpt-"))
    with pytest.raises(Exception):
        q.awaitTermination(120)
    assert G.read_graph(spark, graph, ["RATED_AS"]).E("RATED_AS").count() == 3


# ---------------------------------------------------------------- streams and reloads

def stream(spark, graph, line, checkpoint=None):
    landing = tempfile.mkdtemp(prefix="filmgraph-landing-")
    write(landing, "a.csv", ["userId,movieId,rating,timestamp", line])
    checkpoint = checkpoint or tempfile.mkdtemp(prefix="filmgraph-ckpt-")
    q = start_ratings_stream(spark, landing, graph, checkpoint=checkpoint)
    q.awaitTermination(120)
    assert q.exception() is None
    return landing, checkpoint


def test_two_streams_and_a_reload_keep_every_rating(spark):
    ds, graph = graph_of(spark)
    load.build_adjacency(spark, graph, "RATED_AS")
    landing, checkpoint = stream(spark, graph, "20,1,2.0,9")
    stream(spark, graph, "21,2,2.0,9")
    load.load_ratings(spark, ds, graph)
    q = start_ratings_stream(spark, landing, graph, checkpoint=checkpoint)   # nothing new
    q.awaitTermination(120)
    g = G.read_graph(spark, graph)
    assert sorted(r["src"] for r in g.E("RATED_AS").collect()) == [10, 10, 11, 20, 21]
    assert sorted(r["userId"] for r in g.V("USER").collect()) == [10, 11, 20, 21]
    for direction in ("out", "in"):
        assert g.adjacency[("RATED_AS", direction)].count() == 5
    names = G.register_tables(spark, graph, database="fg_stream_test")
    assert "fg_stream_test.e_rated_as" in names
    assert spark.table("fg_stream_test.e_rated_as").count() == 5
    assert spark.table("fg_stream_test.v_user").count() == 4


def test_a_user_of_both_parts_is_one_vertex(spark):
    ds, graph = graph_of(spark)
    stream(spark, graph, "30,1,2.0,9")
    write(ds, "ratings.csv", ["userId,movieId,rating,timestamp", "30,2,1.0,1"])
    load.load_ratings(spark, ds, graph)
    g = G.read_graph(spark, graph)
    assert [r["userId"] for r in g.V("USER").collect()] == [30] and g.E("RATED_AS").count() == 2


def test_unfinished_version_is_not_read(spark):
    ds, graph = graph_of(spark)
    folder = G.edge_path(graph, "RATED_AS")
    current = G.current(spark, folder)
    write(folder, "version-00000009/part-x.parquet", ["no parquet"])     # a write that broke off
    assert G.current(spark, folder) == current
    assert G.read_graph(spark, graph).E("RATED_AS").count() == 3
    load.load_ratings(spark, ds, graph)
    assert G.current(spark, folder).endswith("version-00000010")
    assert len(G.versions(spark, folder)) == 2
    assert session.list_folder(spark, f"{graph}/_staging") == []


def test_reload_of_fewer_movies_checks_the_stored_edges(spark):
    ds, graph = graph_of(spark)
    write(ds, "movies.csv", MOVIES[:3])
    with pytest.raises(IntegrityError, match="RATED_AS.dst refers to missing"):
        load.load_movies(spark, ds, graph)
    assert G.read_graph(spark, graph).V("MOVIE").count() == 3
    load.load_movies(spark, ds, graph, mode="quarantine")
    g = G.read_graph(spark, graph)
    assert g.V("MOVIE").count() == 2 and g.E("RATED_AS").count() == 2
    bad = spark.read.parquet(load.quarantine_path(graph, "RATED_AS_stored")).collect()
    assert [(r["src"], r["dst"]) for r in bad] == [(11, 3)]


# ---------------------------------------------------------------- links and unique keys

def links(spark, *rows):
    return spark.createDataFrame(rows, "movieId string, imdbId string, tmdbId string")


def movies(spark):
    rows = spark.createDataFrame([(1, "A", "x"), (2, "B", "x"), (3, "C", "x")],
                                 "movieId long, title string, genres string")
    return build.movie_tables(rows).vertices["MOVIE"]


def test_spellings_of_one_movie_id_are_one_key(spark):
    rows = links(spark, ("1", "a", "11"), ("01", "b", "12"), ("2", "c", "13"))
    with pytest.raises(IntegrityError, match="link.movieId is not unique"):
        build.check_links(rows, movies(spark))
    checked = build.check_links(rows, movies(spark), "quarantine")
    assert [r["movieId"] for r in checked.accepted.collect()] == [2]
    assert checked.rejected.count() == 2


def test_links_that_cannot_be_used_are_named(spark):
    bad = {("x7", "a", "11"): "bad movieId", ("1", "a", "abc"): "bad tmdbId",
           ("99", "a", "11"): "no vertex for movieId"}
    for row, reason in bad.items():
        with pytest.raises(IntegrityError):
            build.check_links(links(spark, row), movies(spark))
        rejected = build.check_links(links(spark, row), movies(spark), "quarantine").rejected
        assert [r["_error"] for r in rejected.collect()] == [reason]


def test_equal_copies_of_a_link_count_once(spark):
    rows = links(spark, ("1", "a", "11"), ("1", "a", "11"))
    assert build.check_links(rows, movies(spark), "quarantine").accepted.count() == 1


def test_external_ids_are_unique(spark):
    answer = '{"Response":"True"}'
    answers = spark.createDataFrame([("1", "77", answer), ("2", "77", answer)],
                                    "movieId string, imdbId string, response string")
    with pytest.raises(IntegrityError, match="imdbId is not unique"):
        build.omdb_tables(answers, movies(spark))
    t = build.omdb_tables(answers, movies(spark), mode="quarantine")
    assert t.rejected["omdb_imdb_duplicates"].count() == 2
    with pytest.raises(IntegrityError, match="tmdbId is not unique"):
        build.check_links(links(spark, ("1", "a", "5"), ("2", "b", "5")), movies(spark))


# ---------------------------------------------------------------- search

def test_float_bounds_and_long_value_lists(spark, tmp_root):
    rows = spark.range(300).select(
        F.col("id").alias("movieId"), (F.col("id") / 10).cast("float").alias("movieImdbScore"),
        (F.col("id") * 2).alias("movieTmdbId"))
    G.write_vertices(rows, tmp_root, "MOVIE")
    g = G.read_graph(spark, tmp_root, ["MOVIE"])
    score = Q.Property("MOVIE", "movieImdbScore")

    def ids(df):
        return sorted(r["movieId"] for r in df.collect())

    assert ids(Q.lookup(g, "MOVIE", "movieImdbScore", [8.7, 8.3])) == [83, 87]
    assert ids(Q.search_movies(g, score.between(8.7, 9))) == [87, 88, 89]
    assert ids(Q.search_movies(g, score.inside(8.3, 8.7))) == [84, 85, 86]
    assert ids(Q.search_movies(g, score.without([x / 10 for x in range(299)]))) == [299]
    few, many = [2 * x for x in range(100)], [2 * x for x in range(101)]
    assert ids(Q.lookup(g, "MOVIE", "movieTmdbId", few)) == list(range(100))
    assert ids(Q.lookup(g, "MOVIE", "movieTmdbId", many)) == list(range(101))
    keys = spark.createDataFrame([("4",), ("abc",), (None,)], "k string")
    assert ids(Q.lookup(g, "MOVIE", "movieTmdbId", keys)) == [2]


def test_a_key_lookup_reads_one_of_several_files(spark, tmp_root):
    n = 40_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(n).orderBy(F.xxhash64("id")).select(F.col("id").alias("movieId"))
        G.write_vertices(rows, tmp_root, "MOVIE")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    g = G.read_graph(spark, tmp_root, ["MOVIE"])
    q = Q.lookup(g, "MOVIE", "movieId", 777)
    assert q.count() == 1
    q.collect()
    scan = q._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert len(g.V("MOVIE").inputFiles()) >= 4
    assert scan.metrics().apply("numOutputRows").value() < n / 3
