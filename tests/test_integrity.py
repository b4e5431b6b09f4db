"""V1/V2 with planted faults: a rating of an absent movie, a tag id twice, null keys."""

import pytest

from filmgraph.operators import integrity
from filmgraph.plans import build


def movies_df(spark):
    return spark.createDataFrame(
        [(1, "Toy Story (1995)", "Adventure|Animation"), (2, "Heat (1995)", "Action|Crime")],
        "movieId bigint, title string, genres string")


def ratings_df(spark, extra=()):
    rows = [(10, 1, 4.0, 100), (11, 2, 3.5, 101), (10, 2, 5.0, 102), *extra]
    return spark.createDataFrame(rows, "userId bigint, movieId bigint, rating double, "
                                       "timestamp bigint")


def test_rating_of_absent_movie_fails(spark):
    movies = build.movie_tables(movies_df(spark)).vertices["MOVIE"]
    with pytest.raises(integrity.IntegrityError, match="RATED_AS.dst .* 99"):
        build.rating_tables(ratings_df(spark, [(12, 99, 1.0, 103)]), movies)


def test_rating_of_absent_movie_is_quarantined(spark):
    movies = build.movie_tables(movies_df(spark)).vertices["MOVIE"]
    t = build.rating_tables(ratings_df(spark, [(12, 99, 1.0, 103), (13, None, 2.0, 104)]),
                            movies, mode="quarantine")
    assert t.edges["RATED_AS"].count() == 3
    bad = sorted((r["src"], r["dst"], r["_error"]) for r in t.rejected["RATED_AS"].collect())
    assert bad == [(12, 99, "no vertex for dst"), (13, None, "no vertex for dst")]


def test_clean_input_needs_no_join(spark):
    movies = build.movie_tables(movies_df(spark)).vertices["MOVIE"]
    t = build.rating_tables(ratings_df(spark), movies, mode="quarantine")
    plan = t.edges["RATED_AS"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert t.rejected["RATED_AS"].count() == 0


def tags_df(spark, rows):
    return spark.createDataFrame(rows, "tagId bigint, tag string")


def scores_df(spark):
    return spark.createDataFrame([(1, 1, 0.5), (2, 2, 0.25)],
                                 "movieId bigint, tagId bigint, relevance double")


def test_tag_id_twice_fails(spark):
    movies = build.movie_tables(movies_df(spark)).vertices["MOVIE"]
    with pytest.raises(integrity.IntegrityError, match="TAG.tagId is not unique .1 keys.: 1 x2"):
        build.genome_tables(tags_df(spark, [(1, "007"), (1, "bond"), (2, "noir")]),
                            scores_df(spark), movies)


def test_tag_id_twice_is_quarantined_with_its_edges(spark):
    movies = build.movie_tables(movies_df(spark)).vertices["MOVIE"]
    t = build.genome_tables(tags_df(spark, [(1, "007"), (1, "bond"), (2, "noir")]),
                            scores_df(spark), movies, mode="quarantine")
    assert [r["tagId"] for r in t.vertices["TAG"].collect()] == [2]
    assert t.rejected["TAG"].count() == 2
    # the score pointing at the rejected tag has no TAG vertex any more
    assert [(r["src"], r["dst"]) for r in t.edges["ESTIMATED_AT"].collect()] == [(2, 2)]
    assert [r["src"] for r in t.rejected["ESTIMATED_AT"].collect()] == [1]


def test_duplicate_movie_id_fails(spark):
    df = movies_df(spark).unionByName(movies_df(spark).limit(1))
    with pytest.raises(integrity.IntegrityError, match="MOVIE.movieId"):
        build.movie_tables(df)


def test_unique_report_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k bigint")
    r = integrity.unique_report(df, "X", "k").first().asDict()
    assert r == {"label": "X", "property": "k", "n_rows": 5, "n_null": 2, "n_keys": 2,
                 "n_duplicated": 1}


def test_reference_report_counts(spark):
    edges = spark.createDataFrame([(1, 5), (1, 6), (2, 6), (3, 7)], "src bigint, dst bigint")
    vertices = spark.createDataFrame([(5,), (7,)], "id bigint")
    r = integrity.reference_report(edges, "E", "dst", vertices, "id").first().asDict()
    assert r == {"label": "E", "endpoint": "dst", "n_edges": 4, "n_dangling_edges": 2,
                 "n_dangling_keys": 1}


def test_null_key_counts_as_duplicate_or_missing(spark):
    df = spark.createDataFrame([(None, "a"), (2, "b")], "tagId bigint, tag string")
    with pytest.raises(integrity.IntegrityError, match="None"):
        integrity.enforce_unique(df, "tagId")


def test_absent_keys_small_side_matches_and_avoids_shuffling_the_table(spark):
    table = spark.range(0, 5000).withColumnRenamed("id", "k")
    keys = spark.createDataFrame([(3,), (4999,), (7000,), (None,), (3,)], "k bigint")
    plain = {r["k"] for r in integrity.absent_keys(keys, "k", table, "k").collect()}
    small_df = integrity.absent_keys(keys, "k", table, "k", small=True)
    assert plain == {r["k"] for r in small_df.collect()} == {7000, None}
    plan = small_df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_grouped_reference_report_matches_single(spark):
    a = spark.createDataFrame([(1, 5), (1, 6), (2, 6), (3, 7)], "src bigint, dst bigint")
    b = spark.createDataFrame([(5, 9)], "src bigint, dst bigint")
    empty = spark.createDataFrame([], "src bigint, dst bigint")
    vertices = spark.createDataFrame([(5,), (7,)], "id bigint")
    others = spark.createDataFrame([(1,)], "id bigint")
    edges = {"A": (a, [("src", "W"), ("dst", "V")]), "B": (b, [("src", "V")]),
             "C": (empty, [("dst", "V")])}
    grouped = {(r["label"], r["endpoint"]): r.asDict() for r in integrity.references_report(
        edges, {"V": (vertices, "id"), "W": (others, "id")}).collect()}
    assert grouped[("A", "src")] == integrity.reference_report(a, "A", "src", others,
                                                               "id").first().asDict()
    for label, col, df in (("A", "dst", a), ("B", "src", b), ("C", "dst", empty)):
        single = integrity.reference_report(df, label, col, vertices, "id").first().asDict()
        assert grouped[(label, col)] == single
