"""Load jobs end to end (S10-S12, L2), graph invariants, idempotent reloads, query surface."""

import pytest
from pyspark.sql import functions as F

from filmgraph import schemas as S
from filmgraph.functions import search as P
from filmgraph.plans import load
from filmgraph.plans import search as Q
from filmgraph.plans.traversal import Traversal
from filmgraph.sources import fixtures
from filmgraph.sources import graphstore as G
from filmgraph.sources import dataset as io

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def loaded(spark):
    import tempfile
    dataset = fixtures.dataset_for(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="filmgraph-graph-")
    report = load.load_all(spark, dataset, root)
    return dataset, root, report


def counts(g):
    return ({k: v.count() for k, v in g.vertices.items()},
            {k: v.count() for k, v in g.edges.items()})


def test_every_label_is_written(spark, loaded):
    _, root, report = loaded
    g = G.read_graph(spark, root)
    assert set(g.vertices) == set(S.VERTICES) and set(g.edges) == set(S.EDGES)
    assert report.counters["parse_successes"] > 0 and report.counters["parse_failures"] > 0
    assert report.counters["distinct_writers"] >= report.counters["distinct_writers_names"]


def test_schemas_follow_the_catalog(spark, loaded):
    g = G.read_graph(spark, loaded[1])
    for label, df in g.vertices.items():
        assert df.schema == S.VERTICES[label].schema
    for label, df in g.edges.items():
        assert df.schema == S.EDGES[label].schema


def test_edge_counts_equal_exploded_rows(spark, loaded):
    dataset, root, _ = loaded
    g = G.read_graph(spark, root)
    movies = io.read_movies(spark, dataset)
    from filmgraph.operators.vertices import parse_movies
    parsed = parse_movies(movies)
    assert g.E("CATEGORIZED_AS").count() == parsed.select(F.explode("genres")).count()
    assert g.E("RELEASED_IN").count() == parsed.where("year is not null").count()
    assert g.E("RATED_AS").count() == io.read_ratings(spark, dataset).count()


def test_every_endpoint_resolves_and_keys_are_unique(spark, loaded):
    g = G.read_graph(spark, loaded[1])
    for label, spec in S.EDGES.items():
        for col, vlabel in (("src", spec.src), ("dst", spec.dst)):
            key = S.VERTICES[vlabel].key
            missing = g.E(label).join(g.V(vlabel), F.col(col) == F.col(key), "left_anti")
            assert missing.count() == 0, (label, col)
    for label, spec in S.VERTICES.items():
        for prop in spec.unique:
            dup = g.V(label).where(F.col(prop).isNotNull()).groupBy(prop).count() \
                .where("count > 1")
            assert dup.count() == 0, (label, prop)


def test_reload_is_idempotent(spark, loaded):
    dataset, root, _ = loaded
    before = counts(G.read_graph(spark, root))
    load.load_movies(spark, dataset, root)
    load.load_ratings(spark, dataset, root)
    after = counts(G.read_graph(spark, root))
    assert before == after


def test_genre_set_and_enrichment(spark, loaded):
    g = G.read_graph(spark, loaded[1])
    m = {r["movieId"]: r for r in g.V("MOVIE").collect()}
    dup = [k for k in m if k % 7 == 2][0]      # 'TYPE|TYPE' lists one genre twice
    assert len(m[dup]["movieGenres"]) == 1
    assert g.E("CATEGORIZED_AS").where(F.col("src") == dup).count() == 2
    fetched = [k for k in m if k % 11 and k % 13 and k % 5 and k % 4][0]
    assert m[fetched]["movieRated"] == "PG" and m[fetched]["movieBoxOffice"] is not None
    never = [k for k in m if k % 11 == 0][0]
    assert m[never]["movieImdbId"] is None and m[never]["movieRated"] is None
    assert m[1]["movieTmdbId"] == 100001


def test_filters_reach_the_parquet_scan(spark, loaded):
    g = G.read_graph(spark, loaded[1])
    q = Q.ratings_in_range(g, (3.0, 4.0), (883612800, 915148800)).select("src")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(score), IsNotNull(timestamp), " \
           "GreaterThanOrEqual(score,3.0)" in plan
    # column pruning: only the projected and filtered columns are read
    assert "ReadSchema: struct<src:bigint,score:float,timestamp:bigint>" in plan


def test_lookup_and_search(spark, loaded):
    g = G.read_graph(spark, loaded[1])
    hit = Q.lookup(g, "MOVIE", "movieId", 3).collect()
    assert len(hit) == 1 and hit[0]["movieYear"] == hit[0]["movieYear"]
    title = hit[0]["movieTitle"]
    assert Q.lookup(g, "MOVIE", "movieTitle", title).where("movieId = 3").count() == 1
    assert Q.lookup(g, "MOVIE", "movieImdbId", "0000003").first()["movieId"] == 3
    assert Q.lookup(g, "GENRE", "genreName", ["SMALL", "nope"]).count() == 1
    keys = spark.createDataFrame([(1,), (2,), (999999,)], "k long")
    assert Q.lookup(g, "USER", "userId", keys).count() <= 3
    word = title.split()[-1]
    hits = Q.search_movies(g, P.text_contains("movieTitle", word.upper()),
                           P.between("movieYear", 1950, 2001)).collect()
    assert hits and all(word in r["movieTitle"].split() for r in hits)
    assert Q.search_tags(g, P.text_prefix("tagName", "Brand#2")).count() == 7   # 2, 20-25


def test_traversal_bulk_counts_paths(spark, loaded):
    g = G.read_graph(spark, loaded[1])
    user = g.E("RATED_AS").first()["src"]
    t = Traversal.start(g, "USER", keys=[user]).out("RATED_AS")
    expected = g.E("RATED_AS").where(F.col("src") == user).groupBy("dst").count()
    got = {r["key"]: r["bulk"] for r in t.to_df().collect()}
    assert got == {r["dst"]: r["count"] for r in expected.collect()}
    back = t.in_("RATED_AS")
    total = back.count().first()["count"]
    brute = g.E("RATED_AS").where(F.col("src") == user).alias("a").join(
        g.E("RATED_AS").alias("b"), F.col("a.dst") == F.col("b.dst")).count()
    assert total == brute
    with pytest.raises(ValueError):
        Traversal.start(g, "USER", keys=[user]).in_("RATED_AS")


def test_unified_views(spark, loaded):
    g = G.read_graph(spark, loaded[1])
    assert g.all_vertices().where(F.col("label") == "YEAR").count() == g.V("YEAR").count()
    names = g.register_views(spark, prefix="t_")
    assert "t_e_rated_as" in names
    n = spark.sql("SELECT count(*) FROM t_e_rated_as WHERE score >= 4").first()[0]
    assert n == g.E("RATED_AS").where("score >= 4").count()


def test_lookup_by_unique_column_reads_one_row_group(spark, tmp_root):
    n = 200_000
    movies = spark.range(n).select(
        F.col("id").alias("movieId"),
        F.lpad((F.col("id") * 7919 % 1000003).cast("string"), 7, "0").alias("movieImdbId"),
    ).coalesce(1)
    spark.conf.set("parquet.block.size", str(512 * 1024))      # many row groups in one file
    try:
        G.write_vertices(movies, tmp_root, "MOVIE")
    finally:
        spark.conf.unset("parquet.block.size")
    g = G.read_graph(spark, tmp_root, ["MOVIE"])
    q = Q.lookup(g, "MOVIE", "movieImdbId", "0007919")
    assert [r["movieId"] for r in q.collect()] == [1]
    scan = q._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() < n / 2


def test_describe_graph_lists_labels_keys_and_indexes(spark):
    cat = {(r["kind"], r["label"], r["property"]): r for r in S.describe_graph(spark).collect()}
    assert len({lbl for k, lbl, _ in cat if k == "vertex"}) == 10
    assert len({lbl for k, lbl, _ in cat if k == "edge"}) == 9
    assert cat[("vertex", "MOVIE", "movieId")]["is_key"]
    assert cat[("vertex", "MOVIE", "movieGenres")]["type"] == "array<string>"
    assert sum(r["is_unique"] for r in cat.values()) == 13
    rated = cat[("edge", "RATED_AS", "score")]
    assert rated["is_indexed"] and rated["src_label"] == "USER" and rated["dst_label"] == "MOVIE"
    assert cat[("edge", "SPOKEN_IN", "src")]["type"] == "string"


def test_adjacency_copies_give_the_same_traversals_and_read_less(spark, loaded):
    import shutil
    import tempfile
    _, root, _ = loaded
    copy = tempfile.mkdtemp(prefix="filmgraph-adj-") + "/g"
    shutil.copytree(root, copy)
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        load.build_adjacency(spark, copy, "RATED_AS")
    finally:
        spark.conf.unset("parquet.block.size")
    plain, indexed = G.read_graph(spark, root), G.read_graph(spark, copy)
    assert {("RATED_AS", "out"), ("RATED_AS", "in")} <= set(indexed.adjacency)
    user = plain.E("RATED_AS").first()["src"]

    def two_hops(g):
        return Traversal.start(g, "USER", keys=[user]).out("RATED_AS").in_("RATED_AS").to_df()
    assert sorted(two_hops(plain).collect()) == sorted(two_hops(indexed).collect())
    one_hop = Traversal.start(indexed, "USER", keys=[user]).out_e("RATED_AS")
    plan = one_hop._jdf.queryExecution().executedPlan().toString()
    assert "adjacency/RATED_AS/out" in plan
    assert f"EqualTo(src,{user})" in plan or "In(src, [" in plan    # one key becomes EqualTo
    # the access path the hop uses: the key list pushed into the clustered copy
    scan = indexed.adjacency[("RATED_AS", "out")].where(F.col("src").isin([user]))
    assert scan.count() == plain.E("RATED_AS").where(F.col("src") == user).count()
    leaf = scan._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    read = leaf.metrics().apply("numOutputRows").value()
    assert read < plain.E("RATED_AS").count() / 4


def test_both_dedup_count_and_unified_edges(spark, loaded):
    g = G.read_graph(spark, loaded[1])
    movie = g.E("RATED_AS").first()["dst"]
    raters = Traversal.start(g, "MOVIE", keys=[movie])
    via_both = {r["key"]: r["bulk"] for r in raters.both("RATED_AS").to_df().collect()}
    via_in = {r["key"]: r["bulk"] for r in raters.in_("RATED_AS").to_df().collect()}
    assert via_both == via_in and via_in
    n_edges = g.E("RATED_AS").where(F.col("dst") == movie).count()
    assert raters.in_("RATED_AS").count().first()["count"] == n_edges
    assert raters.in_("RATED_AS").dedup().count().first()["count"] == len(via_in)
    assert raters.in_e("RATED_AS").count() == n_edges
    unified = g.all_edges().where(F.col("label") == "RATED_AS")
    assert unified.count() == g.E("RATED_AS").count()
    assert unified.first()["dst_id"].startswith("MOVIE:")


def test_register_tables_in_the_catalog(spark, loaded):
    names = G.register_tables(spark, loaded[1], database="fg_test")
    assert "fg_test.e_rated_as" in names and len(names) == 19
    n = spark.sql("SELECT count(*) FROM fg_test.e_rated_as WHERE score >= 4").first()[0]
    g = G.read_graph(spark, loaded[1])
    assert n == g.E("RATED_AS").where("score >= 4").count()
    assert spark.table("fg_test.v_movie").schema == S.VERTICES["MOVIE"].schema


def test_genre_and_token_searches_use_the_stored_indexes(spark, loaded):
    from filmgraph.functions import search as P
    g = G.read_graph(spark, loaded[1])
    bare = G.Graph(g.vertices, g.edges)                      # no adjacency, no token table

    def ids(df):
        return sorted(r["movieId"] for r in df.collect())

    genre = g.V("GENRE").first()["genreName"]
    assert ids(Q.movies_with_genre(g, genre)) == ids(Q.movies_with_genre(bare, genre)) != []
    for given in ({"word": "RED"}, {"prefix": "wi"}, {"pattern": "g.*r"}, {"word": "nothing"}):
        assert ids(Q.movies_with_title_token(g, **given)) == ids(
            Q.movies_with_title_token(bare, **given))
    assert g.tokens[("MOVIE", "movieTitle")].where("token = 'red'").count() == bare.V(
        "MOVIE").where(P.text_contains("movieTitle", "red")).count()


def test_edge_steps_chain_and_mix_labels(spark, loaded):
    g = G.read_graph(spark, loaded[1])
    user = g.E("RATED_AS").first()["src"]
    start = Traversal.start(g, "USER", keys=[user])
    high = start.out_edges("RATED_AS").has(F.col("score") >= 3)
    want = g.E("RATED_AS").where(F.col("src") == user).where("score >= 3")
    assert high.count().first()["count"] == want.count()
    assert {r["key"]: r["bulk"] for r in high.in_v().to_df().collect()} == {
        r["dst"]: r["count"] for r in want.groupBy("dst").count().collect()}
    assert [r["key"] for r in high.out_v().to_df().collect()] == [user]
    movie = want.first()["dst"]
    around = Traversal.start(g, "MOVIE", keys=[movie]).both()
    rows = around.to_df().collect()
    assert {r["label"] for r in rows} >= {"USER", "GENRE"}
    raters = around.has_label("USER")
    assert raters.count().first()["count"] == g.E("RATED_AS").where(F.col("dst") == movie).count()
    two = Traversal.start(g, "MOVIE", keys=[movie]).out("CATEGORIZED_AS", "RELEASED_IN")
    assert two.count().first()["count"] == sum(
        g.E(x).where(F.col("src") == movie).count() for x in ("CATEGORIZED_AS", "RELEASED_IN"))
    back = two.in_("CATEGORIZED_AS")
    assert back.label == "MOVIE" and back.dedup().count().first()["count"] >= 1
    with pytest.raises(ValueError):
        start.out("CATEGORIZED_AS")
    assert start.both_edges("RATED_AS").count().first()["count"] == g.E("RATED_AS").where(
        F.col("src") == user).count()
