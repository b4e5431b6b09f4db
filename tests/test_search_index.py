"""Text postings, the curve copy and the manifest: same answers as a scan, less read, all or nothing."""

import re
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filmgraph import session
from filmgraph.functions import grams
from filmgraph.plans import load
from filmgraph.plans import search as Q
from filmgraph.sources import graphstore as G
from tests.test_loads import MOVIES, graph_of, write

# ---------------------------------------------------------------- what a search must hold

ATOMS = st.sampled_from(["a", "b", "ab", "abc", "É", ".", "[ab]", "[^a]", r"\d", r"\.", "(?:ab|ba)",
                         "(abc|cab|b)", "(a)", "^", "$", r"\b", "(?=a)", "(?!b)", "c"])
PATTERNS = st.lists(st.tuples(ATOMS, st.sampled_from(["", "", "", "?", "*", "+", "{2}", "{1,2}", "+?"]))
                    .map(lambda x: "".join(x) if x[0] not in ("^", "$", r"\b") else x[0]),
                    min_size=1, max_size=5).map("".join)


def plain_grams(value):
    marked = grams.BEGIN + "".join(c.lower() if c.isascii() else c for c in value) + grams.END
    return {marked[i:i + 3] for i in range(len(marked) - 2)}


@settings(max_examples=2000, deadline=None)
@given(PATTERNS, st.text("abcAé.É1", max_size=8))
def test_a_value_that_matches_holds_what_an_alternative_needs(pattern, value):
    needed = grams.of_regex(pattern)
    if needed is not None and re.fullmatch(pattern, value, re.S):
        assert any(x <= plain_grams(value) for x in needed)


@pytest.mark.parametrize("pattern, needed", [
    ("The .*", [{"\u0002th", "the", "he "}]), (".*King.*", [{"kin", "ing"}]),
    ("(red|blue) ring", [{"\u0002re", "red", "ed ", "d r", " ri", "rin", "ing", "ng\u0003"},
                         {"\u0002bl", "blu", "lue", "ue ", "e r", " ri", "rin", "ing", "ng\u0003"}]),
    (".*", None), ("a.b", None), (".*(abc)?.*", None), ("(?i)abc", None), (r"\Qabc\E", None),
    ("[abc&&[ab]]bcd", None), (r".*\p{L}abc", None), ("(?<n>abc).*", None), ("abc[", None),
    (".*x{3}.*", [{"xxx"}]), (".*[Kk]ing", [{"kin", "ing", "ng\u0003"}]), (r".*a\.b", [{"a.b", ".b\u0003"}]),
    ("(abc|.)x", None), ("(?:abcd)+.*", [{"\u0002ab", "abc", "bcd"}]), (r".*\vabc", None)])
def test_what_patterns_need(pattern, needed):
    assert grams.of_regex(pattern) == needed


def test_grams_of_values(spark):
    values = ["", "a", "AB", "Ünï", "a b", "ab ab ab", None]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select(
        "v", grams.grams(F.col("v")).alias("g")).collect()
    for r in rows:
        if r["v"] is not None:
            assert set(r["g"]) == plain_grams(r["v"]) and len(r["g"]) == len(set(r["g"]))


# ---------------------------------------------------------------- postings

def rows_read(df):
    """Rows that the scans of an executed plan gave."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value()
               for i in range(leaves.size()) if leaves.apply(i).metrics().contains("numOutputRows"))


@pytest.fixture(scope="module")
def indexed(spark):
    """40,000 movies in small row groups, with postings and curve copy."""
    root = tempfile.mkdtemp(prefix="filmgraph-index-")
    n = 40_000
    h = F.pmod(F.xxhash64("movieId", F.lit(3)), F.lit(1 << 20))
    movies = spark.range(n).select(F.col("id").alias("movieId")).select(
        "movieId",
        F.concat(F.lit("film "), F.hex(h), F.when(F.col("movieId") % 5000 == 7, " Zebra crossing")
                 .otherwise(" common title")).alias("movieTitle"),
        F.when(F.col("movieId") % 9000 == 4, "PG-13").otherwise("R").alias("movieRated"),
        F.lpad((F.col("movieId") * 7919 % 1000003).cast("string"), 7, "0").alias("movieImdbId"),
        F.array(F.lit("Drama"), F.when(F.col("movieId") % 8000 == 11, "Film-Noir")
                .otherwise("Comedy")).alias("movieGenres"),
        (F.lit(1900) + h % 120).alias("movieYear"),
        (F.pmod(F.xxhash64("movieId", F.lit(9)), F.lit(1000)) / 100).cast("float").alias(
            "movieImdbScore"))
    spark.conf.set("parquet.block.size", str(192 * 1024))
    spark.conf.set("parquet.page.row.count.limit", "500")
    try:
        G.write_vertices(movies, root, "MOVIE")
        spark.conf.set("parquet.block.size", str(16 * 1024))     # no bloom filters here
        stored = G.read_graph(spark, root, ["MOVIE"]).V("MOVIE")
        G.write_curve(stored, root, "MOVIE")
        spark.conf.set("parquet.block.size", str(512 * 1024))
        G.write_postings(stored, root, "MOVIE")
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.unset("parquet.page.row.count.limit")
    return G.read_graph(spark, root, ["MOVIE"]), n


SEARCHES = [("movieTitle", {"contains": "Zebra"}, 8), ("movieTitle", {"contains": "zebra"}, 0),
            ("movieTitle", {"regex": "film .* (Zebra|Tiger) cross.*"}, 8),
            ("movieTitle", {"contains": "crossings"}, 0), ("movieTitle", {"word": "ZEBRA"}, 8),
            ("movieTitle", {"word_regex": "zeb.a"}, 8), ("movieRated", {"contains": "G-1"}, 5),
            ("movieRated", {"starts_with": "PG"}, 5), ("movieRated", {"regex": "PG-1\\d"}, 5),
            ("movieImdbId", {"contains": "0007919"}, 1), ("movieGenres", {"contains": "-Noi"}, 5),
            ("movieGenres", {"regex": "Film.Noir"}, 5), ("movieGenres", {"word_prefix": "noi"}, 5)]


@pytest.mark.parametrize("prop, given_, n", SEARCHES)
def test_searches_read_few_movies_and_find_what_a_scan_finds(indexed, prop, given_, n):
    g, total = indexed
    found = Q.text_search(g, "MOVIE", prop, **given_)
    got = sorted(r["movieId"] for r in found.collect())
    bare = G.Graph(vertices=g.vertices)
    assert got == sorted(r["movieId"] for r in Q.text_search(bare, "MOVIE", prop, **given_).collect())
    assert len(got) == n and rows_read(found) < total / 4


def test_searches_that_postings_do_not_help(indexed):
    g, total = indexed
    for given_ in ({"contains": "common"}, {"contains": "m "}, {"regex": "f.l.*"},
                   {"regex": "(?i)FILM.*crossing"}):
        found = Q.text_search(g, "MOVIE", "movieTitle", **given_)
        bare = Q.text_search(G.Graph(vertices=g.vertices), "MOVIE", "movieTitle", **given_)
        assert found.count() == bare.count() > 0
    for wrong in ({}, {"word": "a", "regex": "b"}):
        with pytest.raises(ValueError):
            Q.text_search(g, "MOVIE", "movieTitle", **wrong)
    with pytest.raises(KeyError):
        Q.text_search(g, "MOVIE", "nothing", word="a")


def test_the_postings_of_a_rare_piece_are_read_alone(indexed):
    g, _ = indexed
    rows = g.postings["MOVIE"].where(
        "property = 'movieTitle' AND kind = 'g' AND piece IN ('zeb', 'bra')")
    assert rows.count() == 16
    rows.collect()
    leaf = rows._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().apply("numOutputRows").value() < g.postings["MOVIE"].count() / 20


# ---------------------------------------------------------------- the curve copy

def test_two_ranges_read_a_small_share_of_the_copy(indexed):
    g, total = indexed
    year, score = Q.Property("MOVIE", "movieYear"), Q.Property("MOVIE", "movieImdbScore")
    ranges = (year.between(1950, 1960), score.between(3, 4))
    found = Q.search_movies(g, *ranges)
    got = sorted(r["movieId"] for r in found.collect())
    plain = Q.search_movies(G.Graph(vertices=g.vertices), *ranges)
    assert got == sorted(r["movieId"] for r in plain.collect()) and got
    assert rows_read(found) < total * 0.15 and rows_read(plain) > total * 0.9
    assert "curve/MOVIE" in found._jdf.queryExecution().executedPlan().toString()
    by_key = Q.search_movies(g, F.col("movieId") < 10)
    assert "curve/MOVIE" not in by_key._jdf.queryExecution().executedPlan().toString()


def test_curve_of_odd_columns(spark, tmp_root):
    rows = [(1, None, None), (2, 1990, None), (3, 1990, float("nan")), (4, -5, 1.5), (4, -5, 1.5)]
    df = spark.createDataFrame(rows, "movieId long, movieYear long, movieImdbScore float")
    G.write_curve(df, tmp_root, "MOVIE")
    assert G.read_graph(spark, tmp_root, ["MOVIE"]).curves["MOVIE"].count() == 5
    G.write_curve(df.limit(0), tmp_root, "MOVIE")
    assert G.read_graph(spark, tmp_root, ["MOVIE"]).curves["MOVIE"].count() == 0


# ---------------------------------------------------------------- all tables of a load or none

def test_a_load_that_stops_half_way_changes_nothing(spark, monkeypatch):
    ds, graph = graph_of(spark)
    tables = {"V": ("MOVIE", "YEAR"), "E": ("RELEASED_IN", "CATEGORIZED_AS")}

    def state():
        g = G.read_graph(spark, graph)
        held = {x: sorted(map(str, getattr(g, kind)(x).collect()))
                for kind, names in tables.items() for x in names}
        held["title"] = sorted(r["movieId"] for r in Q.text_search(
            g, "MOVIE", "movieTitle", contains="Z").collect())
        return held

    before, names = state(), G.manifest(spark, graph)
    write(ds, "movies.csv", MOVIES + ["4,Z (1999),z"])

    def broken(df, root, label):
        raise OSError("disk full")

    monkeypatch.setattr(G, "write_postings", broken)
    with pytest.raises(OSError):
        load.load_movies(spark, ds, graph)
    assert state() == before and G.manifest(spark, graph) == names
    for table, version in names.items():
        assert G.versions(spark, f"{graph}/{table}")[-1] == version      # nothing is left behind
    monkeypatch.undo()
    load.load_movies(spark, ds, graph)
    after = state()
    assert after["title"] == [4] and len(after["MOVIE"]) == 4
    assert len(session.list_folder(spark, G.manifest_path(graph))) == 2


def test_a_first_load_that_fails_shows_nothing(spark, monkeypatch):
    ds, graph = tempfile.mkdtemp(prefix="filmgraph-ds-"), tempfile.mkdtemp(prefix="filmgraph-g-")
    write(ds, "movies.csv", MOVIES)
    monkeypatch.setattr(G, "write_curve", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load.load_movies(spark, ds, graph)
    g = G.read_graph(spark, graph)
    assert not g.vertices and not g.edges


def test_a_graph_without_a_manifest_is_read_and_adopted(spark):
    ds, graph = graph_of(spark)
    session.delete_folder(spark, G.manifest_path(graph))
    assert G.read_graph(spark, graph).V("MOVIE").count() == 3
    load.load_ratings(spark, ds, graph)
    g = G.read_graph(spark, graph)
    assert g.V("MOVIE").count() == 3 and g.E("RATED_AS").count() == 3
    assert g.postings["MOVIE"].count() > 0


def test_the_enrichment_renews_the_index(spark):
    ds, graph = graph_of(spark)
    write(ds, "omdb-json/a.json", ['{"movieId":"1","imdbId":"0000077","response":'
                                   '"{\\\\"Response\\\\":\\\\"True\\\\",\\\\"Rated\\\\":\\\\"NC-17\\\\"}"}'.replace("\\\\", "\\")])
    load.load_omdb(spark, ds, graph)
    g = G.read_graph(spark, graph)
    assert [r["movieId"] for r in Q.text_search(g, "MOVIE", "movieRated",
                                                contains="C-1").collect()] == [1]
    assert [r["movieId"] for r in Q.text_search(g, "MOVIE", "movieImdbId",
                                                regex="0+77").collect()] == [1]
