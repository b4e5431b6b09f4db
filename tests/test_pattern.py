"""Labelled patterns against plain enumeration, and the bound on intermediate tables."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from filmgraph import schemas as S
from filmgraph.plans.pattern import Pattern
from filmgraph.plans.traversal import Traversal
from filmgraph.sources import graphstore as G


@pytest.fixture(scope="module")
def small(spark):
    """Users, movies, genres, years and tags with hot movies, parallel edges and dead ends."""
    rng = random.Random(8)
    rated = [(rng.randrange(12), min(int(rng.expovariate(0.4)), 9), float(rng.randrange(1, 6)), 1)
             for _ in range(60)]
    rated += rated[:5]
    genres = [(m, g) for m in range(8) for g in rng.sample("xyz", 2)] + [(0, "x")]
    years = [(m, 1990 + m % 3) for m in range(0, 10, 2)]
    tags = [(t, m, rng.random()) for t in range(3) for m in range(10) if rng.random() < 0.5]
    edges = {"RATED_AS": rated, "CATEGORIZED_AS": genres, "RELEASED_IN": years,
             "ESTIMATED_AT": tags}
    g = G.Graph()
    g.vertices["USER"] = spark.createDataFrame([(u,) for u in range(12)], "userId long")
    g.vertices["MOVIE"] = spark.createDataFrame([(m, f"t{m}") for m in range(10)],
                                                "movieId long, movieTitle string")
    g.vertices["GENRE"] = spark.createDataFrame([(x,) for x in "xyz"], "genreName string")
    g.vertices["YEAR"] = spark.createDataFrame([(1990 + i,) for i in range(3)], "yearNumber long")
    g.vertices["TAG"] = spark.createDataFrame([(t, "n") for t in range(3)],
                                              "tagId long, tagName string")
    for label, rows in edges.items():
        g.edges[label] = spark.createDataFrame(rows, S.EDGES[label].schema)
    return g, edges


def enumerate_matches(p, edges):
    """All matches as {name: key or edge row}, edge by edge."""
    first = next(iter(p.vertices))
    domain = {"USER": range(12), "MOVIE": range(10), "GENRE": "xyz"}[p.vertices[first].label]
    found = [{first: k} for k in domain]
    for e in p.edges:
        grown = []
        for m, row in itertools.product(found, edges[e.label]):
            near, far = (row[0], row[1]) if e.column == "src" else (row[1], row[0])
            if m[e.near] == near and (e.where is None or row[2] >= 3):
                grown.append({**m, e.far: far, **({e.name: row} if e.name else {})})
        found = grown
    for v in p.vertices.values():
        if v.keys is not None:
            found = [m for m in found if m[v.name] in v.keys]
        if v.where is not None:                          # the tests' only predicate
            found = [m for m in found if m[v.name] >= 4]
    return found


def high():
    return F.col("score") >= 3


def shapes(g):
    yield (Pattern.start(g, "a", "USER", keys=[1, 2, 77]).out("a", "RATED_AS", "m", edge="r")
           .in_("m", "RATED_AS", "b", edge_where=high(), edge="s"))
    yield (Pattern.start(g, "m", "MOVIE").out("m", "CATEGORIZED_AS", "g")
           .out("m", "RELEASED_IN", "y").in_("m", "RATED_AS", "u"))
    yield (Pattern.start(g, "u", "USER").out("u", "RATED_AS", "m", where=F.col("movieId") >= 4)
           .out("m", "CATEGORIZED_AS", "g", keys=["x"]).in_("m", "ESTIMATED_AT", "t")
           .in_("g", "CATEGORIZED_AS", "n").out("n", "RELEASED_IN", "y"))
    yield Pattern.start(g, "u", "USER", keys=[99]).out("u", "RATED_AS", "m")
    yield (Pattern.start(g, "g", "GENRE").in_("g", "CATEGORIZED_AS", "m", edge="c")
           .in_("m", "ESTIMATED_AT", "t", keys=[1]))


SELECTED = [("a", "b"), ("m", "b"), ("a",), ("m",), ("g", "y"), ("u", "y"), ("m", "g", "y", "u"),
            ("u", "t"), ("n", "u"), ("t", "g"), ("a", "m", "b")]


def test_patterns_equal_plain_enumeration(small):
    g, edges = small
    for p in shapes(g):
        want = enumerate_matches(p, edges)
        m = p.matches()
        assert m.count().first()["count"] == len(want)
        for name in p.vertices:
            assert {r["key"]: r["bulk"] for r in m.per(name).collect()} == Counter(
                x[name] for x in want)
        for names in [x for x in SELECTED if set(x) <= set(p.vertices)]:
            got = m.select(*names)
            assert got.columns == [*names, "bulk"]
            rows = [tuple(r) for r in got.collect()]
            assert len({r[:-1] for r in rows}) == len(rows)
            assert {r[:-1]: r[-1] for r in rows} == Counter(
                tuple(x[n] for n in names) for x in want)


def test_properties_of_vertices_and_edges(small):
    g, edges = small
    p = next(shapes(g))
    got = p.matches().select("m", "b", props={"r": ["score"], "s": ["score"], "m": ["movieTitle"]})
    assert got.columns == ["m", "b", "r_score", "s_score", "m_movieTitle", "bulk"]
    want = Counter((x["m"], x["b"], x["r"][2], x["s"][2], f"t{x['m']}")
                   for x in enumerate_matches(p, edges))
    assert {tuple(r)[:-1]: r["bulk"] for r in got.collect()} == want


def test_no_table_outgrows_the_edges_or_the_result(small):
    """A hot movie: the matches are many more than the edges, the tables on the way are not."""
    g, _ = small
    spark = g.V("USER").sparkSession
    n = 400
    hot = G.Graph(dict(g.vertices), dict(g.edges))
    hot.edges["RATED_AS"] = spark.range(n).selectExpr(
        "id AS src", "IF(id % 4 = 0, 3, id % 10) AS dst", "CAST(3 AS FLOAT) AS score",
        "id AS timestamp")
    p = (Pattern.start(hot, "a", "USER").out("a", "RATED_AS", "m").in_("m", "RATED_AS", "b")
         .out("m", "CATEGORIZED_AS", "g"))
    m = p.matches()
    matches = m.count().first()["count"]
    assert matches > 20 * n and max(m.sizes) <= n
    out = m.select("a", "m", "b")
    rows = out.collect()
    assert sum(r["bulk"] for r in rows) == matches
    joins = []

    def walk(node):
        if "Join" in node.nodeName():
            joins.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            walk(node.plan())
        for i in range(children.size()):
            walk(children.apply(i))

    walk(out._jdf.queryExecution().executedPlan())
    assert joins and max(joins) <= max(len(rows), n)


def test_names_and_labels_are_checked(small):
    g, _ = small
    p = Pattern.start(g, "u", "USER").out("u", "RATED_AS", "m", edge="r")
    for wrong in (lambda: p.out("u", "RATED_AS", "m"), lambda: p.out("x", "RATED_AS", "n"),
                  lambda: p.out("u", "CATEGORIZED_AS", "n"), lambda: p.in_("m", "RATED_AS", "r"),
                  lambda: p.in_("m", "RATED_AS", "n", edge="n"),
                  lambda: p.in_("m", "RATED_AS", "U"), lambda: p.in_("m", "RATED_AS", "bulk"),
                  lambda: p.in_("m", "RATED_AS", "_w"),
                  lambda: Pattern.start(g, "u", "NOTHING"), lambda: p.matches().select(),
                  lambda: p.matches().select("z"), lambda: p.matches().per("r"),
                  lambda: p.matches().select("m", props={"u": ["userId"]})):
        with pytest.raises((ValueError, KeyError)):
            wrong()
    alone = Pattern.start(g, "u", "USER", keys=[3, 4, 99]).matches()
    assert sorted(tuple(r) for r in alone.select("u").collect()) == [(3, 1), (4, 1)]
    assert alone.count().first()["count"] == 2


def test_edge_steps_over_several_labels(small):
    g, edges = small
    at = Traversal.start(g, "MOVIE", keys=[2, 3])
    out = at.out_edges("CATEGORIZED_AS", "RELEASED_IN")
    want = Counter(("CATEGORIZED_AS", str(a), b) for a, b in edges["CATEGORIZED_AS"] if a in (2, 3))
    want += Counter(("RELEASED_IN", str(a), str(b)) for a, b in edges["RELEASED_IN"]
                    if a in (2, 3))
    assert Counter(tuple(r)[:3] for r in out.to_df().collect()) == want
    every = at.both_edges()
    assert set(every.parts) == set(edges)
    assert every.count().first()["count"] == sum(want.values()) + sum(
        r[1] in (2, 3) for label in ("RATED_AS", "ESTIMATED_AT") for r in edges[label])
    rated = every.has("score", high())
    assert set(rated.parts) == {"RATED_AS"} and rated.out_v().label == "USER"
    assert every.has_label("RELEASED_IN").in_v().label == "YEAR"
    assert at.in_edges().out_v().has_label("TAG").count().first()["count"] == sum(
        r[1] in (2, 3) for r in edges["ESTIMATED_AT"])
    with pytest.raises(ValueError):
        at.out_edges("RATED_AS")
    with pytest.raises(KeyError):
        every.has_label("ACTED_BY")
