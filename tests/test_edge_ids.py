"""Edges have ids that stay, and are found by them through the stored index."""

import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from filmgraph import schemas as S
from filmgraph.operators import edge_ids as I
from filmgraph.plans import load
from filmgraph.plans import search as Q
from filmgraph.plans.traversal import Edges
from filmgraph.sources import graphstore as G
from tests.test_loads import MOVIES, graph_of, stream, write


def test_ids_are_unique_and_stay_over_loads_streams_and_partitionings(spark):
    ds, graph = graph_of(spark, ("10,1,4.0,1", "10,1,4.0,1", "10,1,4.0,2", "11,3,5.0,3"))
    load.build_edge_ids(spark, graph, "RATED_AS")

    def ids():
        rows = G.read_graph(spark, graph, ["RATED_AS"]).edges_with_ids("RATED_AS").collect()
        assert len({r["edge_id"] for r in rows}) == len(rows)
        return {r["edge_id"]: tuple(r)[1:] for r in rows}

    first = ids()
    assert len(first) == 4 and sum(i.endswith(":1") for i in first) == 1
    write(ds, "ratings.csv", ["userId,movieId,rating,timestamp", "11,3,5.0,3", "10,1,4.0,2",
                              "10,1,4.0,1", "10,1,4.0,1"])
    load.load_ratings(spark, ds, graph)
    assert ids() == first
    stream(spark, graph, "10,1,4.0,1")                   # a third copy, streamed
    again = ids()
    assert len(again) == 5 and first.items() <= again.items()
    bare = G.read_graph(spark, graph, ["RATED_AS"])
    bare.ids.clear()                                     # the same without the index
    assert {r["edge_id"] for r in bare.edges_with_ids("RATED_AS").collect()} == set(again)
    g = G.read_graph(spark, graph, ["RATED_AS", "MOVIE", "USER"])
    (third,) = set(again) - set(first)
    got = Q.edges_by_id(g, "RATED_AS", [third, third, third[:-1] + "3", "RATED_AS:x:0", "y", None])
    assert [tuple(r) for r in got.collect()] == [(third, 10, 1, 4.0, 1)]
    assert [r["key"] for r in Edges.by_id(g, "RATED_AS", third).in_v().to_df().collect()] == [1]
    assert Q.edges_by_id(g, "RATED_AS", []).count() == 0


def test_contents_that_look_alike_have_different_ids(spark):
    rows = [("a", 1, None), ("a", 11, ""), ("a1", 1, "-"), ("a", 1, "1:-"), ("a", 1, "x"), (None, 1, "x")]
    df = spark.createDataFrame(rows, S.EDGES["SPOKEN_IN"].schema)
    got = I.numbered(I.contents(df, "SPOKEN_IN"), "SPOKEN_IN").collect()
    assert len({r["edge_id"] for r in got}) == len(rows)
    zeros = spark.createDataFrame([(1, 1, 0.0), (1, 1, -0.0)], S.EDGES["ESTIMATED_AT"].schema)
    ids = {r["edge_id"] for r in I.numbered(I.contents(zeros, "ESTIMATED_AT"),
                                            "ESTIMATED_AT").collect()}
    assert len(ids) == 2 and len({i.rsplit(":", 1)[0] for i in ids}) == 1
    empty = df.limit(0)
    assert I.numbered(I.contents(empty, "SPOKEN_IN"), "SPOKEN_IN").count() == 0


def test_copies_of_a_hot_edge_are_numbered_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(I, "CHUNK", 100)
    df = spark.range(1999).selectExpr("1L AS src", "2L AS dst").unionByName(
        spark.range(50).selectExpr("id AS src", "2L AS dst"))
    rows = I.numbered(I.contents(df, "RELEASED_IN"), "RELEASED_IN")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = Counter(r["p"] for r in rows.where("src = 1").select(
            F.spark_partition_id().alias("p")).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = rows.collect()
    assert len({r["edge_id"] for r in got}) == len(got) == 2049
    assert {int(r["edge_id"].rsplit(":", 1)[1]) for r in got if r["src"] == 1} == set(range(2000))
    assert max(parts.values()) < 1200


def test_a_lookup_by_id_reads_part_of_the_index(spark, tmp_root):
    n = 40_000
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        G.write_edge_ids(spark.range(n).selectExpr("id AS src", "id % 7 AS dst"), tmp_root,
                         "RELEASED_IN")
    finally:
        spark.conf.unset("parquet.block.size")
    index = spark.read.schema(I.contents_schema("RELEASED_IN")).parquet(
        G.current(spark, G.ids_path(tmp_root, "RELEASED_IN")))
    g = G.Graph(edges={"RELEASED_IN": index.select("src", "dst")}, ids={"RELEASED_IN": index})
    wanted = index.where("src = 777").select(F.concat(F.lit("RELEASED_IN:"), I.HASH, F.lit(":0")))
    rows = Q.edges_by_id(g, "RELEASED_IN", [wanted.first()[0]])
    assert [tuple(r)[1:] for r in rows.collect()] == [(777, 0)]
    held = index.where(F.col(I.HASH).isin([wanted.first()[0].split(":")[1]]))
    held.collect()
    leaf = held._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().apply("numOutputRows").value() < n / 2
    many = Q.edges_by_id(g, "RELEASED_IN", [r[0] for r in index.limit(300).select(
        F.concat(F.lit("RELEASED_IN:"), I.HASH, F.lit(":0"))).collect()])
    assert many.count() == 300


def test_load_all_builds_the_index(spark):
    ds, graph = tempfile.mkdtemp(prefix="filmgraph-ds-"), tempfile.mkdtemp(prefix="filmgraph-g-")
    write(ds, "movies.csv", MOVIES)
    write(ds, "ratings.csv", ["userId,movieId,rating,timestamp", "1,1,4.0,1"])
    report = load.load_all(spark, ds, graph, edge_ids=("RATED_AS",))
    assert os.path.exists(report.written["ids/RATED_AS"])
    with pytest.raises(KeyError):
        Q.edges_by_id(G.read_graph(spark, graph), "ACTED_BY", "x")
