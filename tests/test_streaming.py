"""Incremental ratings through Structured Streaming: batches are replay-safe."""

import os
import tempfile

from filmgraph.plans import load
from filmgraph.sources import fixtures
from filmgraph.sources import graphstore as G
from filmgraph.streaming import process_batch, rating_stream, start_ratings_stream

SF_SMALL = "/root/testdata/sf0.001"


def drop(folder, name, lines):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("userId,movieId,rating,timestamp\n" + "".join(l + "\n" for l in lines))


def test_stream_appends_edges_users_and_quarantines(spark):
    dataset = fixtures.dataset_for(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="filmgraph-stream-graph-")
    landing = tempfile.mkdtemp(prefix="filmgraph-landing-")
    load.load_movies(spark, dataset, root)
    load.load_ratings(spark, dataset, root)
    g0 = G.read_graph(spark, root)
    n_edges, n_users = g0.E("RATED_AS").count(), g0.V("USER").count()
    known_user = g0.V("USER").first()["userId"]
    drop(landing, "a.csv", [f"{known_user},1,4.5,1700000000", "9000001,1,3.0,1700000001",
                            "9000001,2,2.0,1700000002", "9000002,99999999,1.0,1700000003",
                            "9000003,x,1.0,1700000004"])
    ckpt = tempfile.mkdtemp(prefix="filmgraph-ckpt-")
    q = start_ratings_stream(spark, landing, root, checkpoint=ckpt)
    q.awaitTermination(300)
    assert q.exception() is None
    g1 = G.read_graph(spark, root)
    assert g1.E("RATED_AS").count() == n_edges + 3
    # users come from every well-formed row (9000001, and 9000002 whose movie is unknown)
    assert g1.V("USER").count() == n_users + 2
    assert g1.V("USER").groupBy("userId").count().where("count > 1").count() == 0
    bad = spark.read.option("recursiveFileLookup", "true").parquet(
        f"{root}/_quarantine/ratings_stream").collect()
    assert sorted(r["_error"] for r in bad) == ["bad movieId", "no vertex for dst"]


def test_replayed_batch_does_not_duplicate(spark):
    dataset = fixtures.dataset_for(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="filmgraph-replay-graph-")
    load.load_movies(spark, dataset, root)
    load.load_ratings(spark, dataset, root)
    base = G.read_graph(spark, root)
    n_edges, n_users = base.E("RATED_AS").count(), base.V("USER").count()
    landing = tempfile.mkdtemp(prefix="filmgraph-landing-")
    drop(landing, "b.csv", ["8000001,1,4.0,1", "8000001,2,3.0,2"])
    batch = spark.read.options(header="true").schema(
        "userId string, movieId string, rating string, timestamp string").csv(landing)
    from filmgraph import schemas as S
    from filmgraph.sources import dataset as io
    typed = io.conform(batch, S.RATINGS, io.INPUTS["ratings"].required, "quarantine")
    process_batch(typed, 0, root)
    process_batch(typed, 0, root)          # the same epoch again, as after a failure
    g = G.read_graph(spark, root)
    assert g.E("RATED_AS").count() == n_edges + 2
    assert g.V("USER").count() == n_users + 1


def test_stream_schema(spark):
    landing = tempfile.mkdtemp(prefix="filmgraph-landing-")
    df = rating_stream(spark, landing)
    assert df.isStreaming
    assert df.columns == ["userId", "movieId", "rating", "timestamp", "_error", "_raw"]


def test_stream_keeps_adjacency_copies_in_step(spark):
    dataset = fixtures.dataset_for(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="filmgraph-adj-stream-")
    load.load_movies(spark, dataset, root)
    load.load_ratings(spark, dataset, root)
    load.build_adjacency(spark, root, "RATED_AS")
    landing = tempfile.mkdtemp(prefix="filmgraph-landing-")
    drop(landing, "c.csv", ["7000001,1,4.0,1", "7000001,2,3.0,2", "7000002,1,5.0,3"])
    q = start_ratings_stream(spark, landing, root,
                             checkpoint=tempfile.mkdtemp(prefix="filmgraph-ckpt-"))
    q.awaitTermination(300)
    assert q.exception() is None
    g = G.read_graph(spark, root)
    n = g.E("RATED_AS").count()
    assert g.adjacency[("RATED_AS", "out")].count() == n
    assert g.adjacency[("RATED_AS", "in")].count() == n
    from filmgraph.plans.traversal import Traversal
    got = Traversal.start(g, "USER", keys=[7000001]).out("RATED_AS").to_df().collect()
    assert sorted((r["key"], r["bulk"]) for r in got) == [(1, 1), (2, 1)]


# ---------------------------------------------------------------- late movies, shared users

def small_graph(spark, movies):
    from tests.test_loads import write
    ds, root = tempfile.mkdtemp(prefix="filmgraph-ds-"), tempfile.mkdtemp(prefix="filmgraph-late-")
    write(ds, "movies.csv", ["movieId,title,genres", *movies])
    load.load_movies(spark, ds, root)
    return ds, root


def run_stream(spark, root, lines, late_seconds=None, checkpoint=None, name="a.csv", landing=None):
    landing = landing or tempfile.mkdtemp(prefix="filmgraph-landing-")
    drop(landing, name, lines)
    checkpoint = checkpoint or tempfile.mkdtemp(prefix="filmgraph-ckpt-")
    q = start_ratings_stream(spark, landing, root, checkpoint=checkpoint, late_seconds=late_seconds)
    q.awaitTermination(300)
    assert q.exception() is None
    return landing, checkpoint


RATINGS = ["10,1,4.0,1", "10,2,3.0,2", "11,2,3.0,2", "11,2,3.0,2", "12,3,1.0,5", "12,x,1.0,5"]


def edges_of(spark, root):
    g = G.read_graph(spark, root, ["RATED_AS", "USER"])
    assert g.V("USER").groupBy("userId").count().where("count > 1").count() == 0
    return sorted(tuple(r) for r in g.E("RATED_AS").collect())


def quarantine(spark, root):
    return sorted(r["_error"] for r in spark.read.option("recursiveFileLookup", "true").parquet(
        f"{root}/_quarantine/ratings_stream").select("_error").collect())


def test_ratings_and_movies_in_either_order_give_the_same_edges(spark):
    from tests.test_loads import write
    movies = ["1,A (1990),x", "2,B (1991),y"]
    _, first = small_graph(spark, movies)
    run_stream(spark, first, RATINGS, late_seconds=1e6)
    ds, second = small_graph(spark, movies[:1])
    landing, checkpoint = run_stream(spark, second, RATINGS, late_seconds=1e6)
    assert [e[:2] for e in edges_of(spark, second)] == [(10, 1)]
    write(ds, "movies.csv", ["movieId,title,genres", *movies])
    load.load_movies(spark, ds, second)                      # releases what waited for movie 2
    assert edges_of(spark, second) == edges_of(spark, first) and len(edges_of(spark, first)) == 4
    # nothing is released twice, whoever asks
    from filmgraph.streaming import release_late_ratings
    assert release_late_ratings(spark, second) == {"released": 0, "expired": 0, "waiting": 1}
    run_stream(spark, second, ["10,2,3.0,2"], 1e6, checkpoint, "b.csv", landing)
    assert len(edges_of(spark, second)) == 5
    assert quarantine(spark, second) == ["bad movieId"]      # movie 3 is waited for
    done = release_late_ratings(spark, second, now=9e12)
    assert done == {"released": 0, "expired": 1, "waiting": 0}
    assert quarantine(spark, second) == ["bad movieId", "no vertex for dst"]
    assert release_late_ratings(spark, second, now=9e12) == {
        "released": 0, "expired": 0, "waiting": 0}
    write(ds, "movies.csv", ["movieId,title,genres", *movies, "3,C (1992),z"])
    load.load_movies(spark, ds, second)                      # too late for the expired one
    assert len(edges_of(spark, second)) == 5


def test_a_release_that_breaks_off_is_done_again(spark, monkeypatch):
    import pytest

    from filmgraph.streaming import ratings as R
    from tests.test_loads import write
    ds, root = small_graph(spark, ["1,A (1990),x"])
    run_stream(spark, root, RATINGS, late_seconds=1e6)
    write(ds, "movies.csv", ["movieId,title,genres", "1,A (1990),x", "2,B (1991),y"])
    real = R._write_edges
    monkeypatch.setattr(R, "_write_edges", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
    with pytest.raises(OSError):
        load.load_movies(spark, ds, root)
    assert len(edges_of(spark, root)) == 1
    monkeypatch.setattr(R, "_write_edges", real)
    assert R.release_late_ratings(spark, root)["released"] == 3
    assert len(edges_of(spark, root)) == 4


def test_two_overlapping_streams_store_a_user_once(spark):
    _, root = small_graph(spark, ["1,A (1990),x"])
    queries = []
    for k in range(2):
        landing = tempfile.mkdtemp(prefix="filmgraph-landing-")
        for f in range(3):
            drop(landing, f"{f}.csv", [f"{u},1,4.0,{k}" for u in range(f * 5, f * 5 + 20)])
        queries.append(start_ratings_stream(
            spark, landing, root, checkpoint=tempfile.mkdtemp(prefix="filmgraph-ckpt-"),
            max_files_per_trigger=1))
    for q in queries:
        q.awaitTermination(300)
        assert q.exception() is None
    g = G.read_graph(spark, root)
    assert sorted(r["userId"] for r in g.V("USER").collect()) == list(range(30))
    assert "Aggregate" not in g.V("USER")._jdf.queryExecution().executedPlan().toString()
    assert g.E("RATED_AS").count() == 120


def test_locks_wait_for_their_holder_and_outlive_a_dead_one(spark, tmp_root):
    import threading
    import time

    import pytest

    from filmgraph import session
    order = []

    def second():
        with session.lock(spark, f"{tmp_root}/_locks/x"):
            order.append("second")

    with session.lock(spark, f"{tmp_root}/_locks/x"):
        t = threading.Thread(target=second)
        t.start()
        time.sleep(0.6)
        order.append("first")
        with pytest.raises(TimeoutError):
            with session.lock(spark, f"{tmp_root}/_locks/x", wait=0.3):
                pass
    t.join(30)
    assert order == ["first", "second"]
    os.makedirs(f"{tmp_root}/_locks", exist_ok=True)
    with open(f"{tmp_root}/_locks/y", "w"):
        pass
    os.utime(f"{tmp_root}/_locks/y", (1, 1))
    with session.lock(spark, f"{tmp_root}/_locks/y", wait=1):
        pass
    assert not os.path.exists(f"{tmp_root}/_locks/y")
