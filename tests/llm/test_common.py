import random

from pyspark.sql import functions as F

from filmgraph.llm import common


def brute_components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def test_components_match_union_find(llm):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(1, 1500)]
    edges = [(a, b) for a, b in edges if a != b]
    got = common.components(llm.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["component"] for r in got} == brute_components(edges)


def test_components_of_no_edges(llm):
    assert common.components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_lookup_join_returns_hot_and_other_keys(llm):
    rows = llm.range(6000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"),
                                  "id")
    lookup = common.written(rows.groupBy("k").agg(F.count("*").alias("n"))
                            .filter("k <> 5000"), "lookup")
    out = common.lookup_join(rows, lookup, ["k"], "n", 6000)
    assert out.count() == 5999
    assert out.select("id").distinct().count() == 5999


def test_word_count_and_fold(llm):
    df = llm.createDataFrame([(1, "a b c\td\x0be"), (2, None), (None, " \n")],
                             "doc_id long, text string")
    rows = df.select(common.word_count(F.col("text")), common.fold(F.col("doc_id"))).collect()
    assert [r[0] for r in rows] == [4, 0, 0]      # a no-break space separates nothing
    assert rows[2][1] == 0


def test_release_deletes_all_but_the_last_tables(llm):
    from filmgraph import session

    common.scratch_start()
    first, last = (common.written(llm.range(3), n) for n in ("one", "two"))
    paths = list(common._scratch)
    common.release(llm, keep=1)
    assert [session.path_exists(llm, p) for p in paths] == [False, True]
    assert last.count() == 3 and first is not last


def test_free_name(llm):
    df = llm.createDataFrame([(1, 2)], "X long, x_ long")
    assert common.free_name(df, "x") == "x__"


def test_broadcast_sides_are_bounded_in_rows_and_bytes(llm, monkeypatch):
    from filmgraph.operators import sizing

    df = common.written(llm.range(100).selectExpr("id", "repeat('x', 1000) AS s",
                                                  "array('a', 'b') AS a"), "sides")

    def hinted(side):
        return "ResolvedHint" in side._jdf.queryExecution().analyzed().toString()

    assert hinted(common.bounded(df)) and not hinted(common.bounded(df, 99))
    monkeypatch.setattr(sizing, "BROADCAST_BYTE_LIMIT", 50_000)
    assert not hinted(common.bounded(df)) and hinted(common.bounded(df.select("id")))
