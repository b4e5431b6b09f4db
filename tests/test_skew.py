"""A third of all rows on one key: results stay whole and the hot key is never shuffled into one
join task (checks on key sets, broadcast of the small sides)."""

from pyspark.sql import functions as F

from filmgraph.operators import integrity
from filmgraph.plans import build
from filmgraph.plans.traversal import Traversal, degrees
from filmgraph.sources.graphstore import Graph

N = 3000


def skewed(spark, hot_movie):
    # every third rating goes to the hot movie; the rest spread over movies 2..101
    return spark.range(N).select(
        (F.col("id") % 500).alias("userId"),
        F.when(F.col("id") % 3 == 0, F.lit(hot_movie)).otherwise(2 + F.col("id") % 100)
        .alias("movieId"),
        ((F.col("id") % 10) / 2).cast("double").alias("rating"),
        F.col("id").alias("timestamp"))


def movies(spark):
    rows = [(i, f"Movie {i} (2000)", "Drama") for i in range(1, 102)]
    return build.movie_tables(spark.createDataFrame(rows, "movieId bigint, title string, "
                                                          "genres string")).vertices["MOVIE"]


def test_hot_existing_movie(spark):
    t = build.rating_tables(skewed(spark, 1), movies(spark))
    edges = t.edges["RATED_AS"]
    assert edges.count() == N
    g = Graph(vertices={"USER": t.vertices["USER"], "MOVIE": movies(spark)},
              edges={"RATED_AS": edges})
    deg = {r["key"]: r["degree"] for r in degrees(g, "RATED_AS", "in").collect()}
    assert deg[1] == N // 3 and sum(deg.values()) == N
    # everyone who rated the hot movie, counted by path
    t2 = Traversal.start(g, "MOVIE", keys=[1]).in_("RATED_AS")
    got = {r["key"]: r["bulk"] for r in t2.to_df().collect()}
    brute = edges.where(F.col("dst") == 1).groupBy("src").count().collect()
    assert got == {r["src"]: r["count"] for r in brute}


def test_hot_dangling_movie_is_quarantined_whole(spark):
    t = build.rating_tables(skewed(spark, 999), movies(spark), mode="quarantine")
    good, bad = t.edges["RATED_AS"], t.rejected["RATED_AS"]
    assert bad.count() == N // 3 and good.count() == N - N // 3
    assert bad.select("dst").distinct().collect()[0]["dst"] == 999
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_hot_key_in_unique_check(spark):
    df = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id"))
                               .alias("k"), "id")
    checked = integrity.enforce_unique(df, "k", mode="quarantine")
    assert checked.rejected.count() == N // 3
    assert checked.accepted.count() == N - N // 3
    # copies of one whole row hold their key once
    copies = integrity.enforce_unique(df.select("k"), "k", mode="quarantine")
    assert copies.rejected.count() == 0 and copies.accepted.count() == N - N // 3 + 1
