"""Steps whose bytes or memory outgrew their input: what their plans hold now, and the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgraph.functions import grams
from filmgraph.operators import integrity
from filmgraph.sources import fixtures
from filmgraph.sources import graphstore as G


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_credits_follow_the_last_line_item_without_sorting(spark, tmp_root):
    tables = {
        "part": ([(i, f"p {i}", 1 + i) for i in range(1, 5)], "p_partkey long, p_name string, p_size int"),
        "supplier": ([(i, f"S{i}") for i in range(10)], "s_suppkey long, s_name string"),
        "customer": ([(i, f"C{i}") for i in range(10)], "c_custkey long, c_name string"),
        "nation": ([(i, f"N{i}") for i in range(25)], "n_nationkey int, n_name string"),
        "orders": ([(1, 7), (2, 8)], "o_orderkey long, o_custkey long"),
        # part 1: the later order; part 2: the later line, without a supplier; part 4: no line item
        "lineitem": ([(1, 1, 1, 3), (2, 1, 1, 5), (2, 2, 2, 6), (2, 3, 2, None), (1, 2, 3, 9)],
                     "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_root}/{name}.parquet")
    made = fixtures.omdb(spark, tmp_root)
    got = {int(r["movieId"]): (r["d"], r["a"]) for r in made.select(
        "movieId", F.get_json_object("response", "$.Director").alias("d"),
        F.get_json_object("response", "$.Actors").alias("a")).collect()}
    assert got == {1: ("S5", "C8, Actor 1"), 2: ("S2", "C8, Actor 2"), 3: ("S9", "C7, Actor 3"),
                   4: ("S4", "C4, Actor 4")}
    assert "SortAggregate" not in plan(made)


def test_endpoints_are_counted_in_their_own_type(spark):
    edges = spark.createDataFrame([(1, 10), (1, 10), (2, 11), (None, 12)], "src long, dst long")
    names = spark.createDataFrame([("x", 10), (None, 99)], "src string, dst long")
    users = spark.createDataFrame([(1,), (1,), (3,)], "userId long")
    movies = spark.createDataFrame([(10,), (12,), (None,)], "movieId long")
    people = spark.createDataFrame([("x",)], "name string")
    report = integrity.references_report(
        {"A": (edges, [("src", "U"), ("dst", "M")]), "B": (names, [("src", "P"), ("dst", "M")]),
         "C": (edges.limit(0), [("src", "U")])},
        {"U": (users, "userId"), "M": (movies, "movieId"), "P": (people, "name")})
    assert {tuple(r) for r in report.collect()} == {
        ("A", "src", 4, 2, 2), ("A", "dst", 4, 1, 1), ("B", "src", 2, 1, 1), ("B", "dst", 2, 1, 1),
        ("C", "src", 0, 0, 0)}
    assert "Generate" not in plan(report) and "as string" not in plan(report)


def _ids(spark, root):
    return G.read_graph(spark, root, ["RELEASED_IN"]).edges_with_ids("RELEASED_IN")


def test_ids_of_one_table_are_not_aggregated_again(spark, tmp_root):
    rows = spark.createDataFrame([(1, 5), (1, 5), (2, 6)], "src long, dst long")
    G.write_edges(rows, tmp_root, "RELEASED_IN")
    G.write_edge_ids(rows, tmp_root, "RELEASED_IN")
    one = _ids(spark, tmp_root)
    assert "Aggregate" not in plan(one)
    own = sorted(r["edge_id"] for r in one.collect())
    assert [x.rsplit(":", 1)[1] for x in own].count("1") == 1 and len(set(own)) == 3
    # an edge that comes again in a stream adds to the copies of the first
    more = f"{G.stream_path(tmp_root, 'ids', 'RELEASED_IN')}/s/epoch-0"
    G.write_edge_ids(rows.where("src = 1"), tmp_root, "RELEASED_IN", path=more)
    both = [r["edge_id"] for r in _ids(spark, tmp_root).collect()]
    assert len(set(both)) == len(both) == 5 and set(own) < set(both)


def test_edges_without_an_index_are_aggregated_once(spark):
    rows = spark.createDataFrame([(1, 5), (1, 5), (2, 6)], "src long, dst long")
    got = G.Graph(edges={"RELEASED_IN": rows}).edges_with_ids("RELEASED_IN")
    assert len({r["edge_id"] for r in got.collect()}) == 3
    logical = got._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Aggregate [") == 2          # once in each branch: few and many copies


def test_a_text_is_folded_once_for_all_its_runs(spark):
    df = spark.createDataFrame([("Ab",), ("",), (None,), ("aBab",)], "x string")
    cut = df.select(grams.grams(F.col("x")).alias("g"))
    assert [r["g"] for r in cut.collect()] == [
        ["\x02ab", "ab\x03"], [], [], ["\x02ab", "aba", "bab", "ab\x03"]]
    assert plan(cut).lower().count("translate(") == 1


def test_pieces_are_counted_from_the_postings_written(spark, tmp_root, monkeypatch):
    rows = spark.createDataFrame([(1, "Red ring"), (2, "ring ring"), (3, ""), (4, None)],
                                 "tagId long, tagName string")
    planted = spark.createDataFrame([("tagName", G.TOKEN, "planted", 9)], G.postings_schema("TAG"))
    real = G.publish

    def publish(session, folder, write):
        path = real(session, folder, write)
        if folder.endswith(G.POSTINGS):
            planted.write.mode("append").parquet(path)
        return path

    monkeypatch.setattr(G, "publish", publish)
    paths = G.write_postings(rows, tmp_root, "TAG")
    postings, counts = (spark.read.parquet(p) for p in paths)
    assert "counts/" in paths[1]
    held = {(r["kind"], r["piece"]): r["n"] for r in counts.collect()}
    assert held.pop((G.ALL, "")) == 3                  # values, also empty ones
    assert held == {(r["kind"], r["piece"]): r["count"] for r in
                    postings.groupBy("kind", "piece").count().collect()}
    assert held[(G.TOKEN, "planted")] == 1         # no text held it
    assert held[(G.TOKEN, "ring")] == 2 and held[(G.GRAM, "rin")] == 2
