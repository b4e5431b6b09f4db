"""Write PLANS.md: the physical plans of the headline operations.

Run ``python tools/plans.py [sf_dir]``. The broadcast threshold is set to 100 bytes so that every
stored table counts as large, as it would at cluster scale; explicit broadcasts are the
library's size-checked ones.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from filmgraph import session  # noqa: E402
from filmgraph.functions import search as P  # noqa: E402
from filmgraph.operators import edges as E  # noqa: E402
from filmgraph.operators import integrity, responses  # noqa: E402
from filmgraph.plans import build, load  # noqa: E402
from filmgraph.plans import search as Q  # noqa: E402
from filmgraph.plans.pattern import Pattern  # noqa: E402
from filmgraph.plans.traversal import Traversal  # noqa: E402
from filmgraph.sources import dataset, fixtures  # noqa: E402
from filmgraph.sources import graphstore as G  # noqa: E402


def physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    details = [blk for blk in text.split("\n\n")[1:]
               if any(k in blk for k in ("Scan parquet", "BroadcastHashJoin", "SortMergeJoin"))]
    keep = []
    for blk in details:
        lines = [ln for ln in blk.splitlines()
                 if ln.startswith("(") or ln.startswith(("PushedFilters", "ReadSchema",
                                                         "Join type", "DataFilters"))]
        keep.append("\n".join(lines))
    return tree.strip() + "\n\n" + "\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session.build_session("local[8]", "plans", {
        "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "100"})
    spark.sparkContext.setLogLevel("ERROR")
    ds = fixtures.dataset_for(spark, sf_dir)
    root = session.new_scratch(spark, "plans-graph")
    load.load_all(spark, ds, root, adjacency=("RATED_AS",), edge_ids=("RATED_AS",))
    g = G.read_graph(spark, root)
    staged = load.stage(dataset.read_ratings(spark, ds), session.new_scratch(spark, "ratings"))
    answers = responses.records(responses.classify(dataset.read_omdb_responses(spark, ds)))
    credits = load.stage(E.credit_items(answers),
                         session.new_scratch(spark, "plans") + "/omdb_credits")
    cases = [
        ("RATED_AS edges in the ratings load (no join: the endpoint check ran on key sets)",
         build.rating_tables(staged, g.V("MOVIE")).edges["RATED_AS"]),
        ("Referential check: distinct rated movies without a MOVIE vertex",
         integrity.dangling_keys(E.rated_as_edges(staged), "dst", g.V("MOVIE"), "movieId")),
        ("USER vertices: partial aggregation before the shuffle",
         build.rating_tables(staged, g.V("MOVIE")).vertices["USER"]),
        ("Two hops from one user: frontier keys pushed into the clustered adjacency copies, "
         "frontiers broadcast",
         Traversal.start(g, "USER", keys=[7]).out("RATED_AS").in_("RATED_AS").to_df()),
        ("Range search on RATED_AS: filters and column pruning reach the scan",
         Q.ratings_in_range(g, (3.0, 4.0), (883612800, 915148800)).select("src", "dst")),
        ("Labelled pattern, selected: the reduced edge tables joined, no row a dead end",
         Pattern.start(g, "me", "USER", keys=[7]).out("me", "RATED_AS", "movie")
         .in_("movie", "RATED_AS", "other").matches().select("movie", "other")),
        ("Edges by id: hashes pushed into the id index",
         Q.edges_by_id(g, "RATED_AS", [r["edge_id"] for r in g.edges_with_ids("RATED_AS")
                                       .limit(2).collect()])),
        ("Pattern search on titles: keys of the movies that hold the needed runs, then the check",
         Q.text_search(g, "MOVIE", "movieTitle", regex="blue (wid|gi).*199.*")),
        ("Movie search by ranges: predicates pushed into the copy along the curve",
         Q.search_movies(g, P.between("movieYear", 1980, 1990),
                         F.col("movieImdbScore") >= 5.0).select("movieId", "movieTitle")),
        ("Key lookup by a list of ids", Q.lookup(g, "MOVIE", "movieId", [1, 2, 3])),
        ("One credit label from the staged credit table",
         E.credit_edges(credits, "WRITTEN_BY")),
    ]
    out = ["# Physical plans of the headline operations", "",
           "Generated by `python tools/plans.py` at " + os.path.basename(sf_dir) + " with "
           "`spark.sql.autoBroadcastJoinThreshold=100` (every stored table counts as large). "
           "AQE is on; plans are shown before adaptive re-planning.", ""]
    for title, df in cases:
        out += [f"## {title}", "", "```", physical(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
