"""Driver contract: the flagship query, and every registered query against its oracle."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from compare import compare  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["movie_id", "title", "year", "n_listed"]


# The optional operators have tests of their own (not all of them can be stated in SQL).
OWN = [q for q in E.queries() if q != "pipeline" and not q.startswith("op")]


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


def test_queries_match_oracle(spark):
    res = compare(spark, SF_SMALL, OWN, verbose=False)
    bad = {k: v for k, v in res.items() if not v["ok"]}
    assert not bad, bad
