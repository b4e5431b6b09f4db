"""Ids above 2^53 beside a null: no operator may turn them into doubles on their way to a worker."""

import pytest
from pyspark.sql import functions as F

from filmgraph.llm import fim, langid, line_rules, lm, minhash, mix, pack, pfor, pu_quality

BIG = [2**53 + 1, 2**53 + 3, -2**63 + 1, 2**63 - 1, None, None, 7]


@pytest.fixture(scope="module")
def docs(llm):
    rows = [(i, f"document number {k} has words of its own {k * k}", "en", "s")
            for k, i in enumerate(BIG)]
    return llm.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()),
                  key=lambda x: (x is None, x or 0))


WANT = sorted(BIG, key=lambda x: (x is None, x or 0))
RUNS = {
    "packing": lambda d: pack.pack(d).filter("start = 0"),
    "token files": pfor.round_trip,
    "near duplicates": minhash.near_duplicates,
    "kept": minhash.keep_one,
    "line rules": lambda d: line_rules.judge(d, "v"),
    "mixing": lambda d: mix.mix(d, "m"),
    "quality": lambda d: pu_quality.score(d, pu_quality.constant(), "q"),
    "language model": lambda d: lm.score(d.select("doc_id", "text", F.lit(False).alias("held_out"))),
    "fill in middle": lambda d: fim.transform(d, "f"),
    "language": lambda d: langid.predict(d, langid.fit(d), "p"),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_ids_stay_what_they_are(docs, name):
    assert ids(RUNS[name](docs)) == WANT


def test_components_carry_whole_ids(llm):
    rows = [(i, "the same words in every row of this table") for i in BIG[:5]]
    got = minhash.near_duplicates(llm.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert {r["component_id"] for r in got.collect()} == {-2**63 + 1, None}
