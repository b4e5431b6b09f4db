import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from filmgraph.llm import common, entry, line_rules, sql
from tests.compare import compare
from tests.llm.test_minhash import brute

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = E.queries()
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(sql.SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_statement_and_query_agree(llm, name):
    got = compare(llm, SF, [name], verbose=False)[name]
    assert got["ok"] if "ok" in got else all(
        got[k] for k in got if k.endswith("match")), got


def test_stages_keep_columns_and_meet_a_plain_version(llm):
    docs = common.table(llm, SF, "documents").selectExpr("*", "'x' AS kept", "1 AS pu_score")
    columns = docs.columns
    ids = {}
    for name, stage in C.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs = common.written(stage(llm, docs, SF), "stage")
        assert docs.columns == columns
        rows = docs.collect()
        ids[name] = [r["doc_id"] for r in rows]
        if name == "quality rules":
            want = {r[0] for r in before
                    if line_rules.judge_text(r[1], line_rules.LineRules())[6]}
            assert set(ids[name]) == want
        if name == "near duplicates":
            groups = brute([(r[0], r[1]) for r in before])
            assert sorted(ids[name]) == sorted(i for i, (_, c) in groups.items() if c == i)
        if name == "mixing":
            assert set(ids[name]) <= {r[0] for r in before}
            assert max(ids[name].count(i) for i in set(ids[name])) <= 3
    pieces = C.STAGES[-1][1](llm, docs, SF).collect()
    assert sorted({p["doc_id"] for p in pieces}) == sorted(set(ids["mixing"]))
    tokens = sum(p["length"] for p in pieces)
    assert max(p["sequence_id"] for p in pieces) == (tokens - 1) // 2048


def test_stages_on_odd_rows_and_empty_tables(llm):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int"
    good = " ".join(f"word{i}" for i in range(80)) + "."
    rows = [(None, None, None, None, None, None), (1, good, None, None, 1, 1),
            (1, good, None, None, 1, 1), (2, "", "en", "s", 0, 1), (None, good, "en", "s", 9, 1)]
    for data in (rows, []):
        docs = llm.createDataFrame(data, schema)
        for _, stage in C.STAGES[:-1]:
            docs = common.written(stage(llm, docs, SF), "odd")
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        C.STAGES[-1][1](llm, docs, SF).collect()


def test_run_equals_the_stages(llm):
    rows = C.run(llm, SF).count()
    docs = common.table(llm, SF, "documents")
    for _, stage in C.STAGES:
        docs = common.written(stage(llm, docs, SF), "again")
    assert docs.count() == rows and rows > 0


def test_every_query_reads_whole_tables():
    import inspect

    source = inspect.getsource(entry)
    assert ".limit(" not in source and ".sample(" not in source
