import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from filmgraph.llm import spelling as S

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def plain_words(docs, v=S.Vocabulary()):
    """Every run on its own, by the statement of the operator."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if v.thin_every and h % v.thin_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= v.min_chars and n >= v.min_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    """All words against all words."""
    form, number = {}, {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        number[w] = len(others)
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, number[w], counts[form[w]] if form[w] else None))
    return out


def rows(df):
    got = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_words_forms_and_roots_equal_a_plain_version(llm):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(4, 9))) for _ in range(120)]

    def typo(w):
        at = rng.randrange(len(w))
        return rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abéÿ×") + w[at:],
                           w[:at] + rng.choice("abÀ") + w[at + 1:]])

    docs = []
    for i in range(300):
        picked = [stems[min(int(rng.expovariate(0.06)), 119)] for _ in range(60)]
        picked = [typo(w) if rng.random() < 0.1 else w.upper() if rng.random() < 0.1 else w
                  for w in picked]
        docs.append((i, rng.choice([" ", "1", "\n"]).join(picked)))
    docs += [(None, docs[0][1]), (7, None), (8, ""), (7, docs[7][1]), (7, docs[7][1]),
             (2**53 + 1, "kkkkkkk " * 50), (2**53 + 3, "q" * 3000 + " " + "q" * 2999)] * 3
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = plain_words(docs)
    assert {r["word"]: r["n"] for r in S.words(df).collect()} == want
    assert "q" * 3000 in want or "q" * 2999 in want
    got = rows(S.group(df.selectExpr("*", "'x' AS word", "1 AS n")))
    assert got == plain_variants(want)
    assert any(r[1] and r[2] != r[1] for r in got)       # chains longer than one form


def test_long_texts_are_counted_in_parts(llm, monkeypatch):
    docs = [(1, "alpha beta gamma alpha alphb " * 20)]
    df = llm.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(S, "FOUND_AT_ONCE", 7)
    monkeypatch.setattr(S, "HELD_WORDS", 1)
    assert {r["word"]: r["n"] for r in S.words(df).collect()} == plain_words(docs)


def test_empty_tables(llm):
    for data in ([], [(1, None), (2, "ab cd")]):
        df = llm.createDataFrame(data, "doc_id long, text string")
        assert S.group(df).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=12), st.text("ab", max_size=12))
def test_common_prefix(a, b):
    import os
    assert S.shared(a, b) == len(os.path.commonprefix([a, b]))


def test_nodes_are_one_number_for_each_prefix_over_many_ranges(llm):
    rng = random.Random(3)
    found = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(400)}
    df = llm.createDataFrame([(w,) for w in sorted(found)], "s string")
    old = llm.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        nodes = S.trie_nodes(df, "trie-test").collect()
    finally:
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    by_prefix = {}
    for r in nodes:
        assert len(r["nodes"]) == len(r["s"])
        for d, x in enumerate(r["nodes"], 1):
            assert by_prefix.setdefault(r["s"][:d], x) == x
    assert len(set(by_prefix.values())) == len(by_prefix) and 0 not in by_prefix.values()
    assert {r["s"] for r in nodes} == found
    order = [r["nodes"][-1] for r in sorted(nodes, key=lambda r: r["s"])]
    assert order == sorted(order)
