import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filmgraph.llm import fim

PARTS = ["a", "Zb", " ", "\n", "é", "日本", "1", "<P", ">", "<S", "<M>", "\U0001F600", "\x00", "ß", "["]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=25).map("".join) | st.text(max_size=60)
UNITS = {"token": r"(?s)[A-Za-z]+|[^A-Za-z]", "line": r"[^\n]*\n|[^\n]+\Z", "char": r"(?s)."}


def plain(doc_id, text, t=fim.FillInMiddle()):
    """The transformation by a list of units."""
    text = text or ""
    units = re.findall(UNITS[t.unit], text)
    n = len(units)
    digest = hashlib.sha256(f"{t.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or (
            h3 % 100 >= 100 - t.plain_percent):
        return n, "plain", None, None, text
    if h4 % 100 < t.spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 10**18), TEXTS), min_size=1, max_size=8),
       st.sampled_from(sorted(UNITS)))
def test_batches_equal_a_plain_version(docs, unit):
    t = fim.FillInMiddle(unit=unit)
    got = fim.transform_batch([str(i) for i, _ in docs], [x for _, x in docs], t)
    assert got == [plain(i, x, t) for i, x in docs]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=300))
def test_ranks_of_the_wavelet_matrix(values):
    matrix = fim.WaveletMatrix(np.asarray(values, dtype=np.uint8), 3)
    at = np.arange(len(values) + 1)
    for v in range(8):
        assert matrix.rank(v, at).tolist() == [values[:i].count(v) for i in at]


def test_texts_are_classified_in_chunks(monkeypatch):
    monkeypatch.setattr(fim, "CHUNK", 3)
    rng = random.Random(1)
    for _ in range(300):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(9))) for _ in range(3)]
        for unit in UNITS:
            t = fim.FillInMiddle(unit=unit)
            assert fim.transform_batch(["1", "2", "3"], texts, t) == [
                plain(i, x, t) for i, x in enumerate(texts, 1)]


def test_tables_with_nulls_long_texts_ties_and_clashes(llm):
    rng = random.Random(2)
    rows = [(None, "no id here", "a"), (3, None, "b"), (4, "", "c"), (5, "x <S> y", "d"),
            (2**53 + 1, "one two three", "e"), (2**53 + 1, "one two three", "e"),
            (-2**63 + 1, "far below", "f"), (6, "Wort und Wört\n" * 40_000, "g")]
    rows += [(100 + i, "".join(rng.choice(PARTS) for _ in range(50)), "z") for i in range(300)]
    df = llm.createDataFrame(rows, "doc_id long, text string, output string").repartition(3)
    made = fim.transform(df, "f")
    assert made.columns == ["doc_id", "text", "output", "f"]
    back = fim.restored(F.col("f.output"), F.col("f.form"))
    got = made.withColumn("back", back).collect()
    assert len(got) == len(rows)
    forms = set()
    for r in got:
        assert tuple(r["f"]) == plain(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
        forms.add(r["f"]["form"])
    assert forms == {"plain", "psm", "spm"}
    assert fim.transform(df.limit(0), "f").count() == 0


def test_unknown_unit():
    with pytest.raises(ValueError):
        fim.FillInMiddle(unit="page")
