import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filmgraph import session
from filmgraph.llm import pfor as P
from filmgraph.llm import tokens

PARTS = ["a", "b ", " ", "  ", "\n", "\t", "É", "!", "<|endoftext|>", "1", "'s", "x\n", "\r", "日本"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=9).map("".join) | st.text(max_size=30))
def test_pieces_give_the_ids_of_the_whole_text(text):
    coder = tokens.encoder(tokens.default_path())
    whole = coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert coder.ids(text).tolist() == whole


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=300), st.floats(0, 1))
def test_block_round_trip(values, percentile):
    ids = np.asarray(values, dtype="<u4")
    assert np.array_equal(P.unpack_block(P.pack_block(ids, percentile), 0), ids)


def test_outliers_go_to_the_exception_list():
    ids = np.full(1000, 7, dtype="<u4")
    ids[10] = 4_000_000_000
    assert len(P.pack_block(ids, 0.98)) < 40


def test_index_finds_every_block():
    rng = np.random.default_rng(1)
    docs = [(i, rng.integers(0, 50000, n).astype("<u4")) for i, n in
            enumerate([1, 0, 5000, 3, 400_000, 2048])]
    data = b"".join(s + P.SYNC.encode() for s in P.file_segments(iter(docs), 3, 0.98))
    starts, ids, lengths, number = P.read_index(data)
    flat = np.concatenate([x for _, x in docs])
    assert number == 3 and ids.tolist() == list(range(6)) and lengths.sum() == len(flat)
    at = 0
    for s in starts.tolist():
        block = P.unpack_block(data, s)
        assert np.array_equal(block, flat[at:at + len(block)])
        at += len(block)
    assert at == len(flat)
    back = list(P.file_documents(data))
    assert all(np.array_equal(a[1], b[2]) for a, b in zip(docs, back, strict=True))
    with pytest.raises(ValueError):
        P.read_index(data[:-1])


def test_files_in_id_order_with_nulls_ties_and_clashes(llm):
    rows = [(5, "five five", 1), (None, "no id", 2), (2, None, 3), (9, "", 4), (2, "two", 5),
            (5, "five five", 6), (7, "long " * 30_000, 7)]
    df = llm.createDataFrame(rows, "doc_id long, text string, start long").repartition(4)
    path = session.new_scratch(llm, "token-test")
    P.write(df, path)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"])
                 for r in P.documents(llm, path).collect())
    assert [g[1] for g in got] == [None, 2, 2, 5, 5, 7, 9]
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    coder = tokens.encoder(tokens.default_path())
    from filmgraph.llm.common import crc32_u4
    want = {i: crc32_u4(np.append(coder.ids(t), 0)) for i, t, _ in rows}
    assert all(want[d] == c for _, d, _, c in got if d != 2)


def test_empty_table(llm):
    assert P.round_trip(llm.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_documents_equal_a_plain_writer(llm):
    """Every document of a driver table, in id order, by the library alone."""
    import zlib

    import duckdb
    from tokenizers import Tokenizer

    from filmgraph.llm import common, entry

    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(tokens.default_path())
    at, want = 0, []
    for doc_id, text in duckdb.sql(
            f"SELECT doc_id, coalesce(text, '') FROM '{sf}/documents.parquet' ORDER BY 1").fetchall():
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((doc_id, at, len(ids), zlib.crc32(raw)))
        at += len(ids)
    rows = entry.op7_token_files(common.configure(llm), sf).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
