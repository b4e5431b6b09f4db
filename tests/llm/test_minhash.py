import math
import random

import numpy as np

from filmgraph.llm import minhash as M
from tests.llm.test_common import brute_components

WORDS = [f"w{i}" for i in range(5000)]


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    ids = sorted(i for i in sets if sets[i])
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    comp = brute_components(links)
    return {i: (len(sets[i]), comp.get(i, i)) for i in sets}


def answers(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in M.near_duplicates(df)
            .collect()}


def test_sketch_is_filled_and_concentrated():
    rng = np.random.default_rng(1)
    for n in (2, 30, 400):
        errors = []
        for _ in range(60):
            base = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
            a, b = base[:int(1.7 * n)], base[2 * n - int(1.7 * n):]
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append((M.sketch(a) == M.sketch(b)).mean() - true)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.055
    assert len(np.unique(M.sketch(np.array([5], dtype=np.uint64)))) > 100


def test_sketch_does_not_depend_on_order():
    items = np.random.default_rng(2).integers(0, 2**63, 50, dtype=np.uint64)
    assert np.array_equal(M.sketch(items), M.sketch(items[::-1].copy()))


def test_groups_match_brute_force(make_docs):
    rng = random.Random(8)
    docs = []
    for g in range(12):                      # bases with copies edited more and more: chains
        words = [rng.choice(WORDS) for _ in range(rng.choice([6, 40, 120]))]
        docs.append(" ".join(words))
        for _ in range(rng.choice([2, 25])):
            if rng.random() < 0.5:
                words = list(words)
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            docs.append(" ".join(words))
    docs += ["one two three", "ONE two\tthree", "one  two three", "a", "A", "", None, " \n",
             " ".join(WORDS) * 3, " ".join(WORDS) * 3 + " x"]
    docs = list(enumerate(docs))
    rng.shuffle(docs)
    assert answers(make_docs(docs)) == brute(docs)


def test_straggler_linked_to_a_member_but_not_to_the_centre(make_docs):
    words = [f"a{i}" for i in range(100)]
    near, far = list(words), list(words)
    for i in (10,):
        near[i] = f"x{i}"
    far = list(near)
    for i in (50,):
        far[i] = f"y{i}"
    docs = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))]
    want = brute(docs)
    assert {c for _, c in want.values()} == {1}
    assert answers(make_docs(docs)) == want


def test_exact_threshold(make_docs):
    docs = []
    for n in range(20, 60):                  # one word appended: n - 4 of n - 3 shingles shared
        words = [f"t{n}_{i}" for i in range(n)]
        cut = int(0.85 * (n - 4) + 0.999999)
        docs += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(words[:cut + 4]))]
    assert answers(make_docs(docs)) == brute(docs)


def test_null_ids_repeated_rows_and_ids_with_several_texts(llm, make_docs):
    long = " ".join(WORDS[:50])
    other = " ".join(WORDS[100:150])
    docs = [(4, long), (4, long), (None, long), (7, long), (7, other), (9, other), (None, None)]
    rows = M.near_duplicates(make_docs(docs)).collect()
    assert len(rows) == 7
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in rows} == {
        (4, 4, True), (7, 4, False), (9, 4, False), (None, None, True)}
    kept = M.keep_one(make_docs(docs)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept if r["doc_id"]) == [(False, 4)]
    assert sum(r["doc_id"] is None for r in kept) == 2
    clash = make_docs(docs).withColumnRenamed("lang", "cls").withColumnRenamed("source", "kept")
    assert M.keep_one(clash).columns == clash.columns


def test_empty_table(make_docs):
    assert M.near_duplicates(make_docs([])).count() == 0
    assert M.keep_one(make_docs([])).count() == 0


def test_large_group_of_near_copies_is_split_and_whole(llm, make_docs):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(60)]
    docs = []
    for i in range(2500):                    # more distinct members than a block holds
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            words[rng.randrange(60)] = f"e{rng.randrange(40)}"
        docs.append((i, " ".join(words)))
    distinct = {}
    for i, t in docs:
        distinct.setdefault(t, i)
    want = brute([(i, t) for t, i in distinct.items()])
    got = answers(make_docs(docs))
    assert got == {i: want[distinct[t]] for i, t in docs}


def test_one_of_each_group_is_kept_at_the_threshold_that_is_given(make_docs):
    docs, want = [], {}
    for g, percent in enumerate((78, 79, 81, 82, 83, 84, 86)):
        words = [f"g{g}_{i}" for i in range(304)]       # 300 shingles, of which the copy has a part
        docs += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[:3 * percent + 4]))]
        want[2 * g + 1] = percent
    kept = M.keep_one(make_docs(docs), 80).collect()
    assert {r["doc_id"] for r in kept if r["doc_id"] % 2} == {i for i in want if want[i] < 80}
    strict = M.keep_one(make_docs(docs)).collect()
    assert {r["doc_id"] for r in strict if r["doc_id"] % 2} == {i for i in want if want[i] < 85}


def test_crossing_links_at_080(make_docs):
    # one document is linked to the others of its buckets only by way of a stranger to their centre
    words = [f"a{i}" for i in range(100)]
    near, far = list(words), list(words)
    near[10] = "x10"
    far = list(near)
    far[50] = "y50"
    far[90] = "z90"
    docs = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))]
    got = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(make_docs(docs), 80).collect()}
    assert got == {1: 1, 2: 1, 3: 1}


def test_the_gate_on_sketches_drops_less_than_the_banding():
    for percent in (80, 85):
        p, least = percent / 100, round(M.min_share(percent) * M.SIZE)
        tail = sum(math.comb(M.SIZE, k) * p ** k * (1 - p) ** (M.SIZE - k) for k in range(least))
        assert 0 < tail < 1e-9 < (1 - p ** M.ROWS) ** M.BANDS


def test_pairs_with_an_unlucky_sketch_are_compared():
    # 84 of 125 equal coordinates, which a pair at 0.85 may have
    sketches = [np.zeros(M.SIZE, np.uint32), np.r_[np.ones(41), np.zeros(84)].astype(np.uint32)]
    frame = M.pd.DataFrame({"key": 1, "block": 0, "role": [0, 1], "rep": [1, 2], "comp": [1, 2],
                            "sketch": [x.tobytes() for x in sketches]})
    out = M.pd.concat(list(M._likely([frame], M.min_share(85))))
    assert sorted(out["rep"]) == [1, 2]


def test_blocks_stripes_and_cuts_by_shingles(make_docs, monkeypatch):
    """A crowd of near copies over many blocks and stripes, with sets cut by their shingles."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(120)] = f"e{rng.randrange(30)}"
        docs.append((i, " ".join(words)))
    want = brute(docs)
    for block, stripe, held in ((16, 1, 300), (1024, 4, 1500)):
        monkeypatch.setattr(M, "BLOCK", block)
        monkeypatch.setattr(M, "STRIPE", stripe)
        monkeypatch.setattr(M, "BLOCK_SHINGLES", held)
        assert answers(make_docs(docs)) == want


def test_a_task_holds_a_bounded_number_of_shingles(llm, make_docs, monkeypatch):
    """Long texts in one bucket: no task gets the sets of all of them."""
    monkeypatch.setattr(M, "BLOCK_SHINGLES", 20_000)
    seen = llm.sparkContext.accumulator(0)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(4000)]
    docs = []
    for i in range(24):                       # similar to their neighbours, less and less to the first
        base = list(base)
        for _ in range(14):
            base[rng.randrange(4000)] = f"x{i}_{rng.randrange(10**6)}"
        docs.append((i, " ".join(base)))
    linked = M._linked

    def watched(frames, percent):
        frames = list(frames)
        held = {}
        for f in frames:
            for *at, role, items in zip(f["key"], f["block"], f["cut"], f["role"], f["items"]):
                if role == 0:
                    held[tuple(at)] = held.get(tuple(at), 0) + len(items)
        seen.add(sum(v > 80_000 for v in held.values()))
        return linked(iter(frames), percent)

    monkeypatch.setattr(M, "_linked", watched)
    assert answers(make_docs(docs)) == brute(docs)
    assert seen.value == 0
