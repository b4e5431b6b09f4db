import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np

from filmgraph.llm import hashing as H
from filmgraph.llm import lm as L
from filmgraph.llm import tokens


def words(text):
    return (text or "").encode().lower().split()


def brute_base(docs, held):
    train = [words(t) for i, t in docs if i not in held]
    counts = Counter(w for t in train for w in t)
    counts["end"] = len(train)
    total, distinct = sum(counts.values()), len(counts) - (not train)
    norm = total + 0.5 * (distinct + 1)
    out = {}
    for i, t in docs:
        own = [*words(t), "end"]
        out[i] = (len(own), sum(counts[w] > 0 for w in own), total,
                  sum(math.log10((counts[w] + 0.5) / norm) for w in own))
    return out


def small_model(seed=1):
    size = 400
    counts = np.random.default_rng(seed).integers(0, 50, size)
    sample = [np.append(np.random.default_rng(i).integers(0, size - 1, 90), size - 1)
              for i in range(20)]
    model = L.build(counts, sample, seed)
    rng = np.random.default_rng(seed)
    for k in ("direct", "near"):
        model.params[k] += rng.normal(0, 0.5, model.params[k].shape).astype(np.float32)
    return model, sample


def test_word_hashes_follow_words_not_places():
    h = H.word_hashes("Foo bar\tfoo ÄB äB\x0bx y")
    assert len(h) == 6 and h[0] == h[2] and h[3] != h[4] and len(set(h.tolist())) == 5
    assert len(H.word_hashes(None)) == 0 and len(H.word_hashes(" \n")) == 0
    long = "ab cd " * 400_000
    assert len(np.unique(H.word_hashes(long))) == 2 and len(H.word_hashes(long)) == 800_000


def test_gradient_matches_finite_differences():
    model, sample = small_model()
    x, y, _ = L.windows(sample[:3], model)
    cls = np.where(y >= 0, model.class_of[np.maximum(y, 0)], -1)
    params = {k: v.astype(np.float64) for k, v in model.params.items()}
    _, g = L.gradient(params, x[:6], cls[:6])
    for k, v in params.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), v.shape)
        old, losses = v[at], []
        for step in (1e-4, -1e-4):
            v[at] = old + step
            losses.append(L.gradient(params, x[:6], cls[:6])[0])
        v[at] = old
        assert abs((losses[0] - losses[1]) / 2e-4 - g[k][at]) < 1e-4 * max(1, abs(g[k][at]) * 100)


def many_windows(model, sample):
    x, y, _ = L.windows([*sample, sample[0][:1], np.concatenate(sample)], model)
    return x, np.where(y >= 0, model.class_of[np.maximum(y, 0)], -1)


def test_windows_of_several_texts_match_a_plain_loop():
    model, sample = small_model()
    texts = [sample[0], sample[1][-1:], sample[2][:32], sample[3][:33]]
    x, y, owner = L.windows(texts, model)
    at = 0
    for d, t in enumerate(texts):
        rows = [model.pad_row] * L.CONTEXT + [model.row_of[model.end], *model.row_of[t[:-1]]]
        for lo in range(0, len(t), L.STEP):
            want = rows[lo:lo + L.CONTEXT + L.STEP]
            want += [model.pad_row] * (L.CONTEXT + L.STEP - len(want))
            assert x[at].tolist() == want and owner[at] == d
            assert y[at].tolist() == [*t[lo:lo + L.STEP], *[-1] * (lo + L.STEP - len(t))]
            at += 1
    assert at == len(x)


def test_slopes_of_a_batch_are_the_mean_of_its_windows():
    model, sample = small_model()
    x, cls = many_windows(model, sample)
    params = {k: v.astype(np.float64) * (3 if k in ("wq", "wk") else 1) for k, v in model.params.items()}
    loss, g = L.gradient(params, x, cls)                 # several blocks, some scores at their bounds
    assert len(x) > 2 * L.BLOCK and (np.abs(L.Forward(params).q) == 2).any()
    each = [((c >= 0).sum(), *L.gradient(params, w[None], c[None])) for w, c in zip(x, cls, strict=True)]
    n = sum(own for own, _, _ in each)
    assert abs(sum(own * one for own, one, _ in each) / n - loss) < 1e-9
    for k, v in g.items():
        assert np.allclose(sum(own * slopes[k] for own, _, slopes in each) / n, v, atol=1e-7)


def test_steps_and_scores_work_in_arrays_that_are_kept():
    model, sample = small_model()
    x, cls = many_windows(model, sample * 2)
    room, adam = L.Room(), L.Adam({k: v for k, v in model.params.items() if k != "direct"})
    texts, forward = sample * 4, L.Forward(model.params)
    peaks = []
    for work in (lambda: L.step(model, adam, x, cls, 0.01, ("direct",), room),
                 lambda: L.log_probs(model, forward, texts, room)):
        work()
        tracemalloc.start()
        work()
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    # a batch's scores alone (windows x STEP x keys) are larger
    scores = len(x) * L.STEP * (L.CONTEXT + L.STEP) * 4
    assert max(peaks) < scores


def naive_log_prob(model, ids):
    """Token by token, with an explicit loop over the keys of its window."""
    p, total = model.params, 0.0
    e = p["embed"].astype(np.float64)
    rows = [model.row_of[model.end], *model.row_of[ids[:-1]]]
    for j, target in enumerate(ids):
        lo = max(0, j - j % L.STEP - L.CONTEXT)
        q = np.clip(e[rows[j]] @ p["wq"], -2, 2)
        weight, mixed = 0.0, np.zeros(L.WIDTH)
        for i in range(lo, j + 1):
            w = math.exp(q @ np.clip(e[rows[i]] @ p["wk"], -2, 2)
                         + float(np.clip(p["near"][j - i], -10, 10)))
            weight, mixed = weight + w, mixed + w * (e[rows[i]] @ p["wv"])
        h = np.maximum(mixed / weight + e[rows[j]], 0)
        z = h @ p["out"] + p["direct"][rows[j]]
        total += (z[model.class_of[target]] - math.log(np.exp(z).sum())) / math.log(10)
        total += model.log_share[target]
    return total


def test_windows_score_each_token_once_and_match_a_plain_loop():
    model, sample = small_model()
    texts = [sample[0], sample[1][:5], sample[2][-1:], np.concatenate([sample[3][:-1]] * 3)]
    got = L.log_probs(model, L.Forward(model.params), texts)
    assert np.allclose(got, [naive_log_prob(model, t) for t in texts], rtol=1e-4)
    _, y, owner = L.windows(texts, model)
    for d, t in enumerate(texts):
        assert (y[owner == d].ravel()[:len(t)] == t).all()
        assert (y[owner == d].ravel()[len(t):] == -1).all()


def test_probabilities_of_all_next_tokens_sum_to_one():
    model, sample = small_model()
    start = sample[0][:3]
    texts = [np.append(start, t) for t in range(len(model.row_of))]
    f = L.Forward(model.params)
    rest = L.log_probs(model, f, [start])[0]
    assert abs((10 ** (L.log_probs(model, f, texts) - rest)).sum() - 1) < 1e-4


def test_training_lowers_the_loss():
    model, sample = small_model()
    text = np.append(np.tile(np.arange(10), 30), len(model.row_of) - 1)
    before = L.log_probs(model, L.Forward(model.params), [text])[0]
    L.train(model, [text] * 8, 60, 0.02, 1)
    assert L.log_probs(model, L.Forward(model.params), [text])[0] > before / 2


def test_scores_match_brute_force_with_nulls_and_repeats(llm):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(vocab[:5] if rng.random() < 0.6 else vocab)
                         for _ in range(rng.randint(0, 80)))) for i in range(60)]
    docs += [(60, None), (61, "ONLY held words\x0bÉ"), (62, "")]
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 1} | {61}
    rows = [(i, t, i in held, 1.0) for i, t in docs]
    df = llm.createDataFrame(rows, "doc_id long, text string, held_out boolean, score double")
    out = L.score(df.repartition(3), L.Training(warm_steps=20, share=1, shard_tokens=1000))
    got = {r["doc_id"]: r for r in out.collect()}
    want = brute_base(docs, held)
    assert got.keys() == want.keys()
    for i, (n, known, total, base) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base))
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert got[60]["score"] == got[62]["score"]


def test_repeated_rows_null_ids_and_empty_tables(llm):
    df = llm.createDataFrame([(1, "a b", None), (1, "a b", False), (None, "c", False)],
                             "doc_id long, text string, held_out boolean")
    few = L.Training(warm_steps=5, share=1)
    rows = L.score(df, few).collect()
    assert len(rows) == 3 and len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    assert L.score(df.limit(0), few).count() == 0
    none = L.score(df.selectExpr("doc_id", "text", "true AS held_out"), few).collect()
    assert {(r["train_tokens"], r["n_known"]) for r in none} == {(0, 0)}


def test_every_training_document_takes_part_in_the_shard_pass(llm):
    # document i consists of token i; a table row moves only if its token was trained on
    rows = [(i, None if i % 2 else "same", i % 4 == 3, True,
             bytearray(np.full(5, i, dtype="<u2").tobytes()), 6) for i in range(80)]
    read = llm.createDataFrame(rows, "key long, doc_id string, held_out boolean, small boolean, "
                                     "ids binary, n_ids long")
    model, _ = small_model()
    after = L.averaged(read, model, L.Training(shard_tokens=50))
    moved = (after.params["direct"] != model.params["direct"]).any(axis=1)
    assert [bool(moved[model.row_of[i]]) for i in range(80)] == [i % 4 != 3 for i in range(80)]


def id_rows(texts):
    return [(i, str(i), False, True, bytearray(np.array(t, dtype="<u2").tobytes()), len(t) + 1)
            for i, t in enumerate(texts)]


READ = "key long, doc_id string, held_out boolean, small boolean, ids binary, n_ids long"


def test_classes_follow_all_training_ids(llm):
    # tokens 100-119 stand behind 1 and tokens 200-219 behind 2, all behind the first 2,048 ids of
    # their text or in documents that the warm start need not see
    rng = np.random.default_rng(3)
    head = rng.integers(300, 340, 2100).tolist()
    texts = [head + [1, 100 + i % 20, 3, 2, 200 + i % 20, 4] * 3 for i in range(40)]
    read = llm.createDataFrame(id_rows(texts), READ).repartition(3)
    size = 400
    counts = L._token_counts(read, size)
    got = {r["key"]: r["c"] for r in L._neighbour_counts(read, counts).collect()}
    want, frame = Counter(), L._frames(counts)
    for t in texts:
        t = [*t, size - 1]
        for a, b in zip(t, t[1:], strict=False):
            want[b * L.NEAR + frame[a]] += 1
            want[a * L.NEAR + frame[b] + 256] += 1
    assert got == want
    few = L.Training(warm_documents=2, warm_steps=1)
    cls = L.fit(read, size, len(texts), few).class_of
    first, second = set(cls[100:120].tolist()), set(cls[200:220].tolist())
    assert not first & second


def test_warm_start_takes_runs_from_anywhere_in_a_text(llm):
    texts = [range(5000)] * 30 + [range(2048), range(7), range(0)]
    rows = L._runs(llm.createDataFrame(id_rows(texts), READ), L.Training()).collect()
    runs = [np.frombuffer(r["ids"], "<u2").tolist() for r in rows]
    assert all(r == list(range(r[0], r[0] + 2048)) for r in runs[:30])
    assert len({r[0] for r in runs[:30]}) > 20
    assert [len(r) for r in runs[30:]] == [2048, 7, 0]


def test_vocabulary_of_the_model_covers_the_tokenizer():
    size = tokens.encoder(tokens.default_path()).tokenizer.get_vocab_size()
    assert size == 50257


def corpus(n=200, seed=5):
    """Texts in which the word before last decides: what a table of previous tokens cannot tell."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = ["the", "big"]
        for _ in range(rng.randint(20, 120)):
            text.append({"the": "dog", "old": "cat"}.get(text[-2], rng.choice(["the", "old", "a"])))
        out.append((i, " ".join(text)))
    return out


def test_scores_do_not_depend_on_the_partitioning(llm):
    docs = corpus() + [(7, corpus()[7][1])] * 30 + [(None, "the big dog")] * 3 + [(900, None)]
    df = llm.createDataFrame([(i, t, i is not None and i % 5 == 1) for i, t in docs],
                             "doc_id long, text string, held_out boolean")
    t = L.Training(warm_steps=30, warm_documents=40, shard_tokens=3000)
    runs = []
    for part in (df.coalesce(1), df.repartition(4), df.repartition(7, "text")):
        rows = L.score(part, t).collect()
        runs.append(sorted(((r["doc_id"] or -1, r["score"], r["base_score"]) for r in rows)))
    for other in runs[1:]:
        assert len(other) == len(docs)
        for a, b in zip(runs[0], other, strict=True):
            assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-3 and abs(a[2] - b[2]) < 1e-6


def test_each_part_of_the_training_lowers_the_loss_of_held_out_texts(llm, monkeypatch):
    df = llm.createDataFrame([(str(i), t, i % 5 == 1) for i, t in corpus(600)],
                             "doc_id string, text string, held_out boolean")
    read = L._read(df, L.pd.DataFrame({"h": np.zeros(0, np.int64), "c": np.zeros(0, np.int64)}),
                   1.0, 1, tokens.default_path())
    size = tokens.encoder(tokens.default_path()).tokenizer.get_vocab_size() + 1
    held = L._ids(read.filter("held_out").toPandas(), size - 1)

    def loss(model):
        return -L.log_probs(model, L.Forward(model.params), held).sum() / sum(map(len, held))

    counts = L._token_counts(read, size)
    monkeypatch.setattr(L, "SHARD_BATCH", 8)
    t = L.Training(warm_steps=150, warm_documents=100, shard_tokens=20_000)
    near = L._neighbour_counts(read, counts).toPandas()
    plain = L._model(counts, L._classes(counts, near["key"].to_numpy(), near["c"].to_numpy(), t.seed),
                     t.seed)
    plain.params["out"][:] = 0
    mass = np.bincount(plain.class_of, counts, L.CLASSES)
    unigram = L.Model({**plain.params, "direct": np.tile(np.log((mass + 1) / (mass.sum() + L.CLASSES)),
                                                         (len(plain.params["direct"]), 1))},
                      plain.row_of, plain.class_of, plain.log_share)
    table = L.Model({**plain.params, "direct": L._direct(L._direct_counts(read, plain))},
                    plain.row_of, plain.class_of, plain.log_share)
    whole = L.fit(read, size, 480, t)
    assert np.array_equal(whole.params["direct"], table.params["direct"])
    warm = L.fit(read.filter("held_out or doc_id is null"), size, 0, t)       # learns nothing
    assert loss(whole) < loss(table) - 0.02 and loss(table) < loss(unigram) - 0.02
    assert loss(warm) > loss(unigram)
    monkeypatch.setattr(L, "averaged", lambda read, model, t, fixed: model)   # the warm start alone
    assert loss(whole) < loss(L.fit(read, size, 480, t))


def test_table_of_previous_tokens_counts_every_training_id(llm):
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 300, rng.integers(0, 60)).tolist() for _ in range(50)]
    read = llm.createDataFrame(id_rows(texts), READ).repartition(3)
    model, _ = small_model()
    want = Counter()
    for t in texts:
        t = [*t, model.end]
        for a, b in zip([model.end, *t], t):
            want[model.row_of[a], model.class_of[b]] += 1
    got = L._direct_counts(read, model)
    assert got.sum() == sum(want.values()) and all(got[k] == n for k, n in want.items())
    p = np.exp(L._direct(got))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_a_shard_has_one_optimiser_and_bounded_groups(llm, monkeypatch):
    model, sample = small_model()
    steps = []
    monkeypatch.setattr(L, "GROUP_IDS", 100)
    update = L.Adam.update
    monkeypatch.setattr(L.Adam, "update", lambda self, p, g, rate, rows: (
        steps.append((id(self), rate)), update(self, p, g, rate, rows)))
    shard = L.ShardTraining(model, L.Training(shard_tokens=2000), ("direct",))
    for ids in [*sample, np.concatenate(sample)]:
        shard.add(ids)
    shard.flush()
    rates = [r for _, r in steps]
    assert len({a for a, _ in steps}) == 1 and rates[0] < min(rates[5:]) and rates[-1] < max(rates)
    assert shard.seen == 2 * sum(map(len, sample)) and len(steps) > 20
    assert np.array_equal(shard.model.params["direct"], model.params["direct"])
