import zlib

import duckdb
import numpy as np

from filmgraph.llm import pu_quality as Q

SF = "/root/testdata/sf0.01"


def test_features_of_odd_texts():
    for text in (None, "", " ", "a", "\x00", "x" * 200_000, "é🙂\ud83d"[:2]):
        x = Q.features(text)
        assert x.shape == (Q.N_FEATURES,) and np.isfinite(x).all()


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    pos = rng.normal(2, 1, 4000)
    unl = np.concatenate([rng.normal(2, 1, 3000), rng.normal(-2, 1, 3000)])
    assert abs(Q.best_bin_prior(pos, unl) - 0.5) < 0.06


def test_non_negative_risk_separates_without_negative_labels():
    rng = np.random.default_rng(2)

    def draw(n, sign):
        x = np.zeros((n, Q.N_FEATURES))
        x[:, :30] = rng.normal(sign * 0.8, 1, (n, 30))
        return x

    model = Q.fit_matrix(draw(600, 1), np.concatenate([draw(700, 1), draw(300, -1)]), Q.Training())
    assert 0.6 < model.prior < 0.8
    assert (model.scores(draw(300, 1)) >= 0.3).mean() > 0.95
    assert (model.scores(draw(300, -1)) < 0.3).mean() > 0.9


def test_constant_model_without_samples(llm, make_docs):
    labels = llm.createDataFrame([], "doc_id long, quality int")
    model = Q.fit(make_docs([(1, "a"), (2, None)]), labels)
    rows = Q.score(make_docs([(1, "a"), (2, None), (None, "")]), model, "s").collect()
    assert [r["s"] for r in rows] == [0.5] * 3
    assert Q.score(make_docs([]), model, "s").count() == 0


def test_held_out_accuracy_and_determinism(llm):
    from filmgraph.llm import entry

    rows = entry.op5_pu_quality(llm, SF).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows
            if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert np.mean([p == q for p, q in held]) > 0.93
    good = [p for p, q in held if q == 1]
    assert np.mean(good) > 0.97
    again = {r["doc_id"]: r["score"] for r in entry.op5_pu_quality(llm, SF).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in rows)


def test_other_columns_pass(llm):
    df = llm.createDataFrame([(1, "a", 3)], "doc_id long, text string, score int")
    zero = np.zeros(Q.N_FEATURES)
    model = Q.Model(zero, 0.0, zero, zero + 1, 0.5)
    assert Q.score(df, model, "s").columns == ["doc_id", "text", "score", "s"]


def plain_descent(p, u, prior, t):
    """The non-negative risk, its slope and the steps, number by number."""
    import math

    def sigmoid(z):
        return 1 / (1 + math.exp(-z))

    def softplus(z):
        return math.log1p(math.exp(z))

    size = len(p[0])
    w, b = [0.0] * size, 0.0
    m, v, late, n_late = [0.0] * (size + 1), [0.0] * (size + 1), [0.0] * (size + 1), 0
    for step in range(1, t.steps + 1):
        z = {"p": [sum(a * c for a, c in zip(w, x)) + b for x in p],
             "u": [sum(a * c for a, c in zip(w, x)) + b for x in u]}
        slope = [0.0] * (size + 1)

        def add(rows, scores, factor, positive):
            for x, s in zip(rows, scores):
                d = factor * (-sigmoid(-s) if positive else sigmoid(s)) / len(rows)
                for k in range(size):
                    slope[k] += d * x[k]
                slope[size] += d

        negative = (sum(map(softplus, z["u"])) / len(u)
                    - prior * sum(map(softplus, z["p"])) / len(p))
        if negative >= 0:
            add(p, z["p"], prior, True)
            add(p, z["p"], -prior, False)
            add(u, z["u"], 1, False)
        else:                                        # the negative part alone, uphill
            add(p, z["p"], prior, False)
            add(u, z["u"], -1, False)
        for k in range(size):
            slope[k] += t.decay * w[k]
        rate = t.rate * (1 - 0.9 * step / t.steps)
        for k in range(size + 1):
            m[k] = 0.9 * m[k] + 0.1 * slope[k]
            v[k] = 0.999 * v[k] + 0.001 * slope[k] ** 2
            move = rate * (m[k] / (1 - 0.9 ** step)) / (math.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
            if k < size:
                w[k] -= move
            else:
                b -= move
        if 2 * step > t.steps:
            n_late += 1
            late = [x + y for x, y in zip(late, [*w, b])]
    return [x / n_late for x in late]


def test_descent_equals_plain_loops():
    rng = np.random.default_rng(5)
    p = rng.normal(0.7, 1, (12, 4)).astype(np.float32)
    u = np.concatenate([rng.normal(0.7, 1, (6, 4)), rng.normal(-2, 0.3, (9, 4))]).astype(np.float32)
    t = Q.Training(steps=40, rate=0.3)
    for prior in (0.1, 0.4, 0.9):                    # the larger ones make the bracket negative
        w, b = Q._descend(p, u, prior, t)
        assert np.allclose([*w, b], plain_descent(p.tolist(), u.tolist(), prior, t), atol=1e-4)


def test_prior_equals_plain_loops():
    import math

    rng = np.random.default_rng(6)
    for _ in range(20):
        pos, unl = rng.normal(1, 1, 70).tolist(), rng.normal(0, 1.5, 90).tolist()
        margin = (math.sqrt(math.log(40) / (2 * len(unl))) + math.sqrt(math.log(40) / (2 * len(pos))))
        best = None
        for cut in sorted(pos):
            share_pos = sum(x >= cut for x in pos) / len(pos)
            share_unl = sum(x >= cut for x in unl) / len(unl)
            bound = (share_unl + margin) / share_pos
            if best is None or bound < best[0]:
                best = (bound, share_unl / share_pos)
        want = min(max(best[1], 0.05), 0.98)
        assert abs(Q.best_bin_prior(np.asarray(pos), np.asarray(unl)) - want) < 1e-12


def test_a_repeated_id_is_one_row_of_the_sample(llm):
    rows = [(1, f"copy {i}") for i in range(300)] + [(i, f"text of {i}") for i in range(2, 40)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = llm.createDataFrame([(i, 1) for i in range(1, 20)], "doc_id long, quality int")
    once = docs.dropDuplicates(["doc_id"]).filter("doc_id <> 1").unionByName(
        llm.createDataFrame([(1, "copy 0")], "doc_id long, text string"))
    a, b = Q.fit(docs, labels), Q.fit(once, labels)
    assert np.array_equal(a.weights, b.weights) and a.prior == b.prior
