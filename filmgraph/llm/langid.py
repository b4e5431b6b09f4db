"""Language identification by averaged subword embeddings and a linear softmax.

A text is a bag of subwords: of each run of letters, with marks at its ends, all byte n-grams of the
chosen orders and the run itself, hashed to a fixed number of buckets. The text's vector is the mean
of the buckets' embeddings; a linear layer and a softmax give the languages' probabilities.
Embeddings and layer are learnt together by stochastic gradient descent, one document a step. The
layer is linear, so a bucket's share of every logit is worked out once, and each different run of a
batch is looked up once.

A part of the sample is left out of the descent: on it a temperature is fitted that makes the
probabilities honest, and the smallest probability is sought from which on the predictions reach the
asked accuracy. Predictions below it are marked as not accepted.

The model is fitted in one task on at most ``Training.documents`` different texts, an equal number for
each language, chosen by a hash of the text; every document is predicted on its whole text.

Null texts and texts without a letter are ``und`` with score 0, and so is everything if there is nothing
to learn from. Rows without a language teach nothing; copies of a text teach once; a text under
several languages teaches each. Runs of more than CHUNK characters are cut there. Other columns pass
through whatever their names. An empty table stays empty.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .hashing import hash_ranges

UNKNOWN = "und"
CHUNK = 1 << 18                   # characters hashed at once
ORDERS = (2, 3, 4)
_LEFT, _RIGHT = 0x02, 0x03        # marks around a run; no letter has these bytes
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Training:
    documents: int = 4000         # documented bound of the sample, over all languages
    buckets: int = 1 << 15
    width: int = 16
    epochs: int = 4
    rate: float = 0.5
    calibration_every: int = 5    # each so-manieth text of the sample is kept for the calibration
    accuracy: float = 0.99        # asked of the accepted predictions
    seed: int = 11


@dataclass(frozen=True)
class Model:
    langs: list[str]
    table: np.ndarray             # share of each bucket in the logit of each language
    bias: np.ndarray
    temperature: float
    accept: float                 # smallest accepted probability

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities of the languages, a row for each text."""
        total = np.zeros((len(texts), len(self.langs)))
        count = np.zeros(len(texts))
        for owner, piece in _batches(texts):
            words, grams, gram_word, doc, word = subwords(piece, owner, len(self.table))
            one = np.zeros((words, len(self.langs)))
            at = np.flatnonzero(np.diff(gram_word, prepend=-1))     # each run has n-grams
            if len(at):
                one[gram_word[at]] = np.add.reduceat(self.table[grams], at, axis=0)
            size = np.bincount(gram_word, minlength=words)
            if len(doc):
                begin = np.flatnonzero(np.diff(doc, prepend=-1))
                total[doc[begin]] += np.add.reduceat(one[word], begin, axis=0)
                count[doc[begin]] += np.add.reduceat(size[word], begin)
        logits = total / np.maximum(count, 1)[:, None] + self.bias
        return softmax(logits / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _batches(texts: list[str | None]):
    """``(owners, pieces)``: the texts in order, in batches of about CHUNK characters. Longer texts are
    cut behind a blank if the last thousand characters of a piece have one."""
    owner, pieces, size = [], [], 0
    for i, text in enumerate(texts):
        text = text or ""
        at = 0
        while at < len(text):
            end = at + CHUNK
            if end < len(text):
                blank = text.rfind(" ", max(at, end - 1000), end)
                end = blank + 1 if blank >= 0 else end
            owner.append(i)
            pieces.append(text[at:end].lower())
            size += end - at
            at = end
            if size >= CHUNK:
                yield owner, pieces
                owner, pieces, size = [], [], 0
    if owner:
        yield owner, pieces


def subwords(pieces: list[str], owner: list[int], buckets: int):
    """The different runs of letters of some lower-cased pieces of text: their number, the buckets of
    their subwords with the run each belongs to (ascending); and for each run that occurs, in
    order, its text and which of the different runs it is."""
    raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
    buffer = b"\n".join(raw) + b"\n"
    data = np.frombuffer(buffer, dtype=np.uint8)
    edge = np.flatnonzero(np.diff(_LETTER[data], prepend=False))
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum([len(r) + 1 for r in raw])
    doc = np.asarray(owner, dtype=np.int64)[np.searchsorted(ends, start, side="right")]
    key, one, word = np.unique(hash_ranges(data, start, end), return_index=True,
                               return_inverse=True)
    size = (end - start)[one]
    # the different runs side by side, each with its marks
    place = np.cumsum(size + 2) - (size + 2)
    marked = np.full(int((size + 2).sum()), _RIGHT, dtype=np.uint8)
    marked[place] = _LEFT
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    marked[np.repeat(place + 1, size) + inner] = data[np.repeat(start[one], size) + inner]
    grams, of = [key], [np.arange(len(one))]
    for n in ORDERS:
        number = np.maximum(size + 3 - n, 0)
        run = np.repeat(np.arange(len(one)), number)
        at = np.repeat(place, number) + np.arange(len(run)) - np.repeat(
            np.cumsum(number) - number, number)
        grams.append(hash_ranges(marked, at, at + n))
        of.append(run)
    grams, of = np.concatenate(grams), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    bucket = (grams[order] >> np.uint64(40)) % np.uint64(buckets)
    return len(one), bucket.astype(np.int64), of[order], doc, word


def bag(text: str | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's subwords, ascending, and how often each occurs."""
    total = np.zeros(buckets, dtype=np.int64)
    for owner, pieces in _batches([text]):
        words, grams, of, _, word = subwords(pieces, owner, buckets)
        times = np.bincount(word, minlength=words)
        total += np.bincount(grams, weights=times[of], minlength=buckets).astype(np.int64)
    held = np.flatnonzero(total)
    return held, total[held]


def fit_bags(langs: list[str], labels: np.ndarray, bags: list[tuple], t: Training) -> Model:
    """Descent over the bags of texts whose language is ``langs[label]``."""
    rng = np.random.default_rng(t.seed)
    kept = np.asarray([i for i, (ids, _) in enumerate(bags) if len(ids)], dtype=np.int64)
    kept = rng.permutation(kept)
    held = kept[::t.calibration_every] if len(kept) >= 10 * t.calibration_every else kept[:0]
    learn = np.setdiff1d(kept, held)
    shares = [(ids, (n / n.sum()).astype(np.float32)) for ids, n in bags]
    table = rng.uniform(-1, 1, (t.buckets, t.width)).astype(np.float32) / t.width
    layer = np.zeros((t.width, len(langs)), dtype=np.float32)
    bias = np.zeros(len(langs), dtype=np.float32)
    steps = t.epochs * max(len(learn), 1)
    for epoch in range(t.epochs):
        for k, i in enumerate(rng.permutation(learn)):
            rate = t.rate * (1 - (epoch * len(learn) + k) / steps)
            ids, share = shares[i]
            rows = table[ids]
            hidden = share @ rows
            slope = softmax(hidden @ layer + bias)
            slope[labels[i]] -= 1
            back = layer @ slope
            layer -= rate * np.outer(hidden, slope)
            bias -= 0.1 * rate * slope
            # every subword of the text moves by the same step; ids are distinct
            table[ids] = rows - (rate * t.width) * share[:, None] * back
    logits = table @ layer
    model = Model(langs, logits.astype(np.float64), bias.astype(np.float64), 1.0, 0.0)
    if not len(held):
        return model
    z = np.stack([shares[i][1] @ model.table[shares[i][0]] + model.bias for i in held])
    return Model(langs, model.table, model.bias, *calibrate(z, labels[held], t.accuracy))


def calibrate(z: np.ndarray, labels: np.ndarray, accuracy: float) -> tuple[float, float]:
    """The temperature of the least log loss, and the smallest probability from which on the
    predictions are right often enough (above all of them if they never are)."""
    def loss(temperature: float) -> float:
        p = softmax(z / temperature)[np.arange(len(z)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    temperature = min(np.geomspace(0.05, 20, 121).tolist(), key=loss)
    p = softmax(z / temperature)
    best = p.max(axis=1)
    order = np.argsort(-best, kind="stable")
    right = (p.argmax(axis=1) == labels)[order]
    good = np.flatnonzero(np.cumsum(right) >= accuracy * np.arange(1, len(right) + 1))
    return float(temperature), float(best[order[good[-1]]]) if len(good) else 1.1


def sample(docs: DataFrame, documents: int) -> DataFrame:
    """``lang, h, text`` of at most ``documents`` different texts of ``docs(text, lang)``, as many for each
    language as far as it has them: those of the smallest hashes. Copies are collapsed by their tasks
    before anything is gathered."""
    named = docs.select(F.col("lang").cast("string").alias("lang"),
                        F.col("text").cast("string").alias("text")).filter(
        "lang is not null and text is not null").withColumn("h", F.xxhash64("text"))
    keys = common.written(named.select("lang", "h").distinct(), "lang-texts")
    sizes = {r["lang"]: r["count"] for r in keys.groupBy("lang").count().collect()}
    if not sizes:
        return named.limit(0).select("lang", "h", "text")
    bound = max(1, documents // len(sizes))
    # hashes are evenly spread: a share of their range has that share of the texts
    cuts = docs.sparkSession.createDataFrame(
        [(x, min(0.9 * bound / n, 1.0) * 2.0 ** 64 - 2.0 ** 63) for x, n in sizes.items()],
        "lang string, cut double")
    chosen = (keys.join(F.broadcast(cuts), "lang").filter(F.col("h").cast("double") <= F.col("cut"))
              .select("lang", "h").orderBy("h", "lang").limit(documents))
    return (named.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h")
            .agg(F.min("text").alias("text")))


def fit(docs: DataFrame, t: Training | None = None) -> Model | None:
    """Fit on ``docs(text, lang)``; the caller leaves out what must not be learnt from. None without a
    text to learn from."""
    t = t or Training()

    @F.pandas_udf("ids array<int>, n array<long>")
    def bags(texts: pd.Series) -> pd.DataFrame:
        rows = [bag(x, t.buckets) for x in texts]
        return pd.DataFrame({"ids": [r[0].astype(np.int32) for r in rows],
                             "n": [r[1] for r in rows]})

    def train(frames):
        parts = [frame for frame in frames if len(frame)]
        if parts:
            # in the order of the hashes: the fit does not depend on the partitioning
            rows = pd.concat(parts, ignore_index=True).sort_values(["h", "lang"])
            langs = sorted(set(rows["lang"]))
            labels = rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
            own = [(np.asarray(i, dtype=np.int64), np.asarray(n, dtype=np.int64))
                   for i, n in zip(rows["ids"], rows["n"], strict=True)]
            yield pd.DataFrame({"model": [pickle.dumps(fit_bags(langs, labels, own, t))]})

    made = (sample(docs, t.documents).select("lang", "h", bags("text").alias("b"))
            .select("lang", "h", "b.*").repartition(1).mapInPandas(train, "model binary").collect())
    return pickle.loads(made[0]["model"]) if made else None


def predict(docs: DataFrame, model: Model | None, out: str, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``out``: lang, score (its calibrated probability) and accepted
    (false for ``und`` and below the accepted probability)."""
    kind = "lang string, score double, accepted boolean"
    none = F.from_json(F.lit(f'{{"lang": "{UNKNOWN}", "score": 0.0, "accepted": false}}'), kind)
    if model is None:
        return docs.withColumn(out, none)

    @F.pandas_udf(kind)
    def judged(texts: pd.Series) -> pd.DataFrame:
        p = model.probabilities([x if isinstance(x, str) else None for x in texts])
        best = p.argmax(axis=1)
        score = p[np.arange(len(p)), best]
        return pd.DataFrame({"lang": [model.langs[i] for i in best], "score": score,
                             "accepted": score >= model.accept})

    body = F.col(text).cast("string")
    return docs.withColumn(out, F.when(F.coalesce(body.rlike(r"\p{L}"), F.lit(False)),
                                       judged(body)).otherwise(none))
