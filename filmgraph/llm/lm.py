"""Language-model scores: a unigram base over words and a causal self-attention model over subwords.

Base: counts of all training words are summed on Spark; words above a 1/FREQUENT share of all
tokens (so fewer than FREQUENT of them) are sent to the tasks that read the texts, the rest meets
its counts in a join on word hashes.

Model: lower-cased texts become subword ids of a public tokenizer. A token's probability is that of
its class given the context, times its share of the class. The share comes from the counts of all
training documents. The class distribution is a softmax over
``relu(attention(context) + embedding) @ out + direct[previous token]``, where one masked attention
head looks back over the context. Texts are cut into windows of ``STEP`` new tokens behind
``CONTEXT`` earlier ones, so windows overlap and each token is scored once, in batches.

Training is numpy throughout. ``direct`` has a closed form: the smoothed logarithms of how often each
class follows each token, counted over all training ids; it stays as it is. The attention learns what
the previous token alone does not tell: a warm start on a bounded sample, then every training document
goes to a shard, each shard trains on its own with one optimiser, and the shards' parameters are
averaged (summed on Spark, not on the driver). Samples, shards and orders follow from hashes of id and
ids, sums run in shard order, so the model does not depend on the partitioning or on lost tasks.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import as_strided
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, tokens
from .hashing import word_hashes

CONTEXT, STEP = 32, 32
WIDTH = 16                        # of embeddings, keys, queries and values
CLASSES, SINGLES = 64, 40         # the most frequent tokens are classes of their own
OWN_ROWS, SHARED_ROWS = 8192, 256  # input rows: frequent tokens, and buckets for the others
NEAR = 512                        # neighbour columns a token is grouped by, 256 on either side
FREQUENT = 200_000
BATCH = 64                        # half the windows of a step of the warm start
BLOCK = 32                        # windows worked out at once
SHARD_BATCH = 128                 # windows of a step in the shards
SETTLE = 60                       # steps over which a shard's rate rises
GROUP_IDS = 500_000               # ids of a shard whose windows are shuffled at once
PRIOR = 20.0                      # weight of the classes' shares in the rows of ``direct``
FIXED = ("direct",)
COUNT_WORDS = 2_000_000         # words a task counts at once


@dataclass(frozen=True)
class Training:
    tokenizer: str | None = None
    warm_documents: int = 1500        # documented bounds of the warm start
    warm_tokens: int = 2048           # of each document
    warm_steps: int = 600
    rate: float = 0.01
    share: int = 1                    # one of so many training documents goes to the shards
    shard_tokens: int = 2_000_000
    shard_rate: float = 0.006
    seed: int = 11


# ---------------------------------------------------------------- model

@dataclass
class Model:
    """Parameters by name, and the fixed tables token -> input row, class, share of the class."""

    params: dict[str, np.ndarray]
    row_of: np.ndarray                # last entry: the end token, which also opens a text
    class_of: np.ndarray
    log_share: np.ndarray             # log10 of a token's share of its class

    @property
    def end(self) -> int:
        return len(self.row_of) - 1

    @property
    def pad_row(self) -> int:
        return len(self.params["embed"]) - 1


def new_params(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    rows = OWN_ROWS + SHARED_ROWS + 2
    small = WIDTH ** -0.5
    return {k: v.astype(np.float32) for k, v in {
        "embed": rng.normal(0, 0.3, (rows, WIDTH)),
        "wq": rng.normal(0, small, (WIDTH, WIDTH)), "wk": rng.normal(0, small, (WIDTH, WIDTH)),
        "wv": rng.normal(0, small, (WIDTH, WIDTH)),
        "near": np.zeros(CONTEXT + STEP),          # added to a score by distance
        "out": rng.normal(0, small, (WIDTH, CLASSES)), "direct": np.zeros((rows, CLASSES))}.items()}


# key position i of a window is absolute place i - CONTEXT, query j is place j
_LAG = np.arange(STEP)[:, None] + CONTEXT - np.arange(CONTEXT + STEP)[None]
_CAUSAL = (_LAG >= 0)
_LAG_AT = np.clip(_LAG, 0, CONTEXT + STEP - 1)


def blocks(ids: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, given with their end token, cut into blocks of ``STEP`` tokens: (input rows [n + 1, STEP]
    behind a block of padding, target tokens [n, STEP] with -1 for none, text of each block)."""
    size = np.array([len(t) for t in ids])
    n = -(-size // STEP)
    start = (np.cumsum(n) - n) * STEP
    x = np.full((n.sum() + 1, STEP), model.pad_row, dtype=np.int32)
    y = np.full((n.sum(), STEP), -1, dtype=np.int32)
    tokens_ = np.concatenate(ids)
    at = np.arange(len(tokens_)) + np.repeat(start - (np.cumsum(size) - size), size)
    y.reshape(-1)[at] = tokens_
    x[1:].reshape(-1)[at[1:]] = model.row_of.take(tokens_[:-1])
    x[1:].reshape(-1)[start] = model.row_of[model.end]
    return x, y, np.repeat(np.arange(len(ids)), n)


def windows(ids: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(input rows [n, CONTEXT + STEP], target tokens [n, STEP] with -1 for none, document of each
    window) for texts given with their end token."""
    x, y, owner = blocks(ids, model)
    x = np.concatenate([x[:-1], x[1:]], axis=1)
    x[_opens(owner), :CONTEXT] = model.pad_row
    return x, y, owner


def _opens(owner: np.ndarray) -> np.ndarray:
    """Whether a block is the first of its text."""
    return np.diff(owner, prepend=-1) > 0


def _classes_of(y: np.ndarray, model: Model) -> np.ndarray:
    cls = model.class_of.take(y, mode="clip")
    cls[y < 0] = -1
    return cls


class Room:
    """Arrays in which a block of windows is worked out. They are small enough for a core's cache and
    kept from block to block, so that no step asks the system for memory. Products stay one small
    matrix a window, which the matrix library multiplies faster than long thin ones."""

    def __init__(self, dtype=np.float32):
        def made(*shape: int) -> np.ndarray:
            return np.empty((BLOCK, *shape), dtype=dtype)

        keys = CONTEXT + STEP
        self.own, self.seen = made(STEP, 2 * WIDTH), made(keys, 3 * WIDTH)
        self.value_t = made(WIDTH + 1, keys)         # values, and a row of ones
        self.value_t[:, -1] = 1
        self.s, self.ds, self.weight = made(STEP, keys), made(STEP, keys), made(STEP, 1)
        self.mixed, self.h, self.dh, self.dq, self.dx = (made(STEP, WIDTH) for _ in range(5))
        self.dhw = made(STEP, WIDTH + 1)
        self.z, self.rows, self.sums = made(STEP, CLASSES), made(STEP, CLASSES), made(STEP, 1)
        self.both, self.k_in = made(keys, 2 * WIDTH), made(keys, WIDTH)
        self.ones = np.ones((max(keys, CLASSES, BLOCK), 1), dtype=dtype)
        self.moved, self.sorted = np.empty((2, 0, WIDTH), dtype=dtype)
        # of blocks that follow each other; the keys of a window are those of two of them
        self.run = np.empty((BLOCK + 1, STEP, 4 * WIDTH), dtype=dtype)
        self.run_seen = as_strided(self.run[..., 2 * WIDTH:], (BLOCK, keys, 2 * WIDTH), self.run.strides)

    def sum(self, values: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """Sums over the last axis, which stays."""
        size = values.shape[-1]
        flat = None if out is None else out.reshape(-1, 1)
        return np.matmul(values.reshape(-1, size), self.ones[:size], out=flat).reshape(
            *values.shape[:-1], 1)

    def grow(self, positions: int) -> None:
        if len(self.moved) < positions:
            self.moved, self.sorted = np.empty((2, positions, WIDTH), dtype=self.s.dtype)


class Forward:
    """Masked attention over a batch of windows, with the tables of keys, queries and values of all
    input rows made once."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params
        e = params["embed"].copy()
        e[-1] = 0
        # scores are bounded, so that exp needs no running maximum
        self.q, self.k = (np.minimum(np.maximum(e @ params[w], -2), 2) for w in ("wq", "wk"))
        # what a query position and a key position need, side by side
        self.own = np.concatenate([self.q, e], axis=1)
        self.seen = np.concatenate([self.k, e @ params["wv"], e], axis=1)
        self.e = e
        near = np.exp(np.clip(params["near"], -10, 10))[_LAG_AT]
        self.near = np.where(_CAUSAL, near, 0).astype(e.dtype)

    @cached_property
    def all(self) -> np.ndarray:
        return np.concatenate([self.own, self.seen[:, :2 * WIDTH]], axis=1)

    def logits(self, x: np.ndarray, room: Room) -> np.ndarray:
        """Logits [windows, STEP, CLASSES] of at most ``BLOCK`` windows; they and what led to them stay
        in ``room``."""
        n = len(x)
        own = self.own.take(x[:, CONTEXT:], axis=0, out=room.own[:n], mode="clip")
        seen = self.seen.take(x, axis=0, out=room.seen[:n], mode="clip")
        return self._logits(own, seen, x[:, CONTEXT:], x[:, 0] == len(self.e) - 1, room)

    def run_logits(self, x: np.ndarray, opens: np.ndarray, room: Room) -> np.ndarray:
        """The same for the blocks behind the first of ``x``, each in the context of the one before."""
        n = len(opens)
        self.all.take(x, axis=0, out=room.run[:n + 1], mode="clip")
        return self._logits(room.run[1:n + 1, :, :2 * WIDTH], room.run_seen[:n], x[1:], opens, room)

    def _logits(self, own: np.ndarray, seen: np.ndarray, at: np.ndarray, opens: np.ndarray,
                room: Room) -> np.ndarray:
        n = len(own)
        s = np.matmul(own[..., :WIDTH], seen[..., :WIDTH].transpose(0, 2, 1), out=room.s[:n])
        np.exp(s, out=s)
        s *= self.near
        # what stands before a text weighs nothing; padding behind it is seen by no target
        for i in np.flatnonzero(opens):
            s[i, :, :CONTEXT] = 0
        weight = room.sum(s, room.weight[:n])
        np.maximum(weight, 1e-30, out=weight)
        mixed = np.matmul(s, seen[..., WIDTH:2 * WIDTH], out=room.mixed[:n])
        mixed /= weight
        h = np.add(mixed, own[..., WIDTH:], out=room.h[:n])
        np.maximum(h, 0, out=h)
        z = np.matmul(h, self.p["out"], out=room.z[:n])
        z += self.p["direct"].take(at, axis=0, out=room.rows[:n], mode="clip")
        return z


def log_probs(model: Model, forward: Forward, ids: list[np.ndarray],
              room: Room | None = None) -> np.ndarray:
    """log10 probability of each text (ids with the end token), every token scored once."""
    room = room or Room(forward.e.dtype)
    x, y, owner = blocks(ids, model)
    opens, cls = _opens(owner), model.class_of.take(y, mode="clip")
    picked, sums = np.empty((2, *y.shape), dtype=room.z.dtype)
    place = np.arange(BLOCK * STEP).reshape(BLOCK, STEP) * CLASSES
    for lo in range(0, len(y), BLOCK):
        hi = min(lo + BLOCK, len(y))
        z = forward.run_logits(x[lo:hi + 1], opens[lo:hi], room)
        z.take(place[:hi - lo] + cls[lo:hi], out=picked[lo:hi], mode="clip")
        np.exp(z, out=z)
        room.sum(z, sums[lo:hi])
    picked -= np.log(sums, out=sums)
    value = picked.astype(np.float64) / np.log(10)
    value += model.log_share.take(y, mode="clip")
    value[y < 0] = 0
    return np.bincount(owner, value.sum(axis=1), len(ids))


def gradient(params: dict[str, np.ndarray], x: np.ndarray, cls: np.ndarray, fixed: tuple = (),
             room: Room | None = None):
    """Mean loss and its slopes over a batch, but for the parameters in ``fixed``; ``cls`` holds target
    classes, -1 for none. The batch is worked out block by block."""
    f = Forward(params)
    dtype = f.e.dtype
    room = room or Room(dtype)
    n = max(1, int((cls >= 0).sum()))
    room.grow(x.size)
    moved = room.moved[:x.size].reshape(*x.shape, WIDTH)
    out_t, wq_t, wkv_t = (np.concatenate([params[k].T for k in names]) for names in (
        ("out",), ("wq",), ("wk", "wv")))
    q_in, k_in = ((np.abs(table) < 2).astype(dtype) for table in (f.q, f.k))
    g = {k: np.zeros_like(params[k]) for k in ("wq", "out")}
    seen_g = np.zeros((WIDTH, 2 * WIDTH), dtype=dtype)
    near = np.zeros((STEP, CONTEXT + STEP), dtype=dtype)
    slopes = [] if "direct" not in fixed else None
    missed = np.empty(cls.shape, dtype=dtype)
    scale = np.where(cls >= 0, dtype.type(1 / n), dtype.type(0))
    place = np.arange(BLOCK * STEP).reshape(BLOCK, STEP) * CLASSES
    for lo in range(0, len(x), BLOCK):
        xs = x[lo:lo + BLOCK]
        m = len(xs)
        p = f.logits(xs, room)
        np.minimum(p, 60, out=p)                # far above any logit, far below an overflow
        np.exp(p, out=p)
        sums = room.sum(p, room.sums[:m])
        at = place[:m] + np.maximum(cls[lo:lo + m], 0)
        picked = p.take(at)
        np.divide(picked, sums[..., 0], out=missed[lo:lo + m])
        p.reshape(-1)[at] = picked - sums[..., 0]
        p *= np.divide(scale[lo:lo + m, :, None], sums, out=sums)
        if slopes is not None:
            slopes.append(p.reshape(-1, CLASSES).copy())
        h, dh, dhw = room.h[:m], room.dh[:m], room.dhw[:m]
        own, seen, s = room.own[:m], room.seen[:m], room.s[:m]
        q, e_own = own[..., :WIDTH], own[..., WIDTH:]
        k, v, e = (seen[..., i * WIDTH:(i + 1) * WIDTH] for i in range(3))
        g["out"] += np.matmul(h.transpose(0, 2, 1), p).sum(axis=0)
        np.matmul(p, out_t, out=dh)
        dh *= h > 0
        np.divide(dh, room.weight[:m], out=dhw[..., :WIDTH])
        both = room.both[:m]
        np.matmul(s.transpose(0, 2, 1), dhw[..., :WIDTH], out=both[..., WIDTH:])
        # the mean of a row's slopes is that of its output
        mixed = room.mixed[:m]
        mixed *= dhw[..., :WIDTH]
        np.negative(room.sum(mixed), out=dhw[..., WIDTH:])
        value_t = room.value_t[:m]
        value_t[:, :-1] = v.transpose(0, 2, 1)
        ds = np.matmul(dhw, value_t, out=room.ds[:m])
        ds *= s
        dq = np.matmul(ds, k, out=room.dq[:m])
        np.matmul(ds.transpose(0, 2, 1), q, out=both[..., :WIDTH])
        # scores at their bounds have no slope
        dq *= q_in.take(xs[:, CONTEXT:], axis=0, out=room.dx[:m], mode="clip")
        both[..., :WIDTH] *= k_in.take(xs, axis=0, out=room.k_in[:m], mode="clip")
        near += ds.sum(axis=0)
        g["wq"] += np.matmul(e_own.transpose(0, 2, 1), dq).sum(axis=0)
        seen_g += np.matmul(e.transpose(0, 2, 1), both).sum(axis=0)
        np.matmul(both, wkv_t, out=moved[lo:lo + m])
        dh += np.matmul(dq, wq_t, out=room.dx[:m])
        moved[lo:lo + m, CONTEXT:] += dh
    loss = -np.log(np.maximum(missed[cls >= 0], 1e-30)).sum(dtype=np.float64) / n
    g["wk"], g["wv"] = seen_g[:, :WIDTH], seen_g[:, WIDTH:]
    g["near"] = np.bincount(_LAG_AT[_CAUSAL], near[_CAUSAL], CONTEXT + STEP).astype(dtype)
    g["embed"] = _scatter(x.ravel(), room.moved[:x.size], len(params["embed"]), room.sorted)
    g["embed"][-1] = 0
    if slopes is not None:
        g["direct"] = _scatter(x[:, CONTEXT:].ravel(), np.concatenate(slopes), len(params["direct"]))
    return loss, g


def _scatter(rows: np.ndarray, values: np.ndarray, size: int,
             room: np.ndarray | None = None) -> np.ndarray:
    """Sum of ``values`` by row; ``room`` may hold them sorted."""
    if size <= 1 << 16:
        rows = rows.astype(np.uint16)         # sorted digit by digit
    order = np.argsort(rows, kind="stable")
    at = rows.take(order)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    values = values.take(order, axis=0, mode="clip", out=None if room is None else room[:len(rows)])
    # two columns are added at once as the parts of a complex number
    pairs = values.view(np.result_type(values.dtype, np.complex64))
    out = np.zeros((size, values.shape[1]), dtype=values.dtype)
    out[at.take(first)] = np.add.reduceat(pairs, first, axis=0).view(values.dtype)
    return out


TABLES = ("embed", "direct")          # parameters with a row for each input row


class Adam:
    """Steps by running moments of the slopes. Rows of a table that a batch does not hold keep theirs."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.step = 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, params: dict[str, np.ndarray], g: dict[str, np.ndarray], rate: float,
               rows: np.ndarray) -> None:
        self.step += 1
        first, second = rate / (1 - 0.9 ** self.step), (1 - 0.999 ** self.step) ** -0.5
        for k, slope in g.items():
            at = rows if k in TABLES else slice(None)
            m, v = self.m[k][at], self.v[k][at]
            m += 0.1 * (slope - m)
            slope = slope * slope
            slope -= v
            slope *= 0.001
            v += slope
            self.m[k][at], self.v[k][at] = m, v
            np.sqrt(v, out=slope)
            slope *= second
            slope += 1e-8
            np.divide(m, slope, out=slope)
            slope *= first
            params[k][at] -= slope


def step(model: Model, adam: Adam, x: np.ndarray, cls: np.ndarray, rate: float, fixed: tuple,
         room: Room | None = None) -> None:
    """One step over a batch of windows. Only the table rows that it holds are worked on."""
    held = np.zeros(len(model.params["embed"]), dtype=bool)
    held[x] = held[-1] = True                 # the padding row stays the last
    rows = np.flatnonzero(held)
    place = np.cumsum(held) - 1
    own = {k: v.take(rows, axis=0) if k in TABLES else v for k, v in model.params.items()}
    _, g = gradient(own, place.take(x), cls, fixed, room)
    adam.update(model.params, g, rate, rows)


def train(model: Model, ids: list[np.ndarray], steps: int | None, rate: float, seed: int,
          size: int = 2 * BATCH, fixed: tuple = ()) -> None:
    """Adam over shuffled windows: ``steps`` batches, or one pass over all (None). Parameters in ``fixed``
    stay as they are."""
    x, y, _ = windows(ids, model)
    cls = _classes_of(y, model)
    rng = np.random.default_rng(seed)
    adam = Adam({k: v for k, v in model.params.items() if k not in fixed})
    room, order = Room(), rng.permutation(len(x))
    n = -(-len(x) // size) if steps is None else steps
    for i in range(n):
        pick = order.take(np.arange(i * size, min((i + 1) * size, len(x)) if steps is None
                                    else (i + 1) * size), mode="wrap")
        step(model, adam, x[pick], cls[pick], rate * (1 - 0.9 * i / n), fixed, room)


class ShardTraining:
    """One pass over the documents of a shard, in groups of a bounded size, with one optimiser."""

    def __init__(self, model: Model, t: Training, fixed: tuple):
        self.fixed = fixed
        self.model = Model({k: v.copy() for k, v in model.params.items()}, model.row_of,
                           model.class_of, model.log_share)
        self.t, self.seen, self.size, self.waiting = t, 0, 0, []
        self.adam = Adam({k: v for k, v in model.params.items() if k not in fixed})
        self.rng, self.room = np.random.default_rng(t.seed), Room()

    def add(self, ids: np.ndarray) -> None:
        for lo in range(0, len(ids), GROUP_IDS):
            self.waiting.append(ids[lo:lo + GROUP_IDS])
            self.size += len(self.waiting[-1])
            if self.size >= GROUP_IDS:
                self.flush()

    def flush(self) -> None:
        if not self.waiting:
            return
        x, y, _ = windows(self.waiting, self.model)
        cls = _classes_of(y, self.model)
        done, order = self.seen, self.rng.permutation(len(x))
        for lo in range(0, len(x), SHARD_BATCH):
            pick = order[lo:lo + SHARD_BATCH]
            at = (done + self.size * lo / len(x)) / self.t.shard_tokens
            # short steps until the optimiser's moments have settled
            soft = min(1.0, (self.adam.step + 1) / SETTLE)
            step(self.model, self.adam, x[pick], cls[pick],
                 self.t.shard_rate * soft * (1 - 0.9 * min(at, 1.0)), self.fixed, self.room)
        self.seen, self.size, self.waiting = done + self.size, 0, []


# ---------------------------------------------------------------- corpus

def _lowered(text: str | None) -> str:
    return text.encode("utf-8", "replace").lower().decode("utf-8") if text else ""


def _word_counts(docs: DataFrame) -> DataFrame:
    """(h, c) of all words of the training documents, written; tasks count before they shuffle."""
    def run(frames):
        waiting, n = [], 0
        for frame in frames:
            waiting += [word_hashes(t if isinstance(t, str) else None) for t in frame["text"]]
            n += sum(map(len, waiting[-len(frame):]))
            if n >= COUNT_WORDS:
                yield _counted(waiting)
                waiting, n = [], 0
        if waiting:
            yield _counted(waiting)

    counted = docs.filter("not held_out").select("text").mapInPandas(run, "h long, c long")
    return common.written(counted.groupBy("h").agg(F.sum("c").alias("c")), "word-counts")


def _counted(hashes: list[np.ndarray]) -> pd.DataFrame:
    h, c = np.unique(np.concatenate(hashes).view(np.int64), return_counts=True)
    return pd.DataFrame({"h": h, "c": c})


def _read(docs: DataFrame, frequent: pd.DataFrame, norm: float, end_count: int, file: str):
    """One row per document, written: key, doc_id, held_out, n_tokens, known and base over the
    frequent words and the end, rare words (hash, count) and subword ids."""
    keys = frequent["h"].to_numpy()
    value = np.log10((frequent["c"].to_numpy() + 0.5) / norm)
    end_value = float(np.log10((end_count + 0.5) / norm))

    def run(frames):
        coder = tokens.encoder(file)
        part, place = TaskContext.get().partitionId(), 0
        for frame in frames:
            out = []
            texts = [t if isinstance(t, str) else None for t in frame["text"]]
            subwords = coder.batch([_lowered(t) for t in texts])
            for doc_id, held, text, ids in zip(frame["doc_id"], frame["held_out"], texts, subwords,
                                               strict=True):
                words = word_hashes(text).view(np.int64)
                h, n = np.unique(words, return_counts=True)
                at = np.searchsorted(keys, h)
                hit = keys.take(at, mode="clip") == h if len(keys) else np.zeros(len(h), bool)
                base = end_value + float((n[hit] * value[at[hit]]).sum())
                small = not len(ids) or int(ids.max()) < 1 << 16
                out.append(((part << 33) + place, doc_id, bool(held), len(words) + 1,
                            int(n[hit].sum()) + (end_count > 0), base, h[~hit],
                            n[~hit].astype(np.int32), small,
                            ids.astype("<u2" if small else "<u4").tobytes(), len(ids) + 1))
                place += 1
            yield pd.DataFrame(out, columns=[c.split()[0] for c in READ.split(", ")])

    return common.written(docs.mapInPandas(run, READ), "lm-documents")


READ = ("key long, doc_id string, held_out boolean, n_tokens long, known long, base double, "
        "rare array<long>, rare_n array<int>, small boolean, ids binary, n_ids long")


def _ids(frame: pd.DataFrame, end: int) -> list[np.ndarray]:
    return [np.append(np.frombuffer(data, "<u2" if small else "<u4").astype(np.int32), end)
            for small, data in zip(frame["small"], frame["ids"], strict=True)]


def _token_counts(read: DataFrame, size: int) -> np.ndarray:
    """Counts of all subword ids (and, last, of ends) over the training documents. The vocabulary
    is fixed, so this table does not grow."""
    def run(frames):
        total = np.zeros(size, dtype=np.int64)
        for frame in frames:
            if len(frame):
                total += np.bincount(np.concatenate(_ids(frame, size - 1)), minlength=size)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"id": at, "c": total[at]})

    rows = (read.filter("not held_out").select("small", "ids").mapInPandas(run, "id int, c long")
            .groupBy("id").agg(F.sum("c").alias("c")).toPandas())
    out = np.zeros(size, dtype=np.int64)
    out[rows["id"].to_numpy()] = rows["c"].to_numpy()
    return out


def _ranks(counts: np.ndarray) -> np.ndarray:
    """Tokens by falling count."""
    return np.lexsort((np.arange(len(counts)), -counts))


def _frames(counts: np.ndarray) -> np.ndarray:
    """Neighbour column of every token: the 255 most frequent have their own, the others share one."""
    out = np.full(len(counts), 255, dtype=np.int64)
    rank = _ranks(counts)[:255]
    out[rank] = np.arange(len(rank))
    return out


def _neighbours(ids: list[np.ndarray], frame: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token * NEAR + column, count) of all neighbours before and behind the tokens of ``ids``."""
    if not ids:
        return np.zeros((2, 0), dtype=np.int64)
    t, end = np.concatenate(ids).astype(np.int32), len(frame) - 1
    frame = frame.astype(np.int32)
    inside = t[:-1] != end                  # the next token is one of the same text
    a, b = t[:-1][inside], t[1:][inside]
    keys = np.concatenate([b * np.int32(NEAR) + frame[a], a * np.int32(NEAR) + (frame[b] + 256)])
    return np.unique(keys, return_counts=True)


def _neighbour_counts(read: DataFrame, counts: np.ndarray) -> DataFrame:
    """(key, c) of the neighbours of all training ids: at most vocabulary x NEAR rows, summed in the
    tasks before they shuffle."""
    size, frame = len(counts), _frames(counts)

    def run(frames):
        total = np.zeros(size * NEAR, dtype=np.int64)
        for rows in frames:
            key, c = _neighbours(_ids(rows, size - 1), frame)
            total[key] += c
        at = np.flatnonzero(total)
        for lo in range(0, len(at), COUNT_WORDS):
            yield pd.DataFrame({"key": at[lo:lo + COUNT_WORDS],
                                "c": total[at[lo:lo + COUNT_WORDS]]})

    return (read.filter("not held_out").select("small", "ids").mapInPandas(run, "key int, c long")
            .groupBy("key").agg(F.sum("c").alias("c")))


def _classes(counts: np.ndarray, key: np.ndarray, c: np.ndarray, seed: int) -> np.ndarray:
    """Class of every token: the most frequent ones and the end stand alone, the others are grouped
    by which tokens stand before and behind them (k-means on the counted neighbours)."""
    size = len(counts)
    singles = np.unique(np.r_[_ranks(counts)[:SINGLES - 1], size - 1])
    out = np.full(size, -1, dtype=np.int64)
    out[singles] = np.arange(len(singles))
    groups = CLASSES - len(singles)
    rest = np.flatnonzero((out < 0) & (counts > 0))
    rest = rest[np.argsort(-counts[rest], kind="stable")]
    index = np.full(size, -1)
    index[rest] = np.arange(len(rest))
    near = np.zeros((len(rest), NEAR), dtype=np.float32)
    at = index[key // NEAR]
    near[at[at >= 0], (key % NEAR)[at >= 0]] = np.sqrt(c[at >= 0])
    norm = np.linalg.norm(near, axis=1)
    near /= np.maximum(norm, 1)[:, None]
    group = np.arange(len(rest)) % groups
    used = np.flatnonzero(norm > 0)
    if len(used) >= groups:
        rng = np.random.default_rng(seed)
        near = near[used]
        heavy = np.arange(len(used))[:max(groups, 4 * groups)]
        centre = near[rng.choice(heavy, groups, replace=False)]
        weight = np.sqrt(counts[rest[used]]).astype(np.float32)
        for _ in range(12):
            best = (near @ centre.T).argmax(axis=1)
            for j in range(groups):
                own = best == j
                if own.any():
                    total = (near[own] * weight[own, None]).sum(0)
                    centre[j] = total / max(np.linalg.norm(total), 1e-9)
        group[used] = best
    out[rest] = len(singles) + group
    never = np.flatnonzero(out < 0)
    out[never] = len(singles) + never % groups
    return out


def build(counts: np.ndarray, texts: list[np.ndarray], seed: int) -> Model:
    """The untrained model of ``counts``, with the classes of ``texts``."""
    return _model(counts, _classes(counts, *_neighbours(texts, _frames(counts)), seed), seed)


def _model(counts: np.ndarray, cls: np.ndarray, seed: int) -> Model:
    size = len(counts)
    members, mass = np.bincount(cls, minlength=CLASSES), np.bincount(cls, counts, CLASSES)
    share = np.log10((counts + 0.5) / (mass[cls] + 0.5 * members[cls]))
    rank = _ranks(counts)
    row = OWN_ROWS + np.arange(size) % SHARED_ROWS
    row[rank[:OWN_ROWS]] = np.arange(min(size, OWN_ROWS))
    row[size - 1] = OWN_ROWS + SHARED_ROWS
    return Model(new_params(seed), row.astype(np.int32), cls, share)


def _direct_counts(read: DataFrame, model: Model) -> np.ndarray:
    """How often each class follows each input row, over all training ids. The table is as large as
    ``direct``, whatever the corpus."""
    rows, end = len(model.params["direct"]), model.end
    row_of, class_of = model.row_of.astype(np.int64), model.class_of

    def run(frames):
        total = np.zeros(rows * CLASSES, dtype=np.int64)
        for frame in frames:
            if len(frame):
                ids = np.concatenate([[end], *_ids(frame, end)])     # an end stands before each text
                total += np.bincount(row_of[ids[:-1]] * CLASSES + class_of[ids[1:]],
                                     minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"key": at, "c": total[at]})

    found = (read.filter("not held_out").select("small", "ids").mapInPandas(run, "key long, c long")
             .groupBy("key").agg(F.sum("c").alias("c")).toPandas())
    out = np.zeros(rows * CLASSES)
    out[found["key"].to_numpy()] = found["c"].to_numpy()
    return out.reshape(rows, CLASSES)


def _direct(counts: np.ndarray) -> np.ndarray:
    """Logarithms of the smoothed shares; rows that no id has get those of all."""
    share = (counts.sum(axis=0) + 1) / (counts.sum() + CLASSES)
    return np.log((counts + PRIOR * share) / (counts.sum(axis=1, keepdims=True) + PRIOR)).astype(
        np.float32)


def _mark() -> Column:
    """Rows that agree in this hash are copies: equal document and subword ids."""
    return F.xxhash64("doc_id", "ids")


def _training(read: DataFrame) -> DataFrame:
    """Training rows ``mark, small, ids, n_ids``; of the copies of a document each task hands on one."""
    def first(frames):
        seen: set[int] = set()
        for frame in frames:
            new = [m not in seen and not seen.add(m) for m in frame["mark"].tolist()]
            yield frame[new]

    rows = read.filter("not held_out").select(_mark().alias("mark"), "small", "ids",
                                              "n_ids")
    return rows.mapInPandas(first, "mark long, small boolean, ids binary, n_ids long")


def fit(read: DataFrame, size: int, n_train: int, t: Training) -> Model:
    """Classes and tables from the counts of all training ids, a warm start on a bounded sample (one
    task, at most ``warm_documents * warm_tokens`` ids), then the averaged pass over all training
    documents."""
    counts = _token_counts(read, size)

    def cluster(frames):
        rows = pd.concat([pd.DataFrame({"key": [], "c": []}, dtype="int64"), *frames])
        cls = _classes(counts, rows["key"].to_numpy(), rows["c"].to_numpy(), t.seed)
        yield pd.DataFrame({"cls": [cls.astype("<i8").tobytes()]})

    # a bounded table, so one task may hold it: vocabulary x NEAR
    near = common.written(_neighbour_counts(read, counts), "neighbours")
    made = near.repartition(1).sortWithinPartitions("key").mapInPandas(
        cluster, "cls binary").collect()
    # without any neighbours the classes stay uniform
    model = (_model(counts, np.frombuffer(made[0]["cls"], dtype="<i8"), t.seed) if made
             else build(counts, [], t.seed))
    model.params["direct"] = _direct(_direct_counts(read, model))
    model.params["out"] *= np.float32(0.1)

    def warm(frames):
        sample = [ids for frame in frames for ids in _ids(frame, size - 1)]
        if sample:
            train(model, sample, t.warm_steps, t.rate, t.seed, fixed=FIXED)
            yield pd.DataFrame({"model": [pickle.dumps(model)]})

    one_of = max(1, n_train // t.warm_documents)
    rows = _training(read).filter(F.pmod(F.xxhash64("mark", F.lit(t.seed)), F.lit(one_of)) == 0)
    rows = (rows.dropDuplicates(["mark"]).orderBy("mark").limit(t.warm_documents)
            .repartition(1).sortWithinPartitions("mark"))
    made = _runs(rows, t).mapInPandas(warm, "model binary").collect()
    # an empty sample only leaves out the warm start
    return averaged(read, pickle.loads(made[0]["model"]) if made else model, t, FIXED)


def _runs(rows: DataFrame, t: Training) -> DataFrame:
    """(small, ids): of each row a run of at most ``warm_tokens`` ids, from any place of its text."""
    mark = F.col("mark") if "mark" in rows.columns else _mark()
    start = F.pmod(F.xxhash64(mark, F.lit(t.seed + 2)),
                   F.greatest(F.lit(1), F.col("n_ids") - t.warm_tokens))
    return rows.select("small", start.alias("start"), "ids").select("small", F.expr(
        f"substring(ids, CAST(1 + start * IF(small, 2, 4) AS int), "
        f"{t.warm_tokens} * IF(small, 2, 4))").alias("ids"))


def averaged(read: DataFrame, model: Model, t: Training, fixed: tuple = ()) -> Model:
    """One pass of local training per shard of the training rows, parameters (but for those in ``fixed``)
    averaged by tokens. Shards and sums live on Spark; the driver gets one set of parameters."""
    n_tokens = read.filter("not held_out").agg(F.coalesce(F.sum("n_ids"), F.lit(0))).first()[0]
    if not n_tokens:
        return model
    shards = -(-n_tokens // t.shard_tokens)
    names = [k for k in model.params if k not in fixed]
    end = model.end

    def local(frames):
        at, last, shard = None, None, None

        def finished():
            shard.flush()
            flat = np.concatenate([shard.model.params[k].ravel() for k in names])
            pieces = np.array_split(flat, 64)
            return pd.DataFrame({"piece": range(64), "shard": at, "tokens": shard.seen,
                                 "values": [p.tobytes() for p in pieces]})

        for frame in frames:
            for number, mark, data, ids in zip(frame["shard"], frame["mark"], frame["ids"],
                                               _ids(frame, end), strict=True):
                if number != at:
                    if shard is not None:
                        yield finished()
                    at, last, shard = number, None, ShardTraining(model, t, fixed)
                if (mark, data) != last:          # copies of a document stand side by side
                    shard.add(ids)
                last = mark, data
        if shard is not None:
            yield finished()

    def added(frames):
        at, total, n = None, None, 0
        for frame in frames:
            for piece, _, seen, data in frame.itertuples(index=False):
                values = np.frombuffer(data, dtype=np.float32).astype(np.float64) * seen
                if piece != at:
                    if at is not None:
                        yield pd.DataFrame({"piece": [at], "mean": [(total / n).tobytes()]})
                    at, total, n = piece, np.zeros(len(values)), 0
                total, n = total + values, n + seen
        if at is not None:
            yield pd.DataFrame({"piece": [at], "mean": [(total / n).tobytes()]})

    # as many non-empty partitions as shards at most, however many partitions there are
    shard = F.pmod("mark", F.lit(shards)).alias("shard")
    part = _training(read)
    if t.share > 1:
        part = part.filter(F.pmod(F.xxhash64("mark", F.lit(t.seed + 1)), F.lit(t.share)) == 0)
    trained = (part.select(shard, "mark", "small", "ids")
               .repartition(int(shards), "shard").sortWithinPartitions("shard", "mark", "ids")
               .mapInPandas(local, "piece int, shard long, tokens long, values binary"))
    sums = (trained.repartition("piece").sortWithinPartitions("piece", "shard")
            .mapInPandas(added, "piece int, mean binary"))
    mean = np.concatenate([np.frombuffer(r["mean"]) for r in
                           sorted(sums.collect(), key=lambda r: r["piece"])]).astype(np.float32)
    params, at = dict(model.params), 0
    for k in names:
        v = model.params[k]
        params[k] = mean[at:at + v.size].reshape(v.shape).copy()
        at += v.size
    return Model(params, model.row_of, model.class_of, model.log_share)


def _scored(read: DataFrame, model: Model) -> DataFrame:
    sc = read.sparkSession.sparkContext
    shared = sc.broadcast(model)          # a few MB, whatever the corpus

    def run(frames):
        m = shared.value
        forward = Forward(m.params)
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({
                    "key": frame["key"], "doc_id": frame["doc_id"], "held_out": frame["held_out"],
                    "n_tokens": frame["n_tokens"], "known": frame["known"], "base": frame["base"],
                    "score": log_probs(m, forward, _ids(frame, m.end))})

    return read.select("key", "doc_id", "held_out", "n_tokens", "known", "base", "small",
                       "ids").mapInPandas(run, "key long, doc_id string, held_out boolean, "
                                          "n_tokens long, known long, base double, score double")


def score(docs: DataFrame, training: Training | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, text, held_out)``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    Null and empty texts consist of their end alone and are scored (and learnt from) like others;
    rows with a null ``held_out`` are learnt from; repeated rows are rows of their own; other columns
    are not read. Without a training document all counts are zero and the model is uniform over its
    classes. An empty table gives an empty result.
    """
    t = training or Training()
    file = t.tokenizer or tokens.default_path()
    kind = dict(docs.dtypes)["doc_id"]
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.coalesce("held_out", F.lit(False)).alias("held_out"))
    n_train = docs.filter("not held_out").count()
    words = _word_counts(docs)
    distinct, total = words.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    total, distinct = total + n_train, distinct + (n_train > 0)
    norm = total + 0.5 * (distinct + 1)
    least = max(2, -(-total // FREQUENT))
    # at most FREQUENT words reach a 1/FREQUENT share of all tokens
    frequent = words.filter(F.col("c") >= least).toPandas().sort_values("h")
    read = _read(docs, frequent, norm, n_train, file)
    model = fit(read, tokens.encoder(file).tokenizer.get_vocab_size() + 1, n_train, t)
    scored = _scored(read, model)
    rare = (read.select("key", F.explode(F.arrays_zip("rare", "rare_n")).alias("w"))
            .select("key", F.col("w.rare").alias("h"), F.col("w.rare_n").alias("n")))
    counts = words.filter(F.col("c") < least)
    c = F.coalesce("c", F.lit(0))
    by_doc = (rare.join(counts, "h", "left").groupBy("key").agg(
        F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(norm))).alias("rare_base"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rare_known")))
    return scored.join(by_doc, "key", "left").select(
        F.col("doc_id").cast(kind).alias("doc_id"), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score")
