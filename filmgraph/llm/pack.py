"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of its documents' ids. Queues are served in bursts of ``quantum`` ids, the
next burst always going to the source that is furthest behind its target share, i.e. whose deficit
is largest; a queue that ran out leaves the round and the others share on. The served stream is cut
every ``window`` ids, so windows are full (the last one aside), each holds the target proportions to
within a burst per source, and what a source lacks in one window it gets in the next.

Serving order is known in closed form: burst ``t`` of a source with weight ``w`` is due at time
``(t + 1/2) / w``, and its place in the stream is the number of ids due before it, summed over the
sources. So no window waits for another: given the ids per source before each input partition, every
partition cuts its documents on its own, and deficits carry over windows and partitions exactly
(integer arithmetic; weights are rounded to 2^-20 of their sum, which leaves 64 bits enough for 2^42
bursts of a source).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, tokens


@dataclass(frozen=True)
class Packing:
    tokenizer: str | None = None
    end_id: int = 1
    window: int = 2048
    quantum: int = 128
    # weight per source name; None: each source's number of ids, so that every window
    # shows the corpus mixture and all queues run out together
    weights: dict | None = None
    with_ids: bool = True             # return the ids of each piece


def queue_ids(docs: DataFrame, packing: Packing) -> DataFrame:
    """Tokenised documents, written: part, source, queue_start (ids of the source before the
    document within the part), doc_id, ids (packed little-endian, 16 bits each where they fit)."""
    file = packing.tokenizer or tokens.default_path()

    def encode(frames):
        coder = tokens.encoder(file)
        end = np.asarray([packing.end_id], dtype="<u4")
        part = TaskContext.get().partitionId()
        behind: dict = {}
        for frame in frames:
            out = []
            for source, ids in zip(frame["source"], coder.batch(frame["text"]), strict=True):
                source = source if isinstance(source, str) else None
                ids = np.concatenate([ids, end])
                at = behind.get(source, 0)
                behind[source] = at + len(ids)
                small = int(ids.max()) < 1 << 16
                out.append((part, source, at, len(ids), small,
                            ids.astype("<u2" if small else "<u4").tobytes()))
            rows = pd.DataFrame(out, columns=["part", "source", "queue_start", "doc_tokens",
                                              "small", "ids"])
            rows.insert(3, "doc_id", common.ids_from(frame["doc_id"]))
            yield rows

    rows = docs.select(common.id_text(F.col("doc_id")).alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       F.col("text").cast("string").alias("text"))
    return common.written(rows.mapInPandas(
        encode, "part int, source string, queue_start long, doc_id long, doc_tokens long, "
                "small boolean, ids binary"), "queues")


WEIGHT_UNITS = 1 << 20


def rounded_weights(weights: list[float]) -> np.ndarray:
    total = sum(weights)
    return np.array([max(1, round(w / total * WEIGHT_UNITS)) for w in weights], dtype=np.int64)


def served_before(t: np.ndarray, j: np.ndarray, sizes: np.ndarray, weights: np.ndarray,
                  quantum: int) -> np.ndarray:
    """Places in the stream of bursts ``t`` of sources ``j``: ids of all bursts due earlier (equal
    times: by source order)."""
    place = np.zeros(len(t), dtype=np.int64)
    own = weights[j]
    for r, (size, w) in enumerate(zip(sizes.tolist(), weights.tolist(), strict=True)):
        # bursts u with (2u + 1) / w < (2t + 1) / own, or equal and r before j
        bursts, left = np.divmod((2 * t + 1) * w + own, 2 * own)
        bursts -= (left == 0) & (r > j)
        place += np.minimum(size, np.where(r == j, t, bursts) * quantum)
    return place


def cut(start: np.ndarray, length: np.ndarray, j: np.ndarray, sizes: np.ndarray,
        weights: np.ndarray, quantum: int, window: int):
    """Pieces ``(document, start in it, length, stream place)``, as arrays, of documents that lie at
    ``start`` of queues ``j``; neighbouring bursts of one document in one window are one piece."""
    first, last = start // quantum, (start + length - 1) // quantum
    n = last - first + 1
    doc = np.repeat(np.arange(len(start)), n)
    t = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[doc]
    lo = np.maximum(t * quantum, start[doc])
    hi = np.minimum((t + 1) * quantum, (start + length)[doc])
    place = served_before(t, j[doc], sizes, weights, quantum) + lo - t * quantum
    # a burst lies in as many pieces as windows
    k = (place + hi - lo - 1) // window - place // window + 1
    part = np.repeat(np.arange(len(t)), k)
    inside = np.arange(len(part)) - np.repeat(np.cumsum(k) - k, k)
    edge = (place // window)[part] * window + inside * window
    a = np.maximum(place[part], edge)
    b = np.minimum((place + hi - lo)[part], edge + window)
    at, own = (lo - place)[part] + a - start[doc[part]], doc[part]
    joins = np.zeros(len(a), dtype=bool)
    joins[1:] = (own[1:] == own[:-1]) & (a[1:] == b[:-1]) & (a[1:] % window != 0)
    head = np.flatnonzero(~joins)
    return own[head], at[head], np.add.reduceat(b - a, head), a[head]


def pack(docs: DataFrame, packing: Packing | None = None) -> DataFrame:
    """One row per piece of ``docs(doc_id, source, text)``: doc_id, source, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, padded_tokens and (on request)
    ids, an array.

    Null and empty texts hold the end id alone, null sources are a source of their own, null and
    repeated ids are packed row by row, other columns are not carried, and an empty table gives no
    piece. All sequences are full but the last one, which is padded to the window unless its length
    is a power of two.
    """
    packing = packing or Packing()
    spark = docs.sparkSession
    queues = queue_ids(docs, packing)
    per_part = common.written(queues.groupBy("part", "source").agg(
        F.sum("doc_tokens").alias("n")), "queue-parts")
    before = (Window.partitionBy("source").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    bases = common.written(per_part.select(
        "part", "source", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    # one row per source: the mixture table of the job, like its weights
    mixture = per_part.groupBy("source").agg(F.sum("n").alias("n")).collect()
    mixture = sorted(((r["source"], r["n"]) for r in mixture),
                     key=lambda x: (x[0] is None, x[0] or ""))
    if not mixture:
        return spark.createDataFrame([], _schema(packing))
    place_of = {s: j for j, (s, _) in enumerate(mixture)}
    sizes = np.array([n for _, n in mixture], dtype=np.int64)
    given = packing.weights
    weights = rounded_weights([n if given is None else given.get(s, 1) for s, n in mixture])
    total, window, quantum = int(sizes.sum()), packing.window, packing.quantum
    rest = total % window
    padded = rest if rest & (rest - 1) == 0 else window
    names = [c.split()[0] for c in _schema(packing).split(", ")]

    def cut_documents(frames):
        for frame in frames:
            if not len(frame):
                continue
            source = [s if isinstance(s, str) else None for s in frame["source"]]
            j = np.array([place_of[s] for s in source], dtype=np.int64)
            n = frame["doc_tokens"].to_numpy()
            doc, start, length, place = cut(frame["queue_at"].to_numpy(), n, j, sizes, weights,
                                            quantum, window)
            ids = [np.frombuffer(data, "<u2" if small else "<u4").astype("<u4")
                   for data, small in zip(frame["ids"], frame["small"], strict=True)]
            views = [memoryview(x).cast("B") for x in ids]
            crc = [zlib.crc32(views[d][4 * a:4 * (a + m)]) for d, a, m in
                   zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            seq = place // window
            full = (seq + 1) * window <= total
            out = {"doc_id": common.ids_from(frame["doc_id"])[doc],
                   "source": [source[d] for d in doc], "start": start, "length": length,
                   "ids_crc32": crc, "doc_tokens": n[doc], "sequence_id": seq,
                   "offset": place % window, "sequence_tokens": np.where(full, window, rest),
                   "padded_tokens": np.where(full, window, padded)}
            if packing.with_ids:
                out["ids"] = [ids[d][a:a + m].astype("<i4") for d, a, m in
                              zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            yield pd.DataFrame({c: out[c] for c in names})

    placed = queues.join(common.bounded(bases.select(
        F.col("part").alias("_part"), F.col("source").alias("_source"), "base")),
        (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))
    placed = placed.select("source", (F.col("base") + F.col("queue_start")).alias("queue_at"),
                           common.id_text(F.col("doc_id")).alias("doc_id"), "doc_tokens", "small",
                           "ids")
    return placed.mapInPandas(cut_documents, _schema(packing))


PIECES = ("doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long, padded_tokens long")


def _schema(packing: Packing) -> str:
    return f"{PIECES}, ids array<int>" if packing.with_ids else PIECES


def sequences(pieces: DataFrame, pad_id: int = 50256) -> DataFrame:
    """Assembled sequences: sequence_id, ids (padded with ``pad_id``), doc_ids in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("p"),
                                             F.max("padded_tokens").alias("n"))
    flat = F.flatten("p.ids")
    fill = F.array_repeat(F.lit(pad_id), (F.col("n") - F.size(flat)).cast("int"))
    return rows.select("sequence_id", F.concat(flat, fill).alias("ids"),
                       F.col("p.doc_id").alias("doc_ids"))
