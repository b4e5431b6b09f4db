"""Spelling variants: words one inserted, deleted or replaced code point apart, and their usual form.

Words are found by a dictionary of trie-node pairs. The nodes of the trie of all words and of the
trie of all reversed words are numbered; a word then says, for each of its places, which prefix node
stands before it and which suffix node behind it:

* skipping place ``i`` gives the pair (prefix of ``i`` characters, suffix behind ``i``): two words share it
  exactly if they differ in that one character;
* splitting between two characters gives the pair (prefix of ``i``, suffix from ``i``), which belongs to one
  word alone: it equals another word's skipping pair exactly if that word has one character more.

So exact neighbours come from one shuffle of integer pairs. A pair is shared by no more words than
there are characters, plus one; its rows are compared by running minima, never paired with each
other. Each neighbour is met at one place only (of a run of equal characters the first is skipped),
so counts add up.

A node's number is the summed length of the words sorted before the first one that passes through
it, plus its depth. That is a sum over sorted ranges: each task numbers its range, and the ranges
are put in line from one row each (first and last word).

Null and empty texts have no words; a null ``doc_id`` is hashed as no digits. Repeated rows count each
time. Words are compared by code points; ties go to the smallest. Empty tables give empty tables.
Columns other than those named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Fixed value: the characters of a word.
LETTERS = "A-Za-zÀ-ÿ"
HELD_WORDS = 200_000              # different words a task counts before it hands them on
FOUND_AT_ONCE = 100_000           # words of a long text counted at once


@dataclass(frozen=True)
class Vocabulary:
    min_chars: int = 5
    min_count: int = 3
    thin_every: int | None = 97   # runs whose hash it divides lose one code point; None: all stay


def thinned(runs: Counter, doc_id: str | None, every: int | None) -> Iterator[tuple[str, int]]:
    """The runs of a document with their counts. Those whose crc32 of ``<doc_id>:<run>`` is a multiple
    of ``every`` lose the code point at that number modulo their length."""
    if every is None:
        yield from runs.items()
        return
    head = zlib.crc32(f"{doc_id or ''}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode("utf-8"), head)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        yield run, n


def words(docs: DataFrame, v: Vocabulary | None = None) -> DataFrame:
    """``word, n`` of all words of ``docs(doc_id, text)`` that are long and frequent enough. Tasks add up
    their own words before the shuffle."""
    v = v or Vocabulary()
    run = re.compile(f"[{LETTERS}]{{{v.min_chars},}}")   # shorter runs give no word

    def count(frames):
        held: Counter = Counter()

        def handed():
            out = pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})
            held.clear()
            return out.astype({"word": object, "n": "int64"})

        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                if not isinstance(text, str) or not text:
                    continue
                lowered = text.lower() if text.isascii() else text.translate(common.LOWER_AZ)
                found = (m.group() for m in run.finditer(lowered))
                runs: Counter = Counter()
                while some := list(islice(found, FOUND_AT_ONCE)):
                    runs.update(some)
                for word, n in thinned(runs, doc_id if isinstance(doc_id, str) else None,
                                       v.thin_every):
                    if len(word) >= v.min_chars:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield handed()
        if held:
            yield handed()

    own = docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                      F.col("text").cast("string").alias("text"))
    return (own.mapInPandas(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= v.min_count))


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n                     # a[:lo] is shared, a[:hi] is not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid)
    return lo


def _numbered(ordered: DataFrame) -> DataFrame:
    """Per row of the sorted ranges of ``s``: its range, and for each prefix of ``s`` the number of its
    node within the range. Prefixes that the range's first word shares with the range before are
    numbered by their depth like all of that word's, so they can be told by it later on."""
    def number(frames):
        part = TaskContext.get().partitionId()
        last, nodes, upto = "", [], 0
        for frame in frames:
            rows = []
            for s in frame["s"]:
                keep = shared(last, s)
                nodes = nodes[:keep] + list(range(upto + keep + 1, upto + len(s) + 1))
                rows.append(nodes)
                last, upto = s, upto + len(s)
            yield pd.DataFrame({"part": part, "s": frame["s"], "nodes": rows})

    return ordered.mapInPandas(number, "part long, s string, nodes array<long>")


def trie_nodes(sorted_words: DataFrame, name: str) -> DataFrame:
    """``s, nodes`` for distinct strings ``s``: the numbers of the trie nodes of all prefixes of ``s`` from
    the one of one character on. The root is 0 and in no list."""
    spark = sorted_words.sparkSession
    local = common.written(_numbered(
        sorted_words.select("s").repartitionByRange("s").sortWithinPartitions("s")), name)
    # a row for each range, that is for each task: first and last word, and the last one's nodes
    ranges = (local.groupBy("part").agg(
        F.min("s").alias("first"), F.max("s").alias("last"), F.max_by("nodes", "s").alias("nodes"),
        F.sum(F.length("s")).alias("total")).collect())
    lines, base, last, nodes = [], 0, "", []
    for r in sorted(ranges, key=lambda r: r["first"]):
        carried = nodes[:shared(last, r["first"])]
        lines.append((r["part"], base, carried))
        nodes = [carried[x - 1] if x <= len(carried) else base + x for x in r["nodes"]]
        base, last = base + r["total"], r["last"]
    lined = spark.createDataFrame(lines, "part long, base long, carried array<long>")
    return local.join(F.broadcast(lined), "part").select("s", F.transform("nodes", lambda x: F.when(
        x <= F.size("carried"), F.get("carried", (x - 1).cast("int")))
        .otherwise(F.col("base") + x)).alias("nodes"))


SPLIT, SKIP, SKIP_FIRST = 0, 1, 2     # SKIP_FIRST: the skipped character differs from the one before


def node_pairs(numbered: DataFrame) -> DataFrame:
    """``a, b, id, n, kind``: every skipping and splitting pair of ``numbered(word, n, id, fore, back)``."""
    before = F.concat(F.array(F.lit(0).cast("long")), "fore")
    behind = F.reverse(F.concat(F.array(F.lit(0).cast("long")), "back"))
    place = F.posexplode(F.arrays_zip(before.alias("a"), behind.alias("b"),
                                      F.slice(behind, 2, F.size("back")).alias("c")))
    at = numbered.select("id", "n", "word", place)
    one, prior = F.substring("word", F.col("pos") + 1, F.lit(1)), F.substring(
        "word", F.col("pos"), F.lit(1))
    skip = F.when((F.col("pos") > 0) & (one == prior), SKIP).otherwise(SKIP_FIRST)
    both = F.array(F.struct(F.col("col.b").alias("b"), F.lit(SPLIT).alias("kind")),
                   F.struct(F.col("col.c").alias("b"), skip.alias("kind")))
    return (at.select("id", "n", F.col("col.a").alias("a"), F.explode(both).alias("p"))
            .select("a", "p.b", "id", "n", F.col("p.kind").cast("byte").alias("kind"))
            .filter("b is not null"))


def group_neighbours(a: np.ndarray, b: np.ndarray, ids: np.ndarray, n: np.ndarray,
                     kind: np.ndarray) -> tuple[np.ndarray, ...]:
    """Neighbours that whole groups of equal pairs show, rows best first within a group:
    ``(id, near, best_n, best_id)`` of the rows that have any."""
    row = np.arange(len(a))
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    start = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    none = len(a)

    def first(mask: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(np.where(mask, row, none), start)[group]

    def number(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int64), start)[group]

    split, skip, outer = kind == SPLIT, kind != SPLIT, kind == SKIP_FIRST
    one = first(skip)
    two = first(skip & (row != one))
    whole = first(split)
    near = np.where(split, number(outer), number(skip) - 1 + (outer & (whole < none)))
    best = np.where(split, first(outer), np.where(one == row, two, one))
    best = np.where(outer, np.minimum(best, whole), best)
    hit = near > 0
    return ids[hit], near[hit], n[best[hit]], ids[best[hit]]


_NEAR = pa.schema([("id", pa.int64()), ("near", pa.int64()), ("best_n", pa.int64()),
                   ("best_id", pa.int64())])


def neighbours(numbered: DataFrame) -> DataFrame:
    """``id, n_near, best`` for the words with a neighbour; ``best`` is (n, id) of the most frequent one,
    of equals the one with the smallest id."""
    def compare(batches):
        held = None                   # rows of the group that the next batch may go on with
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if held is not None:
                cols = [np.concatenate(pair) for pair in zip(held, cols, strict=True)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [c[cut:] for c in cols]
            if cut:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in group_neighbours(
                    *[c[:cut] for c in cols])], schema=_NEAR)
        if held is not None and len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in group_neighbours(*held)],
                                             schema=_NEAR)

    ordered = (node_pairs(numbered).repartition("a", "b")
               .sortWithinPartitions("a", "b", F.desc("n"), "id"))
    rows = ordered.mapInArrow(compare, "id long, near long, best_n long, best_id long")
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("minus")))
    return (rows.groupBy("id").agg(F.sum("near").alias("n_near"), best.alias("m"))
            .select("id", "n_near", F.struct(F.col("m.best_n").alias("n"),
                                             (-F.col("m.minus")).alias("id")).alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """``id, root`` for ``forms(id, form)``, a forest: the end of the chain of forms of each id. Chains are
    halved round by round; forms at least double in frequency, so there are few rounds."""
    ends = common.written(forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        far = ends.select(F.col("id").alias("root"), F.col("root").alias("far"))
        moved = common.written(ends.join(far, "root", "left").select(
            "id", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")),
            "spelling-roots")
        ends = moved.select("id", "root")
        if not moved.agg(F.max("moved")).first()[0]:
            return ends


def variants(counted: DataFrame, ratio: int = 2) -> DataFrame:
    """Neighbours and forms of ``counted(word, n)``, words distinct: word, n, n_near, form (the most
    frequent neighbour if it is at least ``ratio`` times as frequent), form_n and root (from word, follow
    forms to the last; the word itself if it has none)."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2: forms have to grow in frequency")
    fore = trie_nodes(counted.select(F.col("word").alias("s")), "trie")
    back = trie_nodes(counted.select(F.reverse("word").alias("s")), "trie-reversed")
    numbered = common.written(
        counted.join(fore.withColumnRenamed("s", "word").withColumnRenamed("nodes", "fore"), "word")
        .join(back.select(F.reverse("s").alias("word"), F.col("nodes").alias("back")), "word")
        # a word's own node: words in code-point order have ascending ids
        .withColumn("id", F.element_at("fore", -1)), "spelling-nodes")
    own = numbered.select("id", "word", "n")
    formed = (F.col("best.n") >= ratio * F.col("n"))
    judged = common.written(
        own.join(neighbours(numbered), "id", "left")
        .select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                F.when(formed, F.col("best.id")).alias("form_id"),
                F.when(formed, F.col("best.n")).alias("form_n")), "spelling-near")
    tree = roots(judged.filter("form_id is not null").select("id", F.col("form_id").alias("form")))
    form = own.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    root = own.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    return (judged.join(tree, "id", "left").join(form, "form_id", "left").join(root, "root", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near",
                    "form_n"))


def group(docs: DataFrame, v: Vocabulary | None = None) -> DataFrame:
    """``variants`` of the words of ``docs(doc_id, text)``."""
    return variants(common.written(words(docs, v), "spelling-words"))
