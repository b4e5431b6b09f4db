"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its hashed 5-word shingles. Its sketch has BANDS * ROWS coordinates, filled
in rounds: in each of the first rounds every element falls into one hashed coordinate with a hashed
value, the smallest (round, value) stays; from round ``size`` on, round ``size + i`` sends all
elements to coordinate ``i``. So every coordinate is filled after at most two times ``size`` rounds,
usually after one, and the share of equal coordinates is concentrated around the Jaccard similarity.
Equal bands put documents into a bucket; at similarity 0.85 a pair shares none of the 25 buckets
with probability 4e-7, at 0.80 with 5e-5.

No bucket is expanded into pairs. Documents with equal sets collapse first. Then
(1) every class is verified against the smallest id of its buckets, and components are formed;
(2) in buckets that still hold more than one component, members outside the bucket's main component
meet all members of other components: members are dealt into blocks and the others stream past each
block. A first pass compares sketches and keeps the rows with a likely partner, a second compares
the full shingle sets of those and hands on the links that join components. Components are then
formed again. Every pair of a bucket is thus either connected already or compared.
"""

from __future__ import annotations

import hashlib
from functools import partial
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .hashing import mix64, word_hashes

SHINGLE = 5
PERCENT = 85                      # 100 * intersection >= PERCENT * union, unless given
BANDS, ROWS = 25, 5
SIZE = BANDS * ROWS
# Pairs whose sketches agree on fewer coordinates are not verified: so few that a pair at the threshold
# is dropped with less than this chance (binomial tail; the coordinates of a sketch spread less).
DROPPED = 1e-9
# Rows of a file, and of the task that writes it, where a bound on a table's rows is known: pairs
# joined with their sets, sketches, narrow rows.
PAIR_ROWS, WIDE_ROWS, NARROW_ROWS = 2_000, 20_000, 250_000
BLOCK = 1024                      # members of a bucket held at once
STRIPE = 4                        # strangers that meet them in one task, in blocks
BLOCK_SHINGLES = 2_000_000        # shingles of members held at once, about
# Work of a task: pairs of sketches compared, shingles of members times strangers, rows with sketches or sets.
TASK_PAIRS, TASK_SHINGLES, TASK_ROWS = 10_000_000, 2_000_000_000, 20_000

# Odd multipliers that tell the places of a shingle apart.
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; fewer words make one shingle."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = min(SHINGLE, len(h))
    total = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        total += h[i:len(h) - n + 1 + i] * _PLACE[i]
    return np.unique(mix64(total))


def sketch(items: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Fast similarity sketch of distinct hashes as ``size`` uint32 coordinates."""
    filled = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    empty = np.uint64(np.iinfo(np.uint64).max)
    done = 0
    while done < size and (filled == empty).any():
        # enough rounds at once to drop about four elements per coordinate
        rounds = np.arange(done, min(size, done + max(1, -(-4 * size // len(items)))),
                           dtype=np.uint64)
        h = mix64(items[None, :] + mix64(rounds + np.uint64(1))[:, None])
        bins = ((h >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        keys = (rounds[:, None] << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        np.minimum.at(filled, bins.ravel().astype(np.int64), keys.ravel())
        done += len(rounds)
    for i in np.flatnonzero(filled == empty):
        h = mix64(items + mix64(np.uint64([size + i + 1])))
        filled[i] = (np.uint64(size + i) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF)).min()
    return (mix64(filled) >> np.uint64(32)).astype(np.uint32)


def min_share(percent: int) -> float:
    """Share of equal coordinates below which a pair is not verified."""
    p, tail, least = percent / 100, 0.0, 0
    while least < SIZE:
        tail += comb(SIZE, least) * p ** least * (1 - p) ** (SIZE - least)
        if tail > DROPPED:
            break
        least += 1
    return least / SIZE


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """64-bit bucket keys of the bands of one sketch (as signed numbers)."""
    bands = coordinates.reshape(BANDS, ROWS).astype(np.uint64)
    key = mix64(np.arange(1, BANDS + 1, dtype=np.uint64))
    for i in range(ROWS):
        key = mix64(key * _PLACE[i] + bands[:, i])
    return key.view(np.int64)


def _sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, cls (hash of the whole set), sketch - for every row, written."""
    def run(frames):
        for frame in frames:
            out = []
            for text in frame["text"]:
                items = shingles(text if isinstance(text, str) else None)
                cls = hashlib.blake2b(items.tobytes(), digest_size=16).digest()
                out.append((len(items), cls, sketch(items).tobytes() if len(items) else None))
            rows = pd.DataFrame(out, columns=["n_shingles", "cls", "sketch"])
            rows.insert(0, "doc_id", common.ids_from(frame["doc_id"]))
            yield rows

    rows = docs.select(common.id_text(F.col("doc_id")).alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return common.written(rows.mapInPandas(
        run, "doc_id long, n_shingles long, cls binary, sketch binary"), "sketches")


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, rep) for every band of every class."""
    def run(frames):
        for frame in frames:
            if len(frame):
                keys = [band_keys(np.frombuffer(s, np.uint32)) for s in frame["sketch"]]
                yield pd.DataFrame({"key": np.concatenate(keys),
                                    "rep": np.repeat(frame["rep"].to_numpy(), BANDS)})

    return classes.select("rep", "sketch").mapInPandas(run, "key long, rep long")


def _sets(ids: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, items) with the full sorted shingle sets of ``ids(doc_id)``, written."""
    def sets(frames):
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "items": [
                shingles(t if isinstance(t, str) else None).view(np.int64)
                for t in frame["text"]]})

    wanted = common.written(ids.distinct(), "candidates", n, NARROW_ROWS)
    texts = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
             .join(common.bounded(wanted), "doc_id", "left_semi"))
    return common.written(texts.mapInPandas(sets, "doc_id long, items array<long>"), "sets")


def _verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of at most ``n`` ``pairs(a, b)`` whose full shingle sets are similar enough."""
    full = _sets(pairs.select(F.col("a").alias("doc_id")).unionByName(
        pairs.select(F.col("b").alias("doc_id"))), docs, 2 * n)
    side = {x: full.select(F.col("doc_id").alias(x), F.col("items").alias(f"{x}_items"))
            for x in "ab"}
    both = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - both
    return common.written(pairs.join(side["b"], "b").join(side["a"], "a")
                          .filter(100 * both >= percent * union).select("a", "b"), "links", n,
                          PAIR_ROWS)


def _crossing(members: DataFrame, classes: DataFrame, comps: DataFrame, docs: DataFrame,
              n: int, percent: int) -> DataFrame:
    """Verified links ``(a, b)`` that connect all components with a link between them in a bucket.

    ``members(key, rep)`` are the buckets with two classes or more, ``n`` rows. Members are dealt into blocks
    and strangers into stripes, and each block meets each stripe somewhere. Two passes: the first
    compares sketches and passes on the rows with a likely partner, the second compares the full sets
    of those, blocks being cut again by the shingles of their members. The number of tasks follows
    from the comparisons, not from the bytes. Pairs stay inside the tasks.
    """
    labelled = common.written(
        members.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", "rep", F.coalesce("component", "rep").alias("comp")), "members", n,
        NARROW_ROWS)
    by_comp = labelled.groupBy("key", "comp").agg(F.count("*").alias("c"))
    open_keys = common.written(
        by_comp.groupBy("key").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"),
                                   F.sum("c").alias("n"), F.count("*").alias("comps"),
                                   (F.sum("c") - F.max("c")).alias("strangers"))
        .filter("comps > 1").select(
            "key", "main", "n", "strangers", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.col("strangers") / (STRIPE * BLOCK)).cast("int").alias("stripes")),
        "open-buckets", n, NARROW_ROWS)
    total, pairs, sent = (x or 0 for x in open_keys.agg(
        F.sum("n"), F.sum(F.col("n").cast("double") * F.col("strangers")),
        F.sum(F.col("n") * F.col("stripes") + F.col("strangers") * F.col("blocks"))).first())
    rows = common.lookup_join(labelled, open_keys, ["key"], "n", total)
    block, stripe = (F.pmod(F.xxhash64("rep", F.lit(i)), F.col(c)).cast("int")
                     for i, c in enumerate(("blocks", "stripes")))
    member = F.transform(F.sequence(F.lit(0), F.col("stripes") - 1), lambda s: F.struct(
        (block * F.col("stripes") + s).alias("block"), F.lit(0).alias("role")))
    stranger = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(
        (b * F.col("stripes") + stripe).alias("block"), F.lit(1).alias("role")))
    copies = F.when(F.col("comp") != F.col("main"), F.concat(member, stranger)).otherwise(member)
    dealt = rows.select("key", "rep", "comp", F.explode(copies).alias("x")).select(
        "key", "rep", "comp", "x.*")
    likely = common.written(
        _by_block(dealt.join(classes.select("rep", "sketch"), "rep"), "sketch",
                  _tasks((pairs, TASK_PAIRS), (sent, TASK_ROWS)))
        .mapInPandas(partial(_likely, least=min_share(percent)), LIKELY).distinct(), "likely")
    n_likely = likely.count()
    sets = _sets(likely.select(F.col("rep").alias("doc_id")), docs, n_likely)
    # blocks again, now by the shingles that a task would hold
    sized = likely.join(classes.select("rep", "n_shingles"), "rep")
    held = F.sum(F.when(F.col("role") == 0, F.col("n_shingles")))
    cuts = common.written(
        sized.groupBy("key", "block").agg(F.coalesce(held, F.lit(0)).alias("held"),
                                          F.sum("role").alias("strangers"),
                                          F.count_if(F.col("role") == 0).alias("members"))
        # no more cuts than members: a set is never cut itself
        .withColumn("cuts", F.greatest(F.lit(1), F.least(
            "members", F.ceil(F.col("held") / BLOCK_SHINGLES))).cast("int")),
        "block-cuts", n_likely, NARROW_ROWS)
    work = cuts.agg(F.sum(F.col("held").cast("double") * F.col("strangers"))).first()[0] or 0
    cut = F.pmod(F.xxhash64("rep", F.lit(2)), F.col("cuts")).cast("int")
    own = F.when(F.col("role") == 0, F.array(cut)).otherwise(
        F.sequence(F.lit(0), F.col("cuts") - 1))
    full = (likely.join(cuts.select("key", "block", "cuts"), ["key", "block"])
            .select("key", "role", "rep", "comp", "block", F.explode(own).alias("cut"))
            .join(sets.withColumnRenamed("doc_id", "rep"), "rep"))
    return common.written(
        _by_block(full, "items", _tasks((work, TASK_SHINGLES), (n_likely, PAIR_ROWS)), "cut")
        .mapInPandas(partial(_linked, percent=percent), "a long, b long").distinct(), "crossing")


LIKELY = "key long, block int, role int, rep long, comp long"


def _tasks(*loads: tuple[float, int]) -> int:
    """Partitions so that none has more than about its share of each load."""
    return max(1, *(-(-int(load) // share) for load, share in loads))


def _by_block(rows: DataFrame, payload: str, tasks: int, *more: str) -> DataFrame:
    at = ["key", "block", *more]
    return (rows.select(*at, "role", "rep", "comp", payload).repartition(tasks, *at)
            .sortWithinPartitions(*at, "role"))


def _runs(frames):
    """(block, role, rows) for each run of equal bucket, block and role in sorted frames."""
    for frame in frames:
        cut = frame["cut"] if "cut" in frame else frame["block"]
        keys = list(zip(frame["key"], frame["block"], cut, frame["role"], strict=True))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo < hi:
                yield keys[lo][:3], keys[lo][3], frame.iloc[lo:hi]


def _likely(frames, least: float):
    """Rows sorted by bucket, block and role: the members of a block are held, the strangers behind
    them stream past. Passes on both sides of every pair of components whose sketches agree."""
    names = [c.split()[0] for c in LIKELY.split(", ")]
    at, parts, held, hit = None, [], None, None

    def flagged() -> list[tuple]:
        return [(*at, 0, held[0][hit], held[1][hit])] if held is not None and hit.any() else []

    def table(found: list[tuple]) -> pd.DataFrame:
        n = [len(f[3]) for f in found]
        columns = [np.repeat([f[i] for f in found], n) for i in range(3)]
        columns += [np.concatenate([f[i] for f in found]) for i in (3, 4)]
        return pd.DataFrame(dict(zip(names, columns, strict=True)))

    for frame in frames:
        if not len(frame):
            continue
        key, block, role, rep, comp = (frame[c].to_numpy() for c in names)
        sketches, found = _matrix(frame["sketch"]), []
        change = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])
                                | (role[1:] != role[:-1])) + 1
        for lo, hi in zip([0, *change.tolist()], [*change.tolist(), len(key)], strict=True):
            if (key[lo], block[lo]) != at:
                found += flagged()
                at, parts, held = (key[lo], block[lo]), [], None
            if role[lo] == 0:
                parts.append((rep[lo:hi], comp[lo:hi], sketches[lo:hi]))
                continue
            if held is None:
                if not parts:
                    continue
                held = [np.concatenate(x) for x in zip(*parts, strict=True)]
                hit = np.zeros(len(held[0]), dtype=bool)
            near = np.zeros(hi - lo, dtype=bool)
            for i in range(lo, hi, 8):
                some = slice(i, min(i + 8, hi))
                equal = (held[2][None] == sketches[some, None]).sum(axis=2, dtype=np.int16)
                close = (equal >= least * SIZE) & (held[1][None] != comp[some, None])
                hit |= close.any(axis=0)
                near[i - lo:some.stop - lo] = close.any(axis=1)
            if near.any():
                found.append((key[lo], block[lo], 1, rep[lo:hi][near], comp[lo:hi][near]))
        if found:
            yield table(found)
    if found := flagged():
        yield table(found)


def _matrix(sketches) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint32).reshape(-1, SIZE)


def _linked(frames, percent: int):
    """Like ``_likely`` on full sets: links that join components of a block, a spanning forest."""
    at, parts, held = None, [], None
    root: dict[int, int] = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for block, role, rows in _runs(frames):
        if block != at:
            at, parts, held, root = block, [], None, {}
        if role == 0:
            parts.append(rows)
            continue
        if held is None:
            if not parts:
                continue
            held = pd.concat(parts, ignore_index=True)
            sizes = held["items"].map(len).to_numpy()
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            known, index = np.unique(np.concatenate(list(held["items"])), return_inverse=True)
            rep, comp = held["rep"].to_numpy(), held["comp"].to_numpy()
        out = []
        for r, c, items in zip(rows["rep"], rows["comp"], rows["items"], strict=True):
            mark = np.zeros(len(known), dtype=np.int32)
            place = np.searchsorted(known, items)
            place[place == len(known)] = 0
            mark[place[known[place] == items]] = 1
            both = np.add.reduceat(mark[index], first)
            links = 100 * both >= percent * (sizes + len(items) - both)
            for j in np.flatnonzero(links & (comp != c)):
                x, y = find(int(comp[j])), find(int(c))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((int(rep[j]), int(r)))
        if out:
            yield pd.DataFrame(out, columns=["a", "b"])


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept, cls.
    Documents with a similarity of ``percent`` or more are linked.

    Null and empty texts, and texts without a word, have no shingle, link with nothing and form a
    component of their own. Rows with equal ids are one document, whose texts link to what any of
    them is similar to. Rows without an id are in no link: their component_id is null and they are
    kept. Repeated rows get equal answers; other columns are not read; an empty table gives an empty
    result.
    """
    rows = _sketches(docs)
    usable = "n_shingles > 0 and doc_id is not null"
    n = rows.filter(usable).count()
    classes = common.written(
        rows.filter(usable).groupBy("cls")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"),
             F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")),
        "classes", n, WIDE_ROWS)
    buckets = common.written(_buckets(classes), "buckets")
    shared = common.written(buckets.groupBy("key").agg(
        F.min("rep").alias("center"), F.count("*").alias("n")).filter("n > 1"), "shared",
        BANDS * n // 2, NARROW_ROWS)
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    members = common.written(common.lookup_join(buckets, shared, ["key"], "n", total)
                             .select("key", "rep", "center"), "shared-members", BANDS * n,
                             NARROW_ROWS)
    first = common.written(members.filter("center < rep").groupBy("rep").agg(
        F.min("center").alias("a")).select("a", F.col("rep").alias("b")), "star-pairs", n,
        NARROW_ROWS)
    links = _verified(first, docs, first.count(), percent)
    comps = common.components(links)
    links = links.unionByName(_crossing(members.select("key", "rep"), classes, comps, docs,
                                        total, percent))
    # a document whose rows have several texts belongs to several classes: tie them
    several = common.written(
        rows.filter(usable).groupBy("doc_id")
        .agg(F.min("cls").alias("x"), F.max("cls").alias("y")).filter("x <> y")
        .select("doc_id"), "several-texts", n, NARROW_ROWS)
    if several.limit(1).count():
        links = links.unionByName(
            rows.filter("n_shingles > 0").select("doc_id", "cls").distinct()
            .join(several, "doc_id").join(classes.select("cls", "rep"), "cls")
            .select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    comps = common.components(links)
    answer = common.written(classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
                            .groupBy("cls").agg(F.first("n").alias("n"), F.min(
                                F.coalesce("component", "rep")).alias("component_id")), "answer",
                            n, NARROW_ROWS)
    linked = rows.filter(usable).select("doc_id", "n_shingles", "cls")
    alone = rows.filter("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "cls")
    out = (common.lookup_join(linked, answer, ["cls"], "n", n)
           .select("doc_id", "n_shingles", "component_id", "cls").unionByName(alone))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "cls")


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group, all columns and names as they are. Rows with equal
    ids are one document, of which one row stays; rows without an id all stay."""
    kept = common.written(near_duplicates(docs.select("doc_id", "text"), percent).filter(
        "doc_id is not null").groupBy("doc_id").agg(F.min("kept").alias("kept"),
                                                    F.count("*").alias("n")).filter("kept"),
                          "kept")
    single = common.bounded(common.written(kept.filter("n = 1").select("doc_id"), "single"))
    several = common.bounded(common.written(kept.filter("n > 1").select("doc_id"), "several"))
    return (docs.join(single, "doc_id", "left_semi")
            .unionByName(docs.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
            .unionByName(docs.filter("doc_id is null")))
