"""Near-duplicate embeddings by an exact metric range join.

On unit vectors, cosine >= c is a Euclidean distance of at most r = sqrt(2 - 2c), so the triangle
inequality holds. Pivots split the vectors into cells (nearest pivot); a vector also visits every
other cell that a partner within r could lie in: if y is within r of a member x of the cell of
pivot p, then d(y, p) <= d(y, nearest) + 2r, and its distance to the hyperplane between both
pivots is at most r. Neighbouring cells form blocks, and a vector is sent to a block once, however
many of its cells it visits. The visitors of a block are dealt into stripes; block and stripe are a
tile, joined by one task. A member's links are counted in the tiles of its block and added up; no pair
leaves a task.

Inside a tile a visitor meets the members of the cells whose ball - pivot and farthest member -
comes within r of it. They are compared in a rotated basis by the leading components first: the
product of two vectors is at most that of the leading parts plus the product of the lengths of the rests, so
most pairs are decided by a short product in single precision, with room for its rounding. What is left
is compared in double precision. How many components lead is chosen on the pivots' sample.

Equal vectors collapse to one class first. Connectivity leaves a task as at most one edge per visitor
and member. Where no pivot separates the vectors (unstructured ones in many dimensions), every block
is visited by all: the join is then a blocked scan, still exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


BLOCK_BYTES = 16 << 20            # vectors of a block, in double precision
CELLS = 16                        # cells of a block, about
CHUNK = 4096                      # members compared with a frame of visitors at once
LEADING = (8, 16, 24, 32, 48, 64, 96, 128, 192, 256)
LEFT_SHARE = 0.005                # of the pairs of a sample the leading components may leave open
MAX_ROTATED = 1024                # longer vectors are not rotated


@dataclass(frozen=True)
class RangeJoin:
    cosine: float = 0.9
    members: int | None = None        # members of a block; None: as many as BLOCK_BYTES hold
    pivots: int = 4096                # at most; further cells are cut into blocks as they are
    stripe: int = 4                   # visitors of a tile, in blocks
    # slack of the replication bound against rounding of the distances
    slack: float = 1e-6

    @property
    def radius(self) -> float:
        return math.sqrt(2 - 2 * self.cosine) + self.slack


@dataclass(frozen=True)
class Layout:
    """What every task knows: pivots, blocks as runs of cells, and the rotated basis."""

    pivots: np.ndarray
    entry_cell: np.ndarray            # cells in the order of their blocks, a split cell once for each
    entry_start: np.ndarray           # where each block begins in ``entry_cell``
    first: np.ndarray                 # first block of a cell
    parts: np.ndarray                 # blocks of a cell
    stripes: int
    basis: np.ndarray | None          # leading directions as columns; None: the first components
    lead: int

    def leading(self, x: np.ndarray) -> np.ndarray:
        """Leading components and, last, a bound of the length of the rest; single precision."""
        head = x[:, :self.lead] if self.basis is None else x @ self.basis
        rest = np.sqrt(np.maximum(1 - (head * head).sum(axis=1), 0)) + 1e-7
        return np.column_stack([head, rest]).astype(np.float32)

    def rounding(self) -> float:
        """Bound of the error of a product of two rows of ``leading``."""
        return 1e-6 * (self.lead + 16)


def usable(v: Column) -> Column:
    """True for vectors with a direction: not null or empty, every component finite, not zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite
                      & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(rows) -> np.ndarray:
    x = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    # scaling by the largest component first keeps squares from over- and underflowing
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _sample(classes: DataFrame, n: int, k: int) -> np.ndarray:
    """Unit vectors of a hash sample of at most 16 rows for each of ``k`` pivots, 512 at least."""
    most = max(512, 16 * k)
    share = min(1.0, 0.8 * most / max(n, 1))
    sample = classes.filter(F.pmod(F.xxhash64("cls", F.lit(1)), F.lit(1 << 30))
                            <= int(share * (1 << 30))).orderBy("cls").limit(most).collect()
    if not sample:
        sample = classes.orderBy("cls").limit(1).collect()
    return unit([r["v"] for r in sample])


def _farthest(x: np.ndarray, k: int) -> np.ndarray:
    """Pivots from a sample, each next one the farthest from those chosen: the first few are spread as
    widely as few can be."""
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def _basis(x: np.ndarray, cosine: float) -> tuple[np.ndarray | None, int]:
    """Directions in which a sample spreads most, as many as decide nearly all of its pairs."""
    size = x.shape[1]
    axes = None if size > MAX_ROTATED else np.linalg.eigh(x.T @ x)[1][:, ::-1]
    x = x[:512]
    turned = x if axes is None else x @ axes
    for lead in LEADING:
        if 2 * lead > size:
            break
        head = turned[:, :lead]
        rest = np.sqrt(np.maximum(1 - (head * head).sum(axis=1), 0))
        left = (head @ head.T + np.outer(rest, rest) >= cosine).sum() - len(x)
        if left <= LEFT_SHARE * len(x) * (len(x) - 1):
            return None if axes is None else np.ascontiguousarray(axes[:, :lead]), lead
    return None, size


def _cells(x: np.ndarray, pivots: np.ndarray, join: RangeJoin) -> tuple[np.ndarray, np.ndarray]:
    """Own cell of each vector, and a matrix of the cells it visits (its own included)."""
    r = join.radius
    apart = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(-1))
    cos = x @ pivots.T
    own = cos.argmax(axis=1)
    here = np.arange(len(x))
    far = np.sqrt(np.maximum(2 - 2 * cos, 0))
    # distance to the hyperplane between own pivot and p: (cos own - cos p) / their distance <= r
    visits = ((cos[here, own][:, None] - cos <= r * apart[own] + join.slack)
              & (far <= far[here, own][:, None] + 2 * r))
    visits[here, own] = True
    return own, visits


def _cell_sizes(classes: DataFrame, pivots: np.ndarray, join: RangeJoin) -> np.ndarray:
    """Members of each cell (a row per pivot is collected)."""
    def cells(frames):
        for frame in frames:
            if len(frame):
                own, _ = _cells(unit(frame["v"]), pivots, join)
                cell, n = np.unique(own, return_counts=True)
                yield pd.DataFrame({"cell": cell, "n": n})

    counted = classes.select("v").mapInPandas(cells, "cell int, n long").groupBy("cell").sum("n")
    sizes = np.zeros(len(pivots), dtype=np.int64)
    for cell, n in counted.collect():
        sizes[cell] = n
    return sizes


def _laid_out(classes: DataFrame, n: int, size: int, join: RangeJoin) -> Layout:
    members = join.members or max(64, BLOCK_BYTES // (8 * size))
    k = max(1, min(join.pivots, -(-n * CELLS // members)))
    sample = _sample(classes, n, k)
    pivots = _farthest(sample, k)
    sizes = _cell_sizes(classes, pivots, join)
    # cells by the nearest of the first pivots, so that a block holds neighbouring ones
    heads = pivots[:max(1, -(-n // members))]
    near = (pivots @ heads.T).argmax(axis=1)
    first, parts = np.zeros(k, dtype=np.int64), np.ones(k, dtype=np.int64)
    entry_cell, entry_block, block, room = [], [], -1, 0
    for cell in np.lexsort((np.arange(len(pivots)), near)).tolist():
        parts[cell] = max(1, -(-sizes[cell] // members))
        if block < 0 or parts[cell] > 1 or sizes[cell] > room:
            block, room = block + 1, members
        first[cell] = block
        entry_cell += [cell] * int(parts[cell])
        entry_block += range(block, block + int(parts[cell]))
        block += int(parts[cell]) - 1
        room = 0 if parts[cell] > 1 else room - int(sizes[cell])
    basis, lead = _basis(sample, join.cosine)
    return Layout(pivots, np.asarray(entry_cell), np.searchsorted(entry_block, np.arange(block + 1)),
                  first, parts, max(1, -(-n // (join.stripe * members))), basis, lead)


def _dealt(classes: DataFrame, layout: Layout, join: RangeJoin) -> DataFrame:
    """(cls, copies, v, tile, role): a member row (role 0) in every tile of its block, a visitor row (role 1)
    in its stripe of every block visited."""
    stripes = layout.stripes

    def deal(frames):
        for frame in frames:
            if not len(frame):
                continue
            own, visits = _cells(unit(frame["v"]), layout.pivots, join)
            hit = np.logical_or.reduceat(visits[:, layout.entry_cell], layout.entry_start, axis=1)
            i, block = np.nonzero(hit)
            salt = frame["salt"].to_numpy()
            home = layout.first[own] + salt % layout.parts[own]
            stripe = (salt >> 20) % stripes
            all_rows = np.repeat(np.arange(len(frame)), stripes)
            tile = np.concatenate([home[all_rows] * stripes + np.tile(np.arange(stripes), len(frame)),
                                   block * stripes + stripe[i]])
            role = np.zeros(len(tile), dtype=np.int32)
            role[len(all_rows):] = 1
            i = np.concatenate([all_rows, i])
            yield pd.DataFrame({
                "cls": frame["cls"].to_numpy()[i], "copies": frame["copies"].to_numpy()[i],
                "v": frame["v"].to_numpy()[i], "tile": tile, "role": role})

    salt = F.pmod(F.xxhash64("cls", F.lit(2)), F.lit(1 << 40)).alias("salt")
    kind = dict(classes.dtypes)["v"]
    return classes.select("cls", "copies", "v", salt).mapInPandas(
        deal, f"cls long, copies long, v {kind}, tile long, role int")


class Tile:
    """The members of a tile, cell by cell, and what its visitors have shown of them so far."""

    def __init__(self, rows: pd.DataFrame, layout: Layout, join: RangeJoin):
        x = unit(rows["v"])
        cos = x @ layout.pivots.T
        cell = cos.argmax(axis=1)
        order = np.argsort(cell, kind="stable")
        self.layout, self.join = layout, join
        self.ids, self.x = rows["cls"].to_numpy()[order], x[order]
        self.lead = layout.leading(self.x)
        cells, self.begin = np.unique(cell[order], return_index=True)
        self.end = np.append(self.begin[1:], len(order))
        self.pivots = layout.pivots[cells]
        # the farthest member of each cell
        least = np.minimum.reduceat(cos[order, cell[order]], self.begin)
        self.ball = np.sqrt(np.maximum(2 - 2 * least, 0)) + join.radius + join.slack
        self.links = np.zeros(len(order), dtype=np.int64)
        self.label = np.arange(len(order))

    def _near(self, lo: int, hi: int, x: np.ndarray, lead: np.ndarray):
        """Members of a range and visitors that are near."""
        cosine = self.join.cosine
        member, visitor = np.nonzero(
            self.lead[lo:hi] @ lead.T >= np.float32(cosine - self.layout.rounding()))
        if len(member) * 10 > (hi - lo) * len(x):          # mostly near: compare all at once
            return np.nonzero(self.x[lo:hi] @ x.T >= cosine)
        sure = np.zeros(len(member), dtype=bool)
        for at in range(0, len(member), 1 << 14):
            part = slice(at, at + (1 << 14))
            sure[part] = np.einsum("ij,ij->i", self.x[lo + member[part]], x[visitor[part]]) >= cosine
        return member[sure], visitor[sure]

    def meet(self, rows: pd.DataFrame) -> pd.DataFrame | None:
        """Compare visitors with the members; an edge for each visitor that found one."""
        seen, copies = rows["cls"].to_numpy(), rows["copies"].to_numpy()
        x = unit(rows["v"])
        lead = self.layout.leading(x)
        far = np.sqrt(np.maximum(2 - 2 * (x @ self.pivots.T), 0))
        open_ = far <= self.ball
        if open_.mean() > 0.5:
            ranges = [(lo, min(lo + CHUNK, len(self.ids)), None)
                      for lo in range(0, len(self.ids), CHUNK)]
        else:
            ranges = [(lo, min(lo + CHUNK, end), np.flatnonzero(open_[:, c]))
                      for c, (begin, end) in enumerate(zip(self.begin, self.end, strict=True))
                      if open_[:, c].any() for lo in range(begin, end, CHUNK)]
        members, visitors = [], []
        for lo, hi, some in ranges:
            i, j = self._near(lo, hi, x if some is None else x[some],
                              lead if some is None else lead[some])
            i, j = i + lo, j if some is None else some[j]
            other = self.ids[i] != seen[j]
            members.append(i[other])
            visitors.append(j[other])
        member, visitor = np.concatenate(members or [[]]), np.concatenate(visitors or [[]])
        if not len(member):
            return None
        member, visitor = member.astype(np.int64), visitor.astype(np.int64)
        self.links += np.bincount(member, weights=copies[visitor],
                                  minlength=len(self.ids)).astype(np.int64)
        self.label = _join(self.label, member, visitor)
        found, at = np.unique(visitor, return_index=True)
        return pd.DataFrame({"kind": 1, "a": seen[found], "b": self.ids[member[at]]})

    def finished(self):
        """Links counted per member (where there are any) and edges that span its components."""
        some = np.flatnonzero(self.links)
        yield pd.DataFrame({"kind": 0, "a": self.ids[some], "b": self.links[some]})
        root = _roots(self.label)
        some = np.flatnonzero(root != np.arange(len(root)))
        yield pd.DataFrame({"kind": 1, "a": self.ids[some], "b": self.ids[root[some]]})


def _matched(layout: Layout, join: RangeJoin):
    def match(frames):
        """Rows sorted by tile, members first."""
        at, tile, parts = None, None, []
        for frame in frames:
            key, role = frame["tile"].to_numpy(), frame["role"].to_numpy()
            change = np.flatnonzero((key[1:] != key[:-1]) | (role[1:] != role[:-1])) + 1
            for lo, hi in zip([0, *change], [*change, len(frame)], strict=True):
                if lo == hi:
                    continue
                if key[lo] != at:
                    if tile is not None:
                        yield from tile.finished()
                    at, tile, parts = key[lo], None, []
                rows = frame.iloc[lo:hi]
                if role[lo] == 0:
                    parts.append(rows)
                    continue
                if tile is None:
                    if not parts:
                        continue
                    tile, parts = Tile(pd.concat(parts), layout, join), []
                found = tile.meet(rows)
                if found is not None:
                    yield found
        if tile is not None:
            yield from tile.finished()

    return match


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if (up == label).all():
            return label
        label = up


def _join(label: np.ndarray, member: np.ndarray, visitor: np.ndarray) -> np.ndarray:
    """Labels of members after joining all that share a visitor."""
    while True:
        label = _roots(label)
        least = np.full(visitor.max() + 1, len(label))
        np.minimum.at(least, visitor, label[member])
        new = label.copy()
        np.minimum.at(new, label[member], least[visitor])   # hang the root, not only the member
        np.minimum.at(new, member, least[visitor])
        if (new == label).all():
            return label
        label = new


def near_duplicates(vectors: DataFrame, join: RangeJoin | None = None) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding)``: vec_id, n_links, component_id, kept.

    Null, empty and zero vectors and those with null, NaN or infinite components link with nothing;
    vectors of different lengths never link. Rows with a null vec_id are counted as partners by
    none: they stand alone with component_id null. Repeated ids are rows of their own (each counts
    as a link of the other if the vectors are near). Other columns are not read. Each vector length
    is a join of its own, so a table should not hold very many lengths.
    """
    join = join or RangeJoin()
    kind = dict(vectors.dtypes)["embedding"]
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast(kind).alias("v"))
    rows = rows.withColumn("ok", usable(F.col("v")) & F.col("vec_id").isNotNull())
    text = F.array_join(F.col("v").cast("array<string>"), ",")
    keyed = common.written(rows.filter("ok").select(
        "vec_id", "v", F.unhex(F.md5(text.cast("binary"))).alias("key")), "vectors")
    classes = keyed.groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"),
                                       F.first("v").alias("v"))
    classes = common.written(classes.withColumn("dim", F.size("v")), "vector-classes")
    # a class goes by its least id; where repeated ids make two classes share it, by a hash
    shared = common.written(classes.groupBy("least").count().filter("count > 1").select(
        "least", F.lit(True).alias("shared")), "shared-ids")
    classes = classes.join(common.bounded(shared), "least", "left").select(
        "key", "least", "copies", "v", "dim",
        F.when(F.col("shared"), F.xxhash64("key")).otherwise(F.col("least")).alias("cls"))
    out = rows.filter("not ok").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for dim in [r["dim"] for r in classes.select("dim").distinct().collect()]:
        same = F.size("v") == dim
        out = out.unionByName(_joined(keyed.filter(same), classes.filter(same), dim, join))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _joined(keyed: DataFrame, classes: DataFrame, size: int, join: RangeJoin) -> DataFrame:
    """The answer for vectors of one length."""
    layout = _laid_out(classes, classes.count(), size, join)
    tiles = len(layout.entry_start) * layout.stripes
    tasks = (_dealt(classes, layout, join).repartition(2 * tiles, "tile")
             .sortWithinPartitions("tile", "role"))
    found = common.written(tasks.mapInPandas(_matched(layout, join), "kind int, a long, b long"),
                           "matches")
    comps = common.components(found.filter("kind = 1 and a <> b").select("a", "b"))
    links = found.filter("kind = 0").groupBy("a").agg(F.sum("b").alias("links")).select(
        F.col("a").alias("cls"), "links")
    answer = common.written(
        classes.select("cls", "key", "copies", "least").join(links, "cls", "left")
        .join(comps.withColumnRenamed("node", "cls"), "cls", "left")
        # the other copies of the same vector are linked as well
        .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
        .withColumn("component", F.coalesce("component", "cls")).drop("links"), "vector-answer")
    least = answer.groupBy("component").agg(F.min("least").alias("component_id"),
                                            F.count("*").alias("classes"))
    n = answer.count()
    answer = common.written(common.lookup_join(
        answer, common.written(least, "vector-components"), ["component"], "classes", n)
        .select("key", "copies", "n_links", "component_id"), "vector-keys")
    return common.lookup_join(keyed.select("vec_id", "key"), answer, ["key"], "copies",
                              keyed.count()).select("vec_id", "n_links", "component_id")
