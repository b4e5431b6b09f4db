"""Labelled patterns (T5 ``as`` / ``select``, T6): several hops whose vertices and edges keep their names.

A traversal forgets where its traversers came from; a pattern names every vertex and, on request, every
edge, and can be asked for any of them together::

    p = (Pattern.start(g, "me", "USER", keys=[7])
         .out("me", "RATED_AS", "movie", edge="mine")
         .in_("movie", "RATED_AS", "other", edge_where=F.col("score") >= 4, edge="theirs"))
    m = p.matches()
    m.select("movie", "other", props={"mine": ["score"], "theirs": ["score"]})
    m.per("movie")            # matches through each movie, none of them enumerated
    m.count()

Each step adds a new name beside one that exists, so patterns are trees. They are answered by semi-join
reduction: edge tables are cut down, first outwards from the most restricted vertex (whose keys reach the
edge scans), then inwards, then outwards again, after which every edge that is left lies in a match. The
reduced edge tables are the factorised result. Their rows never exceed those of the edge tables, whatever
the number of matches; counts come from them by adding and multiplying along the tree.

``select`` joins them, and as no row is a dead end no intermediate table has more rows than the result over
the names it covers. Names that stand between the selected ones are covered too and summed away at the end;
everything further out enters as a count. ``bulk`` says how many matches a row stands for: parallel edges
without a name are one row. Edge endpoints are taken to exist (V2).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import sizing
from ..sources.graphstore import Graph
from .traversal import KEY_LIST_LIMIT

EDGES = "_edges"                      # column: how many equal edges a row stands for


@dataclass(frozen=True)
class Vertex:
    name: str
    label: str
    where: Column | None = None
    keys: tuple | DataFrame | None = None

    @property
    def restricted(self) -> bool:
        return self.where is not None or self.keys is not None


@dataclass(frozen=True, eq=False)
class Edge:
    near: str                         # the name that the step started from
    far: str
    label: str
    column: str                       # endpoint column of ``near``
    where: Column | None = None
    name: str | None = None

    def other(self, name: str) -> str:
        return self.far if name == self.near else self.near

    def column_of(self, name: str) -> str:
        return self.column if name == self.near else {"src": "dst", "dst": "src"}[self.column]


@dataclass(frozen=True)
class Pattern:
    graph: Graph
    vertices: dict[str, Vertex] = field(default_factory=dict)
    edges: tuple[Edge, ...] = ()

    @classmethod
    def start(cls, graph: Graph, name: str, label: str, where: Column | None = None,
              keys: Iterable | DataFrame | None = None) -> "Pattern":
        """``V().hasLabel(label).as(name)``, narrowed by a predicate and/or key values."""
        return cls(graph)._with_vertex(name, label, where, keys)

    def _with_vertex(self, name, label, where, keys) -> "Pattern":
        self._check_name(name)
        if label not in S.VERTICES:
            raise KeyError(f"no vertex label {label!r}")
        if keys is not None and not isinstance(keys, DataFrame):
            keys = tuple(dict.fromkeys(keys))
        return replace(self, vertices={**self.vertices, name: Vertex(name, label, where, keys)})

    def _check_name(self, name: str, *others: str) -> None:
        """Names become columns: no two that differ in case only, none of the library's own."""
        taken = {x.lower() for x in (*self.vertices, *(e.name for e in self.edges if e.name),
                                     *others)}
        if name.lower() in taken:
            raise ValueError(f"the pattern already has a {name!r}")
        if name.startswith("_") or name.lower() == "bulk":
            raise ValueError(f"{name!r} cannot be a name")

    def _step(self, from_, edge_label, name, column, where, keys, edge_where, edge) -> "Pattern":
        if from_ not in self.vertices:
            raise KeyError(f"no vertex {from_!r} in the pattern; have {list(self.vertices)}")
        spec = S.EDGES[edge_label]
        if getattr(spec, column) != self.vertices[from_].label:
            raise ValueError(f"{edge_label} has no {column} at {self.vertices[from_].label}")
        if edge is not None:
            self._check_name(edge, name)
        grown = self._with_vertex(name, getattr(spec, {"src": "dst", "dst": "src"}[column]), where,
                                  keys)
        return replace(grown, edges=(*self.edges, Edge(from_, name, edge_label, column, edge_where,
                                                       edge)))

    def out(self, from_: str, edge_label: str, name: str, where: Column | None = None,
            keys: Iterable | DataFrame | None = None, edge_where: Column | None = None,
            edge: str | None = None) -> "Pattern":
        """Follow edges forward from ``from_`` to a vertex called ``name``; ``edge`` names the edge."""
        return self._step(from_, edge_label, name, "src", where, keys, edge_where, edge)

    def in_(self, from_: str, edge_label: str, name: str, where: Column | None = None,
            keys: Iterable | DataFrame | None = None, edge_where: Column | None = None,
            edge: str | None = None) -> "Pattern":
        """Follow edges backward from ``from_`` to a vertex called ``name``."""
        return self._step(from_, edge_label, name, "dst", where, keys, edge_where, edge)

    def matches(self) -> "Matches":
        """The factorised result (runs the reduction)."""
        return Matches(self)


def _tree(edges: Iterable[Edge], root: str) -> list[tuple[str, str, Edge]]:
    """``(parent, child, edge)`` outwards from ``root``."""
    left, out, reached = list(edges), [], [root]
    for parent in reached:
        for e in [e for e in left if parent in (e.near, e.far)]:
            left.remove(e)
            out.append((parent, e.other(parent), e))
            reached.append(e.other(parent))
    return out


class Matches:
    """Reduced edge tables of a pattern: ``rows`` per edge, in the columns of both names, ``_edges`` (parallel
    ones) and the edge's properties if it has a name."""

    def __init__(self, pattern: Pattern):
        self.pattern = pattern
        self.sizes: list[int] = []        # rows of every table made on the way
        self._reduce()

    # ------------------------------------------------------------ reduction

    def _kept(self, df: DataFrame) -> sizing.Sized:
        held = sizing.materialize(df)
        self.sizes.append(held.rows)
        return held

    def _own(self, name: str) -> sizing.Sized | None:
        """Keys that the vertex's own restriction leaves, None if it has none."""
        v = self.pattern.vertices[name]
        if not v.restricted:
            return None
        key = S.VERTICES[v.label].key
        rows = self.pattern.graph.V(v.label)
        if v.where is not None:
            rows = rows.where(v.where)
        if isinstance(v.keys, DataFrame):
            side = sizing.for_join(sizing.Sized(
                v.keys.select(F.col(v.keys.columns[0]).alias(key)).distinct(), None))
            rows = rows.join(side, key, "left_semi")
        elif v.keys is not None:
            rows = rows.where(F.col(key).isin(list(v.keys)))
        return self._kept(rows.select(F.col(key).alias(name)))

    def _scan(self, e: Edge, name: str, keys: sizing.Sized | None) -> DataFrame:
        """The rows of an edge, from the keys at ``name`` where there are any: few keys are pushed into the
        scan of the copy clustered on that end."""
        near = e.column_of(name)
        graph = self.pattern.graph
        direction = "out" if near == "src" else "in"
        rows = graph.adjacency.get((e.label, direction)) if keys is not None else None
        rows = graph.E(e.label) if rows is None else rows
        if e.where is not None:
            rows = rows.where(e.where)
        if keys is not None and keys.rows <= KEY_LIST_LIMIT:
            rows = rows.where(F.col(near).isin([r[0] for r in keys.df.collect()]))
        other = "dst" if near == "src" else "src"
        ends = [F.col(near).alias(name), F.col(other).alias(e.other(name))]
        if e.name:
            return rows.select(*ends, *[F.col(p).alias(f"{e.name}_{p}")
                                        for p, _ in S.EDGES[e.label].properties],
                               F.lit(1).cast("bigint").alias(EDGES))
        return rows.select(*ends)

    @staticmethod
    def _semi(rows: DataFrame, keys: sizing.Sized | None, name: str) -> DataFrame:
        return rows if keys is None else rows.join(sizing.for_join(keys), name, "left_semi")

    def _reduce(self) -> None:
        p = self.pattern
        allowed: dict[str, sizing.Sized | None] = {x: self._own(x) for x in p.vertices}
        held = {x: k.rows for x, k in allowed.items() if k is not None}
        self.root = min(held, key=lambda x: (held[x], x)) if held else next(iter(p.vertices))
        self.tree = _tree(p.edges, self.root)
        self.rows: dict[Edge, sizing.Sized] = {}
        # outwards: what can be reached from the root
        for parent, child, e in self.tree:
            rows = self._semi(self._scan(e, parent, allowed[parent]), allowed[parent], parent)
            rows = self._semi(rows, allowed[child], child)
            if not e.name:
                rows = rows.groupBy(parent, child).agg(F.count(F.lit(1)).alias(EDGES))
            self.rows[e] = self._kept(rows)
            if any(child == x for x, _, _ in self.tree):
                allowed[child] = self._kept(self.rows[e].df.select(child).distinct())
        # inwards: what finds all that lies behind it
        for parent, child, e in reversed(self.tree):
            behind = [x for x in self.tree if x[0] == child]
            if behind:
                self._shrink(e, child, self._having(child, behind, allowed[child]))
        # outwards again: what is still reached
        allowed[self.root] = self._having(self.root, [x for x in self.tree if x[0] == self.root],
                                          allowed[self.root])
        for parent, child, e in self.tree:
            self._shrink(e, parent, allowed[parent])
            if any(child == x for x, _, _ in self.tree):
                allowed[child] = self._kept(self.rows[e].df.select(child).distinct())
        self.keys = allowed

    def _having(self, name: str, steps: list, keys: sizing.Sized | None) -> sizing.Sized | None:
        """Keys at ``name`` that have a row in each of the steps outwards."""
        if not steps:
            return keys
        rows = keys.df if keys is not None else None
        for _, _, e in steps:
            found = self.rows[e].df.select(name).distinct()
            rows = found if rows is None else rows.join(found, name, "left_semi")
        return self._kept(rows)

    def _shrink(self, e: Edge, name: str, keys: sizing.Sized | None) -> None:
        if keys is not None and self.rows[e].rows:
            self.rows[e] = self._kept(self._semi(self.rows[e].df, keys, name))

    # ------------------------------------------------------------ answers

    def _weights(self, name: str, coming: Edge | None, inside: set[Edge]) -> DataFrame | None:
        """``name, _w``: matches of what lies behind a vertex, seen from the edge ``coming`` and leaving out
        the edges ``inside``; None where nothing does."""
        out = None
        for e in self.pattern.edges:
            if e == coming or e in inside or name not in (e.near, e.far):
                continue
            other = e.other(name)
            behind = self._weights(other, e, inside)
            rows = self.rows[e].df.select(name, other, EDGES)
            if behind is not None:
                rows = rows.join(behind, other).withColumn(EDGES, F.col(EDGES) * F.col("_w"))
            one = rows.groupBy(name).agg(F.sum(EDGES).alias("_w"))
            out = one if out is None else out.join(one.withColumnRenamed("_w", "_v"), name).select(
                name, (F.col("_w") * F.col("_v")).alias("_w"))
        return out

    def per(self, name: str) -> DataFrame:
        """``key, bulk``: the number of matches through each vertex called ``name``."""
        self._expect(name)
        weights = self._weights(name, None, set())
        if weights is None:               # a pattern of one vertex
            return self._alone(name).select(F.col(name).alias("key"),
                                            F.lit(1).cast("bigint").alias("bulk"))
        return weights.select(F.col(name).alias("key"), F.col("_w").cast("bigint").alias("bulk"))

    def count(self) -> DataFrame:
        """The number of matches as a one-row DataFrame."""
        return self.per(self.root).agg(F.coalesce(F.sum("bulk"), F.lit(0)).cast("bigint")
                                       .alias("count"))

    def _alone(self, name: str) -> DataFrame:
        if self.keys[name] is not None:
            return self.keys[name].df
        v = self.pattern.vertices[name]
        return self.pattern.graph.V(v.label).select(F.col(S.VERTICES[v.label].key).alias(name))

    def _expect(self, name: str) -> None:
        if name not in self.pattern.vertices:
            raise KeyError(f"no vertex {name!r} in the pattern; have {list(self.pattern.vertices)}")

    def hull(self, names: Iterable[str]) -> list[Edge]:
        """The edges between the given vertices."""
        names, kept = set(names), list(self.pattern.edges)
        while True:
            degree: dict[str, int] = {}
            for e in kept:
                for x in (e.near, e.far):
                    degree[x] = degree.get(x, 0) + 1
            loose = [e for e in kept if any(degree[x] == 1 and x not in names
                                            for x in (e.near, e.far))]
            if not loose:
                return kept
            kept = [e for e in kept if e not in loose]

    def select(self, *names: str, props: dict[str, Iterable[str]] | None = None) -> DataFrame:
        """One row per combination of the selected vertices (a column of keys each) and edge properties,
        with ``bulk``; ``props`` adds ``<name>_<property>`` columns of vertices or named edges."""
        props = {x: list(ps) for x, ps in (props or {}).items()}
        by_name = {e.name: e for e in self.pattern.edges if e.name}
        for x in [*names, *(x for x in props if x not in by_name)]:
            self._expect(x)
        if not names:
            raise ValueError("select at least one vertex")
        vertex_props = {x: ps for x, ps in props.items() if x not in by_name}
        if any(x not in names for x in vertex_props):
            raise ValueError("properties of a vertex need the vertex selected")
        edge_columns = {by_name[x]: [f"{x}_{p}" for p in ps]
                        for x, ps in props.items() if x in by_name}
        ends = [x for e in edge_columns for x in (e.near, e.far)]
        inside = self.hull([*names, *ends])
        root = names[0]
        covered = [root, *[child for _, child, _ in _tree(inside, root)]]
        rows = None
        for parent, child, e in _tree(inside, root):
            side = self.rows[e]
            columns = edge_columns.get(e, [])
            table = side.df.groupBy(parent, child, *columns).agg(
                F.sum(EDGES).alias(EDGES)) if e.name else side.df.select(parent, child, EDGES)
            if rows is None:
                rows = table.withColumnRenamed(EDGES, "bulk")
                continue
            rows = rows.join(sizing.for_join(sizing.Sized(table, side.rows, side.width)), parent) \
                .withColumn("bulk", F.col("bulk") * F.col(EDGES)).drop(EDGES)
        if rows is None:
            rows = self._alone_reduced(root)
        for x in covered:                 # what hangs on the covered vertices enters as a count
            w = self._weights(x, None, set(inside))
            if w is not None:
                rows = rows.join(w, x).withColumn("bulk", F.col("bulk") * F.col("_w")).drop("_w")
        shown = [*names, *[c for cs in edge_columns.values() for c in cs]]
        if set(covered) != set(names):
            rows = rows.groupBy(*shown).agg(F.sum("bulk").alias("bulk"))
        rows = rows.select(*shown, F.col("bulk").cast("bigint").alias("bulk"))
        for x, ps in vertex_props.items():
            label = self.pattern.vertices[x].label
            v = self.pattern.graph.V(label).select(
                F.col(S.VERTICES[label].key).alias(x), *[F.col(p).alias(f"{x}_{p}") for p in ps])
            rows = rows.join(v, x)
        return rows.select(*names, *[f"{x}_{p}" for x, ps in props.items() for p in ps], "bulk")

    def _alone_reduced(self, name: str) -> DataFrame:
        """The vertices called ``name`` that lie in a match."""
        for e in self.pattern.edges:
            if name in (e.near, e.far):
                rows = self.rows[e].df.select(name).distinct()
                break
        else:
            rows = self._alone(name)
        return rows.withColumn("bulk", F.lit(1).cast("bigint"))
