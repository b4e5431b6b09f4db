"""Traversal steps over the graph tables.

A traversal holds its current vertices as a DataFrame ``key, bulk``: each distinct vertex once,
with ``bulk`` = the number of paths that reach it (the multiset of traversers, aggregated). A hop
joins the frontier with one edge table and re-aggregates by the far endpoint, so

* the frontier never holds more rows than there are distinct vertices, whatever the number of
  paths (no path explosion, no per-pair output);
* the aggregation is partial on each map task - a movie reached from a third of all ratings costs
  one row per task before the shuffle;
* the frontier's size is proven before each join (a list of start keys bounds it; otherwise it
  is checkpointed and counted, see :mod:`filmgraph.operators.sizing`): a small frontier is
  broadcast and the edge table is streamed, never shuffled; a large one falls back to a
  sort-merge join with AQE skew splitting;
* a frontier of at most ``KEY_LIST_LIMIT`` vertices also pushes its keys into the edge scan,
  which reads the graph's adjacency copy clustered on the near endpoint when one exists
  (:func:`filmgraph.sources.graphstore.write_adjacency`), so only the row groups holding those
  keys are read.

Example - users who rated a movie that user 7 rated, with the number of such paths::

    Traversal.start(g, "USER", keys=[7]).out("RATED_AS").in_("RATED_AS").to_df()

Steps take one edge label, several, or none for all that touch the current vertices. Where they lead
to vertices of different labels the result is a :class:`Mixed` traversal. ``out_edges`` and its
relatives stop on the edges (:class:`Edges`), which can be filtered and left again at either end::

    Traversal.start(g, "USER", keys=[7]).out_edges("RATED_AS").has(F.col("score") >= 4).in_v()
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import sizing
from ..sources.graphstore import Graph

# Frontiers up to this many vertices are pushed into edge scans as IN lists (the session pushes
# IN lists of this size to Parquet, see filmgraph.session).
KEY_LIST_LIMIT = 100


class Traversal:
    def __init__(self, graph: Graph, label: str, frontier: DataFrame, bound: int | None = None):
        self.graph, self.label, self.frontier = graph, label, frontier
        self.bound = bound          # proven upper bound on frontier rows, None if unknown

    def _next(self, label: str, frontier: DataFrame, bound: int | None = None) -> "Traversal":
        return Traversal(self.graph, label, frontier, bound)

    def _sized_frontier(self) -> DataFrame:
        """The frontier for a join with a (large) table: broadcast when provably small."""
        sized = sizing.ensure_bound(sizing.Sized(self.frontier, self.bound))
        self.frontier, self.bound = sized.df, sized.rows
        return sizing.for_join(sized)

    # ------------------------------------------------------------ sources

    @classmethod
    def start(cls, graph: Graph, label: str, where: Column | None = None,
              keys: Iterable | DataFrame | None = None) -> "Traversal":
        """``V().hasLabel(label)`` optionally narrowed by a predicate and/or key values."""
        key = S.VERTICES[label].key
        v = graph.V(label)
        bound = None
        if where is not None:
            v = v.where(where)
        if isinstance(keys, DataFrame):
            side = sizing.for_join(sizing.Sized(
                keys.select(F.col(keys.columns[0]).alias(key)).distinct(), None))
            v = v.join(side, key)            # vertex keys are unique: no row multiplication
        elif keys is not None:
            keys = list(dict.fromkeys(keys))
            v = v.where(F.col(key).isin(keys))
            bound = len(keys)
        return cls(graph, label, v.select(F.col(key).alias("key"), F.lit(1).cast("bigint")
                                          .alias("bulk")), bound)

    # ------------------------------------------------------------ filters

    def has(self, where: Column) -> "Traversal":
        """Keep traversers whose vertex satisfies ``where`` (a predicate on its properties)."""
        key = S.VERTICES[self.label].key
        ok = self.graph.V(self.label).where(where).select(F.col(key).alias("key"))
        # inner join on the unique vertex key keeps the frontier rows whose vertex qualifies
        return self._next(self.label, ok.join(self._sized_frontier(), "key"), self.bound)

    def dedup(self) -> "Traversal":
        return self._next(self.label, self.frontier.withColumn("bulk", F.lit(1).cast("bigint")),
                          self.bound)

    # ------------------------------------------------------------ hops

    def _edges_near(self, edge_label: str, near: str, where: Column | None) -> DataFrame:
        """The edges touching the frontier on ``near``, read through the cheapest access path.

        A frontier of at most ``KEY_LIST_LIMIT`` vertices is collected (a proven small bound)
        and pushed into the scan as an ``IN`` filter; with an adjacency copy clustered on
        ``near`` only the row groups holding those keys are read.
        """
        direction = "out" if near == "src" else "in"
        e = self.graph.adjacency.get((edge_label, direction), self.graph.E(edge_label))
        if where is not None:
            e = e.where(where)
        self._sized_frontier()
        if self.bound is not None and self.bound <= KEY_LIST_LIMIT:
            keys = [r["key"] for r in self.frontier.select("key").collect()]
            e = e.where(F.col(near).isin(keys))
        return e

    def _hop(self, edge_label: str, near: str, far: str, where: Column | None) -> DataFrame:
        e = self._edges_near(edge_label, near, where)
        joined = e.select(F.col(near).alias("key"), F.col(far).alias("_far")).join(
            self._sized_frontier(), "key")
        return joined.select(F.col("_far").alias("key"), "bulk")

    @staticmethod
    def _collapse(df: DataFrame) -> DataFrame:
        return df.groupBy("key").agg(F.sum("bulk").cast("bigint").alias("bulk"))

    def _labels(self, end: str, edge_labels: tuple[str, ...]) -> list[str]:
        """The edge labels of a step: those given, else all stored ones that touch the label."""
        if edge_labels:
            return list(edge_labels)
        return [x for x in self.graph.edges if getattr(S.EDGES[x], end) == self.label]

    def _step(self, edge_label: str, near: str, where: Column | None, step: str) -> "Traversal":
        spec = S.EDGES[edge_label]
        far = "dst" if near == "src" else "src"
        self._expect(getattr(spec, near), edge_label, step)
        return self._next(getattr(spec, far), self._collapse(
            self._hop(edge_label, near, far, where)))

    def out(self, *edge_labels, where: Column | None = None) -> "Traversal | Mixed":
        """Follow edges forward (src -> dst); a Column among the arguments filters the edges."""
        labels, where = _arguments(edge_labels, where)
        return merged([self._step(x, "src", where, "out") for x in self._labels("src", labels)])

    def in_(self, *edge_labels, where: Column | None = None) -> "Traversal | Mixed":
        """Follow edges backward (dst -> src)."""
        labels, where = _arguments(edge_labels, where)
        return merged([self._step(x, "dst", where, "in") for x in self._labels("dst", labels)])

    def both(self, *edge_labels, where: Column | None = None) -> "Traversal | Mixed":
        """Follow edges in whichever directions touch the current label."""
        labels, where = _arguments(edge_labels, where)
        steps = []
        for x in labels or list(self.graph.edges):
            ends = [near for near in ("src", "dst") if getattr(S.EDGES[x], near) == self.label]
            if not ends and labels:
                self._expect(S.EDGES[x].src, x, "both")
            steps += [self._step(x, near, where, "both") for near in ends]
        return merged(steps)

    def _edge_step(self, edge_label: str, near: str, where: Column | None, step: str) -> "Edges":
        self._expect(getattr(S.EDGES[edge_label], near), edge_label, step)
        e = self._edges_near(edge_label, near, where)
        held = e.join(self._sized_frontier().withColumnRenamed("key", near), near)
        return Edges(self.graph, edge_label, held)

    def _edge_steps(self, ends: tuple[str, ...], args: tuple, where: Column | None,
                    step: str) -> "Edges | MixedEdges":
        labels, where = _arguments(args, where)
        found: dict[str, Edges] = {}
        for x in labels or list(self.graph.edges):
            for near in [n for n in ends if getattr(S.EDGES[x], n) == self.label] or (
                    ends[:1] if labels else ()):
                own = self._edge_step(x, near, where, step)
                found[x] = own if x not in found else Edges(
                    self.graph, x, found[x].edges.unionByName(own.edges))
        if not found:
            raise ValueError("no edge label touches the current vertices")
        return next(iter(found.values())) if len(found) == 1 else MixedEdges(found)

    def out_edges(self, *edge_labels, where: Column | None = None) -> "Edges | MixedEdges":
        """``outE`` as a traversal: the edges of one label, several or all that leave the frontier."""
        return self._edge_steps(("src",), edge_labels, where, "outE")

    def in_edges(self, *edge_labels, where: Column | None = None) -> "Edges | MixedEdges":
        """``inE`` as a traversal: the edges of one label, several or all that enter the frontier."""
        return self._edge_steps(("dst",), edge_labels, where, "inE")

    def both_edges(self, *edge_labels, where: Column | None = None) -> "Edges | MixedEdges":
        """``bothE`` as a traversal: the edges touching the frontier at either end."""
        return self._edge_steps(("src", "dst"), edge_labels, where, "bothE")

    def out_e(self, *edge_labels, where: Column | None = None) -> DataFrame:
        """``outE``: the edges leaving the frontier, with the traverser bulk, as a table."""
        return self.out_edges(*edge_labels, where=where).to_df()

    def in_e(self, *edge_labels, where: Column | None = None) -> DataFrame:
        """``inE``: the edges entering the frontier, with the traverser bulk, as a table."""
        return self.in_edges(*edge_labels, where=where).to_df()

    def _expect(self, label: str, edge_label: str, step: str) -> None:
        if label != self.label:
            raise ValueError(f"{step}({edge_label}) needs {label} vertices, traversal is at "
                             f"{self.label}")

    # ------------------------------------------------------------ results

    def to_df(self) -> DataFrame:
        """``key, bulk`` of the current vertices."""
        return self.frontier

    def values(self, *props: str) -> DataFrame:
        """The current vertices' properties, with ``bulk``."""
        key = S.VERTICES[self.label].key
        v = self.graph.V(self.label).select(key, *[p for p in props if p != key])
        return v.withColumnRenamed(key, "key").join(self._sized_frontier(), "key") \
            .withColumnRenamed("key", key)

    def top(self, n: int) -> DataFrame:
        """``order().by(bulk, desc).limit(n)``: the ``n`` most-reached vertices, ties by key.

        Runs as a per-partition top-n followed by one merge of ``n`` rows per partition.
        """
        return self.frontier.orderBy(F.col("bulk").desc(), F.col("key").asc()).limit(n)

    def count(self) -> DataFrame:
        """Number of traversers (sum of bulk) as a one-row DataFrame."""
        return self.frontier.agg(F.coalesce(F.sum("bulk"), F.lit(0)).cast("bigint")
                                 .alias("count"))


def _arguments(args: tuple, where: Column | None) -> tuple[tuple[str, ...], Column | None]:
    """Edge labels and edge filter of a step (the filter may stand among the labels)."""
    columns = [a for a in args if isinstance(a, Column)]
    if len(columns) + (where is not None) > 1:
        raise ValueError("a step takes one edge filter")
    return tuple(a for a in args if not isinstance(a, Column)), columns[0] if columns else where


def merged(steps: list[Traversal]) -> "Traversal | Mixed":
    """Traversals united by label: paths that meet in a vertex add up."""
    if not steps:
        raise ValueError("no edge label touches the current vertices")
    by_label: dict[str, list[Traversal]] = {}
    for t in steps:
        by_label.setdefault(t.label, []).append(t)
    parts = {}
    for label, same in by_label.items():
        rows = same[0].frontier
        for t in same[1:]:
            rows = rows.unionByName(t.frontier)
        parts[label] = same[0] if len(same) == 1 else Traversal(
            same[0].graph, label, Traversal._collapse(rows))
    return next(iter(parts.values())) if len(parts) == 1 else Mixed(parts)


class Mixed:
    """Current vertices of several labels, one :class:`Traversal` each."""

    def __init__(self, parts: dict[str, Traversal]):
        self.parts = parts

    def has_label(self, label: str) -> Traversal:
        if label not in self.parts:
            raise KeyError(f"no {label} vertices here; have {sorted(self.parts)}")
        return self.parts[label]

    def _each(self, step: str, args: tuple, where: Column | None) -> "Traversal | Mixed":
        labels, where = _arguments(args, where)
        out = []
        for t in self.parts.values():
            ends = {"out": ("src",), "in_": ("dst",), "both": ("src", "dst")}[step]
            own = [x for x in labels or t.graph.edges
                   if any(getattr(S.EDGES[x], e) == t.label for e in ends)]
            if own:
                result = getattr(t, step)(*own, where=where)
                out += list(result.parts.values()) if isinstance(result, Mixed) else [result]
        return merged(out)

    def out(self, *edge_labels, where: Column | None = None) -> "Traversal | Mixed":
        return self._each("out", edge_labels, where)

    def in_(self, *edge_labels, where: Column | None = None) -> "Traversal | Mixed":
        return self._each("in_", edge_labels, where)

    def both(self, *edge_labels, where: Column | None = None) -> "Traversal | Mixed":
        return self._each("both", edge_labels, where)

    def dedup(self) -> "Mixed":
        return Mixed({label: t.dedup() for label, t in self.parts.items()})

    def to_df(self) -> DataFrame:
        """``label, key, bulk`` of the current vertices, keys as text."""
        rows = None
        for label, t in self.parts.items():
            part = t.to_df().select(F.lit(label).alias("label"),
                                    F.col("key").cast("string").alias("key"), "bulk")
            rows = part if rows is None else rows.unionByName(part)
        return rows

    def count(self) -> DataFrame:
        return self.to_df().agg(F.coalesce(F.sum("bulk"), F.lit(0)).cast("bigint").alias("count"))


class Edges:
    """Current edges of one label: their columns and ``bulk``, the paths that reach each."""

    def __init__(self, graph: Graph, label: str, edges: DataFrame):
        self.graph, self.label, self.edges = graph, label, edges

    @classmethod
    def by_id(cls, graph: Graph, label: str, ids) -> "Edges":
        """``E(id)``: a traversal that starts on the edges with these ids."""
        from .search import edges_by_id

        return cls(graph, label, edges_by_id(graph, label, ids).withColumn(
            "bulk", F.lit(1).cast("bigint")))

    def has(self, where: Column) -> "Edges":
        """Keep the edges that satisfy ``where`` (a predicate on their properties)."""
        return Edges(self.graph, self.label, self.edges.where(where))

    def _at(self, end: str) -> Traversal:
        rows = self.edges.select(F.col(end).alias("key"), "bulk")
        return Traversal(self.graph, getattr(S.EDGES[self.label], end), Traversal._collapse(rows))

    def out_v(self) -> Traversal:
        """The vertices the edges start from."""
        return self._at("src")

    def in_v(self) -> Traversal:
        """The vertices the edges lead to."""
        return self._at("dst")

    def to_df(self) -> DataFrame:
        return self.edges

    def count(self) -> DataFrame:
        return self.edges.agg(F.coalesce(F.sum("bulk"), F.lit(0)).cast("bigint").alias("count"))


class MixedEdges:
    """Current edges of several labels, one :class:`Edges` each."""

    def __init__(self, parts: dict[str, Edges]):
        self.parts = parts

    def has_label(self, label: str) -> Edges:
        if label not in self.parts:
            raise KeyError(f"no {label} edges here; have {sorted(self.parts)}")
        return self.parts[label]

    def has(self, prop: str, where: Column) -> "MixedEdges":
        """Keep the edges that have the property and satisfy ``where``."""
        return MixedEdges({label: e.has(where) for label, e in self.parts.items()
                           if prop in S.EDGES[label].schema.fieldNames()})

    def out_v(self) -> "Traversal | Mixed":
        return merged([e.out_v() for e in self.parts.values()])

    def in_v(self) -> "Traversal | Mixed":
        return merged([e.in_v() for e in self.parts.values()])

    def to_df(self) -> DataFrame:
        """``label, src, dst, bulk`` of the current edges, endpoints as text."""
        rows = None
        for label, e in self.parts.items():
            part = e.to_df().select(F.lit(label).alias("label"), *[
                F.col(c).cast("string").alias(c) for c in ("src", "dst")], "bulk")
            rows = part if rows is None else rows.unionByName(part)
        return rows

    def count(self) -> DataFrame:
        return self.to_df().agg(F.coalesce(F.sum("bulk"), F.lit(0)).cast("bigint").alias("count"))


def degrees(graph: Graph, edge_label: str, direction: str = "out") -> DataFrame:
    """Edge count per vertex: ``key, degree`` (``out`` counts by src, ``in`` by dst)."""
    side = "src" if direction == "out" else "dst"
    return (graph.E(edge_label).groupBy(F.col(side).alias("key"))
            .agg(F.count(F.lit(1)).alias("degree")))
