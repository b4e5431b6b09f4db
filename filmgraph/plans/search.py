"""The query surface of the declared indexes (Q1-Q9), as DataFrame operations.

Each unique or exact-match index becomes an equality filter that Catalyst pushes into the Parquet
scan (row groups are sorted by the index columns when written); a list of keys becomes an ``IN``
set and a DataFrame of keys a join with its distinct values (broadcast when their counted size
is small, see :mod:`filmgraph.operators.sizing`). Range and text
search are conjunctions of the predicates in :mod:`filmgraph.functions.search`.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import grams
from ..functions import search as P
from ..operators import edge_ids, sizing
from ..sources.graphstore import ALL, CURVES, GRAM, TEXT_INDEXES, Graph, prop_is_set


def _all(predicates: Iterable[Column]) -> Column:
    preds = list(predicates)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


class Property:
    """Typed predicates on one property: literals are converted to its declared type.

    Example: ``search_movies(g, Property("MOVIE", "movieImdbScore").within([8.7, 8.3]))``
    """

    def __init__(self, label: str, name: str):
        self.name = name
        self.dtype = (S.VERTICES.get(label) or S.EDGES[label]).type_of(name)

    def equal(self, value) -> Column:
        return P.equal(self.name, value, self.dtype)

    def between(self, low, high) -> Column:
        return P.between(self.name, low, high, self.dtype)

    def inside(self, low, high) -> Column:
        return P.inside(self.name, low, high, self.dtype)

    def outside(self, low, high) -> Column:
        return P.outside(self.name, low, high, self.dtype)

    def within(self, values: Iterable) -> Column:
        return P.within(self.name, values, self.dtype)

    def without(self, values: Iterable) -> Column:
        return P.without(self.name, values, self.dtype)


# Value lists up to this length become an IN filter; longer ones a join with the distinct values.
VALUE_LIST_LIMIT = 100


def lookup(graph: Graph, label: str, prop: str, values) -> DataFrame:
    """Q1/Q2 (F4, T3): vertices of ``label`` whose ``prop`` equals a value (or any of several).

    ``values`` is one value, an iterable of values, or a DataFrame whose first column holds them.
    """
    spec = S.VERTICES[label]
    if prop not in dict(spec.properties):
        raise KeyError(f"{label} has no property {prop!r}")
    v = graph.V(label)
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).try_cast(spec.type_of(prop)).alias(prop))
        # distinct values, size-checked: broadcast when small, so the vertex table is streamed
        side = sizing.for_join(sizing.Sized(keys.where(F.col(prop).isNotNull()).distinct(), None))
        return v.join(side, prop)
    if isinstance(values, (str, bytes)) or not isinstance(values, Iterable):
        return v.where(F.col(prop) == F.lit(values).cast(spec.type_of(prop)))
    values = list(dict.fromkeys(values))
    if len(values) > VALUE_LIST_LIMIT:
        rows = v.sparkSession.createDataFrame([(x,) for x in values if x is not None], ["value"])
        return lookup(graph, label, prop, rows)
    return v.where(Property(label, prop).within(values))


def movies_with_genre(graph: Graph, genre: str) -> DataFrame:
    """Q3: movies whose genre SET contains ``genre``.

    A stored graph answers from the edges clustered by genre; without them all movies are read.
    """
    edges = graph.adjacency.get(("CATEGORIZED_AS", "in"))
    if edges is None:
        return graph.V("MOVIE").where(F.array_contains("movieGenres", genre))
    keys = edges.where(F.col("dst") == genre).select(F.col("src").alias("movieId"))
    return _vertices(graph, "MOVIE", keys)


def movies_with_title_token(graph: Graph, word: str | None = None, prefix: str | None = None,
                            pattern: str | None = None) -> DataFrame:
    """Q6: movies with a title token equal to ``word``, starting with ``prefix`` or fully matching
    ``pattern`` (give one). Answered from the postings of a stored graph where there are some."""
    return text_search(graph, "MOVIE", "movieTitle", word=word, word_prefix=prefix,
                       word_regex=pattern)


# A text search whose rarest piece is held by more than one in so many values reads the whole table, and
# one looks up no more than so many of its pieces.
USEFUL_SHARE, PIECES = 5, 4


def text_search(graph: Graph, label: str, prop: str, *, word: str | None = None,
                word_prefix: str | None = None, word_regex: str | None = None,
                contains: str | None = None, starts_with: str | None = None,
                regex: str | None = None) -> DataFrame:
    """Q6/Q7: vertices whose text property - for a set, some element - has a token equal to ``word``, with
    ``word_prefix`` or matching ``word_regex``, or ``contains`` a string, ``starts_with`` one or matches
    ``regex`` as a whole (give one).

    A stored graph answers from its postings: token searches read the tokens, the others look up the
    three-character runs that a value must hold, rarest first, and check what is left. Without postings, or
    if no such run follows from the search, the vertices are read.
    """
    given = {name: value for name, value in (
        ("word", word), ("word_prefix", word_prefix), ("word_regex", word_regex),
        ("contains", contains), ("starts_with", starts_with), ("regex", regex)) if value is not None}
    if len(given) != 1:
        raise ValueError("give one search")
    (kind, value), = given.items()
    test = {"word": P.text_contains, "word_prefix": P.text_contains_prefix,
            "word_regex": P.text_contains_regex, "contains": P.text_substring,
            "starts_with": P.text_prefix, "regex": P.text_regex}[kind]
    if prop not in dict(S.VERTICES[label].properties):
        raise KeyError(f"{label} has no property {prop!r}")
    where = test(prop, value, is_set=True) if prop_is_set(label, prop) else test(prop, value)
    if kind.startswith("word"):
        tokens = graph.tokens.get((label, prop))
        if tokens is None:
            return graph.V(label).where(where)
        token = F.col("token")
        hit = {"word": lambda: token == value.lower(),
               "word_prefix": lambda: token.startswith(value.lower()),
               "word_regex": lambda: token.rlike(rf"\A(?:{value})\z")}[kind]()
        return _vertices(graph, label, tokens.where(hit).select(S.VERTICES[label].key))
    needed = {"contains": grams.of_substring, "starts_with": grams.of_prefix,
              "regex": grams.of_regex}[kind](value)
    keys = _with_grams(graph, label, prop, needed)
    rows = graph.V(label) if keys is None else _vertices(graph, label, keys)
    return rows.where(where)


def _with_grams(graph: Graph, label: str, prop: str, needed: list[set[str]] | None):
    """Keys of the vertices that hold, in one of the alternatives, the rarest of the runs it needs; None if
    reading all vertices is as good."""
    if needed is None or label not in graph.postings or prop not in TEXT_INDEXES[label]:
        return None
    key = S.VERTICES[label].key
    every = sorted(set().union(*needed))
    counts = graph.counts[label].where((F.col("property") == prop) & (
        ((F.col("kind") == GRAM) & F.col("piece").isin(every)) | (F.col("kind") == ALL)))
    held = {(r["kind"], r["piece"]): r["n"] for r in counts.collect()}    # one row per run at most
    total = held.get((ALL, ""), 0)
    rows = None
    for alternative in needed:
        sizes = sorted((held.get((GRAM, x), 0), x) for x in alternative)
        if sizes[0][0] == 0:
            continue                  # nothing holds all of it
        if sizes[0][0] * USEFUL_SHARE > total:
            return None
        rarest = [x for _, x in sizes[:PIECES]]
        own = graph.postings[label].where((F.col("property") == prop) & (F.col("kind") == GRAM)
                                          & F.col("piece").isin(rarest))
        # a vertex has a row for each piece at most
        own = own.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(
            F.col("_n") == len(rarest)).select(key)
        rows = own if rows is None else rows.unionByName(own)
    return rows if rows is not None else graph.V(label).select(key).limit(0)


def _vertices(graph: Graph, label: str, keys: DataFrame) -> DataFrame:
    """Vertices of the given keys: few keys are pushed into the scan, which then opens the files of their
    ranges; more are a size-checked join."""
    key = S.VERTICES[label].key
    side = sizing.materialize(keys.distinct())
    rows = graph.V(label)
    if side.rows <= VALUE_LIST_LIMIT:
        return rows.where(F.col(key).isin([r[key] for r in side.df.collect()]))
    return rows.join(sizing.for_join(side), key, "left_semi")


def search_movies(graph: Graph, *predicates: Column) -> DataFrame:
    """Q5/Q6: movies matching every predicate (ranges, equality, text).

    Searches that name a property of the curve copy read that copy, whose files cover narrow ranges of all
    its properties, so several ranges at once leave few of them.
    """
    copy = graph.curves.get("MOVIE")
    named = copy is not None and any(re.search(rf"\b{prop}\b", str(p))
                                     for p in predicates for prop in CURVES["MOVIE"])
    return (copy if named else graph.V("MOVIE")).where(_all(predicates))


def search_tags(graph: Graph, *predicates: Column) -> DataFrame:
    """Q7: tags matching every predicate (id ranges, name text)."""
    return graph.V("TAG").where(_all(predicates))


def ratings_with_score(graph: Graph, score: float) -> DataFrame:
    """Q4: RATED_AS edges with exactly this score."""
    return graph.E("RATED_AS").where(F.col("score") == F.lit(score).cast("float"))


def ratings_in_range(graph: Graph, score: tuple[float, float] | None = None,
                     time: tuple[int, int] | None = None) -> DataFrame:
    """Q8: RATED_AS edges with ``low <= score <= high`` and ``start <= timestamp < end``."""
    preds = []
    if score is not None:
        preds.append(F.col("score").between(F.lit(score[0]).cast("float"),
                                            F.lit(score[1]).cast("float")))
    if time is not None:
        preds += [F.col("timestamp") >= time[0], F.col("timestamp") < time[1]]
    return graph.E("RATED_AS").where(_all(preds))


def edges_by_id(graph: Graph, label: str, ids) -> DataFrame:
    """T2 ``E(id)``: the edges of ``label`` with the given ids (one, several, or the first column of a
    DataFrame), as ``edge_id`` and the edge's columns. Ids that name no edge give no row.

    Few ids reach the scan of the stored id index, which opens the files that hold them.
    """
    spark = graph.E(label).sparkSession
    if isinstance(ids, str):
        ids = [ids]
    rows = ids if isinstance(ids, DataFrame) else edge_ids.as_rows(spark, ids)
    wanted = sizing.materialize(edge_ids.parsed(rows, label))
    held = graph.contents(label)
    if wanted.rows <= VALUE_LIST_LIMIT:
        hashes = sorted({r[edge_ids.HASH] for r in wanted.df.collect()})
        held = held.where(F.col(edge_ids.HASH).isin(hashes))
    else:
        side = sizing.Sized(wanted.df.select(edge_ids.HASH).distinct(), wanted.rows, wanted.width)
        held = held.join(sizing.for_join(side), edge_ids.HASH, "left_semi")
    return edge_ids.found(sizing.for_join(wanted), held, label)


def relevant_tags(graph: Graph, min_relevance: float) -> DataFrame:
    """Q9: ESTIMATED_AT edges with relevance at least ``min_relevance``."""
    return graph.E("ESTIMATED_AT").where(F.col("relevance") >= F.lit(min_relevance).cast("float"))
