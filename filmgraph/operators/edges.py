"""Edge builders (E1-E9). Edges are a multiset: nothing here de-duplicates.

Each builder is a projection (plus ``explode`` for list-valued sources); endpoint checks live in
:mod:`filmgraph.operators.integrity`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text
from .vertices import CREDIT_SOURCES


def conform_edges(df: DataFrame, label: str) -> DataFrame:
    """The label's edge schema: src, dst and the edge properties, typed."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name)
                      for f in S.EDGES[label].schema.fields])


def released_in_edges(parsed: DataFrame) -> DataFrame:
    """MOVIE -> YEAR for every movie with a year."""
    return conform_edges(parsed.where(F.col("year").isNotNull()).select(
        F.col("movieId").alias("src"), F.col("year").alias("dst")), "RELEASED_IN")


def categorized_as_edges(parsed: DataFrame) -> DataFrame:
    """MOVIE -> GENRE, one edge per listed genre (a genre listed twice gives two edges)."""
    return conform_edges(parsed.select(
        F.col("movieId").alias("src"), F.explode("genres").alias("dst")), "CATEGORIZED_AS")


def rated_as_edges(ratings: DataFrame) -> DataFrame:
    """E3 (P9): USER -> MOVIE with score (float) and timestamp (epoch seconds)."""
    return conform_edges(ratings.select(
        F.col("userId").alias("src"), F.col("movieId").alias("dst"),
        text.to_float("rating").alias("score"), F.col("timestamp")), "RATED_AS")


def estimated_at_edges(scores: DataFrame) -> DataFrame:
    """E4 (P9): TAG -> MOVIE with relevance (float)."""
    return conform_edges(scores.select(
        F.col("tagId").alias("src"), F.col("movieId").alias("dst"),
        text.to_float("relevance").alias("relevance")), "ESTIMATED_AT")


# Edge label built from each credit-list vertex label.
CREDIT_EDGES = {
    "DIRECTED_BY": "DIRECTOR",
    "WRITTEN_BY": "WRITER",
    "ACTED_BY": "ACTOR",
    "SPOKEN_IN": "LANGUAGE",
    "PRODUCED_IN": "COUNTRY",
}


def credit_items(records: DataFrame) -> DataFrame:
    """All credits of parsed records, one row each: ``movieId, kind, item, name, notes``.

    The five lists are stacked and exploded once and every item's name/notes parsed once; the
    ten credit labels and the entity counters are all filters and projections of this table.
    """
    kinds = list(CREDIT_SOURCES.values())
    stacked = records.select("movieId", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).alias("items")) for k in kinds])).alias("s"))
    items = stacked.select("movieId", F.col("s.kind").alias("kind"),
                           F.explode("s.items").alias("item"))
    with_parts = items.withColumn("_parts", text.name_parts("item"))
    name, notes = text.name_from_parts(F.col("item"), F.col("_parts"))
    return with_parts.select("movieId", "kind", "item", name.alias("name"), notes.alias("notes"))


def credit_edges(credits: DataFrame, label: str) -> DataFrame:
    """One edge per credit item, keyed by the parsed name, carrying the notes.

    DIRECTED_BY, WRITTEN_BY and ACTED_BY point from the movie; SPOKEN_IN and PRODUCED_IN point
    from the language / country to the movie.
    """
    spec = S.EDGES[label]
    items = credits.where(F.col("kind") == CREDIT_SOURCES[CREDIT_EDGES[label]])
    if spec.src == "MOVIE":
        ends = (F.col("movieId").alias("src"), F.col("name").alias("dst"))
    else:
        ends = (F.col("name").alias("src"), F.col("movieId").alias("dst"))
    return conform_edges(items.select(*ends, "notes"), label)
