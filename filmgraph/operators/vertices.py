"""Vertex builders (P4, VX1-VX10): input rows -> one keyed table per vertex label.

Distinct keys come from ``distinct()`` (partial aggregation on each map task, so a genre or a
country shared by a third of all movies costs one row per task before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text


def parse_movies(movies: DataFrame) -> DataFrame:
    """Movie rows -> movieId, title, year (bigint or null), genres (list, duplicates kept)."""
    title, year = text.parse_title_and_year("title")
    return movies.select(
        F.col("movieId").cast("bigint").alias("movieId"),
        title.alias("title"),
        year.cast("bigint").alias("year"),
        text.parse_genres("genres").alias("genres"))


def conform_vertices(df: DataFrame, label: str) -> DataFrame:
    """V3: the label's full property schema; properties not present are typed nulls."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in S.VERTICES[label].schema.fields])


def movie_vertices(parsed: DataFrame) -> DataFrame:
    """VX1: MOVIE with id, title, year and the genre SET (V4: each genre once, first order)."""
    return conform_vertices(parsed.select(
        "movieId",
        F.col("title").alias("movieTitle"),
        F.col("year").alias("movieYear"),
        F.array_distinct("genres").alias("movieGenres")), "MOVIE")


def year_vertices(parsed: DataFrame) -> DataFrame:
    """VX2 (G1, A1): one YEAR per distinct non-null year."""
    return (parsed.where(F.col("year").isNotNull())
            .select(F.col("year").alias("yearNumber")).distinct())


def genre_vertices(parsed: DataFrame) -> DataFrame:
    """VX3 (G2, A1): one GENRE per distinct genre name."""
    return parsed.select(F.explode("genres").alias("genreName")).distinct()


def user_vertices(ratings: DataFrame) -> DataFrame:
    """VX4 (P10, A2): one USER per distinct rating author."""
    return ratings.select(F.col("userId").cast("bigint").alias("userId")).distinct()


def tag_vertices(tags: DataFrame) -> DataFrame:
    """VX5: one TAG per input row (the unique checks catch a repeated id or name)."""
    return tags.select(F.col("tagId").cast("bigint").alias("tagId"),
                       F.col("tag").alias("tagName"))


# Credit list of the parsed API record feeding each name-keyed vertex label.
CREDIT_SOURCES = {
    "DIRECTOR": "directors",
    "WRITER": "writers",
    "ACTOR": "actors",
    "LANGUAGE": "languages",
    "COUNTRY": "countries",
}


def name_vertices(credits: DataFrame, label: str) -> DataFrame:
    """VX6-VX10 (G3, P6): one vertex per distinct *parsed* name of a credit kind.

    ``credits`` is the exploded credit table (:func:`filmgraph.operators.edges.credit_items`);
    ``"Pete Docter (original story by)"`` and ``"Pete Docter (screenplay by)"`` are one WRITER.
    """
    key = S.VERTICES[label].key
    return (credits.where(F.col("kind") == CREDIT_SOURCES[label])
            .select(F.col("name").alias(key)).distinct())
