"""MOVIE property upserts.

Both are 1:1 left joins on the movie key (the inputs are unique per movie after the V1 checks),
so they can neither multiply rows nor skew; Catalyst/AQE pick broadcast or sort-merge from the
measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.dataset import ERROR_COL, RAW_COL
from .vertices import conform_vertices

# MOVIE property <- parsed record field, set only when the record has a value.
RECORD_PROPERTIES = {
    "movieRated": "rated",
    "movieBoxOffice": "boxOffice",
    "movieMetascore": "metascore",
    "movieImdbScore": "imdbScore",
    "movieImdbVotes": "imdbVotes",
}


def convert_links(links: DataFrame) -> DataFrame:
    """Links with numeric keys: ``movieId, imdbId, tmdbId`` and ``_error`` for a movie id that is
    missing or not a number, or a tmdb id that is not a number (the text stays in ``_raw``)."""
    movie, tmdb = F.col("movieId").try_cast("bigint"), F.col("tmdbId").try_cast("bigint")
    problems = F.concat_ws("; ", F.when(movie.isNull(), "bad movieId"),
                           F.when(tmdb.isNull() & F.col("tmdbId").isNotNull(), "bad tmdbId"))
    error = F.nullif(problems, F.lit(""))
    return links.select(movie.alias("movieId"), "imdbId", tmdb.alias("tmdbId"),
                        error.alias(ERROR_COL),
                        F.when(error.isNotNull(), F.to_json(F.struct("movieId", "imdbId", "tmdbId")))
                        .alias(RAW_COL))


def enrich_movies(movies: DataFrame, recs: DataFrame | None = None,
                  links: DataFrame | None = None) -> DataFrame:
    """Properties from parsed API records; U2: ``movieTmdbId`` from the links table.

    A record always sets ``movieImdbId``; its other properties overwrite the stored value only
    when present (an absent value keeps the old one). Movies without a record are unchanged.
    ``links`` are converted (:func:`convert_links`) and unique per movie.
    """
    out = movies
    if recs is not None:
        r = recs.select(F.col("movieId").alias("_rid"), F.col("imdbId").alias("_imdbId"),
                        *[F.col(src).alias("_" + src) for src in RECORD_PROPERTIES.values()])
        joined = out.join(r, out["movieId"] == r["_rid"], "left")
        has_record = F.col("_rid").isNotNull()
        updates = {"movieImdbId": F.when(has_record, F.col("_imdbId"))
                   .otherwise(F.col("movieImdbId"))}
        for prop, src in RECORD_PROPERTIES.items():
            updates[prop] = F.coalesce(F.col("_" + src), F.col(prop))
        out = joined.withColumns(updates).drop("_rid", "_imdbId",
                                               *["_" + s for s in RECORD_PROPERTIES.values()])
    if links is not None:
        lk = links.select(F.col("movieId").alias("_lid"), F.col("tmdbId").alias("_tmdb"))
        joined = out.join(lk, out["movieId"] == lk["_lid"], "left")
        out = joined.withColumn("movieTmdbId", F.coalesce("_tmdb", "movieTmdbId")) \
            .drop("_lid", "_tmdb")
    return conform_vertices(out, "MOVIE")
