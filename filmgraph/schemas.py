"""Declared input schemas and the property-graph catalog.

Inputs are read with declared types (no inference pass). The graph is one table per vertex label
and one per edge label; vertex tables are keyed by their natural key, edge tables carry the natural
keys of both endpoints in ``src`` / ``dst`` plus the edge properties.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LONG, STRING, FLOAT, DOUBLE = T.LongType(), T.StringType(), T.FloatType(), T.DoubleType()
STRINGS = T.ArrayType(STRING)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# ---------------------------------------------------------------- input records (file layout)

MOVIES = _struct(("movieId", LONG), ("title", STRING), ("genres", STRING))
RATINGS = _struct(("userId", LONG), ("movieId", LONG), ("rating", DOUBLE), ("timestamp", LONG))
GENOME_TAGS = _struct(("tagId", LONG), ("tag", STRING))
GENOME_SCORES = _struct(("movieId", LONG), ("tagId", LONG), ("relevance", DOUBLE))
# imdbId keeps its leading zeros, so every link column stays a string.
LINKS = _struct(("movieId", STRING), ("imdbId", STRING), ("tmdbId", STRING))
# One landed API answer per link: the raw JSON text, or null when nothing was fetched.
OMDB_RESPONSES = _struct(("movieId", STRING), ("imdbId", STRING), ("response", STRING))

# Parsed API answer (movieId already widened to the graph's key type).
MOVIE_OMDB = _struct(
    ("movieId", LONG), ("imdbId", STRING), ("tmdbId", STRING), ("rated", STRING),
    ("directors", STRINGS), ("writers", STRINGS), ("actors", STRINGS),
    ("languages", STRINGS), ("countries", STRINGS),
    ("boxOffice", FLOAT), ("metascore", FLOAT), ("imdbScore", FLOAT), ("imdbVotes", LONG),
)

# Fixed file names below one dataset root directory.
DATASET_FILES = {
    "movies": "movies.csv",
    "ratings": "ratings.csv",
    "genome_tags": "genome-tags.csv",
    "genome_scores": "genome-scores.csv",
    "links": "links.csv",
    "omdb": "omdb-json",
}

# ---------------------------------------------------------------- graph catalog


@dataclass(frozen=True)
class VertexLabel:
    name: str
    key: str
    properties: tuple[tuple[str, T.DataType], ...]
    unique: tuple[str, ...]                 # unique exact-match indexes
    indexed: tuple[str, ...] = ()           # non-unique exact-match indexes
    searchable: tuple[str, ...] = ()        # range / text search
    bloom: tuple[str, ...] = ()             # Parquet bloom filters for point lookups

    @property
    def schema(self) -> T.StructType:
        return _struct(*self.properties)

    def type_of(self, prop: str) -> T.DataType:
        return dict(self.properties)[prop]


@dataclass(frozen=True)
class EdgeLabel:
    name: str
    src: str                                # source vertex label
    dst: str                                # destination vertex label
    properties: tuple[tuple[str, T.DataType], ...] = ()
    indexed: tuple[str, ...] = ()
    searchable: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = field(default=("src",))

    @property
    def schema(self) -> T.StructType:
        src_type = VERTICES[self.src].type_of(VERTICES[self.src].key)
        dst_type = VERTICES[self.dst].type_of(VERTICES[self.dst].key)
        return _struct(("src", src_type), ("dst", dst_type), *self.properties)

    def type_of(self, prop: str) -> T.DataType:
        return self.schema[prop].dataType


def _named(label: str, prop: str) -> VertexLabel:
    return VertexLabel(label, prop, ((prop, STRING),), unique=(prop,))


VERTICES: dict[str, VertexLabel] = {v.name: v for v in [
    VertexLabel(
        "MOVIE", "movieId",
        (("movieId", LONG), ("movieImdbId", STRING), ("movieTmdbId", LONG), ("movieTitle", STRING),
         ("movieYear", LONG), ("movieGenres", STRINGS), ("movieRated", STRING),
         ("movieBoxOffice", FLOAT), ("movieMetascore", FLOAT), ("movieImdbScore", FLOAT),
         ("movieImdbVotes", LONG)),
        unique=("movieId", "movieImdbId", "movieTmdbId"),
        indexed=("movieTitle", "movieYear", "movieGenres", "movieRated"),
        searchable=("movieId", "movieTitle", "movieYear", "movieGenres", "movieImdbId",
                    "movieTmdbId", "movieRated", "movieBoxOffice", "movieMetascore",
                    "movieImdbScore", "movieImdbVotes"),
        bloom=("movieImdbId", "movieTmdbId", "movieTitle"),
    ),
    VertexLabel("YEAR", "yearNumber", (("yearNumber", LONG),), unique=("yearNumber",)),
    VertexLabel("GENRE", "genreName", (("genreName", STRING),), unique=("genreName",)),
    VertexLabel("TAG", "tagId", (("tagId", LONG), ("tagName", STRING)),
                unique=("tagId", "tagName"), searchable=("tagId", "tagName"), bloom=("tagName",)),
    VertexLabel("USER", "userId", (("userId", LONG),), unique=("userId",)),
    _named("DIRECTOR", "directorName"),
    _named("WRITER", "writerName"),
    _named("ACTOR", "actorName"),
    _named("LANGUAGE", "languageName"),
    _named("COUNTRY", "countryName"),
]}

_NOTES = (("notes", STRING),)

EDGES: dict[str, EdgeLabel] = {e.name: e for e in [
    EdgeLabel("RELEASED_IN", "MOVIE", "YEAR"),
    EdgeLabel("CATEGORIZED_AS", "MOVIE", "GENRE"),
    EdgeLabel("ESTIMATED_AT", "TAG", "MOVIE", (("relevance", FLOAT),),
              searchable=("relevance",), sort_by=("relevance",)),
    EdgeLabel("RATED_AS", "USER", "MOVIE", (("score", FLOAT), ("timestamp", LONG)),
              indexed=("score",), searchable=("score", "timestamp"),
              sort_by=("score", "timestamp")),
    EdgeLabel("DIRECTED_BY", "MOVIE", "DIRECTOR", _NOTES),
    EdgeLabel("WRITTEN_BY", "MOVIE", "WRITER", _NOTES),
    EdgeLabel("ACTED_BY", "MOVIE", "ACTOR", _NOTES),
    EdgeLabel("SPOKEN_IN", "LANGUAGE", "MOVIE", _NOTES),
    EdgeLabel("PRODUCED_IN", "COUNTRY", "MOVIE", _NOTES),
]}


def describe_graph(spark: SparkSession) -> DataFrame:
    """The catalog as a table: one row per (label, property) with its type and index kinds."""
    rows = []
    for v in VERTICES.values():
        for prop, dtype in v.properties:
            rows.append(("vertex", v.name, prop, dtype.simpleString(), prop == v.key,
                         prop in v.unique, prop in v.indexed, prop in v.searchable, None, None))
    for e in EDGES.values():
        for f in e.schema.fields:
            rows.append(("edge", e.name, f.name, f.dataType.simpleString(), False, False,
                         f.name in e.indexed, f.name in e.searchable, e.src, e.dst))
    schema = ("kind string, label string, property string, type string, is_key boolean, "
              "is_unique boolean, is_indexed boolean, is_searchable boolean, "
              "src_label string, dst_label string")
    return spark.createDataFrame(rows, schema)
