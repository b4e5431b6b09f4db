"""Input tables -> graph tables, as lazy DataFrames.

Each ``*_tables`` function returns the vertex and edge DataFrames one source file contributes;
:mod:`filmgraph.plans.load` stages and writes them, the registered queries use them directly.
Integrity modes (``"fail"`` / ``"quarantine"``) are those of
:mod:`filmgraph.operators.integrity`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators import edges as E
from ..operators import enrich, integrity, responses, sizing
from ..operators import vertices as V
from ..sources import dataset
from ..sources.graphstore import Graph


@dataclass
class Tables:
    vertices: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, DataFrame] = field(default_factory=dict)
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    extra: dict[str, DataFrame] = field(default_factory=dict)

    def into(self, graph: Graph) -> Graph:
        graph.vertices.update(self.vertices)
        graph.edges.update(self.edges)
        return graph


def movie_tables(movies: DataFrame, mode: str = "fail") -> Tables:
    """MOVIE, YEAR, GENRE, RELEASED_IN, CATEGORIZED_AS from movie rows."""
    parsed = V.parse_movies(movies)
    checked = integrity.enforce_unique(parsed, "movieId", mode, "MOVIE")
    parsed = checked.accepted
    return Tables(
        vertices={"MOVIE": V.movie_vertices(parsed), "YEAR": V.year_vertices(parsed),
                  "GENRE": V.genre_vertices(parsed)},
        edges={"RELEASED_IN": E.released_in_edges(parsed),
               "CATEGORIZED_AS": E.categorized_as_edges(parsed)},
        rejected={"MOVIE": checked.rejected},
        extra={"parsed_movies": parsed})


def rating_tables(ratings: DataFrame, movies: DataFrame, mode: str = "fail") -> Tables:
    """USER and RATED_AS from rating rows; every rated movie must exist."""
    checked = integrity.enforce_references(
        E.rated_as_edges(ratings), [("dst", movies, "movieId")], mode, "RATED_AS")
    return Tables(vertices={"USER": V.user_vertices(ratings)},
                  edges={"RATED_AS": checked.accepted},
                  rejected={"RATED_AS": checked.rejected})


def genome_tables(tags: DataFrame, scores: DataFrame, movies: DataFrame,
                  mode: str = "fail") -> Tables:
    """TAG and ESTIMATED_AT; tag ids/names unique, both endpoints must exist."""
    tag_check = integrity.enforce_unique(V.tag_vertices(tags), ["tagId", "tagName"], mode, "TAG")
    tag_v = tag_check.accepted
    edge_check = integrity.enforce_references(
        E.estimated_at_edges(scores), [("src", tag_v, "tagId"), ("dst", movies, "movieId")],
        mode, "ESTIMATED_AT")
    return Tables(vertices={"TAG": tag_v}, edges={"ESTIMATED_AT": edge_check.accepted},
                  rejected={"TAG": tag_check.rejected, "ESTIMATED_AT": edge_check.rejected})


def omdb_tables(answers: DataFrame, movies: DataFrame, links: DataFrame | None = None,
                mode: str = "fail", classified: DataFrame | None = None,
                stage: Callable[[DataFrame, str], DataFrame] | None = None,
                malformed: int | None = None) -> Tables:
    """Enriched MOVIE plus the five credit labels and their edges.

    ``classified`` may be passed when the caller has already classified and staged the answers;
    otherwise they are classified and checkpointed here, so the checks and the ten credit tables
    read parsed rows instead of parsing the JSON again. ``stage(df, name)`` (optional)
    materialises the exploded credit table that the ten credit tables are read from.
    ``malformed`` is the number of malformed answers when the caller already counted them.
    """
    if classified is None:
        classified = sizing.checkpoint(responses.classify(answers))
    if mode == "fail" and malformed != 0:
        bad = responses.rejects(classified).limit(integrity.SAMPLE).collect()
        if bad:
            shown = ", ".join(f"{r['movieId']!r}: {str(r['response'])[:60]!r}" for r in bad)
            raise integrity.IntegrityError(f"malformed API answers: {shown}")
    recs = responses.records(classified)
    unique = integrity.enforce_unique(recs, "movieId", mode, "OMDB record")
    refs = integrity.enforce_references(
        unique.accepted, [("movieId", movies, "movieId")], mode, "OMDB record")
    recs = refs.accepted
    ids = integrity.enforce_unique(recs, "imdbId", mode, "OMDB record", nulls_allowed=True)
    recs = ids.accepted
    link_rows = None
    rejected = {"omdb_malformed": responses.rejects(classified),
                "omdb_duplicates": unique.rejected, "omdb_dangling": refs.rejected,
                "omdb_imdb_duplicates": ids.rejected}
    if links is not None:
        checked = check_links(links, movies, mode)
        link_rows = checked.accepted
        rejected["links_rejected"] = checked.rejected
    enriched = enrich.enrich_movies(movies, recs, link_rows)
    if stage is not None:
        enriched = stage(enriched, "movie_enriched")
    # values that stay from earlier loads can still clash with the new ones
    integrity.enforce_unique(enriched, ["movieImdbId", "movieTmdbId"], "fail", "MOVIE",
                             nulls_allowed=True)
    t = Tables(vertices={"MOVIE": enriched},
               rejected=rejected, extra={"records": recs, "classified": classified})
    credits = E.credit_items(recs)
    if stage is not None:
        credits = stage(credits, "omdb_credits")
    t.extra["credits"] = credits
    for edge_label, vertex_label in E.CREDIT_EDGES.items():
        t.vertices[vertex_label] = V.name_vertices(credits, vertex_label)
        t.edges[edge_label] = E.credit_edges(credits, edge_label)
    return t


def check_links(links: DataFrame, movies: DataFrame, mode: str = "fail") -> integrity.Checked:
    """Converted links (U2) that pass all checks: numeric ids, one link per movie, one movie per tmdb
    id, and a movie that exists. Rejects keep the row with its reason."""
    converted = enrich.convert_links(links)
    good = dataset.accepted(converted)
    bad = dataset.rejected(converted)
    if mode == "fail":
        found = bad.limit(integrity.SAMPLE).collect()
        if found:
            raise integrity.IntegrityError("links with bad ids: " + ", ".join(
                f"{r[dataset.RAW_COL]} ({r[dataset.ERROR_COL]})" for r in found))
    movie = integrity.enforce_unique(good, "movieId", mode, "link")
    refs = integrity.enforce_references(movie.accepted, [("movieId", movies, "movieId")], mode,
                                        "link")
    tmdb = integrity.enforce_unique(refs.accepted, "tmdbId", mode, "link", nulls_allowed=True)
    rejected = bad
    for part in (movie, refs, tmdb):
        rejected = rejected.unionByName(part.rejected, allowMissingColumns=True)
    return integrity.Checked(tmdb.accepted, rejected)


def build_graph(inputs: dict[str, DataFrame], mode: str = "fail") -> Graph:
    """Every table of the graph from the six inputs (no writes)."""
    g = Graph()
    mt = movie_tables(inputs["movies"], mode)
    mt.into(g)
    if "ratings" in inputs:
        rating_tables(inputs["ratings"], g.V("MOVIE"), mode).into(g)
    if "genome_tags" in inputs and "genome_scores" in inputs:
        genome_tables(inputs["genome_tags"], inputs["genome_scores"], g.V("MOVIE"), mode).into(g)
    if "omdb" in inputs:
        omdb_tables(inputs["omdb"], g.V("MOVIE"), inputs.get("links"), mode).into(g)
    return g
