"""The load jobs: dataset folder -> stored graph.

``load_movies``, ``load_ratings``, ``load_genome``, ``fetch_omdb`` and ``load_omdb`` mirror the
original five batch jobs; ``load_all`` runs the four loads in order. Each job

1. reads its input once and writes it, typed, to ``<graph>/_staging/`` (cuts the lineage, so a lost
   executor costs a re-read of Parquet, not of CSV, and every derived table reads only the columns
   it needs);
2. builds the label tables with :mod:`filmgraph.plans.build` (integrity checks on distinct key
   sets, see :mod:`filmgraph.operators.integrity`);
3. writes every table as its next version and then makes them current together - re-running a job
   replaces its tables instead of appending duplicates, and a job that stops half-way leaves all
   tables as they were (see :func:`filmgraph.sources.graphstore.load_job`). Text indexes and copies
   belong to the job that writes the table behind them. Quarantined rows go to ``<graph>/_quarantine/<name>``;
   staged inputs are deleted when the job has succeeded.

Run from the command line::

    python -m filmgraph.plans.load movies <dataset_root> <graph_root>
    python -m filmgraph.plans.load fetch <dataset_root> <module:function>
"""

from __future__ import annotations

import argparse
import functools
import importlib
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from contextvars import copy_context
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from .. import session
from ..operators import fetch as X
from ..operators import integrity, responses, sizing
from ..sources import graphstore as G
from ..sources import dataset as io
from . import build


@dataclass
class LoadReport:
    written: dict[str, str] = field(default_factory=dict)
    counters: dict[str, int] = field(default_factory=dict)
    staged: list[str] = field(default_factory=list)


def _job(locks: str | None = None, after: Callable[[SparkSession, str], None] | None = None):
    """A load job: its tables become current together, or not at all. It holds the lock of the vertices
    that streams add as well; ``after`` runs once they are current."""
    def job(fn: Callable[..., LoadReport]) -> Callable[..., LoadReport]:
        @functools.wraps(fn)
        def run(spark: SparkSession, dataset_root: str, graph_root: str,
                mode: str = "fail") -> LoadReport:
            held = G.vertex_lock(spark, graph_root, locks) if locks else nullcontext()
            with held, G.load_job(spark, graph_root):
                report = fn(spark, dataset_root, graph_root, mode)
            if after:
                after(spark, graph_root)
            return report
        return run
    return job


def _release_late(spark: SparkSession, graph_root: str) -> None:
    """Streamed ratings that waited for one of the movies just loaded become edges."""
    from ..streaming import release_late_ratings

    release_late_ratings(spark, graph_root)


def staging_path(graph_root: str, name: str) -> str:
    return f"{graph_root.rstrip('/')}/_staging/{name}"


def quarantine_path(graph_root: str, name: str) -> str:
    return f"{graph_root.rstrip('/')}/_quarantine/{name}"


# Staged tables that are read by one value of a column are written in folders by that value.
STAGED_BY = {"omdb_credits": "kind"}


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table once and continue from the written copy."""
    by = STAGED_BY.get(path.rsplit("/", 1)[1])
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _staged(df: DataFrame, graph_root: str, name: str, report: LoadReport) -> DataFrame:
    """Stage a table of a job; the report remembers it for :func:`_drop_staging`."""
    path = staging_path(graph_root, name)
    report.staged.append(path)
    return stage(df, path)


def _drop_staging(spark: SparkSession, report: LoadReport) -> LoadReport:
    for path in report.staged:
        session.delete_folder(spark, path)
    report.staged.clear()
    return report


def _read_mode(mode: str) -> str:
    return "quarantine" if mode == "quarantine" else "fail"


def _staged_input(spark: SparkSession, dataset_root: str, name: str, graph_root: str,
                  mode: str, report: LoadReport) -> DataFrame:
    raw = io.read_input(spark, io.dataset_path(dataset_root, name), name, _read_mode(mode))
    staged = _staged(raw, graph_root, name, report)
    if mode != "quarantine":
        return staged
    _write_rejects(io.rejected(staged), graph_root, name, report)
    return io.accepted(staged)


def _write_rejects(df: DataFrame, graph_root: str, name: str, report: LoadReport) -> None:
    path = quarantine_path(graph_root, name)
    df.write.mode("overwrite").parquet(path)
    report.written[f"_quarantine/{name}"] = path


def build_adjacency(spark: SparkSession, graph_root: str, label: str,
                    directions: tuple[str, ...] = ("out", "in")) -> list[str]:
    """Write the clustered adjacency copies of a stored edge table (traversal access path); streamed
    batches that have no copy yet get theirs."""
    schema = S.EDGES[label].schema
    edges = spark.read.schema(schema).parquet(G.current(spark, G.edge_path(graph_root, label)))
    streamed = G.stream_path(graph_root, "edges", label)
    batches = _streamed_batches(spark, streamed)
    paths = []
    for d in directions:
        copies = G.stream_path(graph_root, f"adjacency/{d}", label)
        for batch in batches:
            if not session.path_exists(spark, f"{copies}/{batch}/_SUCCESS"):
                G.write_adjacency(spark.read.schema(schema).parquet(f"{streamed}/{batch}"),
                                  graph_root, label, d, path=f"{copies}/{batch}")
        paths.append(G.write_adjacency(edges, graph_root, label, d))
    return paths


def build_edge_ids(spark: SparkSession, graph_root: str, label: str) -> str:
    """Write the index of edge ids of a stored edge table; streamed batches without one get theirs."""
    schema = S.EDGES[label].schema
    streamed = G.stream_path(graph_root, "edges", label)
    for batch in _streamed_batches(spark, streamed):
        path = f"{G.stream_path(graph_root, 'ids', label)}/{batch}"
        if not session.path_exists(spark, f"{path}/_SUCCESS"):
            G.write_edge_ids(spark.read.schema(schema).parquet(f"{streamed}/{batch}"), graph_root,
                             label, path=path)
    edges = spark.read.schema(schema).parquet(G.current(spark, G.edge_path(graph_root, label)))
    return G.write_edge_ids(edges, graph_root, label)


def _streamed_batches(spark: SparkSession, streamed: str) -> list[str]:
    return [f"{name}/{epoch}" for name in session.list_folder(spark, streamed)
            for epoch in session.list_folder(spark, f"{streamed}/{name}")]


def _refresh_edge_ids(spark: SparkSession, graph_root: str, label: str) -> None:
    """Rebuild the id index of ``label``, if it has one, after its edges were rewritten."""
    if G.current(spark, G.ids_path(graph_root, label)):
        build_edge_ids(spark, graph_root, label)


def _refresh_adjacency(spark: SparkSession, graph_root: str, label: str) -> None:
    """Rebuild the adjacency copies that exist for ``label`` after its edges were rewritten."""
    present = tuple(d for d in G.NEAR
                    if G.current(spark, G.adjacency_path(graph_root, label, d)))
    if present:
        build_adjacency(spark, graph_root, label, present)


# Independent table writes submitted at once; Spark's scheduler interleaves their tasks, so
# small jobs (a few partitions each) do not leave the rest of the cluster idle.
CONCURRENT_WRITES = 4


def _write_tables(t: build.Tables, graph_root: str, mode: str, report: LoadReport) -> None:
    def vertex(label, df):
        return label, G.write_vertices(df, graph_root, label)

    def edge(label, df):
        path = G.write_edges(df, graph_root, label)
        _refresh_adjacency(df.sparkSession, graph_root, label)
        _refresh_edge_ids(df.sparkSession, graph_root, label)
        return label, path

    def reject(name, df):
        path = quarantine_path(graph_root, name)
        df.write.mode("overwrite").parquet(path)
        return f"_quarantine/{name}", path

    tasks = [(vertex, label, df) for label, df in t.vertices.items()]
    tasks += [(edge, label, df) for label, df in t.edges.items()]
    if mode == "quarantine":
        tasks += [(reject, name, df) for name, df in t.rejected.items()]
    with ThreadPoolExecutor(max_workers=CONCURRENT_WRITES) as pool:
        # each in a copy of this context, which knows the job's versions
        runs = [pool.submit(copy_context().run, task, label, df) for task, label, df in tasks]
        for name, path in [r.result() for r in runs]:
            report.written[name] = path


def _write_search(spark: SparkSession, graph_root: str, label: str, report: LoadReport) -> None:
    """The text index and the curve copy of a label, from its new version."""
    rows = _stored(spark, graph_root, label)
    jobs = [lambda: G.write_postings(rows, graph_root, label)]
    if label in G.CURVES:
        jobs.append(lambda: [G.write_curve(rows, graph_root, label)])
    for path in [path for paths in G.at_once(jobs) for path in paths]:
        report.written[path.removeprefix(f"{graph_root.rstrip('/')}/").rsplit("/", 1)[0]] = path


def _stored(spark: SparkSession, graph_root: str, label: str) -> DataFrame:
    g = G.read_graph(spark, graph_root, [label])
    if label not in g.vertices:
        raise RuntimeError(f"{label} vertices are not loaded yet under {graph_root}")
    return g.V(label)


@_job(after=_release_late)
def load_movies(spark: SparkSession, dataset_root: str, graph_root: str,
                mode: str = "fail") -> LoadReport:
    """MOVIE, YEAR, GENRE, RELEASED_IN, CATEGORIZED_AS from ``movies.csv``."""
    report = LoadReport()
    movies = _staged_input(spark, dataset_root, "movies", graph_root, mode, report)
    t = build.movie_tables(movies, mode)
    stored = G.read_graph(spark, graph_root, ["MOVIE"]).vertices.get("MOVIE")
    if stored is not None:
        # A reload replaces title, year and genres but keeps the properties the enrichment job
        # owns; the merged table is staged because it is built from the table it replaces.
        kept = ["movieId"] + [p for p, _ in S.VERTICES["MOVIE"].properties
                              if p not in MOVIE_OWN]
        merged = t.vertices["MOVIE"].select(*MOVIE_OWN).join(
            stored.select(*kept), "movieId", "left")
        t.vertices["MOVIE"] = _staged(merged, graph_root, "movie_merged", report)
        _check_stored_edges(spark, graph_root, t, mode, report)
    _write_tables(t, graph_root, mode, report)
    _write_search(spark, graph_root, "MOVIE", report)
    # movies of a genre: the edges clustered by genre
    for path in build_adjacency(spark, graph_root, "CATEGORIZED_AS", ("in",)):
        report.written["adjacency/CATEGORIZED_AS/in"] = path
    return _drop_staging(spark, report)


def _check_stored_edges(spark: SparkSession, graph_root: str, t: build.Tables, mode: str,
                        report: LoadReport) -> None:
    """V2 for a reload of MOVIE: edges stored by other jobs must still find their movies.

    ``fail`` stops before anything is written; ``quarantine`` takes the edges of movies that are
    gone out of their tables (streamed ones cannot be taken out and stop the job).
    """
    movies = t.vertices["MOVIE"]
    for label, spec in S.EDGES.items():
        ends = [(c, movies, "movieId") for c, end in (("src", spec.src), ("dst", spec.dst))
                if end == "MOVIE"]
        folder = G.current(spark, G.edge_path(graph_root, label))
        if label in t.edges or not ends:
            continue
        streamed = G.stream_path(graph_root, "edges", label)
        if session.path_exists(spark, streamed):
            rows = spark.read.schema(spec.schema).option("recursiveFileLookup", "true").parquet(
                streamed)
            integrity.enforce_references(rows, ends, "fail", f"streamed {label}")
        if folder:
            checked = integrity.enforce_references(
                spark.read.schema(spec.schema).parquet(folder), ends, mode, label)
            if mode == "quarantine":
                t.rejected[f"{label}_stored"] = rejected = _staged(
                    checked.rejected, graph_root, f"{label}_stored", report)
                if not rejected.isEmpty():
                    t.edges[label] = _staged(checked.accepted, graph_root, label, report)


# MOVIE properties written by the movie load itself (the rest come from the enrichment job).
MOVIE_OWN = ("movieId", "movieTitle", "movieYear", "movieGenres")


@_job(locks="USER")
def load_ratings(spark: SparkSession, dataset_root: str, graph_root: str,
                 mode: str = "fail") -> LoadReport:
    """USER and RATED_AS from ``ratings.csv`` (MOVIE must be loaded)."""
    report = LoadReport()
    ratings = _staged_input(spark, dataset_root, "ratings", graph_root, mode, report)
    movies = _stored(spark, graph_root, "MOVIE")
    t = build.rating_tables(ratings, movies, mode)
    streamed = G.stream_path(graph_root, "vertices", "USER")
    if session.path_exists(spark, streamed):
        # users that came with a stream are stored there
        known = spark.read.schema(S.VERTICES["USER"].schema).option(
            "recursiveFileLookup", "true").parquet(streamed).distinct()
        t.vertices["USER"] = t.vertices["USER"].join(
            sizing.for_join(sizing.materialize(known)), "userId", "left_anti")
    _write_tables(t, graph_root, mode, report)
    return _drop_staging(spark, report)


@_job()
def load_genome(spark: SparkSession, dataset_root: str, graph_root: str,
                mode: str = "fail") -> LoadReport:
    """TAG and ESTIMATED_AT from the genome files (MOVIE must be loaded)."""
    report = LoadReport()
    tags = _staged_input(spark, dataset_root, "genome_tags", graph_root, mode, report)
    scores = _staged_input(spark, dataset_root, "genome_scores", graph_root, mode, report)
    movies = _stored(spark, graph_root, "MOVIE")
    _write_tables(build.genome_tables(tags, scores, movies, mode), graph_root, mode, report)
    _write_search(spark, graph_root, "TAG", report)
    return _drop_staging(spark, report)


@_job()
def load_omdb(spark: SparkSession, dataset_root: str, graph_root: str,
              mode: str = "fail") -> LoadReport:
    """Credit labels and edges plus MOVIE enrichment from landed answers (and ``links.csv``)."""
    report = LoadReport()
    answers = io.read_omdb_responses(spark, dataset_root, _read_mode(mode))
    classified = responses.classify(responses.current(answers))
    # the answer text is only needed again where it could not be read
    classified = classified.withColumn("response", F.when(F.col("status") == "malformed",
                                                          F.col("response")))
    observed, obs = responses.observe_counts(classified)
    classified = _staged(observed, graph_root, "omdb_classified", report)
    report.counters.update(obs.get)
    links_path = io.dataset_path(dataset_root, "links")
    links = None
    if session.path_exists(spark, links_path):
        links = _staged_input(spark, dataset_root, "links", graph_root, mode, report)
    movies = _stored(spark, graph_root, "MOVIE")
    t = build.omdb_tables(None, movies, links, mode, classified=classified,
                          stage=lambda df, name: _staged(df, graph_root, name, report),
                          malformed=report.counters["malformed"])
    # versions: the new MOVIE is written beside the one it is built from
    _write_tables(t, graph_root, mode, report)
    _write_search(spark, graph_root, "MOVIE", report)
    write_entity_sketches(t.extra["credits"], graph_root)
    for row in responses.entity_counts(t.extra["credits"]).collect():   # five rows
        report.counters[f"distinct_{row['kind']}"] = row["n_raw"]
        report.counters[f"distinct_{row['kind']}_names"] = row["n_names"]
    return _drop_staging(spark, report)


def _counters_path(graph_root: str) -> str:
    return f"{graph_root.rstrip('/')}/counters/entities"


def write_entity_sketches(credits: DataFrame, graph_root: str) -> None:
    """Add the entity sketches of a load to those of the loads before. Sketches of a load that breaks off
    later, or runs twice, do no harm: the same entities count once."""
    (responses.entity_sketches(credits).coalesce(1).write.mode("append")
     .parquet(_counters_path(graph_root)))


def entity_estimates(spark: SparkSession, graph_root: str) -> DataFrame:
    """A6 over all loads of a graph: ``kind, n_raw, n_names`` from the stored sketches, no answer is read
    again (about 1% error)."""
    return responses.entity_estimates(spark.read.parquet(_counters_path(graph_root)))


def fetch_omdb(spark: SparkSession, dataset_root: str, fetch: Callable[[str], str | None],
               partitions: int = X.FETCH_PARTITIONS, batch_links: int = X.BATCH_LINKS,
               **retry) -> list[str]:
    """Fetch answers for links without one, in batches of about ``batch_links`` links; each batch
    lands in a folder of its own below ``omdb-json/``, so a failure loses one batch at most and the
    next run goes on from there. Returns the folders written."""
    links = io.read_links(spark, dataset_root)
    target = io.dataset_path(dataset_root, "omdb")
    landed = io.read_omdb_responses(spark, dataset_root) \
        if session.path_exists(spark, target) else None
    todo = stage(X.missing_links(links, landed),
                 session.new_scratch(spark, "fetch"))
    n = todo.count()
    batches = max(1, -(-n // batch_links))
    run, paths = uuid.uuid4().hex[:12], []
    for i in range(batches if n else 0):
        part = todo.where(F.pmod(F.xxhash64("movieId", "imdbId"), F.lit(batches)) == i)
        fetched = X.fetch_missing(part, None, fetch, partitions, **retry)
        paths.append(f"{target}/batch-{run}-{i:06d}")
        io.write_omdb_responses(fetched, paths[-1])
    return paths


def load_all(spark: SparkSession, dataset_root: str, graph_root: str,
             mode: str = "fail", adjacency: tuple[str, ...] = (),
             edge_ids: tuple[str, ...] = ()) -> LoadReport:
    """Every load job in dependency order; inputs that are absent are skipped.

    ``adjacency`` names edge labels that also get clustered adjacency copies (both directions),
    ``edge_ids`` those that get an index of edge ids.
    """
    report = LoadReport()
    steps = [("movies", load_movies), ("ratings", load_ratings),
             ("genome_scores", load_genome), ("omdb", load_omdb)]
    for name, job in steps:
        if name == "movies" or session.path_exists(spark, io.dataset_path(dataset_root, name)):
            r = job(spark, dataset_root, graph_root, mode)
            report.written.update(r.written)
            report.counters.update(r.counters)
    for label in adjacency:
        for path in build_adjacency(spark, graph_root, label):
            report.written["/".join(path.rsplit("/", 4)[1:4])] = path
    for label in edge_ids:
        report.written[f"ids/{label}"] = build_edge_ids(spark, graph_root, label)
    return report


JOBS = {"movies": load_movies, "ratings": load_ratings, "genome": load_genome,
        "omdb": load_omdb, "all": load_all}


def named_function(name: str) -> Callable:
    """``module:function`` as a callable."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"{name!r} is not of the form module:function")
    return getattr(importlib.import_module(module), attribute)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load the film dataset into graph tables")
    parser.add_argument("job", choices=[*sorted(JOBS), "fetch"])
    parser.add_argument("dataset_root")
    parser.add_argument("target", help="graph root, or (with 'fetch') module:function to call with "
                                       "each reference")
    parser.add_argument("--mode", choices=["fail", "quarantine"], default="fail")
    parser.add_argument("--adjacency", default="",
                        help="comma-separated edge labels to give adjacency copies (with 'all')")
    parser.add_argument("--edge-ids", default="",
                        help="comma-separated edge labels to give an index of edge ids (with 'all')")
    args = parser.parse_args(argv)
    spark = session.build_session()
    if args.job == "fetch":
        for path in fetch_omdb(spark, args.dataset_root, named_function(args.target)):
            print(path)
        return
    if args.job == "all":
        labels, ids = (tuple(x for x in given.split(",") if x)
                       for given in (args.adjacency, args.edge_ids))
        report = load_all(spark, args.dataset_root, args.target, args.mode, labels, ids)
    else:
        report = JOBS[args.job](spark, args.dataset_root, args.target, args.mode)
    for name, path in sorted(report.written.items()):
        print(f"{name}\t{path}")
    for name, value in sorted(report.counters.items()):
        print(f"{name}: {value}")


if __name__ == "__main__":
    main()
