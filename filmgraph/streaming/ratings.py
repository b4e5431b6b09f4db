"""Incremental ratings: new rating files dropped into a landing folder become RATED_AS edges and
USER vertices of an already loaded graph.

This is the ratings load (S2, VX4, E3, V2) on a Structured Streaming file source. Each
micro-batch

1. is staged to ``<graph>/_staging/ratings_stream/<stream>/epoch-<n>`` (lineage cut; deleted at the
   end of the batch);
2. checks every rated movie against the stored MOVIE keys (distinct-key anti join; misses go to
   ``<graph>/_quarantine/ratings_stream/<stream>/epoch-<n>``) - the batch's few keys are broadcast
   and the vertex table streamed, so a micro-batch never shuffles the whole key column;
   - or, with ``late_seconds``, ratings of unknown movies wait in ``<graph>/_pending/...`` until their
   movie is loaded or the time is up (:func:`release_late_ratings`);
3. writes its edges to ``stream/edges/RATED_AS/<stream>/epoch-<n>`` (and to the adjacency copies,
   when the graph has them) and the users not yet in the graph to
   ``stream/vertices/USER/<stream>/epoch-<n>`` - all with ``overwrite``, so replaying a batch after
   a failure rewrites exactly that batch's folders and never duplicates rows.

These folders lie outside the batch tables, so reloading ``ratings.csv`` keeps streamed ratings.
``<stream>`` is an id kept beside the checkpoint: two streams, or a stream started again with a new
checkpoint, never share folders. Graph readers unite both parts
(:func:`filmgraph.sources.graphstore.read_graph`). Stream files are CSV with a header line in the
column order of ``ratings.csv``; a file with another header stops the stream.
"""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from .. import session
from ..operators import edges as E
from ..operators import integrity, sizing
from ..operators import vertices as V
from ..sources import graphstore as G
from ..sources import dataset as io

_RAW = T.StructType([T.StructField(f.name, T.StringType(), True) for f in S.RATINGS.fields])


def epoch_folder(epoch_id: int) -> str:
    return f"epoch-{epoch_id:012d}"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the stream with this checkpoint, made and stored on its first start."""
    path = f"{checkpoint.rstrip('/')}/_filmgraph_stream"
    if not session.path_exists(spark, f"{path}/_SUCCESS"):
        name = f"stream-{uuid.uuid4().hex[:12]}"
        spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode(
            "overwrite").text(path)
    return spark.read.text(path).first()["value"]


def rating_stream(spark: SparkSession, landing_dir: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of typed ratings with an ``_error`` column for rows that failed."""
    # enforceSchema=false: the header of every file must be the declared one
    reader = spark.readStream.schema(_RAW).options(**io.CSV_READ, enforceSchema="false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(landing_dir)
    return io.conform(raw, S.RATINGS, io.INPUTS["ratings"].required, mode="quarantine")


def _existing_users(spark: SparkSession, graph_root: str, mine: str) -> DataFrame:
    """Stored USER keys, excluding whatever an earlier attempt of this batch wrote."""
    schema = S.VERTICES["USER"].schema
    users = spark.createDataFrame([], schema)
    batch = G.current(spark, G.vertex_path(graph_root, "USER"))
    if batch:
        users = users.unionByName(spark.read.schema(schema).parquet(batch))
    streamed = G.stream_path(graph_root, "vertices", "USER")
    if session.path_exists(spark, streamed):
        rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(streamed)
        users = users.unionByName(rows.where(
            ~F.col("_metadata.file_path").contains(f"/{mine}/")).select("userId"))
    return users


NO_MOVIE = "no vertex for dst"


def pending_path(graph_root: str) -> str:
    return f"{graph_root.rstrip('/')}/_pending/ratings_stream"


def _pending_schema() -> T.StructType:
    return T.StructType([*S.EDGES["RATED_AS"].schema.fields, T.StructField("_row", T.LongType()),
                         T.StructField("_until", T.DoubleType())])


def _write_edges(edges: DataFrame, graph_root: str, folder: str) -> None:
    """Streamed edges, and their copies where the graph has such copies."""
    spark = edges.sparkSession
    (edges.sortWithinPartitions(*S.EDGES["RATED_AS"].sort_by).write.mode("overwrite")
     .parquet(f"{G.stream_path(graph_root, 'edges', 'RATED_AS')}/{folder}"))
    for direction in G.NEAR:     # keep existing adjacency copies in step with the edges
        if G.current(spark, G.adjacency_path(graph_root, "RATED_AS", direction)):
            copies = G.stream_path(graph_root, f"adjacency/{direction}", "RATED_AS")
            G.write_adjacency(edges, graph_root, "RATED_AS", direction, path=f"{copies}/{folder}")
    if G.current(spark, G.ids_path(graph_root, "RATED_AS")):
        G.write_edge_ids(edges, graph_root, "RATED_AS",
                         path=f"{G.stream_path(graph_root, 'ids', 'RATED_AS')}/{folder}")


def _quarantined(edges: DataFrame, *more: str) -> DataFrame:
    return edges.select(F.col("src").alias("userId"), F.col("dst").alias("movieId"),
                        F.col("score").cast("double").alias("rating"), "timestamp", io.ERROR_COL,
                        *more)


def release_late_ratings(spark: SparkSession, graph_root: str,
                         now: float | None = None) -> dict[str, int]:
    """Ratings that wait for their movie: those whose movie is there by now become edges, those whose time
    is up go to the quarantine, the others wait on. Returns how many of each.

    Called at the start of a stream that keeps late ratings and after each load of movies. A run writes one
    numbered folder per stream, and what earlier runs have written is left out, so a run that breaks off is
    simply done again.
    """
    from ..plans.load import quarantine_path

    now = time.time() if now is None else now
    done = {"released": 0, "expired": 0, "waiting": 0}
    for stream in session.list_folder(spark, pending_path(graph_root)):
        root = f"{pending_path(graph_root)}/{stream}"
        epochs = [e for e in session.list_folder(spark, root)
                  if session.path_exists(spark, f"{root}/{e}/_SUCCESS")
                  and not session.path_exists(spark, f"{root}/{e}/_resolved")]
        if not epochs:
            continue
        rows = G._union([spark.read.schema(_pending_schema()).parquet(f"{root}/{e}").withColumn(
            "_epoch", F.lit(e)) for e in epochs])
        edges = f"{G.stream_path(graph_root, 'edges', 'RATED_AS')}/{stream}"
        gone = f"{quarantine_path(graph_root, 'ratings_stream')}/{stream}"
        runs = [n for n in session.list_folder(spark, edges) if n.startswith("late-")
                and session.path_exists(spark, f"{edges}/{n}/_SUCCESS")]
        if runs:
            known = spark.read.schema("_epoch string, _row long").parquet(
                *[f"{base}/{n}" for n in runs for base in (edges, gone)])
            rows = rows.join(sizing.for_join(sizing.materialize(known)), ["_epoch", "_row"],
                             "left_anti")
        rows = sizing.materialize(rows)
        missing = integrity.absent_keys(rows.df, "dst", G.read_graph(spark, graph_root, ["MOVIE"])
                                        .V("MOVIE"), "movieId", small=True)
        keys = sizing.for_join(sizing.materialize(missing))
        found = sizing.materialize(rows.df.join(keys, "dst", "left_anti"))
        absent = rows.df.join(keys, "dst", "left_semi")
        late = sizing.materialize(absent.where(F.col("_until") < now))
        if found.rows or late.rows:
            folder = f"late-{len(runs):08d}"
            (_quarantined_late(late.df).write.mode("overwrite").parquet(f"{gone}/{folder}"))
            # the extra columns say which rows these were; readers of edges do not ask for them
            _write_edges(found.df, graph_root, f"{stream}/{folder}")
        waiting = {r["_epoch"]: r["count"] for r in absent.where(F.col("_until") >= now)
                   .groupBy("_epoch").count().collect()}
        for e in epochs:
            if e not in waiting:
                session.write_text(spark, f"{root}/{e}/_resolved", "")
        done["released"] += found.rows
        done["expired"] += late.rows
        done["waiting"] += sum(waiting.values())
    return done


def _quarantined_late(rows: DataFrame) -> DataFrame:
    return _quarantined(rows.withColumn(io.ERROR_COL, F.lit(NO_MOVIE)), "_epoch", "_row")


def process_batch(batch: DataFrame, epoch_id: int, graph_root: str, stream: str = "stream-0",
                  late_seconds: float | None = None) -> None:
    """Load one micro-batch of typed ratings (see module docstring)."""
    spark = batch.sparkSession
    from ..plans.load import quarantine_path, stage, staging_path

    folder = f"{stream}/{epoch_folder(epoch_id)}"
    staging = staging_path(graph_root, f"ratings_stream/{folder}")
    staged = stage(batch, f"{staging}/rows")
    good, bad = io.accepted(staged), io.rejected(staged)
    movies = G.read_graph(spark, graph_root, ["MOVIE"]).V("MOVIE")
    checked = integrity.enforce_references(E.rated_as_edges(good), [("dst", movies, "movieId")],
                                           "quarantine", "RATED_AS", small=True)
    edges = stage(E.conform_edges(checked.accepted, "RATED_AS"), f"{staging}/edges")
    _write_edges(edges, graph_root, folder)
    with G.vertex_lock(spark, graph_root, "USER"):
        new_users = integrity.absent_keys(V.user_vertices(good), "userId",
                                          _existing_users(spark, graph_root, folder), "userId",
                                          small=True)
        new_users.write.mode("overwrite").parquet(
            f"{G.stream_path(graph_root, 'vertices', 'USER')}/{folder}")
    rejected = checked.rejected
    if late_seconds is not None:
        waits = (F.col(io.ERROR_COL) == NO_MOVIE) & F.col("dst").isNotNull()
        (rejected.where(waits).select(
            *S.EDGES["RATED_AS"].schema.fieldNames(), F.monotonically_increasing_id().alias("_row"),
            F.lit(time.time() + late_seconds).alias("_until"))
         .write.mode("overwrite").parquet(f"{pending_path(graph_root)}/{folder}"))
        rejected = rejected.where(~waits)
    rejects = bad.unionByName(_quarantined(rejected), allowMissingColumns=True)
    rejects.write.mode("overwrite").parquet(
        f"{quarantine_path(graph_root, 'ratings_stream')}/{folder}")
    session.delete_folder(spark, staging)


def start_ratings_stream(spark: SparkSession, landing_dir: str, graph_root: str,
                         checkpoint: str | None = None, available_now: bool = True,
                         processing_time: str | None = None,
                         max_files_per_trigger: int | None = None,
                         late_seconds: float | None = None) -> StreamingQuery:
    """Start loading rating files from ``landing_dir`` into the graph at ``graph_root``. Ratings of movies
    that are not loaded wait for ``late_seconds``; without it they are set aside at once.

    ``available_now`` processes what has landed and stops (a scheduled incremental load);
    otherwise the query keeps running with ``processing_time`` triggers.
    """
    tag = hashlib.sha1(f"{graph_root} {landing_dir}".encode()).hexdigest()[:16]
    checkpoint = checkpoint or session.shared_path(spark, "streams", f"ratings-{tag}")
    name = stream_id(spark, checkpoint)
    if late_seconds is not None:
        release_late_ratings(spark, graph_root)
    stream = rating_stream(spark, landing_dir, max_files_per_trigger)
    writer = (stream.writeStream.queryName(f"filmgraph_ratings_{name}")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, epoch: process_batch(df, epoch, graph_root, name,
                                                             late_seconds)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
