"""Graph storage: one Parquet table per vertex label and per edge label.

Layout below a graph root::

    vertices/<LABEL>/version-<n>/part-*.parquet   natural key + properties (V3 schema)
    edges/<LABEL>/version-<n>/part-*.parquet      src, dst (endpoint keys) + properties
    index/<LABEL>/<table>/version-<n>/            postings of text properties, and their counts
    ids/<LABEL>/version-<n>/                      content hash, copies, edge: the index of edge ids
    stream/{vertices,edges}/<LABEL>/<stream>/epoch-<n>/   micro-batches of incremental loads

    curve/<LABEL>/version-<n>/                    copy of the vertices along a space-filling curve
    _manifest/<n>                                 the current version of every table

Choosing a label is choosing a folder, so a label predicate never reads other labels. A load job
replaces tables by writing their next versions and then one small file, the manifest, that names
them (:func:`load_job`); readers take the versions of the newest manifest, so a job that stops
half-way leaves all tables as they were. One job writes to a graph at a time. Streamed batches lie
outside the versions: replacing a batch table keeps them, and readers take both.

Rows are range-partitioned and sorted by the label's index columns (vertex key; RATED_AS by score
then timestamp; ESTIMATED_AT by relevance), so every file and row group covers a narrow range and
exact-match and range predicates open few files - the Parquet counterpart of a composite index.
Unique lookup columns that are not the sort key carry Parquet bloom filters (the counterpart of a
unique composite index).
"""

from __future__ import annotations

import json
import threading
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from .. import session
from ..functions import grams
from ..functions import search as P
from ..operators import edge_ids


def vertex_path(root: str, label: str) -> str:
    return f"{root.rstrip('/')}/vertices/{label}"


def edge_path(root: str, label: str) -> str:
    return f"{root.rstrip('/')}/edges/{label}"


def adjacency_path(root: str, label: str, direction: str) -> str:
    return f"{root.rstrip('/')}/adjacency/{label}/{direction}"


def index_path(root: str, label: str, prop: str) -> str:
    return f"{root.rstrip('/')}/index/{label}/{prop}"


def ids_path(root: str, label: str) -> str:
    return f"{root.rstrip('/')}/ids/{label}"


def stream_path(root: str, kind: str, label: str) -> str:
    """Folder of the streamed batches of a table; ``kind`` is vertices, edges, ids or
    adjacency/<direction>."""
    return f"{root.rstrip('/')}/stream/{kind}/{label}"


# ---------------------------------------------------------------- versions

_VERSION = "version-"
_KINDS = ("vertices", "edges", "adjacency", "index", "ids", "curve")
_manifest_lock = threading.RLock()
# Folder -> version of the load job that runs in this context; nobody else reads them yet.
_pending: ContextVar[dict[str, dict[str, str]]] = ContextVar("pending")


def _root_of(folder: str) -> str:
    return folder[:max(folder.rfind(f"/{kind}/") for kind in _KINDS)]


def manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def manifest(spark: SparkSession, root: str) -> dict[str, str] | None:
    """The version that stands for each table folder (relative to the root), as last published; None for a
    graph that has no manifest."""
    root = root.rstrip("/")
    names = [n for n in session.list_folder(spark, manifest_path(root)) if n.isdigit()]
    if not names:
        return None
    return json.loads(session.read_text(spark, f"{manifest_path(root)}/{names[-1]}"))


def _publish_versions(spark: SparkSession, root: str, found: dict[str, str]) -> None:
    """Make new versions of some tables current, all at once: the next manifest names them. Versions that
    are neither current nor were so before are deleted."""
    with _manifest_lock:
        held = manifest(spark, root) or {}
        names = [n for n in session.list_folder(spark, manifest_path(root)) if n.isdigit()]
        number = int(names[-1]) + 1 if names else 1
        session.write_text(spark, f"{manifest_path(root)}/{number:08d}",
                           json.dumps({**held, **found}, sort_keys=True))
        for name in names[:-1]:           # the new one and its predecessor stay
            session.delete_folder(spark, f"{manifest_path(root)}/{name}")
    for table, version in found.items():
        for name in versions(spark, f"{root}/{table}"):
            if name not in (version, held.get(table)):
                session.delete_folder(spark, f"{root}/{table}/{name}")


def _adopt(spark: SparkSession, root: str) -> None:
    """Give a graph its first manifest: what is committed there already."""
    with _manifest_lock:
        if manifest(spark, root) is not None:
            return
        found = {}
        tables = [f"{kind}/{a}" for kind in ("vertices", "edges", "ids", "curve")
                  for a in session.list_folder(spark, f"{root}/{kind}")]
        tables += [f"{kind}/{a}/{b}" for kind in ("adjacency", "index")
                   for a in session.list_folder(spark, f"{root}/{kind}")
                   for b in session.list_folder(spark, f"{root}/{kind}/{a}")]
        for table in tables:
            newest = _newest(spark, f"{root}/{table}")
            if newest:
                found[table] = newest
        session.write_text(spark, f"{manifest_path(root)}/{1:08d}", json.dumps(found))


@contextmanager
def load_job(spark: SparkSession, root: str):
    """The tables written inside become current together when the block ends well, and not at all
    otherwise. Inside, the job reads its own versions; others read the old ones."""
    root = root.rstrip("/")
    _adopt(spark, root)
    found: dict[str, str] = {}
    token = _pending.set({**_pending.get({}), root: found})
    try:
        yield
    except BaseException:
        for table, version in found.items():
            session.delete_folder(spark, f"{root}/{table}/{version}")
        raise
    else:
        if found:
            _publish_versions(spark, root, found)
    finally:
        _pending.reset(token)


def versions(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in session.list_folder(spark, folder) if n.startswith(_VERSION)]


def _newest(spark: SparkSession, folder: str) -> str | None:
    for name in reversed(versions(spark, folder)):
        if session.path_exists(spark, f"{folder}/{name}/_SUCCESS"):
            return name
    return None


def current(spark: SparkSession, folder: str, held: dict[str, str] | None = None) -> str | None:
    """Path of the current version of a table, None if there is none. ``held`` saves reading the
    manifest again."""
    root = _root_of(folder)
    table = folder[len(root) + 1:]
    own = _pending.get({}).get(root, {})
    if table in own:
        return f"{folder}/{own[table]}"
    if held is None:
        held = manifest(spark, root)
    name = _newest(spark, folder) if held is None else held.get(table)
    return f"{folder}/{name}" if name else None


def publish(spark: SparkSession, folder: str, write) -> str:
    """Write the next version of a table with ``write(path)``. It becomes current at the end of the load
    job around it, or at once if there is none."""
    have = versions(spark, folder)
    number = int(have[-1][len(_VERSION):]) + 1 if have else 1
    name = f"{_VERSION}{number:08d}"
    root = _root_of(folder)
    own = _pending.get({}).get(root)
    if own is None:
        _adopt(spark, root)
    write(f"{folder}/{name}")
    if own is not None:
        own[folder[len(root) + 1:]] = name
    else:
        _publish_versions(spark, root, {folder[len(root) + 1:]: name})
    return f"{folder}/{name}"


# Text properties whose tokens and three-character runs get postings.
TEXT_INDEXES = {"MOVIE": ("movieTitle", "movieRated", "movieImdbId", "movieGenres"),
                "TAG": ("tagName",)}
# Numeric properties that order the copy of a label along a space-filling curve.
CURVES = {"MOVIE": ("movieYear", "movieImdbScore", "movieImdbVotes", "movieBoxOffice",
                    "movieMetascore")}
CURVE_BITS = 6

# The endpoint an adjacency copy is clustered on, per direction.
NEAR = {"out": "src", "in": "dst"}


def _conform(df: DataFrame, schema) -> DataFrame:
    have = set(df.columns)
    return df.select([(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
                      .alias(f.name) for f in schema.fields])


def bloom_options(columns) -> dict[str, str]:
    """Writer options for Parquet bloom filters on ``columns`` (sized from the data written)."""
    if not columns:
        return {}
    opts = {"parquet.bloom.filter.adaptive.enabled": "true"}
    for c in columns:
        opts[f"parquet.bloom.filter.enabled#{c}"] = "true"
    return opts


def write_vertices(df: DataFrame, root: str, label: str) -> str:
    """Store one vertex label as the table's next version (re-running replaces it).

    Rows are range-partitioned and sorted by the key, so a key lookup opens one file; the other
    unique lookup columns carry bloom filters, so a lookup by one of them reads only the row group
    holding it.
    """
    spec = S.VERTICES[label]
    rows = _conform(df, spec.schema).repartitionByRange(spec.key).sortWithinPartitions(spec.key)
    return publish(df.sparkSession, vertex_path(root, label), lambda path: rows.write.options(
        **bloom_options(spec.bloom)).parquet(path))


def write_edges(df: DataFrame, root: str, label: str, bloom: tuple[str, ...] = ()) -> str:
    """Store one edge label as the table's next version, clustered by its index columns (the
    endpoints follow as last sort columns, so that one frequent score spreads over files).

    ``bloom=("src", "dst")`` adds bloom filters on the endpoints: worth it when traversals start
    from few, low-degree vertices (a high-degree vertex has rows in every row group anyway).
    """
    spec = S.EDGES[label]
    order = list(dict.fromkeys([*spec.sort_by, "src", "dst"]))
    rows = _conform(df, spec.schema).repartitionByRange(*order).sortWithinPartitions(*order)
    return publish(df.sparkSession, edge_path(root, label), lambda path: rows.write.options(
        **bloom_options(bloom)).parquet(path))


def write_adjacency(df: DataFrame, root: str, label: str, direction: str,
                    path: str | None = None) -> str:
    """An adjacency copy of one edge label, clustered on the near endpoint of ``direction``.

    ``out`` clusters on ``src``, ``in`` on ``dst`` - the two adjacency lists a graph store keeps
    per edge. Rows are range-partitioned on ``(near, far)`` and sorted, so every file and row
    group covers a narrow key range: a traversal from a few vertices pushes its keys as an
    ``IN`` filter and reads only the row groups holding them. Partitioning on the pair lets the
    range boundaries split a vertex that holds a large share of all edges over several tasks.
    ``path`` overrides the target folder (incremental loads add batch folders below the copy).
    """
    spec = S.EDGES[label]
    near = NEAR[direction]
    far = "dst" if near == "src" else "src"
    rows = (_conform(df, spec.schema).repartitionByRange(near, far)
            .sortWithinPartitions(near, far))
    if path:
        rows.write.mode("overwrite").parquet(path)
        return path
    return publish(df.sparkSession, adjacency_path(root, label, direction),
                   lambda target: rows.write.parquet(target))


# Hashes as text hold four bits in a character, which only an entropy coder takes off.
IDS_WRITE = {"compression": "zstd"}


def write_edge_ids(df: DataFrame, root: str, label: str, path: str | None = None) -> str:
    """The index of edge ids: a row per distinct edge with its content hash and number of copies,
    clustered by the hash, so a lookup by id opens the file that holds it. ``path`` overrides the
    target folder, as for adjacency copies."""
    rows = edge_ids.copies(_conform(df, S.EDGES[label].schema), label)
    # the hash is longer than the edge and does not compress: made again rather than sent
    rows = edge_ids.hashed(rows.repartitionByRange(edge_ids.content_hash(label)), label) \
        .sortWithinPartitions(edge_ids.HASH)
    if path:
        rows.write.mode("overwrite").options(**IDS_WRITE).parquet(path)
        return path
    return publish(df.sparkSession, ids_path(root, label),
                   lambda target: rows.write.options(**IDS_WRITE).parquet(target))


POSTINGS, COUNTS = "postings", "counts"
TOKEN, GRAM, ALL = "t", "g", "all"


def postings_schema(label: str):
    key = S.VERTICES[label].key
    return S._struct(("property", S.STRING), ("kind", S.STRING), ("piece", S.STRING),
                     (key, S.VERTICES[label].type_of(key)))


COUNTS_SCHEMA = S._struct(("property", S.STRING), ("kind", S.STRING), ("piece", S.STRING),
                          ("n", S.LONG))


def write_postings(df: DataFrame, root: str, label: str) -> list[str]:
    """The text index of a label: a row per vertex, text property and distinct token or run of three
    characters, clustered by them, so a search opens the files that hold its pieces; and the number of
    vertices of each piece (and of all with the property), by which a search picks the rarest. The
    pieces are counted from the rows written, so values are cut up for the first table only."""
    spec = S.VERTICES[label]
    order = ["property", "kind", "piece"]
    pieces, held = [], []
    for prop in TEXT_INDEXES[label]:
        values = F.col(prop) if prop_is_set(label, prop) else F.array(F.col(prop))
        values = F.filter(values, lambda v: v.isNotNull())
        for kind, cut in ((TOKEN, P.tokens), (GRAM, grams.grams)):
            found = F.array_distinct(F.flatten(F.transform(values, cut)))
            pieces.append(F.transform(found, _piece(prop, kind)))
        held.append(F.when(F.size(values) > 0, F.lit(prop)))
    every = F.flatten(F.filter(F.array(*pieces), lambda x: x.isNotNull()))
    listed = df.select(F.explode(every).alias("x"), spec.key).select("x.*", spec.key) \
        .repartitionByRange(*order, spec.key).sortWithinPartitions(*order, spec.key)
    written = publish(df.sparkSession, index_path(root, label, POSTINGS),
                      lambda path: listed.write.parquet(path))
    with_value = df.select(F.explode(F.filter(F.array(*held), lambda x: x.isNotNull())).alias(
        "property")).select("property", F.lit(ALL).alias("kind"), F.lit("").alias("piece"))
    rows = df.sparkSession.read.schema(postings_schema(label)).parquet(written).select(*order)
    counted = rows.unionByName(with_value).groupBy(*order).agg(F.count(F.lit(1)).alias("n")) \
        .repartitionByRange(*order).sortWithinPartitions(*order)
    return [written, publish(df.sparkSession, index_path(root, label, COUNTS),
                             lambda path: counted.write.parquet(path))]


def at_once(jobs: list) -> list:
    """The results of independent jobs, submitted together so that small ones do not leave the rest of the
    cluster idle; each runs in a copy of this context, which knows the versions of the load around it."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return [run.result() for run in [pool.submit(copy_context().run, job) for job in jobs]]


def _piece(prop: str, kind: str):
    return lambda x: F.struct(F.lit(prop).alias("property"), F.lit(kind).alias("kind"),
                              x.alias("piece"))


def prop_is_set(label: str, prop: str) -> bool:
    return S.VERTICES[label].type_of(prop).typeName() == "array"


def curve_place(df: DataFrame, props: tuple[str, ...], bits: int = CURVE_BITS) -> Column:
    """Place on a space-filling curve: each property's rank among its quantiles (0: null), their bits
    interleaved from the highest on. Neighbours on the curve are near in all properties, so a sorted
    file covers a narrow range of each."""
    parts = (1 << bits) - 2
    cuts = df.approxQuantile(list(props), [i / parts for i in range(1, parts)], 0.25 / parts)
    ranks = []
    for prop, bounds in zip(props, cuts, strict=True):
        value = F.col(prop).cast("double")
        below = F.size(F.filter(F.lit(sorted(set(bounds))).cast("array<double>"), _up_to(value)))
        ranks.append(F.when(value.isNull(), 0).otherwise(below + 1).cast("long"))
    place = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(rank, bit).bitwiseAND(1))
    return place


def _up_to(value: Column):
    return lambda bound: bound <= value


def curve_path(root: str, label: str) -> str:
    return f"{root.rstrip('/')}/curve/{label}"


def write_curve(df: DataFrame, root: str, label: str) -> str:
    """A copy of a label sorted along the curve of its numeric properties, for searches by several."""
    spec = S.VERTICES[label]
    rows = _conform(df, spec.schema)
    place = curve_place(rows, CURVES[label])
    placed = (rows.withColumn("_place", place).repartitionByRange("_place", spec.key)
              .sortWithinPartitions("_place", spec.key).drop("_place"))
    return publish(df.sparkSession, curve_path(root, label), lambda path: placed.write.parquet(path))


@dataclass
class Graph:
    """Vertex and edge tables by label (lazy DataFrames).

    ``postings[label]`` and ``counts[label]`` hold text indexes (:func:`write_postings`) - their tokens
    also by ``tokens[(label, property)]`` -, ``curves[label]`` copies for searches by several properties
    (:func:`write_curve`), ``ids[label]`` indexes of edge ids (:func:`write_edge_ids`) - those of the
    labels in ``whole`` are one table, the others lie in several parts that may repeat an edge - and
    ``adjacency[(label, direction)]`` the optional clustered copies of edge tables used by
    traversals from small frontiers (:func:`write_adjacency`).
    """

    vertices: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, DataFrame] = field(default_factory=dict)
    adjacency: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    tokens: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    ids: dict[str, DataFrame] = field(default_factory=dict)
    whole: set[str] = field(default_factory=set)
    postings: dict[str, DataFrame] = field(default_factory=dict)
    counts: dict[str, DataFrame] = field(default_factory=dict)
    curves: dict[str, DataFrame] = field(default_factory=dict)

    def V(self, label: str) -> DataFrame:
        """The vertex table of one label."""
        if label not in self.vertices:
            raise KeyError(f"no vertex label {label!r}; have {sorted(self.vertices)}")
        return self.vertices[label]

    def E(self, label: str) -> DataFrame:
        """The edge table of one label."""
        if label not in self.edges:
            raise KeyError(f"no edge label {label!r}; have {sorted(self.edges)}")
        return self.edges[label]

    def contents(self, label: str) -> DataFrame:
        """Distinct edges of a label with content hash and copies: the stored index, or made from the
        edges where there is none."""
        return self.ids[label] if label in self.ids else edge_ids.contents(self.E(label), label)

    def edges_with_ids(self, label: str) -> DataFrame:
        """Every edge of a label with its ``edge_id``."""
        held = self.contents(label)
        if label not in self.ids or label in self.whole:
            return edge_ids.numbered(held, label)       # a row per distinct edge already
        columns = S.EDGES[label].schema.fieldNames()
        whole = held.groupBy(edge_ids.HASH, *columns).agg(
            F.sum(edge_ids.COPIES).alias(edge_ids.COPIES))
        return edge_ids.numbered(whole, label)

    def key(self, label: str) -> str:
        return S.VERTICES[label].key

    def all_vertices(self) -> DataFrame:
        """``V()``: every vertex as ``id = "<LABEL>:<key>"`` with its label."""
        parts = [self.V(label).select(
            F.concat(F.lit(label + ":"), F.col(S.VERTICES[label].key).cast("string")).alias("id"),
            F.lit(label).alias("label")) for label in self.vertices]
        return _union(parts)

    def all_edges(self) -> DataFrame:
        """``E()``: every edge as ``src_id, dst_id, label`` over the unified vertex ids."""
        parts = []
        for label in self.edges:
            spec = S.EDGES[label]
            parts.append(self.E(label).select(
                F.concat(F.lit(spec.src + ":"), F.col("src").cast("string")).alias("src_id"),
                F.concat(F.lit(spec.dst + ":"), F.col("dst").cast("string")).alias("dst_id"),
                F.lit(label).alias("label")))
        return _union(parts)

    def register_views(self, spark: SparkSession, prefix: str = "") -> list[str]:
        """Expose every table as a temp view (``v_movie``, ``e_rated_as``, ...) for SQL users."""
        names = []
        for label, df in self.vertices.items():
            df.createOrReplaceTempView(name := f"{prefix}v_{label.lower()}")
            names.append(name)
        for label, df in self.edges.items():
            df.createOrReplaceTempView(name := f"{prefix}e_{label.lower()}")
            names.append(name)
        return names

    def write(self, root: str) -> None:
        for label, df in self.vertices.items():
            write_vertices(df, root, label)
        for label, df in self.edges.items():
            write_edges(df, root, label)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _open_search(spark: SparkSession, g: Graph, root: str, label: str, held) -> None:
    """The text index and the curve copy of a label, where they are stored."""
    tables = {POSTINGS: (g.postings, postings_schema(label)), COUNTS: (g.counts, COUNTS_SCHEMA)}
    for name, (target, schema) in tables.items():
        path = current(spark, index_path(root, label, name), held) if label in TEXT_INDEXES else None
        if path:
            target[label] = spark.read.schema(schema).parquet(path)
    if label in g.postings:
        key = S.VERTICES[label].key
        for prop in TEXT_INDEXES[label]:
            g.tokens[(label, prop)] = g.postings[label].where(
                (F.col("property") == prop) & (F.col("kind") == TOKEN)).select(
                F.col("piece").alias("token"), key)
    path = current(spark, curve_path(root, label), held) if label in CURVES else None
    if path:
        g.curves[label] = spark.read.schema(S.VERTICES[label].schema).parquet(path)


def vertex_lock(spark: SparkSession, root: str, label: str):
    """Held by whoever decides which vertices of a label are new and writes them: a vertex is stored once,
    in the batch table or in one streamed batch, so readers unite both without looking for doubles."""
    return session.lock(spark, f"{root.rstrip('/')}/_locks/{label}")


def _stored(spark: SparkSession, schema, folder: str, streamed: str | None,
            held: dict[str, str] | None = None) -> DataFrame | None:
    """Current version and streamed batches of a table, None if there is neither."""
    reader = spark.read.schema(schema)
    version = current(spark, folder, held)
    table = reader.parquet(version) if version else None
    if streamed is None or not session.path_exists(spark, streamed):
        return table
    batches = reader.option("recursiveFileLookup", "true").parquet(streamed)
    if table is not None:
        batches = table.unionByName(batches)
    return batches


def read_graph(spark: SparkSession, root: str, labels: list[str] | None = None) -> Graph:
    """Open a stored graph. Labels that were never written are skipped.

    Tables are read with their declared schemas, so opening a graph lists files but reads no
    Parquet footers for schema inference.
    """
    root = root.rstrip("/")
    g, held = Graph(), manifest(spark, root)
    for label, spec in S.VERTICES.items():
        if labels is None or label in labels:
            df = _stored(spark, spec.schema, vertex_path(root, label),
                         stream_path(root, "vertices", label), held)
            if df is not None:
                g.vertices[label] = df
            _open_search(spark, g, root, label, held)
    for label, spec in S.EDGES.items():
        if labels is None or label in labels:
            df = _stored(spark, spec.schema, edge_path(root, label),
                         stream_path(root, "edges", label), held=held)
            if df is None:
                continue
            g.edges[label] = df
            for direction in NEAR:
                folder = adjacency_path(root, label, direction)
                if current(spark, folder, held):
                    g.adjacency[(label, direction)] = _stored(
                        spark, spec.schema, folder,
                        stream_path(root, f"adjacency/{direction}", label), held=held)
            if current(spark, ids_path(root, label), held):
                streamed = stream_path(root, "ids", label)
                if not session.path_exists(spark, streamed):
                    g.whole.add(label)
                    streamed = None
                g.ids[label] = _stored(spark, edge_ids.contents_schema(label), ids_path(root, label),
                                       streamed, held=held)
    return g


def register_tables(spark: SparkSession, root: str, database: str = "filmgraph") -> list[str]:
    """Register a stored graph in the catalog as ``<database>.v_<label>`` / ``<database>.e_<label>``
    (no data is copied or moved).

    A table without streamed batches becomes an external table over its current version, one with
    streamed batches a view that unites both. With a persistent metastore they outlive the session,
    so SQL users can query the graph by name. Call again after a reload.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    folders = [(f"v_{label.lower()}", vertex_path(root, label),
                stream_path(root, "vertices", label), spec.schema)
               for label, spec in S.VERTICES.items()]
    folders += [(f"e_{label.lower()}", edge_path(root, label), stream_path(root, "edges", label),
                 spec.schema) for label, spec in S.EDGES.items()]
    for table, folder, streamed, schema in folders:
        version = current(spark, folder)
        has_stream = session.path_exists(spark, streamed)
        if not version and not has_stream:
            continue
        parts = [(f"{table}_batch", version)] if version else []
        parts += [(f"{table}_stream", streamed)] if has_stream else []
        if not has_stream:
            parts = [(table, version)]
        else:
            spark.sql(f"DROP VIEW IF EXISTS `{database}`.`{table}`")
        for name, path in parts:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
            spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet",
                                      schema=schema, recursiveFileLookup="true")
        if has_stream:
            spark.sql(f"CREATE VIEW `{database}`.`{table}` AS " + " UNION ALL ".join(
                f"SELECT * FROM `{database}`.`{name}`" for name, _ in parts))
        names.append(f"{database}.{table}")
    return names
