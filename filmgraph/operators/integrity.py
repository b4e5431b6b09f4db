"""Graph constraints: unique keys (V1) and edge endpoints that must exist (V2).

Both checks work on *distinct key sets*, never on the edge rows themselves: the edge table's key
column is aggregated map-side (a movie holding a third of all ratings becomes one row per task),
then compared with the vertex keys. In the usual case nothing is missing and the edge table
flows to its sink untouched - no join over the big table at all. Only when violations exist does
a quarantine split join the edges with the (materialised, counted) violating keys: broadcast
within the row limit of :mod:`filmgraph.operators.sizing`, a shuffled join beyond it.

Modes: ``"fail"`` raises :class:`IntegrityError` with a bounded sample of offending keys;
``"quarantine"`` returns the offending rows separately with the reason in ``_error``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.dataset import ERROR_COL
from . import sizing

SAMPLE = 20


class IntegrityError(ValueError):
    """A unique or referential constraint does not hold."""


@dataclass
class Checked:
    accepted: DataFrame
    rejected: DataFrame      # the input columns plus ``_error``


def _no_rejects(df: DataFrame) -> DataFrame:
    return df.limit(0).withColumn(ERROR_COL, F.lit(None).cast("string"))


def _flag(df: DataFrame, col: str, keys: sizing.Sized, tag: str) -> DataFrame:
    """Left-join a distinct key set (column ``col``) as a boolean flag column ``tag``."""
    side = sizing.for_join(sizing.Sized(
        keys.df.select(F.col(col).alias(f"{tag}_key"), F.lit(True).alias(tag)), keys.rows))
    return (df.join(side, df[col].eqNullSafe(side[f"{tag}_key"]), "left")
            .drop(f"{tag}_key"))


def _first_violations(checks: list[DataFrame]) -> list[list]:
    """Up to ``SAMPLE`` offending rows of each check; the checks run as concurrent jobs."""
    with ThreadPoolExecutor(max_workers=max(1, len(checks))) as pool:
        return list(pool.map(lambda df: df.limit(SAMPLE).collect(), checks))


def _split(flagged: DataFrame, reasons: list) -> Checked:
    err = F.nullif(F.concat_ws("; ", *reasons), F.lit(""))
    tags = [c for c in flagged.columns if c.startswith("_flag")]
    out = flagged.withColumn(ERROR_COL, err).drop(*tags)
    return Checked(out.where(F.col(ERROR_COL).isNull()).drop(ERROR_COL),
                   out.where(F.col(ERROR_COL).isNotNull()))


# ---------------------------------------------------------------- V1 unique keys

def duplicate_keys(df: DataFrame, key: str, nulls_allowed: bool = False) -> DataFrame:
    """Keys held by more than one row, and the null key if present (unless allowed): ``key, n``."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    if nulls_allowed:
        return per_key.where((F.col("n") > 1) & F.col(key).isNotNull())
    return per_key.where((F.col("n") > 1) | F.col(key).isNull())


def unique_report(df: DataFrame, label: str, props: list[str]) -> DataFrame:
    """A row per unique index of a label: ``label, property, n_rows, n_null, n_keys, n_duplicated``.

    All properties are stacked and counted in one pass over the table.
    """
    stacked = df.select(F.explode(F.array(*[F.struct(
        F.lit(p).alias("property"), F.col(p).cast("string").alias("value"))
        for p in props])).alias("s")).select("s.*")
    per_key = stacked.groupBy("property", "value").agg(F.count(F.lit(1)).alias("n"))
    found = per_key.groupBy("property").agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
        .cast("bigint").alias("n_null"),
        F.count("value").alias("n_keys"),
        F.count_if(F.col("value").isNotNull() & (F.col("n") > 1)).alias("n_duplicated"))
    wanted = df.sparkSession.createDataFrame([(p,) for p in props], "property string")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
              for c in ("n_rows", "n_null", "n_keys", "n_duplicated")]
    return F.broadcast(wanted).join(found, "property", "left").select(
        F.lit(label).alias("label"), "property", *counts)


def enforce_unique(df: DataFrame, keys: list[str] | str, mode: str = "fail",
                   label: str = "vertex", nulls_allowed: bool = False) -> Checked:
    """V1: every key property identifies at most one row and is never null (unless allowed).

    ``quarantine`` first collapses identical rows: copies of one row hold one key once.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if mode == "fail":
        found = _first_violations([duplicate_keys(df, key, nulls_allowed) for key in keys])
        for key, sample in zip(keys, found):
            if sample:
                total = duplicate_keys(df, key, nulls_allowed).count()
                shown = ", ".join(f"{r[key]!r} x{r['n']}" for r in sample)
                raise IntegrityError(f"{label}.{key} is not unique ({total} keys): {shown}")
        return Checked(df, _no_rejects(df))
    if not any(_first_violations([duplicate_keys(df, key, nulls_allowed) for key in keys])):
        return Checked(df, _no_rejects(df))
    df = df.dropDuplicates()
    flagged, reasons = df, []
    for i, key in enumerate(keys):
        dups = sizing.materialize(duplicate_keys(df, key, nulls_allowed).select(key))
        if dups.rows:
            flagged = _flag(flagged, key, dups, f"_flag{i}")
            reasons.append(F.when(F.col(f"_flag{i}"), F.lit(f"duplicate or null {key}")))
    return _split(flagged, reasons) if reasons else Checked(df, _no_rejects(df))


# ---------------------------------------------------------------- V2 endpoints exist

def absent_keys(keys: DataFrame, col: str, table: DataFrame, key: str,
                small: bool = False) -> DataFrame:
    """Distinct ``keys[col]`` values not present as ``table[key]`` (null counts as absent).

    With ``small=True`` the key set is size-checked first: a few keys against a large table (a
    micro-batch against all vertices) stream the table against the broadcast keys and anti-join
    only the matches, instead of shuffling the whole key column of the table.
    """
    used = keys.select(col).distinct()
    known = table.select(F.col(key).alias(col)).where(F.col(col).isNotNull())
    if small:
        sized = sizing.materialize(used)
        if sized.rows <= sizing.BROADCAST_ROW_LIMIT:
            used = sized.df
            known = known.join(F.broadcast(used), col).distinct()
    return used.join(known, col, "left_anti")


def dangling_keys(edges: DataFrame, col: str, vertices: DataFrame, key: str,
                  small: bool = False) -> DataFrame:
    """Distinct values of ``edges[col]`` with no vertex of key ``key`` (null counts as missing)."""
    return absent_keys(edges, col, vertices, key, small)


def reference_report(edges: DataFrame, label: str, col: str, vertices: DataFrame,
                     key: str) -> DataFrame:
    """One row: ``label, endpoint, n_edges, n_dangling_edges, n_dangling_keys``."""
    per_key = edges.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    known = vertices.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct() \
        .withColumn("_known", F.lit(True))
    joined = per_key.join(known, F.col(col) == F.col("_key"), "left")
    missing = F.col("_known").isNull()
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_edges"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).cast("bigint")
        .alias("n_dangling_edges"),
        F.count_if(missing).alias("n_dangling_keys"),
    ).select(F.lit(label).alias("label"), F.lit(col).alias("endpoint"), "*")


def references_report(edges: dict[str, tuple[DataFrame, list[tuple[str, str]]]],
                      vertices: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """:func:`reference_report` for all endpoints of several edge tables at once.

    ``edges`` maps an edge label to its table and its ``(endpoint column, vertex label)`` pairs,
    ``vertices`` a vertex label to its table and key. Each endpoint column is read and counted by itself
    in its own type, so that tasks hold and send a key and a number per distinct key; the vertex keys,
    which several endpoints share, are shuffled once per label.
    """
    rows = [reference_report(df, label, c, vertices[target][0], vertices[target][1])
            for label, (df, ends) in edges.items() for c, target in ends]
    return reduce(DataFrame.unionByName, rows)


def enforce_references(edges: DataFrame, checks: list[tuple[str, DataFrame, str]],
                       mode: str = "fail", label: str = "edge", small: bool = False) -> Checked:
    """V2: for each ``(column, vertex table, vertex key)`` every edge endpoint must exist.

    ``small=True`` when the edges are few compared with the vertices (see :func:`absent_keys`).
    """
    if mode == "fail":
        found = _first_violations([dangling_keys(edges, col, vertices, key, small)
                                   for col, vertices, key in checks])
        for (col, _, _), sample in zip(checks, found):
            if sample:
                vertices, key = next((v, k) for c, v, k in checks if c == col)
                total = dangling_keys(edges, col, vertices, key, small).count()
                shown = ", ".join(repr(r[col]) for r in sample)
                raise IntegrityError(
                    f"{label}.{col} refers to missing vertices ({total} keys): {shown}")
        return Checked(edges, _no_rejects(edges))
    flagged, reasons = edges, []
    for i, (col, vertices, key) in enumerate(checks):
        missing = sizing.materialize(dangling_keys(edges, col, vertices, key, small))
        if missing.rows:
            flagged = _flag(flagged, col, missing, f"_flag{i}")
            reasons.append(F.when(F.col(f"_flag{i}"), F.lit(f"no vertex for {col}")))
    return _split(flagged, reasons) if reasons else Checked(edges, _no_rejects(edges))
