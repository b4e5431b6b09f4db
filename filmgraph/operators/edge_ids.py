"""Identity of edges.

Edges are a multiset without a key, so an edge is named by what it holds: ``<LABEL>:<content>:<ordinal>``, the
content being a hash over both endpoints and all properties, the ordinal its place among equal edges, from 0.
Equal edges cannot be told apart, so which of them has which ordinal does not matter: k copies have the
ordinals 0 to k-1. Ids therefore follow from the counts of the contents, which tasks add up before the
shuffle. No window runs over the copies of an edge, and the same edges get the same ids in every load.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

# Copies of one edge that a task numbers at once.
CHUNK = 100_000
HASH, COPIES = "content", "copies"
ID = "edge_id"


def content_hash(label: str) -> Column:
    """128-bit hash, as text, of an edge's columns. Each is written with its length, so no two edges share a
    text; floats are written as doubles, zero without its sign."""
    parts = []
    for f in S.EDGES[label].schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(c == 0, F.lit(0.0)).otherwise(c.cast("double"))
        c = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")))
    return F.md5(F.concat(*parts).cast("binary"))


def copies(edges: DataFrame, label: str) -> DataFrame:
    """Distinct edges with their number of copies."""
    return edges.groupBy(*S.EDGES[label].schema.fieldNames()).agg(F.count(F.lit(1)).alias(COPIES))


def hashed(counted: DataFrame, label: str) -> DataFrame:
    """``copies`` with the hash of each edge."""
    return counted.select(content_hash(label).alias(HASH), COPIES, *S.EDGES[label].schema.fieldNames())


def contents(edges: DataFrame, label: str) -> DataFrame:
    """Distinct edges with their hash and number of copies."""
    return hashed(copies(edges, label), label)


def contents_schema(label: str) -> T.StructType:
    return T.StructType([T.StructField(HASH, T.StringType()), T.StructField(COPIES, T.LongType()),
                         *S.EDGES[label].schema.fields])


def _id(label: str, ordinal: Column) -> Column:
    return F.concat(F.lit(label + ":"), F.col(HASH), F.lit(":"), ordinal.cast("string"))


def numbered(held: DataFrame, label: str) -> DataFrame:
    """Every edge of ``contents`` with its id. Many copies of an edge are numbered by several tasks."""
    columns = S.EDGES[label].schema.fieldNames()

    def listed(rows: DataFrame, low: Column, high: Column) -> DataFrame:
        return rows.select(HASH, *columns, F.explode(F.sequence(low, high)).alias("_o")).select(
            _id(label, F.col("_o")).alias(ID), *columns)

    few = listed(held.where(F.col(COPIES) <= CHUNK), F.lit(0).cast("long"), F.col(COPIES) - 1)
    chunks = held.where(F.col(COPIES) > CHUNK).select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col(COPIES) - 1) / CHUNK))).alias("_chunk"))
    low = F.col("_chunk") * CHUNK
    many = listed(chunks.repartition(HASH, "_chunk"), low,
                  F.least(low + (CHUNK - 1), F.col(COPIES) - 1))
    return few.unionByName(many)


def parsed(ids: DataFrame, label: str) -> DataFrame:
    """``edge_id, content, ordinal`` of the well-formed ids of a label among ``ids`` (first column)."""
    text = F.col(ids.columns[0]).cast("string")
    form = rf"^{label}:([0-9a-f]{{32}}):(0|[1-9][0-9]{{0,17}})$"
    return ids.select(text.alias(ID)).where(text.rlike(form)).distinct().select(
        ID, F.regexp_extract(ID, form, 1).alias(HASH),
        F.regexp_extract(ID, form, 2).cast("long").alias("_ordinal"))


def found(ids: DataFrame, held: DataFrame, label: str) -> DataFrame:
    """The edges that the parsed ``ids`` name among the contents ``held``: ids whose ordinal is beyond the
    number of copies name nothing. Contents may come in several parts (batch and streams)."""
    columns = S.EDGES[label].schema.fieldNames()
    whole = held.groupBy(HASH, *columns).agg(F.sum(COPIES).alias(COPIES))
    return ids.join(whole, HASH).where(F.col("_ordinal") < F.col(COPIES)).select(ID, *columns)


def as_rows(spark, ids: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(i,) for i in dict.fromkeys(ids)], f"{ID} string")
