"""Helpers the operators of this package share."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..operators import sizing

# Fixed value: a word is a run without space, tab, line feed, vertical tab, form feed or return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_AZ = str.maketrans(_UPPER, _UPPER.lower())

# Rows handed to a Python worker at once: texts may be long, so batches stay short.
BATCH_ROWS = 200
BATCH_BYTES = 8 << 20
# Texts are long: rows that the Parquet reader holds at once, and bytes that its writer collects.
READER_ROWS = 256
WRITER_BYTES = 16 << 20
# A lookup row whose key covers more than 1/HOT_SHARE of all rows is hot: fewer than HOT_SHARE
# such keys can exist, so they are always few enough to broadcast.
HOT_SHARE = 1000
FILE_ROWS = 500_000


def configure(spark: SparkSession) -> SparkSession:
    """Session settings, short Arrow batches included (idempotent)."""
    session.configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scratch: list[str] = []          # folders written by this process and not yet released


def written(df: DataFrame, name: str, rows: int | None = None,
            per_file: int = FILE_ROWS) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch area and continue from that copy.

    Cuts the lineage and keeps the work done when an executor is lost later on. Where at most
    ``rows`` rows are known to come, they go to a file for each ``per_file`` of them, not to one for
    each shuffle partition.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(1 + rows // per_file)
    path = session.new_scratch(spark, name)
    (df.write.option("compression", "zstd").option("parquet.block.size", str(WRITER_BYTES))
     .parquet(path))
    _scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_start() -> None:
    """Forget earlier scratch tables: other results may still read them, so they are not this
    job's to release."""
    _scratch.clear()


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete the scratch tables written so far, but for the last ``keep``. Call it once the results
    that read them have been written."""
    gone = _scratch[:len(_scratch) - keep]
    del _scratch[:len(gone)]
    for path in gone:
        session.delete_folder(spark, path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (0 for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def id_text(doc_id: Column) -> Column:
    """An id on its way to a Python worker. As a number it would turn into a double wherever a batch
    holds a null, and ids above 2^53 would change."""
    return doc_id.cast("long").cast("string")


def ids_from(texts) -> pd.arrays.IntegerArray:
    """Nullable 64-bit ids from what ``id_text`` sent."""
    none = np.fromiter((not isinstance(t, str) for t in texts), dtype=bool, count=len(texts))
    own = np.fromiter((int(t) if isinstance(t, str) else 0 for t in texts), dtype=np.int64,
                      count=len(texts))
    return pd.arrays.IntegerArray(own, none)


def word_count(text: Column) -> Column:
    """Number of words, counted without building them (a null text has none)."""
    starts = F.regexp_count(text, F.lit(WORD_PATTERN))
    return F.coalesce(starts, F.lit(0)).cast("long")


def lower_az(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def lowered_words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER_AZ)) if text else []


def crc32_u4(ids) -> int:
    """crc32 of a numpy integer array written as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def bounded(df: DataFrame, limit: int = 500_000) -> DataFrame:
    """A written side, hinted for broadcast if measured within ``limit`` rows and the library's limit
    of bytes; beyond them the join shuffles."""
    return sizing.for_join(sizing.measure(df), limit)


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: list[str], count: str,
                total: int) -> DataFrame:
    """Inner join of ``rows`` with a table unique by ``keys``, safe against hot keys.

    ``lookup[count]`` says how many of the ``total`` rows carry the key. Keys above a
    1/HOT_SHARE share are broadcast (fewer than HOT_SHARE of them can exist); what is left has no
    hot key and is joined by a shuffle. ``lookup`` should be a written table: it is read twice.
    """
    limit = max(total // HOT_SHARE, 1000)
    hot = lookup.filter(F.col(count) > limit)
    rest = lookup.filter(F.col(count) <= limit)
    by_broadcast = rows.join(F.broadcast(hot), keys)
    marks = F.broadcast(hot.select(*keys))
    by_shuffle = rows.join(marks, keys, "left_anti").join(rest, keys)
    return by_broadcast.unionByName(by_shuffle)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(node, component)`` per node that has
    an edge, ``component`` being the smallest node reachable.

    Alternating star contraction: every round first hangs each node's larger neighbours under its
    smallest neighbour, then its smaller ones; hubs are pre-aggregated and joined by broadcast, and
    each round is cut by a written table. Ends when a round leaves the edges as they are
    (logarithmically many rounds; more than ``max_rounds`` raises, nothing is cut short).
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .filter("u <> v").distinct(), "edges")
    state = _fingerprint(e)
    for _ in range(max_rounds):
        n = state[0]
        if n == 0:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"),
                                                 F.count("*").alias("n")), "star", 2 * n)
        large = (lookup_join(both.filter("v > u"), smallest, ["u"], "n", 2 * n)
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = written(large, "edges", n)
        least = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")),
                        "star", n)
        moved = (lookup_join(large, least, ["u"], "n", 2 * n)
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = moved.unionByName(least.select("u", F.col("m").alias("v")))
        e = written(small.filter("u <> v").distinct(), "edges", 2 * n)
        after = _fingerprint(e)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError("components: no end after max_rounds rounds")
    tree = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return tree.unionByName(roots)


def _fingerprint(e: DataFrame) -> tuple:
    row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
