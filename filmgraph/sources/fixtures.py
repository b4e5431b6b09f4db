"""Film-shaped input tables derived from the driver's TPC-H-like tables.

The derivations are the fixed formulas of FIXTURES.md section 3 (the same rules appear as SQL in
the oracle queries). They give every parser edge case at scale: padded titles, titles without a
year or with a year range, trailing separators, duplicate genres, placeholder genres, answers
that failed or were never fetched, a JSON number where a string is expected, money and vote
counts with separators.

``dataset_for`` writes the six inputs once per source folder into the shared folder in the
dataset layout (CSV + JSON lines), so the queries exercise the real file readers.
"""

from __future__ import annotations

import hashlib
import inspect
import threading

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from . import dataset as io

_LOCK = threading.Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(col: Column) -> Column:
    return col.cast("string")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One movie per part; title/genre spelling varies with the key."""
    k = F.col("p_partkey")
    name, year = F.col("p_name"), _s(F.lit(1950) + F.col("p_size"))
    title = (F.when(k % 10 == 0, name)
             .when(k % 10 == 1, F.concat(F.lit("  "), name, F.lit(" ("), year, F.lit(")  ")))
             .when(k % 10 == 2, F.concat(name, F.lit(" (2006-2007)")))
             .otherwise(F.concat(name, F.lit(" ("), year, F.lit(")"))))
    ptype, brand = F.col("p_type"), F.col("p_brand")
    genres = (F.when(k % 7 == 0, F.lit("(no genres listed)"))
              .when(k % 7 == 1, F.concat(F.lit(" "), ptype, F.lit(" | "), brand, F.lit("|")))
              .when(k % 7 == 2, F.concat(ptype, F.lit("|"), ptype))
              .otherwise(F.concat(ptype, F.lit("|"), brand)))
    return table(spark, sf_dir, "part").select(
        k.cast("int").alias("movieId"), title.alias("title"), genres.alias("genres"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per line item; repeated (user, movie) pairs stay separate ratings."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        (F.col("l_quantity") / 10).alias("rating"),
        F.unix_timestamp("l_shipdate").alias("timestamp"))


def genome_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tag per brand."""
    brand = F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        F.expr("substring(p_brand, 7)").cast("int").alias("tagId"), brand.alias("tag")).distinct()


def genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevance per (movie, tag) in [0, 1]."""
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_partkey").cast("int").alias("movieId"),
                     (F.lit(1) + F.col("l_suppkey") % 25).cast("int").alias("tagId"))
            .agg((F.max("l_discount") * 10).alias("relevance")))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        _s(k).alias("movieId"), F.lpad(_s(k), 7, "0").alias("imdbId"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(_s(F.lit(100000) + k)).alias("tmdbId"))


def omdb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed API answers: never fetched (k%11), failed (k%13), or a 25-field-style object."""
    part = table(spark, sf_dir, "part")
    sup = table(spark, sf_dir, "supplier")
    cust = table(spark, sf_dir, "customer")
    nat = table(spark, sf_dir, "nation")
    k, size = F.col("p_partkey"), F.col("p_size")
    lit = F.lit
    s_name = F.col("s_name")
    body = F.concat(
        lit('{"Title":"'), F.col("p_name"),
        lit('","Rated":'), F.when(k % 5 == 0, lit("5")).otherwise(lit('"PG"')),
        lit(',"Director":"'), s_name,
        lit('","Writer":"'), s_name, lit(" (story by), "), s_name, lit(" (screenplay by)"),
        lit('","Actors":"'), F.col("c_name"), lit(", Actor "), _s(k % 17),
        lit('","Language":"'),
        F.when(k % 3 == 0, lit("English, French")).otherwise(lit("English")),
        lit('","Country":"'), F.col("n_name"),
        lit('","BoxOffice":"'),
        F.when(k % 4 == 0, lit("N/A")).otherwise(
            F.concat(lit("$"), _s(lit(1) + size), lit(",000,000"))),
        lit('","Metascore":"'), F.when(k % 6 == 0, lit("N/A")).otherwise(_s(size * 2)),
        lit('","imdbRating":"'), _s(lit(1) + size % 9), lit("."), _s(k % 10),
        lit('","imdbVotes":"'), _s(lit(1) + size), lit(","), F.lpad(_s(k % 1000), 3, "0"),
        lit('","Response":"True"}'))
    response = (F.when(k % 11 == 0, lit(None).cast("string"))
                .when(k % 13 == 0, lit('{"Response":"False","Error":"Incorrect IMDb ID."}'))
                .otherwise(body))
    # credits from real keys, so that names grow with the data: supplier and customer of the part's
    # last line item (a part without one takes fixed ones)
    last = (table(spark, sf_dir, "lineitem")
            .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumn("place", F.col("l_orderkey") * 16 + F.col("l_linenumber"))
            # numbers, not a struct: tasks then aggregate by hash and sort no line items
            .groupBy("l_partkey").agg(F.max_by("l_suppkey", "place").alias("l_suppkey"),
                                      F.max_by("o_custkey", "place").alias("o_custkey")))
    joined = (part.join(last, k == F.col("l_partkey"), "left")
              .join(sup, sup.s_suppkey == F.coalesce("l_suppkey", k % 10))
              .join(cust, cust.c_custkey == F.coalesce("o_custkey", k % 150))
              .join(nat, nat.n_nationkey == k % 25))
    return joined.select(_s(k).alias("movieId"), F.lpad(_s(k), 7, "0").alias("imdbId"),
                         response.alias("response"))


BUILDERS = {
    "movies": movies, "ratings": ratings, "genome_tags": genome_tags,
    "genome_scores": genome_scores, "links": links, "omdb": omdb,
}


def _source_key(spark: SparkSession, sf_dir: str) -> str:
    """Identity of derived inputs: the source folder, name, size and time of its files (asked of the
    file system Spark reads from) and the formulas of this module."""
    h = hashlib.sha1(sf_dir.rstrip("/").encode())
    for name in ("part", "lineitem", "orders", "supplier", "customer", "nation"):
        h.update(f"{name}:{session.file_facts(spark, f'{sf_dir}/{name}.parquet')}".encode())
    for build in BUILDERS.values():
        h.update(inspect.getsource(build).encode())
    return h.hexdigest()[:16]


def write_dataset(spark: SparkSession, sf_dir: str, root: str, mode: str = "errorifexists") -> str:
    """Write the six derived inputs below ``root`` in the dataset layout."""
    for name, build in BUILDERS.items():
        df = build(spark, sf_dir)
        path = io.dataset_path(root, name)
        if name == "omdb":
            io.write_omdb_responses(df, path, mode)
        else:
            io.write_csv(df, path, mode)
    return root


def dataset_for(spark: SparkSession, sf_dir: str) -> str:
    """Dataset root holding the inputs derived from ``sf_dir``; written on first use."""
    root = session.shared_path(spark, "datasets", _source_key(spark, sf_dir))
    marker = root + "/_ready"
    with _LOCK:
        if not session.path_exists(spark, marker):
            write_dataset(spark, sf_dir, root, mode="overwrite")
            spark.createDataFrame([(sf_dir,)], "source string").coalesce(1) \
                .write.mode("overwrite").text(marker)
    return root


# ---------------------------------------------------------------- planted faults

def faulty_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tags, and for ids divisible by 5 a second tag with the same id; id 6 comes twice alike."""
    tags = genome_tags(spark, sf_dir)
    again = tags.where("tagId % 5 = 0").select("tagId", F.concat("tag", F.lit("-b")).alias("tag"))
    return tags.unionByName(again).unionByName(tags.where("tagId = 6"))


def faulty_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links with movie ids that are no numbers (%19), tmdb ids that are no numbers (%23) or
    shared (%41), a second spelling of a movie id (%31), and links of absent movies (%37)."""
    k = F.col("movieId").cast("bigint")
    base = links(spark, sf_dir)
    text = F.when(k % 19 == 0, F.concat(F.lit("x"), "movieId")).otherwise(F.col("movieId"))
    tmdb = (F.when(k % 23 == 0, F.lit("abc")).when(k % 41 == 0, F.lit("5"))
            .otherwise(F.col("tmdbId")))
    spelled = base.where(k % 31 == 0).select(
        F.concat(F.lit("0"), "movieId").alias("movieId"), "imdbId", F.lit("7").alias("tmdbId"))
    absent = base.where(k % 37 == 0).select(
        F.concat("movieId", F.lit("00000000")).alias("movieId"), "imdbId",
        F.lit(None).cast("string").alias("tmdbId"))
    absent = absent.where(F.col("movieId") != "000000000")
    return (base.select(text.alias("movieId"), "imdbId", tmdb.alias("tmdbId"))
            .unionByName(spelled).unionByName(absent))


def faulty_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a ratings file: the rating is no number (user % 13 = 0), or the line has a field
    more (user % 17 = 0) or less (user % 19 = 0), or no movie (user % 23 = 0)."""
    u = F.col("userId")
    movie = F.when(u % 23 == 0, F.lit("")).otherwise(_s(F.col("movieId")))
    rating = F.when(u % 13 == 0, F.lit("bad")).otherwise(_s(F.col("rating")))
    line = F.concat_ws(",", _s(u), movie, rating, _s(F.col("timestamp")))
    line = F.when(u % 17 == 0, F.concat(line, F.lit(",more"))).when(
        u % 19 == 0, F.concat_ws(",", _s(u), movie)).otherwise(line)
    return ratings(spark, sf_dir).select(line.alias("value"))


def write_lines(lines: DataFrame, header: str, path: str) -> str:
    """Text files of ``lines(value)``, each starting with ``header``."""
    def headed(frames):
        yield pd.DataFrame({"value": [header]})
        yield from frames

    lines.mapInPandas(headed, "value string").write.text(path)
    return path
