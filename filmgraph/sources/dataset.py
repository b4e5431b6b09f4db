"""Readers for the film dataset directory (S1-S9) and the API-answer sink.

A dataset root holds fixed file names (``movies.csv``, ``ratings.csv``, ``genome-tags.csv``,
``genome-scores.csv``, ``links.csv``, ``omdb-json/``). CSV columns are matched to the declared
record by header *name* (like a typed encoder), then converted with the declared types; no schema
inference pass runs. Quoting follows RFC 4180 (a quote inside a quoted field is doubled).

Bad rows are handled by ``mode``:

* ``"fail"`` (default) - the job stops at the first row whose value cannot be converted or
  whose required field is missing;
* ``"quarantine"`` - such rows, and lines with too few or too many fields, are kept with a
  non-null ``_error`` column and the values as they were read in ``_raw`` (the whole line where it
  did not split into the declared fields); split them off with :func:`accepted` / :func:`rejected`.

Every file of a folder must have the header of the first one: a file with other columns, or the
same in another order, stops the read in both modes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

ERROR_COL = "_error"
RAW_COL = "_raw"
_CORRUPT = "_corrupt_record"

# RFC 4180 CSV; leading/trailing blanks are data (titles carry padding the parser must trim).
CSV_READ = {"header": "true", "sep": ",", "quote": '"', "escape": '"',
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_WRITE = {**CSV_READ}


@dataclass(frozen=True)
class InputSpec:
    file: str
    schema: T.StructType
    required: tuple[str, ...]
    fmt: str = "csv"


# Required fields are the record fields that are not optional.
INPUTS: dict[str, InputSpec] = {
    "movies": InputSpec(S.DATASET_FILES["movies"], S.MOVIES, ("movieId", "title", "genres")),
    "ratings": InputSpec(S.DATASET_FILES["ratings"], S.RATINGS,
                         ("userId", "movieId", "rating", "timestamp")),
    "genome_tags": InputSpec(S.DATASET_FILES["genome_tags"], S.GENOME_TAGS, ("tagId", "tag")),
    "genome_scores": InputSpec(S.DATASET_FILES["genome_scores"], S.GENOME_SCORES,
                               ("movieId", "tagId", "relevance")),
    "links": InputSpec(S.DATASET_FILES["links"], S.LINKS, ("movieId", "imdbId")),
    "omdb": InputSpec(S.DATASET_FILES["omdb"], S.OMDB_RESPONSES, ("movieId", "imdbId"), "json"),
}


def dataset_path(root: str, name: str) -> str:
    """Path of one input below a dataset root (plain join, works on object stores)."""
    return root.rstrip("/") + "/" + INPUTS[name].file


def conform(df: DataFrame, schema: T.StructType, required: tuple[str, ...] = (),
            mode: str = "fail") -> DataFrame:
    """Select the declared fields by name and convert them to the declared types.

    A value that does not convert, or a missing required field, is an error for the row: raised
    in ``fail`` mode, recorded in ``_error`` in ``quarantine`` mode.
    """
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    have = {f.name: f.dataType for f in df.schema.fields}
    absent = [f.name for f in schema.fields if f.name not in have]
    if absent:
        raise ValueError(f"input lacks column(s) {absent}; has {sorted(have)}")
    values, problems = [], []
    corrupt = F.col(_CORRUPT) if _CORRUPT in have else F.lit(None).cast("string")
    if _CORRUPT in have:
        problems.append(F.when(corrupt.isNotNull(), F.lit("malformed line")))
    for f in schema.fields:
        raw = F.col(f.name)
        value = raw if have[f.name] == f.dataType else raw.try_cast(f.dataType)
        if have[f.name] != f.dataType:
            problems.append(F.when(corrupt.isNull() & raw.isNotNull() & value.isNull(),
                                   F.lit(f"bad {f.name}")))
        if f.name in required:
            problems.append(F.when(corrupt.isNull() & raw.isNull(), F.lit(f"missing {f.name}")))
        values.append(value.alias(f.name))
    error = F.nullif(F.concat_ws("; ", *problems), F.lit("")) if problems else F.lit(None)
    error = error.cast("string")
    if mode == "quarantine":
        fields = F.to_json(F.struct(*[F.col(f.name) for f in schema.fields]))
        raw = F.when(error.isNotNull(), F.coalesce(corrupt, fields))
        return df.select(*values, error.alias(ERROR_COL), raw.alias(RAW_COL))
    return raise_on_error(df.select(*values, error.alias(ERROR_COL))).drop(ERROR_COL)


def raise_on_error(df: DataFrame, what: str = "input row") -> DataFrame:
    """Keep rows without ``_error``; stop the job at the first row that has one."""
    err = F.col(ERROR_COL)
    ok = F.when(err.isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"bad {what}: "), err)).cast("boolean"))
    return df.where(ok)


def accepted(df: DataFrame) -> DataFrame:
    """Rows of a quarantine-mode read that converted cleanly (``_error`` dropped)."""
    return df.where(F.col(ERROR_COL).isNull()).drop(ERROR_COL, RAW_COL)


def rejected(df: DataFrame) -> DataFrame:
    """Rows of a quarantine-mode read that failed, with the reason in ``_error`` and what was read
    in ``_raw``."""
    return df.where(F.col(ERROR_COL).isNotNull())


def read_input(spark: SparkSession, path: str, name: str, mode: str = "fail") -> DataFrame:
    """Read one dataset input from an explicit path."""
    spec = INPUTS[name]
    if spec.fmt == "csv":
        names = spark.read.options(**CSV_READ).csv(path).columns      # header of the first file
        fields = [T.StructField(n, T.StringType(), True) for n in names]
        # enforceSchema=false: every file's own header must match, it is not just skipped
        reader = spark.read.options(**CSV_READ, enforceSchema="false")
        if mode == "fail":
            raw = reader.option("mode", "FAILFAST").schema(T.StructType(fields)).csv(path)
        else:
            fields.append(T.StructField(_CORRUPT, T.StringType(), True))
            raw = (reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT,
                                  columnPruning="false").schema(T.StructType(fields)).csv(path))
    else:
        # Declared schema - if no answer was ever fetched the writer omits the field and an
        # inferred schema would lose the column. Sub-folders hold later fetch batches.
        raw = (spark.read.schema(spec.schema).option("recursiveFileLookup", "true")
               .option("mode", "FAILFAST" if mode == "fail" else "PERMISSIVE")
               .json(path))
    return conform(raw, spec.schema, spec.required, mode)


def read_movies(spark: SparkSession, root: str, mode: str = "fail") -> DataFrame:
    """``movies.csv`` -> movieId bigint, title, genres."""
    return read_input(spark, dataset_path(root, "movies"), "movies", mode)


def read_ratings(spark: SparkSession, root: str, mode: str = "fail") -> DataFrame:
    """``ratings.csv`` -> userId, movieId, rating double, timestamp (epoch seconds)."""
    return read_input(spark, dataset_path(root, "ratings"), "ratings", mode)


def read_genome_tags(spark: SparkSession, root: str, mode: str = "fail") -> DataFrame:
    """S3: ``genome-tags.csv`` -> tagId, tag."""
    return read_input(spark, dataset_path(root, "genome_tags"), "genome_tags", mode)


def read_genome_scores(spark: SparkSession, root: str, mode: str = "fail") -> DataFrame:
    """``genome-scores.csv`` -> movieId, tagId, relevance."""
    return read_input(spark, dataset_path(root, "genome_scores"), "genome_scores", mode)


def read_links(spark: SparkSession, root: str, mode: str = "fail") -> DataFrame:
    """``links.csv`` -> three strings (imdbId keeps its leading zeros)."""
    return read_input(spark, dataset_path(root, "links"), "links", mode)


def read_omdb_responses(spark: SparkSession, root: str, mode: str = "fail") -> DataFrame:
    """``omdb-json/`` -> movieId, imdbId, response (raw JSON text or null)."""
    return read_input(spark, dataset_path(root, "omdb"), "omdb", mode)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a table in the dataset's CSV dialect (header, RFC 4180 quoting, blanks kept)."""
    df.write.mode(mode).options(**CSV_WRITE).csv(path)


def write_omdb_responses(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON-lines sink for landed API answers; by default refuses an existing path."""
    df.select([F.col(f.name) for f in S.OMDB_RESPONSES.fields]).write.mode(mode).json(path)

