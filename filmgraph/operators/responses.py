"""Landed API answers -> parsed movie records.

Every landed row gets a status:

* ``unfetched`` - no answer text (F1: dropped, counted nowhere in the original counters);
* ``failure``   - ``"Response": "False"`` as a JSON string (F2: dropped and counted);
* ``malformed`` - not JSON, not an object, no ``Response`` key, a movie id that is not a
  number, or a row the reader rejected (stops a ``fail``-mode load, quarantined otherwise);
* ``ok``        - everything else, parsed into the record fields.

The JSON text is parsed once per row into a VARIANT; all fields are read from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import omdb as J
from ..sources.dataset import ERROR_COL

# Buckets of an entity sketch: 2^14, a standard error of 0.8%.
SKETCH_LG_K = 14
STATUSES = ("ok", "failure", "malformed", "unfetched")


def classify(responses: DataFrame) -> DataFrame:
    """Add ``status`` and the record fields (null unless ``ok``) to landed answers.

    Three projections: parse the text once; derive the status and pull each answer field out
    once (as a small VARIANT); convert the fields. Each step's outputs are referenced several
    times by the next, so the optimizer keeps them as separate projections instead of repeating
    the work per use.
    """
    # rows a quarantine-mode read already rejected (``_error``) count as malformed
    bad_row = F.col(ERROR_COL).isNotNull() if ERROR_COL in responses.columns else F.lit(False)
    parsed = responses.select(
        F.col("movieId").try_cast("bigint").alias("movieId"), "imdbId", "response",
        bad_row.alias("_bad_row"), J.parse_json("response").alias("_doc"))
    doc = F.col("_doc")
    status = (F.when(F.col("_bad_row"), F.lit("malformed"))
              .when(F.col("response").isNull(), F.lit("unfetched"))
              # no Response key also covers arrays and scalars (they have no keys at all)
              .when(doc.isNull() | ~J.has_response_key(doc) | F.col("movieId").isNull(),
                    F.lit("malformed"))
              .when(J.is_failure(doc), F.lit("failure"))
              .otherwise(F.lit("ok")))
    keys = sorted({key for key, _ in J.ANSWER_FIELDS.values()})
    fields = parsed.select("movieId", "imdbId", "response", status.alias("status"),
                           *[J.json_field(doc, k).alias(f"_f_{k}") for k in keys])
    ok = F.col("status") == "ok"
    return fields.select(
        "movieId", "imdbId", "response", "status",
        *[F.when(ok, convert(J.string_value(F.col(f"_f_{key}")))).alias(name)
          for name, (key, convert) in J.ANSWER_FIELDS.items()])


def current(responses: DataFrame) -> DataFrame:
    """Landed rows without those an answer has made obsolete: a null answer stays only for a link
    that has no other row with an answer, and once."""
    has = F.col("response").isNotNull()
    if ERROR_COL in responses.columns:
        has = has | F.col(ERROR_COL).isNotNull()
    answered = responses.where(has)
    waiting = responses.where(~has).dropDuplicates(["movieId"])
    known = answered.select("movieId").where(F.col("movieId").isNotNull()).distinct()
    return answered.unionByName(waiting.join(known, "movieId", "left_anti"))


def records(classified: DataFrame) -> DataFrame:
    """The ``ok`` rows as parsed movie records (MOVIE_OMDB schema)."""
    ok = classified.where(F.col("status") == "ok")
    have = set(ok.columns)
    return ok.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in S.MOVIE_OMDB.fields])


def rejects(classified: DataFrame) -> DataFrame:
    """Malformed answers, kept for inspection."""
    return classified.where(F.col("status") == "malformed").select("movieId", "imdbId", "response")


def status_counts(classified: DataFrame) -> DataFrame:
    """A5 as a table: ``metric, n`` for parse successes, failures, malformed and unfetched rows."""
    names = {"ok": "parse_successes", "failure": "parse_failures",
             "malformed": "malformed", "unfetched": "unfetched"}
    counts = classified.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    mapping = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return counts.select(mapping[F.col("status")].alias("metric"), "n")


def observe_counts(classified: DataFrame) -> tuple[DataFrame, Observation]:
    """A5 as job metrics: counts collected while the parsed table is written (one pass).

    Unlike an accumulator updated inside a transformation, an observation is reported once per
    successful action, so a retried task cannot count twice.
    """
    obs = Observation("omdb_parsing")
    s = F.col("status")
    observed = classified.observe(
        obs,
        F.count_if(s == "ok").alias("parse_successes"),
        F.count_if(s == "failure").alias("parse_failures"),
        F.count_if(s == "malformed").alias("malformed"),
        F.count_if(s == "unfetched").alias("unfetched"))
    return observed, obs


def entity_counts(credits: DataFrame, approximate: bool = False) -> DataFrame:
    """Per credit kind, distinct raw items (notes included) and distinct parsed names.

    ``credits`` is the exploded credit table (:func:`filmgraph.operators.edges.credit_items`):
    one aggregation answers all ten counts. ``approximate=True`` uses HyperLogLog sketches
    (``approx_count_distinct``, ~1% error) instead of exact distinct sets.
    """
    if approximate:
        return (credits.groupBy("kind")
                .agg(F.approx_count_distinct("item").alias("n_raw"),
                     F.approx_count_distinct("name").alias("n_names")))
    return (credits.groupBy("kind")
            .agg(F.count_distinct("item").alias("n_raw"),
                 F.count_distinct("name").alias("n_names")))


def entity_sketches(credits: DataFrame) -> DataFrame:
    """A6 in a form that adds up over loads: per credit kind, HyperLogLog sketches of the raw items and
    the parsed names (a few KB each)."""
    return credits.groupBy("kind").agg(
        F.hll_sketch_agg("item", SKETCH_LG_K).alias("raw"),
        F.hll_sketch_agg("name", SKETCH_LG_K).alias("names"))


def entity_estimates(sketches: DataFrame) -> DataFrame:
    """Per credit kind the estimated distinct items and names over all loads whose sketches are given.
    A load that is given twice counts once."""
    return sketches.groupBy("kind").agg(
        F.hll_sketch_estimate(F.hll_union_agg("raw")).alias("n_raw"),
        F.hll_sketch_estimate(F.hll_union_agg("names")).alias("n_names"))
