"""A training-data pipeline over ``documents``: five stages, each a written table for the next.

Quality classifier -> quality rules -> near-duplicate removal -> mixing -> packing. All stages but
the last return the columns of their input; the last returns the pieces of the packed sequences.
Extra columns pass through whatever their names; empty tables stay empty; what each stage does with
nulls and repeated rows is stated with its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgraph.llm import common, entry, line_rules, minhash, mix, pack, pu_quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents scored below the threshold (empty texts are scored like any other)."""
    common.configure(spark)
    model = entry.quality_model(spark, docs, sf_dir)
    score = common.free_name(docs, "pu_score")
    return (pu_quality.score(docs, model, score)
            .filter(F.col(score) >= pu_quality.Training().threshold).drop(score))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that fail the base counts or lose too much text to the line rules, and
    leaves out the failing lines of the others (``n_chars`` follows the text)."""
    common.configure(spark)
    name = common.free_name(docs, "line_verdict")
    judged = line_rules.judge(docs, name, with_cleaned=True).filter(F.col(f"{name}.kept"))
    changed = F.col(f"{name}.lost_chars") > 0
    text = F.when(changed, F.col(f"{name}.cleaned")).otherwise(F.col("text"))
    out = judged.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(
            F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near duplicates."""
    common.configure(spark)
    return minhash.keep_one(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (not at all, or up to three times)."""
    common.configure(spark)
    name = common.free_name(docs, "mix_plan")
    n = common.free_name(docs, "mix_copy")
    # only the repeats are used, so no word is counted again
    mixed = mix.mix(docs, name).withColumn(name, F.col(f"{name}.repeats").cast("int"))
    copies = mixed.filter(F.col(name) > 0).withColumn(n, F.explode(F.sequence(
        F.lit(1), F.col(name))))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences that each show the mixture of the stage before."""
    common.configure(spark)
    return pack.pack(docs, pack.Packing(with_ids=False))


STAGES = [("quality classifier", quality_classifier), ("quality rules", quality_rules),
          ("near duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

# The classifier and the tokenizer have no SQL form; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again by the next; the tables
    behind a stage are released when its rows are written."""
    common.configure(spark)
    docs = common.table(spark, sf_dir, "documents")
    common.scratch_start()
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        common.release(spark, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
