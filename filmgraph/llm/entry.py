"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (common, fim, langid, line_rules, lm, metric_join, minhash, mix, pack, pfor,
               pu_quality, spelling, url_rules, warc)


def op1_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line-first verdict of every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_rules.judge(docs, "q").select("doc_id", "q.*")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed and mined URL rules on every page."""
    pages = common.table(spark, sf_dir, "pages")
    labels = common.table(spark, sf_dir, "labels")
    return url_rules.judge(pages, url_rules.labelled_urls(pages, labels))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences at the corpus mixture."""
    return pack.pack(common.table(spark, sf_dir, "documents"), pack.Packing(with_ids=False))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives with revisits and read back by the salvage reader."""
    return warc.round_trip(common.table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from the folds that are not held out."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(spark, docs, sf_dir)
    return (pu_quality.score(docs, model, "score")
            .select("doc_id", (common.fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                    (F.col("score") >= pu_quality.Training().threshold).cast("int")
                    .alias("predicted")))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> pu_quality.Model:
    learn = common.fold(F.col("doc_id")) != 0
    labels = common.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return pu_quality.fit(docs.select("doc_id", "text").filter(learn), labels.filter(learn))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the mix of all sources."""
    docs = common.table(spark, sf_dir, "documents")
    sizes = common.written(docs.select("doc_id", "source", common.word_count(F.col("text"))
                                       .alias("size")), "document-sizes")
    return mix.mix(sizes, "m", size="size").select("doc_id", "m.size", "m.source_size",
                                                   "m.target", "m.taken")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents written in id order and read back."""
    return pfor.round_trip(common.table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents and the one that stays of each."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs).drop("cls")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and attention-model scores of all documents."""
    docs = common.table(spark, sf_dir, "documents")
    return lm.score(docs.select("doc_id", "text", (common.fold(F.col("doc_id")) == 1)
                                .alias("held_out")))


def op10_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    return metric_join.near_duplicates(common.table(spark, sf_dir, "embeddings"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle forms of all documents, with the text rebuilt from each output."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fim.transform(docs, "f").select("doc_id", "f.*")
    back = fim.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, usual forms and their roots of all words of the documents."""
    return spelling.group(common.table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from the folds that are not held out."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = common.fold(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.filter(~held_out).select("text", "lang"))
    return (langid.predict(docs.select("doc_id", "text"), model, "p")
            .select("doc_id", held_out.alias("held_out"), F.col("p.lang").alias("lang_pred"),
                    "p.score", "p.accepted"))


QUERIES = {q.__name__: q for q in (
    op1_line_rules, op2_url_rules, op3_packing, op4_warc, op5_pu_quality, op6_mixing,
    op7_token_files, op8_near_duplicates, op9_lm_scoring, op10_metric_join, op11_fill_in_middle,
    op12_spelling_variants, op13_language_id)}
