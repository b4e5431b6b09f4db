"""Mixing sources to target weights by hash-threshold histograms.

Each document gets a fixed hash; a source that is to give ``r`` of its ``S`` words once more takes
the documents whose hash lies below a threshold. The threshold is found without sorting: words are
summed by source and hash bucket, the bucket in which the running sum crosses the budget is
located, and only that boundary bucket is split again by the next hash bits, level by level. The
result is one threshold per source, so the final pass is a filter. Budgets are nested by
construction: a larger budget takes a superset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

# Fixed values of the contract: weights repeat over the sources in code point order, null last;
# no document counts more than MAX_REPEAT times.
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
# The hash has HASH_BITS bits, consumed LEVEL_BITS at a time.
HASH_BITS = 48
LEVEL_BITS = 12


def unit_hash(doc_id: Column) -> Column:
    """48 leading bits of md5 of the id as text (a null id hashes as the text 'null')."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Targets by water filling over ``sizes(source, source_size)``.

    Sources in order of ``cap / weight`` reach their cap first; the others share what is left by
    weight. One row per source: the windows below run over sources, not documents.
    """
    n = len(weights)
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (place % n + 1).cast("int"))
    s = (sizes.withColumn("place", place).withColumn("weight", weight)
         .withColumn("cap", (max_repeat * F.col("source_size")).cast("double")))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place"))
    every = Window.partitionBy()
    s = (s.withColumn("capped_before", F.coalesce(
            F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("weight_left", F.sum("weight").over(
            by_fill.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("all_words", F.sum("source_size").over(every).cast("double")))
    level = (F.col("all_words") - F.col("capped_before")) / F.col("weight_left")
    # A source is below its cap if the level of those not yet capped leaves room; once one
    # source in fill order is open all later ones are, at the same level.
    s = s.withColumn("level", F.when(level <= F.col("cap") / F.col("weight"), level))
    s = s.withColumn("open_level", F.first("level", ignorenulls=True).over(
        by_fill.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.when(F.col("open_level").isNotNull(),
                    F.least("cap", F.col("open_level") * F.col("weight"))).otherwise(F.col("cap"))
    return s.select("source", "source_size", target.alias("target"))


def _thresholds(hashed: DataFrame, budgets: DataFrame) -> DataFrame:
    """``(sid, cut)``: of each source the documents with ``h < cut`` come nearest to its budget."""
    state = budgets.select("sid", F.col("budget"), F.lit(0).cast("long").alias("prefix"))
    shift = HASH_BITS
    while shift > 0:
        shift -= LEVEL_BITS
        state = common.bounded(state)
        inside = hashed.join(state.withColumnRenamed("prefix", "p"), "sid").filter(
            F.shiftright("h", shift + LEVEL_BITS) == F.col("p"))
        sums = (inside.groupBy("sid", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("words")))
        run = Window.partitionBy("sid").orderBy("bucket")
        upto = F.sum("words").over(run)
        sums = (sums.withColumn("upto", upto).join(state, "sid")
                .withColumn("before", F.col("upto") - F.col("words")))
        # the first bucket in which the running sum reaches the budget
        crossed = (sums.filter("upto >= budget").groupBy("sid")
                   .agg(F.min_by(F.struct("bucket", "before", "words", "budget"),
                                 "bucket").alias("c")).select("sid", "c.*"))
        found = common.written(crossed, "boundary")
        state = found.select("sid", (F.col("budget") - F.col("before")).alias("budget"),
                             F.col("bucket").alias("prefix"))
    # a bucket is now a single hash: take it whole if that comes nearer to the budget
    near = F.col("budget") - F.col("before") > F.col("words") / 2
    return found.select("sid", (F.col("bucket") + F.when(near, 1).otherwise(0)).alias("cut"))


def mix(docs: DataFrame, out: str, text: str = "text", source: str = "source",
        doc_id: str = "doc_id", weights: tuple = WEIGHTS,
        max_repeat: int = MAX_REPEAT, size: str | None = None) -> DataFrame:
    """``docs`` with a struct column ``out``: size, source_size, target, repeats, taken.

    Words are counted once for the plan, and once more for ``size`` and ``taken`` if these are used. A
    written table with a column of sizes, named by ``size``, is not counted at all.

    A null or empty text has size 0 and takes nothing, null sources form a source of their own
    (last), a null id has a hash like any other; rows with equal ids share their hash and are taken
    together, so they stay together. An empty table gives an empty result. Tables with a row per
    source are broadcast after their rows were counted, else joined by a shuffle.
    """
    words = common.word_count(F.col(text)) if size is None else F.coalesce(
        F.col(size).cast("long"), F.lit(0))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string")
                         .alias("source"), words.alias("size"))
    if size is None:
        narrow = common.written(narrow, "sizes")
    cuts = plan(narrow, weights, max_repeat)
    own = docs.withColumn(out, F.struct(unit_hash(F.col(doc_id)).alias("h"),
                                        sid(F.col(source).cast("string")).alias("sid")))
    cut = common.bounded(cuts).select(F.struct("*").alias("_plan"))
    joined = own.join(cut, F.col(f"{out}.sid") == F.col("_plan.sid"))
    repeats = F.col("_plan.whole") + F.when(
        F.col(f"{out}.h") < F.col("_plan.cut"), 1).otherwise(0)
    return joined.withColumn(out, F.struct(
        words.alias("size"), F.col("_plan.source_size").alias("source_size"),
        F.col("_plan.target").alias("target"), repeats.cast("long").alias("repeats"),
        (words * repeats).cast("long").alias("taken"))).drop("_plan")


def sid(source: Column) -> Column:
    """Source as a join key that also matches null (a null cannot start with 's')."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))


def plan(narrow: DataFrame, weights: tuple, max_repeat: int) -> DataFrame:
    """One written row per source: sid, source_size, target, whole repeats, hash cut."""
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeat)
    # whole repeats first; what is left of the target is the budget of the threshold
    whole = F.when(F.col("source_size") > 0, F.least(
        F.floor(F.col("target") / F.col("source_size")), F.lit(max_repeat))).otherwise(0)
    targets = common.written(targets.select(
        sid(F.col("source")).alias("sid"), "source_size", "target", whole.cast("long")
        .alias("whole")), "targets")
    budgets = targets.select("sid", (F.col("target") - F.col("whole") * F.col("source_size"))
                             .alias("budget")).filter("budget > 0")
    hashed = narrow.filter("size > 0").select(
        sid(F.col("source")).alias("sid"), unit_hash(F.col("doc_id")).alias("h"), "size")
    cuts = _thresholds(hashed, budgets)
    return common.written(targets.join(cuts, "sid", "left").select(
        "sid", "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut")), "plan")
