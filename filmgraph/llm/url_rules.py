"""URL filtering by mined association rules, DataFrame functions only.

Tokens of labelled URLs (domain suffixes, first host label, path segments, extension, query keys,
scheme, fragment) form transactions; Spark's FP-growth finds the combinations on enough blocked
pages, a number that does not depend on the size of the table, and those that imply the block label
with enough confidence become rules, unless a part of them is a rule already.

Tokens that lie on the same labelled pages say the same, so they are merged into one class before
mining, by a hash of their pages, and a rule is a set of classes. Classes that are rules alone take
no part in FP-growth. Without this, a dozen path segments shared by a few pages would give thousands
of combinations. Rules are matched through an inverted index rarest class -> rule: a rule fires on a
URL that holds a token of each of its classes. An explicit rule list (host and path prefix) takes
precedence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Fixed values of the contract: (verdict, host, path).
LIST_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
              ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
BLOCK = 0                         # the label among the classes of a transaction


@dataclass(frozen=True)
class Mining:
    """A rule holds on at least ``min_pages`` blocked pages, whatever the input, and of the labelled
    pages it holds on at least the share ``min_confidence`` is blocked."""

    min_pages: int = 5
    min_confidence: float = 0.8


@dataclass(frozen=True)
class Rules:
    """Written tables: ``classes(token, cls)`` and ``rules(rule_id, items, n_items, confidence, support,
    anchor)``, items being classes and the anchor the rarest of them."""

    classes: DataFrame
    rules: DataFrame


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return common.lower_az(F.regexp_extract(_safe(url), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_safe(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _safe(url: Column) -> Column:
    return F.coalesce(url.cast("string"), F.lit(""))


def list_rule(host_: Column, path_: Column, rules=LIST_RULES) -> Column:
    """Struct (rule, verdict) of the longest listed rule that fits, null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"),
                                    F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL, as an array of tagged strings (empty without a host)."""
    u, h, p = _safe(url), host(url), path(url)
    labels = F.filter(F.split(h, r"\."), lambda x: x != "")
    n = F.size(labels)
    suffixes = F.when(n >= 2, F.transform(
        F.sequence(F.lit(2), n),
        lambda k: F.concat(F.lit("d:"), F.array_join(F.slice(labels, n - k + 1, k), ".")))
    ).otherwise(F.transform(labels, lambda x: F.concat(F.lit("d:"), x)))
    first = F.when(n >= 1, F.array(F.concat(F.lit("h:"), F.element_at(labels, 1)))).otherwise(
        F.array().cast("array<string>"))
    segments = F.transform(F.filter(F.split(p, "/"), lambda x: x != ""),
                           lambda x: F.concat(F.lit("p:"), x))
    ext = F.regexp_extract(p, r"\.([A-Za-z0-9]+)$", 1)
    query = F.regexp_extract(u, r"(?s)^[^#?]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    ext_token = F.when(ext != "", F.array(F.concat(F.lit("x:"), ext))).otherwise(
        F.array().cast("array<string>"))
    scheme = F.array(F.concat(F.lit("s:"), common.lower_az(F.substring_index(u, "://", 1))))
    every = F.array_distinct(F.concat(suffixes, first, segments, ext_token, keys, scheme))
    return F.when(h != "", every).otherwise(F.array().cast("array<string>"))


def mine_classes(labelled: DataFrame, mining: Mining | None = None) -> Rules:
    """Minimal rules over token classes from ``labelled(url, block)``.

    Rows without a label or a token are left out; without any row there are no rules.
    """
    mining = mining or Mining()
    sets = common.written(labelled.filter("block is not null").select(
        F.monotonically_increasing_id().alias("uid"), "block",
        tokens(F.col("url")).alias("tokens")).filter("size(tokens) > 0"), "labelled-tokens")
    n = sets.count()
    # a token on too few blocked pages is in no rule, so the other ones' combinations are not mined;
    # two independent sums of page hashes and the number of pages tell the covers apart
    each = sets.select("uid", "block", F.explode("tokens").alias("token"))
    seen = (each.groupBy("token").agg(
        F.count("*").alias("n"), F.count_if("block").alias("blocked"),
        F.bit_xor(F.xxhash64("uid", F.lit(1))).alias("x"),
        F.bit_xor(F.xxhash64("uid", F.lit(2))).alias("y"))
        .filter(F.col("blocked") >= mining.min_pages)
        .withColumn("cls", F.xxhash64("n", "x", "y").bitwiseOR(1)))       # odd: never the label
    classes = common.written(seen.select("token", "cls", "n", "blocked"), "token-classes")
    sizes = common.written(classes.groupBy("cls").agg(
        F.first("n").alias("n"), (F.first("blocked") / F.first("n")).alias("confidence")),
        "classes")
    sure = F.col("confidence") >= mining.min_confidence
    found = sizes.filter(sure).select(
        F.array("cls").alias("items"), "confidence", (F.col("n") * F.col("confidence") / n)
        .alias("support"))
    unsure = common.bounded(common.written(
        classes.join(sizes.filter(~sure).select("cls"), "cls").select("token", "cls"), "unsure"))
    kept = common.written(
        each.join(unsure, "token").groupBy("uid", "block")
        .agg(F.collect_set("cls").alias("items"))
        .select(F.when(F.col("block"), F.concat("items", F.array(F.lit(BLOCK).cast("long"))))
                .otherwise(F.col("items")).alias("items")), "transactions")
    rows = kept.count()
    if rows:
        # half a page less: the product with the number of rows is rounded up
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, (mining.min_pages - 0.5) / rows),
                         minConfidence=mining.min_confidence).fit(kept)
        found = found.unionByName(
            model.associationRules
            .filter(F.col("consequent") == F.array(F.lit(BLOCK).cast("long")))
            .select(F.sort_array("antecedent").alias("items"), "confidence",
                    (F.col("support") * rows / n).alias("support")))
    found = common.written(found.select(
        F.xxhash64("items").alias("rule_id"), "items", F.size("items").alias("n_items"),
        "confidence", "support"), "found")
    # the rarest class of each rule
    anchors = (found.select("rule_id", F.explode("items").alias("cls"))
               .join(common.bounded(sizes.select("cls", "n")), "cls").groupBy("rule_id")
               .agg(F.min_by("cls", F.struct("n", "cls")).alias("anchor")))
    rules = common.written(found.join(anchors, "rule_id"), "rules")
    # by number of classes, those that hold no rule stay
    for size in sorted(r[0] for r in rules.filter("n_items > 2").select("n_items").distinct()
                       .collect()):
        long = rules.filter(F.col("n_items") == size)
        shorter = rules.filter(F.col("n_items") < size)
        held = _met(long.select(F.col("rule_id").alias("long_id"), F.col("items").alias("held")),
                    shorter).select(F.col("long_id").alias("rule_id")).distinct()
        rules = common.written(rules.join(held, "rule_id", "left_anti"), "rules")
    used = rules.select(F.explode("items").alias("cls")).distinct()
    return Rules(common.written(classes.join(used, "cls").select("token", "cls"), "rule-tokens"),
                 rules)


def mine(labelled: DataFrame, mining: Mining | None = None) -> DataFrame:
    """The rules spelt out in tokens, ``(items, n_items, confidence, support)``: a rule for each choice
    of a token from each of its classes."""
    r = mine_classes(labelled, mining)
    own = r.classes.groupBy("cls").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    listed = (r.rules.select("rule_id", "n_items", "confidence", "support", F.explode("items")
                             .alias("cls")).join(own, "cls")
              .groupBy("rule_id", "n_items", "confidence", "support")
              .agg(F.collect_list("tokens").alias("choices")))
    none = F.array(F.array().cast("array<string>"))
    every = F.aggregate("choices", none, lambda done, more: F.flatten(F.transform(
        done, lambda a: F.transform(more, lambda t: F.concat(a, F.array(t))))))
    return listed.select(F.explode(every).alias("items"), "n_items", "confidence",
                         "support").withColumn("items", F.sort_array("items"))


def _met(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of ``sets(..., held)`` with every rule whose classes they hold."""
    index = common.bounded(rules.select("rule_id", "items", "anchor"), 100_000)
    each = sets.withColumn("anchor", F.explode("held"))
    return each.join(index, "anchor").filter(F.size(F.array_except("items", "held")) == 0)


def fired(urls: DataFrame, rules: Rules) -> DataFrame:
    """Of the distinct ``urls(url)`` those on which a rule fires: ``(url, n_rules)``.

    Inverted index: a URL's classes meet the rules whose rarest class they are, and a rule fires if
    the URL holds its other classes as well. Tokens of no rule never shuffle when the index is
    small.
    """
    held = (urls.select("url", F.explode(tokens(F.col("url"))).alias("token"))
            .join(common.bounded(rules.classes), "token")
            .groupBy("url").agg(F.collect_set("cls").alias("held")))
    return _met(held, rules.rules).groupBy("url").agg(F.count("*").alias("n_rules"))


def judge(pages: DataFrame, labelled: DataFrame, list_rules=LIST_RULES,
          mining: Mining | None = None) -> DataFrame:
    """``pages(page_id, url)`` with host, path, rule, verdict and the number of mined rules.

    A null URL or one without ``://`` has an empty host and path, meets no rule and is allowed;
    repeated rows are judged alike; other columns are not carried. An empty ``labelled`` mines no
    rule: only the list decides.
    """
    own = pages.select("page_id", "url")
    rules = mine_classes(labelled, mining)
    hit = common.written(fired(own.filter("url is not null").select("url").distinct(), rules),
                         "fired")
    h, p = host(F.col("url")), path(F.col("url"))
    listed = list_rule(F.col("host"), F.col("path"), list_rules)
    return (own.join(hit, "url", "left")
            .select("page_id", h.alias("host"), p.alias("path"),
                    F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_mined"))
            .withColumn("listed", listed)
            .select("page_id", "host", "path", F.col("listed.rule").alias("rule"),
                    F.coalesce("listed.verdict", F.when(F.col("n_mined") > 0, "block")
                               .otherwise("allow")).alias("verdict"), "n_mined"))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """URLs with a label: a page is to be blocked if its id is labelled low quality or toxic."""
    block = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1))
        .alias("block"))
    return pages.select("page_id", "url").join(block, "page_id").select("url", "block")
