"""URL filters: listed host and path rules, and association rules mined from labels.

DataFrame functions and Spark's FP-growth only.
"""

import math
import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from formbook.llm.common import other_columns, quoted, row_columns, row_of, staged

BAD = "label=bad"
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8


@dataclass(frozen=True)
class ListedRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


LISTED = (
    ListedRule("allow", "com", "/"),
    ListedRule("block", "example.com", "/en/"),
    ListedRule("allow", "www.example.com", "/en/"),
    ListedRule("block", "net", "/es/"),
    ListedRule("block", "net", "/fr/"),
)


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, A-Z lower-cased, and ``path``; both empty for null and for urls without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def listed_rule(rules: tuple[ListedRule, ...]) -> Column:
    """Struct of the longest rule that fits ``host`` and ``path``; null if none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = (F.col("host") == r.host) | F.col("host").endswith("." + r.host)
        fits = fits & F.col("path").startswith(r.path)
        chosen = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def tokens(url: str = "url") -> Column:
    """Distinct tokens: host labels, path pieces and query keys, each with its kind."""
    query = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"\?([^#]*)", 1)
    kinds = (
        ("h:", F.split("host", r"\.")),
        ("p:", F.split("path", r"[/._-]+")),
        ("q:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
    )

    def marked(kind: str, pieces: Column) -> Column:
        return F.transform(F.filter(pieces, lambda t: t != ""), lambda t: F.concat(F.lit(kind), t))

    return F.array_distinct(F.concat(*[marked(k, x) for k, x in kinds]))


def class_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> tuple[DataFrame, DataFrame]:
    """``rule_id, items, confidence, support`` and ``token, item``: combinations of token classes that imply a bad label.

    ``labelled`` has ``tokens`` and a boolean ``bad``. Tokens in exactly the same labelled urls are one class, named by its smallest
    token; a rule fits a url that has some token of each of its classes. A rule that contains another one is left out. All tokens of a
    url take part, whatever their number, except where they cannot change the rules: a rule's tokens are each frequent
    among bad urls, and a token that is a rule by itself is in no other one.
    """
    session = labelled.sparkSession
    empty = session.createDataFrame([], "rule_id long, items array<string>, confidence double, support double")
    labelled = staged(labelled.filter(F.col("bad").isNotNull()).select("tokens", "bad"), "labelled")
    total = labelled.count()
    if not total:
        return empty, session.createDataFrame([], "token string, item string")
    # Support is a share of all labelled urls, those without a frequent token included.
    least = max(1, math.ceil(min_support * total - 1e-9))
    rows = staged(labelled.withColumn("row", F.monotonically_increasing_id()), "baskets")
    posting = rows.select("row", "bad", F.explode("tokens").alias("token"))
    marks = [F.sum(F.xxhash64("row", F.lit(i)).cast("decimal(20,0)")).alias(f"mark{i}") for i in (1, 2)]
    counts = posting.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("hits"), *marks)
    counts = counts.filter(F.col("hits") >= least).withColumn("confidence", F.col("hits") / F.col("n"))
    counts = staged(counts, "tokens")
    alone = F.col("confidence") >= min_confidence
    single = counts.filter(alone).select(F.array("token").alias("items"), "confidence", (F.col("hits") / total).alias("support"))
    single = single.withColumn("rule_id", F.xxhash64("items")).select("rule_id", "items", "confidence", "support")
    mark = ["n", "hits", "mark1", "mark2"]
    alike = counts.filter(~alone).groupBy(*mark).agg(F.min("token").alias("item"))
    classes = counts.filter(~alone).join(alike, mark).select("token", "item")
    classes = staged(classes.unionByName(counts.filter(alone).select("token", F.col("token").alias("item"))), "classes")
    items = posting.join(alike.select(F.col("item").alias("token")), "token")
    items = items.groupBy("row", "bad").agg(F.collect_list("token").alias("items"))
    marked = items.select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items"))
    marked = staged(marked, "marked")
    held = marked.count()
    if not held:
        return single, classes
    # Half a url below the count, as the share is rounded up to one.
    share = min((least - 0.5) / held, 1.0)
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(marked)
    rules = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD)))
    rules = rules.select(F.sort_array("antecedent").alias("items"), "confidence", (F.col("support") * held / total).alias("support"))
    rules = staged(rules.withColumn("rule_id", F.xxhash64("items")), "rules")
    # Subset test through a shared token: the narrower rule adds nothing.
    by_token = rules.select(F.explode("items").alias("token"), F.col("rule_id").alias("part"), F.size("items").alias("n"))
    wide = rules.select("rule_id", F.size("items").alias("size"), F.explode("items").alias("token"))
    inner = wide.join(by_token, "token").filter("n < size").groupBy("rule_id", "part", "n").count().filter("count = n")
    rules = rules.join(inner.select("rule_id").distinct(), "rule_id", "left_anti")
    return single.unionByName(rules.select(*single.columns)), classes


def mined_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """The rules of ``class_rules`` written out token by token: every choice of one token from each class of a rule.

    Their number is the product of the classes' sizes, so this is for reading rules; matching goes by class.
    """
    rules, classes = class_rules(labelled, min_support, min_confidence)
    tokens_of = classes.groupBy("item").agg(F.collect_list("token").alias("tokens"))
    options = rules.select("rule_id", "confidence", "support", F.explode("items").alias("item")).join(tokens_of, "item")
    options = options.groupBy("rule_id", "confidence", "support").agg(F.collect_list("tokens").alias("options"))
    longer = lambda chosen, tokens: F.flatten(F.transform(chosen, lambda c: F.transform(tokens, lambda t: F.concat(c, F.array(t)))))
    none = F.array(F.array().cast("array<string>"))
    spread = options.select("confidence", "support", F.explode(F.aggregate("options", none, longer)).alias("items"))
    spread = spread.withColumn("items", F.sort_array("items")).withColumn("rule_id", F.xxhash64("items"))
    return spread.select("rule_id", "items", "confidence", "support")


def matches(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, confidence``: urls (``key, tokens``) that some rule fits, through an inverted index.

    A url's tokens become their classes first. A rule is indexed by its rarest class alone and verified on all classes of the url.
    """
    held = urls.select("key", F.explode("tokens").alias("token")).join(classes, "token")
    held = staged(held.groupBy("key").agg(F.collect_set("item").alias("held")), "held")
    posting = held.select("key", "held", F.explode("held").alias("item"))
    terms = rules.select("rule_id", F.explode("items").alias("item"))
    counts = posting.join(terms.select("item").distinct(), "item").groupBy("item").count()
    rarest = terms.join(counts, "item").groupBy("rule_id").agg(F.min(F.struct("count", "item"))["item"].alias("item"))
    index = rules.join(rarest, "rule_id").select("item", "items", "confidence")
    hit = posting.join(index, "item").filter(F.size(F.array_except("items", "held")) == 0)
    return hit.groupBy("key").agg(F.max("confidence").alias("confidence"))


def judge(
    pages: DataFrame,
    labels: DataFrame,
    id: str = "page_id",
    url: str = "url",
    rules: tuple[ListedRule, ...] = LISTED,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, confidence``.

    The longest listed rule decides; elsewhere a mined rule blocks and everything else is allowed. ``labels`` has the id column and a
    boolean ``bad``; an id labelled twice is bad if any label is. Null ids have no label. Pages of equal token sets are matched once. Null and
    malformed urls have no tokens and are allowed. Columns of the names added here, in any case, are replaced.
    """
    added = ["host", "path", "rule", "verdict", "confidence"]
    rest = other_columns(pages, added)
    frame = pages.select(row_of(rest).alias("_row"), quoted(id).alias("_id"), quoted(url).alias("url"))
    frame = parsed(frame).withColumn("_tokens", F.sort_array(tokens("url"))).withColumn("_listed", listed_rule(rules))
    frame = staged(frame, "urls")
    labels = labels.groupBy(F.col(id).alias("_id")).agg(F.max("bad").alias("bad"))
    labelled = frame.select("_id", F.col("_tokens").alias("tokens")).join(labels, "_id")
    mined, classes = class_rules(labelled, min_support, min_confidence)
    sets = frame.select(F.xxhash64("_tokens").alias("key"), F.col("_tokens").alias("tokens")).dropDuplicates(["key"])
    found = matches(sets, mined, classes).withColumnRenamed("key", "_key")
    judged = frame.withColumn("_key", F.xxhash64("_tokens")).join(found, "_key", "left")
    verdict = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return judged.select(
        *row_columns(rest),
        "host",
        "path",
        F.col("_listed.rule").alias("rule"),
        F.coalesce("_listed.verdict", verdict).alias("verdict"),
        "confidence",
    )
