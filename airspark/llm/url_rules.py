"""URL filter: fixed host/path rules first, mined association rules for the rest.

Pages that a fixed rule judges are labelled by it.  Spark's FP-growth mines the token combinations that
go with the label "block"; combinations are pruned by support, confidence and minimality, and matched to
the other pages' token sets by an inverted index from token to rule.  Only DataFrame and Spark ML
operations: nothing runs in Python on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

BLOCK_ITEM = "verdict=block"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    place: str    # host/path-prefix

    @property
    def host(self) -> str:
        return self.place.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.place.partition("/")[2]


#: The registered rules.
RULES = [Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
         Rule("allow", "com/fr/"), Rule("block", "com/de/")]


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; else empty."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule's place; between equal lengths the first in text order; else NULL."""
    fits = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.place), [-ord(c) for c in r.place])):
        under = (host == r.host) | host.endswith("." + r.host)
        fits = F.when(under & path.startswith(r.path), F.lit(r.place)).otherwise(fits)
    return fits


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct sorted tokens: host labels, and path segments with each run of digits as one "#"."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("host="), x))
    parts = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""),
                        lambda x: F.concat(F.lit("path="), F.regexp_replace(_ascii_lower(x), "[0-9]+", "#")))
    return F.array_sort(F.array_distinct(F.concat(labels, parts)))


def mine(labelled: DataFrame, min_support: float = 0.01, min_confidence: float = 0.9) -> DataFrame:
    """rule tokens (``antecedent``) -> block with their confidence and support, from columns tokens and verdict.

    A combination is kept if at least ``min_support`` of the labelled pages hold it together with the
    label, ``min_confidence`` of the pages holding it are labelled block, and no smaller combination
    inside it is kept.  Without labelled pages, or with none blocked, there are no rules.
    """
    spark = labelled.sparkSession
    items = labelled.select(F.when(F.col("verdict") == "block", F.array_append("tokens", F.lit(BLOCK_ITEM)))
                            .otherwise(F.col("tokens")).alias("items"))
    empty = spark.createDataFrame([], "antecedent array<string>, confidence double, support double")
    if not items.where(F.array_contains("items", BLOCK_ITEM)).take(1):
        return empty
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = checkpoint(model.associationRules.where(F.col("consequent") == F.array(F.lit(BLOCK_ITEM)))
                       .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"), "url-rules")
    # Minimality by the same inverted index: a rule goes if all tokens of a smaller rule are among its own.
    small = rules.select(F.col("antecedent").alias("small"), F.size("antecedent").alias("n"),
                         F.explode("antecedent").alias("token"))
    large = rules.select("antecedent", F.explode("antecedent").alias("token"))
    covered = (large.join(small, "token").where(F.size("antecedent") > F.col("n"))
               .groupBy("antecedent", "small", "n").count().where(F.col("count") == F.col("n"))
               .select("antecedent").distinct())
    return rules.join(covered, "antecedent", "left_anti")


def blocked_token_sets(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``tokens`` that hold all tokens of some rule, by inverted index and counting."""
    index = rules.select(F.xxhash64("antecedent").alias("rule_id"), F.size("antecedent").alias("n"),
                         F.explode("antecedent").alias("token"))
    return (token_sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
            .groupBy("tokens", "rule_id", "n").count().where(F.col("count") == F.col("n"))
            .select("tokens").distinct())


def judge(pages: DataFrame, rules: list[Rule] | None = None, id_col: str = "page_id", url_col: str = "url",
          min_support: float = 0.01, min_confidence: float = 0.9) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    A NULL url, or one without "://", has empty host and path and no tokens, fits no rule and is allowed.
    Repeated rows get equal verdicts; an empty table gives an empty result.  Pages are matched as
    distinct token sets, so a hot host is counted once; the join back splits a hot set.
    """
    url = F.col(url_col)
    rules = RULES if rules is None else rules
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    block = [r.place for r in rules if r.verdict == "block"]
    seen = parsed.select("*", fitting_rule(F.col("host"), F.col("path"), rules).alias("rule"),
                         tokens_of(F.col("host"), F.col("path")).alias("tokens"))
    seen = checkpoint(seen, "url-tokens")
    ruled = F.when(F.col("rule").isin(block), "block").when(F.col("rule").isNotNull(), "allow")
    mined = mine(seen.where(F.col("rule").isNotNull()).select("tokens", ruled.alias("verdict")),
                 min_support, min_confidence)
    hit = blocked_token_sets(seen.where(F.col("rule").isNull()).select("tokens").distinct(), mined)
    # Written apart, so that the join below has no aggregate in it and Spark can split a hot token set.
    hit = checkpoint(hit.select("tokens", F.lit(True).alias("hit")), "url-hits")
    return (seen.join(hit, "tokens", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce(ruled, F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict")))
