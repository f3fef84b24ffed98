"""URL filter by association rules.

Tokens that stand in the same labelled URLs always apply together, so they are one item. Spark's FP-growth mines which items
go together with a label. Rules under a confidence or support are pruned, and so are
rules that a shorter one implies. The rest is an inverted index: a rule is filed under its rarest token, a URL looks up its
own items there, and the rules whose other items the URL has too apply.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class ListRule:
    """A curated rule: `host` and its subdomains, under `path`."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The curated rules.
LIST_RULES = (
    ListRule("org", "/", ALLOW), ListRule("example.org", "/es/", BLOCK), ListRule("example.org", "/en/1", BLOCK),
    ListRule("com", "/fr/", ALLOW), ListRule("com", "/de/", BLOCK),
)


def url_host(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_query(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))


def list_rule(host: Column, path: Column, rules: tuple[ListRule, ...] = LIST_RULES) -> Column:
    """(rule, verdict) of the longest fitting rule, nulls if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def url_tokens(host: Column, path: Column, query: Column) -> Column:
    """Distinct tokens: host labels with their level counted from the right, path words with digits masked, file endings
    and query keys."""
    labels = F.reverse(F.filter(F.split(host, r"\."), lambda x: x != ""))
    hosts = F.transform(labels, lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit(":"), x))
    masked = F.regexp_replace(F.lower(path), "[0-9]+", "0")
    paths = F.transform(F.filter(F.split(masked, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), x))
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("key:"), F.regexp_extract(x, "(?s)^([^=]*)", 1)))
    return F.array_distinct(F.concat(hosts, paths, keys))


def same_tokens(labelled: DataFrame) -> DataFrame:
    """(token, item, count): the tokens of rows (tokens, label), and for each the first of those that stand in the same rows. Rows
    are told apart by a hash of what they hold, which is all that decides which tokens they have."""
    rows = labelled.select("tokens", F.xxhash64(F.array_sort("tokens"), "label").alias("row"))
    each = rows.select(F.explode("tokens").alias("token"), "row")
    found = each.groupBy("token").agg(F.count("*").alias("count"), F.bit_xor("row").alias("xor"),
                                      F.sum(F.pmod("row", F.lit(2**31 - 1))).alias("sum"))
    items = found.groupBy("count", "xor", "sum").agg(F.min("token").alias("item"))
    return found.join(items, ["count", "xor", "sum"]).select("token", "item", "count")


def items_of(sets: DataFrame, same: DataFrame) -> DataFrame:
    """(tokens, items, own) of different token sets: their tokens as items, those that no labelled row has left out, and which
    token stands for which item. A set has as many as its URL has tokens."""
    each = sets.select("tokens", F.explode("tokens").alias("token"))
    return each.join(same.select("token", "item"), "token").groupBy("tokens").agg(
        F.collect_set("item").alias("items"), F.collect_set(F.struct("item", "token")).alias("own"))


def mine_rules(labelled: DataFrame, same: DataFrame, min_support: float = 0.002, min_confidence: float = 0.8,
               common_share: float = 0.95) -> DataFrame:
    """(rule_tokens, verdict, confidence, support, anchor, anchor_count) from rows (tokens, label) and their same_tokens.

    A rule holds for any token of its items; rule_tokens names the first one of each. Items in over common_share of the rows
    tell nothing and are left out. A long URL's many tokens that no other labelled URL has, or that only URLs of the same path
    have, are one item; the number of item sets is exponential only in items that go together in some rows and not in others.
    No labelled row: no rule."""
    spark = labelled.sparkSession
    empty = "rule_tokens array<string>, verdict string, confidence double, support double, anchor string, anchor_count long"
    total = labelled.count()
    if not total:
        return spark.createDataFrame([], empty)
    counts = same.where(F.col("token") == F.col("item")).select("token", "count")
    telling = same.join(counts.where(F.col("count") <= common_share * total).select(F.col("token").alias("item")), "item", "left_semi")
    sets = items_of(labelled.select("tokens").distinct(), telling)
    mapped = labelled.join(sets.withColumnRenamed("tokens", "_tokens"), (F.xxhash64("tokens") == F.xxhash64("_tokens")) & (F.col("tokens") == F.col("_tokens")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    baskets = materialized(mapped.select(F.concat(items, F.array(F.concat(F.lit("label:"), "label"))).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0].startswith("label:")).where(
        ~F.exists("antecedent", lambda x: x.startswith("label:")))
    rules = materialized(rules.select(F.sort_array("antecedent").alias("rule_tokens"),
                                      F.regexp_replace(F.col("consequent")[0], "^label:", "").alias("verdict"),
                                      "confidence", "support"))
    # A shorter rule with the same verdict and no less confidence says the same: found by any one of its tokens.
    short = rules.select(F.col("rule_tokens").alias("s_tokens"), F.col("verdict").alias("s_verdict"),
                         F.col("confidence").alias("s_confidence"), F.col("rule_tokens")[0].alias("s_first"))
    long = rules.withColumn("token", F.explode("rule_tokens"))
    implied = long.join(short, (F.col("token") == F.col("s_first")) & (F.col("verdict") == F.col("s_verdict"))
                        & (F.size("s_tokens") < F.size("rule_tokens")) & (F.col("s_confidence") >= F.col("confidence"))
                        & (F.size(F.array_except("s_tokens", "rule_tokens")) == 0))
    rules = rules.join(implied.select("rule_tokens", "verdict").distinct(), ["rule_tokens", "verdict"], "left_anti")
    anchored = (rules.withColumn("token", F.explode("rule_tokens")).join(counts, "token")
                .groupBy("rule_tokens", "verdict", "confidence", "support")
                .agg(F.min(F.struct(F.col("count").alias("n"), F.col("token").alias("t"))).alias("rarest")))
    return materialized(anchored.select("rule_tokens", "verdict", "confidence", "support", F.col("rarest.t").alias("anchor"),
                                        F.col("rarest.n").alias("anchor_count")))


def judge_urls(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
               list_rules: tuple[ListRule, ...] = LIST_RULES, min_support: float = 0.002, min_confidence: float = 0.8,
               default: str = ALLOW) -> DataFrame:
    """One row for each row of pages: its id, host, path, list rule, verdict, mined rule (the URL's
    own tokens that stand for the rule's) and confidence.

    The pages that a list rule fits are the labelled ones; what is mined from them judges the others: the applying rule of
    the highest confidence, then support, then fewest tokens, then last in order, decides, and `default` where none applies. URLs with
    the same tokens are looked up once, so a host with a third of all pages costs no more than its different token sets. A
    null or malformed url has empty host and path, no token and the default verdict; repeated rows each get a row; other
    columns of pages are not read.
    """
    url = F.col("url")
    parsed = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url")).select(
        "page_id", url_host(url).alias("host"), url_path(url).alias("path"), url_query(url).alias("query"))
    parsed = parsed.select("page_id", "host", "path", url_tokens(F.col("host"), F.col("path"), F.col("query")).alias("tokens"),
                           list_rule(F.col("host"), F.col("path"), list_rules).alias("listed"))
    parsed = materialized(parsed)
    labelled = parsed.where("listed is not null").select("tokens", F.col("listed.verdict").alias("label"))
    same = materialized(same_tokens(labelled))
    rules = mine_rules(labelled, same, min_support, min_confidence)

    sets = items_of(parsed.where("listed is null").select("tokens").distinct(), same)
    hits = (sets.select("tokens", "items", "own", F.explode("items").alias("anchor")).join(rules, "anchor")
            .where(F.size(F.array_except("rule_tokens", "items")) == 0))
    best = hits.groupBy("tokens").agg(F.max_by(
        F.struct("verdict", "confidence", F.sort_array(F.transform(F.filter("own", lambda o: F.array_contains("rule_tokens", o["item"])),
                                                                   lambda o: o["token"])).alias("rule_tokens")),
        F.struct("confidence", "support", -F.size("rule_tokens"), "rule_tokens")).alias("mined"))
    judged = parsed.join(best.withColumnRenamed("tokens", "_tokens"),
                         F.col("listed").isNull() & (F.xxhash64("tokens") == F.xxhash64("_tokens"))
                         & (F.col("tokens") == F.col("_tokens")), "left")
    return judged.select(F.col("page_id").alias(id_column), "host", "path", F.col("listed.rule").alias("rule"),
                         F.coalesce("listed.verdict", "mined.verdict", F.lit(default)).alias("verdict"),
                         F.col("mined.rule_tokens").alias("mined_rule"), F.col("mined.confidence").alias("confidence"))
