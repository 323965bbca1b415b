"""URL verdicts by given rules and by rules mined from labelled URLs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import stage

BAD = "label=bad"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for urls without '://'."""
    given = F.coalesce(url, F.lit(""))
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(given, pattern, 1)), F.regexp_extract(given, pattern, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The number of the longest rule whose host is the url's or above it and whose path begins it."""
    out = F.lit(None).cast("int")
    for k, rule in sorted(enumerate(rules), key=lambda x: (len(x[1].text), -x[0])):
        of_host = (host == rule.host) | host.endswith("." + rule.host)
        out = F.when(of_host & path.startswith(rule.path), F.lit(k)).otherwise(out)
    return out


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a url: host, its words, path words, query keys.

    Digits become one, as no rule should rest on a page number. Tokens that always come
    together multiply the combinations to mine, so there is one for each fact.
    """
    tagged = lambda tag, parts: F.transform(parts, lambda x: F.concat(F.lit(tag), x))
    numbers = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    parts = [
        tagged("host=", F.split(host, r"[^\p{L}\p{N}]+")),
        tagged("path=", F.split(numbers(lower_ascii(path)), r"[^\p{L}\p{N}]+")),
        tagged("key=", F.transform(keys, numbers)),
    ]
    bare = lambda x: ~x.endswith("=")
    return F.array_distinct(F.filter(F.concat(*parts), bare))


def mine_rules(
    labelled: DataFrame,
    min_support: float = 0.005,
    min_confidence: float = 0.8,
    min_lift: float = 1.5,
) -> DataFrame:
    """Token combinations that predict a bad url, as rows (rule, token, tokens, confidence).

    `labelled` has `tokens` (array) and `bad` (boolean). FP-growth finds the frequent
    combinations; kept are rules "combination => bad" of enough confidence and lift, whatever
    their size, none of them a superset of a kept rule that is as confident.
    No labelled rows give no rules.
    """
    items = F.when(F.col("bad"), F.array_append("tokens", BAD)).otherwise(F.col("tokens"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(
        labelled.select(items.alias("items"))
    )
    found = model.associationRules.where(
        F.array_contains("consequent", BAD)
        & (F.col("lift") >= min_lift)
    ).select(F.array_sort("antecedent").alias("combo"), "confidence", "support")
    found = stage(found, "url-rules")
    within = F.explode("combo").alias("token")
    inner = found.select("combo", "confidence", within)
    outer = found.select(F.col("combo").alias("larger"), F.col("confidence").alias("other"), within)
    above = (
        inner.join(outer, "token")
        .where((F.size("larger") > F.size("combo")) & (F.col("confidence") >= F.col("other")))
        .groupBy("combo", "larger")
        .count()
        .where(F.col("count") == F.size("combo"))
        .select(F.col("larger").alias("combo"))
    )
    kept = found.join(above, "combo", "left_anti")
    return kept.select(
        F.xxhash64("combo").alias("rule"),
        F.size("combo").alias("n_tokens"),
        "confidence",
        F.explode("combo").alias("token"),
    )


def matched_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The highest confidence among the rules that each distinct url fulfils; rows of those only.

    `urls` has `url` and `tokens`. An inverted index from token to rules: tokens that no
    rule has end at the join, and a rule holds where all its tokens were found.
    """
    hits = (
        urls.select("url", F.explode("tokens").alias("token"))
        .join(rules, "token")
        .groupBy("url", "rule", "n_tokens", "confidence")
        .agg(F.count("*").alias("found"))
        .where(F.col("found") == F.col("n_tokens"))
    )
    return hits.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: Sequence[UrlRule], **mining: float
) -> DataFrame:
    """Verdict for every page: the longest fitting rule's, else block if a mined rule holds.

    `labels` (doc_id, quality) marks pages of the same id; quality 0 is bad, null is no
    label. Null urls have empty host and path, no rule, no tokens, and are allowed. Repeated
    pages each get a row; repeated labels count once, bad if any of them is. Empty tables
    give no rows or no mined rules. Columns beyond these are not read.
    """
    host, path = split_url(F.col("url"))
    marks = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").alias("page_id"))
        .agg((F.min("quality") == 0).alias("bad"))
    )
    tokens = url_tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens")
    narrow = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    mined = mine_rules(narrow.join(marks, "page_id").select(tokens, "bad"), **mining)
    urls = narrow.where("url is not null").groupBy("url").agg(
        F.first("host").alias("host"), F.first("path").alias("path")
    )
    bad = matched_urls(urls.select("url", tokens), mined)
    number = fitting_rule(F.col("host"), F.col("path"), rules)
    texts = F.array(*[F.lit(r.text) for r in rules]) if rules else F.array(F.lit(""))
    verdicts = F.array(*[F.lit(r.verdict) for r in rules]) if rules else F.array(F.lit(""))
    mined_verdict = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return (
        narrow.withColumn("n", number)
        .join(bad, "url", "left")
        .select(
            "page_id",
            "host",
            "path",
            F.get(texts, F.col("n")).alias("rule"),
            F.coalesce(F.get(verdicts, F.col("n")), mined_verdict).alias("verdict"),
            "confidence",
        )
    )
