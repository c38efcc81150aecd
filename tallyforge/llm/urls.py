"""URL filters: fixed host and path rules, then association rules mined from labelled pages.

URLs become token sets: scheme, host, domain, subdomain, host labels, first directory, path segments
and their words, file extension, query keys and values, fragment. Single tokens and pairs that go
with a bad label are counted exactly over all labelled pages, with the same number of pages asked
for at any size; sets of three and more come from FP-growth. Rules with enough pages and confidence
stay if chance would hardly give so many bad ones, without those that only add tokens to a rule at least as sure. A rule is indexed under its rarest token; a URL is compared with the rules
listed under its own tokens, and is blocked if it holds all tokens of one.

Fixed rules name a host, with all its subdomains, and a path prefix; the longest that fits wins.
NULL URLs and URLs without ``://`` have empty host and path and no tokens: no rule fits, verdict
allow. A page with several labels is bad if one of them is. Rows without an id get their verdict
like others but are not learned from.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.rows import ROW, bounded
from tallyforge.sources.storage import materialize

#: Labelled pages that rules of three tokens and more are mined from, at most about so many.
TRAINING_ROWS = 500_000
#: A rule of three tokens and more covers this share of the pages; any rule, this many bad ones; so sure must it be.
MIN_SUPPORT, MIN_ROWS, MIN_CONFIDENCE = 0.002, 20, 0.6
#: Standard deviations by which a rule's bad pages exceed what the share of bad pages makes likely. So many are
#: asked for because as many rules are tried as there are tokens and pairs.
MIN_DEVIATIONS = 5.0
BAD = "label:bad"


@dataclass(frozen=True)
class HostRule:
    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return self.rule[len(self.host) :]


HOST_RULES = (
    HostRule("block", "net/"),
    HostRule("allow", "example.net/en/"),
    HostRule("block", "example.com/de/"),
    HostRule("allow", "org/fr/"),
)


def _rest(url: str) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(F.col(url), "://")
    return F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")


def host_of(url: str) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: str) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def longest_rule(rules: Sequence[HostRule], host: Column, path: Column) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits; NULL when none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for each in sorted(rules, key=lambda r: len(r.rule)):
        within = (host == each.host) | host.endswith(f".{each.host}")
        fits = within & path.startswith(each.path)
        rule, verdict = F.when(fits, each.rule).otherwise(rule), F.when(fits, each.verdict).otherwise(verdict)
    return rule, verdict


def url_tokens(url: str, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL; none without a host."""
    rest = _rest(url)
    labels = F.split(host, r"\.")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    keys = F.flatten(
        F.transform(
            F.split(query, "[&;]"),
            lambda pair: F.array(F.concat(F.lit("query:"), F.substring_index(pair, "=", 1)), F.concat(F.lit("query:"), pair)),
        )
    )
    tagged = lambda tag, parts: F.transform(F.filter(parts, lambda part: part != ""), lambda part: F.concat(F.lit(tag), part))
    parts = [
        tagged("label:", labels),
        tagged("path:", F.split(path, "/")),
        tagged("word:", F.split(F.lower(path), r"[^\p{L}\p{N}]+")),
    ]
    named = F.array(
        F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))),
        F.concat(F.lit("host:"), host),
        F.concat(F.lit("domain:"), F.array_join(F.slice(labels, -2, 2), ".")),
        F.when(F.size(labels) > 2, F.concat(F.lit("sub:"), labels[0])),
        F.concat(F.lit("dir:"), F.nullif(F.regexp_extract(path, r"^/([^/]*)/", 1), F.lit(""))),
        F.concat(F.lit("ext:"), F.nullif(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1), F.lit(""))),
        F.when(F.instr(rest, "#") > 0, F.lit("fragment")),
    )
    keys = F.when(query != "", keys).otherwise(F.array().cast("array<string>"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.array_compact(F.concat(named, keys, *parts)))
    )


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_rows: int = MIN_ROWS,
    min_confidence: float = MIN_CONFIDENCE,
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """Rules (``tokens``, ``confidence``, ``support``) for a bad label from ``tokens`` and ``bad``.

    A rule of one or two tokens holds at least ``min_rows`` bad rows of all, whatever their number.
    Longer rules also need ``min_support``; of more than ``training_rows`` rows a seeded sample is
    used for them. Tokens of a single-token rule are in no longer one.
    """
    spark = labelled.sparkSession
    rows = labelled.count()
    if not rows:
        return spark.createDataFrame([], "tokens array<string>, confidence double, support double")
    listed = materialize(labelled.select(F.monotonically_increasing_id().alias(ROW), "bad", "tokens"))
    share = F.lit(listed.filter("bad").count() / rows)

    def beyond_chance(bad: Column, times: Column) -> Column:
        """Whether a binomial draw at the share of all bad pages would give clearly fewer."""
        return bad - times * share >= MIN_DEVIATIONS * F.sqrt(times * share * (1 - share))

    each = listed.select(ROW, "bad", F.explode("tokens").alias("token"))
    # Tokens of the same rows have the same times and mark.
    counted = each.groupBy("token").agg(
        F.count(F.lit(1)).alias("times"),
        F.count_if("bad").alias("bad_times"),
        F.sum(F.xxhash64(ROW).cast("decimal(20,0)")).alias("mark"),
    )
    counts = materialize(counted.filter(F.col("bad_times") >= min_rows))
    sure = F.col("bad_times") >= min_confidence * F.col("times")
    figures = [(F.col("bad_times") / F.col("times")).alias("confidence"), (F.col("bad_times") / rows).alias("support")]
    lucky = ~beyond_chance(F.col("bad_times"), F.col("times"))
    singles = counts.filter(sure & ~lucky).select(F.array("token").alias("tokens"), *figures)
    joining = counts.filter(~sure & (F.col("times") < rows))
    first = joining.groupBy("times", "mark").agg(F.min("token").alias("first"))
    joining = materialize(joining.join(first, ["times", "mark"]).select("token", (F.col("token") == F.col("first")).alias("main")))
    combined = materialize(
        each.join(bounded(joining), "token")
        .groupBy(ROW, "bad")
        .agg(F.sort_array(F.collect_set("token")).alias("tokens"), F.collect_set(F.when(F.col("main"), F.col("token"))).alias("mains"))
    )
    pair = F.explode(
        F.flatten(
            F.transform(
                "tokens",
                lambda one, at: F.transform(F.slice("tokens", at + 2, F.size("tokens")), lambda two: F.array(one, two)),
            )
        )
    ).alias("tokens")
    bad_pairs = combined.filter("bad").select(pair).groupBy("tokens").agg(F.count(F.lit(1)).alias("bad_times"))
    bad_pairs = materialize(bad_pairs.filter(F.col("bad_times") >= min_rows))
    good_pairs = combined.filter("NOT bad").select(pair).join(bounded(bad_pairs.select("tokens")), "tokens")
    good_pairs = good_pairs.groupBy("tokens").agg(F.count(F.lit(1)).alias("good_times"))
    times = F.col("bad_times") + F.coalesce("good_times", F.lit(0))
    pairs = bad_pairs.join(good_pairs, "tokens", "left").withColumn("times", times)
    pairs = pairs.filter(sure & ~lucky).select("tokens", *figures)
    marked = F.when(F.col("bad"), F.array_append("mains", F.lit(BAD))).otherwise(F.col("mains"))
    sample = combined
    if rows > training_rows:
        sample = combined.sample(fraction=training_rows / rows, seed=29)
        rows = training_rows
    miner = FPGrowth(
        itemsCol="items", minSupport=min(1.0, max(min_support, min_rows / rows)), minConfidence=min_confidence
    )
    found = miner.fit(sample.select(marked.alias("items"))).associationRules
    longer = found.filter((F.col("consequent") == F.array(F.lit(BAD))) & (F.size("antecedent") > 2))
    bad_rows = F.col("support") * rows
    longer = longer.filter(beyond_chance(bad_rows, bad_rows / F.col("confidence")))
    longer = longer.select(F.sort_array("antecedent").alias("tokens"), "confidence", "support")
    rules = materialize(singles.unionByName(pairs).unionByName(longer))
    # A longer rule that is no surer than a rule it contains says nothing new. Each rule meets the
    # shorter ones under the first token of theirs.
    shorter = rules.select(
        F.col("tokens").alias("less"), F.col("confidence").alias("as_sure"), F.get("tokens", F.lit(0)).alias("token")
    )
    longer = rules.select("tokens", "confidence", F.explode("tokens").alias("token"))
    within = (F.size("less") < F.size("tokens")) & (F.size(F.array_except("less", "tokens")) == 0)
    told = longer.join(shorter, "token").filter(within & (F.col("as_sure") >= F.col("confidence")))
    return rules.join(told.select("tokens").distinct(), "tokens", "left_anti")


def matching_rows(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``ROW`` of the rows of ``urls`` (``ROW``, ``tokens``) that hold all tokens of a rule."""
    counts = urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("times"))
    listed = rules.withColumn("rule_tokens", F.col("tokens")).select("rule_tokens", F.explode("tokens").alias("token"))
    weighed = listed.join(counts, "token", "left").select("rule_tokens", F.struct(F.coalesce("times", F.lit(0)), "token").alias("entry"))
    index = materialize(
        weighed.groupBy("rule_tokens").agg(F.min("entry").alias("entry")).select(F.col("entry.token").alias("token"), "rule_tokens")
    )
    met = urls.select(ROW, "tokens", F.explode("tokens").alias("token")).join(bounded(index), "token")
    return met.filter(F.size(F.array_except("rule_tokens", "tokens")) == 0).select(ROW).distinct()


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    host_rules: Sequence[HostRule] = HOST_RULES,
    url: str = "url",
    key: str = "page_id",
    label_key: str = "doc_id",
    **mining,
) -> DataFrame:
    """Per row its id, host, path, fixed rule if any, and verdict."""
    parsed = pages.select(F.monotonically_increasing_id().alias(ROW), F.col(key).alias("id"), F.col(url).alias("url"))
    parsed = parsed.select("*", host_of("url").alias("host"), path_of("url").alias("path"))
    parsed = parsed.select(
        ROW, "id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "url"
    )
    urls = materialize(
        parsed.select(ROW, "id", "host", "path", url_tokens("url", F.col("host"), F.col("path")).alias("tokens"))
    )
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.groupBy(F.col(label_key).alias("id")).agg(F.max(F.coalesce(bad, F.lit(False))).alias("bad"))
    labelled = materialize(urls.join(known, "id").select("tokens", "bad"))
    hit = matching_rows(urls, materialize(mine_rules(labelled, **mining))).withColumn("hit", F.lit(True))
    rule, verdict = longest_rule(host_rules, F.col("host"), F.col("path"))
    learned = F.when(F.col("hit"), "block").otherwise("allow")
    return urls.join(hit, ROW, "left").select(
        "id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict")
    )


def url_report(pages: DataFrame, labels: DataFrame) -> DataFrame:
    return judge_urls(pages, labels).withColumnRenamed("id", "page_id")
