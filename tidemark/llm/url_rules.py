"""URL filters: fixed rules by host and path, and association rules mined from labelled URLs.

FP-growth finds combinations of URL tokens (labels of the host, first folder, ending, names of
query parameters) that go with a bad label. Rules are kept if support, confidence and lift are
high enough and no shorter rule with at least the same confidence says as much. Each rule is
indexed under its rarest token, so URLs meet few rules; a URL is blocked if it has all tokens
of one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, shared_table


@dataclass(frozen=True)
class HostRule:
    """A rule for a host with its subdomains and for paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


HOST_RULES = (
    HostRule("com", "/", "allow"),
    HostRule("example.com", "/en/", "block"),
    HostRule("www.example.com", "/en/", "allow"),
    HostRule("net", "/es/", "block"),
    HostRule("net", "/fr/", "block"),
)
#: Least number of bad labelled URLs, least confidence and least lift of a mined rule. A number and not a
#: share: what is bad often enough to be sure of is so in a table of any size.
SUPPORT, CONFIDENCE, LIFT = 30, 0.8, 1.5
BAD = "label=bad"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_rule(host: Column, path: Column, rules: tuple[HostRule, ...] = HOST_RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: host labels, top domain, first folder, ending and parameter names."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    folder = F.regexp_extract(path, r"^/([^/]+)/", 1)
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda p: F.split(p, "=")[0])
    tag = lambda name, c: F.when(c != "", F.concat(F.lit(name + "="), c))
    listed = F.concat(
        F.transform(labels, lambda label: tag("host", label)),
        F.array(tag("top", F.element_at(labels, -1)), tag("folder", folder), tag("ending", ending)),
        F.transform(names, lambda n: tag("parameter", n)),
    )
    return F.array_distinct(F.filter(listed, lambda t: t.isNotNull()))


def mine(labelled: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT) -> DataFrame:
    """Rules (rule_id, antecedent, confidence, support, lift) from rows (url, bad).

    ``support`` counts bad URLs with all tokens of the rule. FP-growth counts itemsets on the executors; the
    driver gets the tokens that occur ``support`` times, at most tokens / ``support`` many. Rows with a null label or url are left out; without rows there are no rules.
    """
    from pyspark.ml.fpm import FPGrowth

    spark = labelled.sparkSession
    schema = "rule_id bigint, antecedent array<string>, confidence double, support double, lift double"
    rows = labelled.where("url is not null and bad is not null").select("url", "bad")
    with_label = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    baskets = shared_table(rows.select(F.concat(tokens(F.col("url")), with_label).alias("items")), "url-baskets")
    total = baskets.count()
    if not total:
        return spark.createDataFrame([], schema)
    # Half a row less, so that rounding never asks for one more.
    model = FPGrowth(itemsCol="items", minSupport=max(0.0, support - 0.5) / total, minConfidence=confidence).fit(baskets)
    found = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD) & (F.col("lift") >= lift))
    rules = found.select(F.sort_array("antecedent").alias("antecedent"), "confidence", "support", "lift")
    rules = shared_table(rules, "url-rules")
    # A rule says no more than a shorter one inside it with at least its confidence. Each rule lists the parts of
    # its antecedent, and a part meets the one rule that is equal to it.
    parts = "aggregate(antecedent, array(cast(array() AS array<string>)), (done, t) -> concat(done, transform(done, p -> concat(p, array(t)))))"
    inside = rules.select("antecedent", "confidence", F.explode(F.expr(parts)).alias("part")).where("size(part) between 1 and size(antecedent) - 1")
    shorter = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("c"))
    implied = inside.join(shorter, "part").where("c >= confidence")
    kept = rules.join(implied.select("antecedent").distinct(), "antecedent", "left_anti")
    return kept.select(F.xxhash64("antecedent").alias("rule_id"), "antecedent", "confidence", "support", "lift")


def inverted_index(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """(token, rule_id, antecedent): every rule under its rarest token among the labelled URLs."""
    seen = labelled.where("url is not null").select(F.explode(tokens(F.col("url"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    listed = rules.select("rule_id", "antecedent", F.explode("antecedent").alias("token")).join(seen, "token")
    rarest = listed.groupBy("rule_id").agg(F.min_by(F.struct("token", "antecedent"), F.struct("n", "token")).alias("r"))
    return rarest.select("r.token", "rule_id", "r.antecedent")


def judge(urls: DataFrame, index: DataFrame, rules: tuple[HostRule, ...] = HOST_RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict and the mined rules that fit, for every row.

    Null URLs and URLs without ``://`` have neither host nor path and are allowed. Rows may repeat.
    Distinct URLs are matched once; the index, a few rows, is joined by its true size.
    """
    url = F.col(url_col)
    parts = urls.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    parts = parts.withColumn("fixed", host_rule(F.col("host"), F.col("path"), rules))
    index = shared_table(index, "url-index")
    open_urls = parts.where("fixed is null and url is not null").select("url").distinct()
    met = open_urls.select("url", tokens(F.col("url")).alias("tokens")).withColumn("token", F.explode("tokens")).join(index, "token")
    hits = met.where(F.size(F.array_except("antecedent", "tokens")) == 0).groupBy("url").agg(F.sort_array(F.collect_set("rule_id")).alias("mined"))
    joined = parts.join(hits, "url", "left")
    verdict = F.coalesce(F.col("fixed.verdict"), F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"), F.size(F.coalesce("mined", F.array().cast("array<bigint>"))).cast("long").alias("n_mined"))
