"""Block and allow rules for urls, with DataFrame functions only.

A rule is a host and a path. It fits a url if the url's host is the rule's or a subdomain of it and
the url's path starts with the rule's; of the rules that fit, the one of most characters (host and
path together) decides, of equal ones the one with the longer host, then the greater text. A url that no
rule fits gets the default verdict.

What a verdict depends on is little: as many last labels of a host as the list's longest host has, and
as many first characters of a path as its longest path has. These sites are made distinct before
anything else, so a host with a third of all rows is one row for each of its beginnings of paths. A
site's candidates are its ends of hosts with its beginnings of paths that end at a slash, as many as
the deepest rule needs. They pass a blocked Bloom filter of the list, then an exact hash join on
(host, directory), which removes the false positives, then the whole path is compared. The verdicts
join the urls by site.

The filter, the list and the verdicts are broadcast only where their counted size is below
BROADCAST_BYTES; beyond it the same joins shuffle, and Spark splits what is skewed.

Defined cases: a null url, or one without ://, has an empty host and path; an empty host has no
subdomains; null hosts, paths and verdicts of rules are empty, empty and `block`; of equal rules with
different verdicts `block` wins; without rules all urls get the default; repeated rows are judged alike; an empty table
gives no rows; all other columns are kept, and what the operator adds gets underscores before its
name where the name is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bloom
from .common import free_names, settle, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK, ALLOW = "block", "allow"
BROADCAST_BYTES = 16 << 20
#: The rules of the registered query: (host, path, verdict).
RULES = [("net", "/", BLOCK), ("example.net", "/en/", ALLOW), ("example.com", "/de/", BLOCK), ("org", "/fr/", ALLOW)]


def _rest(url: Column) -> Column:
    at = F.call_function("locate", F.lit("://"), url)
    return F.when(at > 0, F.call_function("substring", url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, in small letters; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What stands between the host and the next ? or #."""
    rest = F.coalesce(_rest(url), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.regexp_extract(F.call_function("substring", rest, F.length(host) + 1), r"^[^?#]*", 0)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def _depth(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _end(host: Column, n: Column) -> Column:
    """The last n labels of a host."""
    return F.call_function("substring_index", host, F.lit("."), -n)


def _directory(path: Column, n: Column) -> Column:
    """A path up to and with its n-th slash."""
    return F.when(n > 0, F.concat(F.call_function("substring_index", path, F.lit("/"), n), F.lit("/"))).otherwise("")


class RuleList:
    """Rules as a table with the filter over them; sizes are counted, so that only small ones are broadcast."""

    def __init__(self, rules: DataFrame) -> None:
        """rules: (host, path, verdict)."""
        text = lambda c: F.coalesce(F.col(c), F.lit(""))
        own = rules.select(F.translate(text("host"), UPPER, LOWER).alias("_host"), text("path").alias("_path"), F.coalesce("verdict", F.lit(BLOCK)).alias("_verdict"))
        own = own.groupBy("_host", "_path").agg(F.when(F.bool_or(F.col("_verdict") == BLOCK), BLOCK).otherwise(F.min("_verdict")).alias("_verdict"))
        self.rules = settle(own.withColumn("_dir", _directory(F.col("_path"), _depth(F.col("_path")))))
        size = F.length("_host") + 2 * F.length("_path") + 64
        n = self.rules.agg(F.count(F.lit(1)).alias("n"), F.max(_labels(F.col("_host"))).alias("labels"), F.max(_depth(F.col("_path"))).alias("depth"), F.max(F.length("_path")).alias("chars"), F.sum(size).alias("bytes")).first()
        self.n, self.labels, self.depth, self.chars, self.bytes = n.n, n.labels, n.depth, n.chars, n.bytes
        self.blocks = bloom.blocks_for(self.n)

    def filter(self) -> DataFrame:
        return bloom.bloom_filter(self.rules, self.blocks, "_host", "_dir", block="_block", words="_words")

    def small(self, rows: DataFrame, size: int, limit: int) -> DataFrame:
        return F.broadcast(rows) if size <= limit else rows

    def candidates(self, sites: DataFrame) -> DataFrame:
        """sites: (_tail, _head). A row for each (host, directory) that a rule which fits would have."""
        tail, head, least = F.col("_tail"), F.col("_head"), F.lit(1)
        ends = F.transform(F.sequence(least, F.least(F.lit(self.labels), _labels(tail))), lambda n: _end(tail, n))
        begins = F.transform(F.sequence(F.lit(0), F.least(F.lit(self.depth), _depth(head))), lambda n: _directory(head, n))
        return sites.withColumn("_host", F.explode(ends)).withColumn("_dir", F.explode(begins))

    def possible(self, sites: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
        """The candidates that the filter passes: all that the list has, and a few that it hasn't."""
        keyed = self.candidates(sites).withColumn("_block", bloom.block_of(self.blocks, "_host", "_dir"))
        asked = keyed.join(self.small(self.filter(), self.blocks * bloom.BLOCK_BYTES, limit), "_block")
        return asked.where(bloom.may_contain("_words", "_host", "_dir")).drop("_block", "_words")

    def verdicts(self, sites: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
        """(_tail, _head, _rule, _said) of the sites that a rule fits."""
        hits = self.possible(sites, limit).join(self.small(self.rules, self.bytes, limit), ["_host", "_dir"]).where(F.col("_head").startswith(F.col("_path")))
        order = F.struct(F.length("_host") + F.length("_path"), F.length("_host"), "_host", "_path")
        best = F.max_by(F.struct(F.concat("_host", "_path").alias("rule"), F.col("_verdict").alias("said")), order)
        return hits.groupBy("_tail", "_head").agg(best.alias("b")).select("_tail", "_head", F.col("b.rule").alias("_rule"), F.col("b.said").alias("_said"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW, limit: int = BROADCAST_BYTES) -> DataFrame:
    """pages with host, path, rule (null: none fits) and verdict. rules: (host, path, verdict)."""
    listed = RuleList(rules)
    host, path, rule, verdict, tail, head = free_names(pages, "host", "path", "rule", "verdict", "url_tail", "url_head")
    rows = pages.withColumns({host: host_of(F.col(url)), path: path_of(F.col(url))})
    if not listed.n:
        return rows.withColumns({rule: F.lit(None).cast("string"), verdict: F.lit(default)})
    site = {tail: _end(F.col(host), F.lit(listed.labels)), head: F.left(F.col(path), F.lit(listed.chars))}
    rows = rows.withColumns(site)
    said = settle(listed.verdicts(rows.select(F.col(tail).alias("_tail"), F.col(head).alias("_head")).distinct(), limit))
    size = said.agg(F.coalesce(F.sum(F.length("_tail") + F.length("_head") + F.length("_rule") + 64), F.lit(0))).first()[0]
    joined = rows.join(listed.small(said, size, limit), (F.col(tail) == F.col("_tail")) & (F.col(head) == F.col("_head")), "left")
    return joined.select(*pages.columns, host, path, F.col("_rule").alias(rule), F.coalesce("_said", F.lit(default)).alias(verdict))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages
),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
),
rules(rule_host, rule_path, said) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
fit AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, said, length(rule_host || rule_path) AS chars
  FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, arg_max(rule, chars) AS rule, coalesce(arg_max(said, chars), '{ALLOW}') AS verdict
FROM fit GROUP BY page_id, host, path
"""
