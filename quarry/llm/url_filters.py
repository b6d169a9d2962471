"""URL filters: host-suffix and path-prefix expressions matched through short hash prefixes (operator 3).

Every distinct URL is expanded into host-suffix and path-prefix expressions. They equi-join the rules on the first bytes
of their SHA-256; full digests confirm, and of the rules that fit a URL the longest wins. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, sized

#: Rules of the query: action, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8
MOST_BROADCAST_RULES = 100_000


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ? or #; empty for null or without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """urls with the columns host, path, rule, verdict added (rule is null and verdict `default` where none fits).

    rules: action (allow or block), host, path. A rule fits its host and the hosts below it if the URL's path starts with its
    path. Of several, the longest host and path together wins, then the longer host, then block before allow. Null or odd URLs have an empty host and path,
    which no rule with a host fits. Repeated rows are each judged; other columns stay. An empty table of either kind works.
    """
    rules = rules.select("action", F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path")).distinct()
    # only lengths that some rule has are worth an expression: one row, a number per distinct length of the rules' paths
    cuts, labels = rules.agg(F.sort_array(F.collect_set(F.length("r_path"))), F.coalesce(F.max(F.size(F.split("r_host", "[.]"))), F.lit(0))).first()
    rule_keys = rules.withColumn("r_digest", digest(F.col("r_host"), F.col("r_path"))).withColumn("h", F.substring("r_digest", 1, PREFIX_HEX))
    distinct = urls.select(F.col(url_col).alias("u")).distinct().filter("u IS NOT NULL").withColumns({"host": host_of(F.col("u")), "path": path_of(F.col("u"))})
    parts = distinct.withColumn("p", F.split("host", "[.]"))
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size("p"), F.lit(max(1, labels)))), lambda n: F.concat_ws(".", F.slice("p", -n, n)))
    prefixes = F.transform(F.filter(F.array(*map(F.lit, cuts)).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.expr("path").substr(F.lit(1), n))
    asked = (
        parts.filter("host <> ''")
        .select("u", F.explode(suffixes).alias("s"), prefixes.alias("x"))
        .select("u", "s", F.explode("x").alias("x"))
        .select("u", digest(F.col("s"), F.col("x")).alias("digest"), F.col("s"), F.col("x"))
        .withColumn("h", F.substring("digest", 1, PREFIX_HEX))
    )
    hits = asked.join(sized(rule_keys, MOST_BROADCAST_RULES), "h").filter("digest = r_digest AND s = r_host AND x = r_path")
    rank = F.struct(F.length(F.concat("r_host", "r_path")), F.length("r_host"), F.when(F.col("action") == "block", 1).otherwise(0), "r_host", "r_path")
    asked_url, found = free_name(urls, "u"), free_name(urls, "best")
    best = hits.groupBy(F.col("u").alias(asked_url)).agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), "action"), rank).alias(found))
    out = urls.join(best, urls[url_col] == best[asked_url], "left")
    mine = {"host", "path", "rule", "verdict"}
    kept = [urls[c] for c in urls.columns if c.lower() not in mine]
    return out.select(*kept, host_of(urls[url_col]).alias("host"), path_of(urls[url_col]).alias("path"), F.col(found)["rule"].alias("rule"), F.coalesce(F.col(found)["action"], F.lit(default)).alias("verdict"))


ORACLE = """
WITH rules(action, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
p AS (SELECT page_id, url,
  translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*(/[^?#]*)', 1, 's') AS path FROM pages),
b AS (SELECT p.*, r.action, r.rhost || r.rpath AS rule,
  row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS n
  FROM p LEFT JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM b WHERE n = 1
"""
