"""URL rules, looked up by hash prefixes.

A rule has an action, a host and a path; it fits its host and all subdomains where the URL's
path starts with the rule's. A URL is expanded into expressions, each a suffix of its host
followed by a prefix of its path that ends at a slash. A rule's key is its host and its path up to
the last slash, so every rule that fits is keyed by one of the URL's expressions. Expressions
and keys meet on the first 32 bits of their SHA-256; the full digest, and what a rule's path
has beyond its last slash, are compared in the join. The longest rule wins, host and path
together; of equally long ones the one with the longer host, then a block.

Each distinct host and path is judged once, and no expression is made that is longer than the
rules' longest in labels or slashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, free_name

PREFIX_DIGITS = 8  # of 64, 4 bits each
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty if it is null or has no ://."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^.*/", 0)


def keyed_rules(rules: DataFrame) -> DataFrame:
    """Rules (action, host, path) with their keys' digests. A rule with a null in it fits nothing."""
    host, path = F.translate(F.col("host"), UPPER, LOWER), F.col("path")
    rows = rules.select(F.col("action"), host.alias("rule_host"), path.alias("rule_path")).dropna().distinct()
    digest = F.sha2(F.concat("rule_host", _folder(F.col("rule_path"))).cast("binary"), 256)
    return rows.withColumn("rule_digest", digest).withColumn("rule_prefix", F.substring(digest, 1, PREFIX_DIGITS))


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """All suffixes of host with up to `labels` labels, times the prefixes of path with up to
    `slashes` slashes that end with one, and the empty prefix."""
    parts = F.split(host, r"\.", -1)
    shortest = F.least(F.size(parts), F.lit(labels))
    suffixes = F.transform(F.sequence(F.lit(1), shortest), lambda n: F.array_join(F.slice(parts, -n, n), "."))
    steps = F.split(path, "/", -1)
    deepest = F.least(F.size(steps) - 1, F.lit(slashes))
    prefixes = F.transform(F.sequence(F.lit(0), deepest), lambda n: F.array_join(
        F.concat(F.slice(steps, F.lit(1), n), F.when(n > 0, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))), "/"))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """pages with the columns host, path, rule and verdict; columns of such names are replaced.

    rule is the winning rule's host and path, null if none fits, and verdict its action or
    else default. Null URLs, and those without ://, have an empty host and path. Repeated rows
    are judged each; no rules means no verdict but default; an empty table gives no rows.
    """
    rules = keyed_rules(rules)
    longest = rules.agg(
        F.coalesce(F.max(F.size(F.split("rule_host", r"\.", -1))), F.lit(0)),
        F.coalesce(F.max(F.size(F.split("rule_path", "/", -1)) - 1), F.lit(0))).first()
    host, path = host_and_path(column(url_col).cast("string"))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    own = {c: free_name(pages, c) for c in ("url_host", "url_path", "best_host", "best_path", "best")}
    rows = pages.withColumns({own["url_host"]: host, own["url_path"]: path})

    distinct = rows.select(F.col(own["url_host"]).alias("h"), F.col(own["url_path"]).alias("p")).distinct()
    found = distinct.select("h", "p", F.explode(expressions(F.col("h"), F.col("p"), *longest)).alias("expression"))
    found = found.withColumn("digest", F.sha2(F.col("expression").cast("binary"), 256))
    found = found.withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    fits = (F.col("prefix") == F.col("rule_prefix")) & (F.col("digest") == F.col("rule_digest"))
    found = found.join(rules, fits & F.col("p").startswith(F.col("rule_path")))
    name = F.concat("rule_host", "rule_path")
    order = F.struct(F.length(name), F.length("rule_host"), F.col("action") == "block", name, F.col("action"))
    best = found.groupBy("h", "p").agg(F.max_by(F.struct(name.alias("rule"), "action"), order).alias("best"))

    best = best.select(*[F.col(c).alias(own[f"best{end}"]) for c, end in (("h", "_host"), ("p", "_path"), ("best", ""))])
    same = (F.col(own["url_host"]) == F.col(own["best_host"])) & (F.col(own["url_path"]) == F.col(own["best_path"]))
    return rows.join(best, same, "left").select(
        *[column(c) for c in kept], F.col(own["url_host"]).alias("host"), F.col(own["url_path"]).alias("path"),
        F.col(own["best"])["rule"].alias("rule"), F.coalesce(F.col(own["best"])["action"], F.lit(default)).alias("verdict"))


def sql(rules: list[tuple[str, str, str]], default: str = "allow") -> str:
    """The same over pages (page_id, url) as one DuckDB statement, by comparing every rule."""
    values = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in rules)
    return f"""
WITH rules(action, rule_host, rule_path) AS (VALUES {values}),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
),
best AS (
  SELECT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(action, length(rule_host || rule_path)) AS action
  FROM (SELECT DISTINCT host, path FROM parts), rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(action, '{default}') AS verdict
FROM parts LEFT JOIN best USING (host, path)
"""
