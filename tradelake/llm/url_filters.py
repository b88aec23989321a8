"""URL rules by host suffix and path prefix, matched through short hashes.

A rule (host, path, verdict) fits its host and all subdomains where the URL's
path starts with the rule's.  Every URL is expanded into the host suffixes and
path prefixes that rules can have (as many labels, as long a path), each
expression is hashed with SHA-256, candidates meet their rules in an equi-join
on the first four bytes and are confirmed by the full digest.  Of the rules that
fit, the longest wins: most characters of host and path, then the longer host,
then block before allow.  Without one the verdict is the method's default, allow.

Rules are broadcast up to ``broadcast_rules`` rows (they are counted first);
more are joined by shuffle, salted, because an expression such as a top-level
domain stands in a large share of all URLs.

Only DataFrame functions are used.  Defined results: a null URL, or one without
``://``, has empty host and path and meets no rule with a host; repeated rows
are judged each; rules with a null host or path are ignored; other columns of
the input are kept out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import stored

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    after = F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(host) + 1, F.length(after)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def digest(host: Column, path: Column) -> Column:
    """Of both parts with a ``#`` between, which neither part of a URL can hold: equal
    digests mean equal hosts and equal paths."""
    return F.sha2(F.concat(host, F.lit("#"), path), 256)


def short_hash(full: Column) -> Column:
    """The first four bytes of a digest as a number."""
    return F.conv(F.substring(full, 1, 8), 16, 10).cast("long")


def hashed_rules(rules: DataFrame) -> DataFrame:
    """Rules by digest, one row each; of two verdicts for the same rule block stays."""
    host, path = F.translate("host", UPPER, LOWER), F.col("path")
    named = (rules.where(F.col("host").isNotNull() & path.isNotNull())
             .select(host.alias("rule_host"), path.alias("rule_path"), "verdict"))
    one = named.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("rule_verdict"))  # "block" > "allow"
    full = digest(F.col("rule_host"), F.col("rule_path"))
    return one.select("rule_host", "rule_path", "rule_verdict", full.alias("rule_digest"),
                      short_hash(full).alias("short"))


def expressions(urls: DataFrame, label_counts: list[int], path_lengths: list[int]) -> DataFrame:
    """Distinct (host, path) -> host, path, short, digest of every expansion."""
    counts = F.array(*[F.lit(n) for n in label_counts])
    lengths = F.array(*[F.lit(n) for n in path_lengths])
    hosts = F.filter(counts, lambda n: n <= labels(F.col("host")))
    paths = F.filter(lengths, lambda n: n <= F.length("path"))
    each = (urls.select("host", "path", F.explode(hosts).alias("n"))
            .select("host", "path", F.expr("substring_index(host, '.', -n)").alias("suffix")))
    each = (each.select("host", "path", "suffix", F.explode(paths).alias("m"))
            .select("host", "path", digest(F.col("suffix"), F.expr("left(path, m)")).alias("digest")))
    return each.select("host", "path", "digest", short_hash(F.col("digest")).alias("short"))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = ALLOW, broadcast_rules: int = 100_000, salts: int = 16) -> DataFrame:
    """Every row's id, host, path, rule (host and path of the one that won) and verdict."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    listed = stored(hashed_rules(rules), "url-rules")
    shape = listed.agg(F.count(F.lit(1)).alias("n"), F.collect_set(labels(F.col("rule_host"))).alias("labels"),
                       F.collect_set(F.length("rule_path")).alias("lengths")).first()
    if not shape.n:
        return urls.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    found = expressions(urls.select("host", "path").distinct(), sorted(shape.labels), sorted(shape.lengths))
    if shape.n <= broadcast_rules:
        met = found.join(F.broadcast(listed), "short")
    else:
        salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = (found.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int"))
               .join(salted, ["short", "salt"]))
    fits = met.where(F.col("digest") == F.col("rule_digest"))
    rank = F.struct((F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("by_host"),
                    F.col("rule_verdict").alias("verdict"),
                    F.concat("rule_host", "rule_path").alias("rule"))
    best = stored(fits.groupBy("host", "path").agg(F.max(rank).alias("best"))
                  .select("host", "path", "best.rule", "best.verdict"), "url-verdicts")
    return (urls.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))


def judge_sql(rules: list[tuple[str, str, str]]) -> str:
    """The same rows in DuckDB, by comparing every URL with every rule."""
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    rest = "case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end"
    return rf"""
with rules(rule_host, rule_path, rule_verdict) as (values {listed}),
split as (select page_id, {rest} as after from pages),
hosts as (select page_id, after, regexp_extract(after, '^[^/?#]*') as raw from split),
urls as (select page_id, translate(raw, '{UPPER}', '{LOWER}') as host,
                regexp_extract(substr(after, length(raw) + 1), '^[^?#]*') as path from hosts),
judged as (
  select *, (select max(row(length(rule_host) + length(rule_path), length(rule_host), rule_verdict, rule_host || rule_path))
             from rules where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)) as best
  from urls)
select page_id, host, path, best[4] as rule, coalesce(best[3], '{ALLOW}') as verdict from judged"""
