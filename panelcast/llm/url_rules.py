"""URL filters by hashed host-suffix and path-prefix expressions.

A rule (host, path, verdict) fits its host and all subdomains if the url's path starts with
the rule's path.  Each distinct (host, head of the path) is expanded into the host suffixes
and path prefixes whose sizes occur among the rules (so a url makes at most label counts x
path lengths expressions).  The expressions' SHA-256 digests are joined with the rules' on
their first four bytes, full digests are then confirmed and the longest rule wins (host and
path together; of equal lengths the longer host, then block).  Only DataFrame functions run.

The rule table may be of any size: Spark decides by its size how it is joined.  A hot host is
one row per distinct head of its paths.  Sites that hold ``HOT_SHARE`` of the pages or more
(so at most its inverse) are broadcast with their rules, and their pages are not shuffled.

Defined results: null urls and urls without ``://`` have an empty host and path, and no
rule; without a rule the verdict is ``default`` (allow); rules with an empty host or null
fields never fit; equal rules count once; repeated pages give repeated results; empty tables
of either kind are fine; extra columns are ignored by the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import docs_table, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DIGEST_PREFIX = 8  # hex digits
#: Share of all pages from which a site (host, head of the path) is hot; its inverse bounds their number.
HOT_SHARE = 1 / 1000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ://."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def apply_rules(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", default: str = "allow",
                hot_share: float = HOT_SHARE) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages (page_id, url)."""
    host, path = split_url(F.col("url").cast("string"))
    pages = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rules = (rules.select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
             .filter("r_host <> '' and r_path is not null and r_verdict is not null").distinct()
             .withColumn("digest", F.sha2(F.concat("r_host", "r_path"), 256))
             .withColumn("short", F.substring("digest", 1, DIGEST_PREFIX)))
    sizes = rules.agg(F.sort_array(F.collect_set(_labels(F.col("r_host")))).alias("labels"),
                      F.sort_array(F.collect_set(F.length("r_path"))).alias("lengths")).first()
    labels, lengths = sizes["labels"] or [1], sizes["lengths"] or [0]
    head = F.substring("path", 1, max(lengths))
    pages = pages.withColumn("head", head)
    sites = materialize(pages.groupBy("host", "head").agg(F.count(F.lit(1)).alias("pages")), "sites")
    hot_from = hot_share * (sites.agg(F.sum("pages")).first()[0] or 0)
    asked = (sites.withColumn("n", F.explode(F.array(*[F.lit(n) for n in labels]))).filter(_labels(F.col("host")) >= F.col("n"))
             .withColumn("k", F.explode(F.array(*[F.lit(k) for k in lengths]))).filter(F.length("head") >= F.col("k"))
             .withColumn("own", F.sha2(F.concat(F.expr("substring_index(host, '.', -n)"), F.expr("substring(head, 1, k)")), 256))
             .select("host", "head", "own", F.substring("own", 1, DIGEST_PREFIX).alias("short")))
    order = F.struct(F.length(F.concat("r_host", "r_path")), F.length("r_host"), (F.col("r_verdict") == "block"), "r_host", "r_path", "r_verdict")
    won = (asked.join(rules, "short").filter("own = digest").groupBy("host", "head")
           .agg(F.max_by(F.struct("r_host", "r_path", "r_verdict"), order).alias("won")))
    hot = F.broadcast(sites.filter(F.col("pages") >= hot_from).select("host", "head").join(won, ["host", "head"], "left")
                      .withColumn("hot", F.lit(True)))
    marked = pages.join(hot, ["host", "head"], "left")
    cold = marked.filter("hot is null").drop("won", "hot").join(won, ["host", "head"], "left")
    return (marked.filter("hot").drop("hot").unionByName(cold)
            .select(id_col, "host", "path", F.concat("won.r_host", "won.r_path").alias("rule"),
                    F.coalesce("won.r_verdict", F.lit(default)).alias("verdict")))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return apply_rules(docs_table(spark, sf_dir, "pages"), rules)


SQL = {
    "op2_url_filters": """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h, rest FROM cut
), p AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM parts
), r(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT page_id, host, path, rh || rp AS rule, v,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rh || rp) DESC NULLS LAST, length(rh) DESC) AS k
  FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM best WHERE k = 1""",
}
QUERIES = {"op2_url_filters": op2_url_filters}
