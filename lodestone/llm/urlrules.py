"""URL filter: longest matching (host, path-prefix) rule by a sort-merge range join.

Hosts are written with reversed labels and a closing dot (``m.example.org`` ->
``org.example.m.``), so a rule for a host and its subdomains is the key interval
``[prefix, prefix with the last "." replaced by "/")``.  The intervals are nested or
disjoint.  Rule starts and ends become boundary rows that carry the stack of nested
rules active from there on; urls and boundaries are sorted together and each url
takes over the stack of the last boundary before it (one sorted sweep).  Of the
stack, the rules whose path begins the url's path are kept and the longest wins.

Everything is DataFrame code.  Urls are dealt to the sweeps by a hash of the row, so
a hot host spreads over all of them; the boundaries are repeated once per sweep.
Rules are taken in blocks of ``RULE_BLOCK``, which bounds what is repeated.

Edge cases: a null url or one without ``://`` has empty host and path and no rule; an
empty rule list gives the default verdict everywhere; repeated rows stay; a rule given
twice counts once (of two verdicts for one rule, ``block`` stands).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import partitions, table

#: Rules handled by one sweep; larger lists take several sweeps over the urls.
RULE_BLOCK = 20_000

#: The rules of the registered query: (host, path, verdict).
RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)

DEFAULT_VERDICT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty where there is no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def host_key(host: Column) -> Column:
    """Reversed labels, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _boundaries(rules: DataFrame) -> DataFrame:
    """Rows (key, stack): from ``key`` on, ``stack`` holds the active nested rules."""
    ruled = rules.select(
        host_key(F.col("host")).alias("prefix"),
        F.struct(
            F.length(F.concat("host", "path")).alias("size"),
            F.length("host").alias("host_size"),
            "verdict",
            F.concat("host", "path").alias("rule"),
            "path",
        ).alias("entry"),
    )
    own = ruled.groupBy("prefix").agg(F.collect_set("entry").alias("entries"))
    labels = F.split(F.regexp_replace("prefix", r"\.$", ""), r"\.")
    depth = F.size(labels)
    above = F.transform(F.sequence(F.lit(1), depth), lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))
    chain = own.select("prefix", F.explode(above).alias("up"))
    nested = (
        chain.join(own.select(F.col("prefix").alias("up"), "entries"), "up")
        .groupBy("prefix")
        .agg(
            F.flatten(F.collect_list("entries")).alias("opened"),
            F.flatten(F.collect_list(F.when(F.col("up") != F.col("prefix"), F.col("entries")))).alias("closed"),
        )
    )
    start = nested.select(F.col("prefix").alias("key"), F.col("opened").alias("stack"), F.lit(1).alias("kind"))
    end = nested.select(F.regexp_replace("prefix", r"\.$", "/").alias("key"), F.col("closed").alias("stack"), F.lit(0).alias("kind"))
    return start.unionByName(end)


def _sweep(urls: DataFrame, rules: DataFrame, best: str) -> DataFrame:
    """Add column ``best``: the winning entry of these rules, or null."""
    lanes = partitions(urls.sparkSession)
    bounds = _boundaries(rules).withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).withColumnRenamed("stack", "_opens")
    rows = urls.withColumn("_lane", F.pmod(F.xxhash64("_row", "_key"), F.lit(lanes)).cast("int")).withColumn("kind", F.lit(2))
    both = rows.unionByName(bounds.withColumnRenamed("key", "_key"), allowMissingColumns=True)
    order = Window.partitionBy("_lane").orderBy("_key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("_stack", F.last("_opens", ignorenulls=True).over(order)).where(F.col("kind") == 2)
    fits = F.filter("_stack", lambda r: F.startswith(F.col("path"), r["path"]))
    return swept.withColumn(best, F.array_max(fits)).drop("_opens", "_stack", "kind", "_lane")


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, default: str = DEFAULT_VERDICT, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Per row of ``pages``: id, host, path, rule (null if none fits), verdict."""
    spark: SparkSession = pages.sparkSession
    rules = sorted(set(rules))
    host, path = url_parts(F.col(url_column))
    urls = pages.select(F.col(id_column).alias("_row"), host.alias("host"), path.alias("path")).withColumn("_key", host_key(F.col("host")))
    found = []
    for k in range(0, len(rules), RULE_BLOCK):
        block = spark.createDataFrame(rules[k : k + RULE_BLOCK], "host string, path string, verdict string")
        found.append(f"_best{k}")
        urls = _sweep(urls, block, found[-1])
    if not found:
        winner = F.lit(None).cast("struct<rule:string,verdict:string>")
    else:
        winner = F.array_max(F.array(*(F.col(c) for c in found))) if len(found) > 1 else F.col(found[0])
    return urls.withColumn("_won", winner).select(
        F.col("_row").alias(id_column), "host", "path", F.col("_won.rule").alias("rule"), F.coalesce(F.col("_won.verdict"), F.lit(default)).alias("verdict")
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))


ORACLE = """
WITH rules(rhost, rpath, rverdict) AS (VALUES
  ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
  ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
raw AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM cut),
parts AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM raw),
best AS (SELECT p.page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS verdict
         FROM parts p JOIN rules r ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)
         GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b ON p.page_id = b.page_id
"""
