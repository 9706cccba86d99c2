"""Operator 2: URL filters as a sort-merge range join.

A rule is a host and a path prefix; it fits its host and all subdomains. The
canonical key of a rule is its host with the labels reversed, each closed by a
dot, then its path: ``example.net/en/`` becomes ``net.example./en/``. All keys
with that prefix form one interval of the sorted keys, and two intervals are
nested or disjoint. An url asks at one point per suffix of its host that has
rules (``net./en/25``, ``net.example./en/25``), so a rule fits an url exactly
if one of the points lies in its interval.

Rules and points are sorted together into ranges; a sweep over each range
keeps the stack of rules whose interval is open and answers a point with the
innermost one. The rules already open where a range starts are those whose
key is a prefix of its first key; they are looked up by equality and handed to
the range first. Points of one key carry their row number in the sort key, so
a host that holds a third of all urls is cut into many ranges.

Defined cases: null url or one without ``://`` has empty host and path and
fits no rule; the longest rule (host and path together, then the longer host)
wins; of equal rules block wins; repeated urls are judged one by one; a very
long url is one key like any other; an empty table or empty rules are fine;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import shuffle_partitions, table
from churnlens.session import materialize

DEFAULT_VERDICT = "allow"
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(col: Column) -> Column:
    return F.translate(col, _UPPER, _UPPER.lower())


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_host(labels: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("."))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, key, kind): open rules on a stack, points answered by the top."""
    part, stack = None, []
    for batch in batches:
        rows, rules = [], []
        for p, key, kind, row, rule in zip(*(c.to_pylist() for c in batch.columns)):
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, rule))
            elif stack:
                rows.append(row)
                rules.append(stack[-1][1])
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(rules, pa.int64())], names=["row", "rule"])


def interval_sweep(points: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, rule): for each point (``key, row``) the rule (``key, rule``) with the longest key that is its prefix."""
    spark = points.sparkSession
    events = points.select("key", F.lit(1).alias("kind"), "row", F.lit(None).cast("long").alias("rule")).unionByName(
        rules.select("key", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("row"), "rule"))
    events = materialize(
        events.repartitionByRange(shuffle_partitions(spark), "key", "kind", "row")
        .withColumn("part", F.spark_partition_id()), "url_events")
    longest = rules.agg(F.max(F.length("key"))).first()[0] or 0
    starts = events.groupBy("part").agg(F.min("key").alias("first_key"))
    prefixes = starts.filter(F.length("first_key") > 0).select("part", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(longest), F.length("first_key")))),
        lambda n: F.substring("first_key", F.lit(1), n))).alias("key"))
    located = events.filter("kind = 0").select("key", "rule", F.col("part").alias("_rule_part"))
    carried = prefixes.join(located, "key").filter("_rule_part < part").select(
        "key", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("row"), "rule", "part")
    ordered = (events.unionByName(carried).select("part", "key", "kind", "row", "rule")
               .repartition("part").sortWithinPartitions("part", "key", "kind", "row"))
    return ordered.mapInArrow(_sweep, "row long, rule long")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row.

    ``rules``: (verdict, host, path); the rule string is host and path.
    """
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").groupBy("host", "path").agg(
        F.max(F.struct(F.col("verdict") == "block", "verdict"))["verdict"].alias("verdict"))
    labels = F.split("host", r"\.", -1)
    rules = materialize(rules.select(
        F.monotonically_increasing_id().alias("rule"), reversed_host(labels).alias("suffix"),
        F.concat(reversed_host(labels), F.col("path")).alias("key"), F.size(labels).alias("labels"),
        F.concat("host", "path").alias("rule_text"), F.length("host").alias("host_length"), "verdict"), "url_rules")
    urls = materialize(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"),
        host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")), "urls")
    deepest = rules.agg(F.max("labels")).first()[0] or 0
    n = F.size(labels)
    suffix = F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(deepest), n))),
        lambda k: reversed_host(F.slice(labels, n - k + 1, k)))).alias("suffix")
    points = urls.filter("host <> ''").select("row", "path", suffix).join(
        rules.select("suffix").distinct(), "suffix", "left_semi")
    found = interval_sweep(points.select(F.concat("suffix", "path").alias("key"), "row"), rules.select("key", "rule"))
    best = found.join(rules.select("rule", "rule_text", "host_length", "verdict"), "rule").groupBy("row").agg(
        F.max(F.struct(F.length("rule_text").alias("n"), "host_length", "rule_text", "verdict")).alias("best"))
    return urls.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule_text").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"))


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


OP2_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '') AS raw_host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
h AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC) AS rn
  FROM h JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM h LEFT JOIN m ON m.page_id = h.page_id AND m.host = h.host AND m.path = h.path AND m.rn = 1
"""
