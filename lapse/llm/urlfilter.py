"""URL filter lists as a sort-merge range join with a stack of nested rules.

A rule (host, path prefix) covers its host and all subdomains.  Every URL gives
one key per host suffix: (reversed suffix, path); a rule is then the interval of
all keys that continue its own key, and intervals of one host are nested or
disjoint.  Paths are compared as UTF-8 bytes, in which no byte is FF: an
interval ends at its path followed by FF.

The sweep goes over starts, keys and ends in one order, over range partitions.
A start pushes its rule and an end pops it, so the running sum of +1 and -1 is
the height of the stack, and the rule on level h is the last one that was pushed
to level h.  At a key the top level holds the longest open rule of its suffix.
Between range partitions go the heights and, for each level, the last rule pushed
to it: at most one row per partition and level, whatever the URLs.

Only DataFrame functions.  URLs with equal host and path are judged once; the
host is part of the range key, so a suffix like ``com`` is spread over tasks.

Defined cases: null URLs and those without ``://`` have empty host and path;
of two fitting rules the longer text wins, then the longer host; of equal rules
``block`` wins; columns named host, path, rule and verdict are replaced; rules with a null host, path or action are ignored; URLs without
a rule get the default verdict; repeated rows are judged alike; empty tables of
URLs give no rows, empty tables of rules give the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapse.llm.common import ascii_lower, read_table
from lapse.session import materialize

# The filter list of the query (host, path, action).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DEFAULT_VERDICT = "allow"
URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL_PATTERN, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PATTERN, 2), F.lit(""))


def _reversed_host(labels: Column) -> Column:
    return F.concat_ws(".", F.reverse(labels))


def _intervals(rules: DataFrame) -> DataFrame:
    """The start (+1) and the end (-1) of every distinct rule, in the sweep's columns."""
    clean = (rules.where("host IS NOT NULL AND path IS NOT NULL AND action IS NOT NULL")
             .select(ascii_lower(F.col("host")).alias("host"), F.col("path").alias("rule_path"), "action")
             .groupBy("host", "rule_path").agg(F.max("action").alias("action")))
    clean = clean.select(_reversed_host(F.split("host", r"\.")).alias("rhost"), F.col("rule_path").cast("binary").alias("at"),
                         F.struct("host", F.col("rule_path").alias("path"), "action").alias("rule"))
    none = F.lit(None).cast(clean.schema["rule"].dataType)
    starts = clean.select("rhost", "at", F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit(1).alias("push"), "rule")
    ends = clean.select("rhost", F.concat("at", F.unhex(F.lit("FF"))).alias("at"), F.lit(2).alias("kind"),
                        F.lit("").alias("host"), F.lit(-1).alias("push"), none.alias("rule"))
    return starts.unionByName(ends)


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``urls`` (any columns and ``url``) with host, path, rule and verdict."""
    spark = urls.sparkSession
    urls = urls.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    # suffixes with more labels than any rule can't match one
    most = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    keys = (urls.select("host", "path").distinct()
            .withColumn("labels", labels)
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(1, most))))))
            .select("host", "path", _reversed_host(F.expr("slice(labels, size(labels) - k + 1, k)")).alias("rhost")))

    events = _intervals(rules)
    none = F.lit(None).cast(events.schema["rule"].dataType)
    events = events.unionByName(keys.select(
        "rhost", F.col("path").cast("binary").alias("at"), F.lit(1).alias("kind"), "host", F.lit(0).alias("push"), none.alias("rule")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["rhost", "at", "kind", "host"]
    # written once: all uses must see the same ranges
    swept = materialize(events.repartitionByRange(parts, *order)
                        .withColumn("part", F.spark_partition_id()), "urlsweep")

    # one row per range partition: the height of the stack at its start
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heights = swept.groupBy("part").agg(F.sum("push").alias("push")).select(
        "part", F.coalesce(F.sum("push").over(before), F.lit(0)).alias("carried"))
    running = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    levels = (swept.withColumn("height", F.sum("push").over(running))
              .join(F.broadcast(heights), "part")
              .withColumn("level", F.col("height") + F.col("carried"))
              .where("level > 0 AND kind < 2"))
    # one row per range partition and level: the last rule that earlier partitions pushed to the level
    place = F.struct("rhost", "at", "rule")
    earlier = Window.partitionBy("level").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (levels.groupBy("part", "level").agg(F.max(F.when(F.col("kind") == 0, place)).alias("pushed"))
               .select("part", "level", F.last("pushed.rule", True).over(earlier).alias("carried_rule")))
    pushed = Window.partitionBy("part", "level").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = (levels.withColumn("r", F.last("rule", True).over(pushed))
             .where("kind = 1")
             .join(carried, ["part", "level"])
             .withColumn("r", F.coalesce("r", "carried_rule"))
             .groupBy("host", F.col("at").cast("string").alias("path"))
             .agg(F.max(F.struct(F.length(F.concat("r.host", "r.path")).alias("n"), F.length("r.host").alias("h"),
                                 F.concat("r.host", "r.path").alias("rule"), F.col("r.action").alias("action"))).alias("_won")))
    return (urls.join(found, ["host", "path"], "left")
            .withColumn("rule", F.col("_won.rule"))
            .withColumn("verdict", F.coalesce(F.col("_won.action"), F.lit(default)))
            .drop("_won"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, winning rule and verdict of every page."""
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, RULES))} AS t(host, path, action)")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = """
WITH p AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM p),
u AS (
  SELECT page_id,
         translate(coalesce(raw, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path
  FROM q),
r(rhost, rpath, action) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
pairs AS (SELECT DISTINCT host, path FROM u),
best AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(action, length(rhost || rpath)) AS action
  FROM pairs JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path)
SELECT page_id, u.host, u.path, rule, coalesce(action, 'allow') AS verdict
FROM u LEFT JOIN best ON u.host = best.host AND u.path = best.path
"""
