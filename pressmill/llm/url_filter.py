"""URL filters by a sort-merge range join, on DataFrame functions alone.

A rule (action, host, path) fits its host and all subdomains when the url's path starts with the rule's path; the
longest rule wins (characters of host and path, then of the host). Reversed host labels, each closed by a point, turn a host
and its subdomains into the interval from its key to the key followed by the byte 0xFF; a separator and the path behind
the key do the same for the paths of a rule's host. Keys are compared as the bytes of UTF-8, in which 0xFF never stands. Such intervals nest, so at each place the open ones are a stack.

Two sweeps, of hosts and then of paths. In each, interval starts, interval ends and the distinct probes are range-partitioned
by key and sorted. An event carries the stack that holds from there on (a start: its own interval on top of those around
it; an end: those around it), so a probe's stack is that of the last event before it; a partition without an earlier
event takes the last one of the partitions before, one row each. The first sweep gives each distinct host the stack of rule
hosts that it lies under, at most one for each label; most urls lie under none and go no further. The second gives each
host and path that are left the stack of rules that fit; the top one is the longest of that host, and the longest of all
hosts wins. Equal probes are collapsed beforehand and probes differ, so no key can fill a partition.

Edge cases: a null url and one without '://' have an empty host and path and fit no rule, unless a rule's host is empty; a very long url is cut
to the part that rules can see before it is swept; rules with the same host and path count once (block before allow), null parts of a rule count as empty; repeated rows give
repeated results; empty tables give an empty result or the default verdict; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

LAST = b"\xff"  # in no UTF-8 text, and behind all of its bytes
SEP = "\x01"
DEFAULT = "allow"
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "action string, host string, path string")


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(raw) + 1, F.length(rest))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.regexp_extract(after, r"^[^?#]*", 0)


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def _bytes(text: Column | str) -> Column:
    return F.encode(text, "UTF-8")


def _sweep(events: DataFrame, probes: DataFrame) -> DataFrame:
    """(probe columns, top): the state of the last event at or before each probe's key. events: key, state struct; probes: key, probe struct."""
    state = events.schema["state"].dataType
    probe = probes.schema["probe"].dataType
    both = events.select("key", F.lit(0).alias("kind"), "state", F.lit(None).cast(probe).alias("probe")).union(probes.select("key", F.lit(1).alias("kind"), F.lit(None).cast(state).alias("state"), "probe"))
    slices = C.materialize(both.repartitionByRange("key", "kind", F.xxhash64("probe")).withColumn("slice", F.spark_partition_id()), "slices")
    lasts = slices.groupBy("slice").agg(F.max_by("state", F.when(F.col("kind") == 0, F.col("key"))).alias("closing"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row for each slice
    carried = lasts.select("slice", F.last("closing", True).over(before).alias("carried"))
    run = Window.partitionBy("slice").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = slices.withColumn("top", F.last("state", True).over(run)).where("kind = 1")
    return swept.join(carried, "slice").select("probe", F.coalesce("top", "carried").alias("top"))


def _stacks(intervals: DataFrame, prefixes: Column, value: str) -> DataFrame:
    """(key, stack) of each interval: the values of the intervals around it, from the outermost, and its own. prefixes: the keys that can be around a key, its own left out."""
    inside = intervals.select("key", F.explode(prefixes).alias("outer_key")).join(intervals.select(F.col("key").alias("outer_key"), F.col(value).alias("outer")), "outer_key")
    around = inside.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.length("outer_key").alias("n"), "outer"))).alias("around"))
    held = F.coalesce(F.transform("around", lambda o: o["outer"]), F.array().cast(f"array<{dict(intervals.dtypes)[value]}>"))
    return intervals.join(around, "key", "left").select("key", F.concat(held, F.array(value)).alias("stack"))


def _events(stacks: DataFrame) -> DataFrame:
    """Starts and ends of intervals, each with the stack that holds from there on."""
    starts = stacks.select(_bytes("key").alias("key"), F.struct("stack").alias("state"))
    return starts.union(stacks.select(F.concat(_bytes("key"), F.lit(LAST)), F.struct(F.slice("stack", F.lit(1), F.size("stack") - 1).alias("stack"))))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule ('host' + 'path' of the winning rule, or null) and verdict of every page row."""
    host, path = host_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    clean = rules.select("action", F.lower(F.coalesce("host", F.lit(""))).alias("h"), F.coalesce("path", F.lit("")).alias("p")).groupBy("h", "p").agg(F.max("action").alias("action"))
    at_host = F.concat(_reversed(F.split("h", r"\.")), F.lit("."))
    mine = F.struct((F.length("h") + F.length("p")).alias("size"), F.length("h").alias("of_host"), F.concat("h", "p").alias("rule"), "action").alias("mine")
    clean = C.materialize(clean.select("h", "p", at_host.alias("at_host"), F.concat(at_host, F.lit(SEP), "p").alias("key"), mine), "rules")
    bound = clean.agg(F.max(F.size(F.split("h", r"\."))).alias("labels"), F.max(F.length("p")).alias("chars")).first()
    if bound["labels"] is None:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # a url is known by the part that rules can see
    labels, most = F.split("host", r"\."), int(bound["labels"])
    near = F.concat(_reversed(F.when(F.size(labels) > most, F.slice(labels, -most, most)).otherwise(labels)), F.lit("."))
    urls = urls.withColumn("near", near).withColumn("lead", F.substring("path", 1, int(bound["chars"])) if bound["chars"] else F.lit(""))
    seen = C.materialize(urls.select("near", "lead").distinct(), "seen")
    # the sweep of hosts
    hosts = clean.select(F.col("at_host").alias("key")).distinct().withColumn("own", F.col("key"))
    parts = F.split(F.expr("substring(key, 1, length(key) - 1)"), r"\.")
    shorter = F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.concat(F.array_join(F.slice(parts, F.lit(1), n), "."), F.lit("."))))
    probes = seen.select("near").distinct().select(_bytes("near").alias("key"), F.struct("near").alias("probe"))
    under = _sweep(_events(_stacks(hosts, shorter, "own")), probes).where("size(top.stack) > 0").select("probe.near", F.explode("top.stack").alias("at_host"))
    # the sweep of paths, for each rule host that a url lies under
    cut = F.when(F.length("p") > 0, F.transform(F.sequence(F.lit(1), F.length("p")), lambda n: F.expr("key").substr(F.lit(1), F.length("key") - n)))
    probes = seen.join(C.materialize(under, "under"), "near").select(_bytes(F.concat("at_host", F.lit(SEP), "lead")).alias("key"), F.struct("near", "lead").alias("probe"))
    tops = _sweep(_events(_stacks(clean, cut, "mine")), probes).where("size(top.stack) > 0").select("probe", F.element_at("top.stack", -1).alias("open"))
    best = tops.groupBy("probe").agg(F.max("open").alias("best"))
    found = C.materialize(best.select(F.col("probe.near").alias("near"), F.col("probe.lead").alias("lead"), F.col("best.rule").alias("rule"), F.col("best.action").alias("action")), "found")
    return urls.join(found, ["near", "lead"], "left").select("page_id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), v AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*', 0) AS raw FROM u
), w AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*', 0) AS path FROM v
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM w
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
