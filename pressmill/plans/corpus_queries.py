"""Corpus statistics and classification queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus, metrics
from ..sources.io import table

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _orders(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate", "c_mktsegment", "c_nationkey")



def _pivot(how):
    def query(spark, d):
        return metrics.metric_pivot(_orders(spark, d), "o_orderpriority", "o_orderstatus", "o_totalprice", how, ["F", "O", "P"], 3)

    return query


def _pivot_sql(fn):
    cells = ", ".join(f"round({fn}(o_totalprice) FILTER (WHERE o_orderstatus = '{k}'), 3) AS \"{k}\"" for k in "FOP")
    return f"SELECT o_orderpriority, {cells} FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_orderpriority"


metric_pivot_mean, metric_pivot_median, metric_pivot_std = _pivot("mean"), _pivot("median"), _pivot("std")
METRIC_PIVOT_MEAN, METRIC_PIVOT_MEDIAN, METRIC_PIVOT_STD = _pivot_sql("avg"), _pivot_sql("median"), _pivot_sql("stddev_samp")


def group_mean_median(spark, d):
    return metrics.mean_median(_orders(spark, d), ["c_mktsegment", "o_orderstatus"], "o_totalprice", 3)


GROUP_MEAN_MEDIAN = "SELECT c_mktsegment, o_orderstatus, round(avg(o_totalprice), 3) AS o_totalprice_mean, round(median(o_totalprice), 3) AS o_totalprice_median FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"


def grouped_mape(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("lines_total"))
    df = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return metrics.percentage_errors(df, ["o_orderpriority"], F.col("o_totalprice"), F.col("lines_total"), 1)


GROUPED_MAPE = """WITH l AS (SELECT l_orderkey, sum(l_extendedprice) AS t FROM lineitem GROUP BY l_orderkey)
SELECT o_orderpriority, round(avg(abs((o_totalprice - t) / o_totalprice)) * 100, 1) AS mape, round(median(abs((o_totalprice - t) / o_totalprice)) * 100, 1) AS median_ape FROM orders JOIN l ON o_orderkey = l_orderkey GROUP BY o_orderpriority"""


def rank_and_group_median(spark, d):
    return metrics.rank_in(table(spark, d, "orders").select("o_orderkey", "o_custkey", F.round("o_totalprice", -3).alias("price")), ["o_custkey"], "price")


RANK_AND_GROUP_MEDIAN = "WITH p AS (SELECT o_orderkey, o_custkey, round(o_totalprice, -3) AS price FROM orders) SELECT *, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY price) AS INTEGER) AS rank, median(price) OVER (PARTITION BY o_custkey) AS group_median FROM p"


def describe_numeric(spark, d):
    out = metrics.describe(table(spark, d, "orders"), "o_totalprice", ["o_orderstatus"])
    return out.select("o_orderstatus", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "least", "q25", "q50", "q75", "most")])


DESCRIBE_NUMERIC = """SELECT o_orderstatus, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, round(min(o_totalprice), 4) AS least, round(quantile_cont(o_totalprice, 0.25), 4) AS q25,
 round(quantile_cont(o_totalprice, 0.5), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75, round(max(o_totalprice), 4) AS most FROM orders GROUP BY o_orderstatus"""


def threshold_share(spark, d):
    p = F.col("o_totalprice")
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.round(metrics.share_below(p, 100000.0), 6).alias("share"), F.round(F.sum((p < 50000).cast("int")) * 100 / F.countDistinct("o_custkey"), 6).alias("rate"))


THRESHOLD_SHARE = "SELECT o_orderpriority, round(avg(CASE WHEN o_totalprice < 100000 THEN 1.0 ELSE 0.0 END), 6) AS share, round(sum(CASE WHEN o_totalprice < 50000 THEN 1 ELSE 0 END) * 100.0 / count(DISTINCT o_custkey), 6) AS rate FROM orders GROUP BY o_orderpriority"


def distinct_counts(spark, d):
    return _orders(spark, d).groupBy("c_mktsegment").agg(F.countDistinct("c_nationkey").alias("nations"), F.count("*").alias("orders"))


DISTINCT_COUNTS = "SELECT c_mktsegment, count(DISTINCT c_nationkey) AS nations, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"


def count_pivot(spark, d):
    return _orders(spark, d).groupBy("c_nationkey").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)


COUNT_PIVOT = "SELECT c_nationkey, " + ", ".join(f"count(*) FILTER (WHERE o_orderstatus = '{k}') AS \"{k}\"" for k in "FOP") + " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey"


def top3_bottom3_labels(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    sums = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).groupBy("n_regionkey", "n_name").agg(F.count("*").alias("customers"))
    return corpus.extremes(sums, "n_regionkey", "n_name", "customers")


TOP3_BOTTOM3_LABELS = """WITH s AS (SELECT n_regionkey, n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY customers DESC, n_name) AS t, row_number() OVER (PARTITION BY n_regionkey ORDER BY customers, n_name) AS b FROM s)
SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY t) FILTER (WHERE t <= 3) AS highest, string_agg(n_name, ', ' ORDER BY b) FILTER (WHERE b <= 3) AS lowest FROM r GROUP BY n_regionkey"""


def row_normalise_unpivot(spark, d):
    wide = table(spark, d, "customer").groupBy("c_nationkey").pivot("c_mktsegment", SEGMENTS).count()
    out = corpus.normalise_rows(wide, SEGMENTS).unpivot("c_nationkey", SEGMENTS, "segment", "share")
    return out.withColumn("share", F.round("share", 6))


ROW_NORMALISE_UNPIVOT = f"""WITH n AS (SELECT DISTINCT c_nationkey FROM customer), s AS (SELECT unnest([{", ".join(repr(s) for s in SEGMENTS)}]) AS segment),
c AS (SELECT c_nationkey, c_mktsegment AS segment, count(*) AS k FROM customer GROUP BY ALL), g AS (SELECT n.c_nationkey, s.segment, coalesce(k, 0) AS k FROM n CROSS JOIN s LEFT JOIN c ON c.c_nationkey = n.c_nationkey AND c.segment = s.segment)
SELECT c_nationkey, segment, round(k::DOUBLE / sum(k) OVER (PARTITION BY c_nationkey), 6) AS share FROM g"""


def monthly_counts(spark, d):
    return corpus.monthly_counts(table(spark, d, "orders"), "o_custkey", F.col("o_orderdate")).select("o_custkey", F.date_format("month", "yyyy-MM").alias("month"), "month_name", "n")


MONTHLY_COUNTS = """WITH c AS (SELECT o_custkey AS g, date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY ALL),
s AS (SELECT g, unnest(generate_series(min(m)::TIMESTAMP, max(m)::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM c GROUP BY g)
SELECT s.g AS o_custkey, strftime(s.m, '%Y-%m') AS month, strftime(s.m, '%B') AS month_name, coalesce(n, 0) AS n FROM s LEFT JOIN c ON c.g = s.g AND c.m = s.m"""


def monthly_events(spark, d):
    return corpus.monthly_counts(table(spark, d, "events"), "event_type", F.col("ts")).select("event_type", F.date_format("month", "yyyy-MM").alias("month"), "n")


MONTHLY_EVENTS = "SELECT event_type, strftime(date_trunc('month', ts), '%Y-%m') AS month, count(*) AS n FROM events GROUP BY ALL"


def cosine_matrix(spark, d):
    means = corpus.centroids(table(spark, d, "embeddings"), "label", "embedding")
    return corpus.similarity_matrix(means, "label", "embedding").select("a", "b", F.round("similarity", 5).alias("similarity"), F.round("distance", 5).alias("distance"))


COSINE_MATRIX = """WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(0, len(embedding))) AS pos FROM embeddings), m AS (SELECT label, pos, avg(v) AS v FROM e GROUP BY ALL),
d AS (SELECT x.label AS a, y.label AS b, sum(x.v * y.v) AS dot FROM m x JOIN m y ON x.pos = y.pos GROUP BY ALL)
SELECT d.a, d.b, round(d.dot / sqrt(p.dot) / sqrt(q.dot), 5) AS similarity, round(1 - d.dot / sqrt(p.dot) / sqrt(q.dot), 5) AS distance FROM d JOIN d p ON p.a = d.a AND p.b = d.a JOIN d q ON q.a = d.b AND q.b = d.b"""


def dendrogram(spark, d):
    return corpus.dendrogram(corpus.centroids(table(spark, d, "embeddings"), "label", "embedding"), "label", "embedding")


def left_dim_lookup(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select("c_custkey", "c_nationkey", "n_name")


LEFT_DIM_LOOKUP = "SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"


def self_join_raw(spark, d):
    sums = _orders(spark, d).groupBy("c_nationkey", "o_orderstatus").agg(F.count("*").alias("n"))
    raw = sums.where("o_orderstatus = 'O'").select("c_nationkey", F.col("n").alias("n_raw"))
    return sums.join(raw, "c_nationkey")


SELF_JOIN_RAW = "WITH s AS (SELECT c_nationkey, o_orderstatus, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) SELECT s.c_nationkey, s.o_orderstatus, s.n, r.n AS n_raw FROM s JOIN s r ON r.c_nationkey = s.c_nationkey AND r.o_orderstatus = 'O'"


def union_ragged(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


UNION_RAGGED = "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier"


def upsert_rows(spark, d):
    old = table(spark, d, "part").select("p_partkey", "p_size", F.lit("old").alias("version"))
    return corpus.upsert(old, old.where("p_partkey % 5 = 0").select("p_partkey", (F.col("p_size") + 1).alias("p_size"), F.lit("new").alias("version")), ["p_partkey"])


UPSERT_ROWS = "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS p_size, CASE WHEN p_partkey % 5 = 0 THEN 'new' ELSE 'old' END AS version FROM part"


def _labelled(spark, d):
    docs = table(spark, d, "documents").select("doc_id", (F.length("text") > 500).cast("int").alias("guess"))
    return table(spark, d, "labels").join(docs, "doc_id")


LABELLED = "l AS (SELECT l.doc_id, quality, toxic, CAST(length(text) > 500 AS INTEGER) AS guess FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"


def one_hot_labels(spark, d):
    codes = F.array_compact(F.array(F.when(F.col("quality") == 1, 0), F.when(F.col("toxic") == 1, 1), F.when(F.col("doc_id") % 2 == 0, 2)))
    return corpus.one_hot(table(spark, d, "labels").withColumn("codes", codes), "doc_id", "codes", [0, 1, 2])


ONE_HOT_LABELS = "SELECT doc_id, CAST(quality = 1 AS INTEGER) AS class_0, CAST(toxic = 1 AS INTEGER) AS class_1, CAST(doc_id % 2 = 0 AS INTEGER) AS class_2 FROM labels"


def confusion_matrix(spark, d):
    return metrics.confusion(_labelled(spark, d), "quality", "guess", [0, 1]).withColumnsRenamed({"0": "said_0", "1": "said_1"})


CONFUSION_MATRIX = f"WITH {LABELLED} SELECT quality, count(*) FILTER (WHERE guess = 0) AS said_0, count(*) FILTER (WHERE guess = 1) AS said_1 FROM l GROUP BY quality"


def classification_report(spark, d):
    out = metrics.classification_report(_labelled(spark, d), "quality", "guess", [0, 1])
    return out.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


REPORT = f"""WITH {LABELLED}, k AS (SELECT unnest([0, 1]) AS class), c AS (SELECT class, count(*) FILTER (WHERE quality = class AND guess = class) AS tp, count(*) FILTER (WHERE quality = class) AS support, count(*) FILTER (WHERE guess = class) AS said FROM k CROSS JOIN l GROUP BY class),
r AS (SELECT class, coalesce(tp / nullif(said, 0), 0)::DOUBLE AS precision, coalesce(tp / nullif(support, 0), 0)::DOUBLE AS recall, coalesce(2.0 * tp / nullif(said + support, 0), 0)::DOUBLE AS f1, support FROM c)"""
CLASSIFICATION_REPORT = f"{REPORT} SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM r"


def weighted_average(spark, d):
    out = metrics.weighted_average(metrics.classification_report(_labelled(spark, d), "quality", "guess", [0, 1]))
    return out.select(*[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


WEIGHTED_AVERAGE = f"{REPORT} SELECT round(sum(precision * support) / sum(support), 6) AS precision, round(sum(recall * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1, CAST(sum(support) AS BIGINT) AS support FROM r"


def bold_extremes(spark, d):
    sums = table(spark, d, "part").groupBy("p_brand").agg(F.min("p_size").alias("least"), F.count("*").alias("parts"))
    return metrics.bold_extremes(sums, ["least", "parts"])


BOLD_EXTREMES = """WITH s AS (SELECT p_brand, min(p_size) AS least, count(*) AS parts FROM part GROUP BY p_brand), e AS (SELECT min(least) AS a, min(parts) AS b FROM s)
SELECT p_brand, CASE WHEN least = a THEN '\\textbf{' || least || '}' ELSE CAST(least AS VARCHAR) END AS least, CASE WHEN parts = b THEN '\\textbf{' || parts || '}' ELSE CAST(parts AS VARCHAR) END AS parts FROM s CROSS JOIN e"""


def shared_vocabulary(spark, d):
    words = lambda df, key: df.select(key, F.explode(F.split(F.lower("text"), " ")).alias("word")).groupBy(key, "word").agg(F.count("*").alias("n"))
    b = table(spark, d, "benchmark")
    nxt = b.select((F.col("item_id") - 1).alias("item_id"), "text")
    return corpus.shared_words(words(b, "item_id"), words(nxt, "item_id"), "item_id")


SHARED_VOCABULARY = """WITH w AS (SELECT item_id, unnest(string_split(lower(text), ' ')) AS word FROM benchmark), c AS (SELECT item_id, word, count(*) AS n FROM w GROUP BY ALL)
SELECT a.item_id, CAST(sum(least(a.n, b.n)) AS BIGINT) AS shared FROM c a JOIN c b ON b.item_id = a.item_id + 1 AND a.word = b.word GROUP BY a.item_id"""

NAMES = [
    "metric_pivot_mean", "metric_pivot_median", "metric_pivot_std", "group_mean_median", "grouped_mape", "rank_and_group_median", "describe_numeric", "threshold_share", "distinct_counts", "count_pivot", "top3_bottom3_labels",
    "row_normalise_unpivot", "monthly_counts", "monthly_events", "cosine_matrix", "dendrogram", "left_dim_lookup", "self_join_raw", "union_ragged", "upsert_rows", "one_hot_labels", "confusion_matrix", "classification_report",
    "weighted_average", "bold_extremes", "shared_vocabulary",
]
QUERIES = {n: globals()[n] for n in NAMES}
ORACLE_SQL = {n: globals()[n.upper()] for n in NAMES if n.upper() in globals()}
