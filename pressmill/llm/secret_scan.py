"""Secret scans by corpus-wide ownership frequency, on DataFrame functions alone.

Candidates are the matches of the patterns below (leftmost, not overlapping, per kind). One pass over the texts keeps,
for each row, the lengths between and of the matches and a hash of each candidate value, never the value. The hashes are
then counted over the whole corpus: in how many repositories (distinct repository keys) and by how many owners a value is
found. A value that EXAMPLE_OWNERS owners or more share is a copied example, and so is one of several owners that stands in
EXAMPLE_REPOSITORIES repositories or more. Of the others, one that looks random (letters and digits, at least LIVE_CHARS
different characters) counts as live: owner-specific, and `shared` if its one owner has it in several repositories. Base
kinds are always reported; the spans of the further kinds are added when their value is live.

Hot values are safe: the counts are taken in steps of partial sums (value, owner, repository), then (value, owner), then
(value), and the result is joined back from a table of its own, so that adaptive joins can split a hot value.

Edge cases: null and empty texts have no spans; a null owner or repository is one like any other; a very long text is one row like any other;
repeated rows give repeated results; matches that stand at the same place are listed by kind; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 20
LIVE_CHARS = 8

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern, least characters of the value. Runs of hex digits and AKIA keys are maximal, so a least length in the
#: pattern finds the same matches as a filter behind it; for assign it would not, so its matches are filtered.
BASE = [("assign", ASSIGN, 8), ("access", r"AKIA[A-Z0-9]{12,}", 16), ("hex", r"[0-9a-f]{32,}", 32)]
FURTHER = [
    ("vendor", r"\b(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{30,})", 16),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 16),
    ("bearer", r"\bBearer\x20+[A-Za-z0-9+/_.~=-]{16,}", 16),
]
KINDS = [*BASE, *FURTHER]


def _scan(text: Column, rank: int, pattern: str, least: int) -> Column:
    """array<struct<gap, size, value hash, long enough, looks random>> of a text's matches, gap: characters since the match before."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), 0)

    def one(m: Column, i: Column) -> Column:
        value = F.regexp_extract(m, pattern, 2) if rank == 0 else m
        random = (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARS) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
        return F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("size"), F.unhex(F.sha2(value, 256)).alias("value"), (F.length(value) >= least).alias("enough"), random.alias("random"))

    return F.transform(hits, one)


def candidates(documents: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """row, doc_id, owner, repository and, for each kind, its matches: written once, without the texts."""
    text = F.coalesce("text", F.lit(""))
    maybe = F.when(text.rlike(rf"{ASSIGN}|AKIA[A-Z0-9]|[0-9a-f]{{32}}|gh[pousr]_|xox[abprs]-|sk-|AIza|eyJ|Bearer"), text).otherwise(F.lit(""))
    named = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"), maybe.alias("t"))
    return named.select("row", "doc_id", "owner", "repository", *[_scan(F.col("t"), k, p, n).alias(f"k{k}") for k, (_, p, n) in enumerate(KINDS)])


def ownership(found: DataFrame) -> DataFrame:
    """value, owners, repositories: distinct counts over the corpus, from (value, owner, repository)."""
    each = found.groupBy("value", "owner", "repository").count()
    held = each.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    return held.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def scan(documents: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, n_shared, owners_least, repositories_most of every document row."""
    kept = C.materialize(candidates(documents, owner, repository), "candidates")
    some = F.array(*[F.struct(F.lit(k).alias("rank"), F.col(f"k{k}").alias("hits")) for k in range(len(KINDS))])
    exploded = kept.where(" or ".join(f"size(k{k}) > 0" for k in range(len(KINDS)))).select("row", "owner", "repository", F.explode(some).alias("kind"))
    exploded = exploded.select("row", "owner", "repository", F.col("kind.rank").alias("rank"), F.posexplode("kind.hits").alias("at", "hit"))
    run = Window.partitionBy("row", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("hit.gap").cast("long") + F.col("hit.size")).over(run)
    spans = exploded.withColumn("stop", stop).where("hit.enough").select("row", "owner", "repository", "rank", (F.col("stop") - F.col("hit.size")).alias("start"), "stop", F.col("hit.value").alias("value"), F.col("hit.random").alias("random"))
    spans = C.materialize(spans, "spans")
    counts = C.materialize(ownership(spans), "ownership")
    copied = (F.col("owners") >= EXAMPLE_OWNERS) | ((F.col("owners") > 1) & (F.col("repositories") >= EXAMPLE_REPOSITORIES))
    label = F.when(copied, "example").when(F.col("random"), "live").otherwise("weak")
    shared = (F.col("label") == "live") & (F.col("owners") == 1) & (F.col("repositories") > 1)
    judged = spans.join(counts, "value").withColumn("label", label).where((F.col("rank") < len(BASE)) | (F.col("label") == "live"))
    name = F.element_at(F.array(*[F.lit(k) for k, _, _ in KINDS]), F.col("rank") + 1)
    listed = judged.groupBy("row").agg(
        *[F.count(F.when(F.col("rank") == k, 1)).alias(f"n_{kind}") for k, (kind, _, _) in enumerate(BASE)],
        F.array_sort(F.collect_list(F.struct("start", "rank", "stop", F.concat_ws(":", name, "start", "stop").alias("told")))).alias("all"),
        F.count(F.when(F.col("label") == "live", 1)).alias("n_live"), F.count(F.when(F.col("label") == "example", 1)).alias("n_example"), F.count(F.when(shared, 1)).alias("n_shared"), F.min("owners").alias("owners_least"), F.max("repositories").alias("repositories_most"),
    )
    joined = lambda part: F.array_join(F.transform(part, lambda s: s["told"]), ",")
    out = kept.select("row", "doc_id").join(listed, "row", "left")
    nothing = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    spans_text = F.coalesce(joined(F.col("all")), F.lit(""))
    base_text = F.coalesce(joined(F.filter("all", lambda s: s["rank"] < len(BASE))), F.lit(""))
    return out.select("doc_id", nothing("n_assign"), nothing("n_access"), nothing("n_hex"), F.sha2(base_text, 256).alias("base_sha256"), spans_text.alias("spans"), nothing("n_live"), nothing("n_example"), nothing("n_shared"), "owners_least", "repositories_most")


def oracle() -> str:
    """The same rows in DuckDB: matches and the texts between them give the places."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    each = " UNION ALL ".join(f"SELECT rid, doc_id, source, {k} AS rank, {quoted(kind)} AS kind, {least} AS least, regexp_extract_all(t, {quoted(p)}) AS hits, regexp_split_to_array(t, {quoted(p)}) AS gaps FROM d" for k, (kind, p, least) in enumerate(KINDS))
    base = len(BASE)
    listed = lambda only: f"coalesce(string_agg(told, ',' ORDER BY start, rank, stop){only}, '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
m AS ({each}),
u AS (SELECT rid, doc_id, source, rank, kind, least, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM m),
p AS (SELECT rid, doc_id, source, rank, kind, least, hits[i] AS hit, CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: length(h))), 0) AS BIGINT) AS start FROM u),
v AS (SELECT *, start + length(hit) AS stop, CASE WHEN rank = 0 THEN regexp_extract(hit, {quoted(ASSIGN)}, 2) ELSE hit END AS value FROM p),
c AS (SELECT *, len(list_distinct(string_split(value, ''))) >= {LIVE_CHARS} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AS random, kind || ':' || start || ':' || stop AS told FROM v WHERE length(value) >= least),
o AS (SELECT value, count(DISTINCT {{'s': source}}) AS owners, count(DISTINCT {{'s': source, 'd': doc_id}}) AS repositories FROM c GROUP BY value),
l AS (SELECT c.*, owners, repositories, CASE WHEN owners >= {EXAMPLE_OWNERS} OR owners > 1 AND repositories >= {EXAMPLE_REPOSITORIES} THEN 'example' WHEN random THEN 'live' ELSE 'weak' END AS label FROM c JOIN o USING (value)),
k AS (SELECT * FROM l WHERE rank < {base} OR label = 'live'),
g AS (SELECT rid, {listed("")} AS spans, {listed(f" FILTER (WHERE rank < {base})")} AS base, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
  count(*) FILTER (WHERE label = 'live') AS n_live, count(*) FILTER (WHERE label = 'example') AS n_example, count(*) FILTER (WHERE label = 'live' AND owners = 1 AND repositories > 1) AS n_shared, min(owners) AS owners_least, max(repositories) AS repositories_most FROM k GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(n_shared, 0) AS n_shared, owners_least, repositories_most
FROM d LEFT JOIN g USING (rid)
"""
