"""Text, article, segment, search and evaluation queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import text_udf as U
from ..operators import align, anchors, articles, corpus, finish, metrics, phrase_index, quality, segments
from ..sources.io import table, with_unique_ids

DOC_TITLE = "upper(content) = content AND length(regexp_replace(content, '[^A-Z]', '', 'g')) >= 5 AND length(regexp_replace(content, '[^AEIOU]', '', 'g')) >= 2"

PARTS_SQL = """parts AS (
  SELECT doc_id, pos, regexp_replace(part, '^\\s+|\\s+$', '', 'g') AS content FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS part, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents)
), filled AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS INTEGER) AS sub_order, content FROM parts WHERE content <> ''
), titled AS (SELECT *, CASE WHEN """ + DOC_TITLE + """ THEN 'title' ELSE 'text' END AS class FROM filled)"""

ASCII = "[^\\x00-\\x7F]"


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return articles.split_and_reclassify(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"], "text", "\n")


def doc_counts(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.line_count(t).alias("lines"), T.paragraph_count(t).alias("paragraphs"), T.word_count(t).alias("words"), F.length(t).alias("chars"), T.filled_parts(t, "\n").alias("filled_lines"))


DOC_COUNTS = """SELECT doc_id, len(string_split(text, chr(10))) AS lines, len(string_split(text, chr(10) || chr(10))) AS paragraphs,
 len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')) AS words, length(text) AS chars,
 len(list_filter(string_split(text, chr(10)), lambda p: regexp_replace(p, '\\s+', '', 'g') <> '')) AS filled_lines FROM documents"""


def title_lines(spark, d):
    return _parts(spark, d).where("class = 'title'").select("doc_id", "sub_order", "content")


TITLE_LINES = f"WITH {PARTS_SQL} SELECT doc_id, sub_order, content FROM titled WHERE class = 'title'"


def articles_from_documents(spark, d):
    made = articles.create_articles(_parts(spark, d), ["doc_id"], ["sub_order"], F.col("class") == "title", separator="\n")
    made = made.select("doc_id", "article", "title", "n_parts", T.word_count(F.col("content")).alias("words"), F.md5("content").alias("content_md5"))
    n = F.count("*").over(Window.partitionBy("doc_id"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("words"), "article"))
    return made.withColumns({"n_articles": n, "place": place})


ARTICLES_FROM_DOCUMENTS = f"""WITH {PARTS_SQL}, numbered AS (
  SELECT *, CAST(sum(CASE WHEN class = 'title' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY sub_order) AS BIGINT) AS article FROM titled
), made AS (
  SELECT doc_id, article, max(CASE WHEN class = 'title' THEN content END) AS title, count(*) FILTER (WHERE class <> 'title') AS n_parts, string_agg(content, chr(10) ORDER BY sub_order) AS content FROM numbered GROUP BY doc_id, article
), counted AS (SELECT doc_id, article, title, n_parts, len(regexp_extract_all(content, '[^ \\t\\n\\x0B\\f\\r]+')) AS words, md5(content) AS content_md5 FROM made)
SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_articles, row_number() OVER (PARTITION BY doc_id ORDER BY words DESC, article) AS place FROM counted"""


def articles_from_conversations(spark, d):
    c = table(spark, d, "conversations")
    made = articles.create_articles(c, ["conv_id"], ["turn"], F.col("role") == "user", "text")
    return made.select("conv_id", "article", "title", "n_parts", F.md5("content").alias("content_md5"))


ARTICLES_FROM_CONVERSATIONS = """WITH n AS (SELECT *, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS article FROM conversations)
SELECT conv_id, article, max(CASE WHEN role = 'user' THEN text END) AS title, count(*) FILTER (WHERE role <> 'user') AS n_parts, md5(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS content_md5 FROM n GROUP BY conv_id, article"""


def _turns(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))


def merge_title_runs(spark, d):
    out = articles.merge_titles(_turns(spark, d), ["conv_id"], ["turn"], F.col("role") != "assistant")
    return out.select("conv_id", "new_order", "is_title", "merged", F.md5("content").alias("content_md5"))


MERGE_TITLE_RUNS = """WITH t AS (SELECT *, role <> 'assistant' AS title FROM conversations),
f AS (SELECT *, CASE WHEN title AND coalesce(lag(title) OVER (PARTITION BY conv_id ORDER BY turn), false) THEN 0 ELSE 1 END AS fresh FROM t),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM f),
m AS (SELECT conv_id, run, md5(string_agg(text, chr(10) ORDER BY turn)) AS content_md5, bool_or(title) AS is_title, count(*) AS merged FROM r GROUP BY conv_id, run)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY run) AS new_order, is_title, merged, content_md5 FROM m"""


def merge_title_runs_compat(spark, d):
    out = articles.merge_titles_compat(_turns(spark, d), ["conv_id"], ["turn"], F.col("role") != "assistant")
    return out.select("conv_id", "turn", "new_order", "is_title", F.md5("content").alias("content_md5"))


MERGE_TITLE_RUNS_COMPAT = """WITH t AS (SELECT *, role <> 'assistant' AS title FROM conversations),
m AS (SELECT *, title AND coalesce(lead(title) OVER (PARTITION BY conv_id ORDER BY turn), false) AS mask FROM t),
r AS (SELECT *, sum(CASE WHEN mask THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS run, NOT coalesce(lead(mask) OVER (PARTITION BY conv_id ORDER BY turn), false) AS keep FROM m),
j AS (SELECT conv_id, run, md5(string_agg(text, chr(10) ORDER BY turn)) AS content_md5 FROM r GROUP BY conv_id, run)
SELECT r.conv_id, turn, row_number() OVER (PARTITION BY r.conv_id ORDER BY turn) AS new_order, title AS is_title, content_md5 FROM r JOIN j USING (conv_id, run) WHERE keep"""


def clean_line_breaks(spark, d):
    noisy = F.concat(F.lit("`tsv "), F.regexp_replace("text", r"\.\n", ".\n\n"), F.lit("  -\nend`"))
    bare = T.strip_fences(noisy)
    return table(spark, d, "documents").select("doc_id", F.md5(T.clean_line_breaks(bare)).alias("clean_md5"), F.length(bare).alias("bare_chars"))


CLEAN_LINE_BREAKS = """WITH b AS (SELECT doc_id, 'tsv ' || replace(text, '.' || chr(10), '.' || chr(10) || chr(10)) || '  -' || chr(10) || 'end' AS x FROM documents),
c AS (SELECT doc_id, regexp_replace(x, 'tsv', '') AS x FROM b)
SELECT doc_id, md5(regexp_replace(regexp_replace(replace(replace(regexp_replace(replace(x, '-' || chr(10), ''), '\\n\\n+', chr(1), 'g'), chr(10), ' '), chr(1), chr(10) || chr(10)), ' +', ' ', 'g'), '^\\s+|\\s+$', '', 'g')) AS clean_md5, length(x) AS bare_chars FROM c"""


def fragment_share(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(T.fragment_share(F.col("text")), 6).alias("share"))


FRAGMENTS_SQL = "(list_filter(list_transform(regexp_split_to_array(text, '\\s+'), lambda w: length(regexp_replace(w, '[^\\p{L}]', '', 'g'))), lambda n: n > 0))"
FRAGMENT_SHARE = f"""WITH s AS (SELECT doc_id, {FRAGMENTS_SQL} AS sizes FROM documents)
SELECT doc_id, round(CASE WHEN len(sizes) < 3 THEN 0.0 ELSE len(list_filter(sizes, lambda n: n <= 3))::DOUBLE / len(sizes) END, 6) AS share FROM s"""


def quality_flags(spark, d):
    df = table(spark, d, "documents").withColumns({"w": (F.col("doc_id") % 40) * 25 + 40, "h": (F.col("doc_id") % 7) * 60 + 30, "x": (F.col("doc_id") % 11) * 90})
    n = T.word_count(F.col("text"))
    flag = quality.assess_region(
        F.when(F.col("doc_id") % 13 == 0, "figure").otherwise("text"), F.col("text"), F.col("text"), F.col("w").cast("double"), F.col("h").cast("double"), F.lit(900.0), n, (n / 4).cast("int"),
        (F.col("doc_id") % 10) / 10.0, F.when(F.col("doc_id") % 17 == 0, F.array(F.lit("length"))).otherwise(F.array(F.lit("stop"))), quality.at_page_edge(F.col("x"), F.col("w"), F.lit(1000)), F.col("doc_id") % 5 == 0,
    )
    return df.select("doc_id", flag.alias("suspect"))


QUALITY_FLAGS = f"""WITH b AS (SELECT doc_id, text, (doc_id % 40) * 25 + 40 AS w, (doc_id % 7) * 60 + 30 AS h, (doc_id % 11) * 90 AS x, len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')) AS n, (doc_id % 10) / 10.0 AS score FROM documents),
s AS (SELECT *, {FRAGMENTS_SQL} AS sizes, (x <= 20 OR x + w >= 980) AS edge, w * h / 900.0 AS capacity FROM b),
t AS (SELECT *, CASE WHEN len(sizes) < 3 THEN 0.0 ELSE len(list_filter(sizes, lambda k: k <= 3))::DOUBLE / len(sizes) END AS share FROM s)
SELECT doc_id, CASE
 WHEN doc_id % 17 = 0 THEN 'output hit its token limit (repetition loop)'
 WHEN doc_id % 13 <> 0 AND trim(text) <> '' AND regexp_matches(substr(text, 1, 300), '(?i)\\b(?:the|this) (?:image|picture|photograph|scan)\\b') THEN 'model commentary instead of a transcription'
 WHEN doc_id % 13 = 0 OR trim(text) = '' THEN NULL
 WHEN doc_id % 5 = 0 AND score < 0.2 THEN 'figure text not confirmed by Tesseract'
 WHEN edge AND (w < 75 OR (w < 180 AND share >= 0.6)) THEN 'cut-off text at the page edge'
 WHEN n > greatest(20.0, 3.0 * capacity) THEN n || ' tokens but the region holds about ' || CAST(round_even(capacity, 0) AS BIGINT) || ' words'
 WHEN n // 4 > 0 AND score < 0.2 AND n > 3 * (n // 4) + 10 THEN printf('%d tokens against %d Tesseract words with alignment %.2f', n, n // 4, score::DOUBLE) END AS suspect FROM t"""


def layout_json_flag(spark, d):
    raw = F.concat(F.lit('[{"label":"Text","'), F.when(F.col("event_id") % 3 == 0, "bbox").otherwise("box"), F.lit('":"1"},'), F.lit('{"bbox":"2"}'), F.when(F.col("event_id") % 7 == 0, "").otherwise("]"))
    return table(spark, d, "events").select("event_id", T.is_layout_json(raw).alias("is_layout"))


LAYOUT_JSON_FLAG = "SELECT event_id, event_id % 3 = 0 AND event_id % 7 <> 0 AS is_layout FROM events"


def keyword_filter_ci(spark, d):
    hit = F.col("text").rlike("(?i)the and|idiot") & F.col("text").contains("er")
    return table(spark, d, "documents").where(hit & (F.col("text") != "")).select("doc_id", "lang", "source")


KEYWORD_FILTER_CI = "SELECT doc_id, lang, source FROM documents WHERE regexp_matches(text, '(?i)the and|idiot') AND contains(text, 'er') AND text <> ''"


def _segments(spark, d):
    ident = F.concat(F.lit("issue-"), F.col("conv_id") % 20, F.lit("_page_"), F.col("conv_id") % 5, F.lit("_"), F.col("role"), F.lit("_B0C"), F.col("conv_id") % 3, F.lit("R"), F.col("conv_id"), F.lit("_segment_"), F.col("turn"))
    return table(spark, d, "conversations").select("conv_id", "turn", ident.alias("custom_id"), F.col("text").alias("content"), F.length("text").alias("prompt_tokens"), F.col("turn").alias("completion_tokens"), (F.length("text") + F.col("turn")).alias("total_tokens"))


SEGMENTS_SQL = "s AS (SELECT *, 'issue-' || conv_id % 20 AS issue_id, CAST(conv_id % 5 AS INTEGER) AS page_number, 0 AS block, CAST(conv_id % 3 AS INTEGER) AS \"column\", role AS class, CAST(conv_id AS INTEGER) AS reading_order, CAST(turn AS INTEGER) AS segment, length(text) AS p FROM conversations)"


def custom_id_decompose(spark, d):
    df = segments.with_ids(_segments(spark, d).withColumns(segments.decompose(F.col("custom_id"))))
    return df.select("conv_id", "turn", "issue_id", "page_number", "class", "block", "column", "reading_order", "segment", "bbox_uid")


CUSTOM_ID_DECOMPOSE = f"WITH {SEGMENTS_SQL} SELECT conv_id, turn, issue_id, page_number, class, block, \"column\", reading_order, segment, issue_id || '_page_' || page_number || '_B0C' || \"column\" || 'R' || reading_order AS bbox_uid FROM s"


def segment_totals(spark, d):
    return segments.totals(_segments(spark, d).withColumns(segments.decompose(F.col("custom_id"))))


SEGMENT_TOTALS = f"WITH {SEGMENTS_SQL} SELECT issue_id, page_number, block, \"column\", class, reading_order, count(*) AS segment_count, CAST(sum(p) AS BIGINT) AS prompt_tokens, CAST(sum(turn) AS BIGINT) AS completion_tokens, CAST(sum(p + turn) AS BIGINT) AS total_tokens FROM s GROUP BY ALL"


def segment_knit(spark, d):
    return segments.knit_segments(_segments(spark, d).withColumns(segments.decompose(F.col("custom_id"))))


def semi_sample(spark, d):
    labels = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return table(spark, d, "documents").join(labels, "doc_id", "left_semi").select("doc_id", "lang")


SEMI_SAMPLE = "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"


def anti_processed(spark, d):
    return corpus.not_done(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels").select("doc_id"), ["doc_id"])


ANTI_PROCESSED = "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"


def hash_split(spark, d):
    return corpus.split_by_hash(table(spark, d, "documents").select("doc_id"), "doc_id", 0.8, 1852)


HASH_SPLIT = "SELECT doc_id, CAST('0x' || substr(md5('1852|' || doc_id), 1, 8) AS BIGINT) % 1000 < 800 AS is_train FROM documents"


def batch_number(spark, d):
    return corpus.batch_numbers(table(spark, d, "documents").select("doc_id", "source"), "source", ["doc_id"], 20)


BATCH_NUMBER = "SELECT doc_id, source, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 20 + 1 AS BIGINT) AS batch FROM documents"


def global_batches(spark, d):
    return corpus.batch_numbers(table(spark, d, "documents").select("doc_id"), None, ["doc_id"])


GLOBAL_BATCHES = "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 100 + 1 AS BIGINT) AS batch FROM documents"


def _pairs(spark, d):
    b = table(spark, d, "benchmark")
    fold = lambda c: F.regexp_replace(F.lower(c), ASCII, "?")
    nxt = b.select((F.col("item_id") - 1).alias("item_id"), fold("text").alias("content"))
    return b.select("item_id", fold("text").alias("reference")).join(nxt, "item_id")


PAIRS_SQL = "p AS (SELECT a.item_id, regexp_replace(lower(a.text), '[^\\x00-\\x7F]', '?', 'g') AS reference, regexp_replace(lower(b.text), '[^\\x00-\\x7F]', '?', 'g') AS content FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1)"


def cer_pairs_ascii(spark, d):
    return _pairs(spark, d).select("item_id", F.levenshtein("reference", "content").alias("errors"), F.length("reference").alias("chars"), F.round(T.character_error_rate(F.col("reference"), F.col("content")), 6).alias("cer"))


CER_PAIRS_ASCII = f"WITH {PAIRS_SQL} SELECT item_id, levenshtein(reference, content) AS errors, length(reference) AS chars, round(levenshtein(reference, content)::DOUBLE / length(reference), 6) AS cer FROM p"


def micro_error_rates(spark, d):
    out = metrics.micro_error_rates(cer_pairs_ascii(spark, d).withColumn("half", F.col("item_id") % 2), ["half"], "errors", "chars")
    return out.select("half", F.round("micro_rate", 6).alias("micro_rate"), F.round("median_rate", 6).alias("median_rate"))


MICRO_ERROR_RATES = f"WITH {PAIRS_SQL}, e AS (SELECT item_id % 2 AS half, levenshtein(reference, content) AS errors, length(reference) AS chars FROM p) SELECT half, round(sum(errors)::DOUBLE / sum(chars), 6) AS micro_rate, round(median(errors::DOUBLE / chars), 6) AS median_rate FROM e GROUP BY half"


def worst_pages(spark, d):
    return cer_pairs_ascii(spark, d).orderBy(F.desc("cer"), "item_id").limit(5).select("item_id", "cer")


WORST_PAGES = f"WITH {PAIRS_SQL} SELECT item_id, round(levenshtein(reference, content)::DOUBLE / length(reference), 6) AS cer FROM p ORDER BY cer DESC, item_id LIMIT 5"


def word_error_pairs(spark, d):
    return _pairs(spark, d).select("item_id", U.word_distance("reference", "content").alias("word_errors"), F.size(T.words(F.col("reference"))).alias("words"))


# each word becomes one character by its rank among the words of its pair
WORD_ERROR_PAIRS = f"""WITH {PAIRS_SQL}, w AS (SELECT item_id, list_filter(regexp_split_to_array(reference, '\\s+'), lambda x: x <> '') AS a, list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> '') AS b FROM p),
k AS (SELECT *, list_distinct(list_concat(a, b)) AS known FROM w)
SELECT item_id, CAST(levenshtein(array_to_string(list_transform(a, lambda x: chr(CAST(list_position(known, x) AS INTEGER))), ''), array_to_string(list_transform(b, lambda x: chr(CAST(list_position(known, x) AS INTEGER))), '')) AS INTEGER) AS word_errors,
 CAST(len(a) AS INTEGER) AS words FROM k"""


def html_text(spark, d):
    p = table(spark, d, "pages").select("page_id", U.text_of_html(F.col("html")).alias("h"), U.strings_of_html("html").alias("strings"))
    return p.select("page_id", "h.text", "h.labels", "strings")


def url_parts(spark, d):
    rest = F.split_part("url", F.lit("://"), F.lit(2))
    host = F.split_part(rest, F.lit("/"), F.lit(1))
    return table(spark, d, "pages").select("page_id", F.split_part("url", F.lit("://"), F.lit(1)).alias("scheme"), host.alias("host"), F.split_part(host, F.lit("."), F.lit(1)).alias("prefix"))


URL_PARTS = "SELECT page_id, split_part(url, '://', 1) AS scheme, split_part(split_part(url, '://', 2), '/', 1) AS host, split_part(split_part(split_part(url, '://', 2), '/', 1), '.', 1) AS prefix FROM pages"


def page_ids(spark, d):
    path = F.concat(F.col("source"), F.lit("/Sept "), F.col("doc_id"), F.lit(" (p1).jp2"))
    df = table(spark, d, "documents").select("doc_id", "source", T.page_id(path).alias("page_id"), T.image_identifier(path).alias("image_id"))
    return with_unique_ids(df, "source", ["doc_id"], "unique_id")


PAGE_IDS = """SELECT doc_id, source, rtrim(source || '__Sept_' || doc_id || '_p1_', '._') AS page_id, source || '%2FSept%20' || doc_id || '%20%28p1%29.jp2' AS image_id,
 CASE WHEN row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1 THEN source ELSE source || '_ext' || (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) END AS unique_id FROM documents"""


def normalise_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(U.normalise_text("text")).alias("plain_md5"), F.md5(U.normalise_dashes("text")).alias("dashes_md5"))


FOLDED_SQL = "translate({}, 'ſ‘’“”„–—¬', 's''''\"\"\"---')"
NORMALISE_TEXT = f"""WITH n AS (SELECT doc_id, regexp_replace({FOLDED_SQL.format("nfc_normalize(text)")}, '([\\p{{L}}\\p{{N}}_])-\\s*\\n\\s*([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g') AS t FROM documents),
c AS (SELECT doc_id, t, regexp_replace(t, '\\s*-+\\s*', '-', 'g') AS u FROM n)
SELECT doc_id, md5(trim(regexp_replace(t, '\\s+', ' ', 'g'))) AS plain_md5, md5(trim(regexp_replace(u, '\\s+', ' ', 'g'))) AS dashes_md5 FROM c"""


def fold_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(U.fold_text("text")).alias("folded_md5"))


FOLD_TEXT = f"""SELECT doc_id, md5(lower(replace({FOLDED_SQL.format("strip_accents(text)")}, '‚', ''''))) AS folded_md5 FROM documents"""


def cache_key(spark, d):
    return table(spark, d, "documents").select("doc_id", T.cache_key(F.lit("model"), F.lit(2000), F.lit(0), F.col("lang"), F.encode("text", "UTF-8")).alias("key"))


CACHE_KEY = "SELECT doc_id, sha256('model|2000|0|' || lang || text) AS key FROM documents"


def _page_words(spark, d):
    number = lambda c: c.cast("double")
    word = lambda w, at: F.struct(
        w.alias("text"), F.lit("B0").alias("region"), number((at % 12) * 80).alias("x"), number(F.floor(at / 12) * 30).alias("y"), number(F.length(w) * 6).alias("w"), F.lit(20.0).alias("h")
    )
    return table(spark, d, "documents").select(F.col("doc_id").alias("page_id"), F.transform(T.words(F.col("text")), word).alias("words"))


def phrase_search(spark, d):
    pages = _page_words(spark, d)
    hits = phrase_index.hits(pages, phrase_index.index(pages, ranges=False), "and the", whole_word=True)
    return hits.select("page_id", "word", "n_words", "line_height", "snippet", F.size("boxes").alias("n_boxes"))


PHRASE_SEARCH = """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS words FROM documents),
f AS (SELECT doc_id, words, list_transform(words, lambda x: lower(strip_accents(x))) AS folded FROM w),
h AS (SELECT doc_id, words, unnest(list_filter(range(0, len(words) - 1), lambda i: regexp_matches(folded[i + 1], '(^|[^\\p{L}\\p{N}])and$') AND regexp_matches(folded[i + 2], '^the($|[^\\p{L}\\p{N}])'))) AS i FROM f)
SELECT doc_id AS page_id, CAST(i AS INTEGER) AS word, 2 AS n_words, 20.0::DOUBLE AS line_height, array_to_string(words[greatest(i - 6, 0) + 1 : i + 8], ' ') AS snippet, CASE WHEN i % 12 = 11 THEN 2 ELSE 1 END AS n_boxes FROM h"""


def phrase_function(spark, d):
    """The same hits by the table function, over one row for each word."""
    phrase_index.register(spark)
    words = _page_words(spark, d).select("page_id", F.posexplode("words").alias("at", "w")).select("page_id", "at", "w.*")
    call = "SELECT * FROM find_phrase(TABLE({words}) PARTITION BY (page_id) ORDER BY (at), 'and the', false, true)"
    return spark.sql(call, words=words).select("page_id", "word", "n_words", "line_height", "snippet", F.size("boxes").alias("n_boxes"))


PHRASE_FUNCTION = PHRASE_SEARCH


def token_postings(spark, d):
    """Of the index's postings: pages, places and the widest distance between two places of one page, by token."""
    p = phrase_index.postings(phrase_index.places(_page_words(spark, d)))
    wide = F.element_at("words", -1) - F.get("words", F.lit(0))
    return p.groupBy("token").agg(F.count("*").alias("pages"), F.sum("n").alias("n"), F.max(wide).alias("widest"))


TOKEN_POSTINGS = f"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS words FROM documents),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS pos FROM w),
f AS (SELECT {FOLDED_SQL.format("lower(strip_accents(word))")} AS token, doc_id, pos FROM p),
g AS (SELECT token, doc_id, count(*) AS n, max(pos) - min(pos) AS wide FROM f GROUP BY ALL)
SELECT token, count(*) AS pages, sum(n)::BIGINT AS n, max(wide)::INTEGER AS widest FROM g GROUP BY token"""


def search_page_counts(spark, d):
    text = F.lower(F.array_join(T.words(F.col("text")), " "))
    n = F.regexp_count(text, F.lit("and the"))
    return table(spark, d, "documents").select("doc_id", n.alias("matches")).where("matches > 0")


SEARCH_PAGE_COUNTS = "SELECT doc_id, len(string_split(lower(regexp_replace(text, '\\s+', ' ', 'g')), 'and the')) - 1 AS matches FROM documents WHERE matches > 0"


def reading_ease(spark, d):
    return table(spark, d, "documents").select("doc_id", U.reading_ease("text").alias("flesch"))


READING_EASE = """WITH t AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(lower(text), '\\s+'), lambda x: regexp_replace(x, '[^a-z]', '', 'g')), lambda x: x <> '') AS words,
  greatest(1, len(regexp_extract_all(text, '[.!?]+(\\s|$)'))) AS sentences FROM documents),
g AS (SELECT doc_id, len(words) AS n, sentences, list_transform(words, lambda x: struct_pack(k := len(regexp_extract_all(x, '[aeiouy]+')), e := ends_with(x, 'e') AND NOT ends_with(x, 'le'))) AS each FROM t),
s AS (SELECT doc_id, n, sentences, list_sum(list_transform(each, lambda x: greatest(1, x.k - CASE WHEN x.e AND x.k > 1 THEN 1 ELSE 0 END))) AS syllables FROM g)
SELECT doc_id, CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE CAST(printf('%.2f', (206.835::DOUBLE - 1.015::DOUBLE * n / sentences) - 84.6::DOUBLE * syllables / n) AS DOUBLE) END AS flesch FROM s"""


def align_regions(spark, d):
    tokens = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    # a word box list from a perturbed copy of the text: every seventh word loses its first letter
    bent = F.transform(tokens, lambda w, i: F.struct(F.when((i % 7 == 3) & (F.length(w) > 3), F.substring(w, 2, 100)).otherwise(w).alias("text"), F.lit(90.0).alias("conf"), F.floor(i / 8).cast("int").alias("line"), ((i % 8) * 120).cast("double").alias("x1"), (F.floor(i / 8) * 30).cast("double").alias("y1"), ((i % 8) * 120 + 100).cast("double").alias("x2"), (F.floor(i / 8) * 30 + 20).cast("double").alias("y2")))
    lines = F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / 8).cast("int")), lambda k: F.array_join(F.slice(tokens, k * 8 + 1, 8), " ")), "\n")
    df = table(spark, d, "benchmark").where(F.size(tokens) > 0).select(F.col("item_id").alias("region_id"), lines.alias("text"), bent.alias("words"))
    out = align.align_regions(df)
    return out.select("region_id", "score", "n_chandra_tokens", "n_tesseract_words", "n_matched", F.size("lines").alias("n_lines"), F.array_join(F.transform("words", lambda w: w["text"]), " ").alias("placed"))


def _two_readings(spark, d):
    """Turns and a second reading of them: every seventh word lost its first letter, every eleventh is gone, and of every third turn the halves changed places."""
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    turns = table(spark, d, "conversations").select("conv_id", "turn", words.alias("left")).where("size(left) > 0")
    bent = F.transform("left", lambda w, i: F.when((i % 7 == 3) & (F.length(w) > 3), F.substring(w, F.lit(2), F.length(w))).when(i % 11 != 10, w))
    half = F.floor(F.size("left") / 2).cast("int")
    turned = F.when(F.col("turn") % 3 == 2, F.concat(F.slice(bent, half + 1, F.size("left")), F.slice(bent, 1, half))).otherwise(bent)
    return turns.select("conv_id", "turn", "left", F.filter(turned, lambda w: w.isNotNull()).alias("right"))


def token_anchors(spark, d):
    return anchors.anchors(_two_readings(spark, d), ["conv_id", "turn"])


TOKEN_ANCHORS = r"""WITH w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS a FROM conversations),
x AS (SELECT *, list_transform(range(0, len(a)), lambda i: CASE WHEN i % 7 = 3 AND length(a[i + 1]) > 3 THEN substr(a[i + 1], 2) WHEN i % 11 <> 10 THEN a[i + 1] END) AS b, len(a) // 2 AS h FROM w WHERE len(a) > 0),
y AS (SELECT conv_id, turn, a, list_filter(CASE WHEN turn % 3 = 2 THEN list_concat(b[h + 1:], b[1:h]) ELSE b END, lambda t: t IS NOT NULL) AS b FROM x),
l AS (SELECT conv_id, turn, unnest(list_transform(range(0, greatest(len(a) - 2, 0)), lambda i: {'g': array_to_string(a[i + 1:i + 3], chr(31)), 'at': i})) AS s FROM y),
r AS (SELECT conv_id, turn, unnest(list_transform(range(0, greatest(len(b) - 2, 0)), lambda i: {'g': array_to_string(b[i + 1:i + 3], chr(31)), 'at': i})) AS s FROM y),
lu AS (SELECT conv_id, turn, s.g AS g, min(s.at) AS left_at FROM l GROUP BY ALL HAVING count(*) = 1),
ru AS (SELECT conv_id, turn, s.g AS g, min(s.at) AS right_at FROM r GROUP BY ALL HAVING count(*) = 1)
SELECT conv_id, turn, CAST(left_at AS INTEGER) AS left_at, CAST(right_at AS INTEGER) AS right_at FROM lu JOIN ru USING (conv_id, turn, g)"""


def token_alignment(spark, d):
    return anchors.align_streams(_two_readings(spark, d), ["conv_id", "turn"])


def label_parse(spark, d):
    raw = F.concat(F.lit("```json\n{'class': "), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("["), F.col("doc_id") % 18, F.lit(", 4]"))).when(F.col("doc_id") % 3 == 1, (F.col("doc_id") % 7).cast("string")).otherwise("unclear"), F.lit("}\n```"))
    return table(spark, d, "labels").select("doc_id", F.concat_ws(",", T.parse_label(raw).cast("array<string>")).alias("codes"))


LABEL_PARSE = "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN (doc_id % 18) || ',4' WHEN 1 THEN CAST(doc_id % 7 AS VARCHAR) ELSE '99' END AS codes FROM labels"


def request_jsonl(spark, d):
    prompt = F.when(F.col("lang") == "en", "Transcribe.").otherwise("Transcribe as printed.")
    body = F.struct(F.lit(2000).alias("max_tokens"), F.array(F.struct(F.lit("user").alias("role"), F.concat(prompt, F.lit(" #"), F.col("doc_id")).alias("content"))).alias("messages"))
    return table(spark, d, "documents").select("doc_id", F.to_json(F.struct(F.col("doc_id").cast("string").alias("custom_id"), body.alias("body"))).alias("line"))


REQUEST_JSONL = """SELECT doc_id, '{"custom_id":"' || doc_id || '","body":{"max_tokens":2000,"messages":[{"role":"user","content":"' || CASE WHEN lang = 'en' THEN 'Transcribe.' ELSE 'Transcribe as printed.' END || ' #' || doc_id || '"}]}}' AS line FROM documents"""

def word_candidates(spark, d):
    words = table(spark, d, "documents").select("doc_id", F.posexplode(T.words(F.col("text"))).alias("at", "word"))
    sure = finish.word_candidate(F.col("word"), (F.col("at") * 37 + F.col("doc_id")) % 101)
    return words.groupBy("doc_id").agg(F.count(F.when(sure, 1)).alias("candidates"), F.count("*").alias("words"))


WORD_CANDIDATES = """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS words FROM documents),
e AS (SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS i FROM w)
SELECT doc_id, count(*) FILTER (WHERE (i * 37 + doc_id) % 101 > 90 AND length(word) >= 5 AND regexp_matches(word, '^\\p{L}+$')) AS candidates, count(*) AS words FROM e GROUP BY doc_id"""


def run_summary(spark, d):
    regions = table(spark, d, "conversations").select((F.col("conv_id") % 50).alias("page_id"), F.when(F.col("turn") % 7 == 3, "cut").alias("suspect"), F.length("text").alias("total_tokens"), (F.col("turn") % 3 == 0).alias("cached"))
    return finish.run_summary(regions)


RUN_SUMMARY = "SELECT count(DISTINCT conv_id % 50) AS pages, count(*) AS regions, count(*) FILTER (WHERE turn % 7 = 3) AS withheld, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS tokens, count(*) FILTER (WHERE turn % 3 = 0) AS cached FROM conversations"

NAMES = [
    "word_candidates", "run_summary",
    "doc_counts", "title_lines", "articles_from_documents", "articles_from_conversations", "merge_title_runs", "merge_title_runs_compat", "clean_line_breaks", "fragment_share", "quality_flags", "layout_json_flag",
    "keyword_filter_ci", "custom_id_decompose", "segment_totals", "segment_knit", "semi_sample", "anti_processed", "hash_split", "batch_number", "global_batches", "cer_pairs_ascii", "micro_error_rates", "worst_pages", "word_error_pairs",
    "html_text", "url_parts", "page_ids", "normalise_text", "fold_text", "cache_key", "phrase_search", "phrase_function", "token_postings", "search_page_counts", "reading_ease", "align_regions", "token_anchors", "token_alignment", "label_parse", "request_jsonl",
]
QUERIES = {n: globals()[n] for n in NAMES}
ORACLE_SQL = {n: globals()[n.upper()] for n in NAMES if n.upper() in globals()}
