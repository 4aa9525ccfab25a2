"""Text and nested-value functions over the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, masking, scores, text
from ..operators import dedup, quotes, sampling
from .registry import query, table


@query("""
WITH t AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS w FROM conversations),
c AS (SELECT conv_id, turn, w, unnest(range(0, greatest(1, ceil((len(w) - 5) / 15.0)::INT))) AS number FROM t WHERE len(w) > 0)
SELECT conv_id, turn, CAST(number AS INTEGER) AS number, CAST(number * 15 AS INTEGER) AS start, array_to_string(w[number * 15 + 1 : number * 15 + 20], ' ') AS chunk FROM c""")
def chunk_overlap(spark, sf_dir):
    """Turns in chunks of twenty words that share five with the next."""
    words = F.filter(F.split("text", r"[ \t\n\r]+"), lambda w: w != "")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(text.chunks(words, 20, 5)).alias("c"))
    return rows.select("conv_id", "turn", "c.number", "c.start", F.array_join("c.tokens", " ").alias("chunk"))


@query("""
WITH t AS (SELECT conv_id, turn, string_split(replace(text, '. ', '.' || chr(10)), chr(10)) AS p FROM conversations),
s AS (SELECT conv_id, turn, unnest(p) AS s, generate_subscripts(p, 1) AS place FROM t), k AS (SELECT *, row_number() OVER (PARTITION BY conv_id, trim(s) ORDER BY turn, place) AS r FROM s WHERE trim(s) <> '')
SELECT conv_id, turn, string_agg(s, ' ' ORDER BY place) AS deduplicated FROM k WHERE r = 1 GROUP BY conv_id, turn""")
def sentence_dedup(spark, sf_dir):
    """Turns without sentences that stand earlier in their conversation."""
    return dedup.first_sentences(table(spark, sf_dir, "conversations"), "conv_id", ["turn"], "text", r"(?<=\.) |\n")


@query("""
WITH r AS (SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'so **Final Score: ' || doc_id % 9 || '**' WHEN 1 THEN 'score = ' || doc_id % 7 WHEN 2 THEN 'This is NOT REASONABLE' WHEN 3 THEN 'excluded? Yes!' WHEN 4 THEN 'No!  ' WHEN 5 THEN 'yes' WHEN 6 THEN 'no' ELSE 'unclear' END AS a FROM documents)
SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN least(doc_id % 9, 5) WHEN 1 THEN least(doc_id % 7, 5) WHEN 2 THEN 0 ELSE -1 END::INT AS score, CASE doc_id % 8 WHEN 3 THEN 1.0 WHEN 4 THEN 0.0 WHEN 5 THEN 1.0 WHEN 6 THEN 0.0 ELSE -1.0 END::DOUBLE AS excluded FROM r""")
def response_parsers(spark, sf_dir):
    """Scores and yes/no answers read from the ends of responses."""
    n = F.col("doc_id")
    cases = [F.concat(F.lit("so **Final Score: "), (n % 9).cast("string"), F.lit("**")), F.concat(F.lit("score = "), (n % 7).cast("string")), F.lit("This is NOT REASONABLE"), F.lit("excluded? Yes!"), F.lit("No!  "), F.lit("yes"), F.lit("no"), F.lit("unclear")]
    answer = F.element_at(F.array(*cases), (n % 8 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", text.final_score(answer).alias("score"), text.yes_no_tail(answer).alias("excluded"))


@query("""
SELECT item_id, count(*) FILTER (WHERE contains(trim(lower(regexp_replace(d.text, '\\s+', ' ', 'g'))), trim(lower(regexp_replace(b.text, '\\s+', ' ', 'g'))))) AS n_documents FROM benchmark b, documents d GROUP BY item_id""")
def quote_grounding(spark, sf_dir):
    """In how many documents each benchmark text is quoted: candidates by a few words inside the quote, then the quote itself."""
    return quotes.quote_counts(table(spark, sf_dir, "benchmark"), "item_id", "text", table(spark, sf_dir, "documents"), "text", "n_documents")


@query("""
SELECT CAST(json_extract(props, '$.k') AS INT) AS k, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1""")
def json_listing_flatten(spark, sf_dir):
    """Events by a value inside their JSON."""
    k = F.from_json("props", "k int")["k"].alias("k")
    return table(spark, sf_dir, "events").groupBy(k).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("n_users"))


@query("""
WITH w AS (SELECT item_id, regexp_extract_all(lower(text), '[a-zà-öø-ÿ0-9_]+') AS a FROM benchmark),
p AS (SELECT x.item_id, x.a, y.a AS b FROM w x JOIN w y ON y.item_id = x.item_id + 1),
c AS (SELECT item_id, len(a) + len(b) AS n, list_sum(list_transform(list_distinct(a), lambda t: least(len(list_filter(a, lambda u: u = t)), len(list_filter(b, lambda u: u = t))))) AS k FROM p)
SELECT item_id, round(2.0 * k / n, 6) AS f1 FROM c""")
def token_overlap_f1(spark, sf_dir):
    """Token F1 between each benchmark text and the next one."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    nxt = items.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other"))
    return items.join(nxt, "item_id").select("item_id", F.round(text.token_f1(F.col("text"), F.col("other")), 6).alias("f1"))


@query("""
WITH t AS (SELECT doc_id, doc_id % 6 AS m FROM documents)
SELECT doc_id, CASE m WHEN 0 THEN '2021-02-01' WHEN 1 THEN '2021-02-17' WHEN 2 THEN '2020-12-01' END AS first_day, CASE m WHEN 0 THEN '2021-02-28' WHEN 1 THEN '2021-02-17' WHEN 2 THEN '2020-12-31' END AS last_day,
  CASE m WHEN 0 THEN 54.0 WHEN 1 THEN 1.5 WHEN 2 THEN round(2 + 3 * 7 / 365.2425, 6) WHEN 3 THEN NULL WHEN 4 THEN 67.5 END::DOUBLE AS age,
  CASE m WHEN 0 THEN 'NCT01234567' WHEN 1 THEN 'NCT76543210' END AS registry_id, CASE m WHEN 0 THEN 17123 WHEN 2 THEN 5123 END::BIGINT AS protocol FROM t""")
def field_parsers(spark, sf_dir):
    """Partial dates, ages, registry ids and protocol numbers."""
    pick = lambda *xs: F.element_at(F.array(*(F.lit(x) for x in xs)), (F.col("doc_id") % 6 + 1).cast("int"))
    bounds = dates.partial_bounds(pick("2021-02", " 2021-02-17", "2020-12", "2021-13", "bad", None))
    ages = pick("A man aged 54 with", "age 18 months", "Age 2 years and 3 weeks", "age 140", "aged 67.5 years", "no number")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.date_format(bounds["first"], "yyyy-MM-dd").alias("first_day"),
        F.date_format(bounds["last"], "yyyy-MM-dd").alias("last_day"),
        F.round(dates.age_years(ages), 6).alias("age"),
        text.clean_registry_id(pick(" nct01234567", "NCT76543210", "NCT1", "x", "", None)).alias("registry_id"),
        text.protocol_key(pick("17-123", "TP1234", "05-123", "12-345B", "", None)).alias("protocol"),
    )


@query("""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'no' ELSE 'yes' END AS a, CASE WHEN doc_id % 2 = 0 THEN 'yes' ELSE 'no' END AS b, CASE WHEN doc_id % 3 = 0 THEN 'yes' ELSE 'no' END AS c FROM documents)
SELECT doc_id, CASE WHEN a <> 'yes' THEN 0 ELSE 1 + (b = 'yes')::INT + (c = 'yes')::INT + 2 * (b = 'yes')::INT END AS score, round((n_chars + 1.25 * doc_id) * 4 / 1e6 + n_chars * 20 / 1e6, 9) AS cost FROM t JOIN documents USING (doc_id)""")
def match_scores(spark, sf_dir):
    """Scores of answer maps, and what a response costs."""
    yes = lambda c: F.when(c, "yes").otherwise("no")
    n = F.col("doc_id")
    answers = F.create_map(F.lit("reasonableness"), yes(n % 5 != 0), F.lit("cancer_type"), yes(n % 2 == 0), F.lit("burden"), yes(n % 3 == 0), F.lit("treatment_history"), F.lit("no"), F.lit("biomarker"), yes(n % 2 == 0))
    cost = scores.usage_cost(F.col("n_chars"), n, F.lit(None).cast("long"), F.col("n_chars"), 4.0, 20.0)
    return table(spark, sf_dir, "documents").select("doc_id", scores.match_score(answers).alias("score"), F.round(cost, 9).alias("cost"))


@query("""
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<a href=')) AS INTEGER) AS n_links, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages""")
def listing_pages(spark, sf_dir):
    """Title, links and host of each page."""
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit("<a href="), F.lit(0))).alias("n_links"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))


@query()
def mask_identifiers(spark, sf_dir):
    """Each document's own study identifiers masked, and what is left of them. (No SQL: replacement looks at each match's key.)"""
    n = (F.col("doc_id") % 900 + 100).cast("string")
    key = F.concat(F.lit("17"), n).cast("int")
    note = F.concat_ws(" ", F.substring("text", 1, 1 << 30), F.concat(F.lit("protocol #17-"), n), F.lit("and 18-999"), F.lit("NCT 01234567 ABC-1234"))
    own = masking.masked(note, F.array(key), F.array(F.lit("1234567")), F.array(F.lit("ABC1234")))
    return table(spark, sf_dir, "documents").select("doc_id", own.alias("m")).select("doc_id", "m.n_protocol", "m.n_nct", "m.n_code", F.concat_ws(",", "m.residual").alias("residual"))


@query()
def packed_windows(spark, sf_dir):
    """Documents packed first-fit into bins of 20000 characters, in windows. (No SQL: packing is sequential.)"""
    return sampling.packed_bins(table(spark, sf_dir, "documents"), "doc_id", "n_chars", 20_000, 4096, 3)
