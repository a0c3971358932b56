"""The operators over the given tables: documents as messages, conversations as threads, embeddings as chunk vectors.

Each query reads whole tables. ORACLES has DuckDB SQL of the same rows where SQL can express them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmine.functions import hashes, tripwire
from askmine.functions import text as t
from askmine.operators import chunking, clusters, dedupe, density, embedding, redaction, seeding, similar, spans, terms, threads
from askmine.plans import base, more_queries
from askmine.plans.base import HANDLE_SQL, RANK

_query, _table = base.query, base.table
RUNS = """
words AS (SELECT doc_id, regexp_extract_all(lower(regexp_replace(text, '<[A-Z_]+>', ' ', 'g')), '\\p{L}+') AS w FROM documents),
runs AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)),
seen AS (SELECT run, count(*) AS n FROM runs GROUP BY run)
"""


@_query("SELECT doc_id, " + RANK.format(k="doc_id") + " AS rank, " + RANK.format(k="doc_id") + " < 0.1 AS held_out FROM documents")
def holdout_split(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", hashes.split_rank(F.col("doc_id")).alias("rank"), hashes.is_held_out(F.col("doc_id")).alias("held_out"))


@_query("SELECT " + RANK.format(k="conv_id") + " < 0.1 AS held_out, count(DISTINCT conv_id) AS n_threads, count(*) AS n_turns FROM conversations GROUP BY 1")
def holdout_stats(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").withColumn("held_out", hashes.is_held_out(F.col("conv_id")))
    return turns.groupBy("held_out").agg(F.count_distinct("conv_id").alias("n_threads"), F.count(F.lit(1)).alias("n_turns"))


@_query(r"""SELECT doc_id, min(doc_id) OVER (PARTITION BY trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) AS first_key,
 doc_id = min(doc_id) OVER (PARTITION BY trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) AS is_first FROM documents""")
def exact_text_dedupe(spark, sf_dir):
    found = dedupe.first_of_equal_texts(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", "first_key", (F.col("doc_id") == F.col("first_key")).alias("is_first"))


@_query(r"""SELECT doc_id, regexp_matches(text, '(^|[^0-9])(\+?1[\s.-]?)?\(?[0-9]{3}\)?[\s.-]?[0-9]{3}[\s.-][0-9]{4}([^0-9]|$)') AS phone,
 regexp_matches(text, '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+(\.[\p{L}\p{N}_-]+)+') AS email, regexp_matches(text, '(?i)\bhttps?://\S|\bwww\.\S') AS url, """ + HANDLE_SQL.format(c="text") + " AS handle FROM documents")
def tripwire_flags(spark, sf_dir):
    c = F.col("text")
    return _table(spark, sf_dir, "documents").select("doc_id", tripwire.fires(c, "PHONE_NUMBER").alias("phone"), tripwire.fires(c, "EMAIL_ADDRESS").alias("email"), tripwire.fires(c, "URL").alias("url"), tripwire.fires(c, "SOCIAL_HANDLE").alias("handle"))


@_query(r"SELECT doc_id, len(regexp_extract_all(regexp_replace(text, '<[A-Z_]+>', ' ', 'g'), '\p{L}{2,}')) >= 3 AS has_content FROM documents")
def content_filter(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", t.has_content(F.col("text")).alias("has_content"))


@_query(r"SELECT doc_id, len(regexp_extract_all(text, '\S+'))::BIGINT AS n_words, true AS none_lost, true AS none_long FROM documents WHERE regexp_matches(text, '\S')")
def chunk_conservation(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").withColumn("total", t.n_words(F.col("text")))
    parts = chunking.chunked(docs, "text", keep_empty=True)
    sums = parts.groupBy("doc_id", "total").agg(F.sum("n_words").alias("n_words"), F.max("n_words").alias("most"))
    return sums.select("doc_id", "n_words", (F.col("total") == F.col("n_words")).alias("none_lost"), (F.col("most") <= chunking.TARGET_WORDS).alias("none_long"))


@_query(r"""SELECT w AS n_words, count(*) AS n_docs FROM (SELECT len(regexp_extract_all(text, '\S+'))::INTEGER AS w FROM documents) WHERE w BETWEEN 1 AND 300 GROUP BY w""")
def chunk_counts(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").withColumn("total", t.n_words(F.col("text")))
    parts = chunking.chunked(docs, "text", keep_empty=True).filter("n_chunks = 1")
    return parts.groupBy("n_words").agg(F.count(F.lit(1)).alias("n_docs"))


@_query()
def all_chunk_counts(spark, sf_dir):
    """How many documents have how many words and chunks, whatever their length; chunk_counts has those of one chunk."""
    body = F.coalesce("text", F.lit(""))
    sizes = _table(spark, sf_dir, "documents").select(t.n_words(body).alias("n_words"), F.size(chunking.chunks_of(body)).alias("n_chunks"))
    return sizes.groupBy("n_words", "n_chunks").agg(F.count(F.lit(1)).alias("n_docs"))


@_query("WITH" + RUNS + """, rare AS (SELECT runs.* FROM runs JOIN seen USING (run) WHERE n <= 20), n_of AS (SELECT doc_id, count(*) AS n_rare FROM rare GROUP BY 1),
 pairs AS (SELECT a.doc_id, b.doc_id AS twin, count(*) AS n_shared FROM rare a JOIN rare b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n_shared DESC, twin) AS rn FROM pairs)
 SELECT doc_id, twin, n_shared, n_rare FROM best JOIN n_of USING (doc_id) WHERE rn = 1 AND n_shared >= 0.5 * n_rare""")
def near_duplicates(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return similar.near_duplicates(docs, docs, "doc_id", "doc_id", "text")


@_query("WITH" + RUNS + "SELECT n, count(*) AS n_runs FROM seen GROUP BY n")
def shingle_df(spark, sf_dir):
    return similar.run_counts(_table(spark, sf_dir, "documents"), "text").groupBy("n").agg(F.count(F.lit(1)).alias("n_runs"))


@_query("WITH" + RUNS + """, iw AS (SELECT item_id, regexp_extract_all(lower(text), '\\p{L}+') AS w FROM benchmark),
 ir AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 4], ' ') AS run FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM iw WHERE len(w) >= 5))
 SELECT item_id, doc_id, count(*) AS n_shared FROM ir JOIN runs USING (run) GROUP BY 1, 2""")
def benchmark_overlap(spark, sf_dir):
    run = lambda table, key: _table(spark, sf_dir, table).select(key, F.explode(t.shingles(F.col("text"))).alias("run"))
    return run("benchmark", "item_id").join(run("documents", "doc_id"), "run").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("n_shared"))


@_query("""SELECT a.conv_id, a.turn, (SELECT min(b.turn) FROM conversations b WHERE b.conv_id = a.conv_id AND b.role = 'assistant' AND b.turn > a.turn) AS reply_turn FROM conversations a WHERE a.role = 'user'""")
def first_reply(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    found = threads.with_first_reply(turns, "conv_id", "turn", "turn", F.col("role") == "user", F.col("role") == "assistant")
    return found.select("conv_id", "turn", F.col("reply.time").alias("reply_turn"))


@_query("SELECT conv_id, turn FROM conversations a WHERE role = 'user' AND NOT EXISTS (SELECT 1 FROM conversations b WHERE b.role = 'assistant' AND b.text = a.text)")
def own_unsent(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", "inbound").when(F.col("role") == "assistant", "outbound").otherwise("other").alias("direction"), F.sha2("text", 256).alias("sender"))
    return threads.without_own_unsent(turns).filter("direction = 'inbound'").select("conv_id", "turn")


_TERMS = " " + base.TERMS_SQL.replace("{table}", "documents").replace("{key}", "doc_id") + " "


@_query("WITH" + _TERMS.format(group="source") + "SELECT g AS source, rank, term, n_term FROM top")
def top_terms(spark, sf_dir):
    return terms.top_terms(_table(spark, sf_dir, "documents"), "source", "text")


@_query("WITH" + _TERMS.format(group="lang") + "SELECT g AS lang, rank, term, n_term FROM top")
def top_terms_by_lang(spark, sf_dir):
    return terms.top_terms(_table(spark, sf_dir, "documents"), "lang", "text")


@_query("""WITH c AS (SELECT label, vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT label, i, avg(x) AS m FROM c GROUP BY 1, 2),
 d AS (SELECT label, vec_id, round(sum(x * m), 9) AS dot FROM c JOIN m USING (label, i) GROUP BY 1, 2)
 SELECT label, row_number() OVER (PARTITION BY label ORDER BY dot DESC, vec_id)::INTEGER AS rank, vec_id FROM d QUALIFY rank <= 5""")
def representatives(spark, sf_dir):
    return clusters.representatives(_table(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding")


@_query("SELECT label, count(*) AS n, (row_number() OVER (ORDER BY count(*) DESC, label) - 1)::INTEGER AS new_cluster FROM embeddings GROUP BY label")
def cluster_sizes_ranked(spark, sf_dir):
    return clusters.ranked_by_size(_table(spark, sf_dir, "embeddings"), "label")


@_query()
def density_clusters(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return density.clustered(vectors, "vec_id", "embedding").select("vec_id", "cluster", "probability")


@_query()
def density_sweep(spark, sf_dir):
    return density.sweep(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


_MARKUP = ", ".join(f"'{w}'" for w in clusters.MARKUP_WORDS)
_SIGNALS = f"""sig AS (SELECT source, count(*) AS n, count(*) FILTER (contains(text, '?')) AS n_question, count(*) FILTER (len(regexp_extract_all(text, '(?i)[{t.VIETNAMESE}]')) >= 5) AS n_vietnamese,
 count(*) FILTER (contains(text, 'Date/Time of Event') OR contains(text, 'Message (Please') OR contains(text, 'Day of Contact') OR contains(text, 'Total: $')) AS n_template,
 count(*) FILTER (regexp_matches(text, '(?i){t.FOOTER_NOTICE}')) AS n_footer FROM documents GROUP BY 1),
mk AS (SELECT g AS source, count(*) FILTER (len(list_filter(string_split(term, ' '), lambda x: x NOT IN ({_MARKUP}))) = 0) AS markup_terms FROM top GROUP BY 1)"""


@_query("WITH" + _TERMS.format(group="source") + "," + _SIGNALS + "SELECT sig.*, coalesce(markup_terms, 0) AS markup_terms FROM sig LEFT JOIN mk USING (source)")
def triage_signals(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return clusters.signals(docs, "source", "text", terms.top_terms(docs, "source", "text"))


@_query("WITH" + _TERMS.format(group="source") + "," + _SIGNALS + """SELECT source, CASE WHEN n_vietnamese >= 0.5 * n OR n_template >= 0.5 * n OR n_footer >= 0.3 * n THEN 'skip' WHEN coalesce(markup_terms, 0) >= 3 OR n_question <= 0.1 * n THEN 'review' ELSE 'faq' END AS decision,
 CASE WHEN n_vietnamese >= 0.5 * n THEN 'non_english' WHEN n_template >= 0.5 * n THEN 'template' WHEN n_footer >= 0.3 * n THEN 'footer' WHEN coalesce(markup_terms, 0) >= 3 THEN 'markup' WHEN n_question <= 0.1 * n THEN 'few_questions' ELSE '' END AS reason
 FROM sig LEFT JOIN mk USING (source)""")
def triage_decide(spark, sf_dir):
    return clusters.triaged(triage_signals(spark, sf_dir)).select("source", "decision", "reason")


@_query()
def span_scan(spark, sf_dir):
    """All recognizers over every text, decided on, with the signature zones."""
    return spans.flagged(_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.lit("").alias("subject"), F.col("text").alias("body"))).select("email_id", "field", "entity_type", "start", "end", "score", "recognizer", "decision", "rule")


@_query()
def redacted(spark, sf_dir):
    emails = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.lit("").alias("subject"), F.col("text").alias("body"))
    done = redaction.redact(emails, spans.flagged(emails))
    return done.select("id", "n_redacted", "signature_chars", F.sha2("body", 256).alias("body_sha256"))


@_query()
def signature_zones(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.zones(docs, "text", spans.scanned(F.col("text"))).select("doc_id", "zone_start", "zone_end")


@_query(r"""SELECT word, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(regexp_replace(text, '\S*@\S*|(?i:\bhttps?://\S+|\bwww\.\S+)', ' ', 'g'), '\p{L}+')) AS word FROM documents) WHERE word = lower(word) GROUP BY word HAVING count(*) >= 10""")
def lowercase_usage(spark, sf_dir):
    return terms.lowercase_usage(_table(spark, sf_dir, "documents"), "text")


@_query("""WITH i AS (SELECT l_suppkey, date_diff('day', DATE '1990-01-01', l_shipdate::DATE)::BIGINT AS s, date_diff('day', DATE '1990-01-01', l_shipdate::DATE)::BIGINT + l_quantity::BIGINT AS e FROM lineitem),
 o AS (SELECT *, max(e) OVER (PARTITION BY l_suppkey ORDER BY s, e DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
 r AS (SELECT *, sum(CASE WHEN reach IS NULL OR s >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY s, e DESC ROWS UNBOUNDED PRECEDING) AS run FROM o)
 SELECT l_suppkey, min(s) AS run_start, max(e) AS run_end, count(*) AS n FROM r GROUP BY l_suppkey, run""")
def span_clusters(spark, sf_dir):
    """Shipments as intervals of days, one day per piece."""
    day = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("bigint")
    rows = _table(spark, sf_dir, "lineitem").select("l_suppkey", day.alias("s"), (day + F.rint("l_quantity").cast("bigint")).alias("e"))
    return dedupe.merged_intervals(rows, ["l_suppkey"], "s", "e")


@_query("""SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate::DATE <= o_orderdate::DATE + 30 AND o_orderdate::DATE + 31 <= l_shipdate::DATE + l_quantity::INTEGER)""")
def mention_containment(spark, sf_dir):
    """Orders whose 31st day lies inside a shipment's interval."""
    points = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.date_add("o_orderdate", 30).alias("s"), F.date_add("o_orderdate", 31).alias("e"))
    low = F.col("l_shipdate").cast("date")
    inside = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), low.alias("low"), F.date_add(low, F.col("l_quantity").cast("int")).alias("high"))
    return dedupe.contained(points, inside, ["k"], "s", "e", "low", "high").select(F.col("k").alias("o_orderkey"))


@_query("SELECT doc_id, substr(sha256(trim(source)), 1, 16) AS plain, sha256(chr(0) || trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS fingerprint FROM documents")
def hashes_of(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", hashes.plain_hash(F.col("source")).alias("plain"), hashes.body_fingerprint(F.lit(""), F.col("text")).alias("fingerprint"))


@_query("SELECT c_nationkey AS nation FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def multiset_diff(spark, sf_dir):
    return dedupe.multiset_difference(_table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")), _table(spark, sf_dir, "supplier").select("s_nationkey"))


@_query("""SELECT event_type, user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY sha256('0:' || CAST(event_id AS VARCHAR)), event_id) AS rn FROM events) WHERE rn <= 3""")
def stratified_sample(spark, sf_dir):
    return seeding.stratified(_table(spark, sf_dir, "events"), "event_id", "event_type", 3).select("event_type", "user_id", "event_id")


@_query()
def chunk_vectors(spark, sf_dir):
    """Filtered, chunked and embedded documents with the offline provider; of each unit vector the digest of its numbers, in 2^-30.

    The table has no outbound mail, so no sender is one's own here; drop_reasons has some.
    """
    docs = _table(spark, sf_dir, "documents")
    emails = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").cast("string").alias("thrid"), F.lit(None).cast("string").alias("date"), F.lit("inbound").alias("direction"), F.col("source").alias("sender"), F.lit("").alias("subject"), F.col("text").alias("body"))
    digits = F.transform("embedding", lambda x: F.rint(x.cast("double") * float(1 << 30)).cast("bigint").cast("string"))
    return embedding.embedded(emails).select("chunk_id", "id", "chunk_index", "n_chunks", "n_words", F.size("embedding").alias("width"), F.sha2(F.concat_ws(",", digits), 256).alias("vector_sha256"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out and unsafe messages left out, the rest's distinctive terms by source and language."""
    c = F.col("text")
    docs = _table(spark, sf_dir, "documents").filter(~hashes.is_held_out(F.col("doc_id")) & ~tripwire.fires_any(c) & t.has_content(c))
    return terms.top_terms(docs.withColumn("topic", F.concat_ws("/", "source", "lang")), "topic", "text")


QUERIES, ORACLES = base.QUERIES, base.ORACLES
holdout_queries = more_queries.holdout_queries
