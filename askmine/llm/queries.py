"""The queries of the training-data operators: thin, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmine.llm import bpe, collocations, decontaminate, exact_topk, fill_middle, hilbert, quality, repetition, simhash, substring_dedup, suffix_dedup, toxicity, warc
from askmine.llm.base import table

RANK_FILE = "byte_bpe_50k.tiktoken"
#: Scores from which a row is predicted toxic, or of good quality.
TOXIC_FROM = GOOD_FROM = 0.7


def _remainder(of: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of))


def learn_toxicity():
    """The rows whose toxicity labels may be learnt."""
    return _remainder(3) != 1


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANK_FILE)
    done = bpe.round_trip(table(spark, sf_dir, "documents"), path)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.build(warc.responses(table(spark, sf_dir, "pages")))
    return made.withColumnRenamed("key", "page_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=learn_toxicity())
    return toxicity.score(docs, model).select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = repetition.judge(repetition.measure(table(spark, sf_dir, "documents")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered")


def op7_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = hilbert.shards(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "place")


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeated_windows(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_fourier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=_remainder(4) != 2)
    return scored.select("doc_id", (_remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


def op10_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), ids.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(fill_middle.restored()).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_warc": op2_warc,
    "op3_simhash": op3_simhash,
    "op4_suffix_array": op4_suffix_array,
    "op5_string_kernel": op5_string_kernel,
    "op6_repetition": op6_repetition,
    "op7_hilbert": op7_hilbert,
    "op8_substring": op8_substring,
    "op9_fourier": op9_fourier,
    "op10_fm_index": op10_fm_index,
    "op11_collocations": op11_collocations,
    "op12_exact_topk": op12_exact_topk,
    "op13_fill_middle": op13_fill_middle,
}
#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op4_suffix_array": r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, hash(x[i : i + 199]) AS h FROM (SELECT doc_id, x, unnest(range(1, n - 198)) AS i FROM d WHERE n >= 200)),
r AS (SELECT doc_id, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
o AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM r),
s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o) GROUP BY doc_id, run),
e AS (SELECT doc_id, a, b FROM s UNION ALL SELECT doc_id, n + 1, n + 1 FROM d),
k AS (SELECT doc_id, a, b, lag(b, 1, 1) OVER (PARTITION BY doc_id ORDER BY a, b) AS f FROM e),
g AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) - 1 AS n_spans, string_agg(CASE WHEN f < a THEN hex(x[f : a - 1]) ELSE '' END, '' ORDER BY a, b) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256 FROM g JOIN d USING (doc_id)""",
    "op6_repetition": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, n, i, hash(array_to_string(w[i : i + n - 1], ' ')) AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (VALUES (3), (8), (51)) v(n) WHERE len(w) >= n)),
rep AS (SELECT doc_id, n, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, n, s) > 1),
cov AS (SELECT doc_id, n, count(DISTINCT p) AS c FROM (SELECT doc_id, n, unnest(range(i, i + n)) AS p FROM rep WHERE n < 51) GROUP BY 1, 2),
long AS (SELECT DISTINCT doc_id FROM rep WHERE n = 51),
f AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda t: length(t))), 0)::BIGINT AS word_chars, len(regexp_extract_all(x, '[#*$%&|<>]'))::BIGINT AS n_symbols,
 list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (SELECT f.*, coalesce((SELECT c FROM cov WHERE cov.doc_id = f.doc_id AND n = 3), 0) AS n_repeat_words, coalesce((SELECT c FROM cov WHERE cov.doc_id = f.doc_id AND n = 8), 0) AS n_covered FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
 NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_covered <= 0.4 * n_words AND doc_id NOT IN (SELECT doc_id FROM long) AS kept, n_covered FROM m""",
    "op8_substring": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN least USING (s), range(0, 13) t(k) WHERE m < doc_id),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
done AS (SELECT doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS kept FROM each LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN done USING (doc_id)""",
    "op10_fm_index": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT DISTINCT item_id::VARCHAR AS item, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
win AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item, i, n FROM win JOIN q USING (n, s)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(m) WHERE len(w) >= m)),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING m = 1 OR count(*) >= 10),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY 1),
c AS MATERIALIZED (SELECT lang, m, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE m > 1 AND f >= 10),
k AS (SELECT lang, phrase, a, k, array_to_string(ws[1 : k], ' ') AS first, array_to_string(ws[k + 1 : m], ' ') AS rest FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, (1000000::HUGEINT * k.a * k.a // (x.f::HUGEINT * y.f))::BIGINT AS score
 FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.first JOIN f y ON y.lang = k.lang AND y.phrase = k.rest),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
x AS (SELECT lang, phrase, max(f) AS around FROM (SELECT lang, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS phrase, a AS f FROM c WHERE m = 3) GROUP BY 1, 2),
kept AS (SELECT b.* FROM b LEFT JOIN x ON x.lang = b.lang AND x.phrase = b.phrase WHERE x.around IS NULL OR 100 * x.around < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000""",
    "op12_exact_topk": r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e, row_number() OVER () AS r FROM embeddings
 WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score, row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
 FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM s WHERE rank <= 20""",
    "op13_fill_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, sha256('42:' || doc_id) AS s FROM documents),
h AS (SELECT *, len(w) AS n, list_transform(range(0, 4), lambda i: ('0x' || s[8 * i + 1 : 8 * i + 8])::BIGINT) AS h FROM d),
u AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b FROM h),
p AS (SELECT doc_id, x, n, coalesce(array_to_string(w[1 : a], ''), '') AS pre, coalesce(array_to_string(w[a + 1 : b], ''), '') AS mid, coalesce(array_to_string(w[b + 1 : n], ''), '') AS suf,
 CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(x) AS restored_sha256 FROM p""",
}
