"""T and A20: text features in long form, similarity, term extraction."""

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.profiling import EXCLUDE, in_list, rounded
from catalog.registry import query, table
from voxlens.functions.text import word_tokens
from voxlens.operators import features, models

TOKENS = f"SELECT doc_id, lang, unnest({q.tokens('text')}) AS term FROM documents"
COUNTS = f"SELECT doc_id, term, count(*) AS tf FROM ({TOKENS}) GROUP BY doc_id, term"
SPLIT = r"string_split_regex(regexp_replace(lower(text), '[\s\x0b]+$', ''), '[\s\x0b]')"
KEPT = f"list_filter({SPLIT}, lambda w: w NOT IN ({in_list(EXCLUDE)}))"


def counts(spark, sf):
    tokens = table(spark, sf, "documents").select("doc_id", word_tokens("text").alias("t"))
    return features.term_counts(tokens, "doc_id", "t")


def kept(spark, sf):
    tokens = features.tokenize(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return features.remove_stopwords(tokens, "words", EXCLUDE)


@query("t1_tokenize", f"SELECT doc_id, array_to_string({SPLIT}, '|') AS words FROM documents")
def t1(spark, sf):
    tokens = features.tokenize(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return tokens.select("doc_id", F.array_join("words", "|").alias("words"))


@query("t2_remove_stopwords", f"SELECT doc_id, array_to_string({KEPT}, '|') AS words FROM documents")
def t2(spark, sf):
    return kept(spark, sf).select("doc_id", F.array_join("filtered_words", "|").alias("words"))


@query("t3_count_vectors", f"""
SELECT term, CAST(count(*) AS DOUBLE) AS total, CAST(count(DISTINCT doc_id) AS DOUBLE) AS in_docs
FROM (SELECT doc_id, unnest({KEPT}) AS term FROM documents) GROUP BY term
""")
def t3(spark, sf):
    vectors, index = features.count_arrays(kept(spark, sf), "doc_id", "filtered_words")
    sums = vectors.select(F.inline("entries")).groupBy("idx").agg(
        F.sum("tf").cast("double").alias("total"), F.count("idx").cast("double").alias("in_docs"))
    return sums.join(index.select("idx", F.col("token").alias("term")), "idx").select("term", "total", "in_docs")


@query("t3_term_counts", COUNTS)
def t3_long(spark, sf):
    return counts(spark, sf)


@query("t4_idf_weights", f"""
WITH c AS ({COUNTS}), d AS (SELECT term, count(*) AS df FROM c GROUP BY term), n AS (SELECT count(*) AS n FROM documents)
SELECT doc_id, term, tf, df, round(tf * ln((n + 1) / (df + 1)), 4) AS weight FROM c JOIN d USING (term), n
""")
def t4(spark, sf):
    return rounded(features.idf_weights(counts(spark, sf), table(spark, sf, "documents"), "doc_id"), "weight")


@query("t5_vocabulary", f"SELECT term AS word, count(*) AS n FROM ({TOKENS}) GROUP BY term ORDER BY n DESC, term LIMIT 50")
def t5(spark, sf):
    return features.vocabulary(table(spark, sf, "documents").select(word_tokens("text").alias("t")), "t", 50)


@query("t6_vocabulary_index", f"""
SELECT term AS token, CAST(1 + row_number() OVER (ORDER BY n DESC, term) AS BIGINT) AS idx, n
FROM (SELECT term, count(*) AS n FROM ({TOKENS}) GROUP BY term)
""")
def t6_index(spark, sf):
    return features.vocabulary_index(table(spark, sf, "documents").select(word_tokens("text").alias("t")), "t")


@query("t6_encode_tokens", f"""
WITH v AS (SELECT term, 1 + row_number() OVER (ORDER BY n DESC, term) AS idx
  FROM (SELECT term, count(*) AS n FROM (SELECT * FROM ({TOKENS}) WHERE lang <> 'es') GROUP BY term)),
s AS (SELECT doc_id, {q.tokens('text')} AS t FROM documents),
p AS (SELECT doc_id, t[i] AS token, i FROM s, (SELECT unnest(range(1, 11)) AS i))
SELECT doc_id, string_agg(CASE WHEN token IS NULL THEN 0 ELSE coalesce(idx, 1) END, ' ' ORDER BY i) AS encoded
FROM p LEFT JOIN v ON token = term GROUP BY doc_id
""")
def t6(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", word_tokens("text").alias("t"))
    # The vocabulary leaves out one language, so that unknown tokens occur.
    vocab = features.vocabulary_index(docs.where("lang <> 'es'"), "t")
    encoded = features.encode_tokens(docs, "doc_id", "t", vocab, 10)
    return encoded.select("doc_id", F.array_join(F.col("encoded").cast("array<string>"), " ").alias("encoded"))


L2 = f"""
c AS ({COUNTS}), d AS (SELECT term, count(*) AS df FROM c GROUP BY term), n AS (SELECT count(*) AS n FROM documents),
w AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM c JOIN d USING (term), n),
l AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w)
"""


@query("t7_tfidf_l2", f"WITH {L2} SELECT doc_id, term, round(weight, 4) AS weight FROM l")
def t7(spark, sf):
    return rounded(features.tfidf_l2(counts(spark, sf), table(spark, sf, "documents"), "doc_id"), "weight")


@query("a20_mean_tfidf", f"""
WITH {L2} SELECT term, round(sum(weight) / (SELECT n FROM n), 6) AS mean_weight FROM l GROUP BY term
ORDER BY sum(weight) DESC, term LIMIT 100
""")
def a20(spark, sf):
    return rounded(features.mean_tfidf(table(spark, sf, "documents"), "doc_id", "text", 100), "mean_weight", digits=6)


@query("a20_mean_tfidf_by", f"""
WITH c AS (SELECT lang, doc_id, term, count(*) AS tf FROM ({TOKENS}) GROUP BY ALL),
d AS (SELECT lang, term, count(*) AS df FROM c GROUP BY ALL), n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
w AS (SELECT lang, n, doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM c JOIN d USING (lang, term) JOIN n USING (lang)),
l AS (SELECT lang, n, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w),
m AS (SELECT lang, term, sum(weight) / any_value(n) AS mean_weight FROM l GROUP BY lang, term),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY mean_weight DESC, term) AS INTEGER) AS rank FROM m)
SELECT lang, term, round(mean_weight, 6) AS mean_weight, rank FROM r WHERE rank <= 20
""")
def a20_by(spark, sf):
    top = features.mean_tfidf(table(spark, sf, "documents"), "doc_id", "text", 20, by="lang")
    return rounded(top, "mean_weight", digits=6)


@query("t8_ngrams", f"""
WITH t AS (SELECT {q.tokens('text')} AS t FROM documents)
SELECT gram, count(*) AS n FROM (SELECT unnest({q.grams('t')}) AS gram FROM t) GROUP BY gram
""")
def t8(spark, sf):
    return features.ngrams(table(spark, sf, "documents"), "text", 2)


@query("t16_class_tfidf", f"""
WITH c AS (SELECT lang, term, count(*) AS tf FROM ({TOKENS}) GROUP BY ALL),
f AS (SELECT term, sum(tf) AS f FROM c GROUP BY term),
a AS (SELECT avg(s) AS a FROM (SELECT lang, sum(tf) AS s FROM c GROUP BY lang)),
w AS (SELECT lang, term AS word, tf * ln(1 + a / f) AS weight FROM c JOIN f USING (term), a),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY weight DESC, word) AS INTEGER) AS rank FROM w)
SELECT lang, word, round(weight, 4) AS weight, rank FROM r WHERE rank <= 15
""")
def t16(spark, sf):
    docs = table(spark, sf, "documents").select("lang", word_tokens("text").alias("t"))
    return rounded(features.class_tfidf(docs, "lang", "t", 15), "weight")


@query("t17_similar_rows", """
WITH k AS (SELECT CAST(embedding AS DOUBLE[]) AS k FROM embeddings WHERE vec_id = 0)
SELECT vec_id, label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), k), 4) AS similarity
FROM embeddings, k ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), k) DESC, vec_id LIMIT 20
""")
def t17(spark, sf):
    vectors = table(spark, sf, "embeddings")
    wanted = vectors.where("vec_id = 0").first()["embedding"]
    return rounded(models.similar_rows(vectors, "embedding", wanted, 20, "vec_id").drop("embedding"), "similarity")


@query("t20_extract_terms", f"""
SELECT doc_id, array_to_string(list_filter({q.tokens('text')}, lambda w: w NOT IN ({in_list(EXCLUDE)})), ' ') AS terms FROM documents
""")
def t20(spark, sf):
    terms = features.extract_terms(table(spark, sf, "documents").select("doc_id", "text"), "text", EXCLUDE)
    return terms.select("doc_id", F.array_join("terms", " ").alias("terms"))


@query("t20_extract_terms_tokenizer", f"""
SELECT doc_id, array_to_string(list_filter({q.words('text')}, lambda w: w NOT IN ({in_list(EXCLUDE)})), ' ') AS terms FROM documents
""")
def t20_tokenizer(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    terms = features.extract_terms(docs, "text", EXCLUDE, tokenizer=lambda texts: texts.str.split())
    return terms.select("doc_id", F.array_join("terms", " ").alias("terms"))
