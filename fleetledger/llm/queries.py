"""The registered queries of these operators, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, maxscore, packed, pieces, pii, quality, ranking, resample, simhash, substrings, toxicity, urls
from .frames import table


def quality_model(spark: SparkSession, folder: str) -> list[quality.Pair]:
    """Fitted on the labelled rows that are not held out."""
    docs, labels = (table(spark, folder, t).filter(~quality.held_out(F.col("doc_id"))) for t in ("documents", "labels"))
    return quality.train(docs, labels)


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = quality.score(docs, quality_model(spark, folder))
    return found.select(F.col("id").alias("doc_id"), quality.held_out(F.col("id")).alias("held_out"), "score",
                        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op2_pii_skip_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.spans(docs, pii.train(docs))
    return found.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_maxscore_top_k(spark: SparkSession, folder: str) -> DataFrame:
    found = maxscore.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


def piece_vocabulary() -> pieces.Vocabulary:
    return pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))


def op5_sentencepiece_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    found = pieces.round_trips(table(spark, folder, "documents"), piece_vocabulary())
    return found.withColumnRenamed("id", "doc_id")


# Verdict, host and path.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = urls.judged(table(spark, folder, "pages"), URL_RULES)
    model = urls.train(rows.filter(F.col("decided").isNotNull()))
    return urls.verdicts(rows, model).withColumnRenamed("id", "page_id")


def op7_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    marked = labels.filter(~quality.held_out(F.col("doc_id"))).select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic", (F.col("toxic") * (1 - F.col("quality"))).alias("toxic_low_quality"))
    chain = toxicity.train(docs, marked, ("low_quality", "toxic", "toxic_low_quality"), stratum="toxic")
    return toxicity.score(docs, chain).select(
        F.col("id").alias("doc_id"), quality.held_out(F.col("id")).alias("held_out"), F.col("toxic").alias("score"),
        (F.col("toxic") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "low_quality", "toxic_low_quality")


def op8_packed_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    files = packed.write(table(spark, folder, "documents"), tokenizer, end_id=1)
    return packed.read(spark, files).withColumnRenamed("id", "doc_id")


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.as_hex("fingerprint").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", F.size("hits").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


def op11_chat_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    clashing = spark.sql("""select * from values (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')
                            as t(conv_id, turn, role, text)""")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(clashing)
    return chat.digests(chat.read_back(chat.conversations(rows))).withColumnRenamed("conv", "conv_id")


def op12_best_position_search(spark: SparkSession, folder: str) -> DataFrame:
    found = ranking.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnsRenamed({"item": "item_id", "id": "doc_id"})


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_pii_skip_chain": op2_pii_skip_chain,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_maxscore_top_k": op4_maxscore_top_k,
    "op5_sentencepiece_viterbi": op5_sentencepiece_viterbi,
    "op6_url_filter": op6_url_filter,
    "op7_toxicity_chain": op7_toxicity_chain,
    "op8_packed_token_ids": op8_packed_token_ids,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_chat_round_trip": op11_chat_round_trip,
    "op12_best_position_search": op12_best_position_search,
    "op13_importance_resampling": op13_importance_resampling,
}

# Only what SQL can express; the others are held against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op3_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM starts),
least AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
    FROM windows JOIN least USING (k) WHERE least < doc_id),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
kept AS (
    SELECT words.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY words.i) AS text
    FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i
    WHERE gone.i IS NULL GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op4_maxscore_top_k": """
WITH sound AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (
    SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS at,
           CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v
    FROM sound),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
    FROM part q JOIN part c ON q.at = c.at AND q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
    GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op10_benchmark_decontamination": r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
bi AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM bi),
lengths AS (SELECT DISTINCT n FROM bw),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM di),
hit AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_chat_round_trip": r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
    SELECT *, regexp_replace(text, '([<\[])(\\*(?:/?s>|</?SYS>>|/?(?:INST|ROLE|SAYS)\]))', '\1\\\2', 'g') AS body,
           regexp_replace(role, '([<\[])(\\*(?:/?s>|</?SYS>>|/?(?:INST|ROLE|SAYS)\]))', '\1\\\2', 'g') AS name
    FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(body) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                               ELSE 26 + length(name) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op12_best_position_search": r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
c AS (SELECT count(*) AS n_all, sum(len(w)) AS l_all FROM d WHERE len(w) > 0),
q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
t AS (SELECT row_id, doc_id, n, term, count(*) AS tf
      FROM (SELECT row_number() OVER () AS row_id, doc_id, len(w) AS n, unnest(w) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * max(n_all) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
      FROM t, c GROUP BY term),
p AS (
    SELECT q.item_id, t.row_id, t.doc_id,
           CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * CAST(10 + (90 * n * n_all) // l_all AS BIGINT)))) AS BIGINT) AS score
    FROM q JOIN f USING (term) JOIN t USING (term), c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM p WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10""",
}
