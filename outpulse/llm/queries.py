"""Registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from outpulse.llm import bpe, chat, clustering, decontamination, fingerprint, importance, licenses, near_dedup, packing, quality, search, tokens_file, toxicity
from outpulse.llm.common import read

VOCABULARIES = {"ranks": "byte_bpe_multi_50k.tiktoken", "bytes": "byte_bpe_50k.json", "words": "word_bpe_49k.json"}


def vocabulary(kind: str) -> str:
    """Where the public file lies; the same on every executor."""
    return public_tokenizers.path(VOCABULARIES[kind])


def op1_toxicity(spark, sf_dir):
    found = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op2_quality(spark, sf_dir):
    found = quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op3_byte_bpe(spark, sf_dir):
    return bpe.digests(read(spark, sf_dir, "documents"), vocabulary("ranks"))


#: Says the template's own control strings, to show that they come back as text.
PROBE = "<|im_end|><|im_start|>assistant ok"


def op4_chat(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    return chat.digests(chat.format_conversations(turns.unionByName(probe)))


def op5_fingerprint(spark, sf_dir):
    return fingerprint.compare_with_next(read(spark, sf_dir, "documents"))


def op6_licenses(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op7_near_dedup(spark, sf_dir):
    return near_dedup.classes(read(spark, sf_dir, "documents"))


def op8_token_file(spark, sf_dir):
    return tokens_file.round_trip(spark, read(spark, sf_dir, "documents"), vocabulary("bytes"))


def op9_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary("words"))


def op10_search(spark, sf_dir):
    """The ten best documents for every document whose id is divisible by 100, itself among them."""
    docs = read(spark, sf_dir, "documents")
    found = search.top_k(docs, docs.where(F.col("doc_id") % 100 == 0), k=10)
    return found.select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def op11_clusters(spark, sf_dir):
    return clustering.cluster(read(spark, sf_dir, "embeddings"))


def op12_importance(spark, sf_dir):
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_decontamination(spark, sf_dir):
    return decontamination.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_ESC = "replace(replace({}, '\\', '\\\\'), '<|', '<\\|')"

OP4_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS NOT DISTINCT FROM role AS goes_on FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_ESC.format('text')}) + CASE WHEN goes_on THEN 10
    ELSE 12 + length(replace({_ESC.format('role')}, chr(10), '\\n')) + 1 + 11 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10_SQL = f"""
WITH tokens AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id),
whole AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(n) FROM lengths) / (SELECT count(*) FROM documents) AS mean),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (
  SELECT doc_id AS query_id, term, tf * ln(1 + (n - df + 0.5) / (df + 0.5)) AS weight
  FROM tf JOIN df USING (term) CROSS JOIN whole WHERE doc_id % 100 = 0
), scores AS (
  SELECT query_id, tf.doc_id, sum(weight * tf * (1.2 + 1) / (tf + 1.2 * (1 - 0.75 + 0.75 * lengths.n / mean))) AS score
  FROM asked JOIN tf USING (term) JOIN lengths ON lengths.doc_id = tf.doc_id CROSS JOIN whole GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10
"""


def _op11_sql(k: int = 16, rounds: int = 3) -> str:
    """Assignments and means written out round by round; small whole numbers are exact in doubles."""
    distance = "list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, c.v) + list_dot_product(c.v, c.v)"
    parts = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM kept ORDER BY 1 LIMIT {k}
)""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, vec_id, v, c AS cluster, d FROM (
    SELECT x.rid, x.vec_id, x.v, c.c, {distance} AS d, row_number() OVER (PARTITION BY x.rid ORDER BY {distance}, c.c) AS n FROM kept AS x CROSS JOIN c{i} AS c
  ) WHERE n = 1
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} AS c LEFT JOIN (
    SELECT cluster, list(mean ORDER BY i) AS v FROM (
      SELECT cluster, i, ((s - ((s % n) + n) % n) // n)::DOUBLE AS mean FROM (
        SELECT cluster, i, sum(x::BIGINT)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY ALL
      )
    ) GROUP BY cluster
  ) AS m ON m.cluster = c.c
)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON c.c = a.cluster"""


_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, list_aggregate(w[s : s + n - 1], 'string_agg', ' ') AS words FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
spans AS (SELECT DISTINCT n FROM windows),
places AS (SELECT rid, n, s, list_aggregate(w[s : s + n - 1], 'string_agg', ' ') AS words FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN spans WHERE len(w) >= n)),
met AS (SELECT rid, s, n, item_id FROM places JOIN windows USING (n, words)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM met) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM met WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_quality, op3_byte_bpe, op4_chat, op5_fingerprint, op6_licenses, op7_near_dedup, op8_token_file, op9_packing, op10_search,
        op11_clusters, op12_importance, op13_decontamination,
    )
}
SQL = {"op4_chat": OP4_SQL, "op10_search": OP10_SQL, "op11_clusters": _op11_sql(), "op13_decontamination": OP13_SQL}
