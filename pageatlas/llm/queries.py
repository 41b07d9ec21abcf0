"""Queries of the operators for training data of language models, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageatlas.llm import boilerplate, clusters, mixing, packing, pii, quality, terms, tokens
from pageatlas.llm import vectors as vec
from pageatlas.session import durable, table


def p2_found(spark, sf_dir):
    return terms.term_weights(table(spark, sf_dir, "focuses"), min_records=2, max_records=5).select("focus_id", "term")


def p2_weights(spark, sf_dir):
    w = terms.term_weights(table(spark, sf_dir, "focuses"))
    return w.select("focus_id", "term", "tf", "records", F.round("weight", 6).alias("weight"))


def p3_found(spark, sf_dir):
    return boilerplate.furniture_lines(table(spark, sf_dir, "versions"))


def p5_found(spark, sf_dir):
    near = vec.most_similar(vec.usable_vectors(table(spark, sf_dir, "focus_vectors")))
    return near.select(
        F.least("id", "neighbour").alias("id_a"), F.greatest("id", "neighbour").alias("id_b")
    ).distinct()


def p5_recall(spark, sf_dir):
    return vec.recall(vec.usable_vectors(table(spark, sf_dir, "focus_vectors")))


def p6_found(spark, sf_dir):
    return pii.personal_information(*(table(spark, sf_dir, t) for t in ("versions", "extractions", "people")))


def _clustered(spark, sf_dir):
    return clusters.similarity_clusters(vec.usable_vectors(table(spark, sf_dir, "focus_vectors")))


def p7_found(spark, sf_dir):
    member = _clustered(spark, sf_dir).select("id", "cluster")
    pairs = table(spark, sf_dir, "focus_pairs").select("id_a", "id_b").distinct()
    a = member.select(F.col("id").alias("id_a"), F.col("cluster").alias("cluster_a"))
    b = member.select(F.col("id").alias("id_b"), F.col("cluster").alias("cluster_b"))
    return pairs.join(a, "id_a").join(b, "id_b").where("cluster_a = cluster_b").select("id_a", "id_b")


def p7_clusters(spark, sf_dir):
    return clusters.cluster_report(_clustered(spark, sf_dir), table(spark, sf_dir, "focuses"))


def p7_recall(spark, sf_dir):
    return vec.recall(vec.usable_vectors(table(spark, sf_dir, "focus_vectors")), k=10, target_recall=0.95)


def p3_main_text(spark, sf_dir):
    return boilerplate.main_text(table(spark, sf_dir, "versions"))


def p6_redacted(spark, sf_dir):
    versions = table(spark, sf_dir, "versions").select("version_id", "text_md").distinct()
    versions, given = pii.with_given(versions, "text_md", durable(pii.given_names(table(spark, sf_dir, "people"))))
    return versions.select("version_id", pii.redacted(F.col("text_md"), given).alias("text_md"))


def _sized(spark, sf_dir):
    return durable(tokens.sized_documents(table(spark, sf_dir, "documents")))


def p8_pack(spark, sf_dir):
    return packing.pack(_sized(spark, sf_dir), table(spark, sf_dir, "pack_capacities"))


def p8_report(spark, sf_dir):
    capacities = table(spark, sf_dir, "pack_capacities")
    return packing.pack_report(packing.pack(_sized(spark, sf_dir), capacities), capacities)


def p9_mix(spark, sf_dir):
    return mixing.mix_sources(_sized(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark, sf_dir):
    sized, targets = _sized(spark, sf_dir), table(spark, sf_dir, "mix_targets")
    budgets = durable(mixing.source_budgets(sized, targets))
    return mixing.mix_report(mixing.mix_sources(sized, targets, budgets=budgets), budgets)


def p10_found(spark, sf_dir):
    kinds = quality.classified_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))
    return kinds.where("kind <> 'prose'").select("doc_id")


def p10_statistics(spark, sf_dir):
    return quality.quality_statistics(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))


QUERIES = {
    "p2_found": p2_found,
    "p2_weights": p2_weights,
    "p3_found": p3_found,
    "p5_found": p5_found,
    "p5_recall": p5_recall,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p7_clusters": p7_clusters,
    "p7_recall": p7_recall,
    "p3_main_text": p3_main_text,
    "p6_redacted": p6_redacted,
    "p8_pack": p8_pack,
    "p8_report": p8_report,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_statistics": p10_statistics,
}
_TERMS = r"""
WITH rows AS (SELECT DISTINCT focus_id, summary, tags FROM focuses WHERE focus_id IS NOT NULL),
tag_terms AS (
  SELECT focus_id, trim(regexp_replace(nfc_normalize(lower(nfc_normalize(t))), '[\s\p{Z}_‐‑-]+', ' ', 'g')) AS term
  FROM (SELECT focus_id, unnest(tags) AS t FROM rows) WHERE t IS NOT NULL),
words AS (
  SELECT focus_id, unnest(regexp_extract_all(nfc_normalize(lower(nfc_normalize(summary))), '\p{L}{4,}')) AS term FROM rows),
counts AS (
  SELECT focus_id, term, count(*) AS tf FROM (SELECT * FROM tag_terms WHERE term <> '' UNION ALL SELECT * FROM words)
  GROUP BY focus_id, term),
stats AS (
  SELECT term, count(*) AS records,
         1 - (ln(sum(tf)) - sum(tf * ln(tf)) / sum(tf)) / ln(greatest((SELECT count(DISTINCT focus_id) FROM rows), 2)) AS g
  FROM counts GROUP BY term)
"""
ORACLES: dict[str, str] = {
    "p2_found": _TERMS + "SELECT focus_id, term FROM counts JOIN stats USING (term) WHERE records BETWEEN 2 AND 5",
    "p2_weights": _TERMS
    + "SELECT focus_id, term, tf, records, round(ln(1 + tf) * g, 6) AS weight FROM counts JOIN stats USING (term)",
    "p10_statistics": r"""
WITH words AS (SELECT list(DISTINCT lower(word)) AS cw FROM common_words WHERE word IS NOT NULL),
docs AS (SELECT doc_id, min(text) AS text FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id),
parts AS (
  SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{L}\p{M}]+') AS w,
         list_filter(regexp_split_to_array(text, '\r\n|[\n\r]'), lambda x: length(trim(x)) > 0) AS l
  FROM docs WHERE text IS NOT NULL)
SELECT d.doc_id, len(w)::BIGINT AS n_words,
  CASE WHEN text IS NULL OR d.text IS NULL THEN NULL WHEN len(w) = 0 THEN 0.0
       ELSE round(list_sum(list_transform(w, lambda x: length(x))) / len(w), 6) END AS mean_word_length,
  CASE WHEN d.text IS NULL THEN NULL WHEN length(d.text) = 0 THEN 0.0
       ELSE round(length(regexp_replace(d.text, '[\p{L}\p{M}\p{N}\s]', '', 'g')) / length(d.text), 6) END AS symbol_ratio,
  CASE WHEN d.text IS NULL THEN NULL WHEN len(l) = 0 THEN 0.0
       ELSE round(len(list_filter(l, lambda x: regexp_matches(rtrim(x), '[.!?…:]$'))) / len(l), 6) END AS punctuated_lines,
  CASE WHEN d.text IS NULL THEN NULL WHEN len(w) = 0 THEN 0.0
       ELSE round(len(list_filter(w, lambda x: list_contains(cw, x))) / len(w), 6) END AS common_share
FROM docs d CROSS JOIN words LEFT JOIN (SELECT doc_id, w, l FROM parts) p USING (doc_id)
""".replace("text IS NULL OR d.text", "d.text"),
}
