"""The registered queries opN_<name>: one per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from quarry.plans.tables import table

from . import ann, codes, decontaminate, exact_dedup, lattice_lm, mixing, passages, pieces, runs, secrets, simhash, toxicity, warc

#: The vocabulary file of operators 9 and 10 (a parameter of both).
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_collision_hashing(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op4_sparse_suffixes(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op5_warc(spark, sf_dir):
    return warc.roundtrip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_pareto_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_simhash_groups(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op8_secrets(spark, sf_dir):
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op9_lattice_lm(spark, sf_dir):
    return lattice_lm.lm_scores(table(spark, sf_dir, "documents"), VOCABULARY)


def op10_sentencepiece(spark, sf_dir):
    return pieces.encode_decode(table(spark, sf_dir, "documents"), VOCABULARY)


def op11_periodic_runs(spark, sf_dir):
    return runs.periodic_runs(table(spark, sf_dir, "documents"), plant=True)


def op12_cover_tree_codes(spark, sf_dir):
    return codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_winnowing(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_exact_dedup, op3_collision_hashing, op4_sparse_suffixes, op5_warc, op6_pareto_mix, op7_simhash_groups, op8_secrets,
    op9_lattice_lm, op10_sentencepiece, op11_periodic_runs, op12_cover_tree_codes, op13_winnowing)}

ORACLES = {
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
             g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t""",
    "op5_warc": r"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
             d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
             l AS (SELECT payload_digest, max(page_id) AS last FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest HAVING count(*) > 1)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> last THEN last END AS refers_to
        FROM d LEFT JOIN l USING (payload_digest)""",
    "op6_pareto_mix": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
             s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
             w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS position FROM s),
             r AS (SELECT *, (CASE (position - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::DOUBLE AS weight,
                          (source_size * 2)::DOUBLE AS stop, stop / weight AS stops_at FROM w),
             l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                              - (sum(stop) OVER (ORDER BY stops_at, position ROWS UNBOUNDED PRECEDING) - stop))
                             / sum(weight) OVER (ORDER BY stops_at, position ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
             t AS (SELECT source, source_size, least(stop, coalesce(
                              (SELECT level FROM l WHERE level <= stops_at ORDER BY stops_at, position LIMIT 1) * weight, stop)) AS target FROM l),
             p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t),
             q AS (SELECT d.doc_id, d.size, p.source, p.source_size, p.target, floor(p.ratio)::BIGINT AS whole, p.ratio - floor(p.ratio) AS part,
                          p.target - floor(p.ratio) * p.source_size AS rest,
                          (('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || ':mix'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496::DOUBLE AS u
                   FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
             k AS (SELECT *, CASE WHEN part > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS odds FROM q),
             c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id, size) AS upto FROM k)
        SELECT doc_id, size, source_size, target,
               size * (whole + CASE WHEN part > 0 AND 2 * (upto - size) + size <= 2 * rest THEN 1 ELSE 0 END) AS taken FROM c""",
    "op12_cover_tree_codes": codes.oracle(),
    "op13_winnowing": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
             i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
             ip AS (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(0, greatest(len(w) - 9, 1))) AS p FROM i WHERE len(w) > 0),
             iw AS (SELECT DISTINCT item_id, size, array_to_string(w[p + 1:p + size], ' ') AS g FROM ip),
             dp AS (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS p
                    FROM d, (SELECT DISTINCT size FROM iw) WHERE len(w) >= size),
             dw AS (SELECT doc_id, size, p, array_to_string(w[p + 1:p + size], ' ') AS g FROM dp),
             m AS (SELECT doc_id, item_id, dw.size, p FROM dw JOIN iw ON dw.size = iw.size AND dw.g = iw.g),
             h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS x FROM m) GROUP BY doc_id),
             t AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
                   FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM m) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
}
