"""Registered queries of the operators, over the whole tables."""

from __future__ import annotations

from typing import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann_tree import search
from .bpe_fst import encode_documents
from .common import pick, table
from .fingerprints import edited_fingerprints
from .gear_chunks import dedup_substrings
from .hard_negatives import mine
from .kneser_ney import classify
from .line_windows import dedup_lines
from .log_bilinear import score_documents
from .order_minhash import near_duplicates
from .repair_files import round_trip
from .sos_packing import pack_documents
from .surrogates import replace_entities
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_ann_tree(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark, sf_dir):
    return pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), " ?" in public_tokenizers.PATTERN
    )


def op3_order_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark, sf_dir):
    return encode_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op5_fingerprints(spark, sf_dir):
    return edited_fingerprints(table(spark, sf_dir, "documents"))


#: For tests and checks; a real run takes its own.
SURROGATE_KEY = b"a key for trial runs"


def op6_surrogates(spark, sf_dir):
    found = replace_entities(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return found.select("doc_id", "text", "n_chars", "kinds")


def op7_line_windows(spark, sf_dir):
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_removed")


def op8_kneser_ney(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_gear_chunks(spark, sf_dir):
    return dedup_substrings(table(spark, sf_dir, "documents"))


def op10_log_bilinear(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))


def op11_repair_files(spark, sf_dir):
    return round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), " ?" in public_tokenizers.PATTERN
    )


def op12_hard_negatives(spark, sf_dir):
    v = pick(table(spark, sf_dir, "embeddings"), {"vec_id": "long", "label": "long", "embedding": "array<double>"})
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(v.withColumn("label", changed))


def op13_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))


LLM_QUERIES: dict[str, Query] = {
    "op1_ann_tree": op1_ann_tree,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_order_minhash": op3_order_minhash,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_fingerprints": op5_fingerprints,
    "op6_surrogates": op6_surrogates,
    "op7_line_windows": op7_line_windows,
    "op8_kneser_ney": op8_kneser_ney,
    "op9_gear_chunks": op9_gear_chunks,
    "op10_log_bilinear": op10_log_bilinear,
    "op11_repair_files": op11_repair_files,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}

LLM_ORACLE_SQL: dict[str, str] = {
    "op7_line_windows": """
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
windows AS (
    SELECT doc_id, i, lines[i] || chr(10) || lines[i + 1] || chr(10) || lines[i + 2] AS body
    FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines) - 2)) AS i FROM split) t
),
repeats AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS nth FROM windows
    ) t WHERE nth > 1
),
covered AS (
    SELECT DISTINCT doc_id, i + k AS j FROM repeats CROSS JOIN (VALUES (0), (1), (2)) AS v(k)
),
every AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS j FROM split
)
SELECT e.doc_id,
       coalesce(string_agg(e.line, chr(10) ORDER BY e.j) FILTER (WHERE c.j IS NULL), '') AS text,
       count(*) AS n_lines,
       count(c.j) AS n_removed
FROM every e LEFT JOIN covered c ON c.doc_id = e.doc_id AND c.j = e.j
GROUP BY e.doc_id""",
    "op12_hard_negatives": """
WITH vectors AS (
    SELECT DISTINCT vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS alike,
           list_inner_product(a.x, v.x)::BIGINT AS score
    FROM vectors a JOIN vectors v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5""",
}
