"""Registered queries of the operators, and the DuckDB counterparts of those that SQL expresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.llm import (
    fingerprints, language, mixing, negatives, packing, pages, resampling, simhash_bits, suffixes, surrogates,
    token_files, toxicity, vectors,
)
from forgepulse.llm.support import crc_of_id, settle, table
from forgepulse.llm.tokens import public_tokenizer


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.token_pieces(docs, public_tokenizer()))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id("doc_id") % 3 == 1
    network = language.learn(docs.where(~held_out))
    return language.identify(docs, network).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = settle(docs.select("doc_id", "source", mixing.word_count("text").alias("size")), "sizes")
    mixed = mixing.in_training_order(mixing.mix(sized, "size", "source", mixing.id_key()))
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.size").alias("size"),
        "source_size", "target", "taken",
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizer())


def op6_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bits.near_duplicates(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.with_surrogates(docs, surrogates.session_key(spark)).select("row.doc_id", "row.text", "n_entities")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = toxicity.learn(docs, labels.where(crc_of_id("doc_id") % 5 != 0))
    scored = toxicity.score(docs.select("doc_id", "text"), index)
    return scored.select(
        "row.doc_id", (crc_of_id("row.doc_id") % 5 == 0).alias("held_out"), "score",
        toxicity.predicted().alias("predicted"), "evidence",
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine(negatives.as_integers(rows), F.col("vec_id") % 50 == 0)


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


QUERIES = {
    name: function for name, function in list(globals().items()) if name.startswith("op")
}

ORACLE = {
    "op4_mixing": r"""
        WITH sized AS (
            SELECT doc_id, coalesce('=' || source, '~') AS k,
                md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o,
                CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
            FROM documents),
        per_source AS (
            SELECT k, CAST(sum(size) AS BIGINT) AS source_size,
                [5, 2, 1][(row_number() OVER (ORDER BY k) - 1) % 3 + 1] AS w
            FROM sized GROUP BY k),
        need AS (
            SELECT *, row_number() OVER s AS place,
                CAST((SELECT sum(source_size) FROM per_source) AS BIGINT)
                    - CAST(coalesce(sum(3 * source_size) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
                CAST(sum(w) OVER (s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS ws
            FROM per_source WINDOW s AS (ORDER BY source_size / w, k)),
        first_free AS (
            SELECT place AS p, rest AS r, ws AS s FROM need
            WHERE 3 * source_size * ws > w * rest ORDER BY place LIMIT 1),
        target AS (
            SELECT k, source_size,
                CASE WHEN place >= p THEN CAST(w * r AS DOUBLE) / s ELSE CAST(3 * source_size AS DOUBLE) END AS target
            FROM need LEFT JOIN first_free ON true),
        laid AS (
            SELECT doc_id, size, k, coalesce(sum(size) OVER (PARTITION BY k ORDER BY o, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
            FROM sized)
        SELECT doc_id, size, source_size, target, CAST(
            greatest(0, least(size, floor(least(target, 3 * source_size)) - b))
            + greatest(0, least(size, floor(least(target, 3 * source_size)) - b - source_size))
            + greatest(0, least(size, floor(least(target, 3 * source_size)) - b - 2 * source_size)) AS BIGINT) AS taken
        FROM laid JOIN target USING (k)
    """,
    # crc32 by its table: 256 steps of the rule, then one step a byte of each distinct word.
    "op11_importance_resampling": r"""
        WITH crc_table AS (
            SELECT list(list_reduce(list_prepend(b, range(8)),
                lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crc
            FROM range(256) r(b)),
        found AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents),
        wanted AS (
            SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM benchmark),
        word_of AS (SELECT doc_id, unnest(words) AS word FROM found),
        own AS (SELECT word, count(*) AS s FROM word_of GROUP BY word),
        other AS (SELECT word, count(*) AS t FROM wanted GROUP BY word),
        word_counts AS (SELECT word, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM own FULL JOIN other USING (word)),
        hashed AS (
            SELECT word, s, t, xor(list_reduce(
                list_prepend(4294967295, list_transform(range(1, length(hex(word)) + 1, 2),
                    lambda i: ('0x' || substr(hex(word), i, 2))::BIGINT)),
                lambda c, b: xor(c >> 8, tab.crc[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
            FROM word_counts, crc_table tab),
        bucket_sum AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket),
        total AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM hashed),
        gain AS (
            SELECT bucket, CAST(floor(1000 * ln(
                CAST(b.t + 1 AS DOUBLE) * CAST(a.s + 10000 AS DOUBLE)
                / (CAST(b.s + 1 AS DOUBLE) * CAST(a.t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
            FROM bucket_sum b, total a),
        weighed AS (
            SELECT doc_id, count(*) AS n, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS w
            FROM word_of JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(w, 0) AS weight,
                coalesce(w, 0) + CAST(floor(-1000 * ln(-ln(
                    (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM found LEFT JOIN weighed USING (doc_id)),
        able AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
            FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score,
            CASE WHEN place <= 10 * n // 100 THEN place END AS rank
        FROM scored LEFT JOIN able USING (doc_id)
    """,
    "op12_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same,
                CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
        positive AS (
            SELECT * FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
        SELECT p.anchor AS anchor_id, p.other AS positive_id,
            CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
            n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positive p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
            AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        QUALIFY rank <= 3
    """,
}
