"""Registered queries of this folder: each operator over its whole table, with
production parameters.  Digest columns are derived here from the operators'
real outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlake.llm.common import table


def op1_pii(spark, sf_dir):
    from cohortlake.llm.pii import pseudonymize
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_simhash(spark, sf_dir):
    from cohortlake.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)


def op3_quality_classifier(spark, sf_dir):
    from cohortlake.llm.quality import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("copy")


def op4_suffix_dedup(spark, sf_dir):
    from cohortlake.llm.suffix_dedup import remove_repeated_bytes
    out = remove_repeated_bytes(table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op5_quotation_linking(spark, sf_dir):
    from cohortlake.llm.quotes import link_quotations
    return link_quotations(table(spark, sf_dir, "conversations"))


def op6_decontamination(spark, sf_dir):
    from cohortlake.llm.decontaminate import contamination
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op7_substring_dedup(spark, sf_dir):
    from cohortlake.llm.rlz import remove_repeated_passages
    out = remove_repeated_passages(table(spark, sf_dir, "documents"), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_license_scan(spark, sf_dir):
    from cohortlake.llm.licenses import scan
    return scan(table(spark, sf_dir, "documents")).drop("found")


def op9_quality_rules(spark, sf_dir):
    from cohortlake.llm.rules import apply_rules
    return (apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "rule"))


def op10_bpe(spark, sf_dir):
    import public_tokenizers

    from cohortlake.llm.bpe import encode, read_ranks
    out = encode(table(spark, sf_dir, "documents"),
                 read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_hard_negatives(spark, sf_dir):
    from cohortlake.llm.hard_negatives import mine
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0,
                positives=5, negatives=3, low=50, high=95, scale=256)


def op12_whitening(spark, sf_dir):
    from cohortlake.llm.whitening import whiten
    rows, model = whiten(table(spark, sf_dir, "embeddings"), components=16, scale=64, offset=1_000_000)
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    return (rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    "whitened", share[F.col("at")].alias("explained"),
                    F.lit(model.identity_error).cast("double").alias("identity_error")))


def op13_jaccard_join(spark, sf_dir):
    from cohortlake.llm.jaccard import similar_components
    return similar_components(table(spark, sf_dir, "documents"), gram=3, percent=90)


QUERIES = {f.__name__: f for f in (op1_pii, op2_simhash, op3_quality_classifier, op4_suffix_dedup,
                                     op5_quotation_linking, op6_decontamination, op7_substring_dedup,
                                     op8_license_scan, op9_quality_rules, op10_bpe, op11_hard_negatives,
                                     op12_whitening, op13_jaccard_join)}

#: DuckDB SQL of the queries that SQL can express.
ORACLE = {
    "op11_hard_negatives": """
        WITH rows_ AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
                   CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
            FROM rows_ a JOIN rows_ r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
        positive AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
               s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
         AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
        QUALIFY rank <= 3""",
    "op13_jaccard_join": r"""
        WITH RECURSIVE word AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                   END AS s
            FROM word),
        class AS (SELECT list_sort(s) AS s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
        token AS (SELECT rep, n, unnest(s) AS t FROM class),
        link AS (
            SELECT a.rep AS a, b.rep AS b FROM token a JOIN token b ON a.t = b.t AND a.rep < b.rep
            GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach AS (SELECT rep AS a, rep AS b FROM class UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
        component AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(p.component_id, d.doc_id) AS component_id
        FROM sets d LEFT JOIN class c ON list_sort(d.s) = c.s LEFT JOIN component p ON p.rep = c.rep""",
}
