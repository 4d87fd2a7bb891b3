"""The registered queries of the operators, beside SQL for the same rows where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.conversations import damaged, digest, repair_conversations
from millrace.llm.decontaminate import benchmark_hits
from millrace.llm.line_dedup import drop_repeated_lines
from millrace.llm.mixing import mix_sources
from millrace.llm.ngram_join import jaccard_join
from millrace.llm.pii import KINDS, personal_data, span_text
from millrace.llm.quality import classify_quality
from millrace.llm.secrets import KINDS as SECRET_KINDS
from millrace.llm.secrets import scan_secrets, secret_text
from millrace.llm.sharding import shard_documents
from millrace.llm.substring_dedup import drop_repeated_windows
from millrace.llm.toxicity import score_toxicity
from millrace.llm.vectors import near_vectors
from millrace.llm.whitening import whiten_embeddings


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = jaccard_join(_table(spark, sf_dir, "documents"), k=4, num=85, den=100, with_links=False)
    return members.select(F.col("rid").alias("doc_id"), "n_shingles", "component_id")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select(F.col("rid").alias("doc_id"), "n_lines", "n_dropped",
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mix_sources(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("rid").alias("doc_id"), "size", "source_size", "target", "taken")


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("vid").alias("vec_id"), "n_links", "component_id",
                        (F.col("vid") == F.col("component_id")).alias("kept"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select(F.col("rid").alias("doc_id"), "held_out", "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.select(
        F.col("rid").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select(F.col("rid").alias("doc_id"), "host_rate", "path_rate", "score", "good")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_windows(_table(spark, sf_dir, "documents"))
    return kept.select(F.col("rid").alias("doc_id"), "n_words", "n_removed",
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{kind}')) AS LONG)").alias(f"n_{kind}") for kind in KINDS]
    return found.select(F.col("rid").alias("doc_id"), *counts,
                        F.sha2(span_text("base").cast("binary"), 256).alias("base_sha256"), span_text("spans").alias("spans"))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(_table(spark, sf_dir, "documents"))
    return placed.select(F.col("rid").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, report = repair_conversations(damaged(_table(spark, sf_dir, "conversations")), copies_col="copies")
    told = digest(turns).withColumnRenamed("conv_id", "told_id")
    found = report.join(told, F.col("conv_id").eqNullSafe(F.col("told_id")), "left")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    # As SQL: a lambda's second parameter, default or not, would be the place in the array.
    counts = [F.expr(f"size(filter(base, b -> b.kind = {k}))").cast("long").alias(f"n_{kind}")
              for k, kind in enumerate(SECRET_KINDS[:3])]
    return found.select(F.col("rid").alias("doc_id"), *counts, F.sha2(secret_text("base").cast("binary"), 256).alias("base_sha256"),
                        secret_text("spans").alias("spans"))


def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten_embeddings(_table(spark, sf_dir, "embeddings"), components=4)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "value")
    found = found.select("vid", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error", each)
    return found.select(F.col("vid").alias("vec_id"), (F.col("place") + 1).alias("component"), "n", "deviation",
                        F.col("value.whitened").alias("whitened"), F.col("value.explained").alias("explained"), "identity_error")


QUERIES = {
    "op1_ngram_join": ngram_join,
    "op2_line_dedup": line_dedup,
    "op3_mixing": mixing,
    "op4_embedding_dedup": embedding_dedup,
    "op5_toxicity": toxicity,
    "op6_decontamination": decontamination,
    "op7_quality": quality,
    "op8_substring_dedup": substring_dedup,
    "op9_pii": pii,
    "op10_sharding": sharding,
    "op11_conversation_repair": conversation_repair,
    "op12_secrets": secrets,
    "op13_whitening": whitening,
}

ORACLES = {
    "op1_ngram_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, list_distinct(
                CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
            FROM words),
        grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
                   FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        links AS (SELECT a, b FROM shared WHERE 100 * common >= 85 * (n + m - common)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id, doc_id AS other FROM documents
                  UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.other = edges.a)
        SELECT doc_id, len(s) AS n_shingles, component_id
        FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)""",
    "op2_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        marked AS (
            SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM keyed)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op4_embedding_dedup": """
        WITH RECURSIVE units AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b
                  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
        reach AS (SELECT vec_id, vec_id AS other FROM units
                  UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) LEFT JOIN counts USING (vec_id)""",
    "op6_decontamination": r"""
        WITH doc_words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        item_words AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        windows AS (
            SELECT item_id, w[i:i + least(13, len(w)) - 1] AS win
            FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM item_words WHERE len(w) > 0)),
        lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
        spots AS (
            SELECT doc_id, i, n, w[i:i + n - 1] AS win
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM doc_words, lengths WHERE len(w) >= n)),
        hits AS (SELECT doc_id, item_id, i, n FROM spots JOIN windows USING (win)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(list, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM doc_words LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op8_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        spots AS (
            SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS win
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
        later AS (SELECT doc_id, i FROM spots QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
        placed AS (SELECT doc_id, w, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM words),
        kept AS (SELECT doc_id, count(*) - count(gone.p) AS n, string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS t
                 FROM placed LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)""",
    "op11_conversation_repair": r"""
        WITH RECURSIVE given AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(4294967295, list_reduce(list_transform(range(1, length(k) + 1), lambda i: ord(substr(k, i, 1))::BIGINT),
                       lambda c, b: list_reduce(range(8), lambda x, j: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384)
                                                ELSE x >> 1 END, xor(c, b)), 4294967295)) % 20 AS rule
            FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations)),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN rule = 4 THEN 'user' ELSE role END AS role,
                   CASE rule WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE WHEN rule = 3 THEN 2 ELSE 1 END)) AS copy
            FROM given WHERE rule <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, line, copy) AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, line, copy) AS copies,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
            FROM (SELECT *, md5(length(role) || ':' || role || text) AS line FROM damaged)),
        faults AS (
            SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN copies > 1 THEN 'duplicate'
                           WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
                   substr(role, 1, 1) AS c, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM placed),
        inserts(s, word, mid, cost, added) AS (
            SELECT s, '', s, 0, CAST([] AS VARCHAR[]) FROM range(4) t(s)
            UNION ALL SELECT s, 'I', CASE s WHEN 2 THEN 3 ELSE 2 END, 2, [CASE s WHEN 2 THEN 'assistant:' ELSE 'user:' END]
            FROM range(4) t(s)
            UNION ALL SELECT s, 'II', CASE s WHEN 2 THEN 2 ELSE 3 END, 4,
                             CASE s WHEN 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END FROM range(4) t(s)),
        letters(c, mid, letter, too, paid, name) AS (
            SELECT CAST(NULL AS VARCHAR), mid, 'D', mid, 3, CAST(NULL AS VARCHAR) FROM range(4) t(mid)
            UNION ALL SELECT NULL, mid, 'R', CASE mid WHEN 2 THEN 3 ELSE 2 END, 2, CASE mid WHEN 2 THEN 'assistant' ELSE 'user' END
            FROM range(4) t(mid)
            UNION ALL VALUES ('s', 0, 'K', 1, 0, NULL), ('u', 0, 'K', 2, 0, NULL), ('u', 1, 'K', 2, 0, NULL),
                             ('u', 3, 'K', 2, 0, NULL), ('a', 2, 'K', 3, 0, NULL)),
        paths AS (
            SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS s, CAST(0 AS BIGINT) AS cost, '' AS audit,
                   CAST([] AS VARCHAR[]) AS lines FROM conversations
            UNION ALL
            SELECT conv_id, i, too, min({'cost': cost, 'audit': audit}).cost, min({'cost': cost, 'audit': audit}).audit,
                   arg_min(lines, {'cost': cost, 'audit': audit})
            FROM (SELECT p.conv_id, f.i, CAST(l.too AS BIGINT) AS too,
                         CAST(p.cost + n.cost + l.paid + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END AS BIGINT) AS cost,
                         p.audit || n.word || l.letter AS audit,
                         list_concat(p.lines, n.added, CASE letter WHEN 'D' THEN CAST([] AS VARCHAR[])
                                     ELSE [coalesce(l.name, f.role) || ':' || f.text] END) AS lines
                  FROM paths p JOIN faults f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1
                  JOIN inserts n ON n.s = p.s
                  JOIN letters l ON l.mid = n.mid AND (l.c IS NULL OR l.c = f.c)
                                 AND (l.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate')))
            GROUP BY conv_id, i, too),
        ends AS (
            SELECT conv_id, min({'cost': p.cost + n.cost, 'audit': audit || word}) AS best,
                   arg_min(array_to_string(list_concat(lines, added), chr(10)), {'cost': p.cost + n.cost, 'audit': audit || word}) AS text
            FROM (SELECT *, max(i) OVER (PARTITION BY conv_id) AS last FROM paths) p JOIN inserts n ON n.s = p.s
            WHERE i = last AND (n.mid = 3 OR (n.mid = 0 AND n.word = '')) GROUP BY conv_id),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faults GROUP BY conv_id)
        SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
               sha256(text) AS repaired_sha256
        FROM ends LEFT JOIN counts ON ends.conv_id IS NOT DISTINCT FROM counts.conv_id""",
}
