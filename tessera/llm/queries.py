"""The query of each training-data operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import conversations, decontam, embedding_dedup, html_extract, langid, licenses, packing, pii, quality, rollups, setsketch, spotsigs, whitening
from .common import fold, table, work_path, written

#: A document scored lower than this is taken for label 0.
QUALITY_CUT = 0.3


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels only from rows whose fold of 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    out = quality.scored(docs, model, carry=["doc_id"]).select("row.doc_id", "score")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


def _maintained(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Totals after a load, a revision, deletes, retries of them and compactions.

    Loaded are the counts of all documents; documents without a language are then revised to "und",
    and of documents of equal text all but one are deleted: the one of least id stays, one without an id
    last, then by source and language, absent ones last; of rows that are equal throughout one stays.
    counts has doc_id, hash of the text, and a rollup's columns.
    """
    rollup = rollups.TokenRollup(spark, work_path(spark, "rollup"))
    counts = written(counts, "counts")
    nameless = counts.filter("lang is null")
    named = counts.withColumn("lang", F.coalesce("lang", F.lit("und")))
    least = F.struct(*(x for c in ("doc_id", "source", "lang") for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))), "n_tokens", "n_chars")
    first = named.groupBy("hash", "tokenizer").agg(F.min(least).alias("c")).select("hash", "tokenizer", "c.*")
    rollup.commit("load", rollups.inserts(counts))
    rollup.commit("named", rollups.revisions(nameless, nameless.withColumn("lang", F.lit("und"))))
    rollup.compact()
    rollup.commit("load", rollups.inserts(counts))  # a retried job: committed already, nothing is added
    rollup.commit("copies", rollups.revisions(named, first, "hash"))
    rollup.compact()
    return rollup.totals()


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the hash of their text; a null text is an empty one."""
    return table(spark, sf_dir, "documents").withColumn("hash", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct documents, tokens and characters by source, language and tokenizer version."""
    return _maintained(spark, rollups.token_counts(_hashed(spark, sf_dir), rollups.TOKENIZERS, carry=("doc_id", "hash", "source", "lang")))


def op2_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rollup over plain words, which SQL can check."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = _hashed(spark, sf_dir).select("doc_id", "hash", "source", "lang", F.lit("words-1").alias("tokenizer"), packing.word_count(text).alias("n_tokens"), F.length(text).cast("long").alias("n_chars"))
    return _maintained(spark, counts)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spotsigs.edited_likeness(table(spark, sf_dir, "documents"), blocks=blocks)


def op4_similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of equal fingerprints, and how many other classes each is like."""
    return spotsigs.similar_documents(table(spark, sf_dir, "documents"))


def op5_license_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return licenses.license_spans(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    found = pii.find_spans(table(spark, sf_dir, "documents"), carry=["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("row.doc_id", *map(count, pii.KINDS), F.sha2(pii.span_text("base"), 256).alias("base_sha256"), pii.span_text("spans").alias("spans"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of the permitted lengths."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; labels only from rows whose fold of 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold(F.col("doc_id"), 4) != 2)
    out = langid.identify(docs, model, carry=["doc_id"]).select("row.doc_id", "lang_pred", "score")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.main_content(table(spark, sf_dir, "pages"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and least repair of every damaged conversation."""
    return conversations.faults_and_repair(table(spark, sf_dir, "conversations"))


def op12_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate component of every embedding."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first eight whitened components."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_token_counts": op2_token_counts,
    "op2_word_counts": op2_word_counts,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_fingerprints": op4_fingerprints,
    "op4_similar_documents": op4_similar_documents,
    "op5_license_spans": op5_license_spans,
    "op6_personal_data": op6_personal_data,
    "op7_packing": op7_packing,
    "op8_language": op8_language,
    "op9_decontamination": op9_decontamination,
    "op10_main_text": op10_main_text,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_near_duplicates": op12_embedding_near_duplicates,
    "op13_embedding_whitening": op13_embedding_whitening,
}

_ANCHORS = "[" + ", ".join(f"'{a}'" for a in spotsigs.ANCHORS) + "]"

#: From texts b (doc_id, k, body) to their sorted distinct signatures p (doc_id, k, q).
_PRINTS = rf"""
        low AS (SELECT *, translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower FROM b),
        sp AS (SELECT *, regexp_extract_all(lower, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a0 FROM low),
        wd AS (SELECT doc_id, k, body, CASE WHEN length(body) >= {spotsigs.UNSPACED} * greatest(len(a0), 1) THEN regexp_extract_all(lower, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]') ELSE a0 END AS a, {_ANCHORS} AS s FROM sp),
        ch AS (
            SELECT *, list_filter(list_transform(list_filter(range(1, len(a) + 1), lambda i: list_contains(s, a[i])),
                lambda i: a[i] || ':' || array_to_string(list_slice(list_filter(list_slice(a, i + 1, i + 8), lambda x: NOT list_contains(s, x)), 1, 2), ' ')), lambda g: contains(g, ' ')) AS g FROM wd),
        h AS (
            SELECT doc_id, k, body, CASE
                WHEN len(g) > 0 AND len(g) * {spotsigs.SPARSE} >= len(a) THEN g
                WHEN len(a) > 2 THEN list_transform(range(1, len(a) - 1), lambda i: a[i] || ':' || a[i + 1] || ' ' || a[i + 2])
                ELSE [body] END AS g FROM ch),
        p AS MATERIALIZED (SELECT doc_id, k, list_sort(list_distinct(list_transform(g, lambda x: md5(x)[1:8]))) AS q FROM h)
"""

ORACLE_SQL: dict[str, str] = {
    "op2_word_counts": r"""
        SELECT source, coalesce(lang, 'und') AS lang, 'words-1' AS tokenizer, count(*)::BIGINT AS n_docs,
               sum(len(regexp_extract_all(coalesce(text, ''), '\S+')))::BIGINT AS n_tokens, sum(length(coalesce(text, '')))::BIGINT AS n_chars
        FROM (FROM documents QUALIFY row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id NULLS LAST, source NULLS LAST, coalesce(lang, 'und')) = 1) GROUP BY ALL
    """,
    "op4_fingerprints": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
        e AS (SELECT *, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS nid FROM d WINDOW w AS (ORDER BY doc_id)),
        f AS (SELECT doc_id, nid, n, t, left(t, (n - n // 2)::BIGINT) || left(nt, (n // 2)::BIGINT) AS x FROM e),
        b AS (SELECT doc_id, 1 AS k, t AS body FROM f UNION ALL SELECT doc_id, 2, x FROM f), {_PRINTS}
        SELECT f.doc_id, f.n AS n_chars, sha256(f.x) AS edited_sha256, array_to_string(a.q, ' ') AS fingerprint, array_to_string(b.q, ' ') AS edited_fingerprint,
               len(list_intersect(a.q, b.q)) / (len(a.q) + len(b.q) - len(list_intersect(a.q, b.q)))::DOUBLE AS near_edited,
               len(list_intersect(a.q, c.q)) / (len(a.q) + len(c.q) - len(list_intersect(a.q, c.q)))::DOUBLE AS near_next
        FROM f JOIN p a ON a.doc_id = f.doc_id AND a.k = 1 JOIN p b ON b.doc_id = f.doc_id AND b.k = 2 JOIN p c ON c.doc_id = f.nid AND c.k = 1
    """,
    "op4_similar_documents": rf"""
        WITH b AS (SELECT doc_id, 1 AS k, coalesce(text, '') AS body FROM documents), {_PRINTS},
        c AS MATERIALIZED (SELECT min(doc_id) AS id, q, len(q) AS n FROM p GROUP BY q),
        s AS (SELECT id, n, unnest(q) AS g FROM c),
        j AS (SELECT x.id AS a, y.id AS b, x.n + y.n - count(*) AS n_either, count(*) AS n_both FROM s x JOIN s y ON x.g = y.g AND x.id <> y.id GROUP BY x.id, y.id, x.n, y.n),
        l AS (SELECT a, count(*) AS n FROM j WHERE 4 * n_both >= 3 * n_either GROUP BY a)
        SELECT p.doc_id, c.id AS class_id, coalesce(l.n, 0)::BIGINT AS n_links FROM p JOIN c ON c.q = p.q LEFT JOIN l ON l.a = c.id
    """,
    # distinct five-word shingles, pairs that share one, exact overlap, reachability
    "op3_near_duplicates": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(a, i, i + 4), ' ') AS g
            FROM (SELECT doc_id, a, unnest(generate_series(1, greatest(len(a) - 4, least(len(a), 1)))) AS i FROM w)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
        e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
        u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        r AS (SELECT doc_id AS f, doc_id AS t FROM documents UNION SELECT r.f, u.b FROM r JOIN u ON u.a = r.t),
        c AS (SELECT f, min(t) AS component_id FROM r GROUP BY 1)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
        FROM documents d JOIN c ON c.f = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
    """,
    "op9_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents),
        t AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(len(a), 10) AS k, array_to_string(list_slice(a, i, i + 9), ' ') AS g
            FROM (SELECT item_id, a, unnest(generate_series(1, greatest(len(a) - 9, least(len(a), 1)))) AS i FROM t)),
        pos AS (SELECT doc_id, a, unnest(generate_series(1, len(a))) AS i FROM d),
        occ AS (
            SELECT p.doc_id, p.i, w.k, w.item_id
            FROM pos p CROSS JOIN (SELECT DISTINCT k FROM win) l
            JOIN win w ON w.k = l.k AND len(p.a) >= p.i + l.k - 1 AND array_to_string(list_slice(p.a, p.i, p.i + l.k - 1), ' ') = w.g),
        hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM occ) GROUP BY 1),
        it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY 1)
        SELECT d.doc_id, len(d.a)::BIGINT AS n_words, coalesce(hit.n_hit, 0)::BIGINT AS n_hit, coalesce(it.n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(it.ids, '')) AS items_sha256, coalesce(hit.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
    """,
    # every pair of one label by exact cosine: SQL finds what a forest of full recall would
    "op12_embedding_near_duplicates": r"""
        WITH RECURSIVE v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
        u AS (
            SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
        r AS (SELECT vec_id AS f, vec_id AS t FROM embeddings UNION SELECT r.f, l.b FROM r JOIN l ON l.a = r.t),
        c AS (SELECT f, min(t) AS component_id FROM r GROUP BY f)
        SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept FROM v JOIN c ON c.f = v.vec_id LEFT JOIN n ON n.a = v.vec_id
    """,
}
