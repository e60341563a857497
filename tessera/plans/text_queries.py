"""Queries on text, addresses, nested values and ordered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tessera.functions import text as tx

from .base import Catalogue, table

CATALOGUE = Catalogue()
add = CATALOGUE.add


@add("""
    SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS user_turn FROM conversations
""")
def forward_fill_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last user turn carried forward."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(w).alias("user_turn"))


@add("""
    SELECT doc_id, i - 1 AS pos, length(l)::BIGINT AS n, left(l, 12) AS head FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL)
""")
def split_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each text with their place."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "l"))
    return lines.select("doc_id", F.col("p").cast("long").alias("pos"), F.length("l").cast("long").alias("n"), F.substring("l", 1, 12).alias("head"))


@add("SELECT sha256(text) AS hash, count(*)::BIGINT AS n, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1")
def hash_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that stand more than once."""
    return table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("hash")).agg(F.count("*").cast("long").alias("n"), F.min("doc_id").alias("first")).filter("n > 1")


@add("SELECT page_id, len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))::BIGINT AS n, array_to_string(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), '|') AS targets FROM pages")
def regex_extract_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All link targets of a page in order."""
    found = table(spark, sf_dir, "pages").select("page_id", tx.hrefs(F.col("html")).alias("h"))
    return found.select("page_id", F.size("h").cast("long").alias("n"), F.array_join("h", "|").alias("targets"))


@add("""
    SELECT page_id, i - 1 AS pos, x AS raw, regexp_extract(x, 'href="([^"]*)"', 1) AS target FROM (
        SELECT page_id, unnest(s) AS x, generate_subscripts(s, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)(<a(?:\\s[^>]*)?>.*?</a>)', 1) AS s FROM pages))
""")
def xml_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of a tag as they stand, in document order, with an attribute."""
    each = table(spark, sf_dir, "pages").select("page_id", F.posexplode(tx.elements(F.col("html"), "a")).alias("pos", "raw"))
    return each.select("page_id", F.col("pos").cast("long").alias("pos"), "raw", F.coalesce(tx.attribute(F.col("raw"), "href"), F.lit("")).alias("target"))


@add("""
    SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1) AS host, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) AS last,
           nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, md5(url) AS hash FROM pages
""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, last path segment, query value and hash of an address."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", tx.host(u).alias("host"), tx.last_segment(u).alias("last"), tx.query_value(u, "page").alias("page"), F.md5("url").alias("hash"))


@add("SELECT event_type, count(*)::BIGINT AS n, sum((props->>'$.k')::BIGINT)::BIGINT AS k, max((props->>'$.k')::BIGINT) AS most FROM events GROUP BY 1")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values from JSON text with a declared schema."""
    rows = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k long").alias("p"))
    return rows.groupBy("event_type").agg(F.count("*").cast("long").alias("n"), F.sum("p.k").cast("long").alias("k"), F.max("p.k").alias("most"))


@add("""
    WITH w AS (SELECT lang, length(x) AS n FROM (SELECT lang, unnest(regexp_extract_all(text, '[a-z]+')) AS x FROM documents) GROUP BY ALL HAVING true),
    c AS (SELECT lang, length(x)::BIGINT AS len, count(*)::BIGINT AS n FROM (SELECT lang, unnest(regexp_extract_all(text, '[a-z]+')) AS x FROM documents) GROUP BY ALL)
    SELECT lang, len, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, len) AS r FROM c) WHERE r = 1
""")
def modal_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent word length of each language, the smaller on a tie."""
    words = table(spark, sf_dir, "documents").select("lang", F.explode(F.regexp_extract_all("text", F.lit("[a-z]+"), F.lit(0))).alias("x"))
    counts = words.groupBy("lang", F.length("x").cast("long").alias("len")).agg(F.count("*").cast("long").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.col("n").desc(), "len")
    return counts.withColumn("r", F.row_number().over(w)).filter("r = 1").drop("r")


@add("""
    WITH t AS (SELECT doc_id, '^SERIES = GSE' || doc_id || chr(10) || '!lang = ' || lang || chr(10) || '!empty = ' || chr(10) || '^SAMPLE = GSM' || (doc_id * 2) || chr(10) || '!source = ' || source || chr(10) || '!sample_table_begin' || chr(10) || 'x = 1' || chr(10) || '!sample_table_end' || chr(10) AS s FROM documents)
    SELECT 'GSE' || doc_id AS key, 'SERIES' AS entity, 'lang' AS name, lang AS value FROM documents UNION ALL SELECT 'GSM' || (doc_id * 2), 'SAMPLE', 'source', source FROM documents
""")
def tagged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity blocks of line-tagged text and their fields; tables and empty values are left out."""
    d = F.col("doc_id").cast("string")
    made = F.concat(F.lit("^SERIES = GSE"), d, F.lit("\n!lang = "), "lang", F.lit("\n!empty = \n^SAMPLE = GSM"), (F.col("doc_id") * 2).cast("string"), F.lit("\n!source = "), "source", F.lit("\n!sample_table_begin\nx = 1\n!sample_table_end\n"))
    blocks = table(spark, sf_dir, "documents").select(F.explode(tx.entity_blocks(made)).alias("b")).select("b.*")
    each = blocks.select("key", "entity", F.explode(tx.tagged_fields(F.col("body"))).alias("f"))
    return each.select("key", "entity", "f.name", "f.value")


@add("""
    SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(x, '[;,\\s]+'), lambda t: t <> ''), '|') AS ids, len(list_filter(regexp_split_to_array(x, '\\s+'), lambda t: regexp_full_match(t, '[0-9]+')))::BIGINT AS numbers
    FROM (SELECT doc_id, ' ' || lang || '; ' || source || ',' || doc_id || ' ' || n_chars || '  7x' AS x FROM documents)
""")
def id_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids between several separators, and the tokens that are numbers."""
    x = F.concat(F.lit(" "), "lang", F.lit("; "), "source", F.lit(","), F.col("doc_id").cast("string"), F.lit(" "), F.col("n_chars").cast("string"), F.lit("  7x"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(tx.tokens(x), "|").alias("ids"), F.size(tx.number_tokens(x)).cast("long").alias("numbers"))


@add("""
    SELECT doc_id, CASE WHEN strpos(text, chr(10)) > 0 THEN left(text, strpos(text, chr(10)) - 1) ELSE text END AS first, (CASE WHEN strpos(text, chr(10)) > 0 THEN length(text) - strpos(text, chr(10)) ELSE 0 END)::BIGINT AS rest FROM documents
""")
def first_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line and the length of what follows."""
    first, rest = tx.first_line_and_rest(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", first.alias("first"), F.length(rest).cast("long").alias("rest"))


@add("""
    WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)
    SELECT page_id, t AS title, len(list_filter(string_split(t, ' '), lambda x: x <> ''))::BIGINT AS words, left(sha256(t), 16) AS hash FROM t
""")
def title_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A single value of marked-up text with its hash."""
    t = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    return t.select("page_id", "title", F.size(F.filter(F.split("title", " "), lambda x: x != "")).cast("long").alias("words"), F.substring(F.sha2("title", 256), 1, 16).alias("hash"))
