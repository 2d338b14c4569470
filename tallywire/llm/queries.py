"""The registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywire.llm import (
    decontaminate, exact, licences, minhash, negatives, quality, ranked, secrets, substring, subwords, toxicity, warc, wrappers,
)
from tallywire.llm.common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return register


@query(r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \x09-\x0D]+', ' ', 'g') AS body FROM documents),
rows_ AS (SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS n FROM texts)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM rows_
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for its text, the number of rows with that text, and its digest."""
    found = exact.exact_duplicates(table(spark, sf_dir, "documents"))
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", digest)


@query(r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM words
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
found AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM found LEFT JOIN sizes USING (doc_id)
""")
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and the smallest document of its component."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    kept = F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), "component_id", kept)


@query(r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words),
windows AS (SELECT doc_id, p, list_slice(w, p, p + 12) AS s FROM places),
judged AS (SELECT doc_id, p, doc_id > min(doc_id) OVER (PARTITION BY s) AS again FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM judged WHERE again),
lost AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' '), '')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id)
""")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of words, of words that repeat an earlier document, and the digest of the rest."""
    found = substring.repeated_words(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@query("""
WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
digests AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS d FROM bodies),
judged AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) FILTER (WHERE n >= 100) OVER (PARTITION BY d) ELSE page_id END AS f FROM digests)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN f < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f < page_id THEN f END AS refers_to
FROM judged
""")
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives it was written to."""
    found = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_SECRET_SPANS = """{kind}_spans AS (
  SELECT row_, source, doc_id, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
    'kind': {rank}, 'value': v[i],
    'start': list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0),
    'stop': list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x)))}})) AS s
  FROM (SELECT row_, source, doc_id, string_split_regex(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}', 0) AS m,
    regexp_extract_all(t, '{pattern}', {group}) AS v FROM docs))"""


def _secret_sql() -> str:
    patterns = (secrets.ASSIGN, secrets.ACCESS, secrets.HEX, secrets.TOKEN)
    parts = [
        _SECRET_SPANS.format(kind=kind, rank=rank, pattern=pattern.replace("'", "''"), group=2 if rank == 0 else 0)
        for rank, (kind, pattern) in enumerate(zip(secrets.KINDS, patterns))
    ]
    name = "CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'token' END"
    text = f"string_agg({name} || ':' || start || ':' || stop, ',' ORDER BY start, kind)"
    return f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row_, source, coalesce(text, '') AS t FROM documents),
{", ".join(parts)},
base AS (SELECT row_, source, doc_id, unnest(s) FROM assign_spans WHERE length(s.value) >= 12
  UNION ALL SELECT row_, source, doc_id, unnest(s) FROM access_spans WHERE length(s.value) >= 18
  UNION ALL SELECT row_, source, doc_id, unnest(s) FROM hex_spans),
tokens AS (SELECT row_, source, doc_id, unnest(s) FROM token_spans
  WHERE regexp_matches(s.value, '[A-Z]') AND regexp_matches(s.value, '[a-z]') AND regexp_matches(s.value, '[0-9]')),
free AS (SELECT * FROM tokens t WHERE NOT EXISTS
  (SELECT 1 FROM base b WHERE b.row_ = t.row_ AND b.start < t.stop AND t.start < b.stop)),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM free),
owners AS (SELECT value, count(DISTINCT source) AS n FROM spans GROUP BY value),
judged AS (SELECT s.*, n < {secrets.EXAMPLE_OWNERS} AS live FROM spans s JOIN owners USING (value) WHERE kind < 3 OR n < {secrets.EXAMPLE_OWNERS}),
listed AS (SELECT row_, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
  count(*) FILTER (WHERE kind = 2) AS n_hex, {text} FILTER (WHERE kind < 3) AS base, {text} AS spans,
  count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example FROM judged GROUP BY row_)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN listed USING (row_)"""


@query(_secret_sql())
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base spans counted and digested, all spans, and how many look live or like examples."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))

    def count(test):
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(kind):
        return count(lambda s: s["kind"] == kind).alias(f"n_{secrets.KINDS[kind]}")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        F.col("id").alias("doc_id"),
        *[of_kind(kind) for kind in range(3)],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_example"),
    )


@query()
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licences its sentences state, and where."""
    found = licences.licence_scan(table(spark, sf_dir, "documents"))
    place = F.transform("licences", lambda m: F.concat_ws(":", m["licence"], m["start"].cast("string"), m["end"].cast("string")))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("licences").cast("long").alias("n_licences"),
        F.array_join(place, ",").alias("licences"),
        F.array_join("identifiers", ",").alias("identifiers"),
    )


@query()
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that leaks into it, with the edit distance."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score, and whether it was kept out of training."""
    docs = table(spark, sf_dir, "documents")
    out = quality.held_out(F.col("doc_id"))
    model = quality.train(docs, table(spark, sf_dir, "labels"), allowed=~out)
    scored = docs.select("doc_id", out.alias("held_out"), quality.score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


@query()
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number and digest of its pieces, and whether they decode to the text."""
    found = subwords.encode(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
    return found.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), "round_trip"
    )


@query()
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text."""
    found = wrappers.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query()
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score, and whether it was kept out of training."""
    out = toxicity.held_out(F.col("doc_id"))
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), allowed=~out)
    scored = found.withColumnRenamed("id", "doc_id").select("doc_id", out.alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@query("""
WITH usable AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT * FROM usable WHERE id % 50 = 0),
pairs AS (
  SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM anchors a JOIN usable b ON a.id <> b.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 3
""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every anchor and each of its positives the hardest rows of other labels."""
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


_SAID = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query(f"""
WITH docs AS (SELECT doc_id, {_SAID} AS t FROM documents),
sizes AS (SELECT doc_id, len(t) AS n FROM docs WHERE len(t) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS said FROM sizes),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_SAID}) AS term FROM benchmark) GROUP BY ALL),
postings AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, docs),
found AS (
  SELECT item_id, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // said))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals GROUP BY ALL)
SELECT item_id, row_number() OVER w AS rank, doc_id, score FROM found WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER w <= 10
""")
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every benchmark item the documents that score highest."""
    found = ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")
