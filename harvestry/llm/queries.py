"""Queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harvestry.llm import decontam, html_text, media, mixing, neardup, pii, quality, secret_scan, spans, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogate_report(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.span_report(table(spark, sf_dir, "documents"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_report(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_report(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_surrogates, op2_secret_scan, op3_near_duplicates, op4_toxicity, op5_sentence_spans, op6_media, op7_decontamination, op8_mixing, op9_quality, op10_main_text)
}

#: The base rules and the further public formats, for DuckDB's regular expressions: (kind, pattern, group whose length counts, least length).
SECRET_PATTERNS = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
    ("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----", 0, 1),
    ("git_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("bearer", r"[Bb][Ee][Aa][Rr][Ee][Rr]\x20+[A-Za-z0-9+/_.=-]{16,}", 0, 1),
    ("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@", 0, 1),
)


def _secret_sql() -> str:
    """Matches of a pattern and the pieces between them give the places; a shorter group than asked for drops a match."""
    parts = []
    for k, (kind, pattern, group, least) in enumerate(SECRET_PATTERNS):
        p = "'" + pattern.replace("'", "''") + "'"
        parts.append(
            f"SELECT doc_id, {k} AS k, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, {p}, 0) AS m, regexp_extract_all(t, {p}, {group}) AS g, regexp_split_to_array(t, {p}) AS r FROM d"
        )
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), p AS ({' UNION ALL '.join(parts)}),
    i AS (SELECT doc_id, k, kind, least, m, g, r, unnest(range(1, len(m) + 1)) AS n FROM p),
    x AS (SELECT doc_id, k, kind, (list_sum(list_transform(r[1:n], lambda z: len(z))) + coalesce(list_sum(list_transform(m[1:n - 1], lambda z: len(z))), 0))::BIGINT AS a, len(m[n]) AS l FROM i WHERE len(g[n]) >= least),
    s AS (SELECT doc_id, k, kind, a, kind || ':' || a || ':' || (a + l) AS z FROM x)
    SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    sha256(coalesce(string_agg(z, ',' ORDER BY a, k) FILTER (k < 3), '')) AS base_sha256, coalesce(string_agg(z, ',' ORDER BY a, k) FILTER (z IS NOT NULL), '') AS spans
    FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id"""


NEAR_DUPLICATES_SQL = """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
    x AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
    links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
    least AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
    SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(l.b, s.doc_id)) AS component_id, component_id = s.doc_id AS kept FROM s LEFT JOIN least l USING (doc_id)"""

#: The other operators are beyond SQL (trained models, parsers, transforms, keyed draws); their tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {"op2_secret_scan": _secret_sql(), "op3_near_duplicates": NEAR_DUPLICATES_SQL}
