"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    archive,
    extract,
    language,
    licenses,
    linededup,
    mixing,
    neardup,
    nearest,
    periodicity,
    pieces,
    sharding,
    toplists,
    whitening,
)
from tidemark.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def piece_model() -> str:
    """Place of the tokenizer file, from the package that the machines have."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, folder, "documents"))


def op2_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_scan_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_templates(_table(spark, folder, "documents"), licenses.notices(spark))


def op4_top_scores(spark: SparkSession, folder: str) -> DataFrame:
    return toplists.top_scores(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_identify_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op6_archive_pages(spark: SparkSession, folder: str) -> DataFrame:
    return archive.archive_pages(_table(spark, folder, "pages"))


def op9_extract_pages(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract_pages(_table(spark, folder, "pages"))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "documents"))


def op8_piece_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.token_digests(_table(spark, folder, "documents"), piece_model())


def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op11_drop_repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.line_report(_table(spark, folder, "documents"))


def op12_whiten_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitening_report(_table(spark, folder, "embeddings"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodicity.run_report(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_shard_documents,
        op2_nearest_vectors,
        op3_scan_licenses,
        op4_top_scores,
        op5_identify_language,
        op6_archive_pages,
        op7_near_duplicates,
        op8_piece_tokens,
        op9_extract_pages,
        op10_mix_sources,
        op11_drop_repeated_lines,
        op12_whiten_embeddings,
        op13_periodic_runs,
    )
}

_TOP_SCORES = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""

# Base 32: character i stands for bits 5i to 5i + 4, found in the hex digits 5i / 4 and the next.
_ARCHIVE = """
WITH paid AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), largest AS (SELECT h, max(page_id) AS m FROM paid GROUP BY h)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
    (((strpos('0123456789abcdef', substr(h, CAST(1 + (5 * i) // 4 AS INTEGER), 1)) - 1) * 16
      + strpos('0123456789abcdef', substr(h, CAST(2 + (5 * i) // 4 AS INTEGER), 1)) - 1) >> CAST(3 - (5 * i) % 4 AS INTEGER))
    & 31) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN m IS NULL OR page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM paid JOIN largest USING (h)
"""

_NEAR_DUPLICATES = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END) AS s FROM worded
), parts AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c
  FROM parts a JOIN parts b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (SELECT a, b FROM common WHERE 100 * c >= 75 * (n + m - c)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
), smallest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN smallest USING (doc_id)
"""

_SHINGLES = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))"
_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_NOTICES = ", ".join("(" + ", ".join("'" + part.replace("'", "''") + "'" for part in pair) + ")" for pair in licenses.TEMPLATES)

# Every window of a template's class that holds one of its shingles, by plain containment
_LICENSES = f"""
WITH notices(license, text) AS (VALUES {_NOTICES}
), parts AS (SELECT license, list_distinct({_SHINGLES}) AS s FROM (SELECT license, {_WORDS} AS w FROM notices)
), sought AS (SELECT license, len(s) AS n, CAST(pow(2, ceil(log2(len(s)))) AS BIGINT) AS c, unnest(s) AS g FROM parts
), texts AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM (
    SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)
), places AS (SELECT doc_id, r, unnest({_SHINGLES}) AS g, generate_subscripts({_SHINGLES}, 1) - 1 AS place FROM texts
), met AS (
  SELECT doc_id, r, license, n, c, g, unnest(list_distinct([place // c, greatest(0, place // c - 1)])) AS win
  FROM places JOIN sought USING (g)
), held AS (
  SELECT doc_id, r, license, win * c AS first_word, count(DISTINCT g) / n AS containment
  FROM met GROUP BY doc_id, r, license, n, c, win
)
SELECT doc_id, license, containment, first_word FROM held WHERE containment >= 0.75
QUALIFY row_number() OVER (PARTITION BY doc_id, r, license ORDER BY containment DESC, first_word) = 1
"""

_REPEATED_LINES = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), repeated AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT keyed.*, coalesce(doc_id <> first, false) AS gone FROM keyed LEFT JOIN repeated ON keyed.k = repeated.k
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, r
"""

ORACLES: dict[str, str] = {
    "op3_scan_licenses": _LICENSES,
    "op11_drop_repeated_lines": _REPEATED_LINES,
    "op4_top_scores": _TOP_SCORES,
    "op6_archive_pages": _ARCHIVE,
    "op7_near_duplicates": _NEAR_DUPLICATES,
}
