"""Registered queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.alignment import align_tokenizers
from cohortry.llm.captures import archived_pages
from cohortry.llm.common import table
from cohortry.llm.decontamination import mark_contaminated
from cohortry.llm.fill_in_middle import fill_in_middle_digests
from cohortry.llm.language import language
from cohortry.llm.licenses import oracle as license_sql
from cohortry.llm.licenses import scan_licenses
from cohortry.llm.near_duplicates import near_duplicates
from cohortry.llm.packing import pack_documents
from cohortry.llm.personal_data import BASE, find_personal_data, span_list
from cohortry.llm.quality import quality
from cohortry.llm.spotsigs import fingerprints
from cohortry.llm.token_files import token_files
from cohortry.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


NEAR_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ')
    ELSE words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * p.common >= 85 * (x.n + y.n - p.common)),
r AS (SELECT doc_id AS id, doc_id AS reach FROM documents UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.reach),
c AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query("op1_near_duplicates", NEAR_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, num=85, den=100)


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), special=True)


@query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), special=True)


@query("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    def count(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    digest = F.sha2(span_list(F.col("base_spans")), 256).alias("base_sha256")
    return found.select("doc_id", *map(count, BASE), digest, span_list(F.col("all_spans")).alias("spans"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "contaminated", "item_ids", "containment")


@query("op2_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language(table(spark, sf_dir, "documents"))


@query("op4_licenses", license_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "license_sentences", "licenses")


@query("op8_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


@query("op11_tokenizer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_tokenizers(table(spark, sf_dir, "documents"), a, b)


CAPTURE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url, sha1(coalesce(html, '')) AS hex FROM pages),
k AS (SELECT html, max(page_id) AS kept FROM p GROUP BY html),
u AS (SELECT *, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?(?:[^@/?#]*@)?([^/:?#]*)(?::([0-9]+))?([^#]*)' AS parts,
  array_to_string(list_transform(string_split(hex, ''), lambda c: substr(
    '0000000100100011010001010110011110001001101010111100110111101111', 4 * instr('0123456789abcdef', c) - 3, 4)), '') AS bits FROM p),
d AS (SELECT page_id, html, array_to_string(list_transform(range(0, 160, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * bits[i + 1]::INT + 8 * bits[i + 2]::INT + 4 * bits[i + 3]::INT + 2 * bits[i + 4]::INT + bits[i + 5]::INT, 1)), '') AS digest,
  regexp_replace(lower(regexp_extract(url, parts, 1)), '^www[.]', '') AS host, regexp_extract(url, parts, 2) AS port,
  regexp_extract(url, parts, 3) AS rest, url FROM u),
e AS (SELECT *, CASE WHEN url = '' THEN '' ELSE array_to_string(list_reverse(string_split(host, '.')), ',')
    || CASE WHEN port IN ('', '80', '443') THEN '' ELSE ':' || port END || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END END AS url_key,
  strftime(TIMESTAMP '2000-01-01' + to_seconds(coalesce(page_id, 0)), '%Y%m%d%H%M%S') AS captured FROM d)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> kept THEN kept END AS refers_to,
  url_key, captured, row_number() OVER (ORDER BY url_key, captured, page_id) - 1 AS capture_rank
FROM e JOIN k USING (html)
"""


@query("op12_captures", CAPTURE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(spark, table(spark, sf_dir, "pages"))


MIDDLE_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS hex,
  regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units FROM documents),
h AS (SELECT *, len(units) AS n, ('0x' || hex[1:8])::UBIGINT AS h1, ('0x' || hex[9:16])::UBIGINT AS h2,
  ('0x' || hex[17:24])::UBIGINT AS h3, ('0x' || hex[25:32])::UBIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT *, array_to_string(units[1:low::BIGINT], '') AS prefix, array_to_string(units[low::BIGINT + 1:high::BIGINT], '') AS middle,
  array_to_string(units[high::BIGINT + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM s
"""


@query("op13_fill_in_middle", MIDDLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_digests(table(spark, sf_dir, "documents"))
