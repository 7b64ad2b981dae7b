"""The operators of this subpackage as registered queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (
    alignment, decontaminate, kn_words, packing, pu_quality, repeats, reply_trees, simhash, spelling, token_files, toxicity,
    url_rules, warc,
)
from quire.llm.url_rules import Rule

#: The rule list of the url query (fixed values).
URL_RULES = [Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
             Rule("allow", "com/fr/"), Rule("block", "com/de/")]


#: The conversation that the chat query adds: texts that look like a template's own marks.
CONVERSATION_7 = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES, ["page_id"])


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_captures(_table(spark, sf_dir, "pages"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kn_words.judge_words(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("uid")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(CONVERSATION_7, rows.schema)
    return reply_trees.conversation_digests(rows.unionByName(own))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.document_words(_table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_url_filters, op3_quality_classifier, op4_warc, op5_simhash_near_dedup, op6_token_files, op7_quality_rules,
                                    op8_decontamination, op9_suffix_array_dedup,
                                    op10_toxicity, op11_reply_trees, op12_token_alignment, op13_spelling_variants)}

_RULE_ROWS = ", ".join(f"('{r.verdict}', '{r.pattern}')" for r in URL_RULES)


def _sql_escaped(text: str) -> str:
    """SQL of `reply_trees.escape`, one replacement per control string."""
    out = f"replace({text}, '\\', '\\\\')"
    for c in reply_trees.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_FRAME = len(reply_trees.TURN + reply_trees.SAYS + reply_trees.END)

ORACLE_SQL = {
    "op11_reply_trees": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {", ".join(str(r) for r in CONVERSATION_7)}) AS v(conv_id, turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_FRAME} + length({_sql_escaped("role")}) + length({_sql_escaped("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""",
    "op4_warc": f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, min(page_id) AS holder FROM hashed GROUP BY hex)
SELECT h.page_id, h.payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('{_BASE32}', CAST(
         (CAST('0x' || substr(h.hex, CAST((i // 4) * 5 + 1 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN h.page_id = f.holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN h.page_id <> f.holder THEN f.holder END AS refers_to
FROM hashed h JOIN firsts f ON h.hex = f.hex""",
    # Hosts are compared as strings and paths as prefixes, without regular expressions.
    "op2_url_filters": rf"""
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules AS (
  SELECT verdict, pattern, split_part(pattern, '/', 1) AS rhost, substr(pattern, strpos(pattern, '/')) AS rpath
  FROM (VALUES {_RULE_ROWS}) AS v(verdict, pattern)),
addresses AS (SELECT DISTINCT host, path FROM parts),
judged AS (
  SELECT a.host, a.path, arg_max(r.pattern, length(r.pattern)) AS rule, arg_max(r.verdict, length(r.pattern)) AS verdict
  FROM addresses a JOIN rules r ON (a.host = r.rhost OR ends_with(a.host, '.' || r.rhost)) AND starts_with(a.path, r.rpath)
  GROUP BY a.host, a.path)
SELECT p.page_id, p.host, p.path, j.rule,
       coalesce(j.verdict, CASE WHEN {" OR ".join(
           f"contains(p.host || p.path, '{r.pattern.strip('*')}')" for r in url_rules.DEFAULT_GLOBS)} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN judged j ON p.host = j.host AND p.path = j.path""",
}
