"""The queries of this subpackage and their SQL, as the entry module registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_tokens, log_likelihood and mean_log_likelihood of every document."""
    from .masked_lm import score

    return score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id of every document."""
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    from .substring import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text_kept").cast("binary"), 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document: doc_id, item_id, place in the normalised text and edits."""
    from .decontaminate import find

    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base_failed and kept of every document."""
    from .quality_rules import judge

    found, _ = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation and of one that imitates the template's control strings."""
    from .chat import digests, format_conversations

    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return digests(format_conversations(rows.unionByName(extra)))


#: (host, path, verdict) of the production rules, and hosts and paths listed for blocking where no rule fits.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
URL_LISTED = tuple(f"{site}.example.{top}" for site in ("adult-x", "ads-track", "spam-farm", "cheap-pills", "casino-win", "free-bets") for top in ("com", "org", "net"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """host, path, rule and verdict of every page."""
    from .url_filter import judge

    rows = [(h, p, v, True) for h, p, v in URL_RULES] + [(h, "/", "block", False) for h in URL_LISTED]
    entries = spark.createDataFrame(rows, "host string, path string, verdict string, is_rule boolean")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), entries).select("page_id", "host", "path", "rule", "verdict")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece numbers of every document, how many there are, and whether they decode to the text again."""
    from .sentencepiece_viterbi import encode

    return encode(table(spark, sf_dir, "documents"), ["doc_id"])


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """held_out, lang_pred and score of every document."""
    from .language_id import identify

    return identify(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, text and n_chars of every page."""
    from .html_extract import extract

    return extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_url_filter": op7_url_filter,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_language_id": op9_language_id,
    "op10_html_extraction": op10_html_extraction,
}

_LISTED_SQL = " OR ".join(f"u.host = '{h}' OR u.host LIKE '%.{h}'" for h in URL_LISTED)
_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

ORACLE_SQL = {
    "op6_chat_formatting": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
    length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '<', '\<'), ':', '\:')) AS r,
    length(replace(replace(replace(replace(text, '\', '\\'), '#', '\#'), '<', '\<'), ':', '\:')) AS t
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
  sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(r + t + 14) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op7_url_filter": rf"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest, url FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u
), r(rh, rp, verdict) AS (VALUES {_RULES_SQL}),
m AS (
  SELECT h.page_id, max_by(r.rh || r.rp, length(r.rh || r.rp)) AS rule, max_by(r.verdict, length(r.rh || r.rp)) AS verdict
  FROM h JOIN r ON (h.host = r.rh OR h.host LIKE '%.' || r.rh) AND starts_with(h.path, r.rp) GROUP BY h.page_id)
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, CASE WHEN ({_LISTED_SQL}) AND starts_with(u.path, '/') THEN 'block' ELSE 'allow' END) AS verdict
FROM h u LEFT JOIN m USING (page_id)""",
}
