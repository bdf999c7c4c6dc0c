"""The registered queries of the training-data operators and their SQL twins."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cytospark.llm import ann, chat_format, conversation_repair, html_extract, language_id, minhash, nbest, ngram_lm, packing, \
    quality_rules, simhash, spelling, weak_quality
from cytospark.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_ngram_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.lm_scores(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op4_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.n_best(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


# A conversation whose texts hold control strings, formatted beside the table's own.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op7_prefix_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
                                 "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.examples(rows.unionByName(more)))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.weak_quality(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_ngram_bloom": op2_ngram_bloom,
    "op3_language_id": op3_language_id,
    "op4_nbest": op4_nbest,
    "op5_simhash": op5_simhash,
    "op6_hnsw": op6_hnsw,
    "op7_prefix_target": op7_prefix_target,
    "op8_packing": op8_packing,
    "op9_html_tree": op9_html_tree,
    "op10_weak_quality": op10_weak_quality,
    "op11_spelling": op11_spelling,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_minhash": op13_minhash,
}

_WORD = r"[^\x20\x09-\x0D]+"

ORACLE: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i
      FROM (SELECT rid, regexp_extract_all(text, '{_WORD}') AS words FROM d)),
per_word AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY rid),
windows AS (
  SELECT rid, i, word AS a, lead(word, 1) OVER s AS b, lead(word, 2) OVER s AS c FROM w
  WINDOW s AS (PARTITION BY rid ORDER BY i)),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows WHERE c IS NOT NULL)
  WHERE n >= 2),
covered AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
per_line AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '{_WORD}') GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines
  FROM d LEFT JOIN per_word USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN per_line USING (rid)),
hosts AS (
  SELECT source, count(*) AS n,
         count(*) FILTER (n_words < 50) AS f_short,
         count(*) FILTER (n_repeat_words * 100 > n_words * 50) AS f_repeat,
         count(*) FILTER (n_symbols * 10 > n_words) AS f_symbols,
         count(*) FILTER (n_dup_lines * 10 > n_lines * 3) AS f_dup_lines,
         count(*) FILTER (word_chars < n_words * 3 OR word_chars > n_words * 10) AS f_word_length
  FROM m WHERE source IS NOT NULL GROUP BY source),
long AS (SELECT source, n, rule, fails, fails / n AS rate
         FROM (UNPIVOT hosts ON f_short, f_repeat, f_symbols, f_dup_lines, f_word_length INTO NAME rule VALUE fails)),
prior AS (
  SELECT rule, avg(rate) AS mean, CASE WHEN var_pop(rate) > 0
         THEN least(greatest(avg(rate) * (1 - avg(rate)) / var_pop(rate) - 1, 1), 1000) ELSE 1000 END AS strength
  FROM long GROUP BY rule),
bad AS (SELECT DISTINCT source FROM long JOIN prior USING (rule) WHERE (fails + mean * strength) / (n + strength) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       bad.source IS NOT NULL AS host_rejected,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND bad.source IS NULL AS kept
FROM m LEFT JOIN bad ON m.source = bad.source""",
    # The formatted text has an assistant turn as <s>text</s> and any other as [INST]role, line, text[/INST]; the
    # example of the k-th assistant turn holds all turns up to it, and a rest without one is an example too.
    "op7_prefix_target": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT conv_id, turn, role, text,
         length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
           + CASE WHEN role = 'assistant' THEN 7 ELSE 14 + length(role) END AS chars,
         role = 'assistant' AS target FROM rows),
ends AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS upto,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS is_end FROM marked)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (target), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (target), '')) AS loss_sha256,
       sum(upto) FILTER (target OR is_end)::BIGINT AS formatted_chars
FROM ends GROUP BY conv_id""",
}
