"""Registered queries of the subpackage: one for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup
from .conversation_repair import COUNTS, damaged, repair_conversations
from .decontaminate import overlaps
from .html_extract import extract_pages
from .language_id import identify_languages
from .license_scan import scan_licenses
from .lm_scoring import score_documents
from .mixing import mix_sources
from .prefix_trie import stitched_trie
from .simhash import hexadecimal, near_duplicates
from .substring_dedup import dedup_substrings
from .toxicity import score_toxicity
from .url_filter import filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_substrings(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations after each took over the head of its hundred's first one."""
    trie = stitched_trie(_table(spark, sf_dir, "conversations"))
    return trie.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents")).drop("detections")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = repair_conversations(damaged(_table(spark, sf_dir, "conversations")))
    return repaired.select("conv_id", *COUNTS, "audit", "repaired_sha256")


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_language_id": op5_language_id,
    "op6_html_extract": op6_html_extract,
    "op7_toxicity": op7_toxicity,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_decontaminate": op10_decontaminate,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_license_scan": op12_license_scan,
    "op13_conversation_repair": op13_conversation_repair,
}


def _crc32(text: str) -> str:
    """SQL of the unsigned crc32 of an ASCII text."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    byte = "list_reduce([xor(acc, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    return f"xor(list_reduce([4294967295]::BIGINT[] || {codes}, lambda acc, b: {byte}), 4294967295)"


def _repair_step() -> str:
    """SQL of one row's step back: for each of four states the least (cost, audit, lines)."""
    row = lambda cost, letter, line, q: f"{{'c': {cost} + s{q}.c, 'a': '{letter}' || s{q}.a, 'l': {line} || s{q}.l}}"
    least = lambda *of: f"list_sort([{', '.join(of)}])[1]"
    said, alternate, kept = "[r.role || ':' || r.text]", (2, 2, 3, 2), ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    bad = "(CASE WHEN r.fault IN ('blank', 'duplicate') THEN 1000000 WHEN r.fault = 'truncated' THEN 1 ELSE 0 END)"
    raw = []
    for q in range(4):
        to = alternate[q]
        new = "assistant" if to == 3 else "user"
        keeps = [row(f"CASE WHEN left(r.role, 1) = '{x}' THEN 0 ELSE 1000000 END + {bad}", "K", said, t) for x, t in kept[q].items()]
        raw.append(least(row("3", "D", "[]::VARCHAR[]", q), *keeps, row(f"2 + {bad}", "R", f"['{new}:' || r.text]", to)) + f" AS g{q}")
    insert = lambda g, role: f"{{'c': 2 + {g}.c, 'a': 'I' || {g}.a, 'l': ['{role}:'] || {g}.l}}"
    last = [least("g2", insert("g3", "assistant")) + " AS s2", least("g3", insert("g2", "user")) + " AS s3"]
    first = [least(f"g{q}", insert("s2", "user")) + f" AS s{q}" for q in (0, 1)]
    return f"""
  SELECT conv_id, k, {', '.join(first)}, s2, s3 FROM (
    SELECT conv_id, k, g0, g1, {', '.join(last)} FROM (
      SELECT r.conv_id, r.k, {', '.join(raw)}
      FROM back b JOIN judged r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.k = b.k - 1))"""

ORACLE_SQL: dict[str, str] = {
    "op3_mixing": r"""
WITH counted AS (
  SELECT *, md5(coalesce(text, '')) AS digest, count(*) OVER (PARTITION BY doc_id) AS same_id, row_number() OVER (PARTITION BY doc_id, text) AS row,
         count(*) OVER (PARTITION BY doc_id, coalesce(text, '')) AS equal
  FROM documents),
named AS (
  SELECT doc_id, source, text,
         CASE WHEN same_id = 1 AND doc_id IS NOT NULL THEN doc_id::VARCHAR
              ELSE concat_ws(':', doc_id, digest, CASE WHEN equal > 1 THEN row END) END AS name
  FROM counted),
sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5(name), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM named),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source),
caps AS (SELECT *, source_size * 2.0::DOUBLE AS cap FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER ()
             - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM caps),
free AS (SELECT max(level) AS rest FROM levels WHERE cap > weight * level),
targets AS (
  SELECT source, source_size, CASE WHEN cap <= weight * level THEN cap ELSE weight * rest END AS target
  FROM levels LEFT JOIN free ON true),
ranked AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS wanted,
         sum(size) OVER (PARTITION BY d.source ORDER BY u RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS upto,
         sum(size) OVER (PARTITION BY d.source, u)::DOUBLE AS tied
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN wanted > whole AND upto - tied / 2.0::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END)::BIGINT * size AS taken
FROM ranked""",
    "op8_substring_dedup": r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
each_word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i, len(words) AS n FROM texts),
runs AS (SELECT doc_id, i AS s, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS run FROM each_word),
windows AS (SELECT doc_id, s, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS n FROM runs WHERE s + 19 <= n),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM windows WHERE n > 1),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM each_word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id""",
    "op9_url_filter": r"""
WITH parts AS (
  SELECT page_id,
         translate(CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '(?s)^([^/?#]*)', 1) ELSE '' END,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '(?s)^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('block', 'net', '/de/'), ('allow', 'example.net', '/de/8'), ('block', 'org', '/es/')),
fits AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) p
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path""",
    "op11_prefix_trie": rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32('conv_id::VARCHAR')} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
lent AS (SELECT c.conv_id, c.h, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h),
shift AS (SELECT c.conv_id, c.h, count(l.place) AS n FROM convs c LEFT JOIN lent l ON l.conv_id = c.conv_id GROUP BY c.conv_id, c.h),
rebuilt AS (
  SELECT conv_id, place, role, text FROM lent
  UNION ALL
  SELECT t.conv_id, t.place - s.h + s.n, role, text FROM turns t JOIN shift s ON t.conv_id = s.conv_id AND t.place > s.h),
prefixes AS (
  SELECT conv_id, place::BIGINT AS depth, length(text) AS chars,
         md5(string_agg(md5(length(role) || ':' || role || text), '' ORDER BY place) OVER (PARTITION BY conv_id ORDER BY place)) AS node
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
linked AS (SELECT *, lag(node) OVER w AS above, lead(node) OVER w IS NULL AS ends FROM prefixes WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
nodes AS (
  SELECT node, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM linked GROUP BY node, depth),
full_nodes AS (SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.above = n.node) AS n_children FROM nodes n),
sums AS (
  SELECT p.node, sum((f.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((f.n_convs - 1) * f.chars)::BIGINT AS saved_tokens
  FROM full_nodes f JOIN prefixes p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.node)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums s ON s.node = f.node LEFT JOIN nodes u ON u.node = f.above""",
    "op13_conversation_repair": rf"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS what
  FROM conversations),
rows_left AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN what = 1 THEN '' WHEN what = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE what WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM coded),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS k,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen,
         rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS bare
  FROM rows_left),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) || left(role, 1) AS pair
  FROM ranked),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS n
  FROM judged GROUP BY conv_id),
back(conv_id, k, s0, s1, s2, s3) AS (
  SELECT conv_id, n + 1, {{'c': 0, 'a': '', 'l': []::VARCHAR[]}}, {{'c': 4, 'a': 'II', 'l': ['user:', 'assistant:']}}, {{'c': 2, 'a': 'I', 'l': ['assistant:']}}, {{'c': 0, 'a': '', 'l': []::VARCHAR[]}}
  FROM facts
  UNION ALL {_repair_step()})
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0)::BIGINT AS cost, coalesce(s0.a, '') AS audit, sha256(coalesce(array_to_string(s0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.k = 1""",
}
