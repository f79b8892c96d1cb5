"""Registered queries over the text tables and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm import (
    bpe, decontaminate, line_dedup, manifest, pii, preferences, quality_model, quality_rules, shards, simhash, suffix_dedup,
    token_counts, vector_codes)
from clickmill.llm.common import prepare, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: build(prepare(spark), sf_dir)
        if sql:
            ORACLES[name] = sql
        return build
    return add


@register("op1_preference_pairs", r"""
WITH rows AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM rows),
last AS (SELECT conv_id, max(k) AS last FROM numbered WHERE role = 'assistant' GROUP BY conv_id),
cut AS (SELECT n.conv_id, n.k, n.role, n.text, l.last FROM numbered n JOIN last l USING (conv_id) WHERE n.k <= l.last),
reply AS (
  SELECT l.conv_id, coalesce(max(o.text), '') AS reply
  FROM last l LEFT JOIN cut o ON o.conv_id = xor(l.conv_id, 1) AND o.k = o.last GROUP BY l.conv_id),
sides AS (
  SELECT c.conv_id, '<|' || c.role || '|>' || chr(10) || c.text || '<|end|>' || chr(10) AS shown, c.k, c.last, c.text, r.reply
  FROM cut c JOIN reply r USING (conv_id))
SELECT conv_id AS pair_id, CAST(max(last) - 1 AS BIGINT) AS n_prompt_turns,
  coalesce(string_agg(shown, '' ORDER BY k) FILTER (WHERE k < last), '') AS prompt,
  max(shown) FILTER (WHERE k = last) AS chosen,
  '0:' || max(length(shown)) FILTER (WHERE k = last) || ':1' AS chosen_mask,
  '<|assistant|>' || chr(10) || max(reply) || '<|end|>' || chr(10) AS rejected,
  '0:' || (length('<|assistant|>') + 1 + max(length(reply)) + length('<|end|>') + 1) || ':1' AS rejected_mask
FROM sides GROUP BY conv_id
HAVING max(text) FILTER (WHERE k = last) <> max(reply)
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs out of all conversations: the own last reply against the neighbour's."""
    chosen, rejected = preferences.reply_swaps(read_table(spark, sf_dir, "conversations"))
    return preferences.preference_pairs(chosen, rejected).select(
        "pair_id", F.col("n_prompt_turns").cast("bigint").alias("n_prompt_turns"), "prompt", "chosen",
        preferences.mask_text("chosen_mask").alias("chosen_mask"), "rejected",
        preferences.mask_text("rejected_mask").alias("rejected_mask"))


@register("op2_personal_data")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data_digest(read_table(spark, sf_dir, "documents"))


@register("op3_quality_model")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_model.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe.token_digest(read_table(spark, sf_dir, "documents"), RANKS)


@register("op5_histogram_shards", r"""
WITH RECURSIVE t AS (
  SELECT b, 0 AS k, CAST(b AS BIGINT) AS v FROM range(0, 256) r(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM t WHERE k < 8),
crc AS (
  SELECT list(v ORDER BY b) AS tab FROM t WHERE k = 8),
d AS (
  SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS hash, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (
  SELECT *, list_transform(range(0, strlen(text)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS bytes FROM d),
k AS (
  SELECT doc_id, strlen(text) + 8 AS size, hash,
    xor(list_reduce(bytes, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS text_crc32,
    sum(strlen(text) + 8) OVER () AS total,
    coalesce(sum(strlen(text) + 8) OVER (ORDER BY hash, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM b, crc),
s AS (
  SELECT *, (SELECT count(*) FROM range(1, 24) r(n) WHERE below >= total * n // 24) AS shard FROM k)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY hash, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards of near equal bytes."""
    return shards.shard_digest(read_table(spark, sf_dir, "documents"))


@register("op6_line_windows", r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
p AS (
  SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM d WHERE len(lines) >= 3),
w AS (
  SELECT doc_id, i, lines[i] AS a, lines[i + 1] AS b, lines[i + 2] AS c FROM p
  WHERE length(trim(lines[i] || lines[i + 1] || lines[i + 2], ' ' || chr(9) || chr(11) || chr(12) || chr(13))) > 0),
n AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS n FROM w),
r AS (
  SELECT DISTINCT doc_id, i + k AS line FROM n, range(0, 3) t(k) WHERE n > 1),
s AS (
  SELECT doc_id, line, lag(line) OVER (PARTITION BY doc_id ORDER BY line) AS before FROM r),
c AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR before < line - 1) AS n_spans,
    list(line) AS gone FROM s GROUP BY doc_id)
SELECT d.doc_id, CAST(len(lines) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN lines ELSE
    list_filter(lines, lambda x, i: NOT list_contains(gone, i)) END, chr(10)), '')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of three lines and more that came before."""
    return line_dedup.line_digest(read_table(spark, sf_dir, "documents"))


@register("op7_simhash_bytes")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.simhash_digest(read_table(spark, sf_dir, "documents"))


@register("op8_quality_rules", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
p AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM p),
c AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM g, range(0, 3) t(k) WHERE n > 1 GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n_repeat_words, 0) AS n_repeat_words,
    len(lines) AS n_lines, length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS n_upper,
    length(text) - length(regexp_replace(text, '!', '', 'g')) AS n_exclamations,
    length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS n_digits
  FROM w LEFT JOIN c USING (doc_id)),
b AS (
  SELECT *, (n_words < 50)::BIGINT + (100 * n_repeat_words > 50 * n_words)::BIGINT * 2
    + (10 * n_symbols > n_words)::BIGINT * 4 + (10 * n_dup_lines > 3 * n_lines)::BIGINT * 8
    + (10 * n_upper > 4 * word_chars)::BIGINT * 16 + (10 * n_exclamations > 2 * n_words)::BIGINT * 32
    + (word_chars < 2 * n_words OR word_chars > 14 * n_words)::BIGINT * 64
    + (10 * n_digits > 4 * word_chars)::BIGINT * 128 AS failed_rules
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (failed_rules & 3) <> 0 AS base_failed, failed_rules = 0 AS kept,
  failed_rules
FROM b
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements and verdicts of every document."""
    return quality_rules.quality_digest(read_table(spark, sf_dir, "documents"))


@register("op9_minhash_containment", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM d WHERE len(w) > 0)),
s AS (
  SELECT DISTINCT item_id, array_to_string(w[k:k + 4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM i WHERE len(w) > 0)),
n AS (
  SELECT item_id, count(*) AS n_shingles FROM s GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_shingles, count(*) / n_shingles AS containment
FROM ds JOIN s USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING 5 * count(*) >= 4 * n_shingles
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every document."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 50-byte strings that start in an earlier document."""
    return suffix_dedup.suffix_digest(read_table(spark, sf_dir, "documents"))


def _nearest(name: str, codebook: str) -> str:
    """Nearest entry, the least of equally near ones, and its distance, per vector and part."""
    return f"""{name} AS (
  SELECT rn, part, min(d * 256 + entry) & 255 AS entry, min(d) AS d
  FROM (SELECT rn, part, entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM x JOIN {codebook} USING (part, pos)
        GROUP BY rn, part, entry)
  GROUP BY rn, part)"""


def _means(name: str, codebook: str, nearest: str) -> str:
    return f"""{name} AS (
  SELECT o.part, o.entry, o.pos, coalesce(n.c, o.c) AS c FROM {codebook} o LEFT JOIN (
    SELECT part, entry, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS c FROM x JOIN {nearest} USING (rn, part)
    GROUP BY part, entry, pos) n USING (part, entry, pos))"""


@register("op11_value_dictionaries", f"""
WITH k AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS rn, len(embedding) // 16 AS width,
    list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS (
  SELECT rn, i // width AS part, i % width AS pos, v[i + 1] AS x
  FROM (SELECT rn, width, v, unnest(range(0, len(v))) AS i FROM k)),
c0 AS (
  SELECT part, rn - 1 AS entry, pos, x AS c FROM x WHERE rn <= 64),
{_nearest("a0", "c0")},
{_means("c1", "c0", "a0")},
{_nearest("a1", "c1")},
{_means("c2", "c1", "a1")},
{_nearest("a2", "c2")},
e AS (
  SELECT rn, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY rn)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c2) AS codebooks_sha256
FROM k JOIN e USING (rn)
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as sixteen bytes."""
    return vector_codes.code_digest(read_table(spark, sf_dir, "embeddings"))


@register("op12_prefix_counts")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, read off the counts of its prefixes."""
    return token_counts.token_count_digest(read_table(spark, sf_dir, "documents"), TOKENIZER)


def _leaf(n_chars: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _tree(name: str, nodes: str) -> str:
    """All levels of the trees over ``nodes`` (tree, pos, n, h)."""
    return f"""{name} AS (
  SELECT 0 AS level, tree, pos, n, h FROM {nodes}
  UNION ALL
  SELECT level + 1, tree, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1
  GROUP BY level, tree, pos // 2, (n + 1) // 2)"""


@register("op13_merkle_superblocks", f"""
WITH RECURSIVE t AS (
  SELECT b, 0 AS k, CAST(b AS BIGINT) AS v FROM range(0, 256) r(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM t WHERE k < 8),
crc AS (
  SELECT list(v ORDER BY b) AS tab FROM t WHERE k = 8),
d AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_leaf("n_chars")} AS leaf, {_leaf("(n_chars + 1)")} AS changed,
    xor(list_reduce(list_transform(range(0, strlen(CAST(doc_id AS VARCHAR))),
      lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i + 1, 1)) AS BIGINT)),
      lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS checksum
  FROM documents, crc),
leaves AS (
  SELECT doc_id, tree, leaf AS h, CASE WHEN checksum % 7 = 0 THEN changed ELSE leaf END AS claimed,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM d),
{_tree("nodes", "leaves")},
tops AS (
  SELECT tree AS lang, level AS depth, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
top_leaves AS (
  SELECT 0 AS tree, pos, n, subroot AS h FROM tops),
{_tree("top_nodes", "top_leaves")},
paths AS (
  SELECT l.tree, l.pos, c.level AS step, s.h AS sibling, s.pos < (l.pos >> c.level) AS is_left
  FROM leaves l JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) c USING (tree)
  LEFT JOIN nodes s ON s.tree = l.tree AND s.level = c.level AND s.pos = xor(l.pos >> c.level, 1)),
top_paths AS (
  SELECT l.lang AS tree, l.depth + c.level AS step, s.h AS sibling, s.pos < (l.pos >> c.level) AS is_left
  FROM tops l, (SELECT DISTINCT level FROM top_nodes WHERE n > 1) c
  LEFT JOIN top_nodes s ON s.level = c.level AND s.pos = xor(l.pos >> c.level, 1)),
steps AS (
  SELECT tree, pos, step, sibling, is_left FROM paths
  UNION ALL SELECT l.tree, l.pos, p.step, p.sibling, p.is_left FROM leaves l JOIN top_paths p USING (tree)),
folds AS (
  SELECT tree, pos, 0 AS step, claimed AS h FROM leaves
  UNION ALL
  SELECT f.tree, f.pos, f.step + 1,
    sha256(CASE WHEN s.sibling IS NULL THEN f.h WHEN s.is_left THEN s.sibling || f.h ELSE f.h || s.sibling END)
  FROM folds f JOIN steps s ON s.tree = f.tree AND s.pos = f.pos AND s.step = f.step),
folded AS (
  SELECT tree, pos, max_by(h, step) AS folded_root FROM folds GROUP BY tree, pos),
proofs AS (
  SELECT tree, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY tree, pos),
root AS (
  SELECT h AS root FROM top_nodes WHERE n = 1)
SELECT l.doc_id, l.h AS leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM leaves l JOIN tops ON tops.lang = l.tree JOIN folded f ON f.tree = l.tree AND f.pos = l.pos
LEFT JOIN proofs p ON p.tree = l.tree AND p.pos = l.pos, root
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, with a proof for each."""
    return manifest.manifest_digest(read_table(spark, sf_dir, "documents"))
