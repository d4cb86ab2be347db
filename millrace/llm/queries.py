"""The registered queries of the training-data operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, mixing, packing, quality, quality_rules, scoring, simhash, substrings, token_counts, token_files
from .common import documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(documents(spark, sf_dir))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_rows(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed_digest(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def queries() -> dict:
    return {f.__name__: f for f in (op1_quality_rules, op2_lm_scoring, op3_token_ids, op4_exact_dedup, op5_quality_classifier, op6_token_counts, op7_simhash, op8_best_fit_packing, op9_suffix_array_dedup, op10_mixing)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
WITH n AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm
"""

OP1 = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (SELECT uid, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
x AS (SELECT uid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM g),
y AS (SELECT uid, i, count(*) OVER (PARTITION BY uid, s) AS n FROM x),
z AS (SELECT uid, count(DISTINCT p)::BIGINT AS n_repeat_words FROM (SELECT uid, unnest([i, i + 1, i + 2]) AS p FROM y WHERE n > 1) GROUP BY uid),
f AS (
  SELECT d.uid, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN z ON d.uid = z.uid),
r AS (
  SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeated, 10 * n_symbols > n_words AS symbols,
    100 * n_dup_lines > 30 * n_lines AS lines, word_chars < 2 * n_words OR word_chars > 14 * n_words AS lengths FROM f),
u AS (SELECT source, rule, count(*) AS n, sum(hit::INT) AS k FROM (
    SELECT source, unnest(['short', 'repeated', 'symbols', 'lines', 'lengths', 'any']) AS rule,
      unnest([short, repeated, symbols, lines, lengths, short OR repeated OR symbols OR lines OR lengths]) AS hit FROM r) GROUP BY ALL),
m AS (SELECT rule, sum(k)::DOUBLE / sum(n) AS mu, count(*) AS hosts, sum(n) AS total FROM u GROUP BY rule),
v AS (SELECT m.rule, mu, greatest(sum(n * (k::DOUBLE / n - mu) ** 2) / any_value(total) - mu * (1 - mu) * any_value(hosts) / any_value(total), 0) AS between_hosts
  FROM u JOIN m ON u.rule = m.rule GROUP BY m.rule, mu),
s AS (SELECT rule, mu, CASE WHEN between_hosts <= 0 THEN 1000 ELSE least(1000, greatest(1, mu * (1 - mu) / between_hosts - 1)) END AS strength FROM v),
h AS (SELECT source, bool_or((k + mu * strength) / (n + strength) > CASE u.rule WHEN 'any' THEN mu + 2 * sqrt(mu * (1 - mu) / (strength + 1)) ELSE 0.5 END) AS flagged
  FROM u JOIN s ON u.rule = s.rule GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeated AS base_failed,
  NOT (short OR repeated) AND NOT (flagged AND (short OR repeated OR symbols OR lines OR lengths)) AS kept
FROM r JOIN h ON r.source IS NOT DISTINCT FROM h.source
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS o
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rk FROM s),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM r),
f AS (
  SELECT *, coalesce(sum(cap) OVER b, 0)::BIGINT AS spent, coalesce(sum(weight) OVER b, 0)::BIGINT AS gone,
    (sum(source_size) OVER ())::BIGINT AS everything, (sum(weight) OVER ())::BIGINT AS weights
  FROM w WINDOW b AS (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (everything - spent)::DOUBLE / (weights - gone) AS level FROM f),
u AS (SELECT *, max(CASE WHEN cap::DOUBLE / weight > level THEN level END) OVER () AS water FROM l),
t AS (SELECT source, source_size, rk, CASE WHEN cap::DOUBLE / weight > level THEN water * weight ELSE cap::DOUBLE END AS target FROM u),
q AS (
  SELECT d.*, t.source_size, t.rk, t.target,
    (sum(size) OVER (PARTITION BY t.rk ORDER BY o, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS reached
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT q.*, e.copy, (e.copy * source_size + reached)::DOUBLE / target AS v FROM q, (VALUES (0), (1), (2)) AS e(copy) WHERE size > 0),
x AS (SELECT *, (sum(size) OVER (ORDER BY v, rk, copy, o, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS run FROM c),
k AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM x WHERE run <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM q LEFT JOIN k ON q.doc_id IS NOT DISTINCT FROM k.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": OP1, "op4_exact_dedup": OP4, "op10_mixing": OP10}
