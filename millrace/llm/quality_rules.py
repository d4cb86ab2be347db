"""Document rules with host verdicts (DataFrame and SQL functions only).

How it works
    Every text gets counts from array functions within its row, so nothing is exploded: three-word windows are hashed to
    longs, the hash and the position share one long, and a primitive sort brings equal windows together. Windows that
    meet are compared word by word; should two different ones ever share a hash prefix, or a text have over a million
    words, that row sorts the windows themselves.

    A rule's failures are counted by host (combined on the map side), and so are documents that fail any rule. Across
    hosts an empirical beta prior is fitted to each count by moments; a host's rate is shrunk to it: (failures + a) /
    (documents + a + b). A host is flagged if the shrunk rate of one rule is over ``FLAG_RATE``, or that of any rule over
    the prior's mean by ``FLAG_SPREAD`` of its standard deviations: where hosts are alike that is none, where they differ
    the worst. Verdicts are joined back to documents (hosts with over a thousandth of all rows by broadcast). Of a
    flagged host only documents that fail no rule at all are kept, so clean ones stay.

Rules
    short: under 50 words. repeated: over half the words in repeated windows. symbols: over one symbol to ten words.
    lines: over 30 in 100 lines repeat an earlier one. lengths: mean word length under 2 or over 14 code points.

Defined results
    null text: no words, so base_failed. null host: a host of its own. null or repeated doc_id: rows like any others.
    Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_classes, materialize, words

RULES = ("short", "repeated", "symbols", "lines", "lengths")
FLAG_RATE, FLAG_SPREAD = 0.5, 2.0
#: Column of documents that fail any rule.
ANY = "any_rule"
#: Strength (a + b) of a prior: no weaker and no stronger than this.
PRIOR_RANGE = (1.0, 1000.0)

_COVERED = "aggregate(sort_array({positions}), named_struct('last', -3L, 'n', 0L), (a, p) -> named_struct('last', p, 'n', a.n + least(3L, p - a.last)), a -> a.n)"
_MEETS = "((j > 0 AND {before}) OR (j + 1 < size(s) AND {after}))"


def repeated_words_sql() -> str:
    """Words in three-word windows that occur twice or more; columns __w (words) and __h (hashes of the windows)."""

    def same(a, b):
        return f"shiftright({a}, 20) = shiftright({b}, 20)"

    def equal(a, b):
        return f"({a}.a = {b}.a AND {a}.b = {b}.b AND {a}.c = {b}.c)"

    at = lambda e: f"cast({e} & 1048575L AS int)"
    words_differ = " OR ".join(f"__w[{at('s[j - 1]')} + {k}] <> __w[{at('s[j]')} + {k}]" for k in range(3))
    clash = f"exists(sequence(1, size(s) - 1), j -> {same('s[j - 1]', 's[j]')} AND ({words_differ}))"
    fast = _COVERED.format(positions=f"transform(filter(s, (x, j) -> {_MEETS.format(before=same('s[j - 1]', 'x'), after=same('s[j + 1]', 'x'))}), x -> x & 1048575L)")
    whole = "sort_array(transform(sequence(0, size(__w) - 3), i -> named_struct('a', __w[i], 'b', __w[i + 1], 'c', __w[i + 2], 'p', cast(i AS bigint))))"
    slow = _COVERED.format(positions=f"transform(filter(s, (x, j) -> {_MEETS.format(before=equal('s[j - 1]', 'x'), after=equal('s[j + 1]', 'x'))}), x -> x.p)")
    exact = f"element_at(transform(array({whole}), s -> {slow}), 1)"
    packed = f"element_at(transform(array(sort_array(transform(__h, (x, i) -> (x & -1048576L) | i))), s -> CASE WHEN {clash} THEN -1L ELSE {fast} END), 1)"
    tried = f"CASE WHEN size(__w) >= 1048576 THEN -1L ELSE {packed} END"
    return f"CASE WHEN size(__h) < 2 OR size(array_distinct(__h)) = size(__h) THEN 0L ELSE element_at(transform(array({tried}), t -> CASE WHEN t < 0 THEN {exact} ELSE t END), 1) END"


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host, the counts and a 0/1 column for each rule."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(host_col)), F.lit("")).alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("__t"))
    rows = rows.withColumn("__w", words(F.col("__t"))).withColumn("__l", F.filter(F.split("__t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("__h", F.expr("CASE WHEN size(__w) < 3 THEN array() ELSE transform(sequence(0, size(__w) - 3), i -> xxhash64(__w[i], __w[i + 1], __w[i + 2])) END"))
    counted = rows.select(
        "doc_id",
        "host",
        F.size("__w").cast("long").alias("n_words"),
        F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        (F.char_length("__t") - F.char_length(F.regexp_replace("__t", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.expr(repeated_words_sql()).alias("n_repeat_words"),
    )
    fails = {
        "short": F.col("n_words") < 50,
        "repeated": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
        "lengths": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 14 * F.col("n_words")),
    }
    return counted.select("*", *[fails[r].cast("long").alias(r) for r in RULES]).withColumn(ANY, F.greatest(*RULES))


def host_verdicts(rows: DataFrame, rules=RULES, flag_rate: float = FLAG_RATE) -> DataFrame:
    """host, documents, a shrunk rate for each rule and for any (rate_<rule>), and flagged, from 0/1 columns of documents."""
    single, rules = rules, (*rules, ANY)
    hosts = materialize(rows.groupBy("host").agg(F.count(F.lit(1)).alias("documents"), *[F.sum(r).alias(r) for r in rules]), "hosts")
    total = F.sum("documents").cast("double")
    means = hosts.agg(total.alias("n"), F.count(F.lit(1)).alias("hosts"), *[(F.sum(r) / total).alias(r) for r in rules]).first()
    spread = hosts.agg(
        total.alias("n"),
        *[(F.sum(F.col("documents") * F.pow(F.col(r) / F.col("documents") - F.lit(means[r]), 2)) / total).alias(r) for r in rules],
    ).first()
    rates, limit = [], 1.0
    for r in rules:
        mean = means[r] or 0.0
        # between-host variance: what the rates vary by, less what chance alone gives
        chance = mean * (1 - mean) * means["hosts"] / means["n"] if means["n"] else 0.0
        between = max((spread[r] or 0.0) - chance, 0.0)
        strength = PRIOR_RANGE[1] if between <= 0 else min(PRIOR_RANGE[1], max(PRIOR_RANGE[0], mean * (1 - mean) / between - 1))
        rates.append(((F.col(r) + mean * strength) / (F.col("documents") + strength)).alias(f"rate_{r}"))
        limit = mean + FLAG_SPREAD * sqrt(mean * (1 - mean) / (strength + 1))  # the last one is that of any rule
    shrunk = hosts.select("host", "documents", *rates)
    return shrunk.withColumn("flagged", (F.greatest(*[F.col(f"rate_{r}") for r in single]) > flag_rate) | (F.col(f"rate_{ANY}") > limit))


def judge(docs: DataFrame, flag_rate: float = FLAG_RATE, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row a document: the counts, the rules, base_failed, host_flagged and kept."""
    rows = materialize(features(docs, id_col, text_col, host_col), "rules")
    hosts = materialize(host_verdicts(rows, flag_rate=flag_rate).select("host", "documents", F.col("flagged").alias("host_flagged")), "verdicts")
    total = hosts.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    judged = join_classes(rows, hosts, ["host"], "documents", total)
    judged = judged.withColumn("base_failed", (F.col("short") + F.col("repeated")) > 0)
    return judged.withColumn("kept", ~F.col("base_failed") & ~(F.col("host_flagged") & (F.col(ANY) > 0)))
