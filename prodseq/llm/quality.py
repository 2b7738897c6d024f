"""Quality rules: a ledger of failure bits and measurements, and policies over the bits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseq.llm.scratch import Scratch

#: Words in a window whose repetition is counted.
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A rule's failure as SQL over the measurements; its bit is its place in RULES."""

    name: str
    fails: str


#: Places are bits of stored ledgers: append only.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 8 * word_chars"),
    Rule("repeated_lines", "n_lines >= 3 AND 100 * n_dup_lines > 40 * n_lines"),
    Rule("capitals", "100 * n_capitals > 40 * word_chars"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
    Rule("letterless", "100 * n_letterless > 50 * n_words"),
    Rule("long_words", "100 * n_long_words > 15 * n_words"),
    Rule("bullet_lines", "n_lines >= 3 AND 100 * n_bullet_lines > 90 * n_lines"),
    Rule("cut_lines", "n_lines >= 3 AND 100 * n_cut_lines > 30 * n_lines"),
)

#: Each policy version and the rules that reject a document under it.
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "web-1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "web-2": ("few_words", "repeated_windows", "symbols", "repeated_lines", "capitals", "word_length"),
    "web-3": tuple(rule.name for rule in RULES),
}
BASE, CURRENT = "base-1", "web-3"

#: Code points beyond which a word is long.
LONG_WORD = 40


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    return sum(1 << bit for bit, rule in enumerate(RULES) if rule.name in POLICIES[policy])


def _repeat_words(words: Column, n_words: Column) -> Column:
    """Words that lie in a window found twice or more in the text.

    Window hashes only find the texts without any repetition; all others compare the
    words themselves: sorted windows equal to a neighbour are repeated, and their
    start positions in order give the words covered.
    """
    n = n_words - (WINDOW - 1)
    shifted = [F.slice(words, k + 1, n).alias(f"w{k}") for k in range(WINDOW)]
    hashes = F.transform(F.arrays_zip(*shifted), lambda window: F.xxhash64(window))
    repeats = F.size(F.array_distinct(hashes)) < n
    placed = F.sort_array(F.arrays_zip(*shifted, F.sequence(F.lit(1), n).alias("at")))
    # each lambda sees one variable, so that sorting happens once for a row
    same = lambda a, b: F.reduce(F.array(*(a[f"w{k}"] == b[f"w{k}"] for k in range(WINDOW))), F.lit(True), lambda x, y: x & y)
    pairs = lambda s: F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.when(same(a, b), F.array(a["at"], b["at"])))
    starts = F.sort_array(F.array_distinct(F.flatten(F.array_compact(F.element_at(F.transform(F.array(placed), pairs), 1)))))
    covered = lambda s: F.when(
        F.size(s) > 0,
        F.reduce(
            F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.least(F.lit(WINDOW), b - a)),
            F.lit(WINDOW),
            lambda total, step: total + step,
        ),
    ).otherwise(0)
    counted = F.element_at(F.transform(F.array(starts), covered), 1)
    return F.when(n_words < WINDOW + 1, 0).when(repeats, counted).otherwise(0)


def ledger(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Every rule evaluated once: ``row`` (the input row), measurements and ``fail_bits``.

    The input row travels as one struct, so its columns never clash with the ledger's.
    A missing or empty text has no words, fails ``few_words`` and nothing is missing in
    its measurements. Repeated rows are each kept; an empty table gives an empty ledger.
    """
    text = F.coalesce(F.col("row")[text_column], F.lit(""))
    measured = (
        docs.select(F.struct("*").alias("row"))
        .withColumn("words", F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), ""))
        .withColumn("lines", F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")))
        .withColumn("n", F.size("words"))
        .select(
            "row",
            # a generator: filters on measurements stay above it and measure nothing again
            F.explode(F.array(F.struct(
            F.col("n").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            _repeat_words(F.col("words"), F.col("n")).cast("long").alias("n_repeat_words"),
            F.size(F.filter("words", lambda word: ~word.rlike("\\p{L}"))).cast("long").alias("n_letterless"),
            F.size(F.filter("words", lambda word: F.length(word) > LONG_WORD)).cast("long").alias("n_long_words"),
            F.size(F.filter("lines", lambda line: line.rlike("^[\\x20\\t]*[-*\u2022]"))).cast("long").alias("n_bullet_lines"),
            F.size(F.filter("lines", lambda line: line.rlike("(\\.\\.\\.|\u2026)[\\x20\\t\\r]*\\z"))).cast("long").alias("n_cut_lines"),
            ))).alias("m"),
        )
        .select("row", "m.*")
    )
    bits = [F.when(F.expr(rule.fails), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long") for bit, rule in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("fail_bits", total)


def passes(policy: str) -> Column:
    """Whether no rule of the policy failed."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def store(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The ledger without the input's texts, written once: ``id``, measurements and ``fail_bits``.

    Policies and ablations read this table and evaluate no rule again. A row per input row,
    also for missing or repeated ids; an empty table gives an empty one.
    """
    rows = ledger(docs, text_column)
    return Scratch(docs.sparkSession, "quality").write(rows.select(F.col("row")[id_column].alias("id"), *rows.columns[1:]), "ledger")


def verdicts(stored: DataFrame, policy: str = CURRENT, id_column: str = "doc_id") -> DataFrame:
    """Rows of a stored ledger by id with the base verdict and the verdict of ``policy``.

    ``sole_failure`` names the rule that alone rejects the row under the policy. Texts of any
    length, missing ones and repeated rows are in the ledger, so each has its row here.
    """
    hit = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)))
    sole = F.coalesce(*(F.when(hit == (1 << bit), F.lit(rule.name)) for bit, rule in enumerate(RULES)))
    return stored.select(
        F.col("id").alias(id_column),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        (passes(BASE) & passes(policy)).alias("kept"),
        "n_lines", "n_capitals", "n_letterless", "n_long_words", "n_bullet_lines", "n_cut_lines", "fail_bits",
        F.lit(policy).alias("policy"),
        sole.alias("sole_failure"),
    )


def ablation(rows: DataFrame) -> DataFrame:
    """For each policy and rule: rows it fails, rows it alone rejects, rows kept with and without it.

    ``rows`` is a ledger or any table with ``fail_bits``. Rows are first counted by their
    bits (at most two to the number of rules groups); the rest is bit arithmetic on those.
    An empty ledger gives an empty result.
    """
    settings = [
        F.struct(F.lit(policy).alias("policy"), F.lit(rule.name).alias("rule"), F.lit(mask(policy)).alias("mask"), F.lit(1 << bit).alias("bit"))
        for policy, names in POLICIES.items()
        for bit, rule in enumerate(RULES)
        if rule.name in names
    ]
    hit, bits = F.col("fail_bits").bitwiseAND(F.col("s.mask")), F.col("fail_bits")
    rest = bits.bitwiseAND(F.col("s.mask").bitwiseAND(F.bitwise_not("s.bit")))
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return (
        rows.groupBy("fail_bits")
        .agg(F.count("*").alias("n"))
        .select("fail_bits", "n", F.explode(F.array(*settings)).alias("s"))
        .groupBy("s.policy", "s.rule")
        .agg(
            F.sum("n").alias("n_rows"),
            count(bits.bitwiseAND(F.col("s.bit")) != 0).alias("n_failed"),
            count(hit == F.col("s.bit")).alias("n_sole"),
            count(hit == 0).alias("n_kept"),
            count(rest == 0).alias("n_kept_without"),
        )
    )


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The input rows that pass the base rules and the policy, with their own columns only.

    Missing and empty texts fail; repeated rows pass or fail alike; an empty table stays empty.
    """
    return ledger(docs).filter(passes(BASE) & passes(policy)).select("row.*")


#: The verdicts as DuckDB SQL over the documents table, with numbers of its own.
VERDICTS_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT k, i, array_to_string(words[i:i + 4], chr(10)) AS v
  FROM (SELECT k, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
covered AS (
  SELECT k, count(DISTINCT i + d) AS n
  FROM (SELECT k, i, count(*) OVER (PARTITION BY k, v) AS c FROM windows), (SELECT unnest(range(0, 5)) AS d)
  WHERE c > 1 GROUP BY k),
m AS (
  SELECT w.k, doc_id, len(words) AS n_words,
    length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
    len(list_filter(words, lambda x: NOT regexp_matches(x, '\p{L}'))) AS n_letterless,
    len(list_filter(words, lambda x: length(x) > 40)) AS n_long_words,
    len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\t]*[-*•]'))) AS n_bullet_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\t\r]*\z'))) AS n_cut_lines,
    coalesce(covered.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered ON covered.k = w.k),
f AS (
  SELECT *, n_words < 10 AS few_words, n_repeat_words > 0.2 * n_words AS repeated_windows,
    n_symbols > 0.08 * word_chars AS symbols, n_lines >= 3 AND n_dup_lines > 0.4 * n_lines AS repeated_lines,
    n_capitals > 0.4 * word_chars AS capitals, word_chars NOT BETWEEN 2 * n_words AND 25 * n_words AS word_length,
    n_letterless > 0.5 * n_words AS letterless, n_long_words > 0.15 * n_words AS long_words,
    n_lines >= 3 AND n_bullet_lines > 0.9 * n_lines AS bullet_lines, n_lines >= 3 AND n_cut_lines > 0.3 * n_lines AS cut_lines
  FROM m),
b AS (
  SELECT *, CAST(few_words AS BIGINT) + 2 * CAST(repeated_windows AS BIGINT) + 4 * CAST(symbols AS BIGINT)
    + 8 * CAST(repeated_lines AS BIGINT) + 16 * CAST(capitals AS BIGINT) + 32 * CAST(word_length AS BIGINT)
    + 64 * CAST(letterless AS BIGINT) + 128 * CAST(long_words AS BIGINT) + 256 * CAST(bullet_lines AS BIGINT)
    + 512 * CAST(cut_lines AS BIGINT) AS fail_bits
  FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  few_words OR repeated_windows AS base_failed, fail_bits = 0 AS kept,
  CAST(n_lines AS BIGINT) AS n_lines, CAST(n_capitals AS BIGINT) AS n_capitals, CAST(n_letterless AS BIGINT) AS n_letterless,
  CAST(n_long_words AS BIGINT) AS n_long_words, CAST(n_bullet_lines AS BIGINT) AS n_bullet_lines,
  CAST(n_cut_lines AS BIGINT) AS n_cut_lines, CAST(fail_bits AS BIGINT) AS fail_bits, 'web-3' AS policy,
  CASE fail_bits WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_windows' WHEN 4 THEN 'symbols' WHEN 8 THEN 'repeated_lines'
    WHEN 16 THEN 'capitals' WHEN 32 THEN 'word_length' WHEN 64 THEN 'letterless' WHEN 128 THEN 'long_words'
    WHEN 256 THEN 'bullet_lines' WHEN 512 THEN 'cut_lines' END AS sole_failure
FROM b
"""

#: The ablations as DuckDB SQL over the documents table: policy, its bits, and the place of each rule.
ABLATION_SQL = f"""
WITH v AS ({VERDICTS_SQL}),
p(policy, mask) AS (VALUES ('base-1', 3), ('web-1', 15), ('web-2', 63), ('web-3', 1023)),
r(rule, bit) AS (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('repeated_lines', 8), ('capitals', 16),
  ('word_length', 32), ('letterless', 64), ('long_words', 128), ('bullet_lines', 256), ('cut_lines', 512))
SELECT p.policy AS policy, r.rule AS rule, count(*) AS n_rows,
  count(*) FILTER (WHERE (fail_bits & bit) <> 0) AS n_failed,
  count(*) FILTER (WHERE (fail_bits & mask) = bit) AS n_sole,
  count(*) FILTER (WHERE (fail_bits & mask) = 0) AS n_kept,
  count(*) FILTER (WHERE (fail_bits & (mask - bit)) = 0) AS n_kept_without
FROM v, p, r WHERE p.mask & r.bit <> 0 GROUP BY p.policy, r.rule
"""
