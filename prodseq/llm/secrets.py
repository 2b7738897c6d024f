"""Secret scan: a trigram inverted index finds candidate texts, regular expressions verify them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseq.llm.trigrams import trigram_query


@dataclass(frozen=True)
class SecretRule:
    """A kind of secret; a match counts if ``group`` of it has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int
    least: int
    base: bool = False


#: Kinds in listed order, the base kinds first.
RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, base=True),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20, base=True),
    SecretRule("hex", r"[0-9a-f]{24,}", 0, 24, base=True),  # shorter runs never count
    SecretRule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}", 0, 40),
    SecretRule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    SecretRule("maps", r"AIza[0-9A-Za-z_-]{35}", 0, 39),
    SecretRule("payment", r"[rs]k_live_[0-9A-Za-z]{24,}", 0, 32),
    SecretRule("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 30),
)


def postings(texts: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(key, gram): one row for each text and trigram that some rule's query holds."""
    grams = sorted({g for rule in rules for alternative in trigram_query(rule.pattern) for g in alternative})
    lowered = texts.select("key", F.lower("text").alias("text"))
    present = lowered.select("key", F.concat_ws("\n", *(F.when(F.contains("text", F.lit(g)), F.lit(g)) for g in grams)).alias("grams"))
    # no filter here: Catalyst would push it below and look for all trigrams twice
    return present.select("key", F.explode(F.split("grams", "\n")).alias("gram"))


def candidates(texts: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(key, rules): kinds whose trigram query the postings of a key satisfy.

    Postings of the trigrams of one alternative are intersected by counting them for each
    key; a key is a candidate when none is missing. The query table is as small as the
    rules. Rows that share a key share candidates, which verification corrects.
    """
    needed = [(g, rule.kind, i, len(alternative)) for rule in rules for i, alternative in enumerate(trigram_query(rule.pattern)) for g in alternative]
    by_gram: dict[str, list[Column]] = {}
    for gram, kind, i, size in needed:
        by_gram.setdefault(gram, []).append(F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("alternative"), F.lit(size).alias("size")))
    uses = F.create_map(*(x for gram, found in by_gram.items() for x in (F.lit(gram), F.array(*found))))
    return (
        postings(texts, rules)
        .select("key", "gram", F.explode(uses[F.col("gram")]).alias("use"))
        .groupBy("key", "use")
        .agg(F.size(F.collect_set("gram")).alias("present"))
        .filter(F.col("present") == F.col("use.size"))
        .groupBy("key")
        .agg(F.collect_set("use.kind").alias("rules"))
    )


def _found(text: Column, rule: SecretRule, place: int) -> Column:
    """Spans of a rule, leftmost without overlap, as (start, place, end) in code points.

    Splitting at the matches gives the lengths between them, so a start is the sum of
    the pieces up to it and of the matches before it.
    """
    pattern = F.lit(rule.pattern)
    row = F.struct(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gaps"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("sizes"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("checked"),
    )

    def spans(x: Column) -> Column:
        gaps_and_sizes = F.slice(F.arrays_zip(x["gaps"], x["sizes"], x["checked"]), 1, F.size(x["sizes"]))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,place:int,end:int>>").alias("spans"))

        def step(total: Column, piece: Column) -> Column:
            begin = total["at"] + piece["gaps"]
            end = begin + piece["sizes"]
            span = F.array(F.struct(begin.alias("start"), F.lit(place).alias("place"), end.alias("end")))
            return F.struct(end.alias("at"), F.when(piece["checked"] >= rule.least, F.concat(total["spans"], span)).otherwise(total["spans"]).alias("spans"))

        return F.reduce(gaps_and_sizes, start, step, lambda total: total["spans"])

    return F.element_at(F.transform(F.array(row), spans), 1)


def _number(spans: Column, place: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["place"] == place)).cast("long")


def _told(spans: Column, rules: tuple[SecretRule, ...]) -> Column:
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["place"]], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``row`` (the input row as a struct) and ``spans``: (start, place of the rule, end), sorted.

    A missing text counts as empty. Rows with missing or repeated ids are each scanned;
    an empty table gives an empty result. Rules without mandatory trigrams scan every text.
    """
    texts = docs.select(F.col(id_column).alias("key"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    found = candidates(texts, rules)
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(found, F.col("row")[id_column].eqNullSafe(F.col("key")), "left")
    text = F.coalesce(F.col("row")[text_column], F.lit(""))
    none = F.array().cast("array<struct<start:int,place:int,end:int>>")
    spans = []
    for place, rule in enumerate(rules):
        here = _found(text, rule, place)
        # the scan of a rule without trigrams first looks for any match at all
        chosen = F.array_contains("rules", rule.kind) if trigram_query(rule.pattern) else text.rlike(rule.pattern)
        spans.append(F.when(chosen, here).otherwise(none))
    return joined.select("row", F.sort_array(F.concat(*spans)).alias("spans"))


def secret_digest(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts of the base kinds, the digest of their spans and all spans, one row per input row."""
    base = [i for i, rule in enumerate(rules) if rule.base]
    here = F.col("spans")
    return find_secrets(docs, rules, id_column, text_column).select(
        F.col("row")[id_column].alias(id_column),
        *(_number(here, i).alias(f"n_{rules[i].kind}") for i in base),
        F.sha2(_told(F.filter(here, lambda s: s["place"].isin(base)), rules), 256).alias("base_sha256"),
        _told(here, rules).alias("spans"),
    )


def _digest_sql() -> str:
    parts = []
    for place, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"SELECT k, {place} AS place, '{rule.kind}' AS kind, string_split_regex(t, '{pattern}') AS gaps, "
            f"regexp_extract_all(t, '{pattern}') AS hits, regexp_extract_all(t, '{pattern}', {rule.group}) AS checked, {rule.least} AS least FROM d"
        )
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
p AS (
  SELECT k, place, kind, least, gaps, hits, checked, unnest(range(1, len(hits) + 1)) AS i FROM m WHERE len(hits) > 0),
s AS (
  SELECT k, place, kind,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS b,
    length(hits[i]) AS size
  FROM p WHERE length(checked[i]) >= least),
told AS (SELECT k, place, b, kind || ':' || b::BIGINT || ':' || (b + size)::BIGINT AS v FROM s),
g AS (
  SELECT k, {", ".join(f"count(*) FILTER (place = {i}) AS n_{rule.kind}" for i, rule in enumerate(RULES) if rule.base)},
    string_agg(v, ',' ORDER BY b, place) FILTER (place < {sum(rule.base for rule in RULES)}) AS base,
    string_agg(v, ',' ORDER BY b, place) AS spans
  FROM told GROUP BY k)
SELECT doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in RULES if rule.base)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.k = g.k
"""


#: The digest as DuckDB SQL over the documents table.
DIGEST_SQL = _digest_sql()
